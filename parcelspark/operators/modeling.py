"""Model data, training, search, calibration and importance with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions.hashing import digest
from parcelspark.functions.scalars import abs_pct_error, month_index
from parcelspark.operators import trees
from parcelspark.operators.skew import HOT_ROWS, lookup_join
from parcelspark.operators.trees import GBTRegressor
from parcelspark.session import shared_folder, stage

# Categorical columns, and columns that are no features.
LOW_CARDINALITY = ["property_type", "size_band"]
HIGH_CARDINALITY = ["geo_h3_r8", "postcode_prefix"]
NON_FEATURES = ["property_hash", "ingested_at", "source_file"]
LABEL = "label"
# Trees without a better error on the validation rows that end the boosting (fixed value), and the
# trees that are fitted before the error is looked at again.
PATIENCE, CHUNK = 50, 32

# Settings of the gradient-boosted challenger.
GBT_DEFAULTS = dict(lossType="absolute", maxIter=2000, stepSize=0.03, maxDepth=7,
                    minInstancesPerNode=50, featureSubsetStrategy="0.8", subsamplingRate=0.8,
                    seed=42)


def _smoothed(total, n, prior, weight):
    return (F.coalesce(total, F.lit(0.0)) + prior * weight) / (F.coalesce(n, F.lit(0)) + weight)


def encode_past(train: DataFrame, cols: Sequence[str], y: str = LABEL, month: str = "sale_month",
                weight: float = 20.0) -> DataFrame:
    """Add ``{col}_mean``: the smoothed mean label of the value's rows in earlier months.

    No row sees its own month, so the encoding cannot leak its label. Labels are summed per value
    and month first; the prior is the mean of all earlier months. The first month has no past: its
    encoding is null, for the imputer to fill.
    """
    overall = Window.partitionBy(F.lit(True)).orderBy(month).rowsBetween(
        Window.unboundedPreceding, -1)
    # One row per month.
    prior = stage(train.groupBy(month).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
                  .select(month, F.try_divide(F.sum("_s").over(overall), F.sum("_n").over(overall))
                          .alias("_prior")), "prior")
    out = lookup_join(train, prior, [month])
    for c in cols:
        past = Window.partitionBy(c).orderBy(month).rowsBetween(Window.unboundedPreceding, -1)
        sums = stage(train.groupBy(c, month).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
                     .select(c, month, F.sum("_s").over(past).alias("_ps"),
                             F.sum("_n").over(past).alias("_pn")), "past")
        out = lookup_join(out, sums, [c, month]).withColumn(
            f"{c}_mean", _smoothed(F.col("_ps"), F.col("_pn"), F.col("_prior"), weight)
        ).drop("_ps", "_pn")
    return out.drop("_prior")


def encode_known(df: DataFrame, history: DataFrame, cols: Sequence[str], y: str = LABEL,
                 weight: float = 20.0) -> DataFrame:
    """Add ``{col}_mean`` from all rows of ``history``; an unknown value gets the overall mean."""
    prior = history.agg(F.coalesce(F.avg(y), F.lit(0.0)).alias("m")).scalar()
    for c in cols:
        sums = stage(history.groupBy(c).agg(F.sum(y).alias("_ps"), F.count(y).alias("_pn")),
                     "known")
        df = lookup_join(df, sums, [c]).withColumn(
            f"{c}_mean", _smoothed(F.col("_ps"), F.col("_pn"), prior, weight)).drop("_ps", "_pn")
    return df


def model_matrix(df: DataFrame, target: str = "sale_price",
                 categorical: Sequence[str] = LOW_CARDINALITY,
                 high_card: Sequence[str] = HIGH_CARDINALITY,
                 drop: Sequence[str] = NON_FEATURES, month: str = "sale_month",
                 carry: Sequence[str] = ("fold", "role")) -> tuple[Pipeline, DataFrame]:
    """(pipeline up to the feature vector, frame with ``label`` = log1p(target)).

    ``carry`` columns stay in the frame without being features. ``categorical`` columns are indexed,
    with their labels in the model; columns with very many values belong in ``high_card`` and enter
    as ``{col}_mean`` (see :func:`encode_past`). The month enters as a number.
    """
    out = df.drop(*drop)
    categorical = [c for c in categorical if c in out.columns]
    high_card = [c for c in high_card if c in out.columns]
    out = out.withColumn(LABEL, F.log1p(target))
    if month in out.columns:
        out = out.withColumn("month_index", month_index(F.col(month)).cast("double"))
    skip = {target, LABEL, month, *categorical, *high_card, *carry}
    numeric = [f.name for f in out.schema
               if f.dataType.typeName() in ("double", "float", "integer", "long", "short")
               and f.name not in skip and not f.name.endswith("_mean")]
    out = out.withColumns({c: F.col(c).cast("double") for c in numeric})
    numeric += [f"{c}_mean" for c in high_card]
    stages = [Imputer(inputCols=numeric, outputCols=[f"{c}_filled" for c in numeric],
                      strategy="mean")]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical,
                                    outputCols=[f"{c}_index" for c in categorical],
                                    handleInvalid="keep"))
    stages.append(VectorAssembler(
        inputCols=[f"{c}_filled" for c in numeric] + [f"{c}_index" for c in categorical],
        outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages), out


def _checkpoint_folder(train: DataFrame) -> None:
    """The shared folder also receives the checkpoints of iterative training."""
    folder = shared_folder(train.sparkSession)
    if not train.sparkSession.sparkContext.getCheckpointDir():
        train.sparkSession.sparkContext.setCheckpointDir(folder)


def _with_bins(regressor, features: PipelineModel):
    """A copy of the regressor with bins for all labels, if it is a tree learner."""
    if not regressor.hasParam("maxBins"):
        return regressor.copy()
    return regressor.copy({regressor.maxBins: bins_for(features, regressor.getMaxBins())})


def fit_over(features: PipelineModel, regressors: dict[str, object], train: DataFrame,
             concurrent: int = 1) -> dict[str, object]:
    """Each regressor fitted on the rows of ``train``; ``concurrent`` of them at a time.

    Rows are prepared once for all: in blocks for trees, forests and boosting, which take most of the
    time, and as vectors for the others.
    """
    _checkpoint_folder(train)
    asked = {name: _with_bins(r, features) for name, r in regressors.items()}
    sizes = {r.getMaxBins() for r in asked.values() if trees.grows(r)}
    blocks = {most: trees.make_blocks(features, train, most) for most in sizes}
    vectors = features.transform(train).select(LABEL, "features")
    if not all(trees.grows(r) for r in asked.values()):
        vectors = vectors.persist(StorageLevel.DISK_ONLY)
        vectors.count()

    def fit(name: str):
        r = asked[name]
        return trees.fit(r, blocks[r.getMaxBins()]) if trees.grows(r) else r.fit(vectors)

    with ThreadPool(min(concurrent, len(asked))) as pool:
        fitted = dict(zip(asked, pool.map(inheritable_thread_target(train.sparkSession)(fit), asked)))
    for b in blocks.values():
        b.unpersist()
    vectors.unpersist()
    return fitted


def fit_all(pipeline: Pipeline, regressors: Sequence, train: DataFrame) -> list[PipelineModel]:
    """Each regressor behind the feature stages; rows are prepared once."""
    features = pipeline.fit(train)
    fitted = fit_over(features, {str(i): r for i, r in enumerate(regressors)}, train)
    return [PipelineModel(stages=[*features.stages, m]) for m in fitted.values()]


def bins_for(features: PipelineModel, least: int = 256) -> int:
    """Bins that tree learners need: one for each label of an indexed column, and the unknown."""
    labels = [len(x) for s in features.stages if hasattr(s, "labelsArray") for x in s.labelsArray]
    return max([least, *[n + 1 for n in labels]])


def train_gbt(pipeline: Pipeline, train: DataFrame, valid: DataFrame | None = None,
              patience: int = PATIENCE, chunk: int = CHUNK, **params) -> PipelineModel:
    """Gradient-boosted trees on the absolute error of ``label``.

    Boosting goes on by chunks of ``chunk`` trees. The first tree of a chunk fits what the trees so
    far leave, the others the sign of it in steps of ``stepSize``; what is left after a tree is
    kept, so no tree is fitted or applied twice. Rows are put into bins once for all trees. With ``valid`` the model keeps the trees up to
    the lowest error there, once ``patience`` trees passed without a lower one; ``maxIter`` bounds their
    number. Feature stages are fitted on ``train`` only. ``valid`` must not be the holdout that is
    reported: take the last months before it.
    """
    settings = GBT_DEFAULTS | params
    features = pipeline.fit(train)
    gbt = GBTRegressor(featuresCol="features", labelCol=LABEL, maxBins=bins_for(
        features, max(settings.pop("maxBins", 256), 2)), **settings)
    _checkpoint_folder(train)
    blocks = trees.make_blocks(features, train, gbt.getMaxBins(), settings["seed"], valid)
    if valid is None:
        return PipelineModel(stages=[*features.stages, trees.fit(gbt, blocks)])
    most = settings["maxIter"]
    grown, weights, errors = [], [], []
    while True:
        part = gbt.copy({gbt.maxIter: min(chunk, most - len(errors)),
                         gbt.seed: settings["seed"] + len(errors)}).fit(blocks)
        blocks.unpersist()
        blocks = part.left
        grown, weights, errors = grown + part.trees, weights + part.weights, errors + part.errors
        best = int(np.argmin(errors)) + 1
        if best + patience <= len(errors) or len(errors) >= most:
            break
    blocks.unpersist()
    model = trees.boosted_model(gbt, grown[:best], weights[:best], blocks.bins)
    return PipelineModel(stages=[*features.stages, model])


def predict_price(model: PipelineModel, df: DataFrame, out: str = "pred") -> DataFrame:
    scored = model.transform(df)
    return scored.withColumn(out, F.expm1("prediction")).select(*df.columns, out)


def nrmse(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row: root mean squared error over the range of the target."""
    square = F.avg((F.col(y) - F.col(pred)) * (F.col(y) - F.col(pred)))
    return df.agg(F.try_divide(F.sqrt(square), F.max(y) - F.min(y)).alias("nrmse"))


# ---- calibration ------------------------------------------------------------------------------

def _bin_of(pred, low, high, bins):
    span = F.try_divide(F.log(pred) - F.log(low), F.log(high) - F.log(low))
    return F.least(F.greatest(F.floor(F.coalesce(span, F.lit(0.0)) * bins), F.lit(0)),
                   F.lit(bins - 1)).cast("int")


def isotonic_fit(df: DataFrame, region: str, y: str = "sale_price", pred: str = "pred",
                 bins: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(ranges, curve) of an isotonic calibration per region.

    Predictions are summed into at most ``bins`` log-spaced bins per region, so what one task fits
    is bounded whatever the region's size. ``curve`` has one factor per region and bin.
    """
    df = df.filter(F.col(region).isNotNull() & (F.col(pred) > 0))
    ranges = stage(df.groupBy(region).agg(F.min(pred).alias("_low"), F.max(pred).alias("_high")),
                   "ranges")
    placed = lookup_join(df, ranges, [region], "inner").withColumn(
        "bin", _bin_of(F.col(pred), F.col("_low"), F.col("_high"), bins))
    points = placed.groupBy(region, "bin").agg(
        F.avg(pred).alias("x"), F.avg(y).alias("y"), F.count(F.lit(1)).alias("n"))

    def pool(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin")
        blocks: list[list[float]] = []
        for value, weight in zip(rows["y"], rows["n"].astype(float)):
            blocks.append([value, weight, 1])
            while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
                v, w, k = blocks.pop()
                b = blocks[-1]
                b[0], b[1], b[2] = (b[0] * b[1] + v * w) / (b[1] + w), b[1] + w, b[2] + k
        fitted = np.concatenate([np.full(int(k), v) for v, _, k in blocks])
        every = np.arange(bins)
        factor = np.interp(every, rows["bin"], fitted / rows["x"].to_numpy())
        return pd.DataFrame({region: rows[region].iloc[0], "bin": every.astype("int32"),
                             "factor": factor})

    kind = df.schema[region].dataType.simpleString()
    curve = points.groupBy(region).applyInPandas(pool, f"{region} {kind}, bin int, factor double")
    return ranges, stage(curve, "curve")


def isotonic_apply(df: DataFrame, fitted: tuple[DataFrame, DataFrame], region: str,
                   pred: str = "pred", bins: int = 1000) -> DataFrame:
    """Multiply the prediction by its region's factor; unknown regions keep it."""
    ranges, curve = fitted
    placed = lookup_join(df, ranges, [region]).withColumn(
        "bin", F.when(F.col(pred) > 0, _bin_of(F.col(pred), F.col("_low"), F.col("_high"), bins)))
    return (lookup_join(placed, curve, [region, "bin"])
            .withColumn(pred, F.col(pred) * F.coalesce("factor", F.lit(1.0)))
            .drop("_low", "_high", "bin", "factor"))


# ---- importance -------------------------------------------------------------------------------

def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str],
                           y: str = "sale_price", key: Sequence[str] = (), seed: str = "42",
                           bucket_rows: int = HOT_ROWS // 10) -> DataFrame:
    """Growth of the MAPE when one feature is taken from another row: (feature, mape, importance).

    Rows are hashed into buckets of about ``bucket_rows``; inside a bucket each row takes the value
    of the next row in digest order, the last one that of the first.
    """
    key = list(key) or [c for c in df.columns]
    rows = df.count()
    buckets = max(rows // bucket_rows, 1)
    # Buckets come from the digest, so the figures don't depend on how the rows lie.
    mixed = df.withColumn("_hex", digest(seed, *key)).withColumn(
        "_bucket", F.pmod(F.xxhash64("_hex"), F.lit(buckets)))
    order = Window.partitionBy("_bucket").orderBy("_hex", *features)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    others = {f"_other_{f}": F.struct(F.coalesce(
        F.lead(F.struct(f)).over(order), F.first(F.struct(f)).over(whole))[f].alias("v"))
        for f in features}
    mixed = stage(mixed.withColumns(others).drop("_hex", "_bucket"), "shuffled")

    def error(frame, name):
        scored = predict_price(model, frame.select(*df.columns), "pred")
        return scored.agg(F.lit(name).alias("feature"),
                          F.avg(abs_pct_error(F.col(y), F.col("pred"))).alias("mape"))

    parts = [error(mixed, "")] + [
        error(mixed.withColumn(f, F.col(f"_other_{f}")["v"]), f) for f in features]
    # One row per feature.
    errors = stage(reduce(DataFrame.unionByName, parts), "errors")
    base = errors.filter(F.col("feature") == "").select("mape").scalar()
    return (errors.filter(F.col("feature") != "")
            .withColumn("importance", F.col("mape") - base))
