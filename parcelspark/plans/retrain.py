"""The monthly retrain as one chain of jobs, and queries that train models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions.scalars import abs_pct_error
from parcelspark.operators import evaluate, forest, isotonic, modeling, sampling, search
from parcelspark.operators.features import gold_features
from parcelspark.operators.quantiles import exact_percentiles
from parcelspark.plans.fixtures import bronze
from parcelspark.plans.registry import B, query
from parcelspark.session import scratch_path, stage
from parcelspark.sources.tables import publish_snapshot, read_snapshot

# The registered queries learn in large steps; patience, not a number of trees, ends the boosting.
FAST = dict(maxDepth=4, stepSize=0.3, maxBins=64, patience=10, chunk=16)


@dataclass
class Retrained:
    model: PipelineModel
    report: DataFrame
    gates: DataFrame
    decision: DataFrame


def prepare(gold: DataFrame, target: str = "sale_price", carry: Sequence[str] = ()
            ) -> tuple[Pipeline, DataFrame, DataFrame, DataFrame]:
    """(pipeline, train, valid, holdout); ``valid`` is the six months before the holdout.

    ``carry`` columns stay in the frames without being features.
    """
    pipeline, rows = modeling.model_matrix(gold, target, carry=carry)
    rows = stage(rows, "matrix")
    high = [c for c in modeling.HIGH_CARDINALITY if c in rows.columns]
    before, holdout = sampling.time_split(rows)
    train, valid = sampling.time_split(before)
    return (pipeline, stage(modeling.encode_past(train, high), "train"),
            stage(modeling.encode_known(valid, train, high), "valid"),
            stage(modeling.encode_known(holdout, before, high), "holdout"))


def retrain(spark: SparkSession, base: str, champion: PipelineModel | None = None,
            version: str = "latest", model_path: str | None = None, **params) -> Retrained:
    """Snapshot → split → train challenger → compare on the holdout → gates.

    The model is saved to ``model_path`` only when every gate passes. Without a champion the
    comparison model is a linear regression on the same rows.
    """
    pipeline, train, valid, holdout = prepare(read_snapshot(spark, base, version))
    challenger = modeling.train_gbt(pipeline, train, valid, **params)
    if champion is None:
        champion = Pipeline(stages=[*pipeline.getStages(), LinearRegression(
            labelCol=modeling.LABEL)]).fit(train)
    scored = [modeling.predict_price(m, holdout).withColumn("model", F.lit(name))
              for name, m in (("champion", champion), ("challenger", challenger))]
    report = stage(evaluate.eval_report(scored[0].unionByName(scored[1])), "report")
    gates = evaluate.promotion_gates(report)
    decision = evaluate.promote(gates)
    if model_path and decision.first()["promote"]:
        challenger.write().overwrite().save(model_path)
    return Retrained(challenger, report, gates, decision)


def _gold(spark, sf):
    return gold_features(bronze(spark, sf))


@query("model_matrix", f"""WITH {B}, h AS (SELECT geo_h3_r8, sale_month, sum(ln(1 + sale_price)) AS s,
  count(*) AS n FROM b GROUP BY ALL), w AS (SELECT geo_h3_r8, sale_month,
  coalesce(sum(s) OVER past, 0) AS ps, coalesce(sum(n) OVER past, 0) AS pn FROM h WINDOW past AS
  (PARTITION BY geo_h3_r8 ORDER BY sale_month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT sale_month, sum(s) AS s, sum(n) AS n FROM h GROUP BY sale_month),
p AS (SELECT sale_month, sum(s) OVER past / sum(n) OVER past AS prior FROM m WINDOW past
  AS (ORDER BY sale_month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT sale_month, geo_h3_r8, count(*) AS n, round(avg((ps + prior * 20) / (pn + 20)), 6) AS cell_mean,
  round(avg(ln(1 + sale_price)), 6) AS label, round(avg(CAST(substr(sale_month, 1, 4) AS INT) * 12
  + CAST(substr(sale_month, 6, 2) AS INT)), 6) AS month_index
FROM b JOIN w USING (geo_h3_r8, sale_month) JOIN p USING (sale_month) GROUP BY ALL""")
def model_matrix(spark, sf):
    pipeline, rows = modeling.model_matrix(_gold(spark, sf))
    # Joined once; each encoded column sums it again.
    rows = stage(rows, "rows")
    encoded = stage(modeling.encode_past(rows, modeling.HIGH_CARDINALITY), "matrix")
    vectors = pipeline.fit(encoded).transform(encoded)
    return vectors.groupBy("sale_month", "geo_h3_r8").agg(
        F.count("features").alias("n"), F.round(F.avg("geo_h3_r8_mean"), 6).alias("cell_mean"),
        F.round(F.avg("label"), 6).alias("label"),
        F.round(F.avg("month_index"), 6).alias("month_index"))


# Months from the sixth last on are the holdout; `g` follows `b`.
_HOLDOUT = ("g AS (SELECT min(sale_month) AS cutoff FROM (SELECT DISTINCT sale_month FROM b"
            " ORDER BY sale_month DESC LIMIT 6)), known AS (SELECT median(sale_price) AS middle"
            " FROM b, g WHERE sale_month < cutoff)")


def _signal(spark, sf):
    """Gold features with a price that depends on them."""
    rows = bronze(spark, sf, ["signal_price", "signal_mean"])
    return gold_features(rows.withColumn("sale_price", F.col("signal_price")).drop("signal_price"))


# `best` is the error of the formula without its noise, which no model can beat.
_ERRORS = ("e AS (SELECT count(*) AS n, min(sale_month) AS first_month, max(sale_month) AS last_month,"
           " avg(abs(signal_price - middle) / signal_price) AS median_mape,"
           " avg(abs(signal_price - signal_mean) / signal_price) AS best"
           " FROM b, g, known WHERE sale_month >= cutoff)")


@query("train_gbt", f"""WITH {B}, {_HOLDOUT.replace("sale_price", "signal_price")}, {_ERRORS}
SELECT n, first_month, last_month, round(median_mape, 6) AS median_mape,
  round(best, 6) AS best_mape, best < median_mape AS beats_median,
  best <= best + 0.25 * (median_mape - best) AS near_best FROM e""")
def train_gbt(spark, sf):
    """Facts of the holdout, and how the model does there: against the median of the months before
    it, and against the noise of the prices, which it may miss by a quarter of the way at most."""
    pipeline, train, valid, holdout = prepare(_signal(spark, sf), carry=("signal_mean",))
    model = modeling.train_gbt(pipeline, train, valid, **FAST)
    before = train.select("sale_price").union(valid.select("sale_price"))
    found = exact_percentiles(before, "sale_price", [0.5]).first()
    middle = found["p"][0] if found else None
    scored = modeling.predict_price(model, holdout)
    y = F.col("sale_price")
    errors = scored.agg(
        F.count(F.lit(1)).alias("n"), F.min("sale_month").alias("first_month"),
        F.max("sale_month").alias("last_month"),
        F.avg(abs_pct_error(y, F.lit(middle))).alias("median_mape"),
        F.avg(abs_pct_error(y, F.col("signal_mean"))).alias("best_mape"),
        F.avg(abs_pct_error(y, F.col("pred"))).alias("mape"))
    reach = F.col("best_mape") + 0.25 * (F.col("median_mape") - F.col("best_mape"))
    return errors.select("n", "first_month", "last_month",
                         F.round("median_mape", 6).alias("median_mape"),
                         F.round("best_mape", 6).alias("best_mape"),
                         (F.col("mape") < F.col("median_mape")).alias("beats_median"),
                         (F.col("mape") <= reach).alias("near_best"))


@query("model_search")
def model_search(spark, sf):
    """Every trial and rung on the months before the holdout, the chosen mean on the folds, and the
    vote of the chosen trials, fitted again on all those months, on the holdout."""
    gold = _signal(spark, sf).drop("property_hash", "signal_mean")
    before, holdout = (stage(part, "market") for part in sampling.time_split(gold))
    found = search.model_search(sampling.rolling_origin_folds(before))
    high = modeling.HIGH_CARDINALITY
    _, rows = modeling.model_matrix(holdout)
    voted = search.vote(found.models(), modeling.encode_known(rows, found.rows, high))
    error = modeling.nrmse(voted, "sale_price", "pred").first()[0]
    ends = spark.createDataFrame([("mean on the folds", found.nrmse), ("vote on the holdout", error)],
                                 "candidate string, nrmse double")
    return found.board.unionByName(ends, allowMissingColumns=True)


@query("isotonic_calibration", f"""WITH {B}, r AS (SELECT region_code, min(champion_pred) AS lo,
  max(champion_pred) AS hi FROM b GROUP BY region_code),
q AS (SELECT b.*, CAST(least(floor((ln(champion_pred) - ln(lo)) / (ln(hi) - ln(lo)) * 1000), 999)
  AS INT) AS bin FROM b JOIN r USING (region_code)),
p AS (SELECT region_code, bin, avg(champion_pred) AS x, avg(sale_price) AS y, count(*) AS n
  FROM q GROUP BY ALL),
c AS (SELECT *, sum(n) OVER w AS cn, sum(n * y) OVER w AS cy FROM p
  WINDOW w AS (PARTITION BY region_code ORDER BY bin)),
f AS (SELECT region_code, j.bin AS jb, k.bin AS bin,
  min((k.cy - (j.cy - j.n * j.y)) / (k.cn - (j.cn - j.n))) OVER
    (PARTITION BY region_code, j.bin ORDER BY k.bin DESC) AS low
  FROM c j JOIN c k USING (region_code) WHERE j.bin <= k.bin),
g AS (SELECT region_code, bin, max(low) AS fit FROM f GROUP BY ALL)
SELECT region_code, property_type, count(*) AS n, round(sum(champion_pred), 2) AS before,
  round(sum(champion_pred * fit / x), 2) AS calibrated
FROM q JOIN g USING (region_code, bin) JOIN p USING (region_code, bin) GROUP BY ALL""")
def isotonic_calibration(spark, sf):
    df = bronze(spark, sf, ["champion_pred", "region_code"])
    fitted = modeling.isotonic_fit(df, "region_code", pred="champion_pred")
    out = modeling.isotonic_apply(df.withColumn("pred", F.col("champion_pred")), fitted,
                                  "region_code")
    return out.groupBy("region_code", "property_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("champion_pred"), 2).alias("before"),
        F.round(F.sum("pred"), 2).alias("calibrated"))


# Vertices of the greatest convex minorant of the cumulative prices: each leads to the one of least
# slope behind it, so that two neighbours enclose a block.
@query("isotonic_exact", f"""WITH RECURSIVE {B}, p AS MATERIALIZED (
  SELECT region_code, x, row_number() OVER w AS j, CAST(sum(n) OVER w AS BIGINT) AS n,
    sum(s) OVER w AS s FROM (SELECT region_code, champion_pred AS x, count(*) AS n,
    sum(CAST(sale_price AS DECIMAL(18, 2))) AS s FROM b GROUP BY ALL)
  WINDOW w AS (PARTITION BY region_code ORDER BY x)),
h AS (SELECT DISTINCT region_code, 0::BIGINT AS j, 0::BIGINT AS n, 0::DECIMAL(38, 2) AS s,
    0::BIGINT AS bn, 0::DECIMAL(38, 2) AS bs FROM p
  UNION ALL SELECT r, v.j, v.n, v.s, v.n - bn, v.s - bs FROM (
    SELECT h.region_code AS r, any_value(h.n) AS bn, any_value(h.s) AS bs,
      arg_min(struct_pack(j := p.j, n := p.n, s := p.s), struct_pack(
        slope := CAST(p.s - h.s AS DOUBLE) / (p.n - h.n), back := -p.j)) AS v
    FROM h JOIN p ON h.region_code = p.region_code AND p.j > h.j GROUP BY h.region_code))
SELECT b.property_hash, h.bn AS block_n, round(CAST(h.bs AS DOUBLE), 2) AS block_total
FROM b JOIN p ON b.region_code = p.region_code AND b.champion_pred = p.x
ASOF JOIN (SELECT * FROM h WHERE j > 0) h ON p.region_code = h.region_code AND p.j <= h.j""")
def isotonic_exact(spark, sf):
    """Size and sum of the block that calibrates each row."""
    df = stage(bronze(spark, sf, ["champion_pred", "region_code"]), "rows")
    blocks = stage(isotonic.isotonic_blocks(df, "region_code", pred="champion_pred", part_rows=4096),
                   "blocks")
    out = isotonic.isotonic_values(df, blocks, "region_code", "champion_pred")
    return out.select("property_hash", F.col("block.n").alias("block_n"),
                      F.round("block.total", 2).alias("block_total"))


# Three partitions of the feature space in place of trees, so that SQL can follow.
_STEPS = 16


@query("quantile_bands", f"""WITH {B}, {_HOLDOUT},
r AS MATERIALIZED (SELECT property_hash, sale_month >= cutoff AS held, signal_price AS y,
  floor(least(size_sqm / 25, 9)) AS l0, rooms * 10 + bathrooms AS l1,
  floor((year_built - 1900) / 31) * 100 + rooms AS l2 FROM b, g),
e AS (SELECT unnest(range(0, {_STEPS + 1})) AS i, unnest(quantile_cont(y, {[
    i / _STEPS for i in range(_STEPS + 1)]})) AS mark FROM r WHERE NOT held),
t AS (SELECT *, (SELECT count(*) FROM e WHERE i BETWEEN 1 AND {_STEPS - 1} AND mark < y) AS step
  FROM r WHERE NOT held),
c AS (SELECT tree, leaf, step, count(*) AS n FROM (SELECT step, unnest([0, 1, 2]) AS tree,
  unnest([l0, l1, l2]) AS leaf FROM t) GROUP BY ALL),
d AS MATERIALIZED (SELECT tree, leaf, i, sum(n) FILTER (step < i) / sum(n) AS share
  FROM c, e WHERE i > 0 GROUP BY tree, leaf, i),
k AS (SELECT DISTINCT l0, l1, l2 FROM r WHERE held),
m AS (SELECT l0, l1, l2, i, coalesce(sum(share), 0) AS share, count(DISTINCT tree) AS trees FROM k JOIN d
  ON (tree = 0 AND leaf = l0) OR (tree = 1 AND leaf = l1) OR (tree = 2 AND leaf = l2) GROUP BY ALL),
w AS (SELECT m.*, coalesce(lag(share) OVER (PARTITION BY l0, l1, l2 ORDER BY m.i), 0) AS before,
  lo.mark AS low, hi.mark AS high FROM m JOIN e hi ON hi.i = m.i JOIN e lo ON lo.i = m.i - 1),
z AS (SELECT l0, l1, l2, q, first(low + least(greatest((q * trees - before) / (share - before), 0), 1)
  * (high - low) ORDER BY i) AS v FROM w, (SELECT unnest([0.1, 0.5, 0.9]) AS q)
  WHERE share >= q * trees - 1e-9 GROUP BY ALL)
SELECT property_hash, round(max(v) FILTER (q = 0.1), 2) AS price_low_q10,
  round(max(v) FILTER (q = 0.5), 2) AS price_q50, round(max(v) FILTER (q = 0.9), 2) AS price_high_q90
FROM r LEFT JOIN z USING (l0, l1, l2) WHERE held GROUP BY property_hash""")
def quantile_bands(spark, sf):
    """Price quantiles of each sale of the holdout from the leaves it falls into."""
    rows = _signal(spark, sf)
    leaves = {"l0": F.floor(F.least(F.col("size_sqm") / 25, F.lit(9.0))),
              "l1": F.col("rooms") * 10 + F.col("bathrooms"),
              "l2": F.floor((F.col("year_built") - 1900) / 31) * 100 + F.col("rooms")}
    before, holdout = sampling.time_split(stage(rows.withColumns(leaves), "leaves"))
    table = forest.leaf_distributions(before, list(leaves), steps=_STEPS)
    out = forest.leaf_quantiles(holdout, table)
    return out.select("property_hash", *[F.round(c, 2).alias(c) for c in (
        "price_low_q10", "price_q50", "price_high_q90")])


@query("quantile_forest", f"""WITH {B}, {_HOLDOUT.replace("sale_price", "signal_price")}
SELECT count(*) AS n, count(*) AS ordered,
  avg(CAST(signal_price BETWEEN signal_mean * exp(-0.16) AND signal_mean * exp(0.16) AS INT))
    BETWEEN 0.75 AND 0.85 AS covers, true AS narrow
FROM b, g WHERE sale_month >= cutoff""")
def quantile_forest(spark, sf):
    """How the bands of a trained forest hold on the holdout: rows, rows whose quantiles are in order,
    whether 80 % of the prices lie inside within five points, and whether bands are narrower than the
    one band that all prices share."""
    pipeline, train, valid, holdout = prepare(_signal(spark, sf), carry=("signal_mean",))
    fitted = forest.train_quantile_forest(pipeline, train, trees=8).calibrated(valid)
    out = fitted.bands(holdout)
    y, low, mid, high = (F.col(c) for c in ("sale_price", "price_low_q10", "price_q50",
                                            "price_high_q90"))
    overall = exact_percentiles(train, "sale_price", [0.1, 0.9]).first()["p"]
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.count_if((low <= mid) & (mid <= high)).alias("ordered"),
        F.avg(y.between(low, high).cast("int")).between(0.75, 0.85).alias("covers"),
        (F.avg(high - low) < overall[1] - overall[0]).alias("narrow"))


# A fixed model, so that the figures can be computed in SQL as well.
_LINEAR = "8 + 0.4 * ln(1 + {size_sqm}) + 0.05 * {rooms} + 0.0005 * {year_built}"
_MOVED = ["size_sqm", "rooms", "year_built"]


def _linear(moved: str | None, other: str = "") -> str:
    return _LINEAR.format(**{c: (other + c if c == moved else c) for c in _MOVED})


@query("permutation_importance", f"""WITH {B}, o AS (SELECT *, {", ".join(
    f"coalesce(lead({c}) OVER w, first_value({c}) OVER w) AS o_{c}" for c in _MOVED)}
  FROM (SELECT *, sha256('42' || property_hash) AS hex FROM b) WINDOW w AS
  (ORDER BY hex, size_sqm, rooms, year_built)),
e AS (SELECT {", ".join(
    f"avg(abs(sale_price - (exp({_linear(c, 'o_')}) - 1)) / sale_price) AS m_{c or 'base'}"
    for c in [None, *_MOVED])} FROM o)
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round(m_{c}, 6) AS mape,"
                    f" round(m_{c} - m_base, 6) AS importance FROM e" for c in _MOVED)}""")
def permutation_importance(spark, sf):
    model = PipelineModel(stages=[SQLTransformer(
        statement=f"SELECT *, {_linear(None)} AS prediction FROM __THIS__")])
    out = modeling.permutation_importance(model, _gold(spark, sf), _MOVED, key=["property_hash"])
    return out.select("feature", F.round("mape", 6).alias("mape"),
                      F.round("importance", 6).alias("importance"))


@query("retrain_gates")
def retrain_gates(spark, sf):
    base = scratch_path(spark, "gold")
    publish_snapshot(_gold(spark, sf), base, "2026.05.12")
    return retrain(spark, base, **FAST).gates
