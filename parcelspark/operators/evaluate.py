"""Error metrics, slices, champion-challenger report and promotion gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.scalars import abs_pct_error
from parcelspark.operators.quantiles import exact_percentiles

# Smallest slice, and the thresholds of the promotion gates.
MIN_SLICE_ROWS = 30
GLOBAL_IMPROVE = 0.02
SLICE_REGRESSION_MAX = 0.05
CALIBRATION = (0.97, 1.03)
LATENCY_SLACK_MS = 50.0


def _metrics(y: str, pred: str) -> dict[str, Column]:
    actual, guess = F.col(y), F.col(pred)
    sse = F.sum((actual - guess) * (actual - guess))
    return {
        "mape": F.avg(abs_pct_error(actual, guess)),
        "r2": 1 - F.try_divide(sse, F.var_pop(actual) * F.count(F.lit(1))),
        "calibration_ratio": F.try_divide(F.avg(guess), F.avg(actual)),
    }


def global_metrics(scored: DataFrame, y: str = "sale_price", pred: str = "pred",
                   by: Sequence[str] = ()) -> DataFrame:
    """MAPE, R2, calibration ratio and row count in one pass, per value of ``by``."""
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                   *[m.alias(k) for k, m in _metrics(y, pred).items()])


def with_error_slices(scored: DataFrame, y: str = "sale_price", postcode: str = "postcode_prefix",
                      property_type: str = "property_type", year_built: str = "year_built",
                      vision: str = "has_vision_score") -> tuple[DataFrame, dict[str, Column]]:
    """The frame and the five slice keys: region, type, price decile, vintage decade and vision.

    Decile edges come from the exact percentiles of the price, as one row.
    """
    edges = exact_percentiles(scored, y, [i / 10 for i in range(1, 10)])
    out = scored.withColumn("_edges", edges.select("p").scalar())
    decile = 1 + sum(((F.col("_edges")[i] < F.col(y)).cast("int") for i in range(9)), F.lit(0))
    slices = {
        "postcode_prefix": F.col(postcode),
        "property_type": F.col(property_type),
        "price_decile": decile.cast("string"),
        "vintage_decade": (F.floor(F.col(year_built) / 10) * 10).cast("string"),
        "vision": F.when(F.col(vision) == 1, "available").otherwise("missing"),
    }
    return out.withColumns({f"slice_{k}": c for k, c in slices.items()}).drop("_edges"), {
        k: F.col(f"slice_{k}") for k in slices}


def slice_mape(scored: DataFrame, slices: Mapping[str, Column] | Sequence[str],
               y: str = "sale_price", pred: str = "pred", min_rows: int = MIN_SLICE_ROWS,
               by: Sequence[str] = ()) -> DataFrame:
    """MAPE per (slice_kind, slice_value) for slices of at least ``min_rows`` rows.

    All kinds are computed in one pass with map-side partial sums; null slice values are left out.
    """
    if not isinstance(slices, Mapping):
        slices = {c: F.col(c) for c in slices}
    kinds = F.array(*[F.struct(F.lit(k).alias("slice_kind"), c.cast("string").alias("slice_value"))
                      for k, c in slices.items()])
    long = scored.select(*by, y, pred, F.inline(kinds)).filter(F.col("slice_value").isNotNull())
    return (long.groupBy(*by, "slice_kind", "slice_value")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(abs_pct_error(F.col(y), F.col(pred))).alias("mape"))
            .filter(F.col("n") >= min_rows))


def eval_report(scored_by_model: DataFrame, y: str = "sale_price", pred: str = "pred",
                slices: Sequence[str] | Mapping[str, Column] = ("property_type",
                                                               "postcode_prefix"),
                model: str = "model", min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """Long report (model, slice_kind, slice_value, metric, value) of one scored holdout."""
    overall = global_metrics(scored_by_model, y, pred, [model]).select(
        model, F.lit("global").alias("slice_kind"), F.lit("all").alias("slice_value"),
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                           for m in ("mape", "r2", "calibration_ratio")])))
    sliced = slice_mape(scored_by_model, slices, y, pred, min_rows, [model]).select(
        model, "slice_kind", "slice_value", F.lit("mape").alias("metric"),
        F.col("mape").alias("value"))
    return overall.unionByName(sliced)


def report_map(report: DataFrame, model: str = "model") -> DataFrame:
    """The report as one row per model with a map per slice kind."""
    def values(kind):
        mine = (F.col("slice_kind") == kind) & (F.col("metric") == "mape")
        return F.map_from_entries(F.filter(F.collect_list(F.when(
            mine, F.struct("slice_value", "value"))), lambda e: e.isNotNull()))

    def single(metric):
        return F.max(F.when((F.col("slice_kind") == "global") & (F.col("metric") == metric),
                            F.col("value")))

    return report.groupBy(model).agg(
        single("mape").alias("mape_global"), values("property_type").alias("by_property_type"),
        values("postcode_prefix").alias("by_postcode_prefix"),
        single("calibration_ratio").alias("calibration_ratio"))


def promotion_gates(report: DataFrame, latency: DataFrame | None = None,
                    importance: DataFrame | None = None, model: str = "model",
                    champion: str = "champion", challenger: str = "challenger",
                    improve: float = GLOBAL_IMPROVE, regress: float = SLICE_REGRESSION_MAX,
                    calib: tuple[float, float] = CALIBRATION,
                    p95_ms: float = LATENCY_SLACK_MS) -> DataFrame:
    """One row per check: gate, slice, champion and challenger value, figure, threshold, passed.

    Slices that one of the models lacks are skipped. ``latency`` (columns ``model``, ``p95``) adds
    the latency gate; ``importance`` (any rows) the explainability gate.
    """
    pick = {m: F.max(F.when(F.col(model) == m, F.col("value"))) for m in (champion, challenger)}
    wide = (report.groupBy("slice_kind", "slice_value", "metric")
            .agg(pick[champion].alias("champion"), pick[challenger].alias("challenger")))
    kind, metric = F.col("slice_kind"), F.col("metric")
    old, new = F.col("champion"), F.col("challenger")
    base = F.greatest(old, F.lit(1e-9))
    gain, loss = (old - new) / base, (new - old) / base
    low, high = calib

    def check(gate, figure, threshold, passed):
        return F.struct(F.lit(gate).alias("gate"), figure.alias("figure"),
                        F.lit(float(threshold)).alias("threshold"),
                        F.coalesce(passed, F.lit(False)).alias("passed"))

    checks = (F.when((kind == "global") & (metric == "mape"),
                     check("global_improvement", gain, improve, gain >= improve))
              .when((kind != "global") & (metric == "mape") & old.isNotNull() & new.isNotNull(),
                    check("slice_regression", loss, regress, loss <= regress))
              .when((kind == "global") & (metric == "calibration_ratio"),
                    check("calibration", new, high, new.between(low, high))))
    rows = wide.select("slice_kind", "slice_value", "champion", "challenger",
                       checks.alias("c")).filter(F.col("c").isNotNull())
    if latency is not None:
        pair = latency.agg(*[F.max(F.when(F.col(model) == m, F.col("p95"))).alias(a)
                             for m, a in ((champion, "champion"), (challenger, "challenger"))])
        rows = rows.unionByName(pair.select(
            F.lit("global").alias("slice_kind"), F.lit("all").alias("slice_value"),
            "champion", "challenger",
            check("latency_p95", new - old, p95_ms, new - old <= p95_ms).alias("c")))
    if importance is not None:
        found = importance.agg(F.count(F.lit(1)).cast("double").alias("challenger"))
        rows = rows.unionByName(found.select(
            F.lit("global").alias("slice_kind"), F.lit("all").alias("slice_value"),
            F.lit(None).cast("double").alias("champion"), "challenger",
            check("explainability", new, 1, new >= 1).alias("c")))
    return rows.select("c.gate", "slice_kind", "slice_value", "champion", "challenger",
                       "c.figure", "c.threshold", "c.passed")


def promote(gates: DataFrame) -> DataFrame:
    """One row: promote only when every check passed and there was at least one."""
    return gates.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("promote"),
                     F.count_if(~F.col("passed")).alias("failed"),
                     F.count(F.lit(1)).alias("checks"))
