"""Monitoring: feedback join, quality, latency, drift and health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions.scalars import abs_pct_error
from parcelspark.operators.quantiles import exact_percentiles, keyed_percentiles, running_counts
from parcelspark.operators.skew import HOT_ROWS, forward_fill, lookup_join
from parcelspark.session import stage

# Alert thresholds.
PSI_ALERT = 0.2
KS_ALERT_P = 0.01
DRIFT_ROLLBACK = 0.3
QUALITY_TOLERANCE = 0.05
ERROR_RATE_MAX = 0.01
P95_RATIO_MAX = 2.0


def join_actuals(preds: DataFrame, actuals: DataFrame, key: str, pred_ts: str, act_ts: str,
                 values: Sequence[str], part_rows: int = HOT_ROWS) -> DataFrame:
    """Each actual with the latest prediction of its key at or before it.

    Both sides are sorted together by key and time in parts of about ``part_rows`` rows, cut at their
    quantiles, and each part hands on its last prediction; so neither a key with very many rows nor
    one hour of it is sorted in one task. Among predictions of equal time the largest values win.
    """
    names = [c for c in actuals.columns if c != key]
    last = F.struct(F.col(pred_ts).alias("pred_ts"), *values)
    left = preds.filter(F.col(key).isNotNull() & F.col(pred_ts).isNotNull()).select(
        key, F.col(pred_ts).alias("_ts"), F.lit(0).alias("_side"), last.alias("_tie"),
        last.alias("_pred"))
    # An actual without a time has no prediction before it.
    timed = F.col(key).isNotNull() & F.col(act_ts).isNotNull()
    right = actuals.filter(timed).select(
        key, F.col(act_ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*names).alias("_act"))
    both = left.unionByName(right, allowMissingColumns=True)
    filled = forward_fill(both, [key], ["_ts", "_side", "_tie"], "_pred", part_rows)
    out = filled.filter(F.col("_side") == 1).select(
        key, *[F.col("_act")[c].alias(c) for c in names],
        *[F.col("_pred")[c].alias(c) for c in ("pred_ts", *values)])
    return out.unionByName(actuals.filter(~timed), allowMissingColumns=True)


def quality_monitor(joined: DataFrame, champion_mape: float, ts: str, y: str = "sale_price",
                    pred: str = "price", tol: float = QUALITY_TOLERANCE) -> DataFrame:
    """MAPE of labelled feedback per week, with an alert above the champion's MAPE plus ``tol``."""
    mape = F.avg(abs_pct_error(F.col(y), F.col(pred)))
    return (joined.filter(F.col(pred).isNotNull())
            .groupBy(F.to_date(F.date_trunc("week", ts)).alias("week"))
            .agg(F.count(F.lit(1)).alias("n"), mape.alias("mape"))
            .withColumn("alert", F.col("mape") > champion_mape + tol))


def ab_latency(log: DataFrame, by: Sequence[str] = ("served_by",), latency: str = "latency_ms",
               is_error: str = "is_error") -> DataFrame:
    """Requests, error rate and latency p50, p95, p99 per deployment."""
    rates = log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"),
                                 F.avg(F.col(is_error).cast("double")).alias("error_rate"))
    marks = exact_percentiles(log, latency, [0.5, 0.95, 0.99], by)
    return lookup_join(rates, stage(marks.select(
        *by, *[F.col("p")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))]), "latency"),
        by)


def _index(counts: DataFrame, floor: float = 1e-6) -> DataFrame:
    """PSI per feature from (feature, bin, base, cur) counts."""
    totals = counts.groupBy("feature").agg(F.sum("base").alias("_base"),
                                           F.sum("cur").alias("_cur"))
    # One row per feature name of the caller.
    shares = counts.join(F.broadcast(totals), "feature")
    e, a = (F.greatest(F.try_divide(c, "_" + c), F.lit(floor)) for c in ("base", "cur"))
    return (shares.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
            .withColumn("alert", F.col("psi") > PSI_ALERT))


def _both(base: DataFrame, cur: DataFrame, pairs) -> DataFrame:
    sides = [df.select(F.lit(name).alias("_side"), F.inline(pairs))
             for name, df in (("base", base), ("cur", cur))]
    return sides[0].unionByName(sides[1])


def psi(base: DataFrame, cur: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index of numeric features; bins are the baseline's percentiles and a
    null has its own bin."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v"))
                      for f in features])
    # Both sides are read once, into one narrow table.
    rows = stage(_both(base, cur, pairs), "values")
    # One row per name in `features`.
    edges = exact_percentiles(rows.filter(F.col("_side") == "base"), "v",
                              [i / bins for i in range(1, bins)], ["feature"],
                              bounded_groups=True).select("feature", F.col("p").alias("_edges"))
    below = sum(((F.col("_edges")[i] < F.col("v")).cast("int") for i in range(bins - 1)),
                F.lit(0))
    binned = (rows.join(F.broadcast(edges), "feature")
              .withColumn("bin", F.coalesce(below, F.lit(-1))))
    return _index(binned.groupBy("feature", "bin").agg(
        F.count_if(F.col("_side") == "base").alias("base"),
        F.count_if(F.col("_side") == "cur").alias("cur")))


def psi_categorical(base: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """Population stability index of categorical features over the union of their values."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("bin"))
                      for f in features])
    counts = _both(base, cur, pairs).groupBy("feature", "bin").agg(
        F.count_if(F.col("_side") == "base").alias("base"),
        F.count_if(F.col("_side") == "cur").alias("cur"))
    return _index(counts)


def ks_two_sample(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test: one row with n1, n2, d, p, alert and rollback.

    Both samples are counted by value, then the running counts are taken slot by slot.
    """
    def side(df, mine):
        return df.filter(F.col(col).isNotNull()).select(
            F.col(col).cast("double").alias("v"), F.lit(mine).alias("a"),
            F.lit(1 - mine).alias("b"))

    counts = stage(side(a, 1).unionByName(side(b, 0)).groupBy("v")
                   .agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "counts")
    totals = counts.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b")).alias("t"))
    run = running_counts(counts, "v", ["a", "b"]).withColumn("_t", totals.scalar())
    gap = F.abs(F.try_divide(F.col("run_a"), F.col("_t.a"))
                - F.try_divide(F.col("run_b"), F.col("_t.b")))
    found = run.agg(F.max(F.col("_t.a")).alias("n1"), F.max(F.col("_t.b")).alias("n2"),
                    F.max(gap).alias("d"))
    root = F.sqrt(F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2")))
    lam = (root + 0.12 + 0.11 / root) * F.col("d")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * j * j * lam * lam))
    # The series does not converge near zero, where the probability is one.
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(
        F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))
    return (found.withColumn("p", p)
            .withColumn("alert", F.col("p") < KS_ALERT_P)
            .withColumn("rollback", F.col("d") > DRIFT_ROLLBACK))


def health_windows(log: DataFrame, window: str = "1 minute", by: str = "served_by",
                   ts: str = "ts", latency: str = "latency_ms", is_error: str = "is_error",
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Requests, error rate and exact p95 per deployment and tumbling window."""
    slotted = log.withColumn("window_start", F.window(ts, window)["start"])
    keys = [by, "window_start"]
    out = keyed_percentiles(
        slotted, keys, {"p95": (latency, [0.95])},
        {"requests": F.count(F.lit(1)), "error_rate": F.avg(F.col(is_error).cast("double"))},
        hot_rows)
    return out.select(*keys, "requests", "error_rate", F.col("p95")[0].alias("p95"))


def sustained(windows: DataFrame, metric: str, above: float, periods: int, window_seconds: int,
              by: str = "served_by", start: str = "window_start") -> DataFrame:
    """Windows at which ``metric`` has been above the limit for ``periods`` windows without a gap.

    The input has one row per deployment and window.
    """
    run = Window.partitionBy(by).orderBy(start).rowsBetween(-(periods - 1), 0)
    seconds = F.unix_timestamp(start)
    span = seconds - F.min(seconds).over(run)
    hit = ((F.min(metric).over(run) > above) & (F.count(F.lit(1)).over(run) == periods)
           & (span == (periods - 1) * window_seconds))
    return windows.withColumn("_hit", hit).filter("_hit").select(by, start, metric)


def rollback_triggers(windows: DataFrame, baseline_p95: float, window_seconds: int = 60,
                      err: float = ERROR_RATE_MAX, err_for: int = 5,
                      p95_ratio: float = P95_RATIO_MAX, p95_for: int = 10) -> DataFrame:
    """Rollback triggers from health windows: (served_by, window_start, reason)."""
    slow = windows.withColumn("ratio", F.col("p95") / baseline_p95)
    errors = sustained(windows, "error_rate", err, err_for, window_seconds)
    latency = sustained(slow, "ratio", p95_ratio, p95_for, window_seconds)
    return (errors.select("served_by", "window_start", F.lit("error_rate").alias("reason"))
            .unionByName(latency.select("served_by", "window_start",
                                        F.lit("latency_p95").alias("reason"))))
