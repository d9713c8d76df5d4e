"""Latency profiles: mergeable quantile sketches that are stored, rolled up and compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.monitor import PSI_ALERT

#: Size of a sketch: ranks are right to about 1.65 % at 200.
SKETCH_K = 200
#: Equal steps at which a current profile is read for its shares.
GRID = 400


def profile(log: DataFrame, by: Sequence[str] = ("served_by",), ts: str = "ts",
            value: str = "latency_ms", is_error: str = "is_error", slot: str = "minute",
            k: int = SKETCH_K) -> DataFrame:
    """``(by, slot, requests, errors, measured, sketch)``: one row for each group and time slot.

    The sketch holds the values that aren't null or NaN, in bounded space; partial sketches are built
    before the shuffle, so a busy deployment doesn't fill one task. ``measured`` counts its values.
    """
    v = F.col(value).cast("double")
    sound = F.when(~F.isnan(v), v)
    return log.groupBy(*by, F.date_trunc(slot, ts).alias("slot")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.col(is_error).cast("long")).alias("errors"),
        F.count(sound).alias("measured"), F.kll_sketch_agg_double(sound, k).alias("sketch"))


def roll_up(profiles: DataFrame, slot: str, by: Sequence[str] = ("served_by",),
            k: int = SKETCH_K) -> DataFrame:
    """Profiles of longer slots from stored ones; no raw row is read again."""
    return profiles.groupBy(*by, F.date_trunc(slot, "slot").alias("slot")).agg(
        F.sum("requests").alias("requests"), F.sum("errors").alias("errors"),
        F.sum("measured").alias("measured"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantile(q: float, sketch: str = "sketch", measured: str = "measured") -> Column:
    """A quantile of a profile; null if nothing was measured."""
    return F.when(F.col(measured) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(q))))


def health(profiles: DataFrame, by: Sequence[str] = ("served_by",)) -> DataFrame:
    """Requests, error rate and p50, p95, p99 of each profile."""
    return profiles.select(*by, "slot", "requests", (F.col("errors") / F.col("requests"))
                           .alias("error_rate"), quantile(0.5).alias("p50"),
                           quantile(0.95).alias("p95"), quantile(0.99).alias("p99"))


def profile_drift(base: DataFrame, current: DataFrame, by: Sequence[str] = ("served_by",),
                  bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """Population stability index between stored profiles: ``(by, slot, psi, alert)``.

    ``base`` has one profile for each group. Bins are the baseline's quantiles; the current shares
    are differences of ranks in the current sketch. Groups without a baseline, and profiles without
    values, have a null index.
    """
    edges = F.array(*[quantile(i / bins) for i in range(1, bins)])
    known = base.select(*by, F.when(F.col("measured") > 0, edges).alias("_edges"))
    grid = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    read = F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_double("sketch", grid))
    met = current.withColumn("_grid", read).join(known, list(by), "left")
    some = F.col("_edges").isNotNull() & F.col("_grid").isNotNull()

    def rank(i: int) -> Column:
        if i in (0, bins):
            return F.lit(float(i > 0))
        return F.size(F.filter("_grid", lambda v: v <= F.col("_edges")[i - 1])) / F.lit(float(GRID))

    expected = F.lit(1.0 / bins)
    total = F.lit(0.0)
    for i in range(bins):
        share = F.greatest(rank(i + 1) - rank(i), F.lit(floor))
        total = total + (share - expected) * F.log(share / expected)
    return met.select(*by, "slot", F.when(some, total).alias("psi")).withColumn(
        "alert", F.col("psi") > PSI_ALERT)
