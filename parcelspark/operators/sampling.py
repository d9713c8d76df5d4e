"""Stratified samples, time splits, rolling-origin folds and audit samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions.hashing import digest, uniform
from parcelspark.functions.scalars import size_band
from parcelspark.operators.skew import lowest_share
from parcelspark.session import stage

# Strata and columns that must be known.
STRATA = ["region_code", "property_type", "sale_year"]
REQUIRED = ["sale_price", "size_sqm"]


def recent_known(df: DataFrame, date_col: str, as_of: str, years: int = 5,
                 required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows of the last ``years`` years before ``as_of`` with the required columns known."""
    start = F.add_months(F.to_date(F.lit(as_of)), -12 * years)
    return df.filter(F.col(date_col) >= start).dropna(subset=list(required))


def stratified_sample(df: DataFrame, as_of: str, key_cols: Sequence[str],
                      date_col: str = "sale_date", strata: Sequence[str] = STRATA,
                      years: int = 5, fraction: float = 0.10, seed: str = "42") -> DataFrame:
    """``ceil(fraction * n)`` rows of each stratum in the order of a keyed digest, so that the same
    seed gives the same sample. Adds ``size_band``; ``sale_year`` is derived from the date."""
    rows = recent_known(df, date_col, as_of, years).withColumns({
        "sale_year": F.year(date_col), "size_band": size_band(F.col("size_sqm"))})
    return lowest_share(rows, strata, fraction, digest(seed, *key_cols))


def _nth_last_month(df: DataFrame, month_col: str, n: int) -> DataFrame:
    """One row: the n-th month from the end, and a clear error when there are fewer months."""
    last = df.select(month_col).distinct().orderBy(F.desc(month_col)).limit(n)
    enough = F.count(month_col) >= n
    return last.agg(F.when(enough, F.min(month_col)).otherwise(F.raise_error(F.concat(
        F.lit(f"need {n} distinct months, found "), F.count(month_col).cast("string"))))
        .alias("cutoff"))


def time_split(df: DataFrame, month_col: str = "sale_month",
               holdout_months: int = 6) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): the holdout is the last ``holdout_months`` distinct months.

    The cutoff is a scalar subquery, so it also prunes partitions by month. Fewer months than asked
    raise a ValueError. The distinct months are found in one pass over the month column; rows
    without a month are in neither part.
    """
    months = stage(df.select(month_col).filter(F.col(month_col).isNotNull()).distinct(), "months")
    found = months.count()
    if found < holdout_months:
        raise ValueError(f"need {holdout_months} distinct months, found {found}")
    cutoff = _nth_last_month(months, month_col, holdout_months).scalar()
    return df.filter(F.col(month_col) < cutoff), df.filter(F.col(month_col) >= cutoff)


def rolling_origin_folds(df: DataFrame, month_col: str = "sale_month", folds: int = 5,
                         horizon: int = 6) -> DataFrame:
    """Expanding-window folds: adds ``fold`` (1..folds) and ``role`` (train or test).

    The last ``folds * horizon`` distinct months form the test blocks; fold i trains on every month
    before its block.
    """
    months = df.select(month_col).distinct().dropna()
    # One row per distinct month, a few hundred at most.
    numbered = months.select(
        month_col, F.row_number().over(Window.partitionBy(F.lit(True)).orderBy(F.desc(month_col)))
        .alias("_back"))
    block = F.lit(folds) - F.floor((F.col("_back") - 1) / F.lit(horizon))
    roles = F.transform(F.sequence(F.lit(1), F.lit(folds)), lambda f: F.struct(
        f.alias("fold"), F.when(block == f, "test").when(block < f, "train").alias("role")))
    plan = (numbered.select(month_col, F.inline(roles)).filter(F.col("role").isNotNull()))
    return df.join(F.broadcast(plan), month_col)


def audit_sample(df: DataFrame, key: str, month_col: str, fraction: float = 0.01,
                 seed: str = "42") -> DataFrame:
    """About ``fraction`` of each month's rows, chosen by a keyed digest without a shuffle."""
    return df.filter(uniform(digest(seed, month_col, key)) < fraction)
