"""Model-ready features: derived columns, vision imputation and comparables by cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.functions.scalars import first_of, month_index
from parcelspark.operators.quantiles import exact_percentiles
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

# Neutral defaults of the vision features.
VISION_DEFAULTS = {"condition_score": 0.6, "roof_condition": 0.6, "curb_appeal": 0.6,
                   "renovation_flag": 0}


def vision_defaults(df: DataFrame) -> DataFrame:
    """Fill missing columns and nulls of the vision features with neutral values."""
    known = first_of(df, "has_vision_score", 0).cast("int")
    filled = {c: first_of(df, c, v) for c, v in VISION_DEFAULTS.items()}
    return df.withColumns(filled | {"has_vision_score": known})


def regional_vision(df: DataFrame, region: str = "postcode_prefix") -> DataFrame:
    """Replace null vision scores by the median of their region, then by the neutral value.

    The flag counts as renovated when the regional median says so.
    """
    scores = F.array(*[F.struct(F.lit(c).alias("score"), F.col(c).cast("double").alias("v"))
                       for c in VISION_DEFAULTS])
    medians = exact_percentiles(df.select(region, F.inline(scores)), "v", [0.5],
                                [region, "score"])
    wide = stage(medians.groupBy(region).agg(*[
        F.max(F.when(F.col("score") == c, F.col("p")[0])).alias(f"_{c}")
        for c in VISION_DEFAULTS]), "medians")
    out = lookup_join(df, wide, [region])
    fill = {}
    for c, neutral in VISION_DEFAULTS.items():
        regional = F.col(f"_{c}")
        if c == "renovation_flag":
            regional = F.when(regional.isNotNull(), (regional >= 0.5).cast("int"))
        fill[c] = F.coalesce(F.col(c), regional, F.lit(neutral))
    return out.withColumns(fill).drop(*[f"_{c}" for c in VISION_DEFAULTS])


def gold_features(silver: DataFrame, vision: DataFrame | None = None, as_of_year: int = 2026,
                  impute: str = "neutral", key: str = "property_hash",
                  region: str = "postcode_prefix") -> DataFrame:
    """Derived columns and vision features; the schema is the same with and without ``vision``.

    ``impute`` is "neutral" or "regional" (median of the region where one is known).
    """
    gold = silver
    if vision is not None:
        gold = lookup_join(gold, vision, [key])
    for c, neutral in VISION_DEFAULTS.items():
        if c not in gold.columns:
            gold = gold.withColumn(c, F.lit(None).cast("int" if neutral == 0 else "double"))
    gold = gold.withColumns({
        "log_size_sqm": F.log1p("size_sqm"),
        "age_years": F.lit(as_of_year) - F.col("year_built"),
        "has_vision_score": F.col("condition_score").isNotNull().cast("int"),
    })
    if impute == "regional":
        # Used by the medians and by the join that fills with them.
        gold = regional_vision(stage(gold, "gold"), region)
    elif impute != "neutral":
        raise ValueError("impute must be 'neutral' or 'regional'")
    return vision_defaults(gold)


def recent_comparables(df: DataFrame, cell: str = "geo_h3_r8", month: str = "sale_month",
                       price: str = "sale_price", size: str = "size_sqm",
                       months: int = 6) -> DataFrame:
    """Sales of the same cell in the ``months`` months before the row's month.

    Adds ``recent_sales_h3`` and ``price_per_sqm_h3``. Sales are summed per cell and month first, so
    a window holds at most one row per month, and no row sees its own month or a later one.
    """
    monthly = (df.groupBy(cell, month)
               .agg(F.count(F.lit(1)).alias("_n"), F.sum(price).alias("_price"),
                    F.sum(size).alias("_size"))
               .withColumn("_month", month_index(F.col(month))))
    past = Window.partitionBy(cell).orderBy("_month").rangeBetween(-months, -1)
    stats = stage(monthly.select(
        cell, month, F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("recent_sales_h3"),
        F.try_divide(F.sum("_price").over(past), F.sum("_size").over(past))
        .alias("price_per_sqm_h3")), "comparables")
    return lookup_join(df, stats, [cell, month])


def drop_non_features(df: DataFrame,
                      names: Sequence[str] = ("property_hash", "ingested_at", "source_file")
                      ) -> DataFrame:
    return df.drop(*names)
