"""Batch scoring: prediction to price, rounding and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.scalars import half_even
from parcelspark.operators.evaluate import MIN_SLICE_ROWS
from parcelspark.operators.features import vision_defaults
from parcelspark.operators.quantiles import exact_percentiles
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

# Placeholder band factors, and the largest prediction read as a logarithm.
BAND = (0.92, 1.08)
LOG_SPACE_MAX = 25.0


def to_price(df: DataFrame, prediction: str, target_transform: str) -> Column:
    """Price from a model output; "log1p", "none" or "auto", which takes outputs whose maximum is
    below 25 for logarithms."""
    pred = F.col(prediction)
    if target_transform == "log1p":
        return F.expm1(pred)
    if target_transform == "none":
        return pred
    if target_transform == "auto":
        finite = df.filter(pred.isNotNull() & ~F.isnan(pred))
        largest = finite.agg(F.max(prediction).alias("m")).scalar()
        return F.when(largest < LOG_SPACE_MAX, F.expm1(pred)).otherwise(pred)
    raise ValueError("target_transform must be 'log1p', 'none' or 'auto'")


def batch_score(df: DataFrame, model=None, target_transform: str = "log1p", round_to: float = 100,
                band: tuple[float, float] = BAND, version: str = "unknown",
                currency: str = "EUR", prediction: str = "prediction",
                keep: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Scoring response per row: price, band, currency, condition score and model version.

    Missing vision columns and nulls get neutral defaults before ``model.transform``; without a
    model the prediction column must be there already. ``digits`` rounds the raw price first, so
    that the last bits of an exponential cannot tip a half.
    """
    filled = vision_defaults(df)
    if model is not None:
        filled = model.transform(filled)
    price = to_price(filled, prediction, target_transform)
    if digits is not None:
        price = F.round(price, digits)
    named = filled.withColumn("_price", price)
    return named.select(
        *keep, half_even(F.col("_price"), round_to).alias("price"),
        half_even(F.col("_price") * band[0], round_to).alias("price_low_q10"),
        half_even(F.col("_price") * band[1], round_to).alias("price_high_q90"),
        F.lit(currency).alias("currency"), "condition_score",
        F.lit(version).alias("model_version"))


def conformal_bands(calibration: DataFrame, df: DataFrame, region: str, y: str = "sale_price",
                    pred: str = "pred", q: tuple[float, float] = (0.1, 0.9),
                    min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """Add the band ``price_low_q10``, ``price_high_q90``: the prediction times the percentiles of
    actual over predicted price of its region in the calibration rows.

    Regions of fewer than ``min_rows`` rows, and unknown ones, take the global percentiles.
    """
    ratio = F.try_divide(F.col(y), F.col(pred))
    regional = stage(exact_percentiles(calibration, ratio, q, [region])
                     .filter(F.col("n") >= min_rows)
                     .select(region, F.col("p").alias("_factors")), "bands")
    overall = exact_percentiles(calibration, ratio, q).select("p").scalar()
    factors = F.coalesce(F.col("_factors"), overall)
    return (lookup_join(df, regional, [region]).withColumn("_f", factors)
            .withColumns({"price_low_q10": F.col(pred) * F.col("_f")[0],
                          "price_high_q90": F.col(pred) * F.col("_f")[1]})
            .drop("_f", "_factors"))
