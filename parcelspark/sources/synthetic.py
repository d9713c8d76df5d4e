"""Synthetic valuations for trials, drawn from keyed digests of a row id.

The same seed and id give the same row whatever the number of partitions or retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.functions.hashing import digest, normal, uniform
from parcelspark.functions.scalars import half_even, month_text, size_band

# Postcode prefix, cell and base price per square metre of each region.
REGIONS = [
    ("750", "881f1d4807fffff", 11000),
    ("130", "881e3624a7fffff", 4500),
    ("690", "881f3a44d7fffff", 5500),
    ("330", "881e64b2c7fffff", 4800),
    ("440", "881f01122ffffff", 4200),
    ("310", "881e6024effffff", 3900),
]
# Property types and their price factors.
TYPES = [("apartment", 1.0), ("house", 1.15), ("studio", 0.85), ("duplex", 1.25)]
FIRST_MONTH, MONTHS = "2021-01-01", 64


def _pick(u, table, field):
    """Entry of a small constant table by a uniform number."""
    return F.array(*[F.lit(row[field]) for row in table])[F.floor(u * len(table)).cast("int")]


def valuations_for(ids: DataFrame, id_col: str, seed: int = 42, as_of_year: int = 2026) -> DataFrame:
    """One synthetic sale, in the anonymized shape, for each row of ``ids``."""
    drawn = ids.select(
        F.substring(F.sha2(F.concat(F.lit("poc-"), F.col(id_col).cast("string")), 256), 1, 16)
        .alias("property_hash"),
        digest(f"{seed}a", id_col).alias("_a"), digest(f"{seed}b", id_col).alias("_b"))
    a, b = F.col("_a"), F.col("_b")

    def clip(x, low, high):
        return F.least(F.greatest(x, F.lit(low)), F.lit(high))

    month = F.add_months(F.to_date(F.lit(FIRST_MONTH)), F.floor(uniform(a, 3) * MONTHS).cast("int"))
    rows = drawn.withColumns({
        "geo_h3_r8": _pick(uniform(a, 0), REGIONS, 1),
        "postcode_prefix": _pick(uniform(a, 0), REGIONS, 0),
        "_base": _pick(uniform(a, 0), REGIONS, 2),
        "property_type": _pick(uniform(a, 1), TYPES, 0),
        "_factor": _pick(uniform(a, 1), TYPES, 1),
        "year_built": (F.lit(1900) + F.floor(uniform(a, 2) * 124)).cast("int"),
        "_date": month,
        "size_sqm": F.bround(clip(F.lit(75.0) + normal(a, 4) * 35, 18.0, 350.0), 0),
    })
    rows = rows.withColumn("rooms", clip(F.bround(
        F.col("size_sqm") / 22 + normal(a, 6) * 0.7, 0), 1.0, 8.0).cast("int"))
    age = F.lit(as_of_year) - F.col("year_built")
    price = (F.col("_base") * F.col("size_sqm") * F.col("_factor")
             * F.pow(F.lit(1.06), F.year("_date") - 2021)
             * clip(F.lit(1.0) - age * 0.002, 0.5, 1.0) * (F.lit(1.0) + normal(b, 2) * 0.18))
    return rows.withColumns({
        "sale_month": month_text(F.col("_date")),
        "bathrooms": clip(F.bround(F.col("rooms") / 2.5 + normal(b, 0) * 0.4, 0), 1.0, 4.0)
        .cast("int"),
        "size_band": size_band(F.col("size_sqm")),
        "sale_price": half_even(clip(price, 25_000.0, 5_000_000.0)),
    }).select("property_hash", "geo_h3_r8", "postcode_prefix", "sale_month", "property_type",
              "size_sqm", "rooms", "bathrooms", "year_built", "size_band", "sale_price")


def synthetic_valuations(spark: SparkSession, rows: int = 50_000, seed: int = 42) -> DataFrame:
    """``rows`` synthetic sales."""
    return valuations_for(spark.range(rows), "id", seed)
