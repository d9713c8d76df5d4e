"""Views of the given tables in the shapes of the data model.

Column formulas are SQL text that Spark and the check database read alike. A view joins only the
tables its requested columns need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.functions.geo import hex_cell
from parcelspark.functions.hashing import pseudonym
from parcelspark.functions.scalars import month_text, prefix, size_band

SALT = "0123456789abcdef0123456789abcdef"
AS_OF = "2001-12-01"

# column: (tables beyond lineitem, formula)
VALUATION_COLUMNS = {
    "property_id": ("", "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
                        "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING))"),
    "owner_name": ("oc", "c_name"),
    "owner_id": ("oc", "CAST(c_custkey AS STRING)"),
    "account_number": ("o", "CAST(o_orderkey AS STRING)"),
    "street_address": ("oc", "concat_ws(' ', c_mktsegment, CAST(c_custkey AS STRING))"),
    "postcode": ("oc", "lpad(CAST(c_custkey AS STRING), 5, '0')"),
    "latitude": ("ocnr", "CAST(30 + 5 * r_regionkey AS DOUBLE)"),
    "longitude": ("ocnr", "CAST(10 * r_regionkey AS DOUBLE)"),
    "home_latitude": ("oc", "42 + CAST(c_custkey % 811 AS DOUBLE) / CAST(100 AS DOUBLE)"),
    "home_longitude": ("oc", "-5 + CAST(c_custkey % 997 AS DOUBLE) / CAST(50 AS DOUBLE)"),
    "property_type": ("p", "p_type"),
    "size_sqm": ("", "l_quantity * 5"),
    "rooms": ("p", "CAST(1 + p_size % 8 AS INT)"),
    "bathrooms": ("p", "CAST(1 + p_size % 4 AS INT)"),
    "year_built": ("", "CAST(1900 + l_partkey % 124 AS INT)"),
    "sale_date": ("", "CAST(l_shipdate AS DATE)"),
    "sale_price": ("", "l_extendedprice"),
    "region_code": ("ocnr", "r_name"),
    "champion_pred": ("", "l_extendedprice * (CAST(0.85 AS DOUBLE) + CAST(0.3 AS DOUBLE) * "
                          "CAST((l_orderkey * 7 + l_partkey) % 101 AS DOUBLE) / "
                          "CAST(100 AS DOUBLE))"),
    "challenger_pred": ("", "l_extendedprice * (CAST(0.9 AS DOUBLE) + CAST(0.2 AS DOUBLE) * "
                            "CAST((l_orderkey * 11 + l_partkey) % 101 AS DOUBLE) / "
                            "CAST(100 AS DOUBLE))"),
}
# A price that depends on its features, and the same with noise of up to a fifth.
_SIGNAL = ("exp(CAST(8.2 AS DOUBLE) + CAST(0.85 AS DOUBLE) * ln(1 + l_quantity * 5)"
           " + CAST(0.06 AS DOUBLE) * (1 + p_size % 8) + CAST(0.04 AS DOUBLE) * (1 + p_size % 4)"
           " + CAST(0.004 AS DOUBLE) * (l_partkey % 124) + CAST(0.15 AS DOUBLE) * r_regionkey")
_NOISE = ("CAST(0.4 AS DOUBLE) * (CAST((l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 31"
          " + l_linenumber * 15485863) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE)"
          " - CAST(0.5 AS DOUBLE))")
VALUATION_COLUMNS |= {"signal_mean": ("ocnrp", f"{_SIGNAL})"),
                      "signal_price": ("ocnrp", f"{_SIGNAL} + {_NOISE})")}
RAW = ["property_id", "owner_name", "owner_id", "account_number", "street_address", "postcode",
       "latitude", "longitude", "property_type", "size_sqm", "rooms", "bathrooms", "year_built",
       "sale_date", "sale_price", "region_code"]

_JOINS = {
    "o": ("orders", "l_orderkey = o_orderkey"), "c": ("customer", "o_custkey = c_custkey"),
    "n": ("nation", "c_nationkey = n_nationkey"), "r": ("region", "n_regionkey = r_regionkey"),
    "p": ("part", "l_partkey = p_partkey"),
}


# Tables that a small scale factor keeps in one row group, with the key to spread them by.
SPREAD_BY = {"lineitem": ["l_orderkey", "l_partkey"], "events": ["event_id"],
             "embeddings": ["vec_id"]}
# Schemas read once per table; each inference is a job of its own.
_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables.

    One row group is read by one task. When a scan has fewer splits than there are cores, its rows
    are spread over them; a large table has more splits and is read as it lies.
    """
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[path]).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if name in SPREAD_BY and df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores, *SPREAD_BY[name])
    return df


def valuations(spark: SparkSession, sf: str, cols: Sequence[str] = tuple(RAW)) -> DataFrame:
    needed = {t for c in cols for t in VALUATION_COLUMNS[c][0]}
    df = table(spark, sf, "lineitem")
    for letter, (name, on) in _JOINS.items():
        if letter in needed:
            df = df.join(table(spark, sf, name), F.expr(on))
    return df.selectExpr(*[f"{VALUATION_COLUMNS[c][1]} AS {c}" for c in cols])


def bronze(spark: SparkSession, sf: str, extra: Sequence[str] = ()) -> DataFrame:
    """Anonymized shape, with region centroids as coordinates so that cells are shared."""
    raw = valuations(spark, sf, ["property_id", "latitude", "longitude", "postcode", "sale_date",
                                 "property_type", "size_sqm", "rooms", "bathrooms", "year_built",
                                 "sale_price", *extra])
    return raw.select(
        pseudonym(F.col("property_id"), SALT).alias("property_hash"),
        hex_cell(F.col("latitude"), F.col("longitude")).alias("geo_h3_r8"),
        prefix(F.col("postcode")).alias("postcode_prefix"),
        month_text(F.col("sale_date")).alias("sale_month"), "property_type",
        size_band(F.col("size_sqm")).alias("size_band"), "size_sqm", "rooms", "bathrooms",
        "year_built", "sale_price", *extra)


# Public dimensions: formulas over the distinct keys; some keys are left out.
DIMENSIONS = {
    "public_osm_h3_features": ("geo_h3_r8", "length(geo_h3_r8) % 7 <> 0", {
        "dist_school": "CAST(length(geo_h3_r8) * 37 % 11 AS DOUBLE)",
        "dist_transit": "CAST(length(geo_h3_r8) * 53 % 13 AS DOUBLE)",
        "amenity_count_1km": "CAST(length(geo_h3_r8) * 17 % 29 AS INT)"}),
    "public_census_postcode": ("postcode_prefix", "CAST(postcode_prefix AS INT) % 5 <> 4", {
        "median_income": "CAST(20000 + CAST(postcode_prefix AS INT) * 137 % 9000 AS DOUBLE)",
        "unemployment_rate": "CAST(CAST(postcode_prefix AS INT) * 7 % 13 AS DOUBLE)",
        "pop_density": "CAST(CAST(postcode_prefix AS INT) * 31 % 997 AS DOUBLE)"}),
    "public_macro_indicators": ("sale_month", "substring(sale_month, 6, 2) <> '07'", {
        "mortgage_rate": "CAST(CAST(substring(sale_month, 1, 4) AS INT) % 7 AS DOUBLE)",
        "cpi": "CAST(100 + CAST(substring(sale_month, 6, 2) AS INT) AS DOUBLE)",
        "regional_gdp_growth": "CAST(CAST(substring(sale_month, 6, 2) AS INT) % 5 AS DOUBLE)"}),
    "public_hazard_layers": ("geo_h3_r8", "length(geo_h3_r8) % 2 = 0", {
        "flood_zone": "concat('F', CAST(length(geo_h3_r8) % 3 AS STRING))",
        "seismic_zone": "concat('S', CAST(length(geo_h3_r8) % 4 AS STRING))"}),
}


def dimension(facts: DataFrame, name: str) -> DataFrame:
    key, keep, values = DIMENSIONS[name]
    return (facts.select(key).distinct().filter(keep)
            .selectExpr(key, *[f"{v} AS {c}" for c, v in values.items()]))


# Photo scores from events: property = user, photo = event.
PHOTO_COLUMNS = {
    "property_hash": "CAST(user_id AS STRING)",
    "photo_hash": "CAST(event_id AS STRING)",
    "exterior_condition": "CAST(event_id * 13 % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "roof_condition": "CAST(event_id * 29 % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "curb_appeal": "CAST(event_id * 47 % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "renovation_recency": "CAST(event_id * 61 % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "confidence": "CAST(event_id * 83 % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
}
PHOTO_VALID = "event_id % 20 <> 0 AND event_id % 50 <> 7"
CACHE_UNTIL = "2024-01-20"


def photo_scores(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    return (table(spark, sf, "events").filter(PHOTO_VALID)
            .selectExpr(*[f"{v} AS {c}" for c, v in PHOTO_COLUMNS.items()], *extra))


def photo_json(spark: SparkSession, sf: str) -> DataFrame:
    """Score texts; one in 20 lacks a key and one in 50 is cut off."""
    defects = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("cracks"))).otherwise(
        F.array().cast("array<string>"))
    rows = table(spark, sf, "events").selectExpr(
        "event_id", *[f"{v} AS {c}" for c, v in PHOTO_COLUMNS.items()]).withColumn(
        "visible_defects", defects)
    keys = ["exterior_condition", "roof_condition", "curb_appeal", "renovation_recency",
            "visible_defects", "confidence"]
    short = F.to_json(F.struct(*keys[:-1]))
    full = F.to_json(F.struct(*keys))
    text = (F.when(F.col("event_id") % 20 == 0, short)
            .when(F.col("event_id") % 50 == 7, F.substring(full, 1, 40)).otherwise(full))
    return rows.select("property_hash", "photo_hash", text.alias("score_json"))


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction log from events."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("property_hash"),
        F.when(F.col("user_id") % 2 == 0, "blue").otherwise("green").alias("served_by"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("latency_ms"),
        (F.col("event_type") == "error").cast("int").alias("is_error"), "event_type")


def feedback(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(predictions, actuals) from view and purchase events."""
    log = request_log(spark, sf)
    preds = log.filter(F.col("event_type") == "view").select(
        "property_hash", F.col("ts").alias("pred_ts"), F.col("latency_ms").alias("price"))
    actuals = log.filter(F.col("event_type") == "purchase").select(
        F.col("request_id").alias("sale_id"), "property_hash", F.col("ts").alias("sale_ts"),
        F.col("latency_ms").alias("sale_price"))
    return preds, actuals
