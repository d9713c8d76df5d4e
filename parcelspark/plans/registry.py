"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelspark.functions.geo import CELL_AREA_KM2, EARTH_RADIUS_KM
from parcelspark.plans.fixtures import DIMENSIONS, PHOTO_COLUMNS, PHOTO_VALID, SALT
from parcelspark.plans.fixtures import VALUATION_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def hex_sql(lat: str, lon: str) -> str:
    """The hexagon formula as SQL over two column names."""
    edge = math.sqrt(2 * CELL_AREA_KM2 / (3 * math.sqrt(3)))
    u = f"(radians({lon}) * {EARTH_RADIUS_KM / edge / math.sqrt(3)!r}::DOUBLE)"
    v = f"(sin(radians({lat})) * {EARTH_RADIUS_KM / edge!r}::DOUBLE)"
    stripe = f"floor({u} + {v} + 1)"
    column = f"floor((floor({u} * 2 + 1) + {stripe}) / 3)"
    row = f"floor(({stripe} + floor({v} - {u} + 1)) / 3)"
    return (f"CAST(CAST({column} - {row} AS BIGINT) AS VARCHAR) || '_' || "
            f"CAST(CAST({row} AS BIGINT) AS VARCHAR)")


BAND_SQL = ("CASE WHEN size_sqm < 40 THEN '<40' WHEN size_sqm < 100 THEN '40-100' "
            "WHEN size_sqm < 200 THEN '100-200' ELSE '200+' END")

V = ("v AS MATERIALIZED (SELECT "
     + ", ".join(f"{e} AS {c}" for c, (_, e) in VALUATION_COLUMNS.items())
     + ", l_orderkey, l_linenumber, l_partkey, l_suppkey"
     + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
       " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
       " JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)")

CENTRES = ("centres AS MATERIALIZED (SELECT latitude, longitude, "
           + hex_sql("latitude", "longitude")
           + " AS geo_h3_r8 FROM (SELECT DISTINCT latitude, longitude FROM v))")

# Anonymized shape; `b` follows `v`.
B = (V + ", " + CENTRES + f", b AS MATERIALIZED (SELECT substr(sha256('{SALT}' || property_id), 1, 16)"
     " AS property_hash, geo_h3_r8, substr(postcode, 1, 3) AS postcode_prefix,"
     " strftime(sale_date, '%Y-%m') AS sale_month, property_type,"
     f" {BAND_SQL} AS size_band, size_sqm, rooms, bathrooms, year_built, sale_price,"
     " champion_pred, challenger_pred, region_code, sale_date, signal_mean, signal_price"
     " FROM v JOIN centres USING (latitude, longitude))")

PHOTOS = ("photos AS (SELECT "
          + ", ".join(f"{e} AS {c}" for c, e in PHOTO_COLUMNS.items())
          + f", event_id, ts FROM events WHERE {PHOTO_VALID})")

LOG = ("log AS (SELECT event_id AS request_id, user_id AS property_hash,"
       " CASE WHEN user_id % 2 = 0 THEN 'blue' ELSE 'green' END AS served_by, ts,"
       " value AS latency_ms, CAST(event_type = 'error' AS INT) AS is_error, event_type"
       " FROM events)")


def dimension_sql(name: str, alias: str, facts: str) -> str:
    key, keep, values = DIMENSIONS[name]
    cols = ", ".join(f"{v} AS {c}" for c, v in values.items())
    return f"{alias} AS (SELECT {key}, {cols} FROM (SELECT DISTINCT {key} FROM {facts}) WHERE {keep})"


SILVER = (B + ", " + dimension_sql("public_osm_h3_features", "osm", "b")
          + ", " + dimension_sql("public_census_postcode", "cens", "b")
          + ", " + dimension_sql("public_macro_indicators", "mac", "b")
          + ", " + dimension_sql("public_hazard_layers", "haz", "b")
          + ", silver AS (SELECT * FROM b LEFT JOIN osm USING (geo_h3_r8)"
            " LEFT JOIN cens USING (postcode_prefix) LEFT JOIN mac USING (sale_month)"
            " LEFT JOIN haz USING (geo_h3_r8))")

# Vision features per property; `vision` follows `photos`.
VISION = (PHOTOS + ", vision AS (SELECT property_hash,"
          " CAST(count(*) FILTER (confidence >= 0.5) AS INT) AS photo_count,"
          " median(exterior_condition) FILTER (confidence >= 0.5) AS exterior_condition,"
          " median(roof_condition) FILTER (confidence >= 0.5) AS roof_condition,"
          " median(curb_appeal) FILTER (confidence >= 0.5) AS curb_appeal,"
          " median(renovation_recency) FILTER (confidence >= 0.5) AS renovation_recency"
          " FROM photos GROUP BY property_hash)")
