"""Landing scans, ingest stamps, reconciliation, retention and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schema of the anonymized valuations at rest.
BRONZE_SCHEMA = T.StructType([
    T.StructField("property_hash", T.StringType()), T.StructField("geo_h3_r8", T.StringType()),
    T.StructField("postcode_prefix", T.StringType()),
    T.StructField("property_type", T.StringType()), T.StructField("size_band", T.StringType()),
    T.StructField("size_sqm", T.DoubleType()), T.StructField("rooms", T.IntegerType()),
    T.StructField("bathrooms", T.IntegerType()), T.StructField("year_built", T.IntegerType()),
    T.StructField("sale_price", T.DoubleType()), T.StructField("sale_month", T.StringType()),
])


def read_landing(spark: SparkSession, path: str | Sequence[str],
                 schema: T.StructType | None = BRONZE_SCHEMA) -> DataFrame:
    """Parquet landing folder with its partition columns, such as ``sale_month=2021-01/``.

    A declared schema saves the scan that infers one and keeps the month a string.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def stamp_ingest(df: DataFrame) -> DataFrame:
    """Add ``ingested_at`` and ``source_file``."""
    return df.withColumns({"ingested_at": F.current_timestamp(),
                           "source_file": F.col("_metadata.file_path")})


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Photo manifest, CSV or Parquet by its suffix; all columns are strings."""
    if path.lower().endswith(".csv"):
        names = ["property_hash", "photo_url", "photo_hash"]
        with_header = spark.read.option("header", True).csv(path)
        missing = [c for c in names if c not in with_header.columns]
        if missing:
            raise ValueError(f"manifest lacks {missing}")
        return with_header
    return spark.read.parquet(path)


def row_hash(cols: Sequence[str]) -> Column:
    """Hash of a row as a wide decimal.

    Null flags are hashed with the values: a hash alone passes over nulls, so that a value which
    moved to another column would not show.
    """
    flags = [F.col(c).isNull() for c in cols]
    return F.xxhash64(*flags, *cols).cast("decimal(38,0)")


def checksum(df: DataFrame, cols: Sequence[str]) -> Column:
    """Order-insensitive checksum: sum of row hashes."""
    return F.sum(row_hash(cols))


def reconcile(src: DataFrame, dst: DataFrame, by: Sequence[str],
              totals: Sequence[str] = ()) -> DataFrame:
    """Compare source and landed rows per partition: counts, sums of ``totals``, checksum, match.

    Nothing matches when a column was lost, added or has another type; a null partition is compared
    like any other. Both sides are reduced with partial sums before they meet.
    """
    by = list(by)
    cols = sorted(set(src.columns) & set(dst.columns))
    alike = dict(src.dtypes) == dict(dst.dtypes)

    def side(df, name):
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias(f"{name}_rows"), checksum(df, cols).alias(f"{name}_checksum"),
            *[F.sum(t).alias(f"{name}_{t}") for t in totals])

    left = side(src, "src")
    right = side(dst, "dst").withColumnsRenamed({c: f"_dst_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_dst_{c}"))
    joined = left.join(right, on, "full").withColumns(
        {c: F.coalesce(c, f"_dst_{c}") for c in by}).drop(*[f"_dst_{c}" for c in by])
    same = (F.col("src_rows").eqNullSafe(F.col("dst_rows"))
            & F.col("src_checksum").eqNullSafe(F.col("dst_checksum")))
    return joined.withColumn("matches", same & F.lit(alike))


def retention_tier(df: DataFrame, ts: str, as_of: str, hot_months: int = 12,
                   cold_months: int = 84) -> DataFrame:
    """Add ``tier``: hot up to a year, cold up to seven, expired beyond."""
    day = F.to_date(F.lit(as_of))
    tier = (F.when(F.col(ts) >= F.add_months(day, -hot_months), "hot")
            .when(F.col(ts) >= F.add_months(day, -cold_months), "cold").otherwise("expired"))
    return df.withColumn("tier", F.when(F.col(ts).isNotNull(), tier))
