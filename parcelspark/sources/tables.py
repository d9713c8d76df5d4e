"""Partitioned and clustered tables, versioned snapshots and optional tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.operators.skew import lookup_join, retry_stable_salt
from parcelspark.session import stage

_VERSION = re.compile(r"^\d{4}\.\d{2}\.\d{2}$")


def _is_path(target: str) -> bool:
    return "/" in target


def write_table(df: DataFrame, target: str, partition_by: Sequence[str] = ("sale_month",),
                mode: str = "overwrite") -> None:
    """Write Parquet to a path or a table name, by partition.

    The rebalance hint lets adaptive execution merge small partitions and split a large month over
    several tasks. With a path only the partitions in ``df`` are replaced.
    """
    shaped = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = shaped.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str],
                    files: int | None = None) -> None:
    """Write Parquet range-clustered on ``cluster_by``, so that file and row-group statistics let a
    scan skip what a filter on these columns excludes. Rows with equal values may go to several
    files, so that a frequent value does not fill one task."""
    tied = df.withColumn("_tie", retry_stable_salt(df, F.lit(1 << 20)))
    order = [*cluster_by, "_tie"]
    ranged = (tied.repartitionByRange(files, *order) if files
              else tied.repartitionByRange(*order))
    ranged.sortWithinPartitions(*cluster_by).drop("_tie").write.mode("overwrite").parquet(path)


def range_bounds(df: DataFrame, col: str, bits: int, rows: int = 8192) -> list:
    """At most ``2 ** bits - 1`` bounds that cut a column into ranges of about equal size.

    They come from a hashed sample of about ``rows`` rows, so what reaches the driver is bounded; they
    decide how rows lie, never which rows there are.
    """
    total = max(df.count(), 1)
    share = min(4 * rows / total, 1.0)
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if df.schema[c].dataType.typeName() != "map"]),
                  F.lit(1 << 30))
    drawn = (df.filter((salt < int(share * (1 << 30))) & F.col(col).isNotNull()).select(col)
             .limit(4 * rows))
    values = sorted(r[0] for r in drawn.collect())
    cuts = {values[i * len(values) >> bits] for i in range(1, 1 << bits)} if values else set()
    return sorted(cuts)


def curve_key(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on the space-filling curve over ``cols``: the bits of each column's range
    number, taken in turns. Nulls lie in the first range."""
    key = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        number = sum(((F.lit(b) <= F.col(c)).cast("long") for b in range_bounds(df, c, bits)),
                     F.lit(0).cast("long"))
        number = F.coalesce(number, F.lit(0).cast("long"))
        for bit in range(bits):
            place = bit * len(cols) + len(cols) - 1 - i
            key = key + F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), place)
    return key


def write_on_curve(df: DataFrame, path: str, cols: Sequence[str], files: int | None = None,
                   bits: int = 6) -> None:
    """Write Parquet along a space-filling curve over ``cols``.

    Every column's values lie close together in a file, not only the first one's, so statistics let a
    scan skip files and row groups for a filter on any of them.
    """
    tied = df.withColumns({"_key": curve_key(df, cols, bits),
                           "_tie": retry_stable_salt(df, F.lit(1 << 20))})
    ranged = (tied.repartitionByRange(files, "_key", "_tie") if files
              else tied.repartitionByRange("_key", "_tie"))
    (ranged.sortWithinPartitions("_key", *cols).drop("_key", "_tie").write.mode("overwrite")
     .parquet(path))


def binary_files(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """``(path, modificationTime, length, content)`` of the files under a folder, as listed by this call."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", names)
            .option("recursiveFileLookup", True).load(folder))


def file_sizes(spark: SparkSession, folder: str, names: str = "*.parquet",
               listed: DataFrame | None = None) -> DataFrame:
    """``(path, length)`` of the files under a folder; their content isn't read. ``listed`` is a listing of
    them by :func:`binary_files`, where there is one."""
    files = binary_files(spark, folder, names) if listed is None else listed
    return files.select("path", "length")


def compaction_jobs(files: DataFrame, target: int) -> DataFrame:
    """``(path, length, folder, job)``: files below ``target`` bytes, packed by folder.

    The files of a folder are lined up by size and cut wherever their sum passes a multiple of the
    target, so a job writes about one file of that size. Larger files, and a single small file of a
    folder, stay as they are.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    small = files.withColumn("folder", folder).filter(F.col("length") < target)
    line = Window.partitionBy("folder").orderBy("length", "path")
    before = F.sum("length").over(line) - F.col("length")
    return small.withColumns({"job": F.floor(before / target), "_n": F.count(F.lit(1)).over(
        Window.partitionBy("folder"))}).filter("_n > 1").drop("_n")


def compact(spark: SparkSession, base: str, target: int = 128 << 20, version: str = "latest",
            partition_by: Sequence[str] = ()) -> str:
    """Rewrite the small files of a published snapshot and publish the result under its version.

    Rows of a job move together into one file; rows of large files are copied as they lie. The
    manifest row is written last, so readers see the old files or the new ones, never both, and a
    compaction that dies halfway leaves the old snapshot in force. Returns the new folder.
    """
    name, old = _published(spark, base, version)
    jobs = stage(compaction_jobs(file_sizes(spark, old), target), "jobs")
    schema = spark.read.parquet(old).schema
    rows = spark.read.schema(schema).parquet(old).withColumn("_path", F.col("_metadata.file_path"))
    clean = F.regexp_replace("_path", "^[a-z]+:/*", "/")
    named = jobs.select(F.regexp_replace("path", "^[a-z]+:/*", "/").alias("_file"),
                        F.concat_ws("#", "folder", "job").alias("_job"))
    marked = lookup_join(rows.withColumn("_file", clean), named, ["_file"]).drop("_path", "_file")
    folder = f"{base.rstrip('/')}/data/{name}-{uuid.uuid4().hex}"

    def write(df: DataFrame) -> None:
        writer = df.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)

    count = jobs.select("folder", "job").distinct().count()
    write(marked.filter("_job IS NULL").drop("_job"))
    if count:
        number = jobs.select(F.concat_ws("#", "folder", "job").alias("_job")).distinct()
        numbered = number.withColumn("_to", F.row_number().over(Window.orderBy("_job")) - 1)
        small = lookup_join(marked.filter("_job IS NOT NULL"), stage(numbered, "numbers"), ["_job"],
                            "inner")
        write(small.repartitionByRange(count, "_to").drop("_job", "_to"))
    _announce(spark, base, name, folder)
    return folder


def _announce(spark: SparkSession, base: str, version: str, folder: str) -> None:
    row = spark.range(1).select(F.lit(version).alias("version"), F.lit(folder).alias("folder"),
                                F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/manifest")


def publish_snapshot(df: DataFrame, base: str, version: str) -> DataFrame:
    """Write ``df`` as snapshot ``YYYY.MM.DD`` and return it.

    The data goes to a fresh folder; the manifest row that makes it visible is written last, so a
    reader sees all of a snapshot or none of it.
    """
    if not _VERSION.match(version):
        raise ValueError("version must look like 2026.05.12")
    spark = df.sparkSession
    folder = f"{base.rstrip('/')}/data/{version}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _announce(spark, base, version, folder)
    return spark.read.schema(df.schema).parquet(folder)


def _published(spark: SparkSession, base: str, version: str) -> tuple[str, str]:
    """(version, folder) of a published version; the last publication of a version counts."""
    manifest = spark.read.parquet(f"{base.rstrip('/')}/manifest")
    if version != "latest":
        manifest = manifest.filter(F.col("version") == version)
    found = manifest.agg(F.max(F.struct("version", "published_at", "folder")).alias("m")).first()
    if found is None or found["m"] is None:
        raise ValueError(f"no snapshot {version} under {base}")
    return found["m"]["version"], found["m"]["folder"]


def snapshot_folder(spark: SparkSession, base: str, version: str = "latest") -> str:
    """Folder of a published version."""
    return _published(spark, base, version)[1]


def read_snapshot(spark: SparkSession, base: str, version: str = "latest") -> DataFrame:
    return spark.read.parquet(snapshot_folder(spark, base, version))


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None when it does not exist."""
    return spark.table(name) if spark.catalog.tableExists(name) else None
