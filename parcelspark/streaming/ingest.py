"""File streams: landing to bronze, and the collected prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelspark.sources.landing import BRONZE_SCHEMA, stamp_ingest


# Tasks that may write one folder in one batch.
WRITERS = 8


def _sink(df: DataFrame, dst: str, checkpoint: str, partition_by: list[str],
          once: bool) -> StreamingQuery:
    # Rows of a folder meet in few tasks, so a batch leaves few files; the salt, from the rows
    # themselves, keeps a large folder from filling one task.
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    df = df.repartition(*partition_by, F.pmod(F.xxhash64(*plain), F.lit(WRITERS)))
    writer = (df.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
              .option("path", dst).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_bronze(spark: SparkSession, src: str, dst: str, checkpoint: str,
                  schema: T.StructType = BRONZE_SCHEMA, once: bool = True,
                  max_files: int | None = None) -> StreamingQuery:
    """Load landed files exactly once, stamp them and write them by month.

    ``once`` stops when everything that has landed is loaded; otherwise the query keeps running.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _sink(stamp_ingest(reader.parquet(src)), dst, checkpoint, ["sale_month"], once)


def collect_predictions(stream: DataFrame, dst: str, checkpoint: str, ts: str = "ts",
                        once: bool = True) -> StreamingQuery:
    """Write model inputs and outputs into a folder per hour."""
    rolled = stream.withColumn("hour", F.date_format(ts, "yyyy-MM-dd-HH"))
    return _sink(rolled, dst, checkpoint, ["hour"], once)
