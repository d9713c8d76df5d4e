"""Streams over small files, with late and duplicate rows."""

import pytest
from pyspark.sql import functions as F

from parcelspark.session import scratch_path
from parcelspark.sources import tables
from parcelspark.streaming import health, ingest

SCHEMA = "request_id int, served_by string, ts timestamp, latency_ms double, is_error int"


def land(spark, path, rows):
    """One file of requests; time is given in seconds."""
    df = spark.createDataFrame(rows, "request_id int, served_by string, s long, "
                                     "latency_ms double, is_error int")
    (df.select("request_id", "served_by", F.timestamp_seconds("s").alias("ts"), "latency_ms",
               "is_error").coalesce(1).write.mode("append").parquet(path))


def run(df, path):
    q = (df.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", path + "-log").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


@pytest.fixture
def src(spark):
    return scratch_path(spark, "requests")


def test_bronze_loads_each_file_once(spark):
    src, dst = scratch_path(spark, "land"), scratch_path(spark, "bronze")
    schema = "id int, sale_month string"
    rows = spark.createDataFrame([(1, "2021-01"), (2, "2021-02")], schema)
    tables.write_table(rows, src)
    from pyspark.sql import types as T
    for expected in (2, 3):
        ingest.stream_bronze(spark, src, dst, dst + "-log",
                             T.StructType.fromDDL(schema)).awaitTermination()
        assert spark.read.parquet(dst).count() == expected
        tables.write_table(spark.createDataFrame([(3, "2021-03")], schema), src, mode="append")


def test_duplicates_are_dropped(spark, src):
    land(spark, src, [(i, "blue", 60 + i, 1.0, 0) for i in range(10)])
    land(spark, src, [(i, "blue", 61 + i, 1.0, 0) for i in range(5, 12)])
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    dst = scratch_path(spark, "dedup")
    run(health.dedup_requests(stream), dst)
    assert sorted(r[0] for r in spark.read.parquet(dst).select("request_id").collect()) == list(range(12))


def test_late_rows_are_dropped_and_counted(spark, src):
    land(spark, src, [(1, "blue", 600, 1.0, 0), (2, "blue", 6000, 1.0, 0)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    dst = scratch_path(spark, "late")
    windows = health.health_windows(stream, "1 minute", "2 minutes")
    run(windows, dst)
    before = spark.read.parquet(dst).count()
    land(spark, src, [(3, "blue", 601, 9.0, 1), (4, "blue", 12000, 1.0, 0)])
    q = run(windows, dst)
    assert health.late_rows(q) >= 1
    out = spark.read.parquet(dst)
    assert before == 1 and out.agg(F.sum("requests")).first()[0] == 2
    assert out.filter("p95 = 9").count() == 0


def test_rollback_after_five_bad_minutes(spark, src):
    rows = [(m, "green", 60 * m, 10.0, 1) for m in range(5)]
    rows += [(100 + m, "blue", 60 * m, 10.0, int(m != 2)) for m in range(5)]
    rows += [(900, "blue", 100_000, 1.0, 0)]
    land(spark, src, rows)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    dst = scratch_path(spark, "rollback")
    run(health.rollback_triggers(stream, baseline_p95=10.0), dst)
    got = [(r["served_by"], r["reason"], r["window_start"].minute)
           for r in spark.read.parquet(dst).collect()]
    assert got == [("green", "error_rate", 4)]


def test_collected_log_is_rolled_by_hour(spark, src):
    land(spark, src, [(1, "blue", 10, 1.0, 0), (2, "blue", 3700, 1.0, 0)])
    dst = scratch_path(spark, "collected")
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    ingest.collect_predictions(stream, dst, dst + "-log").awaitTermination()
    hours = {str(r["hour"]) for r in spark.read.parquet(dst).select("hour").collect()}
    assert hours == {"1970-01-01-00", "1970-01-01-01"}


def test_feedback_joins_each_pair_once(spark):
    a, b = scratch_path(spark, "preds"), scratch_path(spark, "sales")
    spark.sql("SELECT 1 AS property_hash, timestamp_seconds(3000) AS pred_ts, 5D AS price "
              "UNION ALL SELECT 1, timestamp_seconds(7100), 6D").write.parquet(a)
    spark.sql("SELECT 1 AS property_hash, timestamp_seconds(3700) AS sale_ts, 7D AS sale_price "
              "UNION ALL SELECT 1, timestamp_seconds(7200), 8D "
              "UNION ALL SELECT 2, timestamp_seconds(7200), 9D").write.parquet(b)
    preds = spark.readStream.schema("property_hash int, pred_ts timestamp, price double").parquet(a)
    sales = spark.readStream.schema("property_hash int, sale_ts timestamp, sale_price double").parquet(b)
    dst = scratch_path(spark, "feedback")
    run(health.stream_feedback(preds, sales), dst)
    got = sorted((r["price"], r["sale_price"]) for r in spark.read.parquet(dst).collect())
    assert got == [(5.0, 7.0), (6.0, 8.0)]
