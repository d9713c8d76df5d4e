"""Queries that run the streams to the end of the given tables and read what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.plans.fixtures import bronze, table
from parcelspark.plans.registry import B, query
from parcelspark.session import scratch_path
from parcelspark.sources import tables
from parcelspark.streaming import health, ingest


def _events(spark, sf):
    """The events table as a file stream, with a timestamp that can carry a watermark."""
    raw = (spark.readStream.schema(table(spark, sf, "events").schema)
           .option("pathGlobFilter", "events.parquet").parquet(sf))
    return raw.select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("property_hash"),
        F.when(F.col("user_id") % 2 == 0, "blue").otherwise("green").alias("served_by"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("latency_ms"),
        (F.col("event_type") == "error").cast("int").alias("is_error"), "event_type")


def _drain(df, label):
    """Run a stream over all available files into a Parquet sink and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    stream = (df.writeStream.format("parquet").outputMode("append").option("path", path)
              .option("checkpointLocation", path + "-log").trigger(availableNow=True).start())
    stream.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("stream_bronze", f"""WITH {B} SELECT sale_month, count(*) AS n,
  round(sum(sale_price), 2) AS total_price, true AS stamped FROM b GROUP BY sale_month""")
def stream_bronze(spark, sf):
    src, dst = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    tables.write_table(bronze(spark, sf), src)
    ingest.stream_bronze(spark, src, dst, dst + "-log").awaitTermination()
    return spark.read.parquet(dst).groupBy(F.col("sale_month").cast("string").alias("sale_month")
                                           ).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sale_price"), 2).alias("total_price"),
        F.bool_and(F.col("ingested_at").isNotNull() & F.col("source_file").isNotNull())
        .alias("stamped"))


@query("stream_collect", """SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS n,
  round(sum(value), 4) AS latency FROM events GROUP BY 1""")
def stream_collect(spark, sf):
    dst = scratch_path(spark, "collected")
    ingest.collect_predictions(_events(spark, sf), dst, dst + "-log").awaitTermination()
    return spark.read.parquet(dst).groupBy(F.col("hour").cast("string").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("latency_ms"), 4).alias("latency"))


_CLOSED = "w + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '2 minutes'"
_WINDOWS = """h AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'blue' ELSE 'green' END AS served_by,
  time_bucket(INTERVAL '1 hour', ts) AS w, count(*) AS requests,
  avg(CAST(event_type = 'error' AS INT)) AS error_rate, quantile_disc(value, 0.95) AS p95
  FROM events GROUP BY ALL)"""


@query("stream_health", f"""WITH {_WINDOWS} SELECT served_by, strftime(w, '%Y-%m-%d %H:%M')
  AS window_start, requests, round(error_rate, 6) AS error_rate, p95 FROM h WHERE {_CLOSED}""")
def stream_health(spark, sf):
    out = _drain(health.health_windows(_events(spark, sf), "1 hour"), "health")
    return out.select("served_by", F.date_format("window.start", "yyyy-MM-dd HH:mm")
                      .alias("window_start"), "requests",
                      F.round("error_rate", 6).alias("error_rate"), "p95")


@query("stream_rollback", f"""WITH {_WINDOWS}, e AS (SELECT served_by, w,
  min(error_rate) OVER r5 AS m5, count(*) OVER r5 AS c5, min(w) OVER r5 AS f5,
  min(p95 / 20) OVER r10 AS m10, count(*) OVER r10 AS c10, min(w) OVER r10 AS f10 FROM h
  WINDOW r5 AS (PARTITION BY served_by ORDER BY w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
  r10 AS (PARTITION BY served_by ORDER BY w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
t AS (SELECT served_by, w, 'error_rate' AS reason FROM e
  WHERE m5 > 0.01 AND c5 = 5 AND w - f5 = INTERVAL '4 hours'
  UNION ALL SELECT served_by, w, 'latency_p95' FROM e
  WHERE m10 > 2 AND c10 = 10 AND w - f10 = INTERVAL '9 hours')
SELECT served_by, strftime(w, '%Y-%m-%d %H:%M') AS window_start, reason FROM t WHERE {_CLOSED}""")
def stream_rollback(spark, sf):
    out = _drain(health.rollback_triggers(_events(spark, sf), 20.0, "1 hour",
                                          window_seconds=3600), "rollback")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query("stream_feedback", """SELECT a.event_id AS sale_id, p.event_id AS request_id,
  a.user_id AS property_hash, p.value AS price, a.value AS sale_price FROM events a JOIN events p
  ON a.user_id = p.user_id AND a.ts >= p.ts AND a.ts <= p.ts + INTERVAL '1 hour'
  WHERE a.event_type = 'purchase' AND p.event_type = 'view'""")
def stream_feedback(spark, sf):
    preds = _events(spark, sf).filter("event_type = 'view'").select(
        "request_id", "property_hash", F.col("ts").alias("pred_ts"),
        F.col("latency_ms").alias("price"))
    actuals = _events(spark, sf).filter("event_type = 'purchase'").select(
        F.col("request_id").alias("sale_id"), "property_hash", F.col("ts").alias("sale_ts"),
        F.col("latency_ms").alias("sale_price"))
    out = _drain(health.stream_feedback(preds, actuals), "feedback")
    return out.select("sale_id", "request_id", "property_hash", "price", "sale_price")


@query("stream_dedup", """SELECT event_id AS request_id, user_id AS property_hash,
  value AS latency_ms FROM events""")
def stream_dedup(spark, sf):
    events = _events(spark, sf)
    # Every twentieth request arrives twice.
    twice = F.explode(F.sequence(F.lit(1), F.when(F.col("request_id") % 20 == 0, 2).otherwise(1)))
    sent = events.withColumn("_copy", twice).drop("_copy")
    out = _drain(health.dedup_requests(sent), "dedup")
    return out.select("request_id", "property_hash", "latency_ms")
