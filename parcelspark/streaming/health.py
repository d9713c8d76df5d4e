"""Endpoint health, rollback triggers, feedback and duplicates as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelspark.operators.monitor import ERROR_RATE_MAX, P95_RATIO_MAX


def dedup_requests(log: DataFrame, watermark: str = "10 minutes", ts: str = "ts",
                   request_id: str = "request_id") -> DataFrame:
    """First row of each request id; ids are forgotten after the watermark."""
    return log.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([request_id])


def health_windows(log: DataFrame, window: str = "1 minute", watermark: str = "2 minutes",
                   by: str = "served_by", ts: str = "ts", latency: str = "latency_ms",
                   is_error: str = "is_error") -> DataFrame:
    """Requests, error rate and p95 per deployment and tumbling window.

    The percentile is the mergeable sketch: its state per window is bounded, and partial sketches
    are built before the shuffle, so a busy deployment does not fill one task.
    """
    return (log.withWatermark(ts, watermark)
            .groupBy(by, F.window(ts, window).alias("window"))
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.avg(F.col(is_error).cast("double")).alias("error_rate"),
                 F.percentile_approx(latency, 0.95, 10_000).alias("p95")))


def rollback_triggers(log: DataFrame, baseline_p95: float, window: str = "1 minute",
                      watermark: str = "2 minutes", window_seconds: int = 60,
                      err: float = ERROR_RATE_MAX, err_for: int = 5,
                      p95_ratio: float = P95_RATIO_MAX, p95_for: int = 10) -> DataFrame:
    """Sustained conditions as a second windowed aggregation over the health windows.

    Emits (served_by, window_start of the last window, reason): every one of the last ``err_for``
    windows above the error rate, or every one of the last ``p95_for`` above the latency ratio.
    """
    per_window = health_windows(log, window, watermark).select(
        "served_by", F.window_time("window").alias("at"), "error_rate",
        (F.col("p95") / baseline_p95).alias("ratio"))
    # One stateful pass for both conditions: each window is asked for its own metric and span.
    conditions = F.array(
        F.struct(F.lit("error_rate").alias("reason"), F.col("error_rate").alias("figure"),
                 F.lit(err).alias("above"), F.lit(err_for).alias("periods")),
        F.struct(F.lit("latency_p95").alias("reason"), F.col("ratio").alias("figure"),
                 F.lit(p95_ratio).alias("above"), F.lit(p95_for).alias("periods")))
    longest = max(err_for, p95_for)
    span = F.window("at", f"{longest * window_seconds} seconds", f"{window_seconds} seconds")
    asked = per_window.select("served_by", "at", F.inline(conditions)).withColumn("span", span)
    recent = (F.unix_timestamp("at") >= F.unix_timestamp(F.col("span.end"))
              - F.col("periods") * window_seconds)
    runs = asked.filter(recent).groupBy("served_by", "reason", "span").agg(
        F.count(F.lit(1)).alias("seen"), F.min("figure").alias("least"),
        F.first("above").alias("above"), F.first("periods").alias("periods"))
    hit = (F.col("seen") == F.col("periods")) & (F.col("least") > F.col("above"))
    start = F.timestamp_seconds(F.unix_timestamp(F.col("span.end")) - window_seconds)
    return runs.filter(hit).select("served_by", start.alias("window_start"), "reason")


def stream_feedback(preds: DataFrame, actuals: DataFrame, key: str = "property_hash",
                    pred_ts: str = "pred_ts", act_ts: str = "sale_ts", max_gap_seconds: int = 3600,
                    watermark: str = "10 minutes") -> DataFrame:
    """Predictions with the sales that follow within ``max_gap_seconds``.

    The join key includes a time slot of that length; a sale looks into its own slot and the one
    before, so a key with many rows is spread over slots and its old state is dropped.
    """
    def slot(ts):
        return F.floor(F.unix_timestamp(ts) / F.lit(max_gap_seconds))

    left = preds.withWatermark(pred_ts, watermark).withColumn("_slot", slot(pred_ts))
    right = (actuals.withWatermark(act_ts, watermark).withColumnRenamed(key, "_key")
             .withColumn("_near", F.explode(F.array(slot(act_ts), slot(act_ts) - 1))))
    gap = F.expr(f"{act_ts} >= {pred_ts} AND {act_ts} <= {pred_ts} "
                 f"+ INTERVAL {max_gap_seconds} SECONDS")
    joined = left.join(right, (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_near"))
                       & gap)
    return joined.drop("_key", "_slot", "_near")


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators dropped for being behind the watermark."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in p["stateOperators"])
