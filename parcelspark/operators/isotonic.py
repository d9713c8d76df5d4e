"""Exact isotonic calibration: pooled blocks of range partitions, merged at their borders."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.operators.skew import HOT_ROWS, forward_fill, lookup_join
from parcelspark.session import stage

_BLOCK = ["lo", "hi", "total", "n"]
#: Range partitions of a round, unless one would hold more than HOT_ROWS points.
MAX_PARTS = 256


def parts_for(rows: int, part_rows: int) -> int:
    """Partitions of about ``part_rows`` points, so many that neither their number nor one of them grows
    with the table alone: the driver samples every range partition, and each is a task and a file."""
    return max(min(math.ceil(rows / part_rows), max(MAX_PARTS, math.ceil(rows / HOT_ROWS))), 1)


def pool(blocks: Iterable[tuple[float, float, float, int]],
         out: list[tuple[float, float, float, int]] | None = None) -> list[tuple[float, float, float, int]]:
    """Neighbouring blocks ``(lo, hi, total, n)`` pooled until their means rise, behind those of ``out``."""
    out = [] if out is None else out
    for lo, hi, total, n in blocks:
        while out and out[-1][2] * n >= total * out[-1][3]:
            before = out.pop()
            lo, total, n = before[0], before[2] + total, before[3] + n
        out.append((lo, hi, total, n))
    return out


def _pooled(points: DataFrame, region: str, parts: int) -> DataFrame:
    """Points or blocks pooled inside ``parts`` ranges of (region, lo)."""
    schema = points.select(region, *_BLOCK).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, blocks, owner = TaskContext.get().partitionId(), [], [], None

        def flush():
            columns = [pa.array([owner] * len(blocks), names[0].type),
                       *[pa.array([b[i] for b in blocks], t) for i, t in enumerate(
                           (pa.float64(), pa.float64(), pa.float64(), pa.int64()))]]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * len(blocks), pa.int32())], [region, *_BLOCK, "part"])

        for batch in batches:
            names = [batch.column(0)]
            rows = zip(batch.column(0).to_pylist(), *[batch.column(i).to_pylist() for i in range(1, 5)])
            for name, *block in rows:
                if blocks and name != owner:
                    yield flush()
                    blocks = []
                owner = name
                pool([tuple(block)], blocks)
        if blocks:
            yield flush()

    ranged = (points.select(region, *_BLOCK).repartitionByRange(parts, region, "lo")
              .sortWithinPartitions(region, "lo"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return ranged.mapInArrow(run, f"{kinds}, part int")


def isotonic_blocks(df: DataFrame, region: str, y: str = "sale_price", pred: str = "pred",
                    part_rows: int = HOT_ROWS) -> DataFrame:
    """``(region, lo, hi, total, n)``: the blocks of the isotonic fit of ``y`` on ``pred``.

    Each block covers the predictions from ``lo`` to ``hi`` of its region and has ``n`` rows whose
    actual prices sum to ``total``; its mean is the fit, and means rise from block to block. Rows
    without a region, prediction or price don't count.

    Predictions are summed by value and pooled inside range partitions of about ``part_rows`` points, more
    where that would make over ``MAX_PARTS`` of them, so a region may spread over many tasks. A block can only change if a later partition begins with a
    lower mean or an earlier one ends with a higher mean; the others are done, and only those at the
    borders go into the next round, which has half as many partitions at most.
    """
    points = df.filter(F.col(region).isNotNull() & F.col(pred).isNotNull() & ~F.isnan(pred)
                       & F.col(y).isNotNull() & ~F.isnan(y))
    left = stage(points.groupBy(region, F.col(pred).cast("double").alias("lo")).agg(
        F.max(F.col(pred).cast("double")).alias("hi"), F.sum(F.col(y).cast("double")).alias("total"),
        F.count(F.lit(1)).alias("n")), "points")
    rows, parts, done = left.count(), None, None
    while True:
        needed = parts_for(rows, part_rows)
        parts = needed if parts is None else max(min(parts // 2, needed), 1)
        blocks = stage(_pooled(left, region, parts), "blocks")
        if parts == 1:
            break
        mean = F.col("total") / F.col("n")
        by_part = Window.partitionBy(region).orderBy("part")
        # One row for each region and partition.
        borders = stage(blocks.groupBy(region, "part").agg(
            F.min(mean).alias("first"), F.max(mean).alias("last")).select(
            region, "part",
            F.min("first").over(by_part.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
            F.max("last").over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("before")),
            "borders")
        open_ = F.coalesce(mean >= F.col("after"), F.lit(False)) | F.coalesce(
            mean <= F.col("before"), F.lit(False))
        marked = stage(lookup_join(blocks, borders, [region, "part"], "inner").select(
            region, *_BLOCK, open_.alias("open")), "marked")
        closed = marked.filter("NOT open").select(region, *_BLOCK)
        done = closed if done is None else done.unionByName(closed)
        left = marked.filter("open").select(region, *_BLOCK)
        rows = left.count()
        if not rows:
            return done
    blocks = blocks.select(region, *_BLOCK)
    return blocks if done is None else done.unionByName(blocks)


def isotonic_values(df: DataFrame, blocks: DataFrame, region: str, pred: str = "pred") -> DataFrame:
    """Add ``block``, the struct (lo, total, n) of the last block that begins at or below the
    prediction, or of the region's first one below all blocks; null for unknown regions and null
    predictions."""
    found = F.struct("lo", "total", "n")
    first = stage(blocks.groupBy(region).agg(F.min(found).alias("_first")), "first")
    x = F.col(pred).cast("double")
    named = df.filter(F.col(region).isNotNull() & F.col(pred).isNotNull())
    rows = named.select(region, x.alias("_x"), F.lit(1).alias("_side"), F.struct(*df.columns).alias("_row"))
    marks = blocks.select(region, F.col("lo").alias("_x"), F.lit(0).alias("_side"), found.alias("_block"))
    filled = forward_fill(rows.unionByName(marks, allowMissingColumns=True), [region], ["_x", "_side"],
                          "_block").filter("_side = 1")
    out = lookup_join(filled.select(region, "_row", "_block"), first, [region])
    out = out.select(*[F.col("_row")[c].alias(c) for c in df.columns],
                     F.coalesce("_block", "_first").alias("block"))
    rest = df.filter(F.col(region).isNull() | F.col(pred).isNull())
    return out.unionByName(rest, allowMissingColumns=True)


def isotonic_calibrate(df: DataFrame, blocks: DataFrame, region: str, pred: str = "pred") -> DataFrame:
    """Replace the prediction by the fit of its block; unknown regions keep it."""
    fit = F.col("block.total") / F.col("block.n")
    return isotonic_values(df, blocks, region, pred).withColumn(
        pred, F.coalesce(fit, F.col(pred))).drop("block")
