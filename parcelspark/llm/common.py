"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.session import stage

#: Links that one task joins by itself: 4 MB, and a few times that in arrays.
EDGES = 1 << 18
#: White space of the contracts, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` itself, or its rows dealt out when the scan has fewer splits than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def strings(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a slice holds about ``max_bytes`` of text or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def keep_rows(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is in ``ids`` (one column, unique; a null key matches null)."""
    wanted = ids.toDF("_wanted")
    return docs.join(wanted, docs[key].eqNullSafe(wanted["_wanted"]), "left_semi")


def drop_rows(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key isn't in ``ids`` (one column, unique; a null key matches null).

    The ids are staged, so that their size is known: where few rows go, whole texts aren't shuffled.
    """
    gone = stage(ids.toDF("_gone"), "gone")
    return docs.join(gone, docs[key].eqNullSafe(gone["_gone"]), "left_anti")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of a link table: ``(node, component)`` with the smallest reachable node.

    Large-star and small-star steps alternate. A step reduces each node's neighbours to their
    minimum with partial aggregates before it joins, and its result is written to the shared
    folder, so neither a node with very many links nor a long chain needs one task's memory. As soon as
    no more than EDGES links are left, one task joins them, without shuffles. Nodes without links to another node don't appear; null ends are ignored.
    """
    edges = stage(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                  .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
                  .distinct(), "links")
    seen = _digest(edges)
    while seen[0] > EDGES:
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("hi"),
                                                            F.col("m").alias("lo")).distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").filter("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(low.select("hi", F.col("m").alias("lo"))).distinct())
        edges = stage(small, "links")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    if seen[0] <= EDGES:
        kind = edges.schema["hi"].dataType.simpleString()
        return edges.coalesce(1).mapInArrow(_forest, f"node {kind}, component {kind}")
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .union(edges.select("lo", "lo").distinct()))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, component)`` of a few links ``(hi, lo)``; roots with a smaller neighbour go under it."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    ends = [x for k in (0, 1) for b in batches for x in [b.column(k)]]
    kind = ends[0].type
    nodes, at = np.unique(np.concatenate([x.to_numpy(zero_copy_only=False) for x in ends]),
                          return_inverse=True)
    hi, lo = np.split(at, 2)
    root = np.arange(len(nodes))
    while True:
        a, b = root[hi], root[lo]
        apart = a != b
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(nodes[root], kind)],
                                     ["node", "component"])


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")),
                    F.sum(F.col("hi").cast("decimal(38,0)"))).first()
    return tuple(row)


def columns(df: DataFrame, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in zip(names, types)])
