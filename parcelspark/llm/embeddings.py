"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import components, spread
from parcelspark.session import stage

THRESHOLD = 0.93
#: Passes of a round, sign hashes in a sort key, and neighbours that a vector is compared with at
#: least and at most on either side.
PASSES, BITS, REACH, MOST_REACH = 20, 62, 96, 1024
#: Vectors of a round that are compared with all of their label.
QUERIES = 512
#: Vectors in a block of neighbours, and in a block of the exact count within a component.
BLOCK, COUNT_BLOCK = 1024, 1024
SEED = 41


def sound_vectors(vectors: DataFrame) -> DataFrame:
    """``(row, vec_id, label, embedding)`` of the rows that can link: a label and a direction.

    Vectors that are null, empty, zero or hold null, NaN or infinite components are left out.
    """
    infinite = F.lit(float("inf"))
    sound = (F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
             & F.exists("embedding", lambda x: x != 0))
    return vectors.filter(sound).select("row", "vec_id", "label", "embedding")


def _units(column: pd.Series) -> np.ndarray:
    """Vectors of length one in double precision.

    Each is scaled by its largest component first, so that no square overflows or vanishes.
    """
    x = np.stack([np.asarray(v, np.float64) for v in column])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sums(groups: set[tuple[int, int]]):
    """Sums of the unit vectors of the given (label, length) in each batch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for (label, size), part in frame.groupby(["label", frame["embedding"].map(len)]):
                if (label, size) in groups:
                    yield pa.RecordBatch.from_pydict({
                        "label": pa.array([label], pa.int64()), "size": pa.array([size], pa.int32()),
                        "n": pa.array([len(part)], pa.int64()),
                        "sum": pa.array([_units(part["embedding"]).sum(axis=0)],
                                        pa.list_(pa.float64()))})

    return emit


def _centres(units: DataFrame, sizes: DataFrame, reach: int) -> dict[tuple[int, int], np.ndarray]:
    """Mean unit vector by (label, length), of those with more than 1/1000 of the vectors.

    They are fewer than a thousand by definition; the others are projected as they are.
    """
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = {(r["label"], r["size"]) for r in
             sizes.filter(F.col("n") > max(reach, total // 1000)).collect()}
    if not large:
        return {}
    sums = (units.select("label", "embedding")
            .mapInArrow(_sums(large), "label long, size int, n long, sum array<double>")
            .select("label", "size", "n", F.posexplode("sum").alias("at", "x"))
            .groupBy("label", "size", "at").agg((F.sum("x") / F.sum("n")).alias("x"))
            .groupBy("label", "size").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("c")))
    return {(r["label"], r["size"]): np.array([c["x"] for c in r["c"]]) for r in sums.collect()}


def _keys(passes: int, bits: int, seed: int, centres: dict[tuple[int, int], np.ndarray]):
    """Sort keys: in each pass the signs of ``bits`` random projections, one behind the other.

    Vectors are projected from the centre of their label, so that a label whose vectors lie to one
    side doesn't share most of its signs.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            frame = batch.to_pandas()
            for size, part in frame.groupby(frame["embedding"].map(len)):
                if size not in planes:
                    rng = np.random.default_rng([seed, size])
                    planes[size] = rng.standard_normal((passes, bits, size))
                unit, labels = _units(part["embedding"]), part["label"].to_numpy()
                for label in np.unique(labels):
                    if (label, size) in centres:
                        unit[labels == label] -= centres[label, size]
                for p in range(passes):
                    key = ((unit @ planes[size][p].T) > 0) @ weights
                    yield pa.RecordBatch.from_pydict({
                        "pass": pa.array(np.full(len(part), p), pa.int32()),
                        "label": pa.array(part["label"].astype("int64")),
                        "size": pa.array(np.full(len(part), size), pa.int32()),
                        "key": pa.array(key, pa.int64()),
                        "row": pa.array(part["row"].astype("int64"))})

    return emit


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the pairs join two trees of a growing forest: enough to keep all components."""
    parent = list(range(n))
    keep = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[x] = y
            keep[i] = True
    return keep


def _neighbour_links(threshold: float, reach: int):
    """Verified links of a block of sorted vectors; a forest of them for each block."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank", kind="stable")
        row, group = frame["row"].to_numpy(), frame["part"].to_numpy()
        parts = []
        sizes = frame["embedding"].map(len).to_numpy()
        # Vectors of several lengths meet at a border; those that compare stay side by side.
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            unit = _units(frame["embedding"].iloc[at])
            for lo in range(0, len(at), reach):
                hi = min(lo + reach, len(at))
                end = min(hi + reach, len(at))
                i, j = np.nonzero(unit[lo:hi] @ unit[lo:end].T >= threshold)
                ok = (j > i) & (j - i <= reach) & (group[at[lo + i]] == group[at[lo + j]])
                parts.append(np.stack([at[lo + i[ok]], at[lo + j[ok]]]))
        i, j = np.concatenate(parts, axis=1)
        keep = _forest(i, j, len(row))
        return pd.DataFrame({"a": row[i[keep]], "b": row[j[keep]]})

    return compare


def _query_links(threshold: float, queries: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]):
    """Verified links of a batch with the query vectors of their label and length; a forest."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for key, part in frame.groupby(["label", frame["embedding"].map(len)]):
                if key not in queries:
                    continue
                row, (asked, unit) = part["row"].to_numpy(), queries[key]
                i, j = np.nonzero(_units(part["embedding"]) @ unit.T >= threshold)
                i, j = i[row[i] != asked[j]], j[row[i] != asked[j]]
                keep = _forest(i, len(row) + j, len(row) + len(asked))
                yield pa.RecordBatch.from_pydict({"a": pa.array(row[i[keep]], pa.int64()),
                                                  "b": pa.array(asked[j[keep]], pa.int64())})

    return compare


def _asked(units: DataFrame, count: int, seed: int
           ) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """``count`` vectors drawn by a hash of their row: rows and unit vectors by (label, length)."""
    drawn = (units.orderBy(F.xxhash64("row", F.lit(seed)), "row").limit(count)
             .select("row", "label", "embedding").toPandas())
    return {key: (part["row"].to_numpy(), _units(part["embedding"])) for key, part in
            drawn.groupby(["label", drawn["embedding"].map(len)])}


def _ranked(keys: DataFrame) -> DataFrame:
    """``keys`` in global order with their rank: sorted by ranges, then offset by range counts."""
    order = ["pass", "label", "size", "key", "row"]
    sorted_keys = stage(keys.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    # One count per range; their number is that of shuffle partitions.
    counts = sorted_keys.groupBy(part.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for r in sorted(counts, key=lambda x: x["range"]):
        offsets.append((r["range"], total))
        total += r["n"]
    table = keys.sparkSession.createDataFrame(offsets or [(-1, 0)], "range long, before long")
    return (sorted_keys.withColumn("range", part).join(F.broadcast(table), "range")
            .withColumn("rank", F.col("before") + inside).drop("range", "before", "at"))


def _linked(units: DataFrame, threshold: float, passes: int, reach: int, bits: int,
            seed: int) -> DataFrame:
    """``(row, component)`` of the vectors with links: rounds of passes until one joins nothing."""
    sizes = stage(units.groupBy("label", F.size("embedding").alias("size"))
                  .agg(F.count(F.lit(1)).alias("n")), "sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    reach = max(reach, min(isqrt(most), MOST_REACH))
    size = max(BLOCK, 4 * reach)
    # Windows as long as every label hold all of its pairs: one pass is exact then.
    exact = most <= reach + 1
    centres = {} if exact else _centres(units, sizes, reach)
    # The last rows of a block are compared once more with the first of the next one.
    block = F.floor(F.col("rank") / size)
    again = F.when(F.col("rank") % size < reach, F.array(block, block - 1)).otherwise(
        F.array(block))
    group = F.xxhash64("pass", "label", "size").alias("part")
    parts, turn = None, 0
    while True:
        keys = units.select("row", "label", "embedding").mapInArrow(
            _keys(1 if exact else passes, bits, seed + turn, centres),
            "pass int, label long, size int, key long, row long")
        placed = (_ranked(keys).select("row", "rank", group, F.explode(again).alias("block"))
                  .filter("block >= 0"))
        found = (placed.join(units.select("row", "embedding"), "row").groupBy("block")
                 .applyInPandas(_neighbour_links(threshold, reach), "a long, b long"))
        if not exact:
            found = found.union(units.select("row", "label", "embedding").mapInArrow(
                _query_links(threshold, _asked(units, QUERIES, seed + turn)), "a long, b long"))
        links = stage(found.distinct(), "links")
        if parts is not None:
            here, there = (parts.toDF(end, f"c{end}") for end in ("a", "b"))
            links = stage(links.join(here, "a", "left").join(there, "b", "left")
                          .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
                          .select("a", "b"), "joins")
            if links.isEmpty():
                return parts
            links = links.union(parts.toDF("a", "b"))
        parts = stage(components(links, "a", "b").toDF("row", "component"), "parts")
        if exact:
            return parts
        turn += 1


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES,
                 reach: int = REACH, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors`` (vec_id, embedding,
    label).

    Only vectors with equal, non-null labels and equal lengths compare, by cosine in double
    precision. Each pass sorts the vectors by the signs of random projections from their label's
    centre and compares each with the next ``reach`` ones, or as many as the root of the largest
    label's size up to 1024; links found are verified, and joined across the passes. Rounds of
    ``passes`` passes, each with projections of its own and with 512 vectors that are compared with
    all of their label, go on until a round joins no two components. Then
    every pair inside a component is compared in blocks, so n_links counts all links of its
    vectors, however many neighbours a group of copies has. The result is exact when no label has
    more vectors than a window. In larger ones a link between components can be missed only if
    every pass of all rounds keeps its two vectors apart.

    Vectors that can't link stand alone, with no links. Rows with the same vec_id are vectors of
    their own, and a null vec_id counts as larger than any other. An empty table gives an empty
    result; other columns are ignored.
    """
    rows = stage(spread(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        "embedding")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    units = stage(sound_vectors(rows), "units")
    parts = _linked(units, threshold, passes, reach, bits, seed)
    counted = _count_links(units.select("row", "embedding").join(parts, "row"), threshold)
    known = (rows.select("row", "vec_id").join(parts, "row", "left").join(counted, "row", "left")
             .withColumn("component", F.coalesce("component", "row")))
    known = stage(known, "known")
    first = F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.col("row"))
    lowest = stage(known.groupBy("component").agg(F.min(first).alias("first")), "lowest")
    return known.join(lowest, "component").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("first.vec_id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("kept"))


def _count_links(members: DataFrame, threshold: float) -> DataFrame:
    """``(row, n_links)``: links of each vector inside its component.

    A component is cut into blocks; each pair of blocks is one group, so a large component is
    spread over many tasks and only counts leave them, never pairs.
    """
    members = stage(members, "members")
    sizes = stage(members.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / COUNT_BLOCK).cast("int").alias("blocks")), "sizes")
    own = members.join(sizes, "component").withColumn(
        "i", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = own.withColumn("k", other).select(
        "component", F.least("i", "k").alias("lo"), F.greatest("i", "k").alias("hi"), "i", "row",
        "embedding")

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        lo, hi = frame["lo"].iloc[0], frame["hi"].iloc[0]
        unit = _units(frame["embedding"])
        row, side = frame["row"].to_numpy(), frame["i"].to_numpy()
        if lo == hi:
            return pd.DataFrame({"row": row, "n": ((unit @ unit.T) >= threshold).sum(axis=1) - 1})
        left, right = side == lo, side == hi
        near = (unit[left] @ unit[right].T) >= threshold
        return pd.DataFrame({"row": np.concatenate([row[left], row[right]]),
                             "n": np.concatenate([near.sum(axis=1), near.sum(axis=0)])})

    return (pairs.groupBy("component", "lo", "hi").applyInPandas(count, "row long, n long")
            .groupBy("row").agg(F.sum("n").alias("n_links")))
