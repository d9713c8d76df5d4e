"""Best-fit packing of token sequences by bin completion over length counts."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.bpe import encoder_of
from parcelspark.llm.common import slices, spread, text_or_empty
from parcelspark.session import stage

CAPACITY = 1024
#: Ranks within a length are counted in so many buckets, so a common length fills no one task.
BUCKETS = 256
#: Fillings kept for one largest document, and nodes the search may visit after its incumbent.
FILLINGS, NODES = 6, 4000
#: Waste, in tokens, that a completion may have for each document that it uses less.
THRIFT = (0, 1, 3, 8, 20)


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of each document's ids and ``end_id``.

    Documents longer than ``capacity`` are cut; the first piece takes what full ones leave.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, last = encoder_of(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices([batch], "text", 1 << 18):
                ids, ends = encoder.encode(part.column("text"))
                rows = []
                for doc, lo, hi in zip(part.column("doc_id").to_pylist(), ends, ends[1:]):
                    raw, total = ids[lo:hi].tobytes() + last, int(hi - lo) + 1
                    at, length, piece = 0, total % capacity or capacity, 0
                    while at < total:
                        rows.append((doc, piece, at, length,
                                     zlib.crc32(raw[4 * at:4 * (at + length)])))
                        at, length, piece = at + length, capacity, piece + 1
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    return docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Counts:
    """How many documents of each length are left."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.n, self.capacity = counts.astype(np.int64).copy(), capacity

    def fillings(self, free: int, thrift: int) -> list[tuple[int, ...]]:
        """Undominated fillings of ``free``, best first, larger documents first.

        A filling is a descending tuple of lengths; it is the better the less it wastes, and the
        fewer documents it uses up at ``thrift`` tokens each. Which sums can be reached at all
        prunes the branches, and so does the best filling found: one that wastes more is dominated.
        """
        lengths = np.flatnonzero(self.n[:free + 1])[::-1]
        lengths = lengths[lengths > 0].tolist()
        if not lengths:
            return [()]
        full = (1 << (free + 1)) - 1
        # reach[i]: bit s is set when s is a sum of documents among lengths[i:].
        reach = [1]
        for x in reversed(lengths):
            have, old = 1, -1
            have = reach[-1]
            for _ in range(min(int(self.n[x]), free // x)):
                old, have = have, have | (have << x) & full
                if old == have:
                    break
            reach.append(have)
        reach.reverse()
        found: list[tuple[int, tuple[int, ...]]] = []
        for total in range(free, -1, -1):
            if found and free - total + thrift >= min(found)[0]:
                break
            if not reach[0] >> total & 1:
                continue
            stack, before = [(0, total, ())], len(found)
            while stack and len(found) < before + FILLINGS:
                i, left, taken = stack.pop()
                if not left:
                    found.append((free - total + thrift * len(taken), taken))
                    continue
                options = []
                while i < len(lengths):
                    if reach[i + 1] >> left & 1:
                        options.append((i + 1, left, taken))
                    x = lengths[i]
                    most = min(int(self.n[x]), left // x)
                    grown = [(i + 1, left - k * x, taken + (x,) * k) for k in range(1, most + 1)
                             if reach[i + 1] >> (left - k * x) & 1]
                    if grown:
                        options.extend(grown)
                        break
                    if options and options[-1][0] == i + 1:
                        options.pop()
                    i += 1
                stack.extend(options)
        return [taken for _, taken in sorted(found, key=lambda x: x[0])[:FILLINGS]] or [()]


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over length counts: the first incumbent.

    Equal documents go into the fullest bins that have room, as many into each as it takes.
    """
    bins: dict[int, dict[tuple[int, ...], int]] = {capacity: {(): int(counts.sum()) + 1}}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for free in sorted(f for f in bins if f >= length):
            for filling in list(bins[free]):
                each = free // length
                for k in (each, left % each):
                    times = min(left // k, bins[free][filling]) if k else 0
                    if times:
                        bins[free][filling] -= times
                        room = bins.setdefault(free - k * length, {})
                        grown = filling + (length,) * k
                        room[grown] = room.get(grown, 0) + times
                        left -= times * k
            if not left:
                break
    return [(f, n) for group in bins.values() for f, n in group.items() if f and n]


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and how often each is used, for ``counts[length]`` documents of each length.

    Bin completion: the largest document left gets a completion, used as often as the counts of
    its lengths allow. The best-fit solution is the first incumbent. Descents that spare small
    documents more and more follow; each goes back over its last choices and drops a branch when
    its waste so far already rules out fewer bins, and ends at the lower bound of the total length
    or after NODES fillings. Work depends on the number of lengths, not of documents.
    """
    counts = np.asarray(counts, np.int64).copy()
    total = int((counts * np.arange(len(counts))).sum())
    over_half = int(counts[capacity // 2 + 1:].sum())
    bound = max(-(-total // capacity), over_half)
    best = best_fit(counts, capacity)
    best_bins = sum(times for _, times in best)
    for thrift in THRIFT:
        if best_bins <= bound:
            break
        best, best_bins = _descend(counts, capacity, thrift, best, best_bins, bound, total)
    return best


def _descend(counts, capacity, thrift, best, best_bins, bound, total):
    """Branch and bound with one way to rank completions; the better of incumbent and find."""
    visited = 0

    def take(state: _Counts, largest: int, filling: tuple[int, ...]) -> int:
        lengths, need = np.unique((largest, *filling), return_counts=True)
        times = int((state.n[lengths] // need).min())
        state.n[lengths] -= times * need
        return times

    # A stack of choices: the state before, the plan so far and the fillings not yet tried.
    first = _Counts(counts, capacity)
    trail: list = [(first, [], 0, 0, None)]
    while trail:
        state, plan, bins, waste, options = trail.pop()
        left = np.flatnonzero(state.n)
        if not len(left):
            if bins < best_bins:
                best, best_bins = plan, bins
            if best_bins <= bound:
                break
            continue
        slack = (best_bins - 1) * capacity - total - waste
        if visited >= NODES + len(counts):
            break
        if slack < 0:
            continue
        largest = int(left[-1])
        if options is None:
            state.n[largest] -= 1
            options = state.fillings(capacity - largest, thrift)
            state.n[largest] += 1
        filling, rest = options[0], options[1:]
        if rest:
            trail.append((state, plan, bins, waste, rest))
            # Only the last choices are gone over again: earlier ones are dropped from the trail.
            if len(trail) > 64:
                del trail[0]
        nextstate = _Counts(state.n, capacity)
        times = take(nextstate, largest, filling)
        spare = capacity - largest - sum(filling)
        visited += 1
        trail.append((nextstate, [*plan, ((largest, *filling), times)], bins + times,
                      waste + times * spare, None))
    return best, best_bins


def slots_of(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, last rank, sequence of the first rank, offset)`` of each slot."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for length in filling:
            rank = used.get(length, 0)
            out.append((length, rank, rank + times - 1, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pack the token ids of ``docs`` (doc_id, text) into sequences of at most ``capacity``.

    Returns ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.
    A null or empty text is the end id alone. Repeated rows and rows that share a doc_id are packed
    each. An empty table gives an empty result; other columns are ignored.

    Only the number of pieces of each length, ``capacity`` figures, is looked at in one place; the
    plan found there has a few thousand slots at most. Each piece finds its slot by its rank among
    the pieces of its length.
    """
    spark = docs.sparkSession
    docs = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              text_or_empty("text").alias("text")))
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(BUCKETS)).cast("int")
    pieces = stage(pieces_of(docs, tokenizer, end_id, capacity).withColumn("bucket", bucket),
                   "pieces")
    sizes = stage(pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    slots = spark.createDataFrame(
        slots_of(complete_bins(counts, capacity)) or [(0, 0, 0, 0, 0)],
        "slot_length long, lo long, hi long, base long, offset long")
    by_bucket = Window.partitionBy("length").orderBy("bucket")
    before = sizes.select("length", "bucket", (F.sum("n").over(by_bucket) - F.col("n"))
                          .alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    # Both broadcasts are bounded: capacity * BUCKETS counts, and the slots of the plan.
    ranked = (pieces.withColumn("rank", F.row_number().over(order) - 1)
              .join(F.broadcast(before), ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("before")))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length"))
                         & F.col("rank").between(F.col("lo"), F.col("hi")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("base") + F.col("rank") - F.col("lo")).alias("sequence_id"),
                         "offset")
