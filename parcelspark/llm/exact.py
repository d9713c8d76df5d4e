"""Exact deduplication of texts behind a two-pass Bloom filter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import SPACE, keep_rows, spread, text_or_empty
from parcelspark.session import stage

#: Bits of filter per row, and the bounds of the filter: 8 KB to 32 MB. Beyond the upper bound
#: more rows pass for possibly repeated and are shuffled; the result stays exact.
BITS_PER_ROW, LEAST_BITS, MOST_BITS = 24, 1 << 16, 1 << 28
SEGMENT_BITS = 1 << 16
PROBES = 3


def text_digests(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, text_sha256, h)``: SHA-256 of the text with white space runs made one space."""
    text = F.regexp_replace(text_or_empty("text"), f"{SPACE}+", " ")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.sha2(text, 256).alias("text_sha256"))
            .withColumn("h", F.xxhash64("text_sha256"))
            .withColumn("row", F.monotonically_increasing_id()))


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """Places in the filter: one 64-bit word per hash and one bit in each third of the word."""
    h = h.view(np.uint64)
    word = (h >> np.uint64(32)) % np.uint64(bits // 64) * np.uint64(64)
    return np.stack([word + np.uint64(21 * i) + (h >> np.uint64(10 * i)) % np.uint64(21)
                     for i in range(PROBES)]).astype(np.int64)


def bloom_filter(keys: DataFrame, hash_col: str, rows: int,
                 repeated: bool = False) -> tuple[int, dict]:
    """The bits that the hashes set, or set at least twice, as ``{segment: packed bits}``.

    Each task sets bits for its own rows; the segments of all tasks are merged on the executors.
    What comes back is a filter of at most MOST_BITS bits, however many rows there are.
    """
    wanted = min(max(rows * BITS_PER_ROW, LEAST_BITS), MOST_BITS)
    bits = 1 << (wanted - 1).bit_length()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, new = np.empty(0, np.int64), np.empty(0, np.int64), []

        def settle():
            nonlocal once, twice, new
            places, n = np.unique(np.concatenate(new), return_counts=True)
            twice = np.union1d(twice, np.concatenate(
                [places[n > 1], np.intersect1d(places, once, assume_unique=True)]))
            once, new = np.union1d(once, places), []

        for batch in batches:
            new.append(_positions(batch.column(0).to_numpy(), bits).ravel())
            if sum(map(len, new)) > 1 << 22:
                settle()
        if new:
            settle()
        for part in np.unique(once // SEGMENT_BITS):
            packed = []
            for places in (once, twice):
                at = np.zeros(SEGMENT_BITS, bool)
                lo, hi = np.searchsorted(places, [part * SEGMENT_BITS, (part + 1) * SEGMENT_BITS])
                at[places[lo:hi] - part * SEGMENT_BITS] = True
                packed.append(np.packbits(at).tobytes())
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([part], pa.int64()), "once": pa.array([packed[0]], pa.binary()),
                "twice": pa.array([packed[1]], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, a, b in zip(*[c.to_pylist() for c in batch.columns]):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if part in once:
                    twice[part] = twice[part] | b | (once[part] & a)
                    once[part] = once[part] | a
                else:
                    once[part], twice[part] = a, b
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array(list(twice), pa.int64()),
            "bits": pa.array([x.tobytes() for x in (twice if repeated else once).values()],
                             pa.binary())})

    filled = keys.select(hash_col).mapInArrow(fill, "segment long, once binary, twice binary")
    merged = filled.repartition("segment").mapInArrow(merge, "segment long, bits binary")
    return bits, {r[0]: bytes(r[1]) for r in merged.collect() if any(r[1])}


def mark_possible(keys: DataFrame, hash_col: str, bits: int, segments: dict) -> DataFrame:
    """``keys`` and ``maybe``, which is false only for rows whose hash isn't in the filter."""
    shared = keys.sparkSession.sparkContext.broadcast(segments)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(bits // 8, np.uint8)
        for part, packed in shared.value.items():
            at = part * SEGMENT_BITS // 8
            whole[at:at + len(packed)] = np.frombuffer(packed, np.uint8)[:len(whole) - at]
        for batch in batches:
            places = _positions(batch.column(hash_col).to_numpy(), bits)
            hit = (whole[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit.all(axis=0))],
                                             [*batch.schema.names, "maybe"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema)
    return keys.mapInArrow(test, f"{kinds}, maybe boolean")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Which row stays for each row of ``docs`` (doc_id, text; other columns are ignored).

    Texts are equal when identical after each run of white space became one space. The row with
    the smallest doc_id stays; a null doc_id counts as larger than any number, and of rows with the
    same doc_id and text one stays. Null and empty texts are equal to each other. An empty table
    gives an empty result.

    A first pass over the digests fills a Bloom filter of bits set at least twice. Rows that miss
    it in the second pass are unique and are never shuffled; the others are grouped by digest, with
    partial aggregates, so a large group of copies is counted before it moves.
    """
    rows = stage(text_digests(spread(docs.select("doc_id", "text"))), "digests")
    bits, twice = bloom_filter(rows, "h", rows.count(), repeated=True)
    marked = mark_possible(rows, "h", bits, twice).drop("h")
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    maybe = marked.filter("maybe").drop("maybe")
    # Staged, so that the join below may split the copies of one text over tasks.
    groups = stage(maybe.groupBy("text_sha256").agg(F.min(first).alias("first"),
                                                    F.count(F.lit(1)).alias("group_size")),
                   "groups")
    seen = maybe.join(groups, "text_sha256").select(
        "row", "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")
    alone = marked.filter("NOT maybe").select(
        "row", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return alone.union(seen)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns and one row for each text.

    Rows are kept by doc_id. Rows that share a doc_id with another text's row are told apart by the
    text's digest, and repeated rows among them are merged.
    """
    kept = stage(exact_duplicates(docs).filter("kept").select("doc_id", "text_sha256"), "kept")
    ids = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id")).groupBy("doc_id")
                .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "twice")
    if ids.isEmpty():
        return keep_rows(docs, kept.select("doc_id"))
    again = ids.toDF("_twice")
    twice = docs["doc_id"].eqNullSafe(again["_twice"])
    single = keep_rows(docs.join(again, twice, "left_anti"), kept.select("doc_id").distinct())
    text = F.regexp_replace(text_or_empty("text"), f"{SPACE}+", " ")
    digests = docs.join(again, twice, "left_semi").withColumn("_digest", F.sha2(text, 256))
    wanted = kept.toDF("_id", "_sha")
    several = digests.join(wanted, digests["doc_id"].eqNullSafe(wanted["_id"])
                           & (digests["_digest"] == wanted["_sha"]), "left_semi")
    plain = [c for c, kind in several.dtypes if not kind.startswith("map")]
    key = [F.col("doc_id"), F.col("_digest")]
    return single.unionByName(_one_row(several, key, plain).drop("_digest"))


def _one_row(df: DataFrame, key: list, plain: list[str]) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in plain])
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
