"""Packing without padding: power-of-two pieces of documents in buckets of equal length."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.bpe import encoder_of
from parcelspark.llm.common import slices, spread, text_or_empty
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

CAPACITY = 1024
_NAMES = ["row", "doc_id", "start", "length", "doc_tokens", "ids"]


def decompose(totals: np.ndarray, capacity: int = CAPACITY
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, start, length)`` of the pieces of documents of ``totals`` tokens.

    ``capacity``, a power of two, comes as often as it fits; the rest is cut by its binary digits,
    the largest first. Pieces come document after document.
    """
    totals = np.asarray(totals, np.int64)
    bits = 1 << np.arange(capacity.bit_length() - 2, -1, -1)
    digits = (totals[:, None] & bits) > 0
    whole = totals // capacity
    doc, bit = np.nonzero(digits)
    doc = np.concatenate([np.repeat(np.arange(len(totals)), whole), doc])
    length = np.concatenate([np.full(int(whole.sum()), capacity), bits[bit]])
    order = np.argsort(doc, kind="stable")
    doc, length = doc[order], length[order]
    start = np.cumsum(length) - length
    before = np.cumsum(totals) - totals
    return doc, start - before[doc], length


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``(task, row, doc_id, start, length, doc_tokens, ids)`` of each document's ids and ``end_id``.

    ``ids`` are little-endian unsigned 32-bit numbers. ``row`` counts the pieces of one length inside
    their task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, task = encoder_of(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity.bit_length(), np.int64)
        for batch in batches:
            for part in slices([batch], "text", 2 << 20):
                ids, ends = encoder.encode(part.column("text"))
                totals = np.diff(ends) + 1
                ids = np.insert(ids, ends[1:], end_id).astype("<u4")
                doc, start, length = decompose(totals, capacity)
                bucket = np.log2(length).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                found = np.bincount(bucket, minlength=len(seen))
                row = np.empty(len(doc), np.int64)
                first = np.cumsum(found) - found
                row[order] = np.arange(len(doc)) - first[bucket[order]] + seen[bucket[order]]
                seen += found
                # The pieces of a batch cover its ids in their order.
                offsets = np.append(0, np.cumsum(4 * length))
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc),
                    [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), task, np.int32)), pa.array(row),
                     part.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                     pa.array(totals[doc]), raw.cast(pa.binary())], ["task", *_NAMES])

    return docs.mapInArrow(cut, "task int, row long, doc_id long, start long, length long, "
                                "doc_tokens long, ids binary")


def binary_sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
                     payload: str = "ids") -> DataFrame:
    """Sequences without padding: ``(doc_id, start, length, doc_tokens, sequence_id, slot, ids)``.

    The ids of each document (doc_id, text) and ``end_id`` are cut into pieces of ``capacity``, 512,
    256, ... ids; each piece is a sequence, so no sequence crosses documents. Sequences of one length
    form a bucket: ``slot`` numbers them there from 0 without gaps, and ``sequence_id`` over all
    buckets, the shortest length first. ``payload`` "ids" keeps the ids as little-endian unsigned
    32-bit numbers, "crc32" only their checksum as ``ids_crc32``.

    A null or empty text is ``end_id`` alone. Repeated rows and rows that share a doc_id are packed
    each; a null doc_id stays null. An empty table gives an empty result; other columns are ignored.

    Tasks number their own pieces, and only their counts by length meet, so no row is shuffled, and a
    bucket that holds most of the pieces needs no task of its own.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    if payload not in ("ids", "crc32"):
        raise ValueError("payload must be 'ids' or 'crc32'")
    docs = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              text_or_empty("text").alias("text")))
    pieces = pieces_of(docs, tokenizer, end_id, capacity)
    if payload == "crc32":
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
        payload = "ids_crc32"
    pieces = stage(pieces, "binary")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # One row per length: at most 11 at the default capacity.
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"))
    bases = lengths.select("length", (F.sum("n").over(Window.orderBy("length")) - F.col("n"))
                           .alias("base"))
    by_task = Window.partitionBy("length").orderBy("task")
    before = counts.select("length", "task", (F.sum("n").over(by_task) - F.col("n")).alias("lower"))
    places = stage(before.join(F.broadcast(bases), "length"), "places")
    return lookup_join(pieces, places, ["length", "task"], "inner").select(
        "doc_id", "start", "length", "doc_tokens",
        (F.col("base") + F.col("lower") + F.col("row")).alias("sequence_id"),
        (F.col("lower") + F.col("row")).alias("slot"), payload)


def batches(sequences: DataFrame, tokens: int) -> DataFrame:
    """Add ``batch``: sequences of one length in their order, ``tokens`` ids a batch.

    Each batch has sequences of one length only, ``tokens / length`` of them but for the last of a
    length. ``tokens`` must be a multiple of the longest length.
    """
    return sequences.withColumn("batch", F.floor(F.col("slot") * F.col("length") / tokens))
