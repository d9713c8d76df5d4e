"""Removal of repeated runs of lines by a suffix array over line ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parcelspark.llm.common import slices, spread, text_or_empty
from parcelspark.llm.exact import bloom_filter, mark_possible
from parcelspark.session import stage

#: Words that a stretch of lines needs to count as a passage.
MIN_WORDS = 50


def _ordered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its place in the global order of ``order``, from 0 on.

    Rows are sorted by ranges, so no task sorts more than its share; one count per range, as many
    as shuffle partitions, is looked at to offset the places.
    """
    ranges = stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    counts = {r[0]: r[1] for r in ranges.groupBy(part).agg(F.count(F.lit(1))).collect()}
    offsets, total = [], 0
    for k in sorted(counts):
        offsets.append((k, total))
        total += counts[k]
    table = df.sparkSession.createDataFrame(offsets or [(-1, 0)], "part long, before long")
    return (ranges.withColumn("part", part).join(F.broadcast(table), "part")
            .withColumn(name, F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1))
            .drop("at", "part", "before"))


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(d, doc_id, pos, id, m, back)`` for each line of ``docs`` (d, doc_id, text).

    A line's id is a hash of it without outer white space. ``m`` is the smallest number of lines
    from this one on that hold ``min_words`` words, null when the rest of the text holds fewer;
    ``back`` is that of lines up to this one, null as well when they are the first one's ``m`` lines.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "text"):
                parts = []
                for d, doc, text in zip(*[c.to_pylist() for c in part.columns]):
                    lines = text.encode().split(b"\n")
                    ids = np.array([xxh64_intdigest(x.strip()) for x in lines], np.uint64)
                    upto = np.cumsum([0, *[len(x.split()) for x in lines]])
                    at = np.arange(len(lines))
                    end = np.searchsorted(upto, upto[:-1] + min_words)
                    begin = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
                    parts.append((np.full(len(lines), d), [doc] * len(lines), at,
                                  ids.view(np.int64), end - at, end > len(lines),
                                  at + 1 - begin, (begin < 0) | (end[begin] == at + 1)))
                d, doc, at, ids, m, none, back, few = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(d)),
                     pa.array([x for own in doc for x in own], pa.int64()),
                     pa.array(np.concatenate(at).astype(np.int64)), pa.array(np.concatenate(ids)),
                     pa.array(np.concatenate(m).astype(np.int64), mask=np.concatenate(none)),
                     pa.array(np.concatenate(back).astype(np.int64), mask=np.concatenate(few))],
                    ["d", "doc_id", "pos", "id", "m", "back"])

    return docs.select("d", "doc_id", "text").mapInArrow(
        cut, "d long, doc_id long, pos long, id long, m long, back long")


def suffix_ranks(places: DataFrame) -> list[DataFrame]:
    """Rank tables ``(d, pos, rank)`` by prefix doubling of ``places`` (d, pos, id).

    Table k orders the suffixes by their first ``2**k`` lines; suffixes with equal first lines, an
    interval of the suffix array with so long a common prefix, share a rank. A suffix whose first
    lines occur once needs no further order and is left out of this and all later tables, so the
    tables shrink and the last one is as long as the longest repeated run asks for.
    """
    tables: list[DataFrame] = []
    pairs = places.select("d", "pos", F.col("id").alias("rank"), F.lit(0).alias("next"))
    while True:
        pairs = stage(pairs, "pairs")
        classes = (pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").drop("n"))
        # Staged, so that the join may split a pair that very many suffixes share.
        classes = stage(_ordered(classes, ["rank", "next"], "new"), "classes")
        table = stage(pairs.join(classes, ["rank", "next"]).select(
            "d", "pos", F.col("new").alias("rank")), "ranks")
        if table.isEmpty():
            return tables
        step = 1 << len(tables)
        tables.append(table)
        ahead = table.select("d", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"))
        pairs = table.join(ahead, ["d", "pos"])


def later_passages(lines: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``(d, pos, m, q_d, q_pos)``: shortest passages that occur before, with their first place.

    A passage of m lines is known by the ranks of its first and its last ``2**k`` lines, k being
    the largest that fits. Order is by doc_id (null last), document and line.
    """
    found = None
    for k, table in enumerate(tables):
        size = 1 << k
        last = table.select("d", F.col("pos").alias("end"), F.col("rank").alias("r2"))
        own = (lines.filter(f"m >= {size} AND m < {2 * size}").select("d", "doc_id", "pos", "m")
               .join(table.withColumnRenamed("rank", "r1"), ["d", "pos"])
               .withColumn("end", F.col("pos") + F.col("m") - size).join(last, ["d", "end"])
               .select("d", "doc_id", "pos", "m", "r1", "r2"))
        found = own if found is None else found.union(own)
    found = stage(found, "passages")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "d", "pos")
    firsts = stage(found.groupBy("m", "r1", "r2").agg(F.min(place).alias("q"),
                                                      F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").select("m", "r1", "r2", F.col("q.d").alias("q_d"),
                                           F.col("q.pos").alias("q_pos")), "firsts")
    return stage(found.join(firsts, ["m", "r1", "r2"]).filter("d <> q_d OR pos <> q_pos")
                 .select("d", "pos", "m", "q_d", "q_pos"), "later")


def _common_lines(pairs: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``pairs`` with ``m`` as the longest common run of lines from (d, pos) and (q_d, q_pos) on.

    Longest steps first: when the next ``2**k`` lines have the same rank, both move on by them.
    """
    pairs = pairs.withColumn("m", F.lit(0).cast("long"))
    for k in reversed(range(len(tables))):
        here = tables[k].select("d", F.col("pos").alias("a"), F.col("rank").alias("ra"))
        there = tables[k].select(F.col("d").alias("q_d"), F.col("pos").alias("b"),
                                 F.col("rank").alias("rb"))
        pairs = stage(pairs.withColumn("a", F.col("pos") + F.col("m"))
                      .withColumn("b", F.col("q_pos") + F.col("m"))
                      .join(here, ["d", "a"], "left").join(there, ["q_d", "b"], "left")
                      .withColumn("m", F.col("m") + F.when(F.col("ra") == F.col("rb"), 1 << k)
                                  .otherwise(0))
                      .select("d", "pos", "q_d", "q_pos", "m"), "common")
    return pairs


def stretches(lines: DataFrame) -> DataFrame:
    """``(d, doc_id, pos, m)``: the shortest passages that begin or end at each line."""
    ends = lines.filter("back IS NOT NULL").select(
        "d", "doc_id", (F.col("pos") + 1 - F.col("back")).alias("pos"), F.col("back").alias("m"))
    return lines.filter("m IS NOT NULL").select("d", "doc_id", "pos", "m").union(ends)


def repeated_runs(lines: DataFrame, any_copy: bool = False) -> DataFrame:
    """``(d, lo, hi)``: the lines ``lo <= pos < hi`` of each document that repeat earlier ones.

    With ``any_copy`` these are all maximal runs that occur at any earlier place. Where such a run
    reaches past the passage it begins with, the shortest passage that ends at each further line
    lies in the run and occurs earlier as well, so the repeated ones of ``stretches`` cover it.
    """
    tables = suffix_ranks(lines)
    if not tables:
        return lines.select("d", F.col("pos").alias("lo"), F.col("pos").alias("hi")).limit(0)
    if any_copy:
        return _joined(later_passages(stretches(lines), tables).select("d", "pos", "m"))
    later = later_passages(lines, tables)
    # Passages of one run follow each other, and so do their first places; the last one is
    # followed to the end of the common run.
    by_doc = Window.partitionBy("d").orderBy("pos")
    follows = [F.lead(c).over(by_doc) == F.col(c) + step
               for c, step in (("pos", 1), ("q_d", 0), ("q_pos", 1))]
    goes_on = F.coalesce(follows[0] & follows[1] & follows[2], F.lit(False))
    ends = later.withColumn("on", goes_on).filter("NOT on").drop("on")
    return _joined(later.select("d", "pos", "m").union(
        _common_lines(ends, tables).select("d", "pos", "m")))


def _joined(passages: DataFrame) -> DataFrame:
    """``(d, lo, hi)``: the stretches of lines that ``passages`` (d, pos, m) cover together."""
    spans = passages.select(
        "d", F.col("pos").alias("lo"), (F.col("pos") + F.col("m")).alias("hi"))
    before = (Window.partitionBy("d").orderBy("lo", "hi")
              .rowsBetween(Window.unboundedPreceding, -1))
    upto = Window.partitionBy("d").orderBy("lo", "hi")
    begins = (F.col("lo") > F.coalesce(F.max("hi").over(before), F.lit(-1))).cast("int")
    return (spans.withColumn("begins", begins).withColumn("run", F.sum("begins").over(upto))
            .groupBy("d", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS,
                        any_copy: bool = False) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, text)`` for each row of ``docs`` (doc_id, text).

    From each line on, the shortest stretch that holds ``min_words`` words is a passage; lines are
    equal when they are without outer white space. When the passage occurs before, in the same text
    or in one with a smaller doc_id (null last), its lines go, and so do the lines behind it as far
    as they agree with those behind its first occurrence, or with ``any_copy`` behind the earlier
    occurrence that agrees longest. The first copy of a run always stays.
    Null texts count as empty; texts without a repeated passage come back as they are. Rows with
    equal doc_id and text are one document and get the same result. An empty table gives an empty
    result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty("text").alias("text")).withColumn(
        "d", F.xxhash64("doc_id", "text"))
    lines = stage(line_table(spread(docs), min_words).dropDuplicates(["d", "pos"]), "lines")
    runs = stage(repeated_runs(lines, any_copy).groupBy("d").agg(
        F.collect_list(F.struct("lo", "hi")).alias("runs")), "runs")
    # Only texts that lose lines are shuffled; a Bloom filter of bounded size lets the others pass.
    bits, segments = bloom_filter(runs.select("d"), "d", runs.count())
    marked = mark_possible(docs, "d", bits, segments)
    n_lines = F.size(F.split("text", "\n", -1)).cast("long")
    whole = marked.filter("NOT maybe").select(
        "doc_id", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), "text")
    kept = F.filter("lines", lambda x, i: ~F.exists(
        "runs", lambda r: (r["lo"] <= i) & (i < r["hi"])))
    cut = (marked.filter("maybe").join(runs.hint("merge"), "d", "left")
           .withColumn("lines", F.split("text", "\n", -1))
           .withColumn("kept", F.when(F.col("runs").isNull(), F.col("lines")).otherwise(kept))
           .select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                   (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
                   F.array_join("kept", "\n").alias("text")))
    return whole.union(cut)
