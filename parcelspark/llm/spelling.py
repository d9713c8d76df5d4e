"""Spelling variants among the words of a corpus, by permuterm rotations."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.bpe import joined
from parcelspark.llm.common import slices, spread, text_or_empty
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

LEAST_CHARS, LEAST_COUNT = 6, 5
#: A word's form occurs at least so many times as often.
FORM_RATIO = 5
#: One run in so many loses a code point.
LOSS = 199
#: Stands behind a word in its rotations; no word holds it, and it sorts before all others.
END = "\x00"
_SHORT = 64
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def letter_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, stop, code points)`` of the maximal runs of ASCII and Latin-1 letters.

    In UTF-8 the code points from U+00C0 to U+00FF are byte 0xC3 and one more. Runs end with their text.
    """
    lead = data == 0xC3
    follow = np.append(False, lead[:-1])
    inside = _LETTER[data] | lead | follow
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = ends[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    chars = np.append(0, np.cumsum(inside & ~follow))
    return starts, stops, chars[stops] - chars[starts]


def run_checksums(data: np.ndarray, starts: np.ndarray, stops: np.ndarray,
                  before: np.ndarray) -> np.ndarray:
    """crc32 of each run's bytes behind a text whose crc32 is ``before``; byte by byte for all runs."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    sizes = stops - starts
    order = np.argsort(sizes, kind="stable")
    steps = np.searchsorted(sizes[order], np.arange(1, _SHORT + 1))
    end = int(np.searchsorted(sizes[order], _SHORT, "right"))
    for k in range(_SHORT):
        rows = order[steps[k]:end]
        if not len(rows):
            break
        now = state[rows]
        state[rows] = (now >> np.uint32(8)) ^ _CRC[(now ^ data[starts[rows] + k]) & np.uint32(255)]
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in order[end:]:
        out[i] = zlib.crc32(data[starts[i]:stops[i]].tobytes(), int(before[i]))
    return out


def _gathered(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The runs as an Arrow column."""
    sizes = stops - starts
    offsets = np.append(0, np.cumsum(sizes))
    place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64)),
                                            pa.py_buffer(data[place]))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices([batch], "text", 4 << 20):
            data, ends = joined(part.column("text"))
            if not len(data):
                continue
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
            starts, stops, chars = letter_runs(data, ends)
            long = chars >= LEAST_CHARS
            starts, stops, chars = starts[long], stops[long], chars[long]
            names = ["" if x is None else str(x) for x in part.column("doc_id").to_pylist()]
            seeds = np.array([zlib.crc32(f"{x}:".encode()) for x in names], np.uint32)
            h = run_checksums(data, starts, stops,
                              seeds[np.searchsorted(ends, starts, "right") - 1])
            lost = h % LOSS == 0
            found = _gathered(data, starts[~lost], stops[~lost]).value_counts()
            words, n = found.field("values"), found.field("counts")
            shorter = []
            for i in np.flatnonzero(lost):
                run, at = data[starts[i]:stops[i]].tobytes().decode(), int(h[i] % chars[i])
                if chars[i] > LEAST_CHARS:
                    shorter.append(run[:at] + run[at + 1:])
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([words, pa.array(shorter, pa.large_string())]).cast(pa.string()),
                 pa.concat_arrays([n, pa.array(np.ones(len(shorter), np.int64))])], ["word", "n"])


def word_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of the words of at least six code points that occur ``least`` times.

    Words are the letter runs of the texts with A-Z in lower case; where the crc32 of
    ``<doc_id>:<run>`` is divisible by 199, the run has lost one code point. Each slice of texts is
    counted before anything is shuffled.
    """
    runs = spread(docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                              text_or_empty("text").alias("text")))
    return (runs.mapInArrow(_counted, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def rotations(words: DataFrame) -> DataFrame:
    """All rotations of each word and its end mark: ``(prefix, skipped, first, word, n)``.

    A whole rotation has no ``skipped`` code point. A rotation that begins behind a code point ends
    with it; without it the rotation is ``prefix`` and ``skipped`` says that it was left out. ``first``
    tells whether the skipped code point is the first of a run of equal ones.
    """
    word, size = F.col("word"), F.char_length("word")

    def turned(i: Column, skip: int) -> Column:
        return F.concat(word.substr(i + 1 + skip, size), F.lit(END), word.substr(F.lit(1), i))

    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        turned(i, 0).alias("prefix"), F.lit(None).cast("string").alias("skipped"),
        F.lit(False).alias("first")))
    cut = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        turned(i, 1).alias("prefix"), word.substr(i + 1, F.lit(1)).alias("skipped"),
        ((i == 0) | (word.substr(i, F.lit(1)) != word.substr(i + 1, F.lit(1)))).alias("first")))
    return (words.filter(size > 0).select("word", "n", F.explode(F.concat(whole, cut)).alias("r"))
            .select("r.*", "word", "n"))


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, near, near_n)`` of each word that has near words in ``words`` (word, n).

    Rotations are sorted by prefix. Those that share a prefix and skip a code point differ by a
    replacement; the whole rotation of that prefix is the word that one of them has with a code
    point less. A word with equal neighbouring code points loses only the first of them, so that no
    pair is met twice. A scan of each group gives every member the number of its neighbours there and
    the best of them: largest n, then smallest in code-point order. A group has as many members as
    there are different code points, and no pair is written out.
    """
    group = Window.partitionBy("prefix")
    order = group.orderBy(F.col("skipped").isNull(), F.desc("n"), "word")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    skips, place = F.col("skipped").isNotNull(), F.struct((-F.col("n")).alias("m"), "word")
    scanned = rotations(words).withColumns({
        "skips": F.count("skipped").over(group),
        "firsts": F.count(F.when(F.col("first"), 1)).over(group),
        "exact": F.max(F.when(~skips, place)).over(group),
        "best_first": F.min(F.when(F.col("first"), place)).over(group),
        "rank": F.row_number().over(order),
        "top": F.first(place).over(whole), "after": F.lead(place).over(order)})
    other = F.when(F.col("rank") > 1, F.col("top")).when(F.col("skips") > 1, F.col("after"))
    joins = F.col("first") & F.col("exact").isNotNull()
    met = scanned.select(
        "word",
        F.when(skips, F.col("skips") - 1 + joins.cast("long")).otherwise(F.col("firsts"))
        .alias("met"),
        F.when(skips, F.least(other, F.when(joins, F.col("exact"))))
        .otherwise(F.col("best_first")).alias("best")).filter("met > 0")
    return (met.groupBy("word").agg(F.sum("met").alias("n_near"), F.min("best").alias("best"))
            .select("word", "n_near", F.col("best.word").alias("near"),
                    (-F.col("best.m")).alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the end of each word's chain of forms, by pointer doubling.

    A form occurs more often than its word, so chains end; each round doubles the steps.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = stage(lookup_join(now, ahead, ["root"]), "roots")
        if step.filter("ahead IS NOT NULL").isEmpty():
            return now
        now = step.select("word", F.coalesce("ahead", "root").alias("root"))


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT,
                      ratio: int = FORM_RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``docs`` (doc_id, text).

    See :func:`word_counts` for the words. Two words are near if one inserted, deleted or replaced
    code point separates them. ``form`` is the near word of largest n (ties: smallest in code-point
    order) if that is at least ``ratio`` times the word's n; ``root`` the last form from form to form.
    A null text has no words; a null doc_id is written as an empty one. Repeated rows count each. An
    empty table gives an empty result; other columns are ignored.
    """
    words = stage(word_counts(docs, least), "words")
    near = near_words(words)
    enough = F.col("near_n") >= ratio * F.col("n")
    known = stage(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(known.filter("form IS NOT NULL"))
    return lookup_join(known, ends, ["word"]).select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
