"""Exact token counts at every prefix of a text, by dynamic programming over its words."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.bpe import Tokenizer, WordTable, joined
from parcelspark.llm.common import slices, spread, text_or_empty

LIMIT = 512
_CONTRACTIONS = {b"'re", b"'ve", b"'ll"}
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLANK_BYTES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BLANK_END = regex.compile(r"\s")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others take the code points from 256 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Number of tokens of every prefix of a word.

    ``last[i]``, the last token of the first i bytes, is the one token ending there that may stand
    behind ``last[i - its length]``; the count is one more than there. Two tokens may stand side by
    side when no merge across their border comes before the merges that made them. Words of a batch
    advance together, byte by byte.
    """

    def __init__(self, tokenizer: Tokenizer):
        letters = _byte_letters()
        vocab = {t: i for t, i in tokenizer.vocab.items() if t.encode() not in tokenizer.special}
        # Ranks: single bytes first, then the merges in their order.
        parts, names = [], {}
        for t in sorted((t for t in vocab if len(t) == 1), key=vocab.get):
            names[t] = len(names)
        self.single = len(names)
        for pair in tokenizer.merges:
            a, b = pair.split(" ")
            parts.append((names[a], names[b]))
            names[a + b] = len(names)
        if len(names) != len(vocab) or len(parts) + self.single != len(names):
            raise ValueError("every token must be a byte or the result of one merge")
        self.left = np.arange(len(names))
        self.right = np.arange(len(names))
        self.left[self.single:], self.right[self.single:] = np.array(parts).T
        keys = self.left[self.single:] << 20 | self.right[self.single:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank = keys[order], order + self.single
        raw = [bytes(letters[c] for c in t) for t in names]
        self.longest = max(map(len, raw))
        self.value = np.random.default_rng(5).integers(1, 1 << 63, 256).astype(np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(self.longest, _ODD)) * _INVERSE
            hashes = np.array([(self.value[list(t)] * powers[:len(t)]).sum(dtype=np.uint64)
                               + np.uint64(len(t)) for t in raw])
        order = np.argsort(hashes)
        self.token_keys, self.token_rank = hashes[order], order
        # First look-up by the leading bits; tokens that share a slot are searched for.
        slots = (self.token_keys >> np.uint64(44)).astype(np.int64)
        self.slot = np.full(1 << 20, -1, np.int32)
        self.slot[slots] = np.arange(len(slots))
        self.shared = np.bincount(slots, minlength=1 << 20) > 1
        # Pairs decided before; a table of fixed size in which later pairs replace others.
        self.memo_key = np.full(1 << 20, -1, np.int64)
        self.memo = np.zeros(1 << 20, bool)

    def _beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = ((key * 0x5851F42D4C957F2D) >> 43) & ((1 << 20) - 1)
        out = self.memo[at]
        new = np.flatnonzero(self.memo_key[at] != key)
        if len(new):
            out[new] = self._decide(a[new], b[new])
            self.memo_key[at[new]], self.memo[at[new]] = key[new], out[new]
            # Two new pairs may share a place: what is stored must belong to the stored key.
            late = new[self.memo_key[at[new]] != key[new]]
            self.memo_key[at[late]] = -1
        return out

    def _decide(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), bool)
        a, b, rows = a.copy(), b.copy(), np.arange(len(a))
        limit = np.full(len(a), 1 << 40)
        while len(rows):
            key = a << 20 | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            early = (self.pair_keys[at] == key) & (self.pair_rank[at] < limit)
            ok[rows[early]] = False
            # Take the younger token apart on the side of the border; bytes can't be.
            from_a = (a > b) & (self.right[a] != a) | (self.left[b] == b)
            done = early | from_a & (self.right[a] == a)
            limit = np.where(from_a, a, b + 1)
            a, b = np.where(from_a, self.right[a], a), np.where(from_a, b, self.left[b])
            a, b, limit, rows = a[~done], b[~done], limit[~done], rows[~done]
        return ok

    def _tokens(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are tokens', and those tokens."""
        slot = (key >> np.uint64(44)).astype(np.int64)
        at = self.slot[slot]
        some = np.flatnonzero(at >= 0)
        at = at[some]
        several = np.flatnonzero(self.shared[slot[some]])
        at[several] = np.minimum(np.searchsorted(self.token_keys, key[some[several]]),
                                 len(self.token_keys) - 1)
        real = self.token_keys[at] == key[some]
        return some[real], self.token_rank[at[real]]

    def counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the first 1, 2, ... bytes of each word, word after word, and word sizes."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        offset = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(len(data) + 1, _ODD)) * _INVERSE
            back = np.cumprod(np.full(len(data) + 1, _INVERSE)) * _ODD
            total = np.concatenate([np.zeros(1, np.uint64),
                                    np.cumsum(self.value[data] * powers[:-1])])
            ends, lengths, tokens = [], [], []
            place = np.arange(len(data))
            for n in range(1, min(self.longest, int(sizes.max())) + 1):
                place = place[offset[place] >= n]
                key = (total[place + 1] - total[place + 1 - n]) * back[place + 1 - n] + np.uint64(n)
                hit, token = self._tokens(key)
                ends.append(place[hit])
                lengths.append(np.full(len(hit), n))
                tokens.append(token)
        ends, lengths, tokens = map(np.concatenate, (ends, lengths, tokens))
        order = np.argsort(offset[ends], kind="stable")
        ends, lengths, tokens = ends[order], lengths[order], tokens[order]
        steps = np.searchsorted(offset[ends], np.arange(1, int(sizes.max()) + 2))
        last = np.zeros(len(data), np.int64)
        count = np.zeros(len(data), np.int32)
        for k in range(int(sizes.max())):
            end, n, token = (x[steps[k]:steps[k + 1]] for x in (ends, lengths, tokens))
            inner = n <= k
            fits = np.ones(len(end), bool)
            fits[inner] = self._beside(last[(end - n)[inner]], token[inner])
            end, n, token = end[fits], n[fits], token[fits]
            last[end] = token
            count[end] = np.where(n <= k, count[end - n], 0) + 1
        for i in np.flatnonzero(sizes == 3):
            if words[i] in _CONTRACTIONS:  # cut in its midst it is a quote and a letter
                count[sizes[:i].sum() + 1] = 2
        return count, sizes


class PrefixTable:
    """Counts for whole texts: a table for each distinct word, summed along the text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer(path)
        counter = PrefixCounter(self.tokenizer)

        def learn(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            count, sizes = counter.counts(words)
            for i in np.flatnonzero(np.isin(sizes, [len(s) for s in self.tokenizer.special])):
                if words[i] in self.tokenizer.special:
                    at = sizes[:i].sum()
                    count[at:at + sizes[i]] = 1
            return count, sizes

        self.table = WordTable(learn, "<i4")

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(bytes, where texts start, tokens of the text up to and with each byte)``."""
        data, ends = joined(column)
        if not len(data):
            return data, ends, np.empty(0, np.int64)
        starts = self.tokenizer.words(data, ends)
        rows = self.table.look_up(data, starts)
        stops = np.append(starts[1:], len(data))
        last = self.table.pool[self.table.place[rows] + self.table.size[rows] - 1].astype(np.int64)
        before = np.cumsum(last) - last
        first_word = np.searchsorted(starts, ends)
        text_of = np.searchsorted(ends, starts, "right") - 1
        before -= np.append(before, before[-1] + last[-1])[first_word[text_of]]
        counts = self.table.gathered(rows) + np.repeat(before, stops - starts)
        self._cut_in_blanks(data, ends, starts, stops, before, counts)
        self._cut_in_special(data, ends, starts, stops, before, counts)
        return data, ends, counts

    def _total(self, words: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum([0, *map(len, words[:-1])])
        rows = self.table.look_up(data, starts)
        return self.table.pool[self.table.place[rows] + self.table.size[rows] - 1].astype(np.int64)

    def _cut_in_blanks(self, data, ends, starts, stops, before, counts) -> None:
        """Behind the first blank of a word that follows a blank word, both are one word."""
        blank_last = _BLANK_BYTES[data[stops - 1]]
        blank_first = np.where(_BLANK_BYTES[data[starts]], 1, 0)
        for i in self.tokenizer._irregular(data, ends):
            lo, hi = np.searchsorted(starts, ends[i:i + 2])
            for j in range(lo, hi):
                word = data[starts[j]:stops[j]].tobytes().decode()
                blank_last[j] = bool(_BLANK_END.match(word[-1]))
                blank_first[j] = len(word[0].encode()) if _BLANK_END.match(word[0]) else 0
        again = np.flatnonzero((blank_first[1:] > 0) & blank_last[:-1]) + 1
        again = again[~np.isin(starts[again], ends)]
        if len(again):
            stop = starts[again] + blank_first[again]
            whole = [data[a:b].tobytes() for a, b in zip(starts[again - 1], stop)]
            counts[stop - 1] = before[again - 1] + self._total(whole)

    def _cut_in_special(self, data, ends, starts, stops, before, counts) -> None:
        """Up to its last byte a special string is ordinary text."""
        lengths = {len(s) for s in self.tokenizer.special}
        for j in np.flatnonzero(np.isin(stops - starts, list(lengths))):
            if data[starts[j]:stops[j]].tobytes() not in self.tokenizer.special:
                continue
            i = j if starts[j] in ends or data[starts[j - 1]:stops[j - 1]].tobytes() in (
                self.tokenizer.special) else j - 1
            for stop in range(starts[j] + 1, stops[j]):
                tail = data[starts[i]:stop].tobytes().decode()
                words = [w.encode() for w in self.tokenizer.split(tail)]
                counts[stop - 1] = before[i] + self._total(words).sum()


@lru_cache(maxsize=1)
def prefix_table(path: str) -> PrefixTable:
    """One instance for each worker."""
    return PrefixTable(path)


def _documents(docs: DataFrame) -> DataFrame:
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              text_or_empty("text").alias("text")))


def _char_ends(data: np.ndarray) -> np.ndarray:
    """Whether a byte is the last of its character."""
    follow = np.append((data[1:] & 0xC0) == 0x80, False)[:len(data)]
    return ~follow


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, counts)``: ``counts[k]`` tokens in the first k characters of the text.

    A table to store once and to ask later with ``tokens_within`` and ``longest_prefix``.
    """

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            for part in slices([batch], "text", 1 << 20):
                data, ends, counts = prefix_table(tokenizer).of(part.column("text"))
                chars = _char_ends(data)
                rows = [np.append(0, counts[a:b][chars[a:b]]).astype(np.int32)
                        for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))],
                    ["doc_id", "counts"])

    return _documents(docs).mapInArrow(table, "doc_id long, counts array<int>")


def tokens_within(counts: str, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` characters, or of the whole text if it is shorter."""
    return F.element_at(counts, (F.least(n_chars, F.size(counts) - 1) + 1).cast("int"))


def longest_prefix(counts: str, budget: int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    return F.array_max(F.transform(counts, lambda c, k: F.when(c <= budget, k)))


def token_budget(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, fit_chars)`` for each row of docs (doc_id, text).

    n_tokens is what the tokenizer's library gives for the whole text without added tokens; special
    strings in a text are one token. fit_chars is the length of the longest prefix whose own tokens
    number at most ``limit``. All three are read off the prefix table. A null text counts as empty:
    no bytes, no tokens. Repeated rows count each; an empty table gives an empty result; other
    columns are ignored.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            for part in slices([batch], "text", 4 << 20):
                data, ends, counts = prefix_table(tokenizer).of(part.column("text"))
                sizes = np.diff(ends)
                total, fit = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                some = sizes > 0
                if some.any():
                    total[some] = counts[ends[1:][some] - 1]
                    chars = np.cumsum(_char_ends(data))
                    ok = np.where(_char_ends(data) & (counts <= limit), chars, 0)
                    starts = ends[:-1][some]
                    begun = np.where(starts > 0, chars[starts - 1], 0)
                    fit[some] = np.maximum(np.maximum.reduceat(ok, starts) - begun, 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(total),
                     pa.array(total > limit), pa.array(fit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return _documents(docs).mapInArrow(
        measure, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
