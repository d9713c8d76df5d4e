"""Byte-level BPE inside tasks: words of many texts at once, and what is known of each word."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers

#: Distinct words a worker remembers before it starts anew; memory only, never results.
CACHED = 600_000
#: Words that the library encodes at once: what it gives for a word takes far more memory than the ids.
ENCODED = 4096
_LETTER, _DIGIT, _BLANK, _OTHER = 1, 2, 4, 8
# Kinds of bytes; those of two-byte Latin letters count as letters.
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
# Bytes that lead to other kinds of characters; texts that hold one are split by the pattern.
_RARE = np.zeros(256, bool)
_RARE[[*range(0x1C, 0x20), 0xC2, *range(0xC9, 256)]] = True
# The split pattern of byte-level tokenizers (fixed value).
_PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = _mixed(np.arange(1, 257, dtype=np.uint64))


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text starts and the last one ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


class Tokenizer:
    """What a byte-level tokenizer file says about splitting and encoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level tokenizer")
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self._cut = regex.compile("(" + "|".join(regex.escape(s.decode()) for s in self.special)
                                  + ")") if self.special else None
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        self.library = tokenizers.Tokenizer.from_file(path)

    def split(self, text: str) -> list[str]:
        """Words of one text; a special string is a word."""
        if self._cut is None:
            return _PATTERN.findall(text)
        out = []
        for i, part in enumerate(self._cut.split(text)):
            out += [part] if i % 2 else _PATTERN.findall(part)
        return out

    def words(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Start of every word of the texts ``data[ends[i]:ends[i + 1]]``; words cover all bytes.

        Runs of one kind are words; the last blank before a word is its space or a word alone, and
        a contraction is cut off. Texts with other than ASCII and Latin letters go by the pattern.
        """
        kind = _KIND[data]
        inner = np.ones(len(data), bool)
        inner[ends[:-1][ends[:-1] < len(data)]] = False
        first = ~inner
        first[1:] |= kind[1:] != kind[:-1]
        blank = kind == _BLANK
        tail = blank[:-1] & ~blank[1:] & inner[1:]
        first[:-1] |= tail
        first[1:][tail & (data[:-1] == 32)] = False
        self._cut_contractions(data, ends, first)
        for i in self._irregular(data, ends):
            lo, hi = ends[i], ends[i + 1]
            sizes = [len(w.encode()) for w in self.split(data[lo:hi].tobytes().decode())]
            first[lo:hi] = False
            first[lo + np.cumsum([0, *sizes[:-1]])] = True
        return np.flatnonzero(first)

    @staticmethod
    def _cut_contractions(data: np.ndarray, ends: np.ndarray, first: np.ndarray) -> None:
        at = np.flatnonzero((data == 39) & first)
        if not len(at):
            return
        stop = ends[np.searchsorted(ends, at, "right")]
        padded = np.append(data, np.zeros(3, np.uint8))
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (at + 2 <= stop)
        pairs = one.astype(np.int64) << 8 | two
        long = np.isin(pairs, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")]) & (
            at + 3 <= stop)
        for hit, size in ((short, 2), (long, 3)):
            for k in range(1, size):
                first[at[hit] + k] = False
            after = at[hit] + size
            first[after[after < stop[hit]]] = True

    def _irregular(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        places = [np.flatnonzero(_RARE[data])]
        signs = np.flatnonzero((data[1:] == 0x97) | (data[1:] == 0xB7))
        places.append(signs[data[signs] == 0xC3])
        whole = None
        for special in self.special:
            lead = np.flatnonzero(data == special[0])
            if len(lead):
                whole = data.tobytes() if whole is None else whole
                at = whole.find(special)
                while at >= 0:
                    places.append(np.array([at]))
                    at = whole.find(special, at + 1)
        return np.unique(np.searchsorted(ends, np.concatenate(places), "right") - 1)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    sizes = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        powers = np.full(int(sizes.max()), _ODD)
        powers[0] = 1
        return _mixed(np.add.reduceat(_VALUE[data] * np.cumprod(powers)[place], starts)
                      + sizes.astype(np.uint64))


class WordTable:
    """Remembers an array for each distinct word.

    ``learn`` gives the arrays of new words, one after the other, and their sizes; it is given at most
    ``batch`` words at once.
    """

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype: str,
                 limit: int = CACHED, batch: int = CACHED):
        self._learn, self._limit, self._batch = learn, limit, batch
        self._room = np.empty(0, dtype)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.place = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.pool = self._room[:0]

    def _append(self, arrays: np.ndarray) -> None:
        """Put ``arrays`` behind the pool, whose room grows by halves, so that it is seldom copied."""
        size = len(self.pool) + len(arrays)
        if size > len(self._room):
            room = np.empty(size + size // 2, self._room.dtype)
            room[:len(self.pool)] = self.pool
            self._room = room
        self._room[len(self.pool):size] = arrays
        self.pool = self._room[:size]

    def look_up(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Row of each word in ``place`` and ``size``, which point into ``pool``."""
        keys, where, inverse = np.unique(word_hashes(data, starts), return_index=True,
                                         return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        missing = np.flatnonzero(~known)
        if len(self.keys) and len(self.keys) + len(missing) > self._limit:
            self._clear()
            at, missing = np.zeros(len(keys), np.int64), np.arange(len(keys))
        if not len(missing):
            return at[inverse]
        stops = np.append(starts, len(data))
        raw, picked = data.tobytes(), where[missing]
        words = [raw[a:b] for a, b in zip(stops[picked].tolist(), stops[picked + 1].tolist())]
        begin, counts = len(self.pool), []
        for i in range(0, len(words), self._batch):
            arrays, sizes = self._learn(words[i:i + self._batch])
            self._append(arrays)
            counts.append(sizes)
        sizes = np.concatenate(counts)
        into = at[missing]
        self.keys = np.insert(self.keys, into, keys[missing])
        self.place = np.insert(self.place, into, begin + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, into, sizes)
        return np.searchsorted(self.keys, keys)[inverse]

    def gathered(self, rows: np.ndarray) -> np.ndarray:
        """The arrays of the rows, one after the other."""
        sizes = self.size[rows]
        ends = np.cumsum(sizes)
        if not len(ends):
            return np.empty(0, self._dtype)
        return self.pool[np.arange(ends[-1]) + np.repeat(self.place[rows] - (ends - sizes), sizes)]


class Encoder:
    """Token ids of whole texts as the library gives them, each new word encoded by the library."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer(path)
        self.table = WordTable(self._ids, "<u4", batch=ENCODED)

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tokenizer.library.encode_batch_fast([w.decode() for w in words],
                                                       add_special_tokens=False)
        ids = [x.ids for x in got]
        return (np.array([i for x in ids for i in x], "<u4"),
                np.fromiter(map(len, ids), np.int64, len(ids)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start and the last ones end."""
        data, ends = joined(column)
        if not len(data):
            return np.empty(0, "<u4"), np.zeros(len(ends), np.int64)
        starts = self.tokenizer.words(data, ends)
        rows = self.table.look_up(data, starts)
        total = np.concatenate([[0], np.cumsum(self.table.size[rows])])
        return self.table.gathered(rows), total[np.searchsorted(starts, ends)]


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One instance for each worker."""
    return Encoder(path)
