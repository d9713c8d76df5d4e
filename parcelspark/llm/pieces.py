"""Sampled segmentations of whole texts into SentencePiece pieces, and decoding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.bpe import WordTable
from parcelspark.llm.common import slices, spread, text_or_empty

#: Segmentations per text, and the weight of piece scores: small values flatten the distribution.
SAMPLES, ALPHA, SEED = 2, 0.0005, 23
#: What a character that only byte pieces can write costs, in scores below the lowest piece.
FALLBACK = 10.0
#: Columns that a lattice keeps of an edge, words whose lattices a worker remembers (about 1.5 KB each)
#: before it starts anew, and words learned at once, few enough for a processor's cache.
WIDTH, REMEMBERED, LEARNED = 7, 100_000, 4096
_SPACE = "▁".encode()
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, *counters: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on a row's key and counters only."""
    with np.errstate(over="ignore"):
        for c in counters:
            key = _mixed(key * _ODD + np.asarray(c).astype(np.uint64) + np.uint64(1))
    return ((key >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def _short(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, as 16-bit ones where they fit, which sort in linear time."""
    return x.astype(np.uint16) if x.max(initial=0) < 1 << 16 else x


class Lattice:
    """Edges of every word's lattice: at a place, the pieces that start there.

    Words are cut before a space, which no piece has inside, so a text's lattice is the chain of its
    words' lattices. An edge keeps its probability given its place, among all completions: piece
    weights times what the rest of the word sums up to (backward sums).
    """

    def __init__(self, path: str, alpha: float):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model
        special = [i for i in range(model.vocab_size()) if model.is_control(i)
                   or model.is_unknown(i) or model.is_unused(i)]
        self.byte_ids = np.zeros(256, np.int64)
        names: dict[bytes, int] = {}
        self.text: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.text.append(bytes([value]))
            elif i in special:
                self.text.append(b"")
            else:
                raw = piece.replace("▁", " ").encode()
                names[raw] = i
                self.text.append(raw)
        if any(b" " in raw.lstrip(b" ") for raw in names):
            raise ValueError("a piece has a space inside")
        score = np.array([model.get_score(i) for i in range(model.vocab_size())])
        usual = score[score > -1e8]
        self.weight = alpha * np.maximum(score, usual.min())
        self.fallback = alpha * (usual.min() - FALLBACK)
        self.names = names
        self._grow_tree()
        # Columns of an edge: its place in the word, its length in bytes, its id (-1: byte pieces),
        # its log-probability, what the other edges of the place share, the probability up to it
        # among those of the place, and the first edge of the place it leads to, counted from the
        # word's first edge (-1: the word's end). Edges lie by word and place.
        self.edges = WordTable(self._learn, "f8", REMEMBERED, LEARNED)

    def _grow_tree(self) -> None:
        """Prefix tree of the pieces as arrays: a node's child by a byte lies at ``base[node] + byte``
        if that slot's ``owner`` is the node. ``piece`` is the id that a node spells, or -1."""
        nodes: dict[bytes, int] = {b"": 0}
        below: list[list[int]] = [[]]
        for raw in self.names:
            for n in range(1, len(raw) + 1):
                if raw[:n] not in nodes:
                    nodes[raw[:n]] = len(nodes)
                    below[nodes[raw[:n - 1]]].append(raw[n - 1])
                    below.append([])
        room = 256 + 4 * len(nodes)
        owner, base = [-1] * (room + 256), [0] * len(nodes)
        for node in sorted(range(len(nodes)), key=lambda i: -len(below[i])):
            at = node * 0x9E3779B1 % room
            while any(owner[at + b] >= 0 for b in below[node]):
                at = (at + 1) % room
            base[node] = at
            for b in below[node]:
                owner[at + b] = node
        self.base, self.owner = np.array(base, np.int32), np.array(owner, np.int32)
        self.child = np.zeros(len(owner), np.int32)
        self.piece = np.full(len(nodes), -1, np.int32)
        for raw, node in nodes.items():
            if raw:
                self.child[base[nodes[raw[:-1]]] + raw[-1]] = node
                self.piece[node] = self.names.get(raw, -1)

    def _pieces_at(self, data: np.ndarray, stop: np.ndarray, place: np.ndarray) -> list[tuple]:
        """``(start, length, id)`` of the pieces inside words, one entry for each length, by start."""
        found = []
        at, node, n = place, np.zeros(len(place), np.int32), 0
        while len(at):
            slot = self.base[node] + data[at + n]
            on = np.flatnonzero(self.owner[slot] == node)
            at, node, n = at[on], self.child[slot[on]], n + 1
            ident = self.piece[node]
            real = np.flatnonzero(ident >= 0)
            found.append((at[real], n, ident[real]))
            inside = np.flatnonzero(at + n < stop[at])
            at, node = at[inside], node[inside]
        return found

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        stop = np.repeat(ends, sizes)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        found = self._pieces_at(data, stop, place)
        # A character without a piece of its own is written in bytes.
        span = np.zeros(len(data), np.int64)
        span[place] = np.diff(np.append(place, len(data)))
        start = np.concatenate([at for at, _, _ in found])
        length = np.repeat([n for _, n, _ in found], [len(at) for at, _, _ in found])
        alone = np.zeros(len(data), bool)
        alone[start[length == span[start]]] = True
        bare = place[~alone[place]]
        # Edges by place, those of a place by length, byte pieces last.
        start = np.concatenate([start, bare])
        length = np.concatenate([length, span[bare]])
        ident = np.concatenate([*[ids for _, _, ids in found], np.full(len(bare), -1)])
        order = np.argsort(_short(start), kind="stable")
        start, length, ident = start[order], length[order], ident[order]
        counts = np.bincount(start, minlength=len(data))
        behind = np.cumsum(counts)
        counts, first = counts[place], (behind - counts)[place]
        weight = np.where(ident >= 0, self.weight[ident], self.fallback)
        # Backward sums, the places nearest to the end of their word first; a word's end sums to 0.
        goal = start + length
        final = goal == stop[start]
        beta = np.zeros(len(data) + 1)
        onto = np.where(final, len(data), goal)
        far = _short(stop[place] - place)
        order, by_place = (np.argsort(x, kind="stable") for x in (np.repeat(far, counts), far))
        sums, nodes = np.cumsum(np.append(0, counts[by_place])), place[by_place]
        steps = np.flatnonzero(np.append(True, np.diff(far[by_place]) != 0))
        near, near_onto = weight[order], onto[order]
        for a, b in zip(steps.tolist(), [*steps[1:].tolist(), len(nodes)]):
            lo, hi = sums[a], sums[b]
            beta[nodes[a:b]] = np.logaddexp.reduceat(near[lo:hi] + beta[near_onto[lo:hi]],
                                                     sums[a:b] - lo)
        value = weight + beta[onto] - beta[start]
        # The likeliest edge of a place comes first.
        order = np.arange(len(value))
        two = first[counts == 2]
        two = two[value[two] < value[two + 1]]
        order[two], order[two + 1] = two + 1, two
        for k in np.flatnonzero(np.bincount(counts)).tolist():
            if k > 2:
                own = first[counts == k][:, None] + np.arange(k)
                order[own] = own[:, :1] + np.argsort(-value[own], axis=1, kind="stable")
        goal, length, ident, value, final = (x[order] for x in (goal, length, ident, value, final))
        p = np.exp(value)
        rest = np.repeat(np.add.reduceat(p, first), counts) - p
        # The others of the first edge are summed without it, for precision.
        tail = p.copy()
        tail[first] = 0
        rest[first] = np.add.reduceat(tail, first)
        upto, at, left = p.copy(), first, counts
        while len(at := at[left > 1]):
            left = left[left > 1] - 1
            at = at + 1
            upto[at] += upto[at - 1]
        upto[first + counts - 1] = 2.0  # the last edge takes what rounding leaves
        edge_of = np.zeros(len(data) + 1, np.int64)
        edge_of[place] = first
        begin = ends - sizes
        per_word = np.add.reduceat(counts, np.searchsorted(place, begin))
        flat = np.empty((len(value), WIDTH))
        flat[:, 0] = start - np.repeat(begin, per_word)
        flat[:, 6] = np.where(final, -1, edge_of[goal]
                              - np.repeat(np.cumsum(per_word) - per_word, per_word))
        for i, column in enumerate((length, ident, value, rest, upto), 1):
            flat[:, i] = column
        return flat.ravel(), per_word * WIDTH

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Normalized bytes with a space before each text, where texts and where words start."""
        texts = [(" " + t.replace("▁", " ")).encode() if t else b"" for t in column.to_pylist()]
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([0, *map(len, texts)])
        if not len(data):
            return data, ends, np.empty(0, np.int64)
        space = data == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        line = np.flatnonzero(data == 10)  # no piece holds a line feed
        first[line] = True
        after = line[line + 1 < len(data)] + 1
        first[after] = True
        first[ends[:-1][ends[:-1] < len(data)]] = True
        return data, ends, np.flatnonzero(first)


class Sampler:
    """Gumbel top-k without replacement over the lattices of many texts at once.

    A text's segmentations are the leaves of a tree of choices. The largest of their perturbed
    log-probabilities is drawn first and its leaf by descending the tree; beside each choice on the
    way lies a region, the leaves that differ there first. The largest value of a region is a
    Gumbel variable of its mass below the value above it. A-star: the region with the largest
    value is taken next, its leaf found by descending from there, which leaves new regions. The
    value of the best region left over is the threshold for inclusion.
    """

    def __init__(self, path: str, alpha: float, seed: int):
        self.lattice = Lattice(path, alpha)
        self.seed = np.uint64(seed)
        size = np.fromiter(map(len, self.lattice.text), np.int64)
        self.text_size, self.text_at = size, np.cumsum(size) - size
        self.text_pool = np.frombuffer(b"".join(self.lattice.text), np.uint8)

    def _descend(self, key, first_edge, word, place, edge, sample):
        """Choices to the end of each word, from the place whose first edge is given on.

        Returns arrays of (word, place, edge, log p, mass of the place's other edges), by word and
        place. ``key`` and ``first_edge`` (of the word) are given for each of the words.
        """
        pool = self.lattice.edges.pool.reshape(-1, WIDTH)
        upto, lead = pool[:, 5], pool[:, 6]
        at = np.arange(len(word))
        out = []
        while len(at):
            # The last edge of a place, which has 2 there, needs no draw.
            limit = upto[edge]
            active = np.flatnonzero(limit < 2)
            u = uniform(key[at[active]], place[active], sample)
            above = np.flatnonzero(u > limit[active])
            active, u = active[above], u[above]
            while len(active):
                edge[active] += 1
                above = np.flatnonzero(u > upto[edge[active]])
                active, u = active[above], u[above]
            out.append((at, place, edge))
            ahead = lead[edge]
            on = np.flatnonzero(ahead >= 0)
            place = place[on] + pool[edge[on], 1].astype(np.int64)
            edge, at = first_edge[at[on]] + ahead[on].astype(np.int64), at[on]
        if not out:
            return (np.empty(0, np.int64),) * 3 + (np.empty(0),) * 2
        at, place, edge = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(at, kind="stable")
        at, place, edge = at[order], place[order], edge[order]
        return word[at], place, edge, pool[edge, 3], pool[edge, 4]

    @staticmethod
    def _bounds(mass, before, bound, u):
        """Largest values of regions of the given mass beside choices, below ``bound``."""
        with np.errstate(divide="ignore"):
            phi = before + np.log(np.maximum(mass, 0.0))
        return -np.logaddexp(-bound, np.log(-np.log(u)) - phi)

    def sample(self, column: pa.Array, keys: np.ndarray, k: int) -> list[list[tuple]]:
        """Per text up to k of ``(edges, log p, perturbed, inclusion)`` by falling perturbed value."""
        return self.sample_words(*self.lattice.words(column), keys, k)

    def sample_words(self, data: np.ndarray, ends: np.ndarray, starts: np.ndarray, keys: np.ndarray,
                     k: int) -> list[list[tuple]]:
        """As ``sample``, of texts that are cut into words (see ``Lattice.words``)."""
        n = len(ends) - 1
        if not len(data):
            return [[(np.empty(0, np.int64), 0.0, 0.0, 1.0)] for _ in range(n)]
        with np.errstate(over="ignore"):
            keys = _mixed(keys.astype(np.int64).view(np.uint64) * _ODD + self.seed)
        table = self.lattice.edges
        row = table.look_up(data, starts)
        pool = table.pool.reshape(-1, WIDTH)
        first_word = np.searchsorted(starts, ends)
        doc = np.repeat(np.arange(n), np.diff(first_word))
        first_edge = table.place[row] // WIDTH
        last_edge = first_edge + table.size[row] // WIDTH
        words = np.arange(len(starts))
        # Every word draws from its own stream: the text's key and the word's number in it.
        with np.errstate(over="ignore"):
            own_key = _mixed(keys[doc] * _ODD + (words - first_word[doc]).astype(np.uint64))
        top = -np.log(-np.log(uniform(keys, 7, 7)))
        tail = self._descend(own_key, first_edge, words, np.zeros(len(words), np.int64),
                             first_edge.copy(), 0)
        paths: list[list[tuple]] = [[] for _ in range(n)]
        extra: list[list[tuple]] = [[] for _ in range(n)]
        chosen: list[list[tuple]] = [[] for _ in range(n)]
        none = np.empty(0, np.int64)
        branch = {d: ((none, none, none), np.empty(0), None, float(top[d])) for d in range(n)}
        threshold = np.full(n, -np.inf)
        for sample in range(k + 1):
            # Append to each text's new path what was found behind its branch.
            cut = np.searchsorted(doc[tail[0]], np.arange(n + 1))
            logs, before = np.empty(len(tail[0])), np.empty(len(tail[0]))
            ceiling = np.zeros(n)
            for d, (_, total, edge, bound) in branch.items():
                own = slice(cut[d], cut[d + 1])
                base = edge[3] if edge is not None else 0.0
                np.add(base, np.cumsum(tail[3][own]), out=logs[own])
                ceiling[d] = bound
            np.subtract(logs, tail[3], out=before)
            # Where a place has one edge there is no region beside it.
            some = np.flatnonzero(tail[4])
            above = np.full(len(logs), -np.inf)
            above[some] = self._bounds(
                tail[4][some], before[some], np.repeat(ceiling, np.diff(cut))[some],
                uniform(own_key[tail[0][some]], tail[1][some], 1000 + sample))
            for d, (head, total, edge, bound) in branch.items():
                own = tuple(x[cut[d]:cut[d + 1]] for x in tail[:3])
                if edge is not None:
                    head = tuple(np.append(h, x) for h, x in zip(head, edge[:3]))
                    total = np.append(total, edge[3])
                path = tuple(np.concatenate(x) for x in zip(head, own))
                total = np.concatenate([total, logs[cut[d]:cut[d + 1]]])
                paths[d].append((path, total, np.concatenate(
                    [np.full(len(head[0]), -np.inf), above[cut[d]:cut[d + 1]]])))
                chosen[d].append((path[2], float(total[-1]) if len(total) else 0.0, bound))
            # The best region of each text, and the branch that its leaf takes.
            resume_word, resume_place, resume_edge, later = [], [], [], []
            last, branch = branch, {}
            for d in last:
                best, where = -np.inf, None
                for p, (_, _, v) in enumerate(paths[d]):
                    if len(v) and v[i := int(v.argmax())] > best:
                        best, where = float(v[i]), (p, i, None)
                for x, region in enumerate(extra[d]):
                    if region[0] > best:
                        best, where = region[0], (region[1], region[2], x)
                threshold[d] = best
                if where is None or sample == k - 1:
                    continue
                p, i, x = where
                path, total, v = paths[d][p]
                word, place = int(path[0][i]), int(path[1][i])
                if x is None:
                    v[i], barred = -np.inf, [int(path[2][i])]
                else:
                    barred = extra[d].pop(x)[3]
                lo = hi = int(path[2][i])
                while lo > first_edge[word] and pool[lo - 1, 0] == place:
                    lo -= 1
                while hi < last_edge[word] and pool[hi, 0] == place:
                    hi += 1
                options = np.array([e for e in range(lo, hi) if e not in barred])
                share = np.exp(pool[options, 3])
                draw = uniform(own_key[word:word + 1], place, np.array([2000, 3000]) + sample)
                pick = min(int(np.searchsorted(np.cumsum(share), draw[0] * share.sum())),
                           len(options) - 1)
                edge, rest = int(options[pick]), float(np.delete(share, pick).sum())
                before = float(total[i - 1]) if i else 0.0
                if rest > 0:
                    extra[d].append((float(self._bounds(rest, before, best, draw[1])), p, i,
                                     [*barred, edge]))
                branch[d] = (tuple(c[:i] for c in path), total[:i],
                             (word, place, edge, before + float(pool[edge, 3])), best)
                if pool[edge, 6] >= 0:
                    resume_word.append(word)
                    resume_place.append(place + int(pool[edge, 1]))
                    resume_edge.append(int(first_edge[word] + pool[edge, 6]))
                later.append(np.arange(word + 1, first_word[d + 1]))
            if not branch:
                break
            whole = np.concatenate(later)
            word = np.concatenate([np.array(resume_word, np.int64), whole])
            place = np.concatenate([np.array(resume_place, np.int64), np.zeros(len(whole), int)])
            edge = np.concatenate([np.array(resume_edge, np.int64), first_edge[whole]])
            order = np.argsort(word, kind="stable")
            word, place, edge = word[order], place[order], edge[order]
            tail = self._descend(own_key[word], first_edge[word], word, place, edge, sample + 1)
        out = []
        for d in range(n):
            found = []
            for edges, logp, value in chosen[d]:
                above = np.exp(min(logp - threshold[d], 50.0)) if threshold[d] > -np.inf else np.inf
                found.append((edges, logp, value, float(-np.expm1(-above))))
            out.append(found)
        return out

    def ids(self, edges: np.ndarray, data: np.ndarray, begin: int) -> np.ndarray:
        """Piece ids of a path whose text starts at ``begin``; byte pieces where there is none."""
        pool = self.lattice.edges.pool.reshape(-1, WIDTH)
        ident = pool[edges, 2].astype(np.int64)
        if (ident >= 0).all():
            return ident
        length = pool[edges, 1].astype(np.int64)
        sizes = np.where(ident < 0, length, 1)
        out = np.repeat(ident, sizes)
        at = begin + np.repeat(np.cumsum(length) - length, sizes)
        at += np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        spelled = out < 0
        out[spelled] = self.lattice.byte_ids[data[at[spelled]]]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of piece ids, without the space that encoding puts before it."""
        size = self.text_size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        raw = self.text_pool[np.arange(ends[-1]) + np.repeat(self.text_at[ids] - (ends - size), size)]
        return raw.tobytes().removeprefix(b" ")


@lru_cache(maxsize=2)
def sampler_of(path: str, alpha: float, seed: int) -> Sampler:
    """One instance for each worker."""
    return Sampler(path, alpha, seed)


def _sampled(docs: DataFrame, model: str, k: int, alpha: float, seed: int, whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = sampler_of(model, alpha, seed)
        for batch in batches:
            for part in slices([batch], "text", 1 << 18):
                keys = part.column("key").to_numpy()
                docs_of, found = part.column("doc_id").to_pylist(), []
                data, ends, starts = sampler.lattice.words(part.column("text"))
                for i, own in enumerate(sampler.sample_words(data, ends, starts, keys, k)):
                    raw = data[ends[i]:ends[i + 1]].tobytes().removeprefix(b" ")
                    for rank, (edges, logp, value, inclusion) in enumerate(own):
                        ids = sampler.ids(edges, data, int(ends[i]))
                        found.append((docs_of[i], rank, len(ids), logp, value, inclusion,
                                      sampler.decode(ids) == raw, ids if whole else
                                      zlib.crc32(ids.astype("<u4").tobytes())))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(),
                         pa.float64(), pa.bool_(), pa.list_(pa.int32()) if whole else pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(zip(*found), kinds)],
                    ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion",
                     "round_trip", "ids"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty("text").alias("text"))
    docs = spread(docs).withColumn("key", F.xxhash64("doc_id"))
    kind = "array<int>" if whole else "long"
    return docs.mapInArrow(run, "doc_id long, sample int, n_pieces long, log_prob double, "
                                f"perturbed double, inclusion double, round_trip boolean, ids {kind}")


def sample_segmentations(docs: DataFrame, model: str, k: int = SAMPLES, alpha: float = ALPHA,
                         seed: int = SEED) -> DataFrame:
    """Up to k distinct segmentations of each whole text of ``docs`` (doc_id, text), sampled
    without replacement.

    Returns ``(doc_id, sample, n_pieces, log_prob, perturbed, inclusion, round_trip, ids)``, samples
    numbered by falling perturbed log-probability. A segmentation's probability is the product of
    its pieces' weights ``exp(alpha * score)``, over all segmentations of the text. ``inclusion`` is
    the probability of a value above the first one left out, 1 when nothing is left out; round_trip
    says whether decoding gives the text. Texts with fewer than k segmentations give them all; an
    empty or null text gives one without pieces. Draws depend on doc_id and seed only, so rows with
    equal doc_id and text, null ids included, get the same ones, however tasks are cut. An empty
    table gives an empty result; other columns are ignored.
    """
    return _sampled(docs, model, k, alpha, seed, True)


def segmentation_digests(docs: DataFrame, model: str, k: int = SAMPLES, alpha: float = ALPHA,
                         seed: int = SEED) -> DataFrame:
    """As ``sample_segmentations``, with the CRC-32 of the ids (32-bit, little-endian) for them."""
    return _sampled(docs, model, k, alpha, seed, False).withColumnRenamed("ids", "ids_crc32")


def decode_pieces(rows: DataFrame, model: str) -> DataFrame:
    """``(doc_id, text)`` of rows (doc_id, ids); null ids give a null text, invalid UTF-8 from byte
    pieces the replacement character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = sampler_of(model, ALPHA, SEED)
        for batch in batches:
            texts = [None if x is None else sampler.decode(np.array(x, np.int64)).decode(
                "utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string")
