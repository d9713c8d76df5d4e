"""Product codes of vectors: integer codebooks whose nearest entries a GNAT finds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import spread
from parcelspark.operators.skew import lookup_join
from parcelspark.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node, and entries that a leaf holds.
SPLITS, LEAF = 24, 16
#: Vectors that are searched together.
BLOCK = 8192


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``, in integers.

    As a product of floats where every figure on the way is an integer below 2 ** 53, and so exact.
    """
    if a.size and b.size:
        most = max(abs(int(a.min())), abs(int(a.max())), abs(int(b.min())), abs(int(b.max())))
        if 4 * most * most * a.shape[1] < 1 << 53:
            x, y = a.astype(np.float64), b.astype(np.float64)
            return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for x, y in zip(a.T, b.T):
        gap = x[:, None] - y
        out += gap * gap
    return out


def root_below(x: np.ndarray) -> np.ndarray:
    """An integer not above the root of ``x``; float rounding is allowed for by one."""
    return np.maximum(np.floor(np.sqrt(x.astype(np.float64))).astype(np.int64) - 1, 0)


def root_above(x: np.ndarray) -> np.ndarray:
    """An integer not below the root of ``x``."""
    return np.ceil(np.sqrt(x.astype(np.float64))).astype(np.int64) + 1


@dataclass
class Node:
    """Entries of a subtree: split points, and for each pair of a split point and a child the range
    of distances from the one to all entries of the other."""

    splits: np.ndarray
    children: list[Node] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


class Gnat:
    """Geometric near-neighbour access tree over the rows of ``entries``.

    :meth:`nearest` is exact: a subtree is left out only when the distance ranges prove that all its
    entries are farther than the best one found. Ranges are rounded outwards, a subtree that could
    hold an equally near entry is visited, and entries are compared by their squared distance in
    integers and then by index.
    """

    def __init__(self, entries: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        self.entries = np.asarray(entries, np.int64)
        self._splits, self._leaf = max(splits, 2), max(leaf, 1)
        self.visited = 0
        self.root = self._build(np.arange(len(self.entries)))

    def _build(self, own: np.ndarray) -> Node:
        if len(own) <= max(self._leaf, self._splits):
            return Node(own)
        # Split points far from each other: each is the entry farthest from those before it.
        between = squares(self.entries[own], self.entries[own])
        picked, reach = [0], between[0].copy()
        while len(picked) < self._splits:
            reach[picked] = -1
            picked.append(int(np.argmax(reach)))
            reach = np.minimum(reach, between[picked[-1]])
        rest = np.setdiff1d(np.arange(len(own)), picked)
        closest = np.argmin(between[np.ix_(rest, picked)], axis=1)
        groups = [rest[closest == j] for j in range(len(picked))]
        groups = [g for g in groups if len(g)]
        near = np.stack([root_below(between[np.ix_(picked, g)].min(axis=1)) for g in groups], 1)
        far = np.stack([root_above(between[np.ix_(picked, g)].max(axis=1)) for g in groups], 1)
        return Node(own[picked], [self._build(own[g]) for g in groups], near, far)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(index, squared distance)`` of the nearest entry of each point; ties: lowest index."""
        points = np.asarray(points, np.int64)
        index = np.full(len(points), len(self.entries))
        best = np.full(len(points), np.iinfo(np.int64).max)
        self._search(self.root, points, np.arange(len(points)), index, best)
        return index, best

    def _search(self, node: Node, points, rows, index, best) -> None:
        if not len(rows):
            return
        gaps = squares(points[rows], self.entries[node.splits])
        self.visited += gaps.size
        low = gaps.min(axis=1)
        first = np.where(gaps == low[:, None], node.splits, len(self.entries)).min(axis=1)
        better = (low < best[rows]) | ((low == best[rows]) & (first < index[rows]))
        index[rows[better]], best[rows[better]] = first[better], low[better]
        if not node.children:
            return
        below, above = root_below(gaps), root_above(gaps)
        # No entry of child j is nearer than this to the point.
        least = np.stack([np.maximum(below - node.far[:, j], node.near[:, j] - above).max(axis=1)
                          for j in range(len(node.children))], axis=1)
        order = np.argsort(least, axis=1, kind="stable")
        # Each point visits its most promising child first, so that later ones can be left out.
        for rank in range(len(node.children)):
            chosen = order[:, rank]
            open_ = least[np.arange(len(rows)), chosen] <= root_above(best[rows])
            for j in np.unique(chosen[open_]):
                self._search(node.children[j], points, rows[open_ & (chosen == j)], index, best)


def bounds(size: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where each part of a vector begins and ends; equal parts if ``size`` allows."""
    return [(p * size // parts, (p + 1) * size // parts) for p in range(parts)]


def largest_component(size: int) -> int:
    """Components are kept within this, so that the error of a vector fits a long."""
    return int((2.0 ** 60 / max(size, 1)) ** 0.5)


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)`` with ``v`` the components floor(scale * x) as longs.

    Left out are vectors that are null, empty or hold null or non-finite components, and those of
    another length than the vector of smallest vec_id.
    """
    x = F.col("e")
    fine = (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                                      & (F.abs(c) < float("inf")))
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e")
                          ).filter(x.isNotNull() & fine)
    first = kept.select(F.col("vec_id").alias("i"), F.size(x).alias("size"))
    size = first.orderBy(F.col("i").isNull(), "i", "size").limit(1).collect()
    size = size[0]["size"] if size else 0
    most = largest_component(size)
    whole = F.transform(x, lambda c: F.greatest(F.least(
        F.floor(c * scale).cast("double"), F.lit(float(most))), F.lit(float(-most))).cast("long"))
    if size:
        kept = kept.filter(F.size(x) == size)
    return kept.select("vec_id", "label", whole.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64, copy=False)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def _sums(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``(part, entry, n, s0, s1, ...)``: how many parts each entry got, and their sums."""
    parts = bounds(sum(b.shape[1] for b in books), len(books))
    width = max(hi - lo for lo, hi in parts)
    names = [f"s{i}" for i in range(width)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        total = [np.zeros((len(b), b.shape[1]), np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for block in _blocks(batches):
            v = _matrix(block.column("v"))
            for p, (lo, hi) in enumerate(parts):
                index, _ = trees[p].nearest(v[:, lo:hi])
                np.add.at(total[p], index, v[:, lo:hi])
                count[p] += np.bincount(index, minlength=len(count[p]))
        rows = []
        for p in range(len(books)):
            for k in np.flatnonzero(count[p]).tolist():
                own = total[p][k].tolist()
                rows.append((p, k, int(count[p][k]), *own, *[0] * (width - len(own))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(width + 3)],
            ["part", "entry", "n", *names])

    found = vectors.select("v").mapInArrow(assign, ", ".join(
        f"{c} long" for c in ["part", "entry", "n", *names]))
    return found.groupBy("part", "entry").agg(*[
        F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *names]])


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors of the smallest vec_ids; equal ids by their components."""
    rows = vectors.orderBy(F.col("vec_id").isNull(), "vec_id", "v").limit(entries).collect()
    if not rows:
        return []
    first = np.array([r["v"] for r in rows], np.int64)
    return [first[:, lo:hi] for lo, hi in bounds(first.shape[1], parts)]


def train_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks for ``(vec_id, v)``: one matrix of entries for each part.

    Each round assigns all parts to their nearest entries and replaces every used entry by the floor
    of the mean of its parts. What meets on the driver is the sums of ``parts * entries`` entries.
    """
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = [b.copy() for b in books]
        for row in _sums(vectors, books).collect():
            book = books[row["part"]]
            book[row["entry"]] = [int(row[f"s{i}"]) // int(row["n"]) for i in range(book.shape[1])]
    return books


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``(vec_id, label, codes, error)`` of ``(vec_id, label, v)``: the nearest entry of each part and
    the sum of the squared distances."""
    schema = f"vec_id long, label {vectors.schema['label'].dataType.simpleString()}, " \
             "codes array<int>, error long"
    if not books:
        return vectors.limit(0).select(
            F.col("vec_id").cast("long"), "label", F.lit(None).cast("array<int>").alias("codes"),
            F.lit(None).cast("long").alias("error"))
    parts = bounds(sum(b.shape[1] for b in books), len(books))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for block in _blocks(batches):
            v = _matrix(block.column("v"))
            found = [tree.nearest(v[:, lo:hi]) for tree, (lo, hi) in zip(trees, parts)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.int32)
            error = reduce(np.add, [gap for _, gap in found])
            offsets = np.arange(0, codes.size + 1, len(books), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("label"),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel())),
                 pa.array(error)], ["vec_id", "label", "codes", "error"])

    return vectors.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(assign, schema)


def decode(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """Add ``embedding``: the middle of what the entries of ``codes`` stand for, as doubles."""
    tables = [F.array(*[F.array(*[F.lit((int(x) + 0.5) / scale) for x in row]) for row in b])
              for b in books]
    parts = [F.get(t, F.col("codes")[p]) for p, t in enumerate(tables)]
    return codes.withColumn("embedding", F.flatten(F.array(*parts)))


def books_sha256(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for b in books for row in b.tolist() for x in row)
    return hashlib.sha256(text.encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks) of ``vectors`` (vec_id, embedding, label).

    ``codes`` is ``(vec_id, label, codes, error, label_error)``: the entry of each part, the squared
    error of the vector, and the sum of the errors of its label. Vectors that are null, empty or hold
    null or non-finite components are left out, and so are those of another length than the vector of
    smallest vec_id; components beyond :func:`largest_component` count as that. A length that
    ``parts`` doesn't divide gives parts that differ by one. Rows that share a vec_id count each;
    null ids sort last, null labels are one label. An empty table gives no codes and no codebooks;
    other columns are ignored.

    A task holds the codebooks, ``parts * entries`` short rows, and one block of vectors.
    """
    kept = stage(spread(whole_vectors(vectors)), "vectors")
    books = train_books(kept, parts, entries, rounds)
    codes = stage(encode(kept, books), "codes")
    # Decimal: the sum over a label may pass what a long holds on its way.
    sums = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    sums = stage(sums.select(F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_l"),
                             F.col("label").isNull().alias("_none"),
                             F.col("s").cast("long").alias("label_error")), "sums")
    named = codes.withColumns({"_l": F.coalesce(F.col("label").cast("string"), F.lit("")),
                               "_none": F.col("label").isNull()})
    return lookup_join(named, sums, ["_l", "_none"], "inner").drop("_l", "_none"), books


def code_digests(vectors: DataFrame) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of :func:`vector_codes`; ``code`` has
    two hex digits for each part."""
    codes, books = vector_codes(vectors)
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return codes.select("vec_id", F.concat_ws("", digits).alias("code"), "error", "label_error",
                        F.lit(books_sha256(books)).alias("codebooks_sha256"))
