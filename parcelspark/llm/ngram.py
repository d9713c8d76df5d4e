"""Similarity join on word shingles: prefix index, then prefix-tree verification."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import components, slices, spread, text_or_empty
from parcelspark.llm.exact import bloom_filter, mark_possible
from parcelspark.session import stage

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Counters of the sketch that tells heavy shingles, and how many times the mean count is heavy.
SKETCH, HEAVY = 1 << 21, 16
SEGMENT = 1 << 14
#: Bytes of text whose shingles are made at once, in arrays of eight bytes for each of them.
SLICE = 1 << 19
#: Share of the shingles, by hash, whose frequency is counted exactly; a prefix is a quarter of a set
#: at 75 percent. The order decides how many candidates there are, never which links are found.
COUNTED = 0.34
#: Identities of sets that a worker remembers, so that copies near each other are read once.
REMEMBERED = 1 << 18
#: Shingles in one block of the prefix-tree join (8 bytes each).
BLOCK = 1 << 20
#: Members of a run whose pairs are listed; larger runs are compared by blocks of at most MEMBERS sets.
PAIRED, MEMBERS = 48, 4096
SALTS = 64
#: Rounds of neighbour pairs before what is left is compared in full.
ROUNDS = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mixed(np.arange(1, 257, dtype=np.uint64)[_LOWER.astype(int)])
_VALUE[_BLANK] = 0


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each one starts and the last one ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    data, ends = _text_bytes(column)
    if not len(data):
        return [np.empty(0, np.uint64)] * len(column)
    solid = ~_BLANK[data]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(solid & ~before)
    if not len(starts):
        return [np.empty(0, np.uint64)] * len(column)
    # A word's hash: its bytes' values times powers of an odd number; blanks count nothing.
    data, ends, starts = data[starts[0]:], np.maximum(ends - starts[0], 0), starts - starts[0]
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    with np.errstate(over="ignore"):
        powers = np.full(int(place.max()) + 1, _ODD)
        powers[0] = 1
        powers = np.cumprod(powers)
        value = mixed(np.add.reduceat(_VALUE[data] * powers[place], starts))
        first = np.searchsorted(starts, ends)
        rolled = np.zeros(max(len(value) - words + 1, 0), np.uint64)
        factor = np.uint64(1)
        for i in range(words):
            rolled += value[i:i + len(rolled)] * factor
            factor *= _ODD
        rolled = mixed(rolled)
        out = []
        for lo, hi in zip(first[:-1], first[1:]):
            if hi - lo >= words:
                own = np.sort(rolled[lo:hi - words + 1])
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                out.append(own[keep])
            elif hi > lo:
                whole = np.uint64(hi - lo)
                for v in value[lo:hi]:
                    whole = whole * _ODD + v
                out.append(mixed(np.array([whole], np.uint64)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def _signature(own: np.ndarray) -> int:
    """Identity of a set: a 64-bit hash of all its shingles."""
    with np.errstate(over="ignore"):
        total = mixed(own * _ODD + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(own))
    return int(mixed(np.array([total]))[0].astype(np.int64))


def _packed(counts: np.ndarray) -> bytes:
    """Counters in as few bytes each as the largest needs, deflated: most are small, so a task's part
    of the sketch takes a sixth of its plain size."""
    kind = np.min_scalar_type(counts.max())
    return bytes([kind.itemsize]) + zlib.compress(counts.astype(kind.newbyteorder("<")).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[1:]), f"<u{raw[0]}")


def _described(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row per text, then the task's part of the sketch."""
    counts, waiting, held = np.zeros(SKETCH, np.uint32), [], 0

    def settle():
        counts[:] += np.bincount(np.concatenate(waiting) & np.uint64(SKETCH - 1),
                                 minlength=SKETCH).astype(np.uint32)

    def rows(ids, n, sig, segment, part):
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()),
            "sig": pa.array(sig, pa.int64()), "segment": pa.array(segment, pa.int32()),
            "counts": pa.array(part, pa.binary())})

    for batch in batches:
        for piece in slices([batch], "text", SLICE):
            sets = shingle_sets(piece.column("text"), words)
            waiting.extend(s for s in sets if len(s))
            held += sum(map(len, sets))
            if held > 1 << 19:
                settle()
                waiting, held = [], 0
            none = [None] * len(sets)
            yield rows(piece.column("doc_id"), [len(s) for s in sets],
                       [_signature(s) for s in sets], none, none)
    if held:
        settle()
    for k in range(0, SKETCH, SEGMENT):
        part = counts[k:k + SEGMENT]
        if part.any():
            yield rows([None], [None], [None], [k // SEGMENT], [_packed(part)])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = _unpacked(part)
            total[k] = total[k] + part if k in total else part.astype(np.uint64)
    yield pa.RecordBatch.from_pydict({
        "segment": pa.array(list(total), pa.int32()),
        "counts": pa.array([np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes()
                            for x in total.values()], pa.binary())})


def _weights(described: DataFrame) -> np.ndarray:
    """Frequency class of each counter: 0 below three times the mean, then one for each doubling.

    The sketch has a fixed number of counters, so what reaches the driver doesn't grow.
    """
    parts = described.filter("segment IS NOT NULL").select("segment", "counts")
    merged = parts.repartition("segment").mapInArrow(_summed, "segment int, counts binary")
    counts = np.zeros(SKETCH, np.uint32)
    for k, part in merged.collect():
        counts[k * SEGMENT:(k + 1) * SEGMENT] = np.frombuffer(bytes(part), np.uint32)
    ratio = counts // max(1, int(counts.mean()))
    return np.where(ratio < HEAVY, 0, np.log2(np.maximum(ratio, 1)).astype(int)).clip(0, 31).astype(
        np.uint8)


def _candidate_rows(docs: DataFrame, weights: np.ndarray, words: int, percent: int) -> DataFrame:
    """``(token, salt, sig, n, slack)``: shingles that may stand in the prefix of a set.

    The global order has the counted shingles first, from rare to frequent, then the others, then heavy
    ones by class. All counted shingles of a set are rows, and of the others those that the prefix
    reaches behind them; ``slack`` is how many rows the set has beyond the length of its prefix.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    limit = np.uint64(int(COUNTED * (1 << 20)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, known = shared.value, set()
        for batch in batches:
            for piece in slices([batch], "text", SLICE):
                tokens, salts, sigs, sizes, slacks = [], [], [], [], []
                for own in shingle_sets(piece.column("text"), words):
                    n, sig = len(own), _signature(own)
                    if not n or sig in known:
                        continue
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known.add(sig)
                    cls = weight[own & np.uint64(SKETCH - 1)]
                    counted = (cls == 0) & (own >> np.uint64(44) < limit)
                    length = n + (-n * percent // 100) + 1
                    take = np.flatnonzero(counted)
                    if len(take) < length:
                        rest = np.flatnonzero(~counted)
                        key = (own[rest] >> np.uint64(5)) | (cls[rest].astype(np.uint64)
                                                             << np.uint64(59))
                        rest = rest[np.argsort(key, kind="stable")[:length - len(take)]]
                        take = np.concatenate([take, rest])
                    tokens.append(own[take])
                    salts.append(np.where(cls[take] > 0, 1 + sig % SALTS, 0))
                    sigs.append(np.full(len(take), sig))
                    sizes.append(np.full(len(take), n))
                    slacks.append(np.full(len(take), len(take) - length))
                if tokens:
                    yield pa.RecordBatch.from_pydict({
                        "token": np.concatenate(tokens).view(np.int64),
                        "salt": np.concatenate(salts).astype(np.int32),
                        "sig": np.concatenate(sigs).astype(np.int64),
                        "n": np.concatenate(sizes).astype(np.int32),
                        "slack": np.concatenate(slacks).astype(np.int32)})

    return docs.mapInArrow(emit, "token long, salt int, sig long, n int, slack int")


def _prefix_rows(docs: DataFrame, weights: np.ndarray, words: int, percent: int) -> DataFrame:
    """``(token, salt, sig, n, lone)``: the shingles of each set's prefix that other sets have there too.

    Two sets that link share a shingle among the first ``n - ceil(n * percent / 100) + 1`` of both.
    Shingles of one set only come first and find nothing: they go where they are counted, and a set
    whose prefix is made of them has no rows left. Of the others the most frequent go until the rest
    is the prefix. Heavy shingles that still stand in a prefix are salted. ``lone`` is the share, in
    thousandths, of a set's counted shingles that no other set has: the text that copies were made from
    has the least.
    """
    rows = _candidate_rows(docs, weights, words, percent)
    token = Window.partitionBy("token", "salt")
    found = rows.withColumns({"df": F.count(F.lit(1)).over(token), "lo": F.min("sig").over(token),
                              "hi": F.max("sig").over(token)})
    # Copies of a set in other tasks gave the same rows; they lie together. Staged, so that the files of
    # the first shuffle, the largest by far, are gone before the next ones are written.
    several = stage(found.filter("lo <> hi OR salt > 0").groupBy("token", "salt", "sig", "n", "slack")
                    .agg(F.max("df").alias("df")), "several")
    own = Window.partitionBy("sig")
    ranked = several.withColumns({
        "rank": F.row_number().over(own.orderBy("salt", "df", "token")),
        "rows": F.count(F.lit(1)).over(own)})
    emitted = F.expr(f"n - ceil(n * {percent} / 100.0D) + 1 + slack")
    return ranked.filter(F.col("rank") <= F.col("rows") - F.col("slack")).select(
        "token", "salt", "sig", F.col("n").cast("long").alias("n"),
        (1000 * (emitted - F.col("rows")) / emitted).cast("int").alias("lone"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal token and salt, from rows sorted by token and salt.

    A run is known by a hash of its members, since the shingles of a passage or a group of copies
    have the same ones; each task gives a run once, and at its end how many tokens had it. The
    first member is the head. Runs of one member go, but those of salted tokens stay and name their
    token in a row without a member.
    """
    names = ["run", "head", "m", "member", "n", "token", "weight"]
    kept, known = None, {}

    def complete(token, salt, member, n, starts, stops):
        with np.errstate(over="ignore"):
            spread_out = mixed(member.view(np.uint64))
            run = mixed(np.add.reduceat(spread_out, starts)[:len(stops)]
                        + (stops - starts).astype(np.uint64)).view(np.int64)
        heavy = salt[starts] > 0
        worth = np.flatnonzero(heavy | (stops - starts > 1))
        ids, at, counts = np.unique(run[worth], return_index=True, return_counts=True)
        pick = np.zeros(len(run), bool)
        pick[worth[at]] = [h not in known for h in ids.tolist()]
        for h, c in zip(ids.tolist(), counts.tolist()):
            known[h] = known.get(h, 0) + c
        rows = np.repeat(pick, stops - starts)
        sizes = (stops - starts)[pick]
        heads = starts[pick]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(run[pick], sizes)), pa.array(np.repeat(member[heads], sizes)),
             pa.array(np.repeat(n[heads], sizes)), pa.array(member[:stops[-1]][rows]),
             pa.array(n[:stops[-1]][rows]), pa.nulls(int(rows.sum()), pa.int64()),
             pa.nulls(int(rows.sum()), pa.int64())], names)
        at = starts[heavy]
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(run[heavy]), pa.array(member[at]), pa.array(n[at]), none, none,
             pa.array(token[at]), none], names)

    def ordered(last: bool):
        token, salt, member, n = (kept.column(c).to_numpy() for c in range(4))
        first = np.flatnonzero(np.append(True, (token[1:] != token[:-1])
                                         | (salt[1:] != salt[:-1])))
        stops = np.append(first[1:], len(token)) if last else first[1:]
        if len(stops):
            yield from complete(token, salt, member, n, first[:len(stops)], stops)
        return first[-1]

    for batch in batches:
        if not batch.num_rows:
            continue
        kept = pa.Table.from_batches([batch] if kept is None else [*kept.to_batches(), batch])
        kept = kept.slice((yield from ordered(False)))
    if kept is not None and len(kept):
        yield from ordered(True)
    ids, none = list(known), pa.nulls(len(known), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), none, none, none, none, none,
         pa.array(list(known.values()), pa.int64())], names)


_RUN_SCHEMA = "run long, head long, m long, member long, n long, token long, weight long"


def _gathered(rows: DataFrame) -> DataFrame:
    """Runs of ``rows`` (token, salt, member, n, lone); the head is the member that is least alone.

    In a group of near copies that is the text they come from, which is nearer to each of them than
    they are to each other.
    """
    order = ["token", "salt", "lone", "member"]
    return (rows.repartition("token", "salt").sortWithinPartitions(*order)
            .select("token", "salt", "member", "n").mapInArrow(_runs, _RUN_SCHEMA))


def _overlaps(query: np.ndarray, members: list[np.ndarray], percent: int) -> np.ndarray:
    """Which member sets link with the query set.

    The members, sorted as sequences, are the paths of a prefix tree in depth-first order. A path
    starts where it leaves the one before: the overlap of the shared part is taken over. It is left
    as soon as the elements that remain on either side can't reach the overlap that is needed, and
    paths that share the failing part fail there without being read.
    """
    order = sorted(range(len(members)), key=lambda i: members[i].astype(">u8").tobytes())
    linked = np.zeros(len(members), bool)
    last, hits, reach = np.empty(0, np.uint64), np.zeros(1, np.int64), 0
    for i in order:
        own = members[i]
        both = len(own) + len(query)
        needed = -(-percent * both // (100 + percent))
        short = min(len(own), reach)
        differs = np.flatnonzero(own[:short] != last[:short])
        depth = int(differs[0]) if len(differs) else short
        count = np.empty(len(own) + 1, np.int64)
        count[:depth + 1] = hits[:depth + 1]
        while True:
            passed = np.searchsorted(query, own[depth - 1], "right") if depth else 0
            if count[depth] + min(len(own) - depth, len(query) - passed) < needed:
                break
            if depth == len(own):
                linked[i] = count[depth] >= needed
                break
            step = own[depth:depth + 256]
            at = np.searchsorted(query, step)
            found = query[np.minimum(at, len(query) - 1)] == step
            count[depth + 1:depth + len(step) + 1] = count[depth] + np.cumsum(found)
            depth += len(step)
        last, hits, reach = own, count, depth
    return linked


def _sets(docs: DataFrame, narrow: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(sig, own)`` of the ``wanted`` set identities, cut from their texts again.

    A Bloom filter of bounded size leaves out the other rows before the shuffle.
    """
    first = narrow.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    ids = stage(wanted.distinct().join(first, "sig").select(
        "sig", F.xxhash64("doc_id").alias("h")), "candidates")
    bits, segments = bloom_filter(ids, "h", ids.count())
    marked = mark_possible(docs.withColumn("h", F.xxhash64("doc_id")), "h", bits, segments)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set()
        for batch in batches:
            for piece in slices([batch], "text", SLICE):
                found = {}
                if len(known) >= REMEMBERED:
                    known.clear()
                for own in shingle_sets(piece.column("text"), words):
                    if len(own) and (sig := _signature(own)) not in known:
                        known.add(sig)
                        found[sig] = own.tobytes()
                yield pa.RecordBatch.from_pydict({
                    "sig": pa.array(list(found), pa.int64()),
                    "own": pa.array(list(found.values()), pa.binary())})

    return marked.filter("maybe").select("text").mapInArrow(cut, "sig long, own binary")


def _joining(left: list[np.ndarray], right: list[np.ndarray], known: np.ndarray,
             percent: int) -> list[tuple[int, int]]:
    """Links ``(i, j)`` of left and right sets that join what isn't joined, as few as needed.

    ``known`` has the components of the left sets, then of the right ones; sets of one component aren't
    compared. Overlaps of all pairs are counted as a product, over the shingles that both sides have.
    """
    sizes = [np.fromiter(map(len, side), np.int64, len(side)) for side in (left, right)]
    tokens = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    shared = np.intersect1d(*tokens)
    places = [np.searchsorted(shared, t) for t in tokens]
    count = np.zeros((len(left), len(right)), np.float32)
    hits = []
    for t, at, owner in zip(tokens, places, owners):
        real = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == t) if len(shared) else at[:0]
        order = real[np.argsort(at[real], kind="stable")]
        hits.append((at[order], owner[order]))
    for lo in range(0, len(shared), 1024):
        planes = []
        for (at, owner), n in zip(hits, sizes):
            a, b = np.searchsorted(at, [lo, lo + 1024])
            plane = np.zeros((len(n), min(1024, len(shared) - lo)), np.float32)
            plane[owner[a:b], at[a:b] - lo] = 1
            planes.append(plane)
        for at in range(0, len(left), 256):
            count[at:at + 256] += planes[0][at:at + 256] @ planes[1].T
    part = np.unique(known, return_inverse=True)[1]
    root = list(range(int(part.max()) + 1))

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for lo in range(0, len(left), 256):
        hits = count[lo:lo + 256].astype(np.int64)
        both = sizes[0][lo:lo + 256, None] + sizes[1]
        linked = (100 + percent) * hits >= percent * both
        linked &= part[lo:lo + 256][:len(hits), None] != part[len(left):]
        for i, j in np.argwhere(linked).tolist():
            own, other = top(part[lo + i]), top(part[len(left) + j])
            if own != other:
                root[other] = own
                out.append((lo + i, j))
    return out


def _joined_in_full(docs: DataFrame, narrow: DataFrame, left: DataFrame, words: int,
                    percent: int) -> DataFrame:
    """Links ``(a, b)`` that join components inside the runs of ``left`` (run, sig, n, component).

    All members of a run that aren't joined yet are compared. A run is cut into blocks of bounded
    size, and each pair of blocks is a group of its own, so a run that holds a large group of texts is
    spread over many tasks; sets travel by block, and no pairs leave a task but the links it needs.
    """
    members = left.select("run", "sig", "n", "component").distinct()
    sizes = stage(members.groupBy("run").agg(F.greatest(
        F.ceil(F.sum("n") / BLOCK), F.ceil(F.count(F.lit(1)) / MEMBERS)).cast("int").alias("parts")),
        "parts")
    own = members.join(sizes, "run").withColumn("i", F.pmod(F.xxhash64("sig"), "parts").cast("int"))
    placed = stage(own.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "run", F.least("i", "k").alias("lo"), F.greatest("i", "k").alias("hi"), "i", "sig",
        "component"), "blocks")
    sets = _sets(docs, narrow, members.select("sig"), words)

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        # Rows that share a doc_id may give a set twice.
        frame = frame.drop_duplicates("sig").sort_values("sig")
        sides = [frame[frame["i"] == frame["lo"]], frame[frame["i"] == frame["hi"]]]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        known = np.concatenate([x["component"].to_numpy() for x in sides])
        found = _joining(*[[np.frombuffer(x, np.uint64) for x in side["own"]] for side in sides],
                         known, percent)
        return pd.DataFrame({"a": sides[0]["sig"].to_numpy()[[i for i, _ in found]],
                             "b": sides[1]["sig"].to_numpy()[[j for _, j in found]]}).astype("int64")

    return stage(placed.join(sets, "sig").groupBy("run", "lo", "hi")
                 .applyInPandas(join, "a long, b long").distinct(), "links")


def _verified(docs: DataFrame, narrow: DataFrame, pairs: DataFrame, words: int,
              percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of set identities whose sets link.

    Blocks hold one query set and BLOCK shingles of candidates.
    """
    parts = stage(pairs.groupBy("a").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts")),
                  "parts")
    sets = _sets(docs, narrow, pairs.select(F.explode(F.array("a", "b")).alias("sig")), words)
    block = F.pmod(F.xxhash64("b"), "parts").cast("int")
    wanted = stage(
        pairs.join(parts, "a").select("a", block.alias("part"), F.col("b").alias("sig"),
                                      F.lit(False).alias("query"))
        .union(parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "a",
                            F.lit(True))), "wanted")

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        queries, members = frame[frame["query"]], frame[~frame["query"]]
        if not len(queries) or not len(members):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        query = np.frombuffer(queries["own"].iloc[0], np.uint64)
        own = [np.frombuffer(x, np.uint64) for x in members["own"]]
        linked = _overlaps(query, own, percent)
        return pd.DataFrame({"a": members["a"][linked], "b": members["sig"][linked]})

    return stage(wanted.join(sets, "sig").groupBy("a", "part")
                 .applyInPandas(join, "a long, b long"), "links")


def ngram_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs`` (doc_id, text).

    A-Z become lower case; words are runs without ASCII white space. A row's set holds its distinct
    ``words``-word shingles, or the whole word sequence when it has fewer words. Two rows link when
    ``100 * intersection >= percent * union``. Null, empty and blank texts have no shingles and
    stand alone. component_id is the smallest doc_id reachable by links; rows with a null doc_id
    get null unless they link with another. Rows that share a doc_id are taken as rows of their
    own. An empty table gives an empty result; other columns are ignored.

    Equal sets are one node. Two nodes that link share a least number of prefix shingles, which
    their sizes tell. Nodes are first compared with the node of a shingle that is least alone and then,
    in rounds, with a neighbour; then every pair of nodes that share enough prefix shingles but still
    aren't in one component is compared, so no link between components is lost. Shingles and sets are known
    by 64-bit hashes.
    """
    docs = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              text_or_empty("text").alias("text")))
    described = stage(docs.mapInArrow(
        lambda b: _described(b, words),
        "doc_id long, n long, sig long, segment int, counts binary"), "shingles")
    narrow = described.filter("segment IS NULL").select("doc_id", "n", "sig")
    prefixes = _prefix_rows(docs, _weights(described), words, percent)
    raw = stage(_gathered(prefixes.withColumnRenamed("sig", "member")), "runs")
    runs = stage(raw.filter("member IS NOT NULL").select("run", "head", "m", "member", "n")
                 .distinct(), "runs")
    # Salted tokens once more: the runs of one token are the members of a run of runs.
    upper = stage(_gathered(raw.filter("token IS NOT NULL").select(
        "token", F.lit(0).alias("salt"), F.col("run").alias("member"), F.col("m").alias("n"),
        F.lit(0).alias("lone"))), "upper")
    groups = stage(upper.filter("member IS NOT NULL").select("run", "member").distinct(), "groups")
    weights = stage(raw.union(upper).filter("weight IS NOT NULL").groupBy("run")
                    .agg(F.sum("weight").alias("weight")), "weights")
    # Overlap that a link needs, and with it the least number of common prefix shingles.
    needed = f"ceil({percent} * (n + m) / {100 + percent}.0D)"
    near = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    enough = f"shared >= {needed} - ceil({percent} * greatest(n, m) / 100.0D) + 1 AND {near}"
    heads = stage(runs.filter("member = head").select(F.col("run").alias("member"), "head", "m"),
                  "heads")
    tops = stage(groups.join(heads, "member").groupBy("run").agg(
        F.min("head").alias("top"), F.min_by("m", "head").alias("t")), "tops")
    stars = runs.filter("member <> head").join(weights, "run").selectExpr(
        "head AS a", "m", "member AS b", "n", "weight").union(
        groups.join(heads, "member").join(tops, "run").join(weights, "run").filter("head <> top")
        .selectExpr("top AS a", "t AS m", "head AS b", "m AS n", "weight"))
    stars = stage(stars.groupBy("a", "m", "b", "n").agg(F.sum("weight").alias("shared"))
                  .filter(enough).select("a", "b", "n"), "stars")
    links = _verified(docs, narrow, stars, words, percent)
    tested = stars.select("a", "b")
    parts = stage(components(links, "a", "b"), "parts")
    rows = stage(runs.select("run", "member", "n").union(
        groups.join(runs.select(F.col("run").alias("member"), F.col("member").alias("sig"), "n"),
                    "member").select("run", "sig", "n").distinct()), "rows")

    def open_rows(parts: DataFrame) -> DataFrame:
        """Rows of the runs whose sets are in several components, with their components."""
        named = stage(rows.join(parts, F.col("member") == F.col("node"), "left").select(
            "run", F.col("member").alias("sig"), "n",
            F.coalesce("component", "member").alias("component")), "named")
        several = stage(named.groupBy("run").agg(F.min("component").alias("lo"),
                                                 F.max("component").alias("hi"),
                                                 F.count(F.lit(1)).alias("size"))
                        .filter("lo <> hi").select("run", "size").join(weights, "run"), "several")
        return stage(named.join(several, "run"), "open")

    # Members of a run in a hashed order, another one each round: neighbours of two components are
    # compared, one pair a member. Neighbours within a group of near copies are neighbours in all
    # runs that hold both, so groups become one component in a few rounds.
    for turn in range(ROUNDS):
        left = open_rows(parts)
        order = Window.partitionBy("run").orderBy(F.xxhash64(F.lit(turn), "sig"))
        ahead = F.lead(F.struct("sig", "n", "component")).over(order)
        pairs = left.withColumn("z", ahead).filter("component <> z.component").selectExpr(
            "least(sig, z.sig) AS a", "greatest(sig, z.sig) AS b", "weight",
            "if(sig < z.sig, z.n, n) AS n", "if(sig < z.sig, n, z.n) AS m")
        pairs = stage(pairs.groupBy("a", "m", "b", "n").agg(F.sum("weight").alias("shared"))
                      .filter(enough).select("a", "b", "n").join(tested, ["a", "b"], "left_anti"),
                      "neighbours")
        if pairs.isEmpty():
            break
        found = _verified(docs, narrow, pairs, words, percent)
        tested = tested.union(pairs.select("a", "b"))
        if found.isEmpty():
            break
        links = links.union(found)
        parts = stage(components(links, "a", "b"), "parts")

    # What is left is compared in full: large runs by blocks of their sets, then the pairs of two
    # components that share enough shingles of small runs. A pair that shares too few of those has
    # others in a large run, where it was compared.
    left = open_rows(parts).filter(F.col("size") > PAIRED)
    if not left.isEmpty():
        links = links.union(_joined_in_full(docs, narrow, left, words, percent))
        parts = stage(components(links, "a", "b"), "parts")
    left = open_rows(parts).filter(F.col("size") <= PAIRED)
    other = left.select("run", F.col("sig").alias("b"), F.col("n").alias("m"),
                        F.col("component").alias("other"))
    rest = stage(left.join(other, "run")
                 .filter(f"component <> other AND sig < b AND {near}")
                 .groupBy("sig", "n", "b", "m").agg(F.sum("weight").alias("shared"))
                 .filter(enough).select(F.col("sig").alias("a"), "b", F.col("m").alias("n"))
                 .join(tested, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.union(_verified(docs, narrow, rest, words, percent))
        parts = stage(components(links, "a", "b"), "parts")

    known = narrow.join(parts, F.col("sig") == F.col("node"), "left").select(
        "doc_id", "n", "sig", F.coalesce("component", "sig").alias("component"))
    known = stage(known, "known")
    lowest = stage(known.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("low")),
                   "lowest")
    return known.filter("n > 0").join(lowest, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("low").alias("component_id")).union(
        known.filter("n = 0").select("doc_id", "n", "doc_id"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest doc_id.

    Rows without shingles stay. doc_ids must be unique, as after exact deduplication; of rows that
    share a doc_id all stay or go together.
    """
    from parcelspark.llm.common import keep_rows

    kept = ngram_components(docs, words, percent).filter(
        F.col("doc_id").eqNullSafe(F.col("component_id")) | F.col("doc_id").isNull())
    return keep_rows(docs, kept.select("doc_id").distinct())
