"""Spelling variants, binary packing and vector codes against plain versions of their definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rows import ROWS
from parcelspark.llm.binary import batches, binary_sequences, decompose
from parcelspark.llm.codes import (Gnat, books_sha256, code_digests, decode, largest_component,
                                   root_above, root_below, vector_codes)
from parcelspark.llm.spelling import near_words, roots, spelling_variants, word_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


# Spelling variants

def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_near(counts):
    out = {}
    for w in counts:
        near = [v for v in counts if one_edit(w, v)]
        if near:
            top = min(near, key=lambda v: (-counts[v], v))
            out[w] = (len(near), top, counts[top])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_near_words_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("aabéÿ"[:3 + seed]) for _ in range(rng.randint(0, 6))): rng.randint(1, 9)
             for _ in range(250)}
    words.pop("", None)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in near_words(df).collect()}
    assert got == plain_near(words)


def test_spelling_variants(spark):
    rng = random.Random(4)
    base = ["harbour", "héritage", "mississippi", "colouring", "ÿard×÷stick", "bookkeeper", "x" * 90]
    words = [base[i % len(base)] for i in range(900)]
    for k, n in ((0, 60), (1, 30), (2, 25)):
        words += ["harbor", "heritage", "missisippi"][k:k + 1] * n
    words += ["harbors"] * 6 + ["harborss"] * 7 + ["harbo"] * 9
    words = [w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words]
    rng.shuffle(words)
    rows = [(i, f"{a}, {b}2{c}\n") for i, (a, b, c) in enumerate(zip(words[::3], words[1::3], words[2::3]))]
    rows += [(None, "harbour harbour"), (3, None), (4, ""), (4, "Ðİ中 harbour"), (5, "word " * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("n", "word", "prefix", "root", "met")})
    want = plain_counts(rows)
    near = plain_near(want)
    got = spelling_variants(df).collect()
    assert {r.word: r.n for r in got} == want
    form = {w: near[w][1] if w in near and near[w][2] >= 5 * n else None for w, n in want.items()}
    for r in got:
        root = r.word
        while form[root]:
            root = form[root]
        assert (r.form, r.root, r.n_near, r.form_n) == (
            form[r.word], root, near.get(r.word, (0,))[0], want[form[r.word]] if form[r.word] else None)
    assert sum(f is not None for f in form.values()) >= 2


def test_spelling_awkward_rows(docs, no_docs):
    rows = [(d, t) for d, t, *_ in ROWS]
    assert {r.word: r.n for r in word_counts(docs, 1).collect() if r.n >= 5} == plain_counts(rows)
    assert spelling_variants(no_docs).count() == 0


def test_roots_of_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("a", "b")],
                                  "word string, form string")
    assert {r.word: r.root for r in roots(forms).collect()} == {f"w{i}": "w9" for i in range(9)} | {"a": "b"}


# Binary packing

def test_decompose():
    totals = np.array([1, 1024, 1025, 3071, 7])
    doc, start, length = decompose(totals)
    for i, total in enumerate(totals):
        own = [(s, n) for d, s, n in zip(doc, start, length) if d == i]
        assert [s for s, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        assert sum(n for _, n in own) == total
        sizes = [n for _, n in own if n < 1024]
        assert sizes == sorted(set(sizes), reverse=True) and all(n & (n - 1) == 0 for n in sizes)


def test_binary_sequences(docs, no_docs):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(BPE)
    want = Counter()
    for doc, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        while at < len(ids):
            size = min(1024, 1 << ((len(ids) - at).bit_length() - 1))
            raw = np.array(ids[at:at + size], "<u4").tobytes()
            want[doc, at, size, len(ids), zlib.crc32(raw)] += 1
            at += size
    rows = binary_sequences(docs, BPE, 0).collect()
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, zlib.crc32(r.ids)) for r in rows) == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    slots = defaultdict(list)
    for r in rows:
        slots[r.length].append((r.slot, r.sequence_id))
    for own in slots.values():
        first = min(s for _, s in own)
        assert sorted(own) == [(i, first + i) for i in range(len(own))]
    digests = binary_sequences(docs, BPE, 0, payload="crc32").collect()
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32) for r in digests) == want
    assert binary_sequences(no_docs, BPE, 0).count() == 0


def test_batches_have_one_length_and_the_same_tokens(docs):
    got = batches(binary_sequences(docs, BPE, 0, payload="crc32"), 2048).groupBy("length", "batch").agg(
        F.sum("length").alias("t")).collect()
    last = {}
    for r in got:
        last[r.length] = max(last.get(r.length, 0), r.batch)
    assert all(r.t == 2048 or r.batch == last[r.length] and r.t < 2048 for r in got)


def test_capacity_must_be_a_power_of_two(docs):
    with pytest.raises(ValueError):
        binary_sequences(docs, BPE, 0, capacity=1000)


# Vector codes

@pytest.mark.parametrize("seed", range(6))
def test_gnat_finds_the_nearest_entry(seed):
    rng = np.random.default_rng(seed)
    high = (3, 40, 3000, largest_component(64))[seed % 4]
    entries = rng.integers(-high, high + 1, (rng.integers(1, 300), 3 + seed))
    entries = np.concatenate([entries, entries[:7]])
    points = np.concatenate([rng.integers(-high, high + 1, (400, 3 + seed)), entries])
    gaps = ((points[:, None] - entries) ** 2).sum(axis=2)
    index, gap = Gnat(entries, splits=5, leaf=4).nearest(points)
    assert (index == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()


def test_gnat_leaves_subtrees_out():
    rng = np.random.default_rng(0)
    centres = rng.integers(-9000, 9000, (20, 8))
    entries = (centres[:, None] + rng.integers(-50, 50, (20, 13, 8))).reshape(-1, 8)
    tree = Gnat(entries)
    tree.nearest(entries)
    assert tree.visited < 0.25 * len(entries) ** 2


def test_roots_are_conservative():
    x = np.array([0, 1, 2, 3, 4, 10 ** 12 - 1, 10 ** 12, (1 << 60) - 1, 1 << 60])
    for v, lo, hi in zip(x.tolist(), root_below(x).tolist(), root_above(x).tolist()):
        assert lo * lo <= v <= hi * hi


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(vec, e, label) for vec, e, label in rows
            if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * x) for x in r[1]]))
    most = largest_component(len(kept[0][1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    v = [[min(max(math.floor(1024 * float(x)), -most), most) for x in e] for _, e, _ in kept]
    size = len(v[0])
    cuts = [(p * size // parts, (p + 1) * size // parts) for p in range(parts)]
    books = [[row[lo:hi] for row in v[:entries]] for lo, hi in cuts]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for (lo, hi), book in zip(cuts, books):
            groups = defaultdict(list)
            for row in v:
                groups[nearest(row[lo:hi], book)[1]].append(row[lo:hi])
            for k, own in groups.items():
                book[k] = [sum(x) // len(own) for x in zip(*own)]
    codes = [[nearest(row[lo:hi], book) for (lo, hi), book in zip(cuts, books)] for row in v]
    text = ",".join(str(x) for b in books for row in b for x in row)
    sha = hashlib.sha256(text.encode()).hexdigest()
    errors = [sum(gap for gap, _ in c) for c in codes]
    sums = Counter()
    for (_, _, label), e in zip(kept, errors):
        sums[label] += e
    return Counter((vec, "".join(f"{k:02x}" for _, k in c), e, sums[label], sha)
                   for (vec, _, label), c, e in zip(kept, codes, errors))


def awkward_vectors(size, n=330):
    rng = random.Random(size)
    rows = [(i, [rng.choice((-1.5, -0.25, 0.0003, 0.0, 0.75, 2.0)) for _ in range(size)],
             rng.choice((None, 1, 2))) for i in range(10, n)]
    rows += [rows[0], (12, rows[5][1], 2), (None, [0.5] * size, 1), (2, None, 1), (3, [], 1),
             (4, [float("nan")] * size, 2), (5, [float("inf")] * size, 2), (6, [None] * size, 2),
             (11, [0.5] * (size + 1), 1), (13, [1e30] * size, 1), (14, [-1e30] * size, None)]
    return rows


@pytest.mark.parametrize("size", [8, 6, 2])
def test_vector_codes(spark, size):
    rows = awkward_vectors(size)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit(1) for c in ("v", "e", "codes", "error", "s", "_l", "part", "n")})
    rows = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], k)
            for i, e, k in rows]
    got = Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)
                  for r in code_digests(df).collect())
    assert got == plain_codes(rows)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    few = [(3, [1.0, 2.0, 3.0, 4.0], None), (1, [1.0, 2.0, 3.0, 4.5], 5)]
    got = code_digests(spark.createDataFrame(few, schema)).collect()
    assert Counter(tuple(r) for r in got) == plain_codes(few)
    empty = spark.createDataFrame([], schema)
    assert code_digests(empty).count() == 0
    codes, books = vector_codes(empty)
    assert books == [] and codes.count() == 0
    assert code_digests(spark.createDataFrame([(1, None, 2)], schema)).count() == 0


def test_decoded_vectors_are_as_near_as_the_error_says(spark):
    df = spark.createDataFrame(awkward_vectors(8)[:300], "vec_id long, embedding array<float>, label int")
    codes, books = vector_codes(df)
    assert len(books_sha256(books)) == 64
    back = {r.vec_id: (r.embedding, r.error) for r in decode(codes, books).collect()}
    for r in df.collect():
        near, error = back[r.vec_id]
        gap = sum((math.floor(1024 * x) - math.floor(1024 * y)) ** 2 for x, y in zip(r.embedding, near))
        assert gap == error
