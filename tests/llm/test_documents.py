"""Operators on documents against plain versions of their definitions."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rows import ROWS
from parcelspark.llm import bpe, common, pieces
from parcelspark.llm.common import components, drop_rows
from parcelspark.llm.exact import bloom_filter, drop_exact_duplicates, exact_duplicates, mark_possible
from parcelspark.llm.langid import Network, fit, identify, predict, train
from parcelspark.llm.lines import drop_repeated_lines
from parcelspark.llm.ngram import (_joining, _overlaps, _packed, _unpacked, drop_near_duplicates,
                                   ngram_components)
from parcelspark.llm.packing import complete_bins, pack
from parcelspark.llm.tokens import longest_prefix, prefix_counts, token_budget, tokens_within
from parcelspark.session import stage

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def library():
    import tokenizers

    return tokenizers.Tokenizer.from_file(BPE)


# Exact duplicates

def test_exact_duplicates(docs):
    got = exact_duplicates(docs).collect()
    groups = defaultdict(list)
    for doc, text, *_ in ROWS:
        groups[hashlib.sha256(SPACE.sub(" ", text or "").encode()).hexdigest()].append(doc)
    want = defaultdict(list)
    for sha, ids in groups.items():
        low = min((x is None, x or 0) for x in ids)
        kept = False
        for doc in sorted(ids, key=lambda x: (x is None, x or 0)):
            first = not kept and (doc is None, doc or 0) == low
            kept = kept or first
            want[sha].append((doc, None if low[0] else low[1], len(ids), first))
    have = defaultdict(list)
    for r in got:
        have[r.text_sha256].append((r.doc_id, r.keep_id, r.group_size, r.kept))
    order = str
    assert {k: sorted(v, key=order) for k, v in have.items()} == {
        k: sorted(v, key=order) for k, v in want.items()}


def test_exact_stage_keeps_columns_and_one_row_a_text(docs, no_docs):
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [SPACE.sub(" ", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({SPACE.sub(" ", t or "") for _, t, *_ in ROWS})
    assert drop_exact_duplicates(no_docs).count() == 0
    assert exact_duplicates(no_docs).count() == 0


def test_bloom_filter_misses_no_repeated_hash(spark):
    keys = spark.range(3000).select(F.xxhash64(F.when(F.col("id") < 200, F.col("id") % 100)
                                               .otherwise(F.col("id"))).alias("h"))
    bits, twice = bloom_filter(keys, "h", 3000, repeated=True)
    marked = mark_possible(keys, "h", bits, twice)
    repeated = keys.groupBy("h").count().filter("count > 1").select("h")
    assert marked.join(repeated, "h").filter("NOT maybe").count() == 0
    assert marked.filter("maybe").count() < 500


# N-gram join

def shingles(text):
    words = SPACE.split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    words = [w for w in words if w]
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else (
        frozenset())


def linked_components(sets):
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in sets}


def test_ngram_components(spark):
    rng = random.Random(4)
    bases = [[rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(3, 60))]
             for _ in range(8)]
    rows = [(300, None), (301, ""), (302, " \n")]
    for d in range(150):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(["ZZ", "yy", "a"])
        if rng.random() < .2:
            words = words[:rng.randint(1, len(words))]
        rows.append((d, " ".join(words)))
    # A large group of near copies and a passage that unlike texts share.
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(400 + i, passage + f" end{i}") for i in range(60)]
    rows += [(500 + i, passage + " " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = {d: shingles(t) for d, t in rows}
    low = linked_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(df).collect()}
    assert got == {d: (len(s), low[d]) for d, s in sets.items()}


def test_ngram_awkward_rows(docs, no_docs):
    got = ngram_components(docs).collect()
    assert len(got) == len(ROWS)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id))
    assert by_id[2] == by_id[7] == by_id[1] == {(9, 1)}
    assert by_id[3] == {(0, 3)} and by_id[4] == {(0, 4)} and by_id[5] == {(0, 5)}
    assert by_id[8] == {(1, 8)} and by_id[None] == {(4, None)}
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {1, 3, 4, 5, 6, 8, 10, 11, None} <= {r.doc_id for r in kept.collect()}
    assert kept.filter("doc_id IN (2, 7)").count() == 0
    assert ngram_components(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_prefix_tree_equals_set_overlap(seed):
    rng = np.random.default_rng(seed)
    query = np.unique(rng.integers(0, 400, 150)).astype(np.uint64)
    members = []
    for _ in range(40):
        keep = query[rng.random(len(query)) < rng.choice([0.5, 0.8, 0.95])]
        own = np.unique(np.concatenate([keep, rng.integers(0, 900, rng.integers(0, 60)).astype(
            np.uint64)]))
        if len(own):
            members.append(own)
    want = [100 * len(set(m) & set(query)) >= 75 * len(set(m) | set(query)) for m in members]
    assert _overlaps(query, members, 75).tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_blocks_join_what_links(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2000, (3, 60))
    sets = []
    for _ in range(50):
        own = base[rng.integers(3)].copy()
        own[rng.random(60) < rng.choice([0.05, 0.15, 0.4])] = rng.integers(0, 5000)
        sets.append(np.unique(own).astype(np.uint64))
    known = rng.integers(0, 30, 50)
    cut = (0, 20, 50)[seed % 3]
    left, right = (sets, sets) if cut in (0, 50) else (sets[:cut], sets[cut:])
    parts = np.concatenate([known, known]) if left is right else known
    at = {0: 0, 50: 0}.get(cut, cut)
    got = _joining(left, right, parts, 75)

    def closed(links):
        low = {int(k): int(k) for k in known}
        for i, j in [(a, b) for a, b in links] * 60:
            x, y = low[int(known[i])], low[int(known[at + j])]
            for k, v in low.items():
                low[k] = min(x, y) if v in (x, y) else v
        return low

    every = [(i, j) for i, a in enumerate(left) for j, b in enumerate(right)
             if 100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b))]
    assert set(got) <= set(every) and closed(got) == closed(every)
    assert len(got) < len(set(known.tolist()))


def test_large_runs_are_compared_by_blocks(spark, monkeypatch):
    """A group of near copies of one text, many of which link only with few others."""
    import parcelspark.llm.ngram as ngram

    monkeypatch.setattr(ngram, "PAIRED", 3)
    monkeypatch.setattr(ngram, "MEMBERS", 7)
    monkeypatch.setattr(ngram, "ROUNDS", 1)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for d in range(60):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 2, 3])):
            words[rng.randrange(70)] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    low = linked_components({d: shingles(t) for d, t in rows})
    assert {r.doc_id: r.component_id for r in ngram_components(df).collect()} == low


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7),
                                                                                        (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long"), "a",
                                            "b").collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


# Tokens

def test_token_budget(docs, no_docs):
    t = library()
    got = sorted(tuple(r) for r in token_budget(docs, BPE).collect() if r.doc_id is not None)
    for doc, n_bytes, n_tokens, over, fit_chars in got:
        texts = [x or "" for d, x, *_ in ROWS if d == doc]
        text = next(x for x in texts if len(x.encode()) == n_bytes)
        assert n_tokens == len(t.encode(text, add_special_tokens=False).ids)
        assert over == (n_tokens > 512)
        assert len(t.encode(text[:fit_chars], add_special_tokens=False).ids) <= 512
        assert (fit_chars == len(text)) == (not over)
    assert token_budget(docs, BPE).count() == len(ROWS)
    assert token_budget(no_docs, BPE).count() == 0


def test_every_prefix_count(spark):
    t = library()
    rng = random.Random(8)
    parts = ["a", "é", "'", "'s", "'re", "'l", "l", " ", "  ", "\n", "\t", "22", "!?", "_", "×", "the",
             "<|endoftext|>", "²", "中", "\x1c", "\xa0", "ª", "'S", "́", "\x85", "　", "<|", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 10))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = prefix_counts(df, BPE)
    for r in stored.collect():
        text = texts[r.doc_id]
        assert r.counts == [len(t.encode(text[:k], add_special_tokens=False).ids)
                            for k in range(len(text) + 1)]
    row = stored.filter("doc_id = 5").select(
        tokens_within("counts", F.lit(2)).alias("two"), F.col("counts"),
        longest_prefix("counts", 3).alias("fit")).first()
    assert row.two == row.counts[min(2, len(texts[5]))]
    assert row.fit == max(k for k, c in enumerate(row.counts) if c <= 3)


# Language

def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = Network.random(["a", "b", "c"], 3, 1)
    for name in ("inputs", "gates", "cand", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(float))
    codes = rng.integers(0, 256, (9, 5))
    codes[6:, 2], codes[3:, 4] = 256, 256
    y = np.array([0, 1, 2, 1, 0])
    for values, grads in zip(net.parameters(), net.gradients(codes, y)):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in values.shape)
            if values.shape[1] == 257:
                at = (at[0], int(codes[rng.integers(0, 3), 0]), at[2])
            old, e = values[at], 1e-6
            values[at] = old + e
            high = net.loss(codes, y)
            values[at] = old - e
            low = net.loss(codes, y)
            values[at] = old
            assert abs((high - low) / 2 / e - grads[at]) < 1e-7


def test_language_ids(spark, docs, no_docs):
    rng = random.Random(2)
    syllables = {"xx": ["ka", "zo", "ri"], "yy": ["élu", "mör", "ença"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(40)), lang)
            for i in range(200) for lang in [rng.choice(["xx", "yy"])]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(df).collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, _, _ in rows)
    held = [(got[d].lang_pred, lang) for d, _, lang in rows if got[d].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    net = train([t.encode() for _, t, _ in rows], [x for *_, x in rows], steps=30)
    odd = predict(docs, net).collect()
    assert len(odd) == len(ROWS)
    for r in odd:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 6))
    # Predictions don't depend on how rows are batched, nor on lang, source and doc_id.
    again = predict(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(99).cast("long")), net)
    assert again.first().score == pytest.approx(next(r.score for r in odd if r.doc_id == 1), abs=1e-5)
    assert identify(no_docs).count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert fit(none) is None
    assert {r.lang_pred for r in identify(none).collect()} == {"und"}


# Lines

def plain_line_dedup(rows, least):
    docs = sorted({(d is None, d or 0, t or "") for d, t in rows})
    lines = [[x.strip(" \t\n\r\x0b\x0c") for x in t.split("\n")] for _, _, t in docs]
    first, drop, passages = {}, [set() for _ in docs], []
    for i, own in enumerate(lines):
        for p in range(len(own)):
            total = 0
            for e in range(p, len(own)):
                total += len(own[e].split())
                if total >= least:
                    passages.append((i, p, tuple(own[p:e + 1])))
                    first.setdefault(tuple(own[p:e + 1]), (i, p))
                    break
    for i, p, key in passages:
        j, q = first[key]
        if (j, q) != (i, p):
            n = 0
            while (p + n < len(lines[i]) and q + n < len(lines[j])
                   and lines[i][p + n] == lines[j][q + n]):
                n += 1
            drop[i].update(range(p, p + n))
    out = defaultdict(list)
    for (none, d, t), gone in zip(docs, drop):
        raw = t.split("\n")
        out[None if none else d].append((len(raw), len(gone), "\n".join(
            x for n, x in enumerate(raw) if n not in gone)))
    return out


def test_line_dedup(spark):
    rng = random.Random(5)
    rows = [(k, "\n".join(rng.choice(["a b", "c", "d e f", "", "x  y", "g"])
                          for _ in range(rng.randint(0, 14)))) for k in range(50)]
    rows += [(61, None), (62, ""), (None, "a b\nc\nd e f"), (3, "c\nd e f\nx  y\ng")]
    rows += [(70 + k, "\n".join(["one two three four"] * 9)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = plain_line_dedup(rows, 4), defaultdict(list)
    for r in drop_repeated_lines(df, 4).collect():
        got[r.doc_id].append((r.n_lines, r.n_dropped, r.text))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def plain_longest_runs(rows, least):
    """Every stretch of enough words that occurs at an earlier place goes."""
    docs = sorted({(d is None, d or 0, t or "") for d, t in rows})
    seen, out = set(), defaultdict(list)
    for none, d, text in docs:
        raw = text.split("\n")
        own, gone = [x.strip(" \t\n\r\x0b\x0c") for x in raw], set()
        for p in range(len(own)):
            for e in range(p, len(own)):
                run = tuple(own[p:e + 1])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen:
                        gone.update(range(p, e + 1))
                    seen.add(run)
        out[None if none else d].append((len(raw), len(gone), "\n".join(
            x for n, x in enumerate(raw) if n not in gone)))
    return out


def test_line_dedup_of_any_earlier_copy(spark):
    """The first copy of a passage is not the one that agrees longest with a later one."""
    rng = random.Random(6)
    rows = [(k, "\n".join(rng.choice(["a b", "c", "d e f", "", "x  y", "g"])
                          for _ in range(rng.randint(0, 14)))) for k in range(80)]
    p, q = "p " * 100, "q " * 3
    rows += [(100, p), (101, f"{p}\n{q}"), (102, f"{p}\n{q}\nend"), (None, f"z\n{p}\n{q}"),
             (103, None), (104, "\n".join(["one two three four"] * 9))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = plain_longest_runs(rows, 4), defaultdict(list)
    for r in drop_repeated_lines(df, 4, any_copy=True).collect():
        got[r.doc_id].append((r.n_lines, r.n_dropped, r.text))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert got[102] == [(3, 2, "end")] and got[None] == [(3, 2, "z")]


def test_line_dedup_query_takes_any_copy(spark, tmp_path):
    p, q = "p " * 100, "q " * 30
    rows = [(1, p), (2, f"{p}\n{q}"), (3, f"{p}\n{q}\nend")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in entry.queries()["op8_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: p, 2: q, 3: "end"}


def test_line_dedup_awkward_rows(docs, no_docs):
    got = drop_repeated_lines(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r.n_dropped == 0 for r in got)
    assert drop_repeated_lines(no_docs).count() == 0


# Packing

def test_packing(docs, no_docs):
    t = library()
    rows = pack(docs, BPE, 2).collect()
    by_text = defaultdict(list)
    for r in rows:
        by_text[r.doc_id].append(r)
    want = defaultdict(list)
    for doc, text, *_ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        at, size, piece = 0, len(ids) % 1024 or 1024, 0
        while at < len(ids):
            raw = np.array(ids[at:at + size], "<u4").tobytes()
            want[doc].append((piece, at, size, zlib.crc32(raw)))
            at, size, piece = at + size, 1024, piece + 1
    assert {d: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in v)
            for d, v in by_text.items()} == {d: sorted(v) for d, v in want.items()}
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    assert pack(no_docs, BPE, 2).count() == 0


def optimum(lengths, capacity):
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + lengths[i] <= capacity:
                bins[k] += lengths[i]
                place(i + 1, bins)
                bins[k] -= lengths[i]
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_finds_the_optimum(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(2, 18) for _ in range(11)), reverse=True)
    counts = np.bincount(lengths, minlength=21)
    plan = complete_bins(counts, 20)
    used = np.zeros_like(counts)
    for filling, times in plan:
        assert sum(filling) <= 20
        for x in filling:
            used[x] += times
    assert (used == counts).all()
    assert sum(times for _, times in plan) == optimum(lengths, 20)


def test_words_of_the_tokenizer_match_the_library():
    from parcelspark.llm.bpe import Encoder

    rng = random.Random(1)
    parts = ["a", "é", "'", "'s", "'re", "re", " ", "  ", "\n", "1", "!?", "_", "×", "<|endoftext|>", "²",
             "中", "\x1c", "\xa0", "ß", "́", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    ids, ends = Encoder(BPE).encode(pa.array(texts))
    want = library().encode_batch(texts, add_special_tokens=False)
    assert all(w.ids == ids[a:b].tolist() for w, a, b in zip(want, ends, ends[1:]))


def test_lattice_of_a_word_does_not_depend_on_its_company():
    """What a worker learned before, and which words it learns together, must not move a draw."""
    lattice = pieces.Lattice(public_tokenizers.path("piece_bpe_32k.model"), pieces.ALPHA)
    rng = np.random.default_rng(5)
    words = [b" " + bytes(rng.integers(97, 123, int(n)).astype(np.uint8)) for n in
             rng.integers(1, 14, 3000)] + [" \u65e5\u672c\u8a9e\U0001f389x".encode(), b"\n"]
    flat, sizes = lattice._learn(words)
    ends = np.cumsum(sizes)
    for i in (0, 1500, 2999, 3000, 3001):
        alone, size = lattice._learn([words[i]])
        assert size[0] == sizes[i]
        assert (alone == flat[ends[i] - sizes[i]:ends[i]]).all()


def test_word_table_learns_by_batches_and_forgets_as_a_whole():
    asked = []

    def learn(words):
        asked.append(len(words))
        return np.concatenate([np.frombuffer(w, np.uint8) for w in words]), np.array(
            [len(w) for w in words])

    table = bpe.WordTable(learn, "u1", limit=50, batch=16)
    for lo in (0, 30, 10, 200):
        words = [f"w{i:03d}"[:2 + i % 3].encode() + b"-%d" % i for i in range(lo, lo + 40)] * 2
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum([0, *map(len, words[:-1])])
        rows = table.look_up(data, starts)
        assert table.gathered(rows).tobytes() == data.tobytes()
        assert len(table.keys) <= 50
    assert max(asked) <= 16


def test_rows_of_unwanted_ids_go_without_a_shuffle_of_texts(spark):
    docs = spark.range(6).selectExpr("if(id < 2, null, id) AS doc_id", "concat('t', id) AS text")
    gone = spark.createDataFrame([(3,), (9,)], "doc_id long")
    assert sorted(r.text for r in drop_rows(docs, gone).collect()) == ["t0", "t1", "t2", "t4", "t5"]
    nulls = drop_rows(docs, spark.createDataFrame([(None,)], "doc_id long"))
    assert sorted(r.text for r in nulls.collect()) == ["t2", "t3", "t4", "t5"]
    assert drop_rows(docs, gone.limit(0)).count() == 6
    plan = drop_rows(docs, gone)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_language_step_joins_no_texts_by_shuffle(spark, monkeypatch):
    """A row goes when none of its id is known; rows with a null id are judged together."""
    rows = [(1, "a", "en", .9), (2, "b", "und", 0.0), (3, "c", "en", .3), (3, "d", "en", .8),
            (None, "e", "und", 0.0), (None, "f", "de", .5), (4, "g", "de", .39)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    monkeypatch.setattr(corpus_pipeline, "identify", lambda df: df)
    left = corpus_pipeline.known_language(spark, docs, "")
    assert sorted(r.text for r in left.collect()) == ["a", "c", "d", "e", "f"]
    assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [1, 255, 256, 70000])
def test_parts_of_the_sketch_are_packed_whole(most):
    counts = np.random.default_rng(3).integers(0, most + 1, 1 << 14).astype(np.uint32)
    counts[0] = most
    assert (_unpacked(_packed(counts)) == counts).all()
    if most == 255:
        few = np.random.default_rng(4).poisson(2, 1 << 14).astype(np.uint32)
        assert len(_packed(few)) < few.nbytes / 6


def test_pipeline_reads_texts_in_small_batches_and_leaves_the_session_as_it_was(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text").coalesce(1)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)

    def sizes(spark, df, sf):
        return df.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict(
            {"n": pa.array([b.num_rows], pa.int64())}) for b in batches), "n long")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", sizes), ("b", lambda s, df, d: df)])
    before = spark.conf.get(name)
    got = [r.n for r in corpus_pipeline.run(spark, "").collect()]
    assert sum(got) == 3000 and max(got) <= corpus_pipeline.BATCH_ROWS
    assert spark.conf.get(name) == before
    spark.conf.set(name, 7)
    try:
        assert max(r.n for r in corpus_pipeline.run(spark, "").collect()) == 7
    finally:
        spark.conf.set(name, before)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in str(files.getAllFiles().mkString("\n")).split("\n") if "shuffle_" in x}


def test_staged_steps_leave_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name), shuffle_files(spark)
    kept = stage(spark.range(10000).selectExpr("id % 100 AS k").groupBy("k").count(), "counts")
    end = time.time() + 20
    while (left := shuffle_files(spark) - before[1]) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert kept.count() == 100 and kept.groupBy().sum("count").first()[0] == 10000
    assert spark.conf.get(name) == before[0]


def test_few_links_are_joined_without_shuffles(spark, monkeypatch):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(400)] + [(500, 1000 + i) for i in range(300)]
    pairs += [(rng.randrange(2000, 3000), rng.randrange(2000, 3000)) for _ in range(600)]
    pairs += [(-5, 2**62), (2**62, 7), (4000, 4000), (None, 3), (4, None), (1, 0)]
    rng.shuffle(pairs)
    links = spark.createDataFrame(pairs, "a long, b long").repartition(8)
    few = components(links, "a", "b")
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, few.collect()))
    low = {}
    for own in linked_nodes([p for p in pairs if None not in p and p[0] != p[1]]):
        low |= {x: min(own) for x in own}
    assert got == sorted(low.items())
    monkeypatch.setattr(common, "EDGES", 0)
    assert sorted(map(tuple, components(links, "a", "b").collect())) == got
    assert components(links.limit(0), "a", "b").count() == 0


def linked_nodes(pairs):
    parts = []
    for pair in pairs:
        touched = [p for p in parts if p & set(pair)]
        parts = [p for p in parts if not p & set(pair)] + [set(pair).union(*touched)]
    return parts


def test_each_step_of_the_pipeline_reads_texts_in_small_batches(spark, monkeypatch):
    """A step may be run by itself; the bound must hold there too."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen = []
    for operator in ("identify", "drop_exact_duplicates", "drop_near_duplicates", "pack"):
        def look(docs, *rest, operator=operator):
            seen.append(int(spark.conf.get(name)))
            return docs.selectExpr("doc_id", "'en' AS lang_pred", "1D AS score")

        monkeypatch.setattr(corpus_pipeline, operator, look)
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, "").count() == 2
    assert seen == [corpus_pipeline.BATCH_ROWS] * 4 and spark.conf.get(name) == before
