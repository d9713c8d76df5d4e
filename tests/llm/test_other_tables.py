"""Operators on vectors, conversations, pages and pieces, and the registered queries."""

import math
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from compare import connect, differences
from parcelspark.llm.chat import collapse_conversations
from parcelspark.llm.embeddings import near_vectors
from parcelspark.llm.html import extract_text, visible_text
from parcelspark.llm.pieces import Sampler, decode_pieces, sample_segmentations

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
OPS = sorted(n for n in entry.queries() if n.startswith("op"))


def test_thirteen_operators_and_the_pipeline():
    assert {n.split("_")[0] for n in OPS} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in OPS if n not in entry.oracle_sql()])
def test_whole_table(spark, name):
    rows = entry.queries()[name](spark, SF)
    tables = {"op7": "pages"}
    n = spark.read.parquet(f"{SF}/{tables.get(name.split('_')[0], 'documents')}.parquet").count()
    key = rows.columns[0]
    assert rows.select(key).distinct().count() == n


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from parcelspark.session import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in pipeline.STAGES[:-1]:
        after = stage(step(spark, docs, SF))
        assert after.columns == docs.columns
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
    packed = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r[0] for r in packed.select("doc_id").collect()} == {
        r[0] for r in docs.select("doc_id").collect()}


# Vectors

def plain_links(rows):
    unit = []
    for vec, e, label in rows:
        ok = (label is not None and e and all(x is not None and math.isfinite(x) for x in e)
              and any(e))
        unit.append(np.array(e, float) / np.linalg.norm(np.array(e, float)) if ok else None)
    links = defaultdict(set)
    for i, (_, _, a) in enumerate(rows):
        for j, (_, _, b) in enumerate(rows[:i]):
            if (a == b and unit[i] is not None and unit[j] is not None
                    and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93):
                links[i].add(j)
                links[j].add(i)
    part = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        part[i] = min(seen, key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    return links, part


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    rows, vec = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            centre = rng.standard_normal(16)
            for _ in range(rng.integers(1, 5)):
                e = (centre + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.3])).astype("f4")
                rows.append((vec, e.tolist(), label))
                vec += 1
    same = rng.standard_normal(16)
    rows += [(vec + i, (same + rng.standard_normal(16) * 0.05).astype("f4").tolist(), 2)
             for i in range(300)]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * 16, 0), (2003, [float("nan")] * 16, 0),
             (2004, [None] * 16, 0), (2005, [1.0, 2.0], 0), (2006, [1.0, 2.0], 0),
             (None, rows[0][1], 0), (2007, [float("inf")] * 16, 0), (2008, [1e-30] * 16, 0),
             (2009, [1e30] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", "1 AS row", "1 AS component", "1 AS unit")
    links, part = plain_links(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert got == {rows[i][0]: (len(links[i]), rows[part[i]][0], part[i] == i)
                   for i in range(len(rows))}
    assert near_vectors(df.limit(0)).count() == 0


def test_near_vectors_of_a_large_label(spark):
    """Pairs that one round's short windows don't bring together, in a label to one side."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(32) * 0.8
    one = rng.standard_normal((1000, 32)) + centre
    two = one[:500] + rng.standard_normal((500, 32)) * 0.37
    both = np.concatenate([one, two]).astype("f4")
    rows = [(i, e.tolist(), 1) for i, e in enumerate(both)]
    links, part = plain_links(rows)
    assert sum(map(len, links.values())) > 600
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in
           near_vectors(df, passes=4, reach=4).collect()}
    assert got == {i: (len(links[i]), part[i]) for i in range(len(rows))}


# Conversations

def test_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"),
            (2, 0, "user", "a"), (2, 1, "assistant", "b"),
            (3, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 2, "user", "c"),
            (4, 0, "user", "a"), (4, 1, "assistant", "x"), (5, 0, "user", None),
            (6, 0, "user", ""), (7, 0, None, "a"), (None, 0, "user", "z"), (8, None, "user", "q"),
            (8, 0, "user", "a"), (9, 0, "user", "a"), (9, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in collapse_conversations(df.selectExpr("*", "1 AS at", "1 AS h1"))
           .collect()}
    status = {k: (r.n_turns, r.status, r.keep_id) for k, r in got.items()}
    assert status == {
        1: (3, "kept", 1), 2: (2, "prefix", None), 3: (3, "copy", 1), 4: (2, "kept", 4),
        5: (1, "kept", 5), 6: (1, "kept", 6), 7: (1, "kept", 7), None: (1, "kept", None),
        8: (2, "kept", 8), 9: (2, "kept", 9)}
    assert got[1].text == ("<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
                           "<|im_start|>user\nc<|im_end|>\n")
    assert got[8].text.endswith("user\nq<|im_end|>\n") and got[2].text is None
    assert collapse_conversations(df.limit(0)).count() == 0


# Pages

@pytest.mark.parametrize("html, text", [
    ("<p>a<p>b <b>c</b><br>d", "a\n\nb c\nd"),
    ("<ul><li>x<li>y<ul><li>z</ul><li>w</ul>t", "- x\n- y\n  - z\n- w\n\nt"),
    ("<ol start=3><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n8. c"),
    ("<table><tr><th>Name<th>N<tr><td>longer name<td>12</table>x",
     "Name         N\nlonger name  12\n\nx"),
    ("<div hidden>q</div><i style='display: none'>r</i><pre>\n a\n  b</pre>z", " a\n  b\n\nz"),
    ("<head><title>T</title></head>x &amp; y<script>if(a<b){}</script> z", "x & y z"),
    ("<b>bold<p>para</b> more</p>end", "bold\n\npara more\n\nend"),
    ("<details><summary>s</summary>hid<b>den</b></details>v", "s\nv"),
    ("<table>before<tr><td>1</table>", "before\n\n1"), ("a < b", "a < b"), ("", ""),
    ("<!-- a > b -->c<p/>", "c"), ("</p></li></table>", ""), ('<a href="x>y">l</a>', "l"),
])
def test_layout(html, text):
    assert visible_text(html) == text


def test_deep_and_broken_pages_end():
    assert visible_text("<div>" * 50000 + "x") == "x"
    assert visible_text("<" * 50000) == "<" * 50000
    visible_text('<a b="' * 5000)


def test_pages(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None), (None, "u", "b"), (3, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in extract_text(df.selectExpr("*", "1 AS text")).collect()), key=str)
    assert got == sorted([(1, 1, "a"), (1, 1, "a"), (2, 0, ""), (None, 1, "b"), (3, 0, "")], key=str)
    assert extract_text(df.limit(0)).count() == 0


# Pieces

def all_segmentations(lattice, text):
    raw, found = (" " + text).encode(), {}

    def go(at, ids, weight):
        if at == len(raw):
            found[tuple(ids)] = weight
            return
        for n in range(1, len(raw) - at + 1):
            piece = lattice.names.get(raw[at:at + n])
            if piece is not None:
                go(at + n, [*ids, piece], weight + lattice.weight[piece])
        first = raw[at:].decode()[0].encode()
        if first not in lattice.names:
            go(at + len(first), [*ids, *(int(lattice.byte_ids[b]) for b in first)],
               weight + lattice.fallback)

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(found.values()))
    return {k: math.exp(v - total) for k, v in found.items()}


@pytest.mark.parametrize("text", ["ab", "the cat", "x\ny", "é𠀀"])
def test_sampling_without_replacement(text):
    sampler, n = Sampler(MODEL, 0.0005, 23), 1500
    share = all_segmentations(sampler.lattice, text)
    column = pa.array([text] * n)
    data, ends, _ = sampler.lattice.words(column)
    firsts, seconds, totals = defaultdict(int), defaultdict(int), []
    for i, own in enumerate(sampler.sample(column, np.arange(n), 2)):
        ids = [tuple(sampler.ids(e, data, int(ends[i])).tolist()) for e, *_ in own]
        assert len(set(ids)) == len(ids) == min(2, len(share))
        assert all(math.log(share[k]) == pytest.approx(x[1], abs=1e-9) for k, x in zip(ids, own))
        assert own == sorted(own, key=lambda x: -x[2])
        firsts[ids[0]] += 1
        seconds[ids[1]] += 1
        totals.append(sum(math.exp(x[1]) / x[3] for x in own))
    assert sum(abs(firsts[k] / n - p) for k, p in share.items()) < 0.08
    second = {k: sum(p * q / (1 - p) for j, p in share.items() if j != k) for k, q in share.items()}
    assert sum(abs(seconds[k] / n - p) for k, p in second.items()) < 0.12
    # Weighting by inclusion makes the expected total one.
    assert np.mean(totals) == pytest.approx(1, abs=0.1)


def test_segmentations_round_trip(spark, docs, no_docs):
    from rows import ROWS

    short = docs.filter("doc_id IS NULL OR doc_id <> 8")
    rows = sample_segmentations(short, MODEL, 3)
    got = rows.collect()
    assert all(r.round_trip and 0 <= r.inclusion <= 1 for r in got)
    texts = defaultdict(set)
    for r in decode_pieces(rows, MODEL).collect():
        texts[r.doc_id].add(r.text)
    want = defaultdict(set)
    for d, t, *_ in ROWS:
        want[d].add(t or "")
    assert texts == {d: t for d, t in want.items() if d != 8}
    again = {(r.doc_id, r.sample, tuple(r.ids))
             for r in sample_segmentations(short.repartition(5), MODEL, 3).collect()}
    assert again == {(r.doc_id, r.sample, tuple(r.ids)) for r in got}
    assert sample_segmentations(no_docs, MODEL).count() == 0


@pytest.mark.parametrize("name", [n for n in OPS if n in entry.oracle_sql()])
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None
