"""Registered queries of the operators in this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelspark.llm.binary import binary_sequences
from parcelspark.llm.chat import collapse_conversations
from parcelspark.llm.codes import code_digests
from parcelspark.llm.common import table
from parcelspark.llm.embeddings import near_vectors
from parcelspark.llm.exact import exact_duplicates
from parcelspark.llm.html import extract_text
from parcelspark.llm.langid import identify
from parcelspark.llm.lines import drop_repeated_lines
from parcelspark.llm.ngram import ngram_components
from parcelspark.llm.packing import pack
from parcelspark.llm.pieces import segmentation_digests
from parcelspark.llm.spelling import spelling_variants
from parcelspark.llm.tokens import token_budget

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_exact_dedup", """
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'))
           AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
""")
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(table(spark, sf, "documents")).drop("row")


@query("op2_embedding_near_dedup", """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
ways AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT vec_id, coalesce(n, 0) AS n_links, low AS component_id, vec_id = low AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM ways GROUP BY a) USING (vec_id)
JOIN (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a) USING (vec_id)
""")
def embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors(table(spark, sf, "embeddings"))


@query("op3_token_counts")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_budget(table(spark, sf, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_ngram_jaccard_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5
           THEN [list_aggregate(words, 'string_agg', ' ')]
           ELSE list_transform(range(1, len(words) - 3),
                               lambda i: list_aggregate(words[i:i + 4], 'string_agg', ' ')) END)) AS g
  FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n
          UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) r USING (doc_id)
""")
def ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_components(table(spark, sf, "documents"))


@query("op5_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(table(spark, sf, "documents"))


@query("op9_sentencepiece_sampling")
def sentencepiece_sampling(spark: SparkSession, sf: str) -> DataFrame:
    return segmentation_digests(table(spark, sf, "documents"),
                                public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


@query("op6_chat_formatting", """
WITH t AS (SELECT conv_id, role, text, row_number() OVER o AS place FROM conversations
           WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST,
                        text NULLS FIRST)),
p AS MATERIALIZED (
  SELECT conv_id, place, string_agg(CASE WHEN role IS NULL THEN '-' ELSE '+' || role END || chr(30)
             || CASE WHEN text IS NULL THEN '-' ELSE '+' || text END, chr(31))
           OVER (PARTITION BY conv_id ORDER BY place) AS turns,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                    || '<|im_end|>' || chr(10), '') OVER (PARTITION BY conv_id ORDER BY place) AS text,
         max(place) OVER (PARTITION BY conv_id) AS n FROM t),
f AS (SELECT conv_id, n, text, turns, min(conv_id) OVER (PARTITION BY turns) AS low,
             turns IN (SELECT turns FROM p WHERE place < n) AS shorter
      FROM p WHERE place = n)
SELECT conv_id, n AS n_turns,
       CASE WHEN shorter THEN 'prefix' WHEN conv_id = low THEN 'kept' ELSE 'copy' END AS status,
       CASE WHEN NOT shorter THEN low END AS keep_id,
       CASE WHEN NOT shorter AND conv_id = low THEN text END AS text FROM f
""")
def chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    return collapse_conversations(table(spark, sf, "conversations"))


@query("op7_html_extraction")
def html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages"))


@query("op8_line_dedup")
def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf, "documents"), any_copy=True)


@query("op11_spelling_variants", """
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n, length(run) AS size FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM runs),
-- crc32, bit by bit.
sums AS MATERIALIZED (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
    range(1, length(hx), 2), lambda i: list_transform(range(8), lambda k:
      (CAST('0x' || hx[i:i + 1] AS BIGINT) >> k) & 1)))),
    lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h FROM hexed),
words AS MATERIALIZED (
  SELECT CAST(sum(n) AS BIGINT) AS n, word FROM (SELECT n, CASE WHEN h % 199 = 0 THEN
    run[:h % size] || run[h % size + 2:] ELSE run END AS word FROM sums)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS MATERIALIZED (SELECT word, n, i, word[:i - 1] AS l, word[i + 1:] AS r FROM
  (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b USING (i, l, r) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.l || a.r = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.l || a.r = b.word),
best AS (SELECT word, count(*) AS n_near, first(struct_pack(f := near, n := n) ORDER BY n DESC, near)
  AS top FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top.n >= 5 * w.n THEN top.f END AS form, CASE WHEN top.n >= 5 * w.n THEN top.n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM chain
  WHERE next IS NULL) USING (word)
""")
def spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(table(spark, sf, "documents"))


@query("op12_binary_packing")
def binary_packing(spark: SparkSession, sf: str) -> DataFrame:
    return binary_sequences(table(spark, sf, "documents"),
                            public_tokenizers.path("byte_bpe_50k.json"), 0, payload="crc32")


_GAP = ("list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.e) + list_dot_product(c.e, c.e)")


def _round(i: int) -> str:
    """One assignment and replacement: codebook ``c{i}`` from ``c{i - 1}``."""
    return f"""a{i} AS MATERIALIZED (SELECT x.row, x.p, min_by(c.k, ({_GAP}) * 256 + c.k) AS k
  FROM x JOIN c{i - 1} c USING (p) GROUP BY x.row, x.p),
m{i} AS (SELECT p, k, pos, floor(sum(y) / count(*)) AS e FROM (SELECT x.p, a.k,
  unnest(range(len(x.v))) AS pos, unnest(x.v) AS y FROM x JOIN a{i} a USING (row, p)) GROUP BY ALL),
c{i} AS MATERIALIZED (SELECT p, k, coalesce(n.e, o.e) AS e FROM c{i - 1} o
  LEFT JOIN (SELECT p, k, list(e ORDER BY pos) AS e FROM m{i} GROUP BY ALL) n USING (p, k))"""


@query("op13_vector_codes", f"""
WITH v AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x))
    AS v, row_number() OVER (ORDER BY vec_id, v) AS row FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(embedding) > 0),
x AS MATERIALIZED (SELECT row, vec_id, label, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS v
  FROM v, (SELECT unnest(range(4)) AS p)),
c0 AS MATERIALIZED (SELECT p, row - 1 AS k, v AS e FROM x WHERE row <= 256),
{", ".join(_round(i) for i in range(1, 5))},
f AS MATERIALIZED (SELECT x.row, x.p, min_by(c.k, ({_GAP}) * 256 + c.k) AS k, min({_GAP}) AS gap
  FROM x JOIN c4 c USING (p) GROUP BY x.row, x.p),
o AS (SELECT row, string_agg(lower(printf('%02x', k)), '' ORDER BY p) AS code,
  CAST(sum(gap) AS BIGINT) AS error FROM f GROUP BY row),
s AS (SELECT sha256(string_agg(list_aggregate(list_transform(e, lambda y: CAST(y AS BIGINT)),
  'string_agg', ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256 FROM v JOIN o USING (row), s
""")
def vector_codebooks(spark: SparkSession, sf: str) -> DataFrame:
    return code_digests(table(spark, sf, "embeddings"))
