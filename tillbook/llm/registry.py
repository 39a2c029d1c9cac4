"""Registered queries of the training-data operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import (
    byte_bpe,
    chat,
    exact_dedup,
    fill_middle,
    langid,
    minhash,
    packing,
    quality,
    simhash,
    substring_dedup,
    topk,
    trie,
    url_filter,
)
from tillbook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (SELECT h, count(*) AS group_size, max(n) AS top FROM d GROUP BY h),
k AS (SELECT d.h, min(doc_id) AS keep_id FROM d JOIN g ON d.h = g.h AND d.n = g.top GROUP BY d.h)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.h AS text_sha256
FROM d JOIN g ON d.h = g.h JOIN k ON d.h = k.h"""


@register("op1_exact_dedup", OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


@register("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


@register("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN)


@register("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w
  FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
s AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS words FROM p),
f AS (SELECT words, min(doc_id) AS first_id FROM s GROUP BY words),
r AS (SELECT s.doc_id, s.i FROM s JOIN f ON s.words = f.words WHERE s.doc_id > f.first_id),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM r),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
y AS (SELECT x.doc_id, count(g.k) AS n_removed,
             string_agg(word, ' ' ORDER BY x.k) FILTER (WHERE g.k IS NULL) AS kept
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.k = g.k GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(y.n_removed, 0) AS n_removed,
       sha256(coalesce(y.kept, '')) AS kept_sha256
FROM d LEFT JOIN y ON d.doc_id = y.doc_id"""


@register("op2_substring_dedup", OP2_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removals(table(spark, sf_dir, "documents"))


@register("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judged(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@register("op3_exact_topk", OP3_SQL)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 50 = 0"))


@register("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judged(pages, url_filter.labelled_pages(pages, table(spark, sf_dir, "labels")))


OP10_SQL = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations),
c AS (
  SELECT conv_id, max(place) AS n_turns, list(struct_pack(r := role, x := text) ORDER BY place) AS turns,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                    || '<|im_end|>' || chr(10), '' ORDER BY place) AS chat
  FROM t GROUP BY conv_id),
one AS (
  SELECT turns, min(conv_id) AS conv_id, count(*) AS copies, any_value(n_turns) AS n_turns,
         any_value(chat) AS chat
  FROM c GROUP BY turns),
i AS (SELECT turns, unnest(range(1, n_turns)) AS i FROM c),
p AS (SELECT DISTINCT turns[1:i] AS turns FROM i)
SELECT conv_id, n_turns, copies, chat FROM one
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.turns = one.turns)"""


@register("op10_chat_format", OP10_SQL)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
c AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
e AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM c),
s AS (SELECT *, substr(t, 1, p) AS a, substr(t, p + 1, q - p) AS m, substr(t, q + 1) AS z FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
              ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s"""


@register("op11_fill_in_middle", OP11_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations),
o AS (SELECT c, list(struct_pack(r := r, x := x) ORDER BY place) AS turns FROM t GROUP BY c),
h AS (
  SELECT c, turns, xor(list_reduce(
           list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT)),
           lambda z, s: list_reduce(range(8), lambda y, i: CASE WHEN y & 1 = 1
             THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(z, s)), 4294967295), 4294967295) % 4 AS h
  FROM o),
l AS (
  SELECT h.c, coalesce(b.turns, [])[1:h.h] || h.turns[h.h + 1:] AS turns
  FROM h LEFT JOIN o b ON b.c = h.c - h.c % 20),
n AS (
  SELECT p, min(c) AS conv_id, count(*) AS n_convs
  FROM (SELECT c, turns[1:unnest(range(0, len(turns) + 1))] AS p FROM l) GROUP BY p),
k AS (SELECT p[1:len(p) - 1] AS p, count(*) AS n_children FROM n WHERE len(p) > 0 GROUP BY 1),
v AS (
  SELECT n.p, n.conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN len(n.p) = 0 THEN 0 ELSE (n.n_convs - 1) * len(list_filter(
           regexp_split_to_array(n.p[-1].x, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS saved
  FROM n LEFT JOIN k ON n.p = k.p),
u AS (
  SELECT p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT p[1:unnest(range(0, len(p) + 1))] AS p, n_children, saved FROM v) GROUP BY p),
e AS (SELECT turns AS p, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM l GROUP BY turns)
SELECT v.conv_id, CAST(len(v.p) AS BIGINT) AS depth, w.conv_id AS parent_conv_id, v.n_convs, v.n_children,
       u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM v JOIN u ON v.p = u.p LEFT JOIN e ON v.p = e.p
LEFT JOIN v w ON len(v.p) > 0 AND w.p = v.p[1:len(v.p) - 1]"""


@register("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_prefixes(table(spark, sf_dir, "conversations"))


@register("op12_minhash_near_dedup")
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))
