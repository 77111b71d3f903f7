"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import (
    centroids, conversations, decontaminate, exact_dedup, html_extract, language, mixing, pii,
    quality, secrets, simhash, tokens, warc,
)
from tallyframe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TOKEN_LIMIT = 4096


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


@query("op10_exact_dedup", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(table(spark, sf_dir, "documents"), shingle=3, radius=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_mixing", mixing.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(table(spark, sf_dir, "documents"))


@query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.spans(table(spark, sf_dir, "documents"))


def _rounds(k: int, rounds: int) -> str:
    """The SQL of `rounds` rounds of assignment and recentring, written out one after another."""
    step = """
a{i} AS (
  SELECT vec, arg_min(number, [d, number]) AS number, min(d) AS d FROM (
    SELECT v.vec, c.number,
           list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d
    FROM v CROSS JOIN c{i} AS c)
  GROUP BY vec),"""
    move = """
m{i} AS (
  SELECT number, list(floor_mean ORDER BY place) AS x FROM (
    SELECT number, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
    FROM (SELECT number, unnest(x) AS x, generate_subscripts(x, 1) AS place FROM v JOIN a{i} USING (vec))
    GROUP BY number, place)
  GROUP BY number),
c{j} AS (SELECT number, coalesce(m.x, c.x) AS x FROM c{i} AS c LEFT JOIN m{i} AS m USING (number)),"""
    return "".join(step.format(i=i) + move.format(i=i, j=i + 1) for i in range(rounds)) + step.format(i=rounds)


@query("op11_centroids", """
WITH v AS (
  SELECT row_number() OVER () AS vec, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS number, x
  FROM v ORDER BY number LIMIT 40),
""" + _rounds(40, 5).strip().rstrip(",") + """
SELECT vec_id, a5.number::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY a5.number))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.x, ',')) AS centroid_sha256
FROM a5 JOIN v USING (vec) JOIN c5 ON c5.number = a5.number
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(
        table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)


@query("op12_conversation_trie", """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(
           list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, _: xor(x >> 1, (x & 1) * 3988292384)), 4294967295), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
sizes AS (SELECT conv_id AS base, count(*) AS n FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, t.pos AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT conv_id, pos - h + least(h, coalesce(n, 0)), role, text
  FROM c JOIN t USING (conv_id) LEFT JOIN sizes USING (base) WHERE pos > h),
m AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM c
  UNION ALL
  SELECT conv_id, depth,
         string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
           OVER (PARTITION BY conv_id ORDER BY depth), strlen(text)
  FROM r),
ends AS (
  SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM m JOIN (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id) USING (conv_id, depth)
  GROUP BY depth, path),
node AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes
  FROM m GROUP BY depth, path),
kids AS (
  SELECT m.depth, m.path, count(*) AS n_children
  FROM node JOIN m ON m.conv_id = node.conv_id AND m.depth = node.depth - 1 GROUP BY m.depth, m.path),
below AS (
  SELECT m.depth, m.path, sum((n_children IS NULL)::INTEGER) AS n_leaves,
         sum((n_convs - 1) * node.bytes) AS saved_tokens
  FROM node LEFT JOIN kids USING (depth, path)
  JOIN m ON m.conv_id = node.conv_id AND m.depth <= node.depth GROUP BY m.depth, m.path)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node
JOIN below ON below.depth = node.depth AND below.path = node.path
LEFT JOIN kids ON kids.depth = node.depth AND kids.path = node.path
LEFT JOIN ends ON ends.depth = node.depth AND ends.path = node.path
LEFT JOIN m AS up ON up.conv_id = node.conv_id AND up.depth = node.depth - 1
LEFT JOIN node AS parent ON parent.depth = up.depth AND parent.path = up.path
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(table(spark, sf_dir, "conversations"))


@query("op13_warc", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept
  FROM pages)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN kept END AS refers_to
FROM p
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
