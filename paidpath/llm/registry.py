"""Queries of the training-data operators, and the SQL of those that SQL can express.

A query reads its whole tables with production parameters and derives the columns of its
result; the operators have their own interfaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paidpath.llm import (crossentropy, decontaminate, infilling, jaccard, langid, lexical, neighbours, passages, quality,
                          sentencepieces, sharding, tokencounts, warc)
from paidpath.llm.tables import crc_of_id, read


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.tokenised(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.pmod(crc_of_id(), F.lit(4)) == 2
    rows = langid.identified(docs.select("doc_id", "text"), langid.fit(docs.where(~held_out)))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
                       F.col("lang_bits").alias("bits"), F.col("lang_accepted").alias("accepted"))


def op3_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1")
    return crossentropy.cross_entropy_difference(read(spark, sf_dir, "documents", "doc_id", "text"), good)


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_spans(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffled(read(spark, sf_dir, "documents", "doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infilling.infilled(read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", "text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256(F.col("output")).alias("output_sha256"),
                       _sha256(infilling.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokencounts.counted(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                       (F.col("n_tokens") > 1024).alias("over_limit"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_language_id, op3_cross_entropy, op4_neighbours, op5_jaccard_join, op6_warc, op7_repeated_passages,
    op8_quality, op9_decontamination, op10_sharding, op11_fill_in_middle, op12_token_counts,
    op13_ranked_search)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op5_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS t FROM sized),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS class_id, count(*) AS n_copies FROM sized WHERE n > 0 GROUP BY 1)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, c.component_id, coalesce(k.class_id, d.doc_id) AS class_id,
  CAST(coalesce(k.n_copies, 1) AS BIGINT) AS n_copies
FROM sized d JOIN component c ON c.x = d.doc_id LEFT JOIN classes k ON k.s = list_sort(d.s)""",
    "op6_warc": r"""
WITH digests AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
leaders AS (SELECT hex, max(page_id) AS leader FROM digests GROUP BY hex)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = leader THEN NULL ELSE leader END AS refers_to
FROM digests JOIN leaders USING (hex)""",
    "op9_decontamination": rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS t
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT DISTINCT size FROM windows))),
found AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON v.t = p.t AND v.size = p.size),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_fill_in_middle": r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM units),
formed AS (
  SELECT doc_id, t, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
  FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
    "op13_ranked_search": rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, corpus GROUP BY term, n_docs),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), corpus GROUP BY item_id, doc_id),
ranks AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 20""",
}
