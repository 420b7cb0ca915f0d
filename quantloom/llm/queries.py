"""The registered queries of the operators: production parameters, whole tables, fixed result columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, language_id, quality, toxicity, warc
from .alignment import align
from .exact_dedup import exact_dedup
from .embedding_dedup import near_vectors
from .language_id import held_out
from .lm_scoring import cross_entropy_difference
from .near_dedup import near_dedup
from .packing import pack
from .spelling import spelling_variants
from .tables import Workspace
from .token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, arg_max(doc_id, (length(text), -doc_id)) AS keep_id FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


@query
def op2_minhash_near_dedup(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"), width=3, percent=85, bands=20, rows=5)


@query
def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_packing(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "input_ids")


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text").where(~held_out()).join(labels, "doc_id"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "spans")


@query
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out()))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query
def op6_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_bpe(spark, sf_dir):
    automaton = bpe.Automaton.compile(public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), automaton, public_tokenizers.PATTERN), automaton)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_lm_scoring(spark, sf_dir):
    """Target: the documents labelled as good. Background: all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query
def op11_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    weights = quality.train(docs.select("doc_id", "text").where(~quality.held_out()).join(labels, "doc_id"))
    found = quality.score(docs, weights)
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted", "n_features")


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS tab
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
grouped AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 5 GROUP BY ALL),
coded AS (
  SELECT doc_id, run, c, tab, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195, ord(x)::BIGINT - 64] END)) AS bytes
  FROM grouped, crc_table),
hashed AS (
  SELECT run, c, length(run) AS size,
    xor(list_reduce(bytes, lambda h, b: xor(h // 256, tab[xor(h % 256, b) + 1]), 4294967295), 4294967295) AS h
  FROM coded),
cut AS (
  SELECT c, CASE WHEN h % 97 = 0 THEN left(run, (h % size)::BIGINT) || substr(run, (h % size)::BIGINT + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
parts AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT p.word AS a, p.n AS an, w.word AS b, w.n AS bn FROM parts p JOIN words w ON w.word = p.rest),
near AS (
  SELECT p.word AS a, q.word AS b, q.n AS bn FROM parts p JOIN parts q ON p.i = q.i AND p.rest = q.rest AND p.word <> q.word
  UNION ALL SELECT a, b, bn FROM shorter UNION ALL SELECT b, a, an FROM shorter),
best AS (
  SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, b) AS b, max(bn) AS bn FROM near GROUP BY a),
known AS (
  SELECT word, CASE WHEN bn >= 2 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * n THEN bn END AS form_n
  FROM words LEFT JOIN best ON a = word),
chain AS (
  SELECT word, form AS at FROM known WHERE form IS NOT NULL
  UNION ALL SELECT c.word, k.form FROM chain c JOIN known k ON k.word = c.at WHERE k.form IS NOT NULL),
ends AS (SELECT c.word, c.at FROM chain c JOIN known k ON k.word = c.at WHERE k.form IS NULL)
SELECT k.word, k.form, coalesce(e.at, k.word) AS root, k.n, k.n_near, k.form_n FROM known k LEFT JOIN ends e USING (word)
"""


@query
def op13_tokenizer_alignment(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_warc_audit(spark, sf_dir):
    """All pages as WARC files, a replica of them with known damage, and the audit of the two."""
    work = Workspace(spark, "replicas")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    place = work.path()
    first, second = f"{place}/first", f"{place}/second"
    warc.write_warc(pages, {first: lambda p, own: p, second: warc.damaged}, compress=True)
    return warc.audit(spark, f"{place}/replica=first", f"{place}/replica=second")


ORACLES["op9_warc_audit"] = r"""
WITH both_sides AS (
  SELECT page_id, url, coalesce(html, '') AS html,
    CASE WHEN page_id % 50 = 7 AND length(html) > 0 THEN
      left(html, length(html) // 2) || CASE WHEN html[length(html) // 2 + 1] = '#' THEN '*' ELSE '#' END || html[length(html) // 2 + 2:]
    ELSE coalesce(html, '') END AS hurt,
    page_id // 1024 AS segment, md5(page_id::VARCHAR) AS m
  FROM pages),
head AS (
  SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:' ||
    substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21) || '>' || chr(13) || chr(10) ||
    'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) ||
    'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS h, chr(13) || chr(10) || chr(13) || chr(10) AS gap
  FROM both_sides),
bytes AS (
  SELECT *, h || strlen(html)::VARCHAR || gap || html || gap AS a, h || strlen(hurt)::VARCHAR || gap || hurt || gap AS b FROM head),
placed AS (
  SELECT *, coalesce(sum(strlen(a)) OVER (PARTITION BY segment ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_a
  FROM bytes),
first AS (SELECT segment, page_id, start_a, strlen(a) AS length, url AS uri, sha256(a) AS digest FROM placed),
second AS (SELECT page_id, sha256(b) AS digest FROM placed WHERE page_id % 1024 <> 1023)
SELECT segment, CAST(start_a AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, uri,
  CASE WHEN s.digest IS NULL THEN 'missing' ELSE 'changed' END AS status, f.digest AS first_digest, s.digest AS second_digest
FROM first f LEFT JOIN second s USING (page_id)
WHERE f.digest IS DISTINCT FROM s.digest
"""
