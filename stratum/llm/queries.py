"""Registered queries of the numbered operators, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (bpe, decontaminate, divergence, fp_tree, hmm_lm, jaccard_join, langid, license_join,
                         poisson_mix, prefix_hash, secret_scan, warc, whitening)
from stratum.llm.common import residue, scratch_path, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def as_doc_id(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("id", "doc_id")


def language_model(docs: DataFrame) -> langid.Model | None:
    return langid.train(docs.where(residue("doc_id", 5) != 0), F.col("doc_id"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = as_doc_id(langid.identify(docs, language_model(docs)))
    return found.select("doc_id", (residue("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return as_doc_id(found.select("id", "class_id", "n_links"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doc_id(secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents"))))


def op4_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doc_id(hmm_lm.score_documents(table(spark, sf_dir, "documents"), residue("doc_id", 7) == 2))


def op5_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doc_id(prefix_hash.compare_with_next(table(spark, sf_dir, "documents")))


def op6_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doc_id(license_join.digests(license_join.find_licenses(table(spark, sf_dir, "documents"))))


def op7_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return as_doc_id(divergence.judge(docs, divergence.learn_references(docs)))


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(pages, path)
    return warc.read_archives(spark, path, pages.schema["page_id"].dataType.simpleString())


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = poisson_mix.replicate(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.round(poisson_mix.RATE, 9).alias("rate"),
                        F.col(poisson_mix.COPIES).cast("bigint").alias("copies"),
                        F.col(poisson_mix.COPY).cast("bigint").alias("copy"),
                        F.md5("text").alias("text_md5"), F.col(poisson_mix.ORDER).alias("shuffle_key"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doc_id(bpe.digests(encoded(table(spark, sf_dir, "documents"))))


def op11_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = as_doc_id(fp_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return as_doc_id(decontaminate.digests(found)).drop("spans")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def encoded(docs: DataFrame) -> DataFrame:
    return bpe.encode_documents(docs, bpe.read_ranks(public_tokenizers.path(VOCABULARY)),
                                public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_ngram_jaccard_join, op3_secret_scan, op4_hmm_scores, op5_prefix_hashes,
    op6_license_join, op7_quality_divergence, op8_warc_segments, op9_poisson_mix, op10_byte_bpe,
    op11_fp_tree_search, op12_benchmark_decontamination, op13_embedding_whitening)}

#: DuckDB: the words of a text, A-Z lower-cased.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE_SQL = {
    "op8_warc_segments": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
owners AS (
  SELECT payload_digest, max(page_id) AS owner FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN p.page_id < o.owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < o.owner THEN o.owner END AS refers_to
FROM p LEFT JOIN owners o ON o.payload_digest = p.payload_digest AND p.payload_bytes >= 1000""",
    "op9_poisson_mix": """
WITH RECURSIVE sources AS (SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
rates AS (
  SELECT source, w / (SELECT sum(w) FROM sources) * (SELECT sum(n) FROM sources) / n AS rate FROM sources),
hashed AS (
  SELECT d.doc_id, d.source, d.text, r.rate,
         md5(concat_ws('|', coalesce(CAST(d.doc_id AS VARCHAR), ''), coalesce(d.text, ''), coalesce(d.lang, ''),
                       coalesce(d.source, ''), coalesce(CAST(d.n_chars AS VARCHAR), ''))) || '|' ||
           CAST(row_number() OVER (PARTITION BY d.doc_id, d.text, d.lang, d.source, d.n_chars) AS VARCHAR) AS hash
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
drawn AS (
  SELECT *, CAST(('0x' || substr(md5('mix|' || hash || '|1'), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM hashed),
terms(source, rate, k, term, total) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM terms WHERE k < 63),
counted AS (
  SELECT d.doc_id, d.source, d.text, d.hash, d.rate, count(t.k) AS copies
  FROM drawn d JOIN terms t ON t.source IS NOT DISTINCT FROM d.source AND t.total <= d.u
  GROUP BY ALL)
SELECT doc_id, source, round(rate, 9) AS rate, copies, copy, md5(text) AS text_md5,
       md5('mix-order|' || hash || '|' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted) t""",
    "op11_fp_tree_search": f"""
WITH doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
totals AS (SELECT count(*) AS docs, sum(len(words)) AS all_words FROM doc_words WHERE len(words) > 0),
norms AS (SELECT r, doc_id, 75 + (25 * len(words) * docs) // all_words AS m FROM doc_words, totals WHERE len(words) > 0),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM doc_words) t GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, docs),
item_terms AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS i, item_id, unnest({_WORDS}) AS term FROM benchmark) t GROUP BY ALL),
scores AS (
  SELECT i, item_id, r, n.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN tfs USING (term) JOIN norms n USING (r) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op12_benchmark_decontamination": f"""
WITH doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, words[p:p + least(len(words), 10) - 1] AS run
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p FROM item_words WHERE len(words) > 0) t),
doc_runs AS (
  SELECT r, p, size, words[p:p + size - 1] AS run
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS p
        FROM doc_words, (SELECT DISTINCT size FROM windows) s) t),
hits AS (SELECT r, p, d.size, item_id FROM doc_runs d JOIN windows w ON d.size = w.size AND d.run = w.run),
hit_words AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(p, p + size)) AS place FROM hits) t GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) t GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words h USING (r) LEFT JOIN hit_items i USING (r)""",
}
