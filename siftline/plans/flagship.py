"""The minimum slice: documents through lane routing, native quality flags, exact deduplication and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_CHARS, MAX_CHARS, MIN_ALNUM = 50, 3_000_000, 0.45


def lane(text):
    """table, multiline (3 non-blank lines or more) or normal."""
    pipe = text.rlike(r"(?m)^\s*\|.*\|\s*$") & text.rlike(r"(?m)^\s*\|?\s*:?-{3,}")
    lines = F.size(F.filter(F.split(text, "\n"), lambda line: F.regexp_replace(line, r"\s", "") != ""))
    return F.when(pipe, "table").when(lines >= 3, "multiline").otherwise("normal")


def corpus_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "n_chars")
    docs = docs.filter(F.col("text").isNotNull() & F.length("text").between(MIN_CHARS, MAX_CHARS))
    alnum = F.length(F.regexp_replace("text", r"[^\p{L}\p{N}]", "")) / F.length("text")
    docs = docs.filter(alnum >= MIN_ALNUM).select("doc_id", lane(F.col("text")).alias("lane"), "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))
    # a partial aggregate keeps the lowest id of each text before the shuffle, so no group of copies meets in one task
    kept = F.min(F.struct("doc_id", "lane", "source", "n_chars"))
    return docs.groupBy("text_sha256").agg(kept.alias("k")).select("k.*", "text_sha256")


SQL = r"""
SELECT doc_id, lane, source, n_chars, text_sha256 FROM (
  SELECT doc_id, source, n_chars, sha256(text) AS text_sha256,
         CASE WHEN regexp_matches(text, '(?m)^\s*\|.*\|\s*$') AND regexp_matches(text, '(?m)^\s*\|?\s*:?-{3,}') THEN 'table'
              WHEN len(list_filter(string_split(text, chr(10)), lambda l: regexp_replace(l, '\s', '', 'g') <> '')) >= 3 THEN 'multiline' ELSE 'normal' END AS lane,
         row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn
  FROM documents WHERE length(text) BETWEEN 50 AND 3000000
    AND length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))::DOUBLE / length(text) >= 0.45) WHERE rn = 1"""

QUERIES = {"flagship_corpus_slice": (corpus_slice, SQL)}
