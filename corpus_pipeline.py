"""The corpus pipeline: documents through five of the operators, one after another.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and hands the reread table on, so a lost executor costs a task and never a stage. All but the last return the columns
of ``docs``. Each works on all rows that its predecessor kept and handles nulls, empty and very long texts, repeated rows,
empty tables and further columns as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm._common import packed, table, written
from siftline.llm.decontaminate import decontaminate
from siftline.llm.line_dedup import line_dedup
from siftline.llm.near_dups import drop_near_duplicates
from siftline.llm.quality import LEAST_WORDS, quality_rules
from siftline.llm.sentencepiece_bpe import default_model, encode_decode


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(packed(docs), "row.text", "row.lang", "row.source")
    return judged.filter("kept").select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that an earlier one has; n_chars follows the text.

    A document that lost lines and has fewer than ``LEAST_WORDS`` words left goes, by the quality rules' own least length; so do
    copies of whole documents, of which little or nothing is left.
    """
    out = line_dedup(docs).filter((F.col("n_removed") == 0) | (F.size(F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))) >= LEAST_WORDS))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c].cast(kind) if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c, kind in docs.dtypes])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate(packed(docs), table(spark, sf_dir, "benchmark"), "row.text").filter(~F.col("contaminated")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, intact): the tokens of every document, and whether they decode to its text."""
    out = encode_decode(packed(docs), default_model(), "row.text")
    text = F.translate(F.coalesce(F.col("row.text"), F.lit("")), "▁", " ")
    return out.select("row.doc_id", "row.lang", "row.source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == text).alias("intact"))


STAGES = [("quality_rules", quality), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontamination), ("sentencepiece", tokens)]

#: SQL has neither SimHash nor the tokenizer's merge rules; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
