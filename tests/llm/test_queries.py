"""The registered queries, as the driver calls them: against their SQL, or against the contract computed another way."""

import glob
import hashlib
import os
import zlib

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

from siftline.llm import queries as q
from siftline.llm import simhash
from siftline.llm.sentencepiece_bpe import default_model

from ..test_catalog import rows
from .test_near_dups import brute_fingerprint, groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_its_sql(spark, tables, name):
    got, want = q.queries()[name](spark, SF).toPandas(), tables.execute(q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_op3_equals_brute_force(spark):
    texts = documents(spark)
    prints = {d: brute_fingerprint(t) for d, t in texts.items()}
    want = groups(sorted(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    out = simhash.op3_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {d: (f"{prints[d]:016x}", want[d]) for d in texts} and len(out) == len(texts)


def test_op4_keeps_its_law(spark):
    texts = documents(spark)
    out = q.queries()["op4_sharding"](spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in out} == {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts.items()}
    assert {(r.law, r.grown_shard) for r in out} == {("bytes", None)} and {r.shard for r in out} <= set(range(8))
    total, largest = sum(r.size for r in out), max(r.size for r in out)
    for k in range(8):
        own = [r for r in out if r.shard == k]
        assert sorted(r.slot for r in own) == list(range(len(own))) and abs(sum(r.size for r in own) - total / 8) <= largest + 0.02 * total / 8


def test_op4_with_clashing_names_and_a_very_long_text(spark):
    from siftline.llm import sharding

    df = spark.createDataFrame([(1, "x" * 2_000_000, 5), (2, "y", 6), (3, None, 7)], "doc_id long, text string, size int").withColumn("k", F.lit("own")).withColumn("r", F.lit(1))
    out = sharding.shard_by_bytes(df, 2).collect()
    assert sorted(r.size for r in out) == [1, 2, 2_000_001] and len(out) == 3


def test_op6_equals_the_library(spark):
    texts = documents(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=str(default_model()))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d, t in texts.items():
        ids = library.encode(t or "")
        want[d] = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in q.queries()["op6_sentencepiece"](spark, SF).collect()} == want
