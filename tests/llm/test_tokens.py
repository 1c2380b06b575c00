import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from siftline.llm import sentencepiece_bpe as sp


@pytest.fixture(scope="module")
def both():
    path = sp.default_model()
    with open(path, "rb") as f:
        return sp.Codec(f.read()), sentencepiece.SentencePieceProcessor(model_file=path)


def same(both, text):
    own, library = both
    ids = library.encode(text)
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids)


def test_random_texts(both):
    random.seed(1)
    alphabet = ["a", "b", "e", "the", " ", "  ", "\n", "▁", "é", "ß", "😀", "中", "<", "s", ">", "0", "1", "x0", "A", "ing", "\x00", "\t", "…", "²", "."]
    for _ in range(4000):
        same(both, "".join(random.choices(alphabet, k=random.randint(0, 30))))
    pieces = list(both[0].ids)
    for _ in range(3000):
        same(both, "".join(random.choices(pieces, k=random.randint(1, 8))).replace("▁", " "))


def test_runs_of_spaces_and_long_words(both):
    for k in range(70):
        same(both, " " * k + "x" + " " * k)
    same(both, "ab" * 20_000)
    same(both, "".join(random.Random(3).choices("aeinorstlh", k=30_000)))


def test_table(spark, both):
    rows = [(1, "Hello world"), (2, None), (3, ""), (4, "x" * 200_000), (5, "Hello world")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("mine"))
    out = {r.doc_id: r for r in sp.encode_decode(df, sp.default_model()).collect()}
    assert all(out[d].ids == both[1].encode(t or "") and out[d].decoded == (t or "") for d, t in rows)
    assert sp.encode_decode(df.limit(0), sp.default_model()).collect() == []


def test_unsupported_models_are_refused():
    with pytest.raises(Exception):
        sp.Codec(b"\x0a\x03\x0a\x01a")
