from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftline.llm import quality as q

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if __import__("re").search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a b c a b c", "a a a a a a", "x\nx\n\nx", "é\u00a0ü # $", "a b c d a b c", "l1 \nl1 \nl1"])
def test_measures_match_brute_force(text):
    n, chars, symbols, _, dup, repeated = q.measures(text)
    assert (n, chars, symbols, dup, repeated) == brute(text)


def test_adaptive_thresholds_and_edges(spark):
    plain = " ".join(f"word{i} plain" for i in range(60))
    junk = " ".join(f"w{i}***" for i in range(120))
    rows = [(i, f"{plain} {i}", "en", "a") for i in range(80)] + [(100, junk, "en", "a"), (101, None, None, None), (102, "", "en", "b"), (103, f"{plain} 5", None, None), (5, f"{plain} 5", "en", "a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"kept": F.lit("mine"), "n_words": F.lit(-1)})
    out = q.quality_rules(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].kept for i in range(80)) and by[103].kept
    assert not by[100].kept and "symbol_rate_high" in by[100].reasons and not by[100].base_failed
    assert by[101].base_failed and by[102].base_failed and by[101].n_words == 0


def test_groups_of_different_distributions_judge_one_document_differently(spark):
    text = lambda i, k: " ".join(f"{'words' if (j + i) % 10 < 10 - k else 'word&'}{i:04d}x{j:02d}" for j in range(100))
    plain = [(i, text(i, 0), "en", "plain") for i in range(1600)]
    code = [(3000 + i, text(i, i % 8), "en", "code") for i in range(400)]
    same = text(1500, 6)
    out = {r.doc_id: r for r in q.quality_rules(spark.createDataFrame([*plain, *code, (1, same, "en", "plain"), (2, same, "en", "code")], SCHEMA)).collect() if r.text == same}
    assert not out[1].kept and out[1].reasons == ["symbol_rate_high"] and out[2].kept
    fences = {(r.lang, r.source): r.fences for r in q.thresholds(q.sketches(q.measure(spark.createDataFrame([*plain, *code], SCHEMA)))).collect()}
    assert fences["en", "plain"]["symbol_rate"].high < 600 < fences["en", "code"]["symbol_rate"].high


def test_very_long_text_ties_and_clashing_names(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, long, "en", "a"), (2, "x y z " * 50_000, "en", "a")] + [(3, " ".join(f"t{i}" for i in range(60)), "en", "a")] * 3
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"__l": F.lit("own"), "__fences": F.lit(7), "N_WORDS": F.lit(0)})
    out = q.quality_rules(df).collect()
    assert {r["__l"] for r in out} == {"own"} and {r["__fences"] for r in out} == {7}
    assert [r.kept for r in out if r.doc_id == 3] == [True] * 3 and all(r.kept for r in out if r.doc_id == 1) and all(r.base_failed for r in out if r.doc_id == 2)


def test_empty_table_and_join_without_broadcast(spark):
    assert q.quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(i, " ".join(f"w{j}" for j in range(60)), "en", "a") for i in range(5)]
    measured = q.measure(spark.createDataFrame(rows, SCHEMA))
    fences = q.thresholds(q.sketches(measured))
    assert q.judge(measured, fences, max_broadcast=0).filter("kept").count() == 5
