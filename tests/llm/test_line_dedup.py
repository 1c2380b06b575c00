import random
import time
from collections import defaultdict

import regex
import xxhash
from pyspark.sql import functions as F

from siftline.llm import line_dedup as ld


def sentence(n):
    return (" ".join("".join(random.choices("abcdefghijk", k=random.randint(2, 7))) for _ in range(n))).capitalize() + "."


def body(n):
    return " ".join(sentence(random.randint(4, 14)) for _ in range(n))


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {(r.row.doc_id, r.row.text): r for r in ld.line_dedup(df, **options).collect()}


def test_lines_put_together_are_the_text(spark):
    texts = ["", "a", "a.b. c!\n\n d?? e", "\n\n", ". . .", "no end", "x\ty.\r\nz", "…é. ü"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(F.array_join(ld.lines(F.col("t")), "") != F.col("t")).count() == 0


def test_shared_passages_go_and_other_text_stays(spark):
    random.seed(2)
    rows, own = [], {}
    for k in range(20):
        passage = body(14)
        for j in range(4):
            a, b = body(6), body(6)
            rows.append((len(rows), f"{a} {passage} {b}" if j % 2 else f"{a}\n{passage}"))
            own[len(rows) - 1] = (passage, a, b if j % 2 else "")
    clean = [(1000 + i, body(20)) for i in range(20)]
    out = {r.row.doc_id: r for r in run(spark, rows + clean).values()}
    assert all(out[d].text == t for d, t in clean)
    for d, (passage, a, b) in own.items():
        if d % 4 == 0:
            assert out[d].n_removed == 0
        else:
            assert out[d].removed_chars >= 0.5 * len(passage)
            assert out[d].text.startswith(a[:20]) and out[d].text.endswith(b[-20:])


def test_edges(spark):
    random.seed(3)
    t = body(12)
    rows = [(1, t), (1, t), (2, t), (None, t), (None, None), (3, None), (4, ""), (5, "short. short."), (6, ("Same words here again. " * 30)), (2, "other text entirely. " + body(8))]
    out = run(spark, rows)
    assert out[(None, t)].n_removed == 0 and out[(1, t)].text == "" and out[(2, t)].text == ""
    assert out[(6, rows[8][1])].text == rows[8][1] and out[(3, None)].text is None and out[(2, rows[9][1])].n_removed == 0
    assert run(spark, []) == {}


def test_one_hash_for_different_texts_is_settled_by_bytes(spark, monkeypatch):
    random.seed(4)
    a, b = body(6), body(6)
    rows = [(1, a), (2, b), (3, a), (4, b)]
    real = ld.chunks
    # all chunks of the same place share a hash
    monkeypatch.setattr(ld, "chunks", lambda *x: real(*x).withColumn("h", F.col("se")))
    out = {k[0]: r for k, r in run(spark, rows).items()}
    assert out[1].text == a and out[2].text == b and out[3].text == "" and out[4].text == ""


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "b", 2)], "doc_id long, text string, t string, u int")
    assert ld.line_dedup(df).select("row.*").first() == df.first()


def cut_into(passage, n):
    """``passage`` (words) as ``n`` lines of about equal length."""
    return " ".join(" ".join(passage[len(passage) * k // n : len(passage) * (k + 1) // n]) + "." for k in range(n))


def test_passages_of_51_words_go_however_few_their_lines(spark):
    random.seed(8)
    word = lambda: "".join(random.choices("abcdefghijk", k=random.randint(2, 7)))
    words = lambda n: [word() for _ in range(n)]
    rows, kinds = [], {}
    for n in (0, 1, 2, 3, 4, 5, 25):  # 0: in the middle of a line
        for _ in range(40):
            passage = words(51)
            text = cut_into(passage, n) if n else " ".join(passage)
            for j in range(2):
                a, b = (" ".join(words(30)), " ".join(words(30)) + ".") if n == 0 else (body(4), body(4))
                if j:
                    kinds[len(rows)] = (n, len(text))
                rows.append((len(rows), f"{a} {text} {b}"))
    out = {r.row.doc_id: r for r in run(spark, rows).values()}
    share = {n: [out[d].removed_chars / size for d, (k, size) in kinds.items() if k == n] for n, _ in kinds.values()}
    print({n: (sum(x == 0 for x in s), round(sum(s) / len(s), 3)) for n, s in share.items()})
    assert all(min(s) > 0 for n, s in share.items() if n > 1) and all(sum(x == 0 for x in s) <= 2 for s in share.values())
    assert all(sum(s) / len(s) > (0.75 if n else 0.6) for n, s in share.items())
    assert all(out[d].n_removed == 0 for d in range(0, len(rows), 2))


def brute_lines(text):
    return [x for x in regex.findall(ld._LINE, text) if x]


def brute(rows, min_chars=ld.MIN_CHARS):
    """(doc_id, text) -> what is left, from the definition: chunks compared as texts, nothing hashed but boundaries."""
    spans, holders = {}, defaultdict(set)
    for d, t in rows:
        u = brute_lines(t or "")
        h = [xxhash.xxh64_intdigest(x.rstrip(" \n\t\r\f\v").encode(), 42) for x in u]
        h = [x - (1 << 64) if x >> 63 else x for x in h]
        cuts = [i for i in range(len(u)) if i == 0 or i + 1 == len(u) or len(u[i]) >= min_chars or h[i] <= h[i - 1] or h[i] <= h[i + 1]]
        enough = lambda i, j: sum(map(len, u[i : j + 1])) >= min_chars
        found = {(i, next((j for j in cuts[k + 1 :] if enough(i, j)), None)) for k, i in enumerate(cuts)}
        if cuts:
            found |= {(next((i for i in cuts[-2::-1] if enough(i, cuts[-1])), None), cuts[-1])} - {(cuts[-1], None)}
        spans[d, t] = [(i, j, "".join(u[i : j + 1]).rstrip(" \n\t\r\f\v")) for i, j in found if None not in (i, j)]
        for *_, txt in spans[d, t]:
            holders[txt].add(d)
    left = {}
    for d, t in rows:
        gone = {x for i, j, txt in spans[d, t] if min(holders[txt]) < d for x in range(i, j + 1)}
        left[d, t] = "".join(x for i, x in enumerate(brute_lines(t)) if i not in gone) if gone else t
    return left


def test_removed_chunks_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    random.seed(21)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    passages = ["a\nb\n\nc.\n" * 9, body(5), " ".join("abcdefgh"[i % 8] * 3 for i in range(60)), "".join(random.choices("\u4e00\u4e8c\u4e09\u56db\u3002\uff0c", k=200))]
    rows += [(10_000 + i, f"{body(3)} {passages[i % 4]} {body(2)}") for i in range(16)] + [(20_000, "tiny\n" * 40), (20_001, "x " + "tiny\n" * 40)]
    out = {k: r.text for k, r in run(spark, rows).items()}
    assert out == brute(rows)
    assert sum(out[k] != k[1] for k in out) > 12


def test_two_documents_of_100_000_lines(spark):
    text = "".join(f"line {i} of a long text\n" for i in range(100_000))
    out = run(spark, [(1, text), (2, text), (3, text[: len(text) // 2])])
    assert out[(1, text)].text == text and out[(2, text)].text == "" and out[(2, text)].n_removed == 100_000
    assert len(out[(3, text[: len(text) // 2])].text) < 100
    df = spark.createDataFrame([(1, text)], "d long, text string")
    times = []
    for n in (1, 4):
        began = time.time()
        assert ld.chunks(df.withColumn("text", F.repeat("text", n))).count() > 40_000 * n
        times.append(time.time() - began)
    assert times[1] < 10 * times[0] + 2  # in proportion, not its square
