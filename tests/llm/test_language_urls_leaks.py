import random
from itertools import combinations

import numpy as np

from siftline.llm import decontaminate as dc
from siftline.llm import language_id as li
from siftline.llm import url_filters as uf

STOP = {"en": "the of and to in is that with for was", "de": "der die und das ist nicht ein mit sich auf", "fr": "les des est dans pour que une sur avec pas"}


def texts(n, seed):
    random.seed(seed)
    return [(lang, " ".join(random.choices(words.split(), k=random.randint(12, 60)))) for lang, words in STOP.items() for _ in range(n)]


def test_language_held_out_accuracy_and_edges(spark):
    train = spark.createDataFrame(texts(40, 1) + [(None, "x y"), ("en", None), ("en", "")], "lang string, text string")
    content = li.dictionaries(train)
    assert sorted(content) == ["de", "en", "fr"] and all(len(c) <= li.DICTIONARY_BYTES for c in content.values())
    held = [(i, t, lang) for i, (lang, t) in enumerate(texts(20, 2))]
    edges = [(1000, None, ""), (1001, "", ""), (1002, "123 !!", ""), (1003, "der die das " * 30_000, "de")]
    df = spark.createDataFrame(held + edges, "doc_id long, text string, score string").withColumnRenamed("score", "lang")
    out = {r.doc_id: r for r in li.identify(df, content).collect()}
    assert np.mean([out[i].lang_pred == lang for i, _, lang in held]) >= 0.95
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (1000, 1001, 1002)) and out[1003].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in out.values())
    assert li.Classifier({}).predict("text") == ("und", 0.0) and li.Classifier({"en": b"the"}).predict("text") == ("en", 1.0)
    assert li.identify(df.limit(0), content).collect() == []


def test_url_rules_and_model(spark):
    urls = ["http://a.example.com/en/7", "http://example.com/en/8", "HTTP://X.NET/de/8", "http://example.net/de/8?x", "http://notcom/en/", "http://my.org/es/1", None, "no scheme", "http://casino.example.com/casino", "a://b://c/d", "http://example.com/en/7"]
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    out = {r.page_id: r for r in uf.filter_urls(df, uf.RULES).collect()}
    assert [out[i].rule for i in range(6)] == ["example.com/en/7", "com/en/", "net/de/", "example.net/de/8", None, "org/es/"]
    assert [out[i].verdict for i in (0, 1, 2, 3, 5)] == ["allow", "block", "allow", "block", "block"]
    assert (out[6].host, out[6].path, out[7].host) == ("", "", "") and out[8].verdict == "block" and (out[9].host, out[9].path) == ("b:", "//c/d")
    model = uf.train(uf.labelled_urls())
    for i, u in enumerate(urls):
        host, path = uf._parts(u)
        assert (out[i].host, out[i].path) == (host, path)
        assert out[i].logit_micro == model[1] + sum(model[0][k] for k in uf._features(host, path))
    right = sum((model[1] + sum(model[0][k] for k in uf._features(*uf._parts(u))) > 0) == bool(y) for u, y in uf.labelled_urls())
    assert right >= 0.95 * len(uf.labelled_urls())
    assert uf.filter_urls(df.limit(0), uf.RULES).collect() == []


def brute_stretch(agree, identity):
    n = len(agree)
    return max([0] + [j - i for i in range(n) for j in range(i + 1, n + 1) if sum(agree[i:j]) >= identity * (j - i) - 1e-9])


def test_longest_stretch():
    index = dc.Index([(1, "a b c d e f g")])
    random.seed(1)
    for _ in range(500):
        agree = [random.random() < 0.7 for _ in range(random.randint(1, 25))]
        assert index.longest(np.array(agree)) == brute_stretch(agree, dc.IDENTITY)


def test_leaks_with_substitutions(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(random.choices(words, k=random.choice([6, 14, 40])))) for i in range(60)]
    rows, want = [], {}
    for i, (item, text) in enumerate(items):
        w = text.split()
        if len(w) >= 14 and i % 2:
            for k in range(5, len(w), 11):
                w[k] = "changed"
        rows.append((i, f"{' '.join(random.choices(words, k=30))}\n{' '.join(w).upper()}, {' '.join(random.choices(words, k=30))}", "mine"))
        want[i] = [item]
    rows += [(100 + i, " ".join(random.choices(words, k=80)), None) for i in range(60)] + [(200, None, None), (201, "", None), (202, "w1 " * 50_000, None)]
    bench = spark.createDataFrame([*items, (900, None), (901, "too short")], "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string, contaminated string")
    for block_bytes in (dc.BLOCK_BYTES, 2000):
        out = {r.doc_id: r for r in dc.decontaminate(df, bench, block_bytes=block_bytes).collect()}
        assert all(out[i].contaminating_items == v for i, v in want.items())
        assert not any(out[d].contaminated for d, _, _ in rows if d >= 100)
    assert dc.decontaminate(df, bench.limit(0)).filter("contaminated").count() == 0
    assert dc.decontaminate(df.limit(0), bench).collect() == []


def test_every_allowed_choice_of_substitutions_is_hit():
    for n in range(5, 26):
        allowed = int(0.2 * n + 1e-9)
        masks = [[i for i, c in enumerate(m) if c == "1"] for m in dc.MASKS] if n >= dc.MIN_OVERLAP else dc.short_masks(n)
        placed = [sum(1 << (p + i) for i in m) for m in masks for p in range(n - (m[-1] if n >= dc.MIN_OVERLAP else n - 1))]
        for changed in combinations(range(n), allowed):
            bits = sum(1 << i for i in changed)
            assert any(not bits & m for m in placed), (n, changed)


def test_random_overlaps_at_the_limit_are_found():
    random.seed(9)
    words = [f"w{i}" for i in range(5000)]
    for n, substituted in [(5, 1), (11, 2), (12, 1), (12, 2), (13, 1), (13, 2), (16, 3), (20, 4), (40, 8)]:
        items = [(i, " ".join(random.choices(words, k=n))) for i in range(100)]
        index = dc.Index(items)
        for i, text in items:
            w = text.split()
            for k in random.sample(range(n), substituted):
                w[k] = "changed"
            assert (i, n) in index.overlaps(" ".join(["before"] * 9 + w + ["after"] * 9)), (n, substituted)


def test_short_items_are_matched_as_whole_lines(spark):
    bench = spark.createDataFrame([(1, "Yes"), (2, "the red fox"), (3, "!?")], "item_id long, text string")
    rows = [(1, "so\nthe RED fox!\nruns"), (2, "the red fox runs"), (3, "yes"), (4, "oh yes"), (5, "!?"), (6, None)]
    out = {r.doc_id: r.contaminating_items for r in dc.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert out == {1: [2], 2: [], 3: [1], 4: [], 5: [], 6: []}


def test_registered_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, dc.tokens(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    numbers: dict = {}
    code = lambda ws: np.array([numbers.setdefault(w, len(numbers)) for w in ws], np.int64)
    index = dc.Index([])
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        doc, hits = code(dc.tokens(r.text)), []
        for item, w in items:
            own = code(w)
            need = min(dc.MIN_OVERLAP, len(own))
            for shift in range(need - len(own), len(doc) - need + 1):
                a, b = max(0, -shift), min(len(own), len(doc) - shift)
                agree = own[a:b] == doc[shift + a : shift + b]
                if agree.sum() >= dc.IDENTITY * need and index.longest(agree) >= need:
                    hits.append(item)
                    break
        want[r.doc_id] = sorted(hits)
    out = {r.doc_id: r for r in dc.op9_decontaminate(spark, sf).collect()}
    assert {d: [int(x) for x in r.item_ids.split(",") if x] for d, r in out.items()} == want
    assert {d for d, r in out.items() if r.contaminated} == {d for d, h in want.items() if h} and any(want.values())


def test_url_model_on_urls_it_has_not_seen(spark):
    shapes = [("my", "", "start"), ("top-", "", "x/1"), ("the", "site", "en/9")]
    held = [(f"https://{a}{t}{c}.example.com/{b}", y) for y, ts in ((1, uf._UNWANTED), (0, uf._WANTED)) for t in ts for a, c, b in shapes]
    assert not {u for u, _ in held} & {u for u, _ in uf.labelled_urls()}
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)] + [(9999, "http://" + "ab." * 20_000 + "com/x")], "page_id long, url string")
    out = {r.page_id: r.verdict for r in uf.filter_urls(df, []).collect()}
    assert np.mean([(out[i] == "block") == bool(y) for i, (_, y) in enumerate(held)]) >= 0.9 and 9999 in out
    unseen = ["https://gambling-hub.com/", "https://x.com/slots777/bonus", "http://sexcams.net/live", "https://buy-cheap-pills.org"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(unseen)], "page_id long, url string")
    assert uf.filter_urls(df, []).filter("verdict = 'block'").count() == len(unseen)


def test_numerals_and_marks_are_no_letters():
    model = li.Classifier({"en": b"the of and", "de": b"der die das"})
    for text in ("\u00bd \u2167", "\u00b2", "123", "_ _", "\u0301"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("\u00bd der die")[0] == "de"


def test_language_accuracy_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = li.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert len(out) > 200 and np.mean([r.lang_pred == r.lang for r in out]) >= 0.95
