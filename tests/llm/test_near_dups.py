import random

import pytest
import xxhash
from pyspark.sql import functions as F

from siftline.llm import components, near_dups
from siftline.llm import simhash as s


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed=5):
    random.seed(seed)
    words = ["w%d" % i for i in range(300)]
    texts = []
    for _ in range(12):
        base = random.choices(words, k=random.randint(30, 120))
        for k in range(6):
            copy = list(base)
            for _ in range(k // 2):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy))
    return texts + [None, "", " \n", "one", "ONE", "a b c", texts[0], "lang " * 20_000]


@pytest.mark.parametrize("text", [None, "", "a", "A b\tc", "a b c d", "a b c d e f g A b"])
def test_fingerprint(text):
    assert s.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("tile", [4096, 2])
def test_simhash_components_match_brute_force(spark, tile):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("fp", F.lit("mine"))
    out = {r.doc_id: r for r in s.near_duplicates(df, tile=tile).collect()}
    prints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: int(r.fingerprint, 16) for i, r in out.items()} == prints
    want = groups(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {i: r.component_id for i, r in out.items()} == want


def test_bk_tree_finds_all_within_radius():
    random.seed(1)
    values = [random.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for v in values for _ in range(3)]
    tree = s.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:40]:
        assert sorted(tree.within(v, 4)) == sorted(x for x in values if (x ^ v).bit_count() <= 4)


@pytest.mark.parametrize("tile", [2048, 2])
def test_similarity_groups_match_brute_force(spark, tile):
    texts = corpus(9)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    want = groups(range(len(texts)), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    got = {r.d: r.root for r in near_dups.near_duplicate_groups(df, tile=tile).collect()}
    assert got == want


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "z"), (None, None, None), (9, "", "w"), (5, "q r s t u v w", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sig string")
    out = near_dups.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 5), (True, 0)]
    assert near_dups.drop_near_duplicates(df.limit(0)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + k) for k in range(1, 60)] + [(7, 7)]
    out = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(out.values()) == {0, 1000} and out[40] == 0 and out[1059] == 1000
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_texts_with_a_repeated_line_are_linked(spark):
    random.seed(12)
    rows = []
    for k in range(60):
        base = [f"v{random.randrange(10**6)}" for _ in range(1000)]
        tail = [f"t{random.randrange(10**6)}" for _ in range(8)]
        rows += [(2 * k, " ".join(base + tail)), (2 * k + 1, " ".join(base + tail * 40))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.d: r.root for r in near_dups.near_duplicate_groups(df).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}


def test_unlike_texts_with_a_null_or_repeated_id_stay(spark):
    texts = [" ".join(f"{x}{i}" for i in range(40)) for x in "abcdefgh"]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:]] + [(None, texts[0] + " end"), (8, texts[5])]
    out = near_dups.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 8 and {r.text.split()[0] for r in out} == {t.split()[0] for t in texts}


def test_groups_of_a_whole_table_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets, holders = {}, {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {hash(tuple(w[i : i + 5])) for i in range(max(1, len(w) - 4))}
        for x in sets[d]:
            holders.setdefault(x, []).append(d)
    shared: dict = {}
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    linked = {p for p, n in shared.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    for options in ({}, {"tile_bytes": 1 << 16}):
        got = {r.d: r.root for r in near_dups.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()}
        assert sum(got[a] == got[b] for a, b in linked) >= 0.98 * len(linked)
        assert all(find(d) == find(r) for d, r in got.items())
