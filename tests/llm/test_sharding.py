import zlib

from siftline.llm import sharding as s


def check(rows, shards, out):
    assert len(out) == len(rows)
    assert sorted((r.size, r.text_crc32) for r in out) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    for k in range(shards):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    sizes = [sum(r.size for r in out if r.shard == k) for k in range(shards)]
    return max(sizes) - min(sizes), max(r.size for r in out)


def test_sizes_are_near_equal_and_slots_gapless(spark):
    rows = [(i, f"text {i} " * (i % 17)) for i in range(600)] + [(1000 + i, "copy of one text") for i in range(400)] + [(None, None), (5, "text 5 " * 5), (7, None), (9, "")]
    out = s.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    spread, largest = check(rows, 8, out)
    assert spread <= 2 * largest + 0.03 * sum(r.size for r in out) / 8


def test_hot_text_is_divided(spark):
    rows = [(i, "hot") for i in range(1000)]
    spread, largest = check(rows, 4, out := s.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect())
    assert spread <= 2 * largest and {r.shard for r in out} == {0, 1, 2, 3}


def test_small_groups_stay_together(spark):
    rows = [(i, f"some longer text {i // 2}") for i in range(4000)]
    out = s.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    homes = {}
    for r in out:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert max(map(len, homes.values())) == 1


def test_empty_table(spark):
    assert s.shard_by_bytes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
