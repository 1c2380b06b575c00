"""Sharding by sampled splitters: shards of nearly equal bytes.

Records are ordered by a sort key of the text's CRC-32 and a hash of the id, so equal texts stand next to each other. A
sample in which each record has a chance in proportion to its size gives quantiles of the key as splitters, and records
are range-partitioned by them. The exact size of every range is then counted; a range of over twice the aim is
subdivided at even steps of its key interval, again and again until none is overfull or a single key is left. Running sums
inside ranges, on top of the exact sizes of those before, give each record its place in the whole order, and a shard is an
equal share of all bytes. A cut that falls into a group of equal texts of at most ``snap`` of a shard moves to the
nearer end of the group, so that only groups too large for that are divided.

Native throughout. The ranges number about ``RANGES`` times the shards, or one per ``ROWS_PER_RANGE`` rows where that is
more, so no window is large; the driver holds splitters and sizes of ranges only (at most ``MAX_RANGES`` before subdivision).

Edge cases: a null text has size 1 and CRC 0; null ids sort first; repeated rows get slots of their own; an empty table
gives an empty table; input columns named like an output column are replaced.
"""

from __future__ import annotations

import bisect
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import table, written

RANGES, ROWS_PER_RANGE, MAX_RANGES, SAMPLES_PER_RANGE = 16, 1_000_000, 16_384, 50
SNAP = 0.01


def sized(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, k): k packs the CRC and 31 bits of a hash of the id."""
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    return out.withColumn("k", F.shiftleft("text_crc32", 31).bitwiseOR(F.xxhash64("doc_id").bitwiseAND(0x7FFFFFFF)))


def place_among(splitters: list[int], k: Column) -> Column:
    """How many splitters are at most ``k``: a binary search over a sorted literal array."""
    if not splitters:
        return F.lit(0)
    array = F.from_json(F.lit(json.dumps(splitters)), "array<bigint>")
    steps = F.sequence(F.lit(1), F.lit(len(splitters).bit_length() + 1))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def halve(s, _):
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        over = F.get(array, mid) > k
        return F.when(s["lo"] >= s["hi"], s).when(over, F.struct(s["lo"].alias("lo"), mid.alias("hi"))).otherwise(F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))

    return F.aggregate(steps, start, halve)["lo"]


def _sample(rows: DataFrame, total: int, wanted: int) -> list[int]:
    """Keys of a size-weighted sample of about ``wanted`` records, in order. Every record's chance is its share of the
    bytes times ``wanted``; a record that is due several times counts as often."""
    due = F.col("size") * (wanted / total)
    luck = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "k"), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor(due) + F.when(luck < due - F.floor(due), 1).otherwise(0)).cast("int")
    return sorted(r.k for r in rows.withColumn("times", times).filter("times > 0").select("k", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("k").collect())


def _ranges(rows: DataFrame, total: int, count: int, shards: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Splitters, and exact (bytes, rows) of each range between them, none overfull unless it is a single key."""
    aim_ranges = min(MAX_RANGES, max(shards * RANGES, -(-count // ROWS_PER_RANGE)))
    sample = _sample(rows, total, aim_ranges * SAMPLES_PER_RANGE)
    splitters = sorted({sample[len(sample) * i // aim_ranges] for i in range(1, aim_ranges)}) if sample else []
    aim, top = total / aim_ranges, 1 << 63
    while True:
        found = {r.r: (r.b, r.n) for r in rows.groupBy(place_among(splitters, F.col("k")).alias("r")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()}
        sizes = [found.get(i, (0, 0)) for i in range(len(splitters) + 1)]
        more = set()
        for i, (size, n) in enumerate(sizes):
            low, high = (splitters[i - 1] if i else 0), (splitters[i] if i < len(splitters) else top)
            parts = min(int(-(-size // aim)), high - low, 1024)
            if size > 2 * aim and n > 1 and parts > 1:
                # the keys of a hot group differ in their low half only: step to that half where the interval spans more
                more |= {low + (high - low) * p // parts for p in range(1, parts)}
                for crc in {low >> 31, (high - 1) >> 31}:
                    more |= {(crc << 31) + (p << 31) // parts for p in range(parts)}
        more = {m for m in more if 0 < m < top} - set(splitters)
        heavy = [i for i, (size, n) in enumerate(sizes) if size > 2 * aim and n > 1]
        if not heavy or not more:
            return splitters, sizes
        splitters = sorted({*splitters, *more})


def shard_by_bytes(df: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", snap: float = SNAP) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row."""
    rows = written(sized(df, doc_id, text), "sized")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not count:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    splitters, sizes = _ranges(rows, total, count, shards)
    before = [0]
    for size, _ in sizes:
        before.append(before[-1] + size)
    n_before = [0]
    for _, n in sizes:
        n_before.append(n_before[-1] + n)
    offsets = F.from_json(F.lit(json.dumps(before)), "array<bigint>")
    numbers = F.from_json(F.lit(json.dumps(n_before)), "array<bigint>")
    inside = Window.partitionBy("r").orderBy("k", "doc_id", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("r", place_among(splitters, F.col("k"))).withColumns({"begin": F.get(offsets, F.col("r")) + F.sum("size").over(upto) - F.col("size"), "at": F.get(numbers, F.col("r")) + F.row_number().over(inside) - 1})
    placed = written(placed.select("doc_id", "size", "text_crc32", "begin", "at"), "placed")
    # the group of equal texts that each cut falls into, and where it begins and ends
    aims = [total * i // shards for i in range(1, shards)]
    touched = F.exists(F.from_json(F.lit(json.dumps(aims)), "array<bigint>"), lambda a: (F.col("begin") <= a) & (a <= F.col("begin") + F.col("size")))
    groups = {r.text_crc32 for r in placed.filter(touched).select("text_crc32").collect()}  # two rows per cut at most
    spans = placed.filter(F.col("text_crc32").isin(*groups)).groupBy("text_crc32").agg(F.min("begin").alias("lo"), F.max(F.col("begin") + F.col("size")).alias("hi")).collect()
    spans = sorted((s.lo, s.hi) for s in spans)
    cuts = []
    for aim in aims:
        k = bisect.bisect_right(spans, (aim, 1 << 63)) - 1
        lo, hi = spans[k] if k >= 0 else (aim, aim)
        if lo < aim < hi and hi - lo <= snap * total / shards:
            aim = lo if aim - lo <= hi - aim else hi
        cuts.append(max(aim, cuts[-1] if cuts else 0))
    shard = place_among([c for c in cuts], F.col("begin"))
    firsts = {r.s: r.f for r in placed.groupBy(shard.alias("s")).agg(F.min("at").alias("f")).collect()}
    starts = F.from_json(F.lit(json.dumps([firsts.get(i, 0) for i in range(shards)])), "array<bigint>")
    out = placed.withColumn("shard", shard)
    return out.select("doc_id", "size", "text_crc32", F.col("shard").cast("int"), (F.col("at") - F.get(starts, F.col("shard"))).alias("slot"))


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
