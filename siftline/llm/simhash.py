"""SimHash near-duplicates with BK-trees.

Every document gets a 64-bit fingerprint of its word shingles (a bit is set if it is in over half of the shingles'
XXH64 values); documents whose fingerprints differ in at most ``radius`` bits are linked, and components of links are
the groups. Equal fingerprints are one vertex, so copies are never expanded into pairs.

Links: of radius + 1 bands of a fingerprint, two linked fingerprints share at least one whole, so each (band, value) is a
shard and no link is lost. In each shard a BK-tree holds the fingerprints (children keyed by their integer Hamming
distance to the parent); a search follows only edges within the radius of its distance. Each shard hands on a spanning
forest of its links, not all pairs.

Scale: shards of more than ``TILE`` fingerprints are split into tiles. Every pair of tiles is a task of its own with the
tree of one tile (broadcast to the tasks of all others through the shuffle) and the probes of the other, so a shard in
which a third of all fingerprints meet is spread out, whole. The number of (band, value) keys is bounded by
(radius + 1) * 2^(bits of a band), so the table of tile counts is broadcast.

Edge cases: null texts and texts without words have fingerprint zero and are linked like others; repeated rows and ties
share their group; an empty table gives an empty table; input columns named like an output column are replaced.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounded_batches, table, written
from .components import components

BITS, TILE = 64, 4096


def shingle_hashes(text: str | None, words: int, seed: int = 42):
    """XXH64 of each shingle of ``words`` words, repeats included, as the rows of an array of bytes; a shorter text is a
    single shingle, and a text without words has none."""
    import numpy as np
    import xxhash

    parts = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return np.zeros((0, 8), np.uint8)
    line = b" ".join(parts)
    digest = xxhash.xxh64_digest
    ends = list(accumulate(map(len, parts), lambda a, b: a + b + 1))
    starts = [0, *[e + 1 for e in ends[: max(0, len(ends) - words)]]]
    view = memoryview(line)
    return np.frombuffer(b"".join([digest(view[a:b], seed) for a, b in zip(starts, ends[words - 1 :] or ends[-1:])]), np.uint8).reshape(-1, 8)


def fingerprint_of(hashes) -> int:
    import numpy as np

    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[i : i + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the shingles of ``words`` words, repeats included; zero if there are no words."""
    return fingerprint_of(shingle_hashes(text, words, seed))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """``df`` without its text, with the fingerprint as a signed 64-bit column ``fp``; no shuffle."""
    bounded_batches(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name.lower() != "fp"]
    df = df.select(*[f.name for f in fields])
    names = [f.name for f in fields if f.name != text]

    def run(batches):
        for batch in batches:
            own = [signed(fingerprint(x.as_py(), words)) for x in batch.column(batch.schema.get_field_index(text))]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(own, pa.int64())], names=[*names, "fp"])

    return df.mapInArrow(run, T.StructType([*[f for f in fields if f.name != text], T.StructField("fp", T.LongType())]))


class BKTree:
    """Fingerprints by distance: a node is [value, {distance: child}]."""

    def __init__(self):
        self.root = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = [value, {}]
                return
            node = child

    def within(self, value: int, radius: int):
        """All values at most ``radius`` away. A child at distance d of its parent can only hold values whose distance
        to the parent's differs from d by no more than the radius."""
        stack = [self.root] if self.root else []
        while stack:
            held, children = stack.pop()
            distance = (held ^ value).bit_count()
            if distance <= radius:
                yield held
            if len(children) > 2 * radius:
                stack += [children[d] for d in range(distance - radius, distance + radius + 1) if d in children]
            else:
                stack += [child for d, child in children.items() if -radius <= d - distance <= radius]


def forest(tree_side: list[int], probes: list[int] | None, radius: int, alike=None):
    """Edges that connect what is linked within a tile (``probes`` None), or between two tiles.

    ``alike`` decides whether two fingerprints within the radius are linked; it isn't asked where they are connected.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[up]
        return x

    tree = BKTree()
    if probes is not None:
        for value in tree_side:
            tree.add(value)
    for value in tree_side if probes is None else probes:
        for other in tree.within(value, radius):
            a, b = find(value), find(other)
            if a != b and (alike is None or alike(value, other)):
                parent[b] = a
                yield value, other
        if probes is None:
            tree.add(value)


def bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 bands that cover the fingerprint."""
    n = radius + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(distinct: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect all fingerprints of ``distinct`` (column fp, no repeats) within the radius."""
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.expr(f"shiftrightunsigned(fp, {shift}) & {(1 << width) - 1}").alias("value")) for i, (shift, width) in enumerate(bands(radius))])
    rows = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.band", "k.value")
    # at most (radius + 1) * 2^width keys, whatever the input
    large = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    large = large.select("band", "value", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    rows = rows.join(F.broadcast(large), ["band", "value"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("fp", "band"), F.col("tiles")).cast("int"))
    # a row goes to each pair of tiles that its own is part of; (i, i) is the tile itself
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("band", "value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "fp")
    dealt = rows.repartition("band", "value", "i", "j").sortWithinPartitions("band", "value", "i", "j", "mine")

    def run(batches):
        key, left, right = None, [], []

        def done():
            if key is not None and len(left) + len(right) > 1:
                yield from forest(left, None if key[2] == key[3] else right, radius)

        for batch in batches:
            found: list[tuple[int, int]] = []
            for *own, mine, fp in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if own != key:
                    found += done()
                    key, left, right = own, [], []
                (left if mine == own[2] else right).append(fp & 0xFFFFFFFFFFFFFFFF)
            yield edges(found)
        yield edges(list(done()))

    def edges(found):
        return pa.RecordBatch.from_arrays([pa.array([signed(a) for a, _ in found], pa.int64()), pa.array([signed(b) for _, b in found], pa.int64())], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row; component_id is the smallest id of its group."""
    docs = written(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", words), "fingerprints")
    classes = written(docs.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    roots = components(links(classes.select("fp"), radius, tile))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = named.join(lows, "root").select("fp", "component_id")
    return docs.join(found, "fp").select(F.col("doc_id").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
