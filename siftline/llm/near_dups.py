"""Near-duplicate groups by similarity: SimHash and BK-trees inside shards, verified on word shingles.

Texts are linked if the sets of their shingles of ``words`` words have a Jaccard similarity of ``similarity`` or more. At
0.8 the fingerprints of two texts differ in some 10 of 64 bits, with a spread of 3, so bands of the fingerprint itself would
lose links; here the shards are the connected groups of texts that share a band of min-hashes (a chance of 0.998 and more at
0.8). In each shard a BK-tree of the fingerprints follows only edges within ``radius``, and each pair that it finds and that
isn't connected yet is compared shingle by shingle. Shards of more than ``TILE`` texts or ``TILE_BYTES`` of text are split into
pairs of tiles, so a worker holds the shingle hashes of two tiles (or of two texts, where these are longer).

Equal texts are one member, found first by an aggregate, so copies are never expanded into pairs. Every table that grows
with the corpus stays distributed; counts of tiles are broadcast only after they have been counted.

Edge cases: null texts are empty; texts without words are alike; rows that repeat id and text are members of one group;
null ids sort before others.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bounded_batches, discard, packed, shuffle_files_go, written
from .components import components
from .simhash import fingerprint_of, forest, shingle_hashes, signed

WORDS, SIMILARITY, RADIUS = 5, 0.8, 22
BANDS, ROWS = 14, 4
TILE, TILE_BYTES, MAX_BROADCAST = 2048, 16 << 20, 100_000


def _factors():
    import numpy as np

    random = np.random.default_rng(77)
    return random.integers(0, 1 << 62, (BANDS * ROWS, 1), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def min_hash_bands(hashes, factors) -> list[int]:
    """One key per band from ``ROWS`` minima of multiplied shingle hashes (their upper halves)."""
    import numpy as np
    import xxhash

    if not len(hashes):
        return [signed(xxhash.xxh64_intdigest(b"", i)) for i in range(BANDS)]
    own = hashes.copy().view(np.uint64).reshape(-1)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(own), 4096):  # bounded memory for very long texts
        part = own[i : i + 4096]
        mixed = (part[None, :] ^ (part[None, :] >> np.uint64(29))) * factors
        least = np.minimum(least, (mixed >> np.uint64(32)).min(axis=1))
    least = least.astype(np.uint32).reshape(BANDS, ROWS)
    return [signed(xxhash.xxh64_intdigest(row.tobytes(), i)) for i, row in enumerate(least)]


def near_duplicate_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS, tile: int = TILE, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(d, sig, root, g): for every distinct pair of id (null: the smallest long) and text (as its SHA-1) the smallest id of its
    group and the group's name. A row is the one that stays if root equals d and no smaller sig of that id has the same g.
    """
    bounded_batches(df.sparkSession)
    rows = df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("sig", F.sha1("text"))

    def sketch(batches):
        factors = _factors()
        for batch in batches:
            keys = [min_hash_bands(shingle_hashes(x.as_py(), words), factors) for x in batch.column(2)]
            sizes = pc.cast(pc.binary_length(batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(keys, pa.list_(pa.int64()))], names=["d", "sig", "size", "bands"])

    sketched = written(rows.select("d", "sig", "text").mapInArrow(sketch, "d long, sig string, size long, bands array<long>"), "sketched")
    # one member per text: its smallest id
    members = written(sketched.groupBy("sig").agg(F.min("d").alias("low"), F.first("size").alias("size"), F.first("bands").alias("bands")), "members")
    keyed = members.select("sig", F.explode("bands").alias("key"))
    node = F.conv(F.substring("sig", 1, 15), 16, 10).cast("long")  # 60 bits of a SHA-1 name a text; a shared name only merges shards
    lows = keyed.groupBy("key").agg(F.min(node).alias("c"), F.max(node).alias("m")).filter("c < m").select("key", "c")
    found = components(keyed.join(lows, "key").select(node.alias("u"), F.col("c").alias("v")))
    shards = all_shards = written(found.select(F.col("node"), F.col("root").alias("shard")), "shards")
    discard(found)
    sized = shards.join(members.select(node.alias("node"), "size"), "node")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("size") / tile_bytes)).cast("int")
    tiles = written(sized.groupBy("shard").agg(parts.alias("tiles")).filter("tiles > 1"), "tiles")
    few = tiles.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    shards = shards.join(F.broadcast(tiles) if few else tiles, "shard", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    wanted = members.withColumn("node", node).join(shards, "node").select("sig", F.col("low").alias("d"), "shard", "tiles")
    rows = rows.join(wanted, ["sig", "d"]).select("shard", "tiles", F.pmod(F.xxhash64("sig"), F.col("tiles")).cast("int").alias("mine"), "sig", "text")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("shard", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "sig", "text")
    dealt = rows.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j", "mine", "sig")

    def verify(batches):
        import numpy as np

        key, left, right, sets, names = None, [], [], {}, {}

        def alike(a: int, b: int) -> bool:
            # several texts may have one fingerprint; these are compared member by member below
            return similar(sets[a][0], sets[b][0])

        def similar(x, y) -> bool:
            if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                return False
            both = len(np.intersect1d(x, y, assume_unique=True))
            return both >= similarity * (len(x) + len(y) - both) - 1e-9

        def done():
            if key is None or len(left) + len(right) < 2:
                return
            # a member is named by its fingerprint and a counter above its 64 bits, which no distance below sees
            for a, b in forest(left, None if key[1] == key[2] else right, radius, alike):
                yield names[a], names[b]

        seen: set = set()
        for batch in batches:
            found = []
            for k, value in enumerate(zip(*[batch.column(i).to_pylist() for i in range(5)])):
                own, mine, sig = value[:3], value[3], value[4]
                if own != key:
                    found += done()
                    key, left, right, sets, names, seen = own, [], [], {}, {}, set()
                if sig in seen:
                    continue  # rows that repeat id and text
                seen.add(sig)
                hashes = shingle_hashes(batch.column(5)[k].as_py(), words)
                distinct = np.unique(np.ascontiguousarray(hashes).view(np.uint64).reshape(-1))
                # the fingerprint of the set that is compared: repeated lines must not pull it away
                member = Member(fingerprint_of(distinct.view(np.uint8).reshape(-1, 8)))
                sets[member] = (distinct,)
                names[member] = sig
                (left if mine == own[1] else right).append(member)
            yield frame(found)
        yield frame(list(done()))

    def frame(found):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.string())], names=["a", "b"])

    edges = written(dealt.mapInArrow(verify, "a string, b string"), "verified")
    discard(all_shards, tiles)
    joined = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    groups = joined.select(F.col("node").alias("sig"), F.col("root").alias("g"))
    named = members.select("sig", "low").join(groups, "sig", "left").withColumn("g", F.coalesce("g", "sig"))
    lows = named.groupBy("g").agg(F.min("low").alias("root"))
    roots = written(named.join(lows, "g").select("sig", "root", "g"), "roots")
    discard(edges, joined, members)
    return sketched.select("d", "sig").distinct().join(roots, "sig").select("d", "sig", "root", "g")


class Member(int):
    """A fingerprint that stands for one text: equal fingerprints of different texts stay different members."""

    __slots__ = ()
    __hash__ = object.__hash__

    def __eq__(self, other):
        return self is other

    def __ne__(self, other):
        return self is not other


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of each group: the one with the smallest id."""
    none = F.lit(-(1 << 63)).cast("long")
    with shuffle_files_go(df.sparkSession):
        groups = written(near_duplicate_groups(df, doc_id, text, **options), "groups")
    # of several texts that share the smallest id of their group, the least SHA-1 stays
    stay = groups.filter("d = root").groupBy("g").agg(F.min(F.struct("d", "sig")).alias("x")).select("x.d", "x.sig")
    gone = groups.join(stay, ["d", "sig"], "left_anti").select("d", "sig")
    rows = packed(df).withColumns({"d": F.coalesce(F.col(f"row.{doc_id}").cast("long"), none), "sig": F.sha1(F.coalesce(F.col(f"row.{text}"), F.lit("")))})
    kept = rows.join(gone, ["d", "sig"], "left_anti")
    repeated = written(kept.groupBy("d", "sig").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("d", "sig"), "repeated")
    if not repeated.isEmpty():  # rows that repeat id and text: one of each stays
        from pyspark.sql import Window

        own = Window.partitionBy("d", "sig").orderBy(F.xxhash64(F.to_json("row")))
        again = kept.join(repeated, ["d", "sig"], "left_semi").withColumn("k", F.row_number().over(own)).filter("k = 1").drop("k")
        kept = kept.join(repeated, ["d", "sig"], "left_anti").select("row").union(again.select("row"))
    return kept.select("row.*")
