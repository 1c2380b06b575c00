"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become word sequences (lower case, letters and digits). A spaced seed is a fixed mask over
neighbouring words that ignores some of them, so a hash of the others survives substitutions at the ignored
places. Seed hashes of every place of every document are joined with those of the benchmark; around each hit the
document and the item are laid over each other word by word, and the longest stretch in which at least ``identity`` of
the words agree is measured. A document is contaminated by an item if that stretch has ``min_overlap`` words, or all of
a shorter item.

Scale: the benchmark is measured first and cut into blocks of at most ``BLOCK_BYTES`` of text; one block at a time is
shipped to the workers and probed in a single pass over the documents without a shuffle. More blocks mean more passes
(written out in between), never a larger broadcast.

Items of under ``MIN_WORDS`` words would be found in any prose; they are matched exactly, where a line of the document has
these words and no others.

Edge cases: null and empty texts are clean; null items and items without words are never matched; an empty
benchmark leaves all clean; repeated items count once each by id; items of fewer words than a match needs have
masks of their own, one of which every allowed choice of substitutions leaves alone; input columns
named like an output column are replaced.
"""

from __future__ import annotations

import re
import uuid
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounded_batches, column_at, table, written

#: Masks: 1 marks a word that counts. At MIN_OVERLAP and IDENTITY they miss nothing: every stretch of 13 to 25 words with a
#: fifth of them substituted anywhere holds the counting words of one mask, and a longer one holds such a stretch.
MASKS = ("1111011", "110100010011", "1010001111", "1001100000111")
MIN_WORDS, MIN_OVERLAP, IDENTITY = 5, 13, 0.8
BLOCK_BYTES = 16 << 20
_WORDS = re.compile(r"\w+").findall


def tokens(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


def short_masks(n: int, identity: float = IDENTITY) -> list[list[int]]:
    """Masks over all ``n`` words of an item: with m substitutions allowed, the words are cut into m + 2 parts, any two of which
    count, and at least two parts have no substitution."""
    m = int(n * (1 - identity) + 1e-9)
    parts = min(n, m + 2)
    ends = [n * k // parts for k in range(parts + 1)]
    keep = parts - m
    return [[i for k in chosen for i in range(ends[k], ends[k + 1])] for chosen in combinations(range(parts), keep)]


class Index:
    """Seeds of a block of items."""

    def __init__(self, items: list[tuple[int, str]], min_overlap: int = MIN_OVERLAP, identity: float = IDENTITY):
        import numpy as np

        self.np, self.min_overlap, self.identity = np, min_overlap, identity
        random = np.random.default_rng(20240601)
        words = [(item, tokens(text)) for item, text in items]
        self.items = [(item, w) for item, w in sorted(words) if len(w) >= MIN_WORDS]
        self.lines: dict[tuple, list[int]] = {}
        for item, w in words:
            if 0 < len(w) < MIN_WORDS:
                self.lines.setdefault(tuple(w), []).append(item)
        vocabulary = sorted({x for _, w in self.items for x in w})
        self.number = {x: i + 1 for i, x in enumerate(vocabulary)}
        self.code = random.integers(1, 1 << 63, len(vocabulary) + 1, np.int64).astype(np.uint64)
        shorter = sorted({len(w) for _, w in self.items if len(w) < min_overlap})
        #: (words of the items, or None: min_overlap and more; span; places that count)
        self.masks = [(None, len(m), [i for i, c in enumerate(m) if c == "1"]) for m in MASKS]
        self.masks += [(n, n, m) for n in shorter for m in short_masks(n, identity)]
        self.factor = random.integers(0, 1 << 62, max(span for _, span, _ in self.masks), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.ids = [np.fromiter((self.number[x] for x in w), np.int64, len(w)) for _, w in self.items]
        self.tables = []
        for size, span, mask in self.masks:
            found, own, place = [], [], []
            for k, ids in enumerate(self.ids):
                if len(ids) != size if size else len(ids) < min_overlap:
                    continue
                h = self.seeds(ids, span, mask)
                found.append(h)
                own.append(np.full(len(h), k, np.int64))
                place.append(np.arange(len(h)))
            if not found:
                self.tables.append(None)
                continue
            found, own, place = map(np.concatenate, (found, own, place))
            order = np.argsort(found, kind="stable")
            bits = np.zeros(1 << 20, np.bool_)
            bits[found >> np.uint64(44)] = True
            self.tables.append((found[order], own[order], place[order], bits))

    def seeds(self, ids, span: int, mask: list[int]):
        np = self.np
        n = len(ids) - span + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        codes = self.code[ids]
        out = np.zeros(n, np.uint64)
        for k in mask:
            out += codes[k : k + n] * self.factor[k]
        return out ^ (out >> np.uint64(31))

    def overlaps(self, text: str | None) -> list[tuple[int, int]]:
        """(item, words) of each item that contaminates the text, with its longest stretch."""
        np = self.np
        words = tokens(text)
        alone: dict[int, int] = {}
        if self.lines:
            for line in text.split("\n") if words else ():
                own = tuple(tokens(line)) if len(line) < 1000 or len(line.split(None, MIN_WORDS)) <= MIN_WORDS else ()
                alone.update((item, len(own)) for item in self.lines.get(own, ()))
        if not words or not self.items:
            return sorted(alone.items())
        get = self.number.get
        ids = np.fromiter([get(x, 0) for x in words], np.int64, len(words))
        best: dict[int, int] = {}
        seen: set[tuple[int, int]] = set()
        for (_, span, mask), kept in zip(self.masks, self.tables):
            if kept is None or len(ids) < span:
                continue
            hashes, own, place, bits = kept
            h = self.seeds(ids, span, mask)
            near = np.flatnonzero(bits[h >> np.uint64(44)])
            low, high = np.searchsorted(hashes, h[near], "left"), np.searchsorted(hashes, h[near], "right")
            hit = low < high
            for at, a, b in zip(near[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                for k, q in zip(own[a:b].tolist(), place[a:b].tolist()):
                    shift = at - q
                    if (k, shift) in seen:
                        continue
                    item = self.ids[k]
                    first, last = max(0, -shift), min(len(item), len(ids) - shift)
                    agree = item[first:last] == ids[shift + first : shift + last]
                    if not agree[q - first + mask[0]]:
                        continue  # other words with an equal hash
                    seen.add((k, shift))
                    length = self.longest(agree)
                    if length >= min(self.min_overlap, len(item)):
                        best[k] = max(best.get(k, 0), length)
        return sorted([*alone.items(), *[(self.items[k][0], n) for k, n in best.items()]])

    def longest(self, agree) -> int:
        """Length of the longest stretch with at least ``identity`` of its places agreeing, in linear time."""
        np = self.np
        if agree.all():
            return len(agree)
        sums = np.concatenate([[0.0], np.cumsum(np.where(agree, 1 - self.identity, -self.identity))])
        # the furthest end j for each start i with sums[j] >= sums[i]: largest sum from j on, walked with two pointers
        ahead = np.maximum.accumulate(sums[::-1])[::-1]
        best = j = 0
        behind = np.minimum.accumulate(sums)
        for i in range(len(sums)):
            while j + 1 < len(sums) and ahead[j + 1] >= behind[i] - 1e-9:
                j += 1
            best = max(best, j - i)
            if j + 1 == len(sums):
                break
        return best


#: The last index that this worker process built, by the name of its block: later tasks find it ready.
_BUILT: dict[str, Index] = {}


def _pass(df: DataFrame, text: str, items: list[tuple[int, str]], min_overlap: int, identity: float) -> DataFrame:
    """Add to contaminating_items and overlap_words what one block of items gives."""
    bounded_batches(df.sparkSession)
    shipped, block = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    names = df.columns
    at = names.index("contaminating_items"), names.index("overlap_words")

    def run(batches):
        from siftline.llm import decontaminate as home  # this module itself, also where the function was sent by value

        if block not in home._BUILT:
            home._BUILT.clear()
            home._BUILT[block] = Index(shipped.value, min_overlap, identity)
        own = home._BUILT[block]
        for batch in batches:
            columns = list(batch.columns)
            hits, most = [], []
            for value, items, words in zip(column_at(batch, text), columns[at[0]].to_pylist(), columns[at[1]].to_pylist()):
                found = own.overlaps(value.as_py())
                hits.append(sorted({*items, *[i for i, _ in found]}))
                most.append(max([words, *[n for _, n in found]]))
            columns[at[0]], columns[at[1]] = pa.array(hits, pa.list_(pa.int64())), pa.array(most, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", min_overlap: int = MIN_OVERLAP, identity: float = IDENTITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with contaminating_items array<long>, overlap_words long and contaminated boolean; rows are marked only."""
    own = ("contaminating_items", "overlap_words", "contaminated")
    df = df.drop(*own).withColumns({own[0]: F.array().cast(T.ArrayType(T.LongType())), own[1]: F.lit(0).cast("long")})
    items = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect() if blocks > 1 else items.collect()
        df = _pass(df, text, [(r.i, r.t) for r in rows], min_overlap, identity)
        if blocks > 1:
            df = written(df, "decontaminated")
    return df.withColumn(own[2], F.size(own[0]) > 0)


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", F.size("contaminating_items").cast("long").alias("n_items"), F.array_join(F.col("contaminating_items").cast("array<string>"), ",").alias("item_ids"), "overlap_words")
