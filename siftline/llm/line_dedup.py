"""Line deduplication with content-defined chunks of lines.

A line is a stretch of text up to and with a line break or the end of a sentence and the white space after it. A sentence
that goes on for over ``LONG`` characters is also cut between two words whose letters at the cut are in ``_BEFORE`` and ``_AFTER``
(one place in seven or so; in some scripts one in three) or after a full-width mark, so a stretch without punctuation has
lines too, cut alike wherever it stands. The lines of a text put together are the text.

Boundaries are chosen by rolling over the lines' hashes: a line is one if its hash isn't above that of a neighbour, so of
two neighbouring lines one is a boundary at least, and whether a line inside a passage is one depends on the passage only. A
line that has ``min_chars`` by itself is always one. A
chunk goes from a boundary up to and with the next one that gives it ``min_chars`` characters (from a text's last line
back to such a one); it has two lines or more, and chunks overlap in their boundaries. Any passage of four lines or more, or
of two long ones, that has the characters holds a chunk wherever it stands, and all of it but a line or so at either end is covered. Chunks that occur in more than one document are removed from all but the one with the smallest id,
after the bytes have been compared (the stretch of the text itself, without the white space at its end).

Native throughout, in four steps: (1) chunk hashes, one narrow row each; (2) an aggregate that combines before its
shuffle finds repeated hashes, and a join (skew split by Spark) their places, which are listed by document; (3) documents
with their lists are written once; for repeated hashes only the least and greatest of their chunks' texts are compared, which
shows whether all bytes agree, and a hash under which texts differ is settled text by text; (4) lines go, in one projection.
No step carries a document's lines into rows of its chunks, so work and memory grow with the text, not with its square.

Edge cases: null and empty texts stay as they are; rows with one id (or a null one) count as one document, and within a
document nothing is removed; rows that share an id but not the text are told apart by a hash of the text; an empty
table stays empty; further columns are kept, also with clashing names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import discard, let, shuffle_files_go, table, written

LONG, MIN_CHARS = 120, 48


#: Letters that end the word before a cut, and that begin the word after it: about three in eight of each. Classes beyond
#: Latin-1 are slow, so they are tried only where other letters are near.
_BEFORE, _AFTER = "[acdgilmpruy,;:0-3à-ê]", "[acegkmpruwA-J4-7à-ê]"
_AFTER_OTHER = "".join(f"{chr(c)}-{chr(c + 11)}" for c in range(0x100, 0xE00, 32))
_LINE = "|".join([
    rf"[^\n.!?]{{0,{LONG}}}+[\n.!?][\s.!?]*",
    rf"[^\n.!?]{{1,512}}?{_BEFORE} (?={_AFTER})",
    rf"(?=[\x00-ÿ]{{0,64}}+[^\x00-ÿ])[^\n.!?]{{1,512}}?(?: (?<=[^\x00-ÿ] )(?=[{_AFTER_OTHER}])|[。！？；，]\s*)",
    r"[^\n.!?]+(?:[\n.!?][\s.!?]*)?",
])
_SPACE = " \n\t\r\f\v"


def lines(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(text, F.lit(_LINE), F.lit(0)), lambda x: x != "")


def _packed(start: Column, length: Column) -> Column:
    return F.shiftleft(start.cast("long"), 31).bitwiseOR(length.cast("long"))


def _start(se: Column) -> Column:
    return F.shiftright(se, 31).cast("int")


def _length(se: Column) -> Column:
    return se.bitwiseAND((1 << 31) - 1).cast("int")


def _stretch(u: Column, se: Column) -> Column:
    """The text of a chunk: its lines, without the white space at the end."""
    return F.rtrim(F.array_join(F.slice(u, _start(se), _length(se)), ""), F.lit(_SPACE))


def _boundary(n: Column, hashes: Column, i: Column, min_chars: int) -> Column:
    return (F.get(n, i) >= min_chars) | (F.get(hashes, i) <= F.greatest(F.get(hashes, i - 1), F.get(hashes, i + 1)))


def boundaries(n: Column, hashes: Column, min_chars: int) -> Column:
    """Numbers (from 0) of the lines that have ``min_chars`` or whose hash isn't above that of a neighbour, and of the first
    and last."""
    last = F.size(hashes) - 1
    inner = F.when(last > 1, F.filter(F.sequence(F.lit(1), last - 1), lambda i: _boundary(n, hashes, i, min_chars))).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(0)), inner, F.array(last))


def _ends(n: Column, hashes: Column, cuts: Column, min_chars: int, near: int = 4) -> Column:
    """For each boundary the one at the other end of its chunk: a later one, for the last boundary an earlier one, null where
    the text ends before ``min_chars``.

    ``n``: the lines' lengths. Chunks of more than ``near`` boundaries are rare; their ends are looked for line by line.
    """

    def further(j: Column, chars: Column, way: int) -> Column:
        # lines have a character and every second one is a boundary at least, so 2 * min_chars more lines do
        start = F.struct(chars.alias("n"), F.lit(None).cast("int").alias("j"))
        more = lambda a, x: F.when(a["j"].isNotNull(), a).otherwise(
            F.struct((a["n"] + F.get(n, x)).alias("n"), F.when((a["n"] + F.get(n, x) >= min_chars) & (_boundary(n, hashes, x, min_chars) | (x == 0) | (x == F.size(n) - 1)), x).alias("j"))
        )
        if way > 0:
            return F.when(j + 1 < F.size(n), F.aggregate(F.sequence(j + 1, F.least(j + 2 * min_chars, F.size(n) - 1)), start, more, lambda a: a["j"]))
        return F.when(j > 0, F.aggregate(F.sequence(j - 1, F.greatest(j - 2 * min_chars, F.lit(0)), F.lit(-1)), start, more, lambda a: a["j"]))

    def other(i: Column, k: Column, way: int) -> Column:
        out, chars, before = F, F.get(n, i), i
        for step in range(1, near + 1):
            j = F.get(cuts, k + step * way)
            chars = chars + F.get(n, j) + F.when(j - before == 2 * way, F.get(n, j - way)).otherwise(0)  # boundaries are one line apart at most
            out = out.when(chars >= min_chars, j)
            before = j
        return out.when(before.isNotNull(), further(before, chars, way))

    return F.transform(cuts, lambda i, k: F.when(k + 1 < F.size(cuts), other(i, k, 1)).otherwise(other(i, k, -1)))


def chunks(df: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, d, t, se) of every chunk of ``df`` (columns d and text): hash, document, hash of its text, packed first line
    (from 1) and length."""

    def of(u: Column, n: Column, hs: Column) -> Column:
        chunk = lambda i, j: F.struct(F.xxhash64(F.array_join(F.slice(u, i + 1, j - i), ""), F.get(hs, j)).alias("h"), i.alias("i"), j.alias("j"))
        both = lambda i, j: F.when(i < j, chunk(i, j)).when(j < i, chunk(j, i))
        return let(boundaries(n, hs, min_chars), lambda cuts: F.zip_with(cuts, _ends(n, hs, cuts, min_chars), both))

    def found(u: Column) -> Column:
        hashes, lengths = F.transform(u, lambda x: F.xxhash64(F.rtrim(x, F.lit(_SPACE)))), F.transform(u, lambda x: F.length(x))
        return let(hashes, lambda hs: let(lengths, lambda n: of(u, n, hs)))

    rows = df.select("d", "text").filter(F.length("text") >= min_chars)
    own = let(lines(F.col("text")), lambda u: F.when(F.size(u) > 1, found(u)))
    # outer, because Spark would filter by the size of an inner explode's argument first, that is, evaluate it twice
    rows = rows.select("d", F.xxhash64("text").alias("t"), own.alias("c")).select("d", "t", F.explode_outer("c").alias("x")).filter("x IS NOT NULL")
    return rows.select("x.h", "d", "t", _packed(F.col("x.i") + 1, F.col("x.j") - F.col("x.i") + 1).alias("se"))


def repeated_places(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(d, t, x) with x an array of (h, se, later) per document that holds repeated chunks; ``later``: an earlier document
    has the chunk."""
    all_chunks = written(chunks(docs, min_chars), "chunks")
    repeated = all_chunks.groupBy("h").agg(F.min("d").alias("o"), F.max("d").alias("m")).filter("o < m").select("h", "o")
    places = all_chunks.join(repeated, "h").select("d", "t", F.struct("h", "se", (F.col("d") > F.col("o")).alias("later")).alias("p"))
    listed = written(places.groupBy("d", "t").agg(F.collect_list("p").alias("x")), "places")
    discard(all_chunks)
    return listed


def _left(u: Column, spans: Column) -> Column:
    """What is left of a text's lines, how many they were and how many went; null where none go."""
    covered = F.flatten(F.transform(spans, lambda se: F.sequence(_start(se), _start(se) + _length(se) - 1)))
    kept = lambda gone: F.array_except(F.sequence(F.lit(1), F.size(u)), gone)
    out = lambda k: F.struct(F.array_join(F.transform(k, lambda i: F.get(u, i - 1)), "").alias("text"), F.size(u).alias("n"), (F.size(u) - F.size(k)).cast("long").alias("removed"))
    return F.when(F.size(spans) > 0, let(kept(covered), out))


def line_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(row struct, text, n_lines, n_removed, removed_chars): ``row`` holds the input row, ``text`` what is left.

    n_lines is null where no line goes.
    """
    none = F.lit(-(1 << 63)).cast("long")
    own = F.col(f"row.`{text}`")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.coalesce(F.col(doc_id).cast("long"), none).alias("d"), F.xxhash64(F.col(text)).alias("t"))
    with shuffle_files_go(df.sparkSession):
        places = repeated_places(rows.select("d", own.alias("text")), min_chars)

        def both(u: Column) -> Column:
            texts = F.transform("x", lambda p: F.struct(p["h"].alias("h"), p["se"].alias("se"), p["later"].alias("later"), _stretch(u, p["se"]).alias("txt")))
            return F.struct(texts.alias("x"), _left(u, F.transform(F.filter("x", lambda p: p["later"]), lambda p: p["se"])).alias("z"))

        listed = rows.join(places, ["d", "t"], "left").withColumn("y", F.when(F.col("x").isNotNull(), let(lines(own), both)))
        listed = written(listed.select("row", "d", "t", "y.x", "y.z"), "listed", "zstd")
        discard(places)
        texts = listed.select("d", "t", F.explode("x").alias("p")).select("d", "t", "p.*")
        unequal = written(texts.groupBy("h").agg(F.min("txt").alias("a"), F.max("txt").alias("b")).filter("a <> b").select("h"), "unequal")
        if not unequal.isEmpty():
            # different texts under one hash: settle each text by itself
            same = texts.join(unequal, "h", "left_semi")
            firsts = same.groupBy("h", "txt").agg(F.min("d").alias("o"))
            settled = same.join(firsts, ["h", "txt"]).withColumn("later", F.col("d") > F.col("o")).select("d", "t", "se", "later")
            agreed = texts.join(unequal, "h", "left_anti").select("d", "t", "se", "later")
            spans = agreed.union(settled).filter("later").groupBy("d", "t").agg(F.collect_set("se").alias("gone"))
            again = let(lines(own), lambda u: _left(u, F.col("gone")))
            listed = written(listed.drop("x", "z").join(spans, ["d", "t"], "left").withColumn("z", F.when(F.col("gone").isNotNull(), again)), "settled")
    return listed.select(
        "row", F.when(F.col("z").isNotNull(), F.col("z.text")).otherwise(own).alias("text"), F.col("z.n").alias("n_lines"), F.coalesce("z.removed", F.lit(0).cast("long")).alias("n_removed"),
        F.when(F.col("z").isNotNull(), F.length(own) - F.length("z.text")).otherwise(0).cast("long").alias("removed_chars"),
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "text", "n_removed", "removed_chars")
