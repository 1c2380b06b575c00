"""Quality rules with adaptive thresholds.

Each document is measured once (whole text). The rates of the documents that pass the base rules feed mergeable quantile
sketches per language and source: log-linear histograms, whose cells are the leading seven bits of a whole number, so a
quantile is exact to 1/64, sketches merge by adding counts in any order, and results never depend on how rows were dealt
out. Sketches of a language merge from those of its sources, and that of the corpus from those.

From each sketch come the median and a tail quantile per rate (90 or 99 %, a parameter; the 10 or 1 % one where low values are
rejected too). Those of a group are drawn towards its language's, and these towards the corpus's, as if ``PRIOR`` documents
of the larger group were added, so small groups follow the larger and large ones their own data. A threshold lies
``reach`` times the distance from median to tail beyond the tail; the distance counts as ``least`` at least, a few per cent
of what junk shows, so that a group of equals rejects nobody for a trifle. Filtering joins documents with the thresholds of
their group.

Scale: counting cells combines before the shuffle, so a source with a third of all rows sends as many cells as others;
the thresholds have one row per group, and are broadcast only if counted and within ``MAX_BROADCAST_GROUPS``, else
the join is Spark's (with its handling of skew).

Edge cases: a null or empty text has no words and fails the base rules; null language or source counts as the empty
name; repeated rows are judged alike; an empty table gives an empty table; input columns named like an output column are
replaced.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounded_batches, column_at, private, table, written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Rate: (numerator, denominator, scale, tail in per cent, reach, least distance, whether low values are rejected too).
RATES = {
    "word_length": ("word_chars", "n_words", 100, 90, 3, 10, True),
    "symbol_rate": ("n_symbols", "n_words", 1000, 90, 3, 30, False),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1000, 99, 2, 30, False),
    "repeat_rate": ("n_repeat_words", "n_words", 1000, 99, 2, 30, False),
}
#: Documents of the next larger group that a group's quantiles are mixed with.
PRIOR = 200
LEAST_WORDS = 50
MAX_BROADCAST_GROUPS = 100_000


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of one text."""
    data = (text or "").encode()
    words = data.split()  # bytes split at ASCII white space only
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0
    chars = len(text) - (len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c")))
    symbols = len(data) - len(data.translate(None, b"#*$%&|<>"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        end = 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated


def measure(df: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``df`` with the measures as long columns; without a shuffle."""
    bounded_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name.lower() not in MEASURES]
    df = df.select(*[f.name for f in kept])
    kept = [f for f in kept if not (drop_text and f.name == text)]
    schema = T.StructType([*kept, *[T.StructField(m, T.LongType()) for m in MEASURES]])

    def run(batches):
        for batch in batches:
            rows = [measures(x.as_py()) for x in column_at(batch, text)]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            new = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(MEASURES))]
            yield pa.RecordBatch.from_arrays(columns + new, names=[f.name for f in kept] + list(MEASURES))

    return df.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rate(name: str) -> Column:
    top, bottom, scale, *_ = RATES[name]
    return F.when(F.col(bottom) > 0, F.floor(F.expr(f"({scale} * {top}) div {bottom}"))).otherwise(F.lit(0)).cast("long")


def cell(value: str) -> str:
    """SQL for the lower edge of a whole number's cell: its leading seven bits."""
    return f"shiftleft(shiftright({value}, greatest(0, length(bin({value})) - 7)), greatest(0, length(bin({value})) - 7))"


def sketches(measured: DataFrame, language: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, rate, edge, n): the cells of the sketches of each group."""
    good = measured.filter(~base_failed()).select(
        F.coalesce(F.col(language), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("rate"), rate(name).alias("v")) for name in RATES])).alias("x"),
    ).select("lang", "source", "x.rate", "x.v")
    return good.groupBy("lang", "source", "rate", F.expr(cell("v")).alias("edge")).agg(F.count(F.lit(1)).alias("n"))


def thresholds(cells: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, fences): per language and source a map from rate to its low and high threshold."""
    none = F.lit(None).cast("string")
    levels = F.array(*[F.struct(F.lit(k).alias("level"), (F.col("lang") if k else none).alias("l"), (F.col("source") if k == 2 else none).alias("s")) for k in (2, 1, 0)])
    merged = cells.select("rate", "edge", "n", F.explode(levels).alias("x")).groupBy("x.level", "x.l", "x.s", "rate", "edge").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("level", "l", "s", "rate")
    upto = whole.orderBy("edge").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    of = lambda k: F.create_map(*[F.lit(x) for name, r in RATES.items() for x in (name, r[k])])[F.col("rate")].cast("long")
    at = lambda percent: F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("edge")))
    found = ranked.withColumn("tail", of(3)).groupBy("level", "l", "s", "rate").agg(F.max("total").alias("n"), at(100 - F.col("tail")).alias("a"), at(F.lit(50)).alias("m"), at(F.col("tail")).alias("b"))
    pick = lambda k, *cols: found.filter(F.col("level") == k).select("rate", *cols, *[F.col(c).alias(f"{c}{k}") for c in "namb"])
    own = pick(2, F.col("l").alias("lang"), F.col("s").alias("source"))
    out = own.join(pick(1, F.col("l").alias("lang")), ["lang", "rate"]).join(pick(0), "rate")

    def mixed(c: str) -> Column:
        near = f"(n1 * {c}1 + {prior} * {c}0) div (n1 + {prior})"
        return F.expr(f"(n2 * {c}2 + {prior} * ({near})) div (n2 + {prior})")

    out = out.select("lang", "source", "rate", *[mixed(c).alias(c) for c in "amb"])
    low = F.col("a") - of(4) * F.greatest(F.col("m") - F.col("a"), of(5))
    high = F.col("b") + of(4) * F.greatest(F.col("b") - F.col("m"), of(5))
    return out.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("rate", F.struct(low.alias("low"), high.alias("high"))))).alias("fences"))


def judge(measured: DataFrame, fences: DataFrame, language: str = "lang", source: str = "source", max_broadcast: int = MAX_BROADCAST_GROUPS) -> DataFrame:
    """``measured`` with base_failed, kept and reasons (array<string>)."""
    measured = measured.drop("base_failed", "kept", "reasons")
    few = fences.limit(max_broadcast + 1).count() <= max_broadcast  # one row per group: counted before any broadcast
    l, s, own = private(measured, "l", "s", "fences")
    right = fences.select(F.col("lang").alias(l), F.col("source").alias(s), F.col("fences").alias(own))
    joined = measured.join(F.broadcast(right) if few else right, (F.coalesce(F.col(language), F.lit("")) == F.col(l)) & (F.coalesce(F.col(source), F.lit("")) == F.col(s)), "left")
    reasons = []
    for name, (*_, both) in RATES.items():
        fence = F.col(own)[name]
        if both:
            reasons.append(F.when(rate(name) < fence["low"], f"{name}_low"))
        reasons.append(F.when(rate(name) > fence["high"], f"{name}_high"))
    reasons = F.when(base_failed(), F.array(F.lit("base"))).otherwise(F.array_compact(F.array(*reasons)))
    return joined.withColumns({"base_failed": base_failed(), "reasons": reasons}).withColumn("kept", F.size("reasons") == 0).drop(l, s, own)


def quality_rules(df: DataFrame, text: str = "text", language: str = "lang", source: str = "source", drop_text: bool = False) -> DataFrame:
    """All of it: measure, sketch, derive thresholds, join, judge. Rejected rows are marked, not removed."""
    measured = written(measure(df, text, drop_text), "measured")  # texts are measured once for sketches and judging
    fences = written(thresholds(sketches(measured, language, source)), "thresholds")
    return judge(measured, fences, language, source)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = quality_rules(docs, drop_text=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("reasons", ",").alias("reasons"))


def sql_cell(v: str) -> str:
    return f"(({v} >> greatest(0, length(bin({v})) - 7)) << greatest(0, length(bin({v})) - 7))"


def oracle(select: str = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, reasons", documents: str = "documents") -> str:
    rates = ", ".join(f"CASE WHEN {b} > 0 THEN ({k} * {t}) // {b} ELSE 0 END AS {name}" for name, (t, b, k, *_) in RATES.items())
    cells = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS rate, {sql_cell(name)} AS edge FROM r WHERE NOT base_failed" for name in RATES)
    of = lambda k: "CASE rate " + " ".join(f"WHEN '{name}' THEN {r[k]}" for name, r in RATES.items()) + " END"
    mixed = ", ".join(f"((g.n * g.{c} + {PRIOR} * ((h.n * h.{c} + {PRIOR} * o.{c}) // (h.n + {PRIOR}))) // (g.n + {PRIOR}))::BIGINT AS {c}" for c in "amb")
    reasons = ", ".join(x for name, (*_, both) in RATES.items() for x in ([f"CASE WHEN {name} < {name}_lo THEN '{name}_low' END"] if both else []) + [f"CASE WHEN {name} > {name}_hi THEN '{name}_high' END"])
    wide = ", ".join(f"max(low) FILTER (rate = '{name}') AS {name}_lo, max(high) FILTER (rate = '{name}') AS {name}_hi" for name in RATES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, lang, source FROM {documents}),
w AS (SELECT rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win FROM w, unnest(range(1, len(words) - 1)) AS u(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM g) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, i + k AS p FROM rep, unnest([0, 1, 2]) AS v(k)) GROUP BY rid),
m AS (SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w JOIN l USING (rid) LEFT JOIN cov USING (rid)),
r AS (SELECT *, {rates}, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
c AS ({cells}),
lv AS (SELECT 2 AS level, lang AS l, source AS s, rate, edge, count(*) AS n FROM c GROUP BY ALL UNION ALL SELECT 1, lang, NULL, rate, edge, count(*) FROM c GROUP BY ALL UNION ALL SELECT 0, NULL, NULL, rate, edge, count(*) FROM c GROUP BY ALL),
k AS (SELECT *, sum(n) OVER (PARTITION BY level, l, s, rate ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY level, l, s, rate) AS total FROM lv),
q AS (SELECT level, l, s, rate, max(total)::BIGINT AS n, min(edge) FILTER (100 * upto >= (100 - {of(3)}) * total) AS a, min(edge) FILTER (100 * upto >= 50 * total) AS m, min(edge) FILTER (100 * upto >= {of(3)} * total) AS b FROM k GROUP BY ALL),
x AS (SELECT g.l AS lang, g.s AS source, g.rate, {mixed} FROM q g JOIN q h ON h.level = 1 AND h.l = g.l AND h.rate = g.rate JOIN q o ON o.level = 0 AND o.rate = g.rate WHERE g.level = 2),
f AS (SELECT lang, source, rate, a - {of(4)} * greatest(m - a, {of(5)}) AS low, b + {of(4)} * greatest(b - m, {of(5)}) AS high FROM x),
y AS (SELECT lang, source, {wide} FROM f GROUP BY lang, source),
z AS (SELECT r.*, list_filter([{reasons}], lambda e: e IS NOT NULL) AS why FROM r LEFT JOIN y ON r.lang = y.lang AND r.source = y.source)
SELECT {select} FROM (SELECT *, CASE WHEN base_failed THEN 'base' ELSE array_to_string(why, ',') END AS reasons, NOT base_failed AND len(why) = 0 AS kept FROM z)"""
