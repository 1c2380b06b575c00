"""Operators around the corpus: site rules with scopes and blocks, submission slots, outbound policy, durations. All native."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import empty, let, strip
from .lines import position_ratio

HEADER_END, FOOTER_START = 0.35, 0.65
_LINK = r"https?://|\]\("


def like(value: Column, pattern: str) -> Column:
    """Shell-style matching with * and ?, of the whole value and with case."""
    out = "".join(".*" if ch == "*" else "." if ch == "?" else re.escape(ch) for ch in pattern)
    return F.lit(True) if pattern == "*" else empty(value).rlike(rf"(?s)\A{out}\z")


def _inside(rule: dict, place: Column) -> Column:
    low, high = rule.get("start", 0.0), rule.get("end", 1.0)
    if rule.get("region") == "header" and high == 1.0:
        high = HEADER_END
    if rule.get("region") == "footer" and low == 0.0:
        low = FOOTER_START
    return (place >= low) & (place <= high)


def site_rules(text: Column, source: Column, domain: Column, rules: list[dict]) -> Column:
    """struct<text, hits array<struct<rule, line, text>>>: the text without the lines that a rule removes, and each such line with
    its number (from 0) and the rule.

    A rule has an ``id``, a scope (``source``, ``domain``: * and ?), a place (``region`` header or footer, or ``start`` and
    ``end`` ratios), and exact ``lines``, a full-match ``pattern``, or ``block`` (two full-match patterns: from a line that
    matches the first to the next that matches the second; one without an end stays). Lines with a link stay unless
    ``keep_links`` is false. Of several rules blocks come first, the last of them, then the first line rule. Rules of high
    risk must be disabled; ids may not repeat.
    """
    ids = [rule["id"] for rule in rules]
    if len(set(ids)) < len(ids):
        raise ValueError("rule ids repeat")
    for rule in rules:
        if rule.get("risk") == "high" and rule.get("enabled", True):
            raise ValueError(f"rule {rule['id']} is high risk and must be disabled")
    rules = [rule for rule in rules if rule.get("enabled", True)]
    scope = lambda rule: like(source, rule.get("source", "*")) & like(domain, rule.get("domain", "*"))
    full = lambda s, pattern: strip(s).rlike(rf"\A(?:{pattern})\z")
    spans_type = "array<struct<a:int,b:int>>"

    def spans(rows: Column, rule: dict) -> Column:
        begin, end = rule["block"]
        start = F.struct(F.lit(None).cast("int").alias("open"), F.array().cast(spans_type).alias("done"))

        def step(a, x):
            close = a["open"].isNotNull() & full(x["l"], end)
            opened = F.when(a["open"].isNull() & full(x["l"], begin) & _inside(rule, x["p"]), x["i"]).otherwise(a["open"])
            done = F.when(close, F.concat(a["done"], F.array(F.struct(a["open"].alias("a"), x["i"].alias("b"))))).otherwise(a["done"])
            return F.struct(F.when(close, F.lit(None).cast("int")).otherwise(opened).alias("open"), done.alias("done"))

        return F.when(scope(rule), F.aggregate(rows, start, step, lambda a: a["done"])).otherwise(F.array().cast(spans_type))

    blocks = [rule for rule in rules if "block" in rule]
    singles = [rule for rule in rules if "block" not in rule]
    plain = lambda rule, s: ~s.rlike(_LINK) if rule.get("keep_links", True) else F.lit(True)

    def named(x: Column, found: list[Column]) -> Column:
        out, none = F.lit(None).cast("string"), F.lit(None).cast("string")
        for rule, own in zip(blocks, found):
            out = F.when(F.exists(own, lambda b: (b["a"] <= x["i"]) & (x["i"] <= b["b"])), F.when(plain(rule, x["l"]), rule["id"]).otherwise(none)).otherwise(out)
        for rule in singles:
            match = strip(x["l"]).isin(*rule["lines"]) if "lines" in rule else full(x["l"], rule["pattern"])
            out = F.coalesce(out, F.when(match & scope(rule) & _inside(rule, x["p"]) & plain(rule, x["l"]), rule["id"]))
        return out

    def apply(rows: Column, *found: Column) -> Column:
        marked = F.transform(rows, lambda x: F.struct(x["l"].alias("l"), x["i"].alias("i"), named(x, list(found)).alias("rule")))
        kept = lambda m: F.array_join(F.transform(F.filter(m, lambda x: x["rule"].isNull()), lambda x: x["l"]), "\n")
        hits = lambda m: F.transform(F.filter(m, lambda x: x["rule"].isNotNull()), lambda x: F.struct(x["rule"].alias("rule"), x["i"].alias("line"), x["l"].alias("text")))
        return let(marked, lambda m: F.struct(kept(m).alias("text"), hits(m).alias("hits")))

    def nested(rows: Column, left: list[dict], found: list[Column]) -> Column:
        return let(spans(rows, left[0]), lambda own: nested(rows, left[1:], [*found, own])) if left else apply(rows, *found)

    lines = F.split(empty(text), "\n", -1)
    placed = F.transform(F.arrays_zip(lines.alias("l"), position_ratio(lines).alias("p")), lambda x, i: F.struct(x["l"].alias("l"), x["p"].alias("p"), i.alias("i")))
    return let(placed, lambda rows: nested(rows, blocks, []))


def admit(tasks: DataFrame, batch_cap: int, pool_cap: int | None = None, batch: str = "batch", pool: str = "pool", status: str = "status", order: str = "task") -> DataFrame:
    """``tasks`` with admitted boolean: pending tasks that may be submitted now, in ``order``, as if slots were taken one by one.

    A batch holds ``batch_cap`` active tasks at most and a pool ``pool_cap``. A task that its batch refuses takes no slot of the
    pool, so ranks within batches come first and ranks within pools among those that passed.
    """
    waiting = (F.col(status) == "pending").cast("int")
    active = F.sum((F.col(status) == "active").cast("int"))
    upto = lambda key: Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = tasks.withColumn("__ok", (waiting == 1) & (active.over(Window.partitionBy(batch)) + F.sum(waiting).over(upto(batch)) <= batch_cap))
    if pool_cap is not None:
        taken = F.sum(F.col("__ok").cast("int")).over(upto(pool))
        out = out.withColumn("__ok", F.col("__ok") & (active.over(Window.partitionBy(pool)) + taken <= pool_cap))
    return out.withColumnRenamed("__ok", "admitted")


def outbound(classification: Column, external: Column, allowed: Column) -> Column:
    """Whether data may go to a provider: an external one gets public data only, and only where that was allowed."""
    known = classification.isin("public", "internal", "confidential")
    return F.when(~known, "unknown_classification").when(external & (classification != "public"), "refused_classification").when(external & ~allowed, "refused_not_allowed").otherwise("allowed")


def duration(seconds: Column) -> Column:
    """A compact duration in Chinese: seconds, minutes or hours; negative ones count as zero."""
    s = F.greatest(seconds.cast("double"), F.lit(0.0))
    minutes = F.floor(s / 60)
    rest = F.format_string("%.2f", s - 60 * minutes)
    whole = F.concat(minutes.cast("string"), F.lit(" 分 "), rest, F.lit(" 秒"))
    hours = F.concat(F.floor(minutes / 60).cast("string"), F.lit(" 小时 "), (minutes % 60).cast("string"), F.lit(" 分 "), rest, F.lit(" 秒"))
    return F.when(s < 60, F.concat(F.format_string("%.2f", s), F.lit(" 秒"))).when(minutes < 60, whole).otherwise(hours)


def presubmit(extension: Column, size: Column, sha256: Column, done: Column, active: Column, supported: list[str], largest: int, dry_run: bool = False) -> Column:
    """What becomes of a file before it is submitted: the first of unsupported, preflight_failed, skipped_duplicate (its hash has
    been parsed), waiting (its hash is on its way), dry_run, pending."""
    out = F.when(~F.lower(empty(extension)).isin(*supported), "unsupported").when(sha256.isNull() | (size <= 0) | (size > largest), "preflight_failed")
    return out.when(done, "skipped_duplicate").when(active, "waiting").otherwise("dry_run" if dry_run else "pending")
