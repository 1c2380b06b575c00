"""Record-level predicates, labels and routes. All native."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms
from ..functions.scalars import empty, let, one_line, strip
from .lines import found_terms


def validation(doc_id: Column, title: Column, url: Column, body: Column, shortest: int = 30) -> tuple[Column, Column, Column]:
    """(status, fields missing, warnings) of a raw record."""
    missing = F.array_compact(F.array(*[F.when(empty(v.cast("string")) == "", name) for name, v in (("doc_id", doc_id), ("title", title), ("url", url))]))
    warnings = F.array_compact(F.array(F.when(F.length(strip(empty(body))) < shortest, "too_short_or_empty")))
    status = F.when(F.size(missing) > 0, F.when(empty(url) != "", "invalid_repairable").otherwise("invalid_drop_candidate")).when(F.size(warnings) > 0, "valid_with_warning").otherwise("valid")
    return status, missing, warnings


def nonblank_lines(text: Column) -> Column:
    return F.size(F.filter(F.split(empty(text), "\n", -1), lambda x: strip(x) != ""))


def has_markdown_table(text: Column) -> Column:
    return empty(text).rlike(r"(?m)^\s*\|.*\|\s*$") & empty(text).rlike(r"(?m)^\s*\|?\s*:?-{3,}")


def lane(text: Column, origin: Column, reparse: Column, html_table: Column, oversize: int = 3_000_000) -> Column:
    """web_reparse, web_table, web_multiline, web_normal, attachment_reparse, attachment_oversized, attachment_table, attachment_text."""
    table = html_table | has_markdown_table(text)
    web = F.when(reparse, "web_reparse").when(table, "web_table").when(nonblank_lines(text) >= 3, "web_multiline").otherwise("web_normal")
    attachment = F.when(reparse, "attachment_reparse").when(F.length(empty(text)) > oversize, "attachment_oversized").when(html_table, "attachment_table").otherwise("attachment_text")
    return F.when(origin == "web", web).otherwise(attachment)


def occurrences(text: Column, names: list[str]) -> Column:
    """How often terms occur, all together."""
    total = F.lit(0)
    for t in names:
        total = total + ((F.length(text) - F.length(F.replace(text, F.lit(t), F.lit("")))) / len(t)).cast("int")
    return total


def nav_noise(text: Column, nav: list[str] | None = None, footer: list[str] | None = None, paging: list[str] | None = None, strong: list[str] | None = None, starts: list[str] | None = None) -> Column:
    """struct<nav,footer,paging,strong,starts,score> of a text in one line."""
    nav, footer, paging = nav or terms.ROUTE_NAV_TERMS, footer or terms.ROUTE_FOOTER_TERMS, paging or terms.ROUTE_PREV_NEXT_TERMS
    strong, starts = strong or terms.ROUTE_STRONG_TERMS, starts or terms.ROUTE_STARTS

    def count(t):
        hits = F.struct(occurrences(t, nav).alias("nav"), occurrences(t, footer).alias("footer"), occurrences(t, paging).alias("paging"), F.size(found_terms(t, strong)).alias("strong"), F.array_contains(F.array(*[t.startswith(x) for x in starts]), True).alias("starts"))
        return let(hits, lambda h: F.struct(h["nav"], h["footer"], h["paging"], h["strong"], h["starts"], (h["nav"] + h["footer"] * 2 + h["paging"] * 2 + h["strong"] * 3).alias("score")))

    return let(one_line(text), count)


def route(df: DataFrame, text: str, html: str, attachments: Column, images: Column, noise: Column, short: int = 80, long: int = 20_000, score: int = 8) -> DataFrame:
    """Add flags (sorted) and route. ``attachments`` and ``images`` are counts; ``noise`` is :func:`nav_noise`."""
    df = df.withColumn("__t", one_line(F.col(text))).withColumn("__n", noise)
    n = F.length("__t")
    noisy = F.col("__n.starts") | (F.col("__n.score") >= score)
    blank, brief = n == 0, (n > 0) & (n < short)
    tests = {
        "empty_text": blank, "short_text": brief, "long_text": n > long, "has_body_html": strip(empty(F.col(html))) != "", "has_table": empty(F.col(html)).rlike(r"(?i)<\s*table\b"),
        "has_attachment": attachments > 0, "has_image": images > 0, "likely_image_article": (images > 0) & (n < short) & (attachments == 0), "nav_noise": noisy,
        "footer_noise": F.col("__n.footer") >= 1, "prev_next_noise": F.col("__n.paging") >= 1, "needs_manual_review": blank | brief | noisy,
    }
    flags = F.array_sort(F.array_compact(F.array(*[F.when(test, name) for name, test in tests.items()])))
    way = F.when((blank | brief) & (attachments > 0), "attachment_candidate").when(blank | brief, "short_or_empty_no_attachment").when(noisy, "needs_body_extraction").otherwise("body_text_ok")
    return df.withColumns({"flags": flags, "route": way}).drop("__t", "__n")


def length_gate(before: Column, after: Column, least: int = 75) -> Column:
    """Why a document goes: too short already, or only once cleaned; null if it stays."""
    return F.when(F.length(empty(before)) < least, "raw_text_too_short").when(F.length(empty(after)) < least, "clean_text_too_short")


def quality_label(text: Column, raw_length: Column, url: Column, noise: Column, date_conflict: Column, risk: Column, group: Column, short: int = 80, ratio: float = 0.2) -> tuple[Column, Column, Column]:
    """(label, reasons, score): score is 100 less 15 for each reason."""
    n = F.length(empty(text))
    tests = [
        ("empty_clean_text", n == 0), ("short_clean_text", n < short), ("residual_navigation_noise", noise), ("html_tag_residue", empty(text).rlike(r"<[^>]+>")),
        ("possible_truncation", (raw_length > 0) & (n / raw_length < ratio)), ("date_conflict", date_conflict), ("high_sensitive_risk", risk == "high"), ("duplicate_canonical", empty(group) != ""),
    ]
    reasons = F.array_compact(F.array(*[F.when(test, name) for name, test in tests]))
    severe = (n < short) | (risk == "high")
    label = F.when((n == 0) & (empty(url) == ""), "drop_candidate").when(severe, "needs_review").when(F.size(reasons) > 0, "partial_clean").otherwise("clean")
    return label, reasons, F.greatest(F.lit(0), 100 - 15 * F.size(reasons))


def threshold(count: Column, key: Column, source: Column, domain: Column, override: int | None = None, mapping: dict[str, int] | None = None, allow_small: bool = False) -> tuple[Column, Column, Column]:
    """(threshold, where it comes from, whether line deduplication is on) for a group of ``count`` documents."""
    policy = F.when(count < 100, 5).when(count < 1000, 10).otherwise(20)
    known = F.create_map(*[F.lit(x) for pair in (mapping or {"": 0}).items() for x in pair])
    names = [key, F.concat(source, F.lit(" + "), domain), domain, source]
    mapped = F.coalesce(*[F.when(n != "", known[n]) for n in names])
    by = F.coalesce(*[F.when((n != "") & known[n].isNotNull(), F.concat(F.lit("map:"), n)) for n in names], F.lit("policy" if override is None else "cli"))
    value = F.coalesce(mapped, F.lit(override).cast("int"), policy)
    on = (count > 1) if allow_small else (count >= 20)
    return F.when(on | F.lit(allow_small), value), by, on


def llm_partition(success: Column, score: Column, relevance: Column, confidence: Column, excluded: Column, least: float = 0.6, min_relevance: float = 4.0, min_confidence: float = 0.9) -> Column:
    """retry, low_quality, topic_excluded, manual_review or keep, in this precedence."""
    return F.when(~success, "retry").when(score < least, "low_quality").when(excluded, "topic_excluded").when((relevance < min_relevance) | (confidence < min_confidence), "manual_review").otherwise("keep")


def mark_assets(assets: Column, text: Column) -> Column:
    """Assets with referenced (name in the text, or the text mentions attachments at all) and role (decorative or body_image)."""
    decorative = r"(?i)logo|icon|copy|wx|qrcode"
    return F.transform(assets, lambda a: F.struct(a["name"], a["url"], ((empty(a["name"]) != "") & F.contains(text, F.left(a["name"], F.lit(20))) | F.contains(text, F.lit("附件"))).alias("referenced"), F.when(empty(a["url"]).rlike(decorative), "decorative").otherwise("body_image").alias("role")))


def ratio_of(text: Column, keep: str) -> Column:
    """Share of the characters that a pattern of single characters matches; 0 for empty texts."""
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, rf"[^{keep}]", "")) / F.length(text)).otherwise(0.0)


#: Fixed values: (pattern, replacement) of the text normalisation, in order; for pages, and what attachments have instead
#: of the first four.
_HAN = r"\p{IsHan}"
WEB_RULES = [
    (r"!\[[^\]]*\]\(data:image/[^;]+;base64,[A-Za-z0-9+/=]+\)", ""), (r"\[([^\]]+)\]\(\s*\)", "$1"),
    (r"(?m)^\s*(?:打印本页|关闭窗口|分享给好友或朋友圈)\s*$", ""), (r"(?m)^\s*(?:时政要闻|医保新闻|机构设置|信息公开|统计数据|机关党建)\s*$", ""),
    (rf"(?<={_HAN})[ \t]+(?=[{_HAN}\d])", ""), (rf"(?<=\d)[ \t]+(?={_HAN})", ""), (r"(?<!\d)([12])[ \t]+(\d{3})(?=年)", "$1$2"), (r"(?<!\d)([12]\d)[ \t]+(\d{2})(?=年)", "$1$2"),
    (r"(?<!\d)([12]\d{2})[ \t]+(\d)(?=年)", "$1$2"), (r"(?<!\d)(1)[ \t]+([0-2])(?=月)", "$1$2"), (r"(?<!\d)([12])[ \t]+(\d)(?=日)", "$1$2"), (r"(?<!\d)(3)[ \t]+([01])(?=日)", "$1$2"),
    (r"(?<!\d)(\d)[ \t]+(\d)(?=[.]\d+[ \t]*%)", "$1$2"), (rf"(?<=[{_HAN}\d])[ \t]*-[ \t]*(?=\d)", "-"),
    (rf"(?:(?<={_HAN}),|,(?=\s*{_HAN}))", "，"), (rf"(?:(?<={_HAN});|;(?=\s*{_HAN}))", "；"), (rf"(?:(?<={_HAN}):|:(?=\s*{_HAN}))", "："), (rf"(?:(?<={_HAN})!|!(?=\s*{_HAN}))", "！"),
    (rf"(?:(?<={_HAN})[?]|[?](?=\s*{_HAN}))", "？"), (rf"(?<={_HAN})[.](?=\s*(?:{_HAN}|$))", "。"), (rf"[(](?=[ \t]*[{_HAN}\d])", "（"), (rf"(?<=[{_HAN}\d])[ \t]*[)]", "）"),
    (rf"(?<=[{_HAN}\d%])[ \t]+(?=[\p{{P}}%])", ""), (rf"(?<=[\p{{P}}%])[ \t]+(?=[{_HAN}\d\p{{P}}%])", ""), (r"(?<=[A-Za-z])[ \t]+(?=[\p{P}\p{S}])", ""), (r"(?<=[\p{P}\p{S}])[ \t]+(?=[\p{P}\p{S}])", ""),
    (r"(?<=[\p{Ps}，、；：！？。])[ \t]+(?=[A-Za-z])", ""), (r"(?m)(?<!^[ \t]{0,3})([/／+\-‐‑‒–—―=＝×÷*＊%％])[ \t]+(?=[A-Za-z])", "$1"), (rf"(?<=[，、；：])\r?\n(?=[{_HAN}\d])", ""), (r"(?:[ \t]*\r?\n){3,}", "\n\n"),
]


def looked_ahead(pattern: str) -> str:
    """The same pattern with a look at its first character before its look behind, which is dear at every place of a text."""
    found = re.match(r"\(\?<[=!](?:[^()\[\]]|\[[^\]]*\])*\)(\[ \\t\][+*])(-|\[\)\])?", pattern)
    if found and (found[1].endswith("+") or found[2]):
        return rf"(?=[ \t{(found[2] or '').strip('[]')}]){pattern}"
    found = re.match(r"\(\?:\(\?<=[^()]*\)([,;:!]|\[\?\])\|", pattern) or re.match(r"\(\?<=[^()]*\)(\[\.\])", pattern)
    return rf"(?={found[1]}){pattern}" if found else pattern


def replace_all(text: Column, rules: list[tuple[str, str]] = WEB_RULES) -> Column:
    for pattern, new in rules:
        text = F.regexp_replace(text, looked_ahead(pattern), new)
    return text


def unicode_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(empty(text), r"[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]", " "))
