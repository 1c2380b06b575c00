"""Queries for the line operators (W rows of the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import terms
from ..functions.python_text import validated_noise_deletion
from ..operators import lines as w
from .build import Query, literal, projection, quoted, read, values
from .scalars import TEXTS, _space, strip

c = F.col
#: Terms that occur in the test tables, beside the defaults.
DATA_TERMS = ["Licensed under", "Copyright", "| ", "That", "der ", *terms.NOISE_TERMS[:4]]
_LINES = "list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]'), lambda l: " + strip("l") + "), lambda l: l <> '')"


def _list(names: list[str]) -> str:
    return "[" + ", ".join(map(quoted, names)) + "]"


def _hits(text: str, names: list[str]) -> str:
    return f"list_filter({_list(names)}, lambda t: contains({text}, t))"


_NOISY = f"(length(l) <= 60 AND len({_hits('l', DATA_TERMS)}) > 0)"
_INLINE_RE2 = [p.replace(r"\b搜\s*索\b", r"\b搜\s*索\b") for p in w.INLINE_PATTERNS]
SOFT = terms.NAV_TERMS + terms.FOOTER_TERMS + terms.PREV_NEXT_TERMS + ["Licensed under", "Apache"]


def _inline(x: str) -> str:
    for term in terms.HARD_LITERALS:
        x = f"replace({x}, {quoted(term)}, ' ')"
    for p in _INLINE_RE2:
        x = f"regexp_replace({x}, {quoted(p)}, ' ', 'g')"
    return _space(x)


def _nav(s: str) -> str:
    full = " OR ".join(f"regexp_full_match({s}, {quoted(p)})" for p in w.NAV_FULL_LINES)
    n = f"len({_hits(s, SOFT)})"
    return f"({s} = '' OR {s} IN ({', '.join(map(quoted, w.NAV_WORDS))}) OR (regexp_matches({s}, {quoted(w.VIDEO_SHELL)}) AND length({s}) < 500) OR ({n} > 0 AND length({s}) < 120) OR {n} >= 5 OR (regexp_matches({s}, {quoted(w.TAIL_START)}) AND length({s}) < 220) OR {full})"


def _cleaned(spark, d) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text").unionByName(literal(spark, *TEXTS))
    return w.clean_document(docs, soft=SOFT).select("doc_id", "clean_text", "head_cut", "inline_strip", "line_strip", "tail_cut")


CHROME = ("doc_id bigint, text string", [
    (-1, "首页 > 当前位置 > 政务公开 通知公告\n正文第一行很长很长\n第二行"), (-2, "关于做好工作的通知 发布时间：2024-03-05 10:20 来源：某委 分享到： 正文开始了\n后文"),
    (-3, "正文" * 60 + "\n第二段\n版权所有 某单位\n邮编 100000"), (-4, "首页\n联系我们\n真正的正文在这里，没有导航词\n第二行"), (-5, "普通文本，没有标记"), (-6, ""),
])
MARKDOWN = ("doc_id bigint, text string", [
    (-1, "# 标题\n\n| a | b | c |\n|---|---|---|\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |\n尾"), (-2, "|x|y|\n|:-:|---|\n|1|2|\n\n文\n|p|q|\n|---|---|"), (-3, "![图](http://a/b.png)\n<p>残留</p> �"),
    (-4, "第一章 总则\n一、目的\n1. 列表\n附件：表\n来源：某委\n二〇二四年\n2024年3月5日\n普通段落"), (-5, "附件：\n请查看附件 通知.pdf\n首页\n机构\n新闻\n主办单位 甲\n邮编 1"), (-6, "根据《某法》\n〔2024〕5 号\n某某委员会 2024年1月2日\n主办单位：甲\n这是一行足够长的文字" + "长" * 50),
])


def _elements(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text").unionByName(literal(spark, *MARKDOWN))
    return w.content_elements(docs)


def _removed(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    after = docs.withColumn("text", w.remove_noise_lines(c("text"), DATA_TERMS)[0])
    before = docs.withColumn("text", F.array_join(F.filter(F.transform(w.split_lines(c("text")), lambda x: F.trim(x)), lambda x: x != ""), "\n"))
    return w.removed_lines(before, after, "doc_id")


def _noise_removed(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text").unionByName(literal(spark, *TEXTS))
    rows = docs.select("doc_id", w.split_noise(c("text"), DATA_TERMS).alias("r"))
    return rows.select("doc_id", c("r.kept").alias("clean"), F.size("r.removed").cast("long").alias("n_removed"), F.array_join(w.found_terms(c("r.kept"), DATA_TERMS), ",").alias("residual"))


def _table_blocks(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text").unionByName(literal(spark, *MARKDOWN))
    lines = F.split("text", "\n", -1)
    return docs.select("doc_id", F.size(F.filter(w.table_block_numbers(lines), lambda x: x)).cast("long").alias("protected"), F.size(F.filter(lines, w.is_table_line)).cast("long").alias("table_lines"))


_TL = "list_transform(string_split(text, chr(10)), lambda l: regexp_matches(l, '^\\s*\\|(?:[^|]*\\|){2,}\\s*$') OR regexp_matches(l, '^\\s*\\|?\\s*:?-{3,}:?\\s*(?:\\|\\s*:?-{3,}:?\\s*)+\\|?\\s*$'))"
_DOCS_MD = f"(SELECT doc_id, text FROM documents UNION ALL VALUES {values(MARKDOWN[1])})"
_ELEMENT = f"""CASE WHEN regexp_matches(l, '{w.ELEMENT_HEADING}') THEN CASE WHEN length(l) < 80 THEN 'heading' ELSE 'policy_clause' END
 WHEN regexp_matches(l, '{w.ELEMENTS[0][1]}') THEN 'attachment_ref' WHEN regexp_matches(l, '{w.ELEMENTS[1][1]}') THEN 'publish_metadata_line' WHEN regexp_matches(l, '{w.ELEMENTS[2][1]}') THEN 'list_item'
 WHEN regexp_matches(l, '{w.ELEMENT_SIGNATURE}') AND length(l) < 40 THEN 'signature_date' ELSE 'paragraph' END"""


def _metric(name: str):
    return lambda: (lambda x: x.cast("long") if name not in {"is_empty", "markdown_table", "html_residue"} else x)(w.markdown_metrics(c("text"), c("text"))[name])


def _protect(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text").unionByName(literal(spark, *MARKDOWN))
    rows = docs.withColumn("p", w.protect_lines(c("text"), F.lit(""), c("doc_id").cast("string")))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.transform("p", lambda x: x["kind"])))), ",")
    back = w.restore_lines(F.transform("p", lambda x: x["shown"]), c("p"))
    return rows.select("doc_id", kinds.alias("kinds"), F.size(F.filter("p", lambda x: x["kind"].isNotNull())).cast("long").alias("n_protected"), (back == c("text")).alias("restored"))


def _noise_deletion(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    first = F.get(F.split("text", "\n"), 0)
    segment = F.array(F.struct(F.lit("navigation").alias("noise_type"), F.lit(1).alias("start_line"), F.array(first).alias("exact_lines"), F.lit(0.95).alias("confidence")))
    out = docs.withColumn("r", validated_noise_deletion(c("text"), segment, ["navigation"], 0.9, 0.3, 50))
    return out.select("doc_id", c("r.status").alias("status"), c("r.removed_lines").alias("removed_lines"), F.array_join("r.issues", ",").alias("issues"))


RULES = [{"id": "licence", "pattern": "Licensed under.*", "start": 0.65}, {"id": "nav", "lines": ["首页", "That it."], "end": 0.35}]
_PLACE = "((i - 1)::DOUBLE / greatest(len(ls) - 1, 1))"

QUERIES: dict[str, Query] = {
    "W-01": projection("documents", "doc_id", {"hits": (lambda: F.array_join(w.found_terms(c("text"), DATA_TERMS), ","), f"array_to_string({_hits(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')', DATA_TERMS)}, ',')")}, TEXTS),
    "W-02": (_noise_removed, f"SELECT doc_id, clean, n_removed, array_to_string({_hits('clean', DATA_TERMS)}, ',') AS residual FROM (SELECT doc_id, {strip(f'array_to_string(list_filter({_LINES}, lambda l: NOT {_NOISY}), chr(10))')} AS clean, len(list_filter({_LINES}, lambda l: {_NOISY})) AS n_removed FROM (SELECT doc_id, text FROM documents UNION ALL VALUES {values(TEXTS[1])}))"),
    "W-03": projection("documents", "doc_id", {
        "nav": (lambda: w.count_noise(c("text"), terms.HARD_LITERALS, terms.NAV_TERMS + ["That"], terms.FOOTER_TERMS + ["Licensed"])[0].cast("long"), f"len({_hits('coalesce(text, chr(32))', terms.HARD_LITERALS + terms.NAV_TERMS + ['That'])}) + CASE WHEN regexp_matches(coalesce(text, ''), {quoted(w.VIDEO_SHELL)}) THEN 3 ELSE 0 END"),
        "footer": (lambda: w.count_noise(c("text"), terms.HARD_LITERALS, terms.NAV_TERMS, terms.FOOTER_TERMS + ["Licensed"])[1].cast("long"), f"len({_hits('coalesce(text, chr(32))', terms.FOOTER_TERMS + ['Licensed'])})"),
    }, TEXTS),
    "W-04": projection("documents", "doc_id", {"clean": (lambda: w.remove_inline_noise(F.coalesce(c("text"), F.lit(""))), _inline("coalesce(text, '')"))}, TEXTS),
    "W-05": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *CHROME)).select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line", "l")).select("doc_id", c("line").cast("long").alias("line"), w.is_nav_line(c("l"), SOFT).alias("nav")), f"SELECT doc_id, (i - 1)::BIGINT AS line, {_nav('(' + strip('l') + ')')} AS nav FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM (SELECT doc_id, text FROM documents UNION ALL VALUES {values(CHROME[1])})))"),
    "W-06": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *CHROME)).select("doc_id", w.truncate_head(c("text"), soft=SOFT).alias("text")), None),
    "W-07": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *CHROME)).select("doc_id", w.truncate_tail(c("text")).alias("text")), None),
    "W-08": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *CHROME)).select("doc_id", w.strip_noise_lines(c("text"), soft=SOFT).alias("text")), f"SELECT doc_id, {_space('array_to_string(list_filter(list_transform(regexp_split_to_array(text, ' + quoted(chr(92) + 'n') + '), lambda l: ' + _inline('l') + '), lambda l: NOT ' + _nav('l') + '), chr(10))')} AS text FROM (SELECT doc_id, text FROM documents UNION ALL VALUES {values(CHROME[1])})"),
    "W-09": (_cleaned, None),
    "W-10": projection("documents", "doc_id", {"text": (lambda: w.restore_table_lines(c("text"), F.lit("x")), "CASE WHEN len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: starts_with(" + strip("l") + ", '|'))) > 0 THEN 'x' || chr(10) || array_to_string(list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: starts_with(" + strip("l") + ", '|')), chr(10)) ELSE 'x' END")}, MARKDOWN),
    "W-11": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *MARKDOWN)).select("doc_id", w.deterministic_clean(c("text"), F.get(F.split("text", "\n"), 0)).alias("text")), None),
    "W-12": (lambda s, d: read(s, d, "documents").select("doc_id", w.apply_line_rules(c("text"), RULES).alias("text")), f"SELECT doc_id, array_to_string(list_filter(ls, lambda l, i: NOT ((regexp_full_match({strip('l')}, 'Licensed under.*') AND {_PLACE} >= 0.65 AND NOT regexp_matches(l, 'https?://|\\]\\(')) OR ({strip('l')} IN ('首页', 'That it.') AND {_PLACE} <= 0.35))), chr(10)) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)"),
    "W-13": (_table_blocks, f"SELECT doc_id, len(list_filter(list_transform(range(1, len(f) + 1), lambda i: f[i] AND (coalesce(CASE WHEN i > 1 THEN f[i - 1] END, false) OR coalesce(f[i + 1], false))), lambda x: x)) AS protected, len(list_filter(f, lambda x: x)) AS table_lines FROM (SELECT doc_id, {_TL} AS f FROM {_DOCS_MD})"),
    "W-14": (_protect, None),
    "W-15": (lambda s, d: _protect(s, d).groupBy("restored").agg(F.count(F.lit(1)).alias("n")), f"SELECT true AS restored, count(*) AS n FROM {_DOCS_MD}"),
    "W-16": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *MARKDOWN)).select("doc_id", F.array_join(w.anomalies(c("text"), F.lit("")), ",").alias("flags")), None),
    "W-17": (_elements, f"SELECT doc_id, doc_id || '#e' || lpad(i::VARCHAR, 4, '0') AS element_id, {_ELEMENT} AS type, l AS text, i::INTEGER AS \"order\", (CASE WHEN {_ELEMENT} IN ('heading', 'policy_clause') THEN 1 ELSE 0 END)::INTEGER AS level FROM (SELECT doc_id, unnest({_LINES}) AS l, unnest(range(1, len({_LINES}) + 1)) AS i FROM {_DOCS_MD})"),
    "W-18": (lambda s, d: read(s, d, "documents").select("doc_id", "text").unionByName(literal(s, *MARKDOWN)).select("doc_id", w.markdown_tables(c("text")).alias("t")).select("doc_id", c("t.n_tables").cast("long").alias("n_tables"), c("t.n_rows").cast("long").alias("n_rows")), f"SELECT doc_id, len(regexp_extract_all(k, 'P*S[PS]*')) AS n_tables, coalesce(list_sum(list_transform(regexp_extract_all(k, 'P*S[PS]*'), lambda b: length(b) - 1)), 0)::BIGINT AS n_rows FROM (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN regexp_matches(l, '^\\s*\\|*\\s*:?-{{3,}}:?\\s*(?:\\|\\s*:?-{{3,}}:?\\s*)+\\|*\\s*$') THEN 'S' WHEN contains(l, '|') THEN 'P' ELSE '-' END), '') AS k FROM {_DOCS_MD})"),
    "W-19": projection("documents", "doc_id", {
        "headings": (_metric("headings"), "len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '^#{1,6}\\s+')))"), "table_candidates": (_metric("table_candidates"), "len(list_filter(string_split(text, chr(10)), lambda l: contains(l, '|')))"),
        "images": (_metric("images"), "len(regexp_extract_all(text, '!\\[[^\\]]*\\]\\([^)]*\\)'))"), "replacement_characters": (_metric("replacement_characters"), "length(text) - length(replace(text, '�', ''))"),
        "very_long_lines": (_metric("very_long_lines"), "len(list_filter(string_split(text, chr(10)), lambda l: length(l) > 2000))"), "html_residue": (_metric("html_residue"), "regexp_matches(text, '</?[A-Za-z][^>]*>')"),
        "warnings": (lambda: F.array_join(w.markdown_metrics(c("text"), c("text"))["warnings"], ","), f"concat_ws(',', CASE WHEN {strip('text')} = '' THEN 'empty_content' END, CASE WHEN contains(text, '�') THEN 'replacement_character_detected' END, CASE WHEN len(list_filter(string_split(text, chr(10)), lambda l: length(l) > 2000)) > 0 THEN 'very_long_line_detected' END, CASE WHEN regexp_matches(text, '</?[A-Za-z][^>]*>') THEN 'html_residue_detected' END)"),
    }, MARKDOWN),
    "W-20": (_noise_deletion, None),
    "W-21": (_removed, f"SELECT doc_id, l AS line, count(*) AS n FROM (SELECT doc_id, unnest({_LINES}) AS l FROM documents) WHERE {_NOISY} GROUP BY ALL"),
}
