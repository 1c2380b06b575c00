"""Operators on the lines of a text. All native: lines are arrays, rules are expressions on their elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import terms
from ..functions.scalars import empty, let, normalize_space, strip

_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

#: Patterns of page chrome inside lines, at the head, at the tail, and of video shells.
INLINE_PATTERNS = [
    r"【?\s*字体\s*[:：]?\s*大\s*中\s*小\s*】?",
    r"字号\s*[:：]\s*\[?\s*大\s*中\s*小\s*\]?",
    r"\[\s*字体\s*[:：]?\s*大\s*中\s*小\s*\]",
    r"\[\s*智能咨询\s*\]\(\s*['\"]?智能咨询['\"]?\s*\)",
    r"\[\s*市民网页\s*\]\(\s*['\"]?市民网页['\"]?\s*\)",
    r"\[\s*!\[\]\([^)]+\)\s*\]\([^)]+\)",
    r"\[\s*(?:首\s*页|机\s*构|新\s*闻|信\s*息|服\s*务|互\s*动|专\s*题)\s*\]\([^)]*\)",
    r"#{1,6}\s*[:：]\s*分享",
    r"(?m)^\s*#{1,6}\s*$",
    r"\b搜\s*索\b",
    r"(?:信息来源|来源|文章来源)\s*[:：]\s*[^\n。；;]{0,80}",
    r"(?:责任编辑|责任编校|编辑|责编|审核|校对|签发)\s*[:：]\s*[^\n。；;]{0,40}",
    r"(?:时间|发布时间|发布日期)\s*[:：]\s*\d{4}[-年]\d{1,2}[-月]\d{1,2}(?:[日\s]\s*\d{1,2}:\d{2}(?::\d{2})?)?",
    r"https?://[^\s，。；；）)】]+",
]
HEAD_CHROME = (
    r"^(?:\s|[\x{a0}>›/|·-]|网站支持IPv6|网站支持ipv6|长者助手|长者版|长者浏览模式|无障碍(?:浏览|模式)?|"
    r"首页|网站首页|当前位置|机构职能|政务动态|政务公开|政务服务|互动交流|"
    r"新闻中心|工作动态|通知公告|政策法规|政策解读|专题专栏|要闻速递|棣栭〉|缃戠珯棣栭〉|褰撳墠浣嶇疆)+"
)
META_BLOCK = (
    r"(?s)^.{0,300}?(?:时间|发布时间|发布日期)\s*[:：]\s*\d{4}[-年]\d{1,2}[-月]\d{1,2}"
    r"(?:[日\s]\s*\d{1,2}:\d{2}(?::\d{2})?)?.{0,160}?(?:分享到[:：]?|【?\s*字体\s*[:：]?\s*大\s*中\s*小\s*】?)"
)
VIDEO_SHELL = r"(?i)(?:刷新\s+重试\s+诊断|code[:：]\s*vid:|uuid:|requestId:|播放时间[:：]|00:00\s*/\s*00:00)"
TAIL_START = (
    r"(?:版权所有|Copyright|Reference numbers|WHO Reference Number|Number of pages|Editors|WHO Team|"
    r"ICP备案|公安备案|公网安备|政府网站标识码|网站标识码|主办单位|承办单位|主办[:：]|承办[:：]|技术支持|网站地图|联系我们|网站声明|"
    r"联系电话|联系地址|寄信地址|邮政编码|邮编|国家部委|省政府及省直部门|政府网站|部门网站|下属单位|网站信息|粤ICP备20001927号-1|新媒体矩阵|"
    r"广州健康通微信公众号|广州健康通小程序|@健康广州微博|广州卫健委南方号|广州卫健委微信公众号|广州卫健委微信视频号|广州地区互联网医院导引平台|"
    r"中共广东省纪委|纪检监察组|上一篇[:：]|下一篇[:：]|相关链接|相关附件|相关文件|"
    "鐗堟潈鎵€鏈?|ICP澶囨\ue50d|浜\ue100叕缃戝畨澶?|缃戠珯鏍囪瘑鐮?|鑱旂郴鐢佃瘽|鎶€鏈\ue21b敮鎸?|瀹樻柟寰\ue1bb俊)"
)
NAV_FULL_LINES = [
    r"\[\s*(?:智能咨询|市民网页|首\s*页|机\s*构|新\s*闻|信\s*息|服\s*务|互\s*动|专\s*题)\s*\]\([^)]*\)",
    r"\[\s*!\[\]\([^)]+\)\s*\]\([^)]+\)",
    r"(?:搜\s*索|#{1,6}\s*[:：]\s*分享)",
]
NAV_WORDS = ["首页", "返回", "TOP", "关于我们", "404 Not Found", "nginx"]
TABLE_LINE = r"^\s*\|(?:[^|]*\|){2,}\s*$"
TABLE_SEPARATOR = r"^\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?\s*$"
PROTECTED_KINDS = {
    "heading": r"^\s{0,3}#{1,6}\s+\S",
    "attachment_link": r"(?i)\[[^\]]+\]\([^\s)]+\.(?:pdf|docx?|xlsx?|pptx?|rar|zip)(?:\?[^)]*)?\)",
    "document_number": r"(?:〔|\[)\d{4}(?:〕|\])\s*\d+\s*号|第\s*\d+\s*号",
    "signature_date": r"(?:人民政府|委员会|卫生健康|疾病预防控制|管理局).{0,20}(?:\d{4}年\d{1,2}月\d{1,2}日)?\s*$",
    "clause": r"^\s*(?:[一二三四五六七八九十]+、|（[一二三四五六七八九十]+）|\([一二三四五六七八九十]+\)|\d+[.、]|（\d+）)\s*\S",
    "policy_basis": r"根据《[^》]+》|依据《[^》]+》|按照《[^》]+》",
}
FOOTER_LABEL = r"^\s*(?:主办单位|承办单位|联系电话|邮编|版权所有)[：:]"
ELEMENTS = [
    ("attachment_ref", r"^附件[:：]"),
    ("publish_metadata_line", r"^(来源|发布时间|发布日期|索引号)[:：]"),
    ("list_item", r"^\d+[、.．]"),
]
ELEMENT_HEADING = r"^(第[一二三四五六七八九十百]+[章节条]|[一二三四五六七八九十]+[、.．])"
ELEMENT_SIGNATURE = r"\d{4}年\d{1,2}月\d{1,2}日$"


def split_lines(text: Column) -> Column:
    """Lines by any line boundary; a final line end makes no further line."""
    return let(F.split(empty(text), _BREAK, -1), lambda p: F.when(F.get(p, F.size(p) - 1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def _may_hold(literals: list[str], patterns: str = "") -> str:
    """A cheap pattern that a text must match to hold one of ``literals`` or of ``patterns``: a character beyond Latin-1, or one
    of those literals that have none."""
    plain = [rf"\Q{x}\E" for x in literals if all(ord(ch) < 256 for ch in x)]
    return "|".join([r"[^\x00-ÿ]", *plain, *([patterns] if patterns else [])])


#: What INLINE_PATTERNS, and the tests of navigation lines, need beside characters beyond Latin-1.
_INLINE_PLAIN = r"#|!\[\]\(|https?://"
_NAV_PLAIN = r"(?i:code|uuid:|requestid:|00:00|copyright|reference number|number of pages|editors|who team)|!\[\]"


def found_terms(text: Column, names: list[str]) -> Column:
    """Terms that occur in the text, in list order."""
    return F.filter(F.array(*map(F.lit, names)), lambda t: F.contains(empty(text), t))


def split_noise(text: Column, names: list[str], longest: int = 60) -> Column:
    """struct<kept, removed>: the text without its short lines with a term and blank lines, and the lines that went."""
    lines = F.filter(F.transform(split_lines(text), strip), lambda x: x != "")
    noisy = lambda x: (F.length(x) <= longest) & x.rlike("|".join(rf"\Q{n}\E" for n in names))
    marked = F.transform(lines, lambda x: F.struct(x.alias("line"), noisy(x).alias("noisy")))
    pick = lambda m, which: F.transform(F.filter(m, which), lambda x: x["line"])
    return let(marked, lambda m: F.struct(strip(F.array_join(pick(m, lambda x: ~x["noisy"]), "\n")).alias("kept"), pick(m, lambda x: x["noisy"]).alias("removed")))


def remove_noise_lines(text: Column, names: list[str], longest: int = 60) -> tuple[Column, Column, Column]:
    """(text, removed lines, terms that are still in it): short lines with a term go, and so do blank lines."""
    out = split_noise(text, names, longest)
    return out["kept"], out["removed"], found_terms(out["kept"], names)


def count_noise(text: Column, hard: list[str], nav: list[str], footer: list[str]) -> tuple[Column, Column]:
    shell = F.when(empty(text).rlike(VIDEO_SHELL), 3).otherwise(0)
    return F.size(found_terms(text, hard + nav)) + shell, F.size(found_terms(text, footer))


def remove_inline_noise(text: Column, hard: list[str] | None = None, patterns: list[str] | None = None) -> Column:
    """Literals, then patterns, one after another, each replaced by a space; a text that can't hold any is only normalised."""
    whole = text
    for term in terms.HARD_LITERALS if hard is None else hard:
        text = F.replace(text, F.lit(term), F.lit(" "))
    for pattern in INLINE_PATTERNS if patterns is None else patterns:
        text = F.regexp_replace(text, pattern, " ")
    if patterns is not None:
        return normalize_space(text)
    return F.when(whole.rlike(_may_hold(terms.HARD_LITERALS if hard is None else hard, _INLINE_PLAIN)), normalize_space(text)).otherwise(normalize_space(whole))


def is_nav_line(line: Column, soft: list[str] | None = None) -> Column:
    soft = terms.NAV_TERMS + terms.FOOTER_TERMS + terms.PREV_NEXT_TERMS if soft is None else soft

    def test(s):
        hits, n = F.size(found_terms(s, soft)), F.length(s)
        out = (s == "") | s.isin(*NAV_WORDS) | (s.rlike(VIDEO_SHELL) & (n < 500)) | (s.rlike(TAIL_START) & (n < 220)) | let(hits, lambda k: ((k > 0) & (n < 120)) | (k >= 5))
        for pattern in NAV_FULL_LINES:
            out = out | s.rlike(rf"\A{pattern}\z")
        return F.when(s.rlike(guard), out).otherwise((s == "") | s.isin(*NAV_WORDS))

    guard = _may_hold(soft, _NAV_PLAIN)
    return let(strip(line), test)


def truncate_head(text: Column, window: int = 500, least: int = 10, lines: int = 12, soft: list[str] | None = None) -> Column:
    """Cut a leading metadata block, else leading chrome, else leading navigation lines."""

    def by_lines(parts):
        first = F.array_position(F.transform(F.slice(parts, 1, lines), lambda x: is_nav_line(x, soft)), F.lit(False)).cast("int")
        return let(first, lambda k: F.when(k > 0, strip(F.array_join(F.slice(parts, k, F.size(parts)), "\n"))).otherwise(text))

    def cut(meta, trimmed):
        rest = strip(F.substring(text, F.length(meta) + 1, F.length(text)))
        return F.when(text == "", text).when(meta != "", rest).when(F.length(text) - F.length(trimmed) >= least, trimmed).otherwise(let(split_lines(text), by_lines))

    return let(F.regexp_extract(F.left(text, F.lit(window)), META_BLOCK, 0), lambda meta: let(strip(F.regexp_replace(text, HEAD_CHROME, "")), lambda trimmed: cut(meta, trimmed)))


def truncate_tail(text: Column, share: float = 0.45) -> Column:
    """Cut at the line of the first footer marker beyond ``share`` of the text."""

    def begins(parts):
        # the first part stands before the first marker; every other one begins with a marker
        start = F.struct(F.length(F.get(parts, 0)).alias("at"), F.lit(-1).alias("best"))

        def step(a, part):
            hit = (a["best"] < 0) & (a["at"] > F.length(text) * share)
            return F.struct((a["at"] + F.length(part)).alias("at"), F.when(hit, a["at"]).otherwise(a["best"]).alias("best"))

        return F.aggregate(F.slice(parts, 2, F.size(parts)), start, step)["best"]

    def cut(best):
        before = F.left(text, best)
        by_line = F.regexp_extract(before, r"(?s)\A(.+)\n[^\n]*\z", 1)
        return F.when(best < 0, text).otherwise(let(by_line, lambda x: F.when(x != "", strip(x)).otherwise(strip(before))))

    marked = F.split(F.regexp_replace(text, TAIL_START, "\u0001$0"), "\u0001", -1)
    return let(let(marked, begins), cut)


def strip_noise_lines(text: Column, hard: list[str] | None = None, soft: list[str] | None = None) -> Column:
    inner = F.transform(split_lines(text), lambda x: remove_inline_noise(x, hard))
    return normalize_space(F.array_join(F.transform(F.filter(inner, lambda x: ~is_nav_line(x, soft)), strip), "\n"))


def clean_document(df: DataFrame, text: str = "text", hard: list[str] | None = None, soft: list[str] | None = None) -> DataFrame:
    """Add clean_text and the four flags head_cut, inline_strip, line_strip and tail_cut."""
    df = df.withColumn("__0", normalize_space(F.col(text)))
    for i, (name, f) in enumerate((("head_cut", lambda t: truncate_head(t, soft=soft)), ("inline_strip", lambda t: remove_inline_noise(t, hard)), ("line_strip", lambda t: strip_noise_lines(t, hard, soft)), ("tail_cut", truncate_tail))):
        df = df.withColumn(f"__{i + 1}", f(F.col(f"__{i}"))).withColumn(name, F.col(f"__{i + 1}") != F.col(f"__{i}"))
    return df.withColumn("clean_text", normalize_space(F.col("__4"))).drop(*[f"__{i}" for i in range(5)])


def restore_table_lines(before: Column, after: Column, prefix: int = 30) -> Column:
    """Append table lines of the original whose beginnings cleaning has removed."""
    has = F.filter(split_lines(before), lambda x: strip(x).startswith("|"))
    lost = F.filter(has, lambda x: ~F.contains(after, F.left(strip(x), F.lit(prefix))))
    return F.when(F.size(lost) > 0, F.concat(after, F.lit("\n"), F.array_join(lost, "\n"))).otherwise(after)


def is_table_line(line: Column) -> Column:
    return line.rlike(TABLE_LINE) | line.rlike(TABLE_SEPARATOR)


def table_block_numbers(lines: Column) -> Column:
    """For every line, whether it stands in a block of two table lines or more."""
    near = lambda flags, i: F.coalesce(F.get(flags, i), F.lit(False))
    return let(F.transform(lines, is_table_line), lambda flags: F.transform(flags, lambda x, i: x & (near(flags, i - 1) | near(flags, i + 1))))


def protected_kind(line: Column, in_table: Column, title: Column, long_line: int = 50) -> Column:
    """Why a line is exempt from line deduplication, or null."""
    k = PROTECTED_KINDS
    out = F.when(in_table, "table").when(line.rlike(k["heading"]), "heading").when((strip(title) != "") & (strip(line) == strip(title)), "title")
    out = out.when(line.rlike(k["attachment_link"]), "attachment_link").when(line.rlike(k["document_number"]), "document_number")
    out = out.when(line.rlike(k["signature_date"]) & ~line.rlike(FOOTER_LABEL), "signature_date").when(line.rlike(k["clause"]), "clause").when(line.rlike(k["policy_basis"]), "policy_basis")
    return out.when((F.length(strip(line)) >= long_line) & ~line.rlike(FOOTER_LABEL), "long_line")


def protect_lines(text: Column, title: Column, key: Column, long_line: int = 50) -> Column:
    """array<struct<line,kind,shown>>: ``shown`` is a placeholder for protected lines, and the line itself for others."""
    lines = F.split(empty(text), "\n", -1)
    token = F.upper(F.left(F.sha2(key, 256), F.lit(16)))
    kinds = F.transform(F.arrays_zip(lines.alias("l"), table_block_numbers(lines).alias("t")), lambda x, i: F.struct(x["l"].alias("line"), protected_kind(x["l"], x["t"], title, long_line).alias("kind"), i.alias("i")))
    return F.transform(kinds, lambda x: F.struct(x["line"], x["kind"], F.when(x["kind"].isNull(), x["line"]).otherwise(F.concat(F.lit("__KEPT_"), token, F.lit("_"), F.lpad(x["i"].cast("string"), 5, "0"), F.lit("__"))).alias("shown")))


def restore_lines(shown: Column, protected: Column) -> Column:
    """Lines with their placeholders replaced; null if a placeholder is missing or there more than once."""
    table = F.map_from_entries(F.transform(F.filter(protected, lambda x: x["kind"].isNotNull()), lambda x: F.struct(x["shown"], x["line"])))


    def put_back(known):
        there = F.filter(shown, lambda s: F.map_contains_key(known, s))
        once = (F.size(there) == F.size(known)) & (F.size(F.array_distinct(there)) == F.size(known))
        return F.when(once, F.array_join(F.transform(shown, lambda s: F.coalesce(F.element_at(known, s), s)), "\n"))

    return let(table, put_back)


def classify_element(line: Column) -> Column:
    n = F.length(line)
    out = F.when(line.rlike(ELEMENT_HEADING), F.when(n < 80, "heading").otherwise("policy_clause"))
    for name, pattern in ELEMENTS:
        out = out.when(line.rlike(pattern), name)
    return out.when(line.rlike(ELEMENT_SIGNATURE) & (n < 40), "signature_date").otherwise("paragraph")


def content_elements(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per non-blank line: element_id, type, text, order, level."""
    lines = F.filter(F.transform(split_lines(F.col(text)), strip), lambda x: x != "")
    rows = df.select(F.col(doc_id), F.posexplode(lines).alias("i", "line"))
    kind = classify_element(F.col("line"))
    return rows.select(doc_id, F.concat(F.col(doc_id).cast("string"), F.lit("#e"), F.lpad((F.col("i") + 1).cast("string"), 4, "0")).alias("element_id"), kind.alias("type"), F.col("line").alias("text"), (F.col("i") + 1).alias("order"), F.when(kind.isin("heading", "policy_clause"), 1).otherwise(0).alias("level"))


def is_markdown_separator(line: Column) -> Column:
    s = strip(line)
    parts = F.transform(F.split(F.regexp_replace(s, r"^\|+|\|+$", ""), r"\|", -1), strip)
    return F.contains(s, F.lit("|")) & (F.size(parts) >= 2) & F.forall(parts, lambda p: p.rlike(r"\A:?-{3,}:?\z"))


def markdown_tables(text: Column) -> Column:
    """struct<n_tables,n_rows>: a separator line with the lines that hold a ``|`` around it is a table."""
    kinds = F.array_join(F.transform(split_lines(text), lambda x: F.when(is_markdown_separator(x), "S").when(F.contains(x, F.lit("|")), "P").otherwise("-")), "")
    # a table begins with the rows above its separator and takes all rows below it
    blocks = F.regexp_extract_all(kinds, F.lit("P*S[PS]*"), F.lit(0))
    return F.struct(F.size(blocks).alias("n_tables"), F.aggregate(F.transform(blocks, lambda b: F.length(b) - 1), F.lit(0), lambda a, n: a + n).alias("n_rows"))


def markdown_metrics(raw: Column, clean: Column) -> dict[str, Column]:
    lines = split_lines(clean)
    number = lambda test: F.size(F.filter(lines, test))
    table = r"^\s*\|?(?:\s*:?-{3,}:?\s*\|)+\s*:?-{3,}:?\s*\|?\s*$"
    replaced = F.length(clean) - F.length(F.replace(clean, F.lit("�"), F.lit("")))
    blank, long, html = strip(clean) == "", number(lambda x: F.length(x) > 2000), clean.rlike(r"</?[A-Za-z][^>]*>")
    warnings = F.array_compact(F.array(F.when(blank, "empty_content"), F.when(replaced > 0, "replacement_character_detected"), F.when(long > 0, "very_long_line_detected"), F.when(html, "html_residue_detected")))
    return {
        "is_empty": blank, "raw_characters": F.length(raw), "clean_characters": F.length(clean), "raw_lines": F.size(split_lines(raw)), "clean_lines": F.size(lines),
        "headings": number(lambda x: x.rlike(r"^#{1,6}\s+")), "table_candidates": number(lambda x: F.contains(x, F.lit("|"))), "images": F.regexp_count(clean, F.lit(r"!\[[^\]]*\]\([^)]*\)")),
        "replacement_characters": replaced, "nul_characters": F.length(raw) - F.length(F.replace(raw, F.lit("\0"), F.lit(""))), "very_long_lines": long, "markdown_table": number(lambda x: x.rlike(table)) > 0, "html_residue": html, "warnings": warnings,
    }


_FOOTERS = r"主办单位|承办单位|ICP备|公网安备|网站地图|新媒体矩阵|联系电话|邮编"
_FILE = r"(?i)\.(?:pdf|docx?|xlsx?|pptx?|rar|zip)(?:\b|\)|\?|$)"
_DATE_LINE = r"^\s*(?:\d{4}[-/.年]\d{1,2}[-/.月]\d{1,2}日?|\d{4}年\d{1,2}月)\s*$"


def anomalies(text: Column, title: Column, nav: list[str] | None = None, list_titles: list[str] | None = None, footers: str = _FOOTERS) -> Column:
    """Sorted flags of what looks wrong with a document."""
    nav = terms.ANOMALY_NAV_TERMS if nav is None else nav
    lines = F.filter(F.transform(F.split(empty(text), "\n", -1), strip), lambda x: x != "")
    return let(lines, lambda x: let(strip(empty(text)), lambda s: _anomaly_flags(empty(text), s, x, title, nav, terms.ANOMALY_LIST_TITLES if list_titles is None else list_titles, footers)))


def _anomaly_flags(text, stripped, lines, title, nav, list_titles, footers):
    number = lambda test: F.size(F.filter(lines, test))
    n, nav_hits, footer_hits = F.size(lines), number(lambda x: x.isin(*nav)), number(lambda x: x.rlike(footers))
    dates, short, long = number(lambda x: x.rlike(_DATE_LINE)), number(lambda x: F.length(x) <= 35), number(lambda x: F.length(x) >= 80)
    crumbs = F.exists(lines, lambda x: F.contains(x, F.lit("当前位置")) | F.contains(x, F.lit("您现在所在位置")))
    list_page = (n >= 6) & (dates >= 3) & (short / n > 0.7) & (long == 0) & (strip(title).isin(*list_titles) | crumbs)
    refers = text.rlike(_FILE) & text.rlike(r"(?m)请(?:点击)?查看附件|^\s*附件[：:]")
    alone = refers & (F.length(stripped) < 500) & (long == 0)
    body = F.aggregate(F.filter(lines, lambda x: ~(x.isin(*nav) | x.rlike(footers))), F.lit(0), lambda a, x: a + F.length(x))
    only = (stripped != "") & (body < 40) & ((nav_hits >= 3) | (footer_hits >= 2))
    repeated = (title != "") & (F.size(F.filter(F.slice(lines, 1, 10), lambda x: x == strip(title))) > 1)
    table = F.exists(table_block_numbers(F.split(text, "\n", -1)), lambda x: x)
    tests = [
        (stripped == "", ("empty_after_clean", "body_missing")), (F.contains(text, F.lit("data:image/")) & F.contains(text, F.lit(";base64,")), ("base64_image_residue",)),
        (text.rlike(r"!\[[^\]]*\]\([^)]+\)"), ("markdown_image_residue",)), (text.rlike(r"(?i)&(?:nbsp|amp|lt|gt|#\d+);"), ("html_entity_residue",)), ((n <= 1) & (stripped != ""), ("single_line_text",)),
        (nav_hits >= 3, ("navigation_block_detected",)), (footer_hits >= 2, ("footer_block_detected",)), (list_page, ("list_page_contamination", "wrong_page_type", "needs_recrawl")), (refers, ("has_attachment_reference",)),
        (alone, ("attachment_only", "needs_attachment_merge")), (repeated, ("duplicate_title",)), (table, ("table_content_protected",)), (only, ("boilerplate_only", "body_missing")),
    ]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(test, flag) for test, flags in tests for flag in flags]))))


def removed_lines(before: DataFrame, after: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line, n): how many more times a non-blank line occurs before than after; the multiset difference per document."""
    rows = lambda df: df.select(key, F.explode(F.filter(F.split(empty(F.col(text)), "\n", -1), lambda x: strip(x) != "")).alias("line"))
    return rows(before).exceptAll(rows(after)).groupBy(key, "line").agg(F.count(F.lit(1)).alias("n"))


def edge_trimmed(line: Column) -> Column:
    return F.regexp_replace(line, "^[\t 　]+|[\t 　]+$", "")


def deterministic_clean(text: Column, title: Column, literal_newlines: bool = False) -> Column:
    """Images out, edges trimmed, consecutive equal lines once, a repeated title near the start once, at most two blank lines.

    Entities are decoded by :func:`siftline.functions.python_text.unescape` before this, as the JVM has no such function.
    """
    text = F.replace(text, F.lit("\\n"), F.lit("\n")) if literal_newlines else text
    text = F.regexp_replace(F.regexp_replace(text, r"!\[[^\]]*\]\(data:image/[^;)]+;base64,[A-Za-z0-9+/=\s]+\)", ""), r"!\[[^\]]*\]\([^)\n]*\)", "")
    lines = F.transform(F.split(text, "\n", -1), edge_trimmed)

    def consecutive_once(x):
        return F.filter(x, lambda line, i: ~((line != "") & F.coalesce(line == F.get(x, i - 1), F.lit(False))))

    def title_once(x):
        same = F.filter(F.transform(F.slice(x, 1, 10), lambda line, i: F.when(strip(line) == strip(title), i)), lambda i: i.isNotNull())
        return let(F.when(strip(title) != "", F.slice(same, 2, 10)), lambda drop: F.filter(x, lambda line, i: ~F.coalesce(F.array_contains(drop, i), F.lit(False))))

    lines = let(let(lines, consecutive_once), title_once)
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), r"\n{4,}", "\n\n\n"), r"^\n+|\n+$", "")


def position_ratio(lines: Column) -> Column:
    """Place of each line from 0 (first) to 1 (last)."""
    return let(F.size(lines), lambda n: F.transform(lines, lambda x, i: i / F.greatest(n - 1, F.lit(1))))


def apply_line_rules(text: Column, rules: list[dict]) -> Column:
    """Site rules on single lines: each has exact ``lines`` or a full-match ``pattern``, and a region (``start``, ``end`` as
    place ratios). Lines with a markdown or web link stay where ``keep_links``. Rules marked high risk must be disabled."""
    lines = F.split(empty(text), "\n", -1)

    def hit(line, place):
        out = F.lit(False)
        for rule in rules:
            if not rule.get("enabled", True):
                continue
            if rule.get("risk") == "high":
                raise ValueError(f"rule {rule.get('id')} is high risk and must be disabled")
            s = strip(line)
            match = s.isin(*rule["lines"]) if "lines" in rule else s.rlike(rf"\A(?:{rule['pattern']})\z")
            inside = (place >= rule.get("start", 0.0)) & (place <= rule.get("end", 1.0))
            link = s.rlike(r"https?://|\]\(") if rule.get("keep_links", True) else F.lit(False)
            out = out | (match & inside & ~link)
        return out

    placed = F.arrays_zip(lines.alias("l"), position_ratio(lines).alias("p"))
    return F.array_join(F.transform(F.filter(placed, lambda x: ~hit(x["l"], x["p"])), lambda x: x["l"]), "\n")
