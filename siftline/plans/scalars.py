"""Queries for the scalar functions (F rows of the survey)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import terms
from .build import Query, projection, quoted

c = F.col
_URLRE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
_STRIP = r"'^[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


def urlpart(u: str, k: int) -> str:
    return f"regexp_extract({u}, '{_URLRE}', {k})"


def case_map(value: str, table: dict[str, str], other: str) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + f" ELSE {other} END"


NETLOC = f"lower({urlpart('coalesce(url, chr(32))', 2)})"
DOMAIN = f"regexp_replace({NETLOC}, '^www\\.', '')"
STATS = f"replace({NETLOC}, 'www.', '')"
_U = strip("coalesce(url, '')")
_FULL = f"(CASE WHEN contains({_U}, '://') THEN {_U} ELSE 'https://' || {_U} END)"
HOST = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({urlpart(_FULL, 2)}), '^.*@', ''), ':\\d*$', ''), '^\\.+|\\.+$', '', 'g'), '^www\\.', '')"
HOST = f"(CASE WHEN {_U} = '' OR {HOST} = '' THEN 'unknown_source' ELSE {HOST} END)"
IDENTITY = f"""(CASE WHEN {_U} = '' THEN '' ELSE
 (CASE WHEN {urlpart(_U, 1)} <> '' THEN lower({urlpart(_U, 1)}) || ':' ELSE '' END) || (CASE WHEN {urlpart(_U, 2)} <> '' THEN '//' || lower({urlpart(_U, 2)}) ELSE '' END)
 || (CASE WHEN {urlpart(_U, 3)} = '' THEN '/' ELSE {urlpart(_U, 3)} END) || (CASE WHEN {urlpart(_U, 4)} <> '' THEN '?' || {urlpart(_U, 4)} ELSE '' END) END)"""

URLS = ("page_id bigint, url string", [
    (-1, "HTTPS://WWW.NHC.gov.cn:8080/a/../b?z=1&a=&b=2#top"), (-2, None), (-3, "  who.int/x  "), (-4, "http://user@www.Who.int./art/2026/5/31/7.html"), (-5, "mailto:x@y.z"),
    (-6, "https://a.www.b.cn"), (-7, "https://xwho.int/20260608_1"), (-8, "https://h.cn/2024年3月5日"), (-9, "https://hsa.gd.gov.cn/x?token=abc&Token=d"), (-10, ""),
])
TEXTS = ("doc_id bigint, text string", [
    (-1, "（ 一 ） 2024 年 3 月 15 日 会议 1 - 3 <b>粗</b> x\n\n\n\n尾  "), (-2, "﻿甲　乙 丙\x01\t丁\n\n\n\n戊 "), (-3, ""), (-4, None),
    (-5, "a \r\nb\t\rc\n\n\n\nd　"), (-6, "**标题** a  b"), (-7, "患者张三 手机 13812345678 邮箱 a.b@c.org 电话 010-12345678 身份证 11010519491231002X 地址：北京市某某路一号"),
    (-8, "x?token=abc&y=1"), (-9, "data:image/png;base64,AAAA"), (-10, "&nbsp;<html>"), (-11, "网站支持IPv6\n首页 | 联系我们\n正文" + "文" * 30 + "\n责任编辑：甲\n版权所有"),
])
IDS = ("page_id bigint, url string", [(-1, "nhc_gov_cn_zhengce_20240101_7"), (-2, "report_notice_12_x"), (-3, "plain"), (-4, "gz_广州市卫健委_通知_8"), (-5, "20240506")])


def _clean(t: str) -> str:
    sp = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    steps = [(" ", " "), ("<[^>]+>", " "), (rf"([〔（(]){sp}+", r"\1"), (rf"{sp}+([〕）)])", r"\1"), (rf"([0-9]{{2,4}}){sp}+年{sp}*([0-9]{{1,2}}){sp}+月{sp}*([0-9]{{1,2}}){sp}+日", r"\1年\2月\3日"), (rf"([0-9]){sp}*-{sp}*([0-9])", r"\1-\2"), (rf"([0-9]){sp}+([0-9]{sp}*年)", r"\1\2"), (r"[ \t\r\f\x0B]+", " "), (r"\n{3,}", "\n\n")]
    for a, b in steps:
        t = f"regexp_replace({t}, '{a}', '{b}', 'g')"
    return strip(t)


def _space(t: str) -> str:
    t = f"regexp_replace(translate(coalesce({t}, ''), ' 　﻿', '  '), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')"
    return strip(f"regexp_replace(regexp_replace({t}, '[ \\t\\r\\f\\x0B]+', ' ', 'g'), '\\n{{3,}}', '\n\n', 'g')")


def _one_line(t: str) -> str:
    return strip(rf"regexp_replace(coalesce({t}, ''), '[\s\x0B\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g')")


_MD = "regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '^﻿+', ''), '\\r\\n?', '\n', 'g'), '\\x00', '', 'g')"
_MD = f"array_to_string(list_transform(string_split({_MD}, chr(10)), lambda l: regexp_replace(l, '[\\s\\x0B\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+$', '')), chr(10))"
_MD = strip(f"regexp_replace({_MD}, '\\n{{3,}}', '\n\n', 'g')")
_QUERY = f"(CASE WHEN contains({IDENTITY}, '?') THEN regexp_extract({IDENTITY}, '\\?(.*)$', 1) ELSE '' END)"
_KEPT = f"list_sort(list_filter(string_split({_QUERY}, '&'), lambda p: regexp_matches(p, '=.')))"
_SRC = "regexp_replace(regexp_replace(concat_ws('_', source, source || '.org'), '[^0-9A-Za-z._-]+', '_', 'g'), '^_+|_+$', '', 'g')"
LONG = 400  # a length at which documents of the test tables are long


def _review() -> str:
    head = f"(CASE WHEN contains(left(text, {LONG // 4}), chr(10)) THEN regexp_replace(left(text, {LONG // 4}), '(?s)\\n[^\\n]*$', '') ELSE left(text, {LONG // 4}) END)"
    tail = f"(CASE WHEN contains(right(text, {LONG // 4}), chr(10)) THEN regexp_replace(right(text, {LONG // 4}), '(?s)^[^\\n]*\\n', '') ELSE right(text, {LONG // 4}) END)"
    raw = f"substr(text, greatest(length(text) // 2 - {LONG // 8}, 0) + 1, {LONG // 4})"
    middle = f"(CASE WHEN len(string_split({raw}, chr(10))) > 2 THEN array_to_string(string_split({raw}, chr(10))[2:-2], chr(10)) ELSE {raw} END)"
    note = "【长文抽样审阅说明】以下仅为原文的开头、中部和结尾抽样，仅用于主题与质量判断；不得据此定位或删除栏目噪声，noise_segments必须输出空数组。\n【原文开头】\n"
    return f"CASE WHEN length(text) <= {LONG} THEN text ELSE {quoted(note)} || {head} || '\n【原文中部】\n' || {middle} || '\n【原文结尾】\n' || {tail} END"


def _org() -> str:
    by_domain, by_prefix = terms.ORG_BY_DOMAIN, terms.ORG_BY_ID_PREFIX
    tests = " ".join(f"WHEN starts_with('', {quoted(p)}) THEN {quoted(o)}" for p, o in by_prefix.items())
    tests += " " + " ".join(f"WHEN {STATS} = {quoted(d)} THEN {quoted(o)}" for d, o in by_domain.items()) + " " + " ".join(f"WHEN ends_with({STATS}, {quoted(d)}) THEN {quoted(o)}" for d, o in by_domain.items())
    return f"CASE {tests} WHEN {STATS} <> '' THEN {STATS} ELSE '未知机构' END"


def _date() -> str:
    p = r"/(20\d{2}|19\d{2})/(\d{1,2})/(\d{1,2})(?:/|$)"
    z = r"(20\d{2}|19\d{2})年(\d{1,2})月(\d{1,2})日"
    part = lambda pattern: f"CASE WHEN regexp_matches(coalesce(url, ''), '{pattern}') THEN regexp_extract(url, '{pattern}', 1) || '-' || lpad(regexp_extract(url, '{pattern}', 2), 2, '0') || '-' || lpad(regexp_extract(url, '{pattern}', 3), 2, '0') END"
    e = r"(?:^|[^0-9])((?:20|19)\d{6})(?:[^0-9]|$)"
    eight = f"CASE WHEN regexp_matches(coalesce(url, ''), '{e}') THEN regexp_replace(regexp_extract(url, '{e}', 1), '^(\\d{{4}})(\\d{{2}})(\\d{{2}})$', '\\1-\\2-\\3') END"
    return f"coalesce({eight}, {part(p)}, {part(z)}, '')"


def _has(pattern: str) -> str:
    return f"regexp_matches(coalesce(text, ''), '{pattern}')"


ID_CARD, MOBILE = r"\b\d{17}[\dXx]\b", r"(?:^|[^0-9])1[3-9]\d{9}(?:[^0-9]|$)"
PATIENT, ADDRESS = s.SENSITIVE["patient_case"], s.SENSITIVE["address"]
EMAIL, PHONE = s.SENSITIVE["email"], s.SENSITIVE["phone"]
_HIGH, _MEDIUM = f"({_has(ID_CARD)} OR {_has(PATIENT)})", f"({_has(MOBILE)} OR {_has(ADDRESS)})"
_NAMES = r"regexp_replace(regexp_replace(coalesce(url, ''), '[<>:\"/\\\\|?*]', '_', 'g'), '[\x00-\x1f\x7f]', '', 'g')"
_NAMES = f"regexp_replace(regexp_replace(regexp_replace({_NAMES}, '\\s+', '_', 'g'), '_+', '_', 'g'), '^[ ._]+|[ ._]+$', '', 'g')"
_NAMES = f"(CASE WHEN {_NAMES} = '' THEN 'untitled' ELSE {_NAMES} END)"
_CHANNEL = "regexp_replace(regexp_extract(coalesce(url, ''), '^(.*?)(?:(?:^|_)\\d+(?:_.*)?)?$', 1), '^_+|_+$', '', 'g')"
_CHANNEL = f"coalesce(nullif({_CHANNEL}, ''), '未分类')"
_RID = "regexp_replace(regexp_replace(url, '[^0-9A-Za-z._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g')"
_SUFFIX = "regexp_replace(regexp_replace(lower(coalesce(url, '')), '\\?.*$', ''), '#.*$', '')"
_MASK = "regexp_replace(text, '(?i)([?&]token=)[^\\s&]+', '\\1****', 'g')"

QUERIES: dict[str, Query] = {
    "F-01": projection("events", "event_id", {"found": (lambda: F.coalesce(F.get_json_object("props", "$.k"), F.lit("absent")), "coalesce(json_extract_string(props, '$.k'), 'absent')")}),
    "F-02": projection("documents", "doc_id", {"nested": (lambda: F.struct(F.struct(c("source").alias("site"), c("lang").alias("lang")).alias("source")).getField("source").withField("domain", F.lit("x")).getField("domain"), "'x'"), "site": (lambda: c("source"), "source")}),
    "F-05": projection("documents", "doc_id", {"sha1": (lambda: s.sha1_text(c("text")), "sha1(coalesce(text, ''))"), "sha12": (lambda: s.sha12(c("text")), "left(sha1(coalesce(text, '')), 12)")}, TEXTS),
    "F-07": projection("pages", "page_id", {"stable_id": (lambda: s.stable_id("web", s.empty(c("url"))), "'web_' || left(sha256(coalesce(url, '')), 32)")}, URLS),
    "F-08": projection("pages", "page_id", {"document_id": (lambda: s.document_id(c("url"), F.lit("abc")), "left(sha256(url || chr(0) || 'abc'), 32)")}),
    "F-09": projection("pages", "page_id", {"domain": (lambda: s.domain_of(c("url")), DOMAIN)}, URLS),
    "F-10": projection("pages", "page_id", {"host": (lambda: s.host_or_unknown(c("url")), HOST)}, URLS),
    "F-11": projection("pages", "page_id", {"domain": (lambda: s.stats_domain(c("url")), STATS)}, URLS),
    "F-12": projection("pages", "page_id", {"canonical": (lambda: s.canonical_url(c("url")), f"CASE WHEN len({_KEPT}) > 0 THEN split_part({IDENTITY}, '?', 1) || '?' || array_to_string({_KEPT}, '&') ELSE split_part({IDENTITY}, '?', 1) END")}, URLS),
    "F-13": projection("pages", "page_id", {"identity": (lambda: s.url_identity(c("url")), IDENTITY)}, URLS),
    "F-14": projection("events", "event_id", {"day": (lambda: s.parse_date(F.date_format("ts", "yyyy/M/d")), "strftime(ts, '%Y-%m-%d')")}),
    "F-15": projection("pages", "page_id", {"published": (lambda: s.publish_date(F.lit(""), c("url")), _date()), "year": (lambda: s.year_of(s.publish_date(F.lit(""), c("url"))), f"CASE WHEN {_date()} <> '' THEN left({_date()}, 4) ELSE '未知' END")}, URLS),
    "F-16": projection("pages", "page_id", {"format": (lambda: s.date_format(c("url")), r"CASE WHEN url IS NULL OR url = '' THEN 'missing' WHEN regexp_matches(url, '^\d{4}-\d{2}-\d{2}$') THEN 'YYYY-MM-DD' WHEN regexp_matches(url, '^\d{4}/\d{1,2}/\d{1,2}$') THEN 'YYYY/M/D' WHEN regexp_matches(url, '^\d{4}年\d{1,2}月\d{1,2}日$') THEN 'Chinese date' WHEN regexp_matches(url, '^\d{4}-\d{2}-\d{2}[ T].+$') THEN 'datetime' ELSE 'other' END")}, ("page_id bigint, url string", [(-1, "2024-01-02"), (-2, "2024/1/2"), (-3, "2024年1月2日"), (-4, "2024-01-02 10:00"), (-5, None), (-6, ""), (-7, "2024")])),
    "F-17": projection("documents", "doc_id", {"clean": (lambda: s.clean_basic(s.empty(c("text"))), _clean("coalesce(text, '')"))}, TEXTS),
    "F-19": projection("documents", "doc_id", {"clean": (lambda: s.normalize_space(c("text")), _space("text"))}, TEXTS),
    "F-20": projection("documents", "doc_id", {"line": (lambda: s.one_line(c("text")), _one_line("text"))}, TEXTS),
    "F-21": projection("documents", "doc_id", {"clean": (lambda: s.normalize_markdown(c("text")), f"CASE WHEN {_MD} = '' THEN '' ELSE {_MD} || chr(10) END"), "raw_chars": (lambda: F.length(s.empty(c("text"))).cast("long"), "length(coalesce(text, ''))"), "clean_chars": (lambda: F.length(s.normalize_markdown(c("text"))).cast("long"), f"CASE WHEN {_MD} = '' THEN 0 ELSE length({_MD}) + 1 END")}, TEXTS),
    "F-22": projection("documents", "doc_id", {"clean": (lambda: s.clean_markdown(c("text")), strip("regexp_replace(regexp_replace(replace(translate(coalesce(text, ''), ' 　 ', '   '), '**', ''), '[ \\t]+', ' ', 'g'), '\\n{3,}', '\n\n', 'g')"))}, TEXTS),
    "F-24": projection("documents", "doc_id", {"bucket": (lambda: s.length_bucket(c("text")), "CASE WHEN length(coalesce(text, '')) = 0 THEN '0 空标题' WHEN length(text) <= 10 THEN '1-10' WHEN length(text) <= 20 THEN '11-20' WHEN length(text) <= 30 THEN '21-30' WHEN length(text) <= 50 THEN '31-50' WHEN length(text) <= 80 THEN '51-80' WHEN length(text) <= 120 THEN '81-120' ELSE '120以上' END"), "quality": (lambda: s.text_quality(c("text")), "CASE WHEN length(coalesce(text, '')) = 0 THEN '空文本' WHEN length(text) < 50 THEN '过短' ELSE '正常' END")}, TEXTS),
    "F-25": projection("pages", "page_id", {"organisation": (lambda: s.organisation(c("url"), F.lit("")), _org())}, URLS),
    "F-26": projection("pages", "page_id", {"channel": (lambda: s.channel(c("url"), F.lit("")), case_map(_CHANNEL, terms.CHANNEL_NAMES, _CHANNEL)), "raw_channel": (lambda: s.channel(c("url"), F.lit(""), mapped=False), _CHANNEL)}, IDS),
    "F-27": projection("documents", "doc_id", {"key": (lambda: s.source_group(c("source"), F.concat(c("source"), F.lit(".org")))[0], "source || ' + ' || source || '.org'"), "slug": (lambda: s.source_group(c("source"), F.concat(c("source"), F.lit(".org")))[1], f"left({_SRC}, 70) || '_' || left(sha1(source || ' + ' || source || '.org'), 10)")}),
    "F-28": projection("pages", "page_id", {"name": (lambda: s.safe_filename(s.empty(c("url")), 40), f"CASE WHEN length({_NAMES}) > 40 THEN regexp_replace(left({_NAMES}, 28), '[ ._]+$', '') || '__' || left(sha256(coalesce(url, '')), 10) ELSE {_NAMES} END")}, URLS),
    "F-29": projection("pages", "page_id", {"request_id": (lambda: s.safe_request_id(c("url")), f"CASE WHEN regexp_matches(url, '^[0-9A-Za-z._-]{{1,160}}$') THEN url ELSE left(CASE WHEN {_RID} = '' THEN 'request' ELSE {_RID} END, 120) || '--' || left(sha256(url), 16) END")}, ("page_id bigint, url string", [(-1, "plain-id_1.x"), (-2, "中文"), (-3, "a b"), (-4, "...")])),
    "F-30": projection("documents", "doc_id", {"safe": (lambda: s.mask_tokens(c("text"), ("secret-value",)), f"CASE WHEN contains(text, ';base64,') THEN regexp_extract(text, '(?s)^([^,]*),', 1) || ',<BASE64省略，' || (length(text) - length(regexp_extract(text, '(?s)^([^,]*),', 1)) - 1)::VARCHAR || '字符>' ELSE replace({_MASK}, 'secret-value', '****') END")}, TEXTS),
    "F-31": projection("pages", "page_id", {"suffix": (lambda: s.attachment_suffix(F.lit(None).cast("string"), c("url")), f"CASE WHEN contains({_SUFFIX}, '.') THEN string_split({_SUFFIX}, '.')[-1] WHEN {_SUFFIX} IN ({', '.join(map(quoted, terms.ATTACHMENT_FLAGS))}) THEN {_SUFFIX} ELSE '' END")}, ("page_id bigint, url string", [(-1, "A.PDF?x=1.2"), (-2, "docx"), (-3, "none"), (-4, None)])),
    "F-33": projection("documents", "doc_id", {"emails": (lambda: s.sensitive_counts(c("text"))["email"].cast("long"), f"len(regexp_extract_all(coalesce(text, ''), '{EMAIL}'))"), "phones": (lambda: s.sensitive_counts(c("text"))["phone"].cast("long"), f"len(regexp_extract_all(coalesce(text, ''), '{PHONE}'))"), "has_mobile": (lambda: s.sensitive_counts(c("text"))["mobile"] > 0, _has(MOBILE)), "has_id": (lambda: s.sensitive_counts(c("text"))["id_card"] > 0, _has(ID_CARD))}, TEXTS),
    "F-34": projection("documents", "doc_id", {"b64": (lambda: F.base64(s.empty(c("source")).cast("binary")), "to_base64(encode(coalesce(source, '')))"), "sha256": (lambda: F.sha2(s.empty(c("text")), 256), "sha256(coalesce(text, ''))")}),
    "F-35": projection("events", "event_id", {"bounded": (lambda: F.round(s.bounded(c("value").cast("string"), 0.0, 5.0), 6), "round(coalesce(least(greatest(value, 0), 5), 0), 6)"), "codes": (lambda: F.array_join(s.codes(F.array("event_type", F.lit(" "), "event_type")), ","), "event_type")}),
    "F-36": projection("events", "event_id", {"label": (lambda: F.array_join(s.labels(F.array("event_type", F.lit("click")), {"click": "点击"}), ","), "CASE WHEN event_type = 'click' THEN '点击' ELSE '未映射标签：' || event_type END || ',点击'")}),
    "F-37": projection("documents", "doc_id", {"review": (lambda: s.review_text(c("text"), LONG, LONG // 4)[0], _review()), "kind": (lambda: s.review_text(c("text"), LONG, LONG // 4)[1], f"CASE WHEN length(text) <= {LONG} THEN 'full_text' ELSE 'representative_sample' END")}),
    "F-39": projection("events", "event_id", {"utc": (lambda: s.utc_iso(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+08:00'")), "strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%SZ')"), "same": (lambda: s.utc_iso(c("event_type")), "event_type")}),
    "P-11": projection("documents", "doc_id", {"risk": (lambda: s.sensitive_risk(c("text"))[0], f"CASE WHEN {_HIGH} THEN 'high' WHEN {_MEDIUM} THEN 'medium' ELSE 'low' END"), "action": (lambda: s.sensitive_risk(c("text"))[1], f"CASE WHEN {_HIGH} THEN 'manual_review' WHEN {_MEDIUM} THEN 'mask_recommended' ELSE 'mark_only' END")}, TEXTS),
}
