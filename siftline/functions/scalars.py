"""Scalar functions on text, urls, dates, hashes and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import terms

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda variable, where an expression would be repeated."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(value: Column) -> Column:
    """Without white space (Unicode) at both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


# hashes and identifiers


def sha1_text(text: Column) -> Column:
    return F.sha1(empty(text).cast("binary"))


def sha12(text: Column) -> Column:
    return F.left(sha1_text(text), F.lit(12))


def stable_id(prefix: str, identity: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.left(F.sha2(identity, 256), F.lit(32)))


def document_id(path: Column, file_hash: Column) -> Column:
    return F.left(F.sha2(F.concat(path, F.lit("\0"), file_hash), 256), F.lit(32))


def safe_request_id(value: Column) -> Column:
    """Names of the safe alphabet pass; others get a cleaned prefix and a digest. Blank or over-long ones are an error."""
    digest = F.left(F.sha2(value, 256), F.lit(16))
    clean = F.regexp_replace(F.regexp_replace(value, r"[^0-9A-Za-z._\-]+", "_"), r"^[._\-]+|[._\-]+$", "")
    other = F.concat(F.left(F.when(clean == "", "request").otherwise(clean), F.lit(120)), F.lit("--"), digest)
    return (
        F.when(strip(empty(value)) == "", F.raise_error(F.lit("empty request id")).cast("string"))
        .when(F.length(value) > 1024, F.raise_error(F.lit("request id of over 1024 characters")).cast("string"))
        .when(value.rlike(r"\A[0-9A-Za-z._\-]{1,160}\z"), value)
        .otherwise(other)
    )


# urls


def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(empty(url), _URL, 2))


def domain_of(url: Column) -> Column:
    """Lower-case authority without one leading ``www.``; a port stays."""
    return F.regexp_replace(netloc(url), r"^www\.", "")


def host_or_unknown(url: Column, unknown: str = "unknown_source") -> Column:
    """Host without user, port, outer dots and ``www.``; urls without a scheme get one first."""
    url = strip(empty(url))
    full = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(netloc(full), r"^.*@", ""), r":\d*$", ""), r"^\.+|\.+$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when((url == "") | (host == ""), F.lit(unknown)).otherwise(host)


def stats_domain(url: Column) -> Column:
    """Authority without any ``www.``."""
    return F.replace(netloc(url), F.lit("www."), F.lit(""))


def url_identity(url: Column) -> Column:
    """Lower-case scheme and authority, ``/`` for an empty path, query kept, fragment dropped."""
    url = strip(empty(url))
    part = lambda k: F.regexp_extract(url, _URL, k)
    query = F.when(part(4) != "", F.concat(F.lit("?"), part(4))).otherwise("")
    scheme = F.when(part(1) != "", F.concat(F.lower(part(1)), F.lit(":"))).otherwise("")
    authority = F.when(part(2) != "", F.concat(F.lit("//"), F.lower(part(2)))).otherwise("")
    path = F.when(part(3) == "", "/").otherwise(part(3))
    return F.when(url == "", "").otherwise(F.concat(scheme, authority, path, query))


def canonical_url(url: Column) -> Column:
    """:func:`url_identity` with query parameters in order and blank ones dropped."""
    same = url_identity(url)
    head, query = F.substring_index(same, "?", 1), F.when(F.contains(same, F.lit("?")), F.regexp_extract(same, r"\?(.*)$", 1)).otherwise("")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: p.rlike(r"=.")))
    return F.when(F.size(kept) > 0, F.concat(head, F.lit("?"), F.array_join(kept, "&"))).otherwise(head)


def mask_tokens(text: Column, secrets: tuple[str, ...] = ()) -> Column:
    """Values of ``token`` parameters, given secrets and inline base 64 payloads are hidden."""
    out = F.regexp_replace(text, r"(?i)([?&]token=)[^\s&]+", "$1****")
    for secret in secrets:
        out = F.replace(out, F.lit(secret), F.lit("****"))
    payload = F.concat(F.regexp_extract(text, r"(?s)^([^,]*),", 1), F.lit(",<BASE64省略，"), (F.length(text) - F.length(F.regexp_extract(text, r"(?s)^([^,]*),", 1)) - 1).cast("string"), F.lit("字符>"))
    return F.when(F.contains(text, F.lit(";base64,")), payload).otherwise(out)


# text


def clean_basic(text: Column) -> Column:
    """Plain Chinese web text: no-break spaces, tags, spaces inside brackets and dates, blank runs."""
    for pattern, new in (
        ("\u00a0", " "), (r"<[^>]+>", " "), (r"([〔（(])(?U:\s)+", "$1"), (r"(?U:\s)+([〕）)])", "$1"),
        (r"([0-9]{2,4})(?U:\s)+年(?U:\s)*([0-9]{1,2})(?U:\s)+月(?U:\s)*([0-9]{1,2})(?U:\s)+日", "$1年$2月$3日"),
        (r"([0-9])(?U:\s)*-(?U:\s)*([0-9])", "$1-$2"), (r"(?<=[0-9])(?U:\s)+(?=[0-9](?U:\s)*年)", ""), ("[ \t\r\f\u000b]+", " "), (r"\n{3,}", "\n\n"),
    ):
        text = F.regexp_replace(text, pattern, new)
    return strip(text)


def normalize_space(text: Column) -> Column:
    """Byte order marks, no-break and ideographic spaces, control characters, blank runs."""
    text = F.regexp_replace(F.translate(empty(text), "\u00a0\u3000\ufeff", "  "), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return strip(F.regexp_replace(F.regexp_replace(text, "[ \t\r\f\u000b]+", " "), r"\n{3,}", "\n\n"))


def one_line(text: Column) -> Column:
    return strip(F.regexp_replace(empty(text), r"(?U)\s+", " "))


def normalize_markdown(text: Column) -> Column:
    """Line ends, NULs, trailing white space, blank runs and the final newline."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(empty(text), "^\ufeff+", ""), r"\r\n?", "\n"), "\u0000", "")
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, r"(?U)\s+$", ""))
    text = strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))
    return F.when(text == "", "").otherwise(F.concat(text, F.lit("\n")))


def clean_markdown(text: Column) -> Column:
    text = F.replace(F.translate(empty(text), "\u00a0\u3000\u2003", "   "), F.lit("**"), F.lit(""))
    return strip(F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), r"\n{3,}", "\n\n"))


def text_quality(text: Column, short: int = 50) -> Column:
    n = F.length(empty(text))
    return F.when(n == 0, "空文本").when(n < short, "过短").otherwise("正常")


def length_bucket(title: Column) -> Column:
    n = F.length(empty(title))
    out = F.when(n == 0, "0 空标题")
    low = 1
    for high in (10, 20, 30, 50, 80, 120):
        out = out.when(n <= high, f"{low}-{high}")
        low = high + 1
    return out.otherwise("120以上")


def normalize_source(source: Column) -> Column:
    return one_line(source)


def source_group(source: Column, url: Column, unknown: str = "unknown_source") -> tuple[Column, Column]:
    """Key and slug of the group that a document's source and host make."""
    source, host = normalize_source(source), host_or_unknown(url, unknown)
    key = F.when((source != "") & (host != unknown), F.concat(source, F.lit(" + "), host)).when(host != unknown, host).when(source != "", F.concat(source, F.lit(f" + {unknown}"))).otherwise(unknown)
    plain = F.left(F.regexp_replace(F.regexp_replace(F.concat_ws("_", source, host), r"[^0-9A-Za-z._\-]+", "_"), "^_+|_+$", ""), F.lit(70))
    return key, F.concat(F.when(plain == "", unknown).otherwise(plain), F.lit("_"), F.left(F.sha1(key.cast("binary")), F.lit(10)))


def review_text(text: Column, direct: int = 20_000, section: int = 6_000) -> tuple[Column, Column]:
    """(review text, kind): short texts whole, long ones as head, middle and tail cut at line breaks."""
    n = F.length(text)
    head = F.left(text, F.lit(section))
    head = F.when(F.contains(head, F.lit("\n")), F.regexp_replace(head, r"(?s)\n[^\n]*\z", "")).otherwise(head)
    tail = F.right(text, F.lit(section))
    tail = F.when(F.contains(tail, F.lit("\n")), F.regexp_replace(tail, r"(?s)\A[^\n]*\n", "")).otherwise(tail)
    start = F.greatest(F.floor(n / 2).cast("int") - section // 2, F.lit(0))
    middle = F.substring(text, start + 1, F.lit(section))
    cut = F.split(middle, "\n", -1)
    middle = F.when(F.size(cut) > 2, F.array_join(F.slice(cut, 2, F.greatest(F.size(cut) - 2, F.lit(0))), "\n")).otherwise(middle)
    note = "【长文抽样审阅说明】以下仅为原文的开头、中部和结尾抽样，仅用于主题与质量判断；不得据此定位或删除栏目噪声，noise_segments必须输出空数组。\n【原文开头】\n"
    long = F.concat(F.lit(note), head, F.lit("\n【原文中部】\n"), middle, F.lit("\n【原文结尾】\n"), tail)
    return F.when(n <= direct, text).otherwise(long), F.when(n <= direct, "full_text").otherwise("representative_sample")


# dates


def date_format(value: Column) -> Column:
    text = strip(value.cast("string"))
    return (
        F.when(value.isNull() | (value.cast("string") == ""), "missing")
        .when(text.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), "YYYY-MM-DD").when(text.rlike(r"\A\d{4}/\d{1,2}/\d{1,2}\z"), "YYYY/M/D")
        .when(text.rlike(r"\A\d{4}年\d{1,2}月\d{1,2}日\z"), "Chinese date").when(text.rlike(r"\A\d{4}-\d{2}-\d{2}[ T].+\z"), "datetime").otherwise("other")
    )


def parse_date(value: Column) -> Column:
    """ISO date of the usual notations; anything else comes back unchanged (free-form dates depend on today, so aren't guessed)."""
    text = strip(empty(value))
    ymd = r"^(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})(?:日|[ T].*)?$"
    iso = F.concat_ws("-", F.regexp_extract(text, ymd, 1), F.lpad(F.regexp_extract(text, ymd, 2), 2, "0"), F.lpad(F.regexp_extract(text, ymd, 3), 2, "0"))
    tight = F.regexp_replace(F.regexp_extract(text, r"^(\d{8})$", 1), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    found = F.coalesce(F.try_to_date(F.when(text.rlike(ymd), iso), "yyyy-MM-dd"), F.try_to_date(F.nullif(tight, F.lit("")), "yyyy-MM-dd"))
    return F.coalesce(F.date_format(found, "yyyy-MM-dd"), text)


def publish_date(doc_id: Column, url: Column) -> Column:
    """Date in an identifier or url: eight digits, a /year/month/day/ path, or Chinese notation; '' if there is none."""
    doc_id, url = empty(doc_id), empty(url)
    eight = lambda v: F.regexp_replace(F.nullif(F.regexp_extract(v, r"(?<!\d)((?:20|19)\d{6})(?!\d)", 1), F.lit("")), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")

    def parts(value: Column, pattern: str) -> Column:
        got = [F.regexp_extract(value, pattern, k) for k in (1, 2, 3)]
        return F.when(got[0] != "", F.concat_ws("-", got[0], F.lpad(got[1], 2, "0"), F.lpad(got[2], 2, "0")))

    path, chinese = r"/(20\d{2}|19\d{2})/(\d{1,2})/(\d{1,2})(?:/|$)", r"(20\d{2}|19\d{2})年(\d{1,2})月(\d{1,2})日"
    return F.coalesce(eight(doc_id), eight(url), parts(url, path), parts(doc_id, chinese), parts(url, chinese), F.lit(""))


def year_of(date: Column) -> Column:
    return F.when(empty(date).rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.left(date, F.lit(4))).otherwise("未知")


def utc_iso(value: Column) -> Column:
    """Time stamps with an offset (none: UTC) as UTC; what isn't one is left alone."""
    text = empty(value)
    stamp = F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.when(text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))))
    return F.coalesce(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssXXX"), text)


# lookups


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def labels(codes: Column, table: dict[str, str]) -> Column:
    mapped = _map(table)
    return F.transform(codes, lambda c: F.coalesce(mapped[c], F.concat(F.lit("未映射标签："), c)))


def codes(value: Column) -> Column:
    """Distinct non-blank codes in their order, trimmed."""
    return F.array_distinct(F.filter(F.transform(value, strip), lambda c: c != ""))


def bounded(value: Column, low: float, high: float, otherwise: float = 0.0) -> Column:
    """A number given as text within bounds; true and false are no numbers."""
    number = F.when(~F.lower(value).isin("true", "false"), F.try_cast(value, "double")) if hasattr(F, "try_cast") else F.when(~F.lower(value).isin("true", "false"), value.try_cast("double"))
    return F.coalesce(F.least(F.greatest(number, F.lit(low)), F.lit(high)), F.lit(otherwise))


def organisation(url: Column, doc_id: Column, by_domain: dict[str, str] | None = None, by_prefix: dict[str, str] | None = None) -> Column:
    """By id prefix, exact domain, domain suffix (without a dot boundary), else the domain itself."""
    by_domain, by_prefix = terms.ORG_BY_DOMAIN if by_domain is None else by_domain, terms.ORG_BY_ID_PREFIX if by_prefix is None else by_prefix
    domain, doc_id = stats_domain(url), empty(doc_id)
    tests = [F.when(doc_id.startswith(p), o) for p, o in by_prefix.items()] + [F.when(domain == d, o) for d, o in by_domain.items()] + [F.when(domain.endswith(d), o) for d, o in by_domain.items()]
    return F.coalesce(*tests, F.nullif(domain, F.lit("")), F.lit("未知机构"))


def channel(doc_id: Column, url: Column, by_domain: list[str] | None = None, names: dict[str, str] | None = None, mapped: bool = True) -> Column:
    """The words of an identifier between its domain and its first number or date."""
    names = terms.CHANNEL_NAMES if names is None else names
    domain, doc_id = stats_domain(url), empty(doc_id)
    rest = doc_id
    for d in terms.ORG_BY_DOMAIN if by_domain is None else by_domain:
        token = d.replace(".", "_") + "_"
        rest = F.when((domain == d) & doc_id.startswith(token), F.substring(doc_id, F.lit(len(token) + 1), F.length(doc_id))).otherwise(rest)
    words = F.nullif(F.regexp_replace(F.regexp_extract(rest, r"^(.*?)(?:(?:^|_)\d+(?:_.*)?)?$", 1), "^_+|_+$", ""), F.lit(""))
    raw = F.coalesce(words, F.lit("未分类"))
    return F.coalesce(_map(names)[raw], raw) if mapped else raw


def attachment_suffix(*candidates: Column, flags: dict[str, str] | None = None) -> Column:
    """Suffix of the first candidate that has one (or that is a known suffix itself)."""
    flags = terms.ATTACHMENT_FLAGS if flags is None else flags
    out = []
    for c in candidates:
        value = F.substring_index(F.substring_index(F.lower(strip(empty(c))), "?", 1), "#", 1)
        out.append(F.when(F.contains(value, F.lit(".")), F.nullif(F.substring_index(value, ".", -1), F.lit("\0"))).when(value.isin(*flags), value))
    return F.coalesce(*out, F.lit(""))


def safe_filename(value: Column, longest: int = 100) -> Column:
    """A path component without characters that some system forbids; over-long ones end in a digest."""
    value = value.cast("string")
    clean = F.regexp_replace(F.regexp_replace(value, r'[<>:"/\\|?*]', "_"), r"[\x00-\x1f\x7f]", "")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean, r"\s+", "_"), "_+", "_"), r"^[ ._]+|[ ._]+$", "")
    clean = F.when(clean == "", "untitled").otherwise(clean)
    short = F.concat(F.regexp_replace(F.left(clean, F.lit(longest - 12)), r"[ ._]+$", ""), F.lit("__"), F.left(F.sha2(value, 256), F.lit(10)))
    return F.when(F.length(clean) > longest, short).otherwise(clean)


#: Patterns of personal data.
SENSITIVE = {
    "id_card": r"\b\d{17}[\dXx]\b",
    "mobile": r"(?<!\d)1[3-9]\d{9}(?!\d)",
    "email": r"[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}",
    "phone": r"0\d{2,3}-?\d{7,8}",
    "patient_case": r"(患者|病例|个案|密切接触者|活动轨迹|行程轨迹)",
    "address": r"(地址|邮寄地址|通讯地址)[:：].{5,80}",
}


def sensitive_counts(text: Column) -> dict[str, Column]:
    return {name: F.regexp_count(empty(text), F.lit(pattern)) for name, pattern in SENSITIVE.items()}


def sensitive_risk(text: Column) -> tuple[Column, Column]:
    """(risk, action) from which kinds of personal data occur."""
    has = {name: empty(text).rlike(pattern) for name, pattern in SENSITIVE.items()}
    high, medium = has["id_card"] | has["patient_case"], has["mobile"] | has["address"]
    return F.when(high, "high").when(medium, "medium").otherwise("low"), F.when(high, "manual_review").when(medium, "mask_recommended").otherwise("mark_only")
