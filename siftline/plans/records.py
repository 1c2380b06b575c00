"""Queries for predicates, mappers, deduplication, joins, aggregates, windows, sets and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import python_text as p
from ..functions import scalars as s
from ..functions import terms
from ..operators import dedup as dd
from ..operators import lines as w
from ..operators import records as r
from .build import Query, literal, projection, quoted, read, values
from .lines import DATA_TERMS, MARKDOWN, _hits
from .scalars import TEXTS, _one_line, strip

c = F.col


def n_rows():
    return F.count(F.lit(1))



def docs(spark, d, *extra) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", "text", *extra)


NAV = ["the ", "and ", "der ", *terms.ROUTE_NAV_TERMS]
FOOT = ["Licensed", *terms.ROUTE_FOOTER_TERMS]


def _noise():
    return r.nav_noise(c("text"), NAV, FOOT, ["That"], ["Licensed under"], ["The "])


_ONE = "(" + _one_line("text") + ")"
_OCC = lambda names: "(" + " + ".join(f"((length(o) - length(replace(o, {quoted(t)}, ''))) // {len(t)})" for t in names) + ")"
_NOISE = f"(SELECT doc_id, o, text, {_OCC(NAV)} AS nav, {_OCC(FOOT)} AS foot, {_OCC(['That'])} AS paging, CASE WHEN contains(o, 'Licensed under') THEN 1 ELSE 0 END AS strong, starts_with(o, 'The ') AS starts FROM (SELECT doc_id, text, {_ONE} AS o FROM documents))"
_SCORE = "(nav + foot * 2 + paging * 2 + strong * 3)"


def _routed(spark, d):
    pages = read(spark, d, "pages").select(c("page_id").alias("doc_id"), "html")
    rows = docs(spark, d).join(pages, "doc_id", "left")
    out = r.route(rows, "text", "html", F.when(c("doc_id") % 3 == 0, 1).otherwise(0), F.when(c("doc_id") % 5 == 0, 1).otherwise(0), _noise())
    return out.select("doc_id", "route", F.array_join("flags", ",").alias("flags"))


_ROUTE = f"""WITH n AS (SELECT n.*, coalesce(html, '') AS h, {_SCORE} AS score, length(o) AS len, doc_id % 3 = 0 AS att, doc_id % 5 = 0 AS img FROM {_NOISE} n LEFT JOIN pages ON page_id = doc_id),
f AS (SELECT *, starts OR score >= 8 AS noisy FROM n)
SELECT doc_id, CASE WHEN len < 80 AND att THEN 'attachment_candidate' WHEN len < 80 THEN 'short_or_empty_no_attachment' WHEN noisy THEN 'needs_body_extraction' ELSE 'body_text_ok' END AS route,
 array_to_string(list_sort(list_filter([CASE WHEN len = 0 THEN 'empty_text' END, CASE WHEN len > 0 AND len < 80 THEN 'short_text' END, CASE WHEN len > 20000 THEN 'long_text' END, CASE WHEN {strip('h')} <> '' THEN 'has_body_html' END,
  CASE WHEN regexp_matches(h, '(?i)<\\s*table\\b') THEN 'has_table' END, CASE WHEN att THEN 'has_attachment' END, CASE WHEN img THEN 'has_image' END, CASE WHEN img AND len < 80 AND NOT att THEN 'likely_image_article' END, CASE WHEN noisy THEN 'nav_noise' END,
  CASE WHEN foot >= 1 THEN 'footer_noise' END, CASE WHEN paging >= 1 THEN 'prev_next_noise' END, CASE WHEN len < 80 OR noisy THEN 'needs_manual_review' END], lambda x: x IS NOT NULL)), ',') AS flags FROM f"""


def _quality(spark, d):
    rows = docs(spark, d, "n_chars").join(read(spark, d, "labels"), "doc_id", "left")
    label, reasons, score = r.quality_label(c("text"), c("n_chars") * 2, F.lit("u"), F.size(w.found_terms(c("text"), DATA_TERMS)) > 0, c("quality") == 0, F.when(c("toxic") == 1, "high").otherwise("low"), F.lit(""))
    return rows.select("doc_id", label.alias("label"), F.array_join(reasons, ",").alias("reasons"), score.cast("long").alias("score"))


_QUALITY = f"""WITH q AS (SELECT documents.doc_id, list_filter([CASE WHEN text = '' THEN 'empty_clean_text' END, CASE WHEN length(text) < 80 THEN 'short_clean_text' END, CASE WHEN len({_hits('text', DATA_TERMS)}) > 0 THEN 'residual_navigation_noise' END,
 CASE WHEN regexp_matches(text, '<[^>]+>') THEN 'html_tag_residue' END, CASE WHEN n_chars > 0 AND length(text) / (n_chars * 2.0) < 0.2 THEN 'possible_truncation' END, CASE WHEN quality = 0 THEN 'date_conflict' END, CASE WHEN toxic = 1 THEN 'high_sensitive_risk' END], lambda x: x IS NOT NULL) AS why,
 length(text) < 80 OR coalesce(toxic, 0) = 1 AS severe FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN severe THEN 'needs_review' WHEN len(why) > 0 THEN 'partial_clean' ELSE 'clean' END AS label, array_to_string(why, ',') AS reasons, greatest(0, 100 - 15 * len(why))::BIGINT AS score FROM q"""


def _thresholds(spark, d):
    groups = docs(spark, d, "source").groupBy("source").agg(n_rows().alias("n")).withColumn("domain", F.concat("source", F.lit(".org")))
    groups = groups.union(literal(spark, "source string, n bigint, domain string", [("a", 10, "a.org"), ("b", 500, "b.org"), ("c", 5000, "c.org")]))
    value, by, on = r.threshold(c("n"), F.concat("source", F.lit(" + "), "domain"), c("source"), c("domain"), None, {"src1": 7, "src2.org": 8})
    return groups.select("source", "n", F.coalesce(value, F.lit(-1)).alias("threshold"), by.alias("by"), on.alias("enabled"))


def _llm(spark, d):
    rows = read(spark, d, "labels").join(docs(spark, d, "n_chars"), "doc_id")
    status = r.llm_partition(c("doc_id") % 11 != 0, c("quality") * 0.5 + 0.3, c("doc_id") % 6, F.lit(0.95), c("toxic") == 1)
    return rows.select("doc_id", status.alias("policy_status"))


def _repetition(spark, d):
    share = F.round(p.repeated_ngram_share(c("text")), 6)
    return docs(spark, d).select("doc_id", share.alias("share"), (share <= 0.5).alias("kept"))


_GRAMS = "WITH g AS (SELECT doc_id, substr(text, i, 10) AS g FROM documents, unnest(range(1, length(text) - 8)) AS u(i)), n AS (SELECT doc_id, g, count(*) AS k FROM g GROUP BY ALL), s AS (SELECT doc_id, sum(k) FILTER (k > 1) AS again, sum(k) AS total FROM n GROUP BY doc_id) SELECT d.doc_id, round(coalesce(again / total, 0), 6) AS share, round(coalesce(again / total, 0), 6) <= 0.5 AS kept FROM documents d LEFT JOIN s USING (doc_id)"


def _language(spark, d):
    """Share of letters in Han blocks or, for other scripts, of stop words; a stand-in for a model that is passed in."""
    words = F.split(F.lower("text"), r"[^\p{L}]+")
    stop = {"en": ["the", "of", "and", "to", "in", "is", "that"], "de": ["der", "die", "und", "in", "den", "das", "ist"], "fr": ["de", "la", "le", "et", "les", "des", "un"], "es": ["de", "la", "que", "el", "en", "los", "las"]}
    score = lambda names: F.size(F.filter(words, lambda x: x.isin(*names)))
    best = F.sort_array(F.array(*[F.struct(score(n).alias("k"), F.lit(lang).alias("lang")) for lang, n in stop.items()]), asc=False)[0]
    han = r.ratio_of(c("text"), r"\p{IsHan}")
    return docs(spark, d).select("doc_id", F.when(han >= 0.5, "zh").when(best["k"] == 0, "und").otherwise(best["lang"]).alias("lang"))


def _rejections(spark, d):
    n, letters = F.length("text"), r.ratio_of(c("text"), r"\p{L}\p{N}")
    first = F.when(~n.between(50, 3_000_000), "text_length").when(letters < 0.45, "alphanumeric").when(r.ratio_of(c("text"), r"#*$%&|<>") > 0.2, "special_characters")
    return docs(spark, d).select("doc_id", first.alias("first_failed"))


_LETTERS = "length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'))"
_SPECIAL = "length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))"


def _greedy(spark, d):
    rows = docs(spark, d).withColumn("url", F.concat(F.lit("u"), (c("doc_id") % 700).cast("string")))
    return dd.greedy_dedup(rows, "doc_id", "url", "text")


def _line_frequency(spark, d):
    return dd.line_frequency(docs(spark, d, "source"), "doc_id", "text", "source").filter("n_docs > 1")


def _summary(spark, d):
    n = F.length("text").cast("long")
    return docs(spark, d).agg(n_rows().alias("documents"), F.sum(F.when(c("text") == "", 1).otherwise(0)).alias("empty"), F.sum(n).alias("chars"), F.round(F.avg(n), 6).alias("mean"), F.median(n).alias("median"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.min_by("doc_id", F.struct(n, "doc_id")).alias("shortest_id"))


def _cleaned(spark, d):
    return docs(spark, d, "source").withColumn("after", w.remove_noise_lines(c("text"), DATA_TERMS)[0])


_AFTER = strip("array_to_string(list_filter(list_filter(list_transform(string_split(text, chr(10)), lambda l: " + strip("l") + "), lambda l: l <> ''), lambda l: NOT (length(l) <= 60 AND len(" + _hits("l", DATA_TERMS) + ") > 0)), chr(10))")


def _comparison(spark, d):
    lost = F.length("text") - F.length("after")
    share = lost / F.greatest(F.length("text"), F.lit(1))
    return _cleaned(spark, d).groupBy("source").agg(n_rows().alias("documents"), F.sum(lost).alias("removed"), *[F.count_if(share > x / 100).alias(f"over_{x}") for x in (10, 30, 50, 80)])


def _aligned(spark, d):
    """Before and after by id, the k-th row of an id with the k-th."""
    before = dd.occurrence(docs(spark, d).withColumn("k", c("doc_id") % 50), "k", "doc_id")
    after = dd.occurrence(docs(spark, d).filter("doc_id % 7 <> 0").withColumn("k", c("doc_id") % 50), "k", "doc_id")
    return before.select("k", "occ", c("doc_id").alias("before")).join(after.select("k", "occ", c("doc_id").alias("after")), ["k", "occ"], "left").withColumn("after", F.coalesce("after", F.lit(-1).cast("long")))


def _survivors(spark, d):
    rows = docs(spark, d).withColumn("h", F.sha2(F.regexp_replace("text", r"(?U)\s+", ""), 256))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("survivor"))
    return rows.join(first, "h").filter("doc_id <> survivor").select("doc_id", "survivor")


def _manual_assets(spark, d):
    assets = read(spark, d, "pages").select(c("page_id").alias("doc_id"), "url", F.concat(F.lit("name"), c("page_id").cast("string")).alias("name"))
    given = assets.filter("doc_id % 4 = 0").select("doc_id", F.when(c("doc_id") % 8 == 0, c("url")).otherwise("other").alias("m_url"), F.when(c("doc_id") % 12 == 0, c("name")).otherwise("none").alias("m_name"))
    return given.join(assets, (given["doc_id"] == assets["doc_id"]) & ((c("m_url") == c("url")) | (c("m_name") == c("name"))), "left").select(given["doc_id"], c("url").isNotNull().alias("matched"))


def _audit(spark, d):
    left = read(spark, d, "orders").select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("fact"))
    right = read(spark, d, "lineitem").filter("l_linenumber = 1").select(c("l_orderkey").alias("id"), c("l_linestatus").alias("indexed"))
    return left.join(right, "id", "full").select("id", F.when(c("fact").isNull(), "missing_fact").when(c("indexed").isNull(), "missing_index").when(c("fact") != c("indexed"), "status_differs").otherwise("ok").alias("issue"))


def _remaining(spark, d):
    files = read(spark, d, "pages").select(c("url").alias("path"), F.length("html").cast("long").alias("size"), "page_id")
    tasks = read(spark, d, "pages").filter("page_id % 3 <> 0").select(c("url").alias("path"), (F.length("html") + F.when(c("page_id") % 5 == 0, 1).otherwise(0)).cast("long").alias("t_size"), F.when(c("page_id") % 2 == 0, "submitted").otherwise("processed").alias("status"))
    tasks = tasks.groupBy("path").agg(F.max(F.struct((c("status") == "submitted").alias("s"), "t_size", "status")).alias("t"))
    return files.join(tasks, "path", "left").select("page_id", F.when(c("t").isNull(), "remaining").when(c("t.t_size") != c("size"), "changed").otherwise(c("t.status")).alias("state"))


def _reuse(spark, d):
    done = read(spark, d, "events").filter("event_type <> 'error'").select(F.sha2(c("user_id").cast("string"), 256).alias("sha"), "ts", "event_id")
    last = done.groupBy("sha").agg(F.max(F.struct("ts", (-c("event_id")).alias("k"))).alias("x"))
    return last.select("sha", (-c("x.k")).alias("event_id"))


def _stats(spark, d):
    return read(spark, d, "pages").groupBy(s.organisation(c("url"), F.lit(""), {"example.com": "Com", "example.org": "Org"}).alias("org"), F.regexp_extract("url", r"//[^/]*/([a-z]{2})/", 1).alias("channel")).agg(n_rows().alias("n"), F.count_distinct("url").alias("urls"))


def _duplicate_counts(spark, d):
    each = read(spark, d, "lineitem").groupBy("l_partkey").agg(n_rows().alias("k"))
    return each.agg(F.sum("k").alias("records"), n_rows().alias("distinct_values"), F.count_if(c("k") > 1).alias("repeated_values"), F.sum(F.when(c("k") > 1, c("k")).otherwise(0)).alias("in_repeats"), F.sum(F.when(c("k") > 1, c("k") - 1).otherwise(0)).alias("surplus"))


def _top_lines(spark, d):
    return dd.line_frequency(docs(spark, d), "doc_id", "text").orderBy(F.desc("n_docs"), "line").limit(100).select("line", "n_docs")


def _unified(spark, d):
    a = read(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_acctbal").alias("balance"))
    b = read(spark, d, "supplier").select(c("s_suppkey").alias("id"), c("s_nationkey").alias("nation"))
    both = a.withColumn("lane", F.lit("a")).unionByName(b.withColumn("lane", F.lit("b")), allowMissingColumns=True)
    absent = {"name": ("b", F.lit("")), "balance": ("b", F.lit(0.0)), "nation": ("a", F.lit(0))}
    return both.withColumns({k: F.when(c("lane") == lane, default).otherwise(c(k)) for k, (lane, default) in absent.items()})


def _export_fields(spark, d):
    return read(spark, d, "events").select(c("event_id").alias("id"), F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$").isNull().alias("missing"))


_LF = "SELECT DISTINCT doc_id, source, trim(l, ' ') AS line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l, ' ') <> ''"

QUERIES: dict[str, Query] = {
    "P-01": projection("documents", "doc_id", {"status": (lambda: r.validation(c("doc_id"), F.left("text", F.lit(3)), F.lit("u"), c("text"))[0], f"CASE WHEN coalesce(text, '') = '' THEN 'invalid_repairable' WHEN length({strip('text')}) < 30 THEN 'valid_with_warning' ELSE 'valid' END"), "missing": (lambda: F.array_join(r.validation(c("doc_id"), F.left("text", F.lit(3)), F.lit("u"), c("text"))[1], ","), "CASE WHEN coalesce(text, '') = '' THEN 'title' ELSE '' END")}, TEXTS),
    "P-03": projection("documents", "doc_id", {"lane": (lambda: r.lane(c("text"), F.when(c("doc_id") % 2 == 0, "web").otherwise("attachment"), c("doc_id") % 10 == 0, c("text").rlike("&&&"), 2000), f"CASE WHEN doc_id % 2 = 0 THEN CASE WHEN doc_id % 10 = 0 THEN 'web_reparse' WHEN contains(text, '&&&') OR (regexp_matches(text, '(?m)^\\s*\\|.*\\|\\s*$') AND regexp_matches(text, '(?m)^\\s*\\|?\\s*:?-{{3,}}')) THEN 'web_table' WHEN len(list_filter(string_split(text, chr(10)), lambda l: {strip('l')} <> '')) >= 3 THEN 'web_multiline' ELSE 'web_normal' END ELSE CASE WHEN doc_id % 10 = 0 THEN 'attachment_reparse' WHEN length(text) > 2000 THEN 'attachment_oversized' WHEN contains(text, '&&&') THEN 'attachment_table' ELSE 'attachment_text' END END")}, MARKDOWN),
    "P-04": projection("documents", "doc_id", {"table": (lambda: r.has_markdown_table(c("text")), "regexp_matches(text, '(?m)^\\s*\\|.*\\|\\s*$') AND regexp_matches(text, '(?m)^\\s*\\|?\\s*:?-{3,}')"), "lines": (lambda: r.nonblank_lines(c("text")).cast("long"), f"len(list_filter(string_split(text, chr(10)), lambda l: {strip('l')} <> ''))")}, MARKDOWN),
    "P-05": (_routed, _ROUTE),
    "P-06": (lambda sp, d: docs(sp, d).select("doc_id", _noise().alias("n")).select("doc_id", c("n.score").cast("long").alias("score"), c("n.starts").alias("starts")), f"SELECT doc_id, {_SCORE}::BIGINT AS score, starts FROM {_NOISE}"),
    "P-07": projection("pages", "page_id", {"html_len": (lambda: F.length(s.empty(c("html"))).cast("long"), "length(coalesce(html, ''))"), "has_html": (lambda: s.strip(s.empty(c("html"))) != "", f"{strip('html')} <> ''")}),
    "P-08": (lambda sp, d: _cleaned(sp, d).select("doc_id", r.length_gate(c("text"), c("after")).alias("reason")), f"SELECT doc_id, CASE WHEN length(text) < 75 THEN 'raw_text_too_short' WHEN length({_AFTER}) < 75 THEN 'clean_text_too_short' END AS reason FROM documents"),
    "P-09": projection("documents", "doc_id", {"short_page": (lambda: (F.length("text") < 200) & c("text").rlike("Licensed|发布时间"), "length(text) < 200 AND regexp_matches(text, 'Licensed|发布时间')")}),
    "P-10": (_quality, _QUALITY),
    "P-12": (lambda sp, d: read(sp, d, "pages").select("page_id", F.explode(r.mark_assets(F.array(F.struct(F.lit("track(0)").alias("name"), c("url").alias("url"))), c("html"))).alias("a")).select("page_id", "a.referenced", "a.role"), "SELECT page_id, contains(html, 'track(0)') OR contains(html, '附件') AS referenced, CASE WHEN regexp_matches(url, '(?i)logo|icon|copy|wx|qrcode') THEN 'decorative' ELSE 'body_image' END AS role FROM pages"),
    "P-13": projection("pages", "page_id", {"domain": (lambda: s.domain_of(c("url")), "regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '')"), "summary": (lambda: F.left("html", F.lit(200)), "left(html, 200)")}),
    "P-14": (_thresholds, "WITH g AS (SELECT source, count(*) AS n, source || '.org' AS domain FROM documents GROUP BY source UNION ALL VALUES ('a', 10, 'a.org'), ('b', 500, 'b.org'), ('c', 5000, 'c.org')) SELECT source, n, (CASE WHEN n < 20 THEN -1 WHEN source = 'src1' THEN 7 WHEN domain = 'src2.org' THEN 8 WHEN n < 100 THEN 5 WHEN n < 1000 THEN 10 ELSE 20 END)::INTEGER AS threshold, CASE WHEN source = 'src1' THEN 'map:src1' WHEN domain = 'src2.org' THEN 'map:src2.org' ELSE 'policy' END AS by, n >= 20 AS enabled FROM g"),
    "P-15": (lambda sp, d: docs(sp, d).agg((F.count_if(c("doc_id").isNull()) / n_rows() > 0.05).alias("ids_missing"), (1 - F.count_distinct("doc_id") / n_rows() > 0.05).alias("ids_repeat"), (F.count_if(~F.contains("text", F.lit("\n"))) / n_rows() > 0.7).alias("single_line")), "SELECT count(*) FILTER (doc_id IS NULL) / count(*) > 0.05 AS ids_missing, 1 - count(DISTINCT doc_id) / count(*) > 0.05 AS ids_repeat, count(*) FILTER (NOT contains(text, chr(10))) / count(*) > 0.7 AS single_line FROM documents"),
    "P-16": (lambda sp, d: _cleaned(sp, d).agg(F.bool_and(F.length("after") <= F.length("text")).alias("no_growth"), (F.count_distinct("doc_id") == n_rows()).alias("ids_kept")), f"SELECT bool_and(length({_AFTER}) <= length(text)) AS no_growth, count(DISTINCT doc_id) = count(*) AS ids_kept FROM documents"),
    "P-17": (_llm, "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'retry' WHEN quality * 0.5 + 0.3 < 0.6 THEN 'low_quality' WHEN toxic = 1 THEN 'topic_excluded' WHEN doc_id % 6 < 4 THEN 'manual_review' ELSE 'keep' END AS policy_status FROM labels JOIN documents USING (doc_id)"),
    "P-21": (lambda sp, d: read(sp, d, "pages").withColumn("size", F.length("html")).join(read(sp, d, "pages").filter("page_id % 2 = 0").select("url", F.length("html").alias("size")), ["url", "size"], "left_anti").select("page_id"), "SELECT page_id FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages q WHERE q.page_id % 2 = 0 AND q.url = p.url AND length(q.html) = length(p.html))"),
    "P-22": projection("documents", "doc_id", {"needs_ocr": (lambda: (c("source") == "src1") & (F.length("text") < 500), "source = 'src1' AND length(text) < 500")}),
    "P-24": (lambda sp, d: read(sp, d, "pages").select("page_id", F.array_join(F.array_compact(F.array(F.when(~F.lower(F.left("html", F.lit(5000))).rlike("<html|<body|<!doctype"), "raw_html"), F.when(~F.contains("html", F.lit("<img")), "images"))), ",").alias("missing")).filter("missing <> ''"), "SELECT * FROM (SELECT page_id, concat_ws(',', CASE WHEN NOT regexp_matches(lower(left(html, 5000)), '<html|<body|<!doctype') THEN 'raw_html' END, CASE WHEN NOT contains(html, '<img') THEN 'images' END) AS missing FROM pages) WHERE missing <> ''"),
    "J-01": projection("documents", "doc_id", {"text": (lambda: p.normal_form(c("text"), "NFC"), "nfc_normalize(text)")}, TEXTS),
    "J-02": projection("documents", "doc_id", {"text": (lambda: F.translate("text", "國門會", "国门会"), "translate(text, '國門會', '国门会')")}, ("doc_id bigint, text string", [(-1, "中國會門")])),
    "J-03": projection("documents", "doc_id", {"text": (lambda: r.unicode_spaces(c("text")), strip("regexp_replace(coalesce(text, ''), '[\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}\\x{3000}]', ' ', 'g')"))}, TEXTS),
    "J-04": (lambda sp, d: docs(sp, d).unionByName(literal(sp, "doc_id bigint, text string", [(-1, "接种 率 为 8 5 .2 % ,较 去年上升;"), (-2, "会议于2 024年3 月 1 5日召开( 第2次) ."), (-3, "Vitamin C / D - 3 levels, see Table 2"), (-4, "打印本页\n正文"), (-5, "甲，\n乙")])).select("doc_id", r.replace_all(c("text")).alias("text")), None),
    "J-05": (lambda sp, d: docs(sp, d).select("doc_id", p.drop_repeated_sentences(c("text")).alias("text")), None),
    "J-06": (lambda sp, d: dd.drop_frequent_lines(docs(sp, d), "doc_id", "text", 3), "WITH l AS (SELECT doc_id, i, ls[i] AS line, trim(ls[i], ' ') AS bare FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(i)), f AS (SELECT bare FROM l WHERE length(bare) >= 2 AND NOT regexp_matches(line, '^\\s*(?:[\\[\\](){}<>]|#{1,6}\\s|\\\\|<[^>]+>)') GROUP BY bare HAVING count(DISTINCT doc_id) > 3) SELECT d.doc_id, coalesce(string_agg(line, chr(10) ORDER BY i), '') AS text FROM documents d LEFT JOIN (SELECT * FROM l WHERE bare NOT IN (SELECT bare FROM f)) k ON k.doc_id = d.doc_id GROUP BY d.doc_id"),
    "J-08": projection("documents", "doc_id", {"kept": (lambda: F.length("text").between(50, 3_000_000), "length(text) BETWEEN 50 AND 3000000")}),
    "J-09": projection("documents", "doc_id", {"ratio": (lambda: F.round(r.ratio_of(c("text"), r"\p{L}\p{N}"), 6), f"round(CASE WHEN length(text) > 0 THEN {_LETTERS} / length(text) ELSE 0 END, 6)")}),
    "J-10": projection("documents", "doc_id", {"ratio": (lambda: F.round(r.ratio_of(c("text"), "#*$%&|<>"), 6), f"round(CASE WHEN length(text) > 0 THEN {_SPECIAL} / length(text) ELSE 0 END, 6)")}),
    "J-11": (_repetition, _GRAMS),
    "J-12": (_language, None),
    "J-13": (lambda sp, d: dd.exact_dedup(docs(sp, d)).select("doc_id", F.sha2("text", 256).alias("sha")), "SELECT min(doc_id) AS doc_id, sha256(text) AS sha FROM documents GROUP BY text"),
    "J-15": (_rejections, f"SELECT doc_id, CASE WHEN length(text) NOT BETWEEN 50 AND 3000000 THEN 'text_length' WHEN {_LETTERS} / length(text) < 0.45 THEN 'alphanumeric' WHEN {_SPECIAL} / length(text) > 0.2 THEN 'special_characters' END AS first_failed FROM documents"),
    "JN-01": (lambda sp, d: docs(sp, d, "source").join(read(sp, d, "labels").groupBy("doc_id").agg(F.max_by("quality", "toxic").alias("quality")), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality")), "SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN (SELECT doc_id, arg_max(quality, toxic) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)"),
    "JN-02": (lambda sp, d: docs(sp, d).join(read(sp, d, "labels").select("doc_id", F.lit(1).alias("there")), "doc_id", "left").select("doc_id", F.when(c("there").isNull(), "missing_rebuilt_doc").otherwise("ok").alias("issue")), "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_rebuilt_doc' ELSE 'ok' END AS issue FROM documents d LEFT JOIN labels l USING (doc_id)"),
    "JN-03": (lambda sp, d: read(sp, d, "lineitem").join(read(sp, d, "lineitem").filter("l_quantity > 49").select("l_orderkey", "l_linenumber", F.lit("repair").alias("action")).distinct(), ["l_orderkey", "l_linenumber"], "left").select("l_orderkey", "l_linenumber", F.coalesce("action", F.lit("pass")).alias("action")), "SELECT l_orderkey, l_linenumber, CASE WHEN (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity > 49) THEN 'repair' ELSE 'pass' END AS action FROM lineitem"),
    "JN-04": (_manual_assets, "WITH a AS (SELECT page_id AS doc_id, url, 'name' || page_id AS name FROM pages), g AS (SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN url ELSE 'other' END AS mu, CASE WHEN doc_id % 12 = 0 THEN name ELSE 'none' END AS mn FROM a WHERE doc_id % 4 = 0) SELECT g.doc_id, a.url IS NOT NULL AS matched FROM g LEFT JOIN a ON a.doc_id = g.doc_id AND (mu = url OR mn = name)"),
    "JN-05": (_aligned, "WITH b AS (SELECT doc_id % 50 AS k, doc_id, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id)::INTEGER AS occ FROM documents), a AS (SELECT doc_id % 50 AS k, doc_id, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id)::INTEGER AS occ FROM documents WHERE doc_id % 7 <> 0) SELECT b.k, b.occ, b.doc_id AS before, coalesce(a.doc_id, -1) AS after FROM b LEFT JOIN a USING (k, occ)"),
    "JN-06": (_survivors, "WITH h AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY regexp_replace(text, '[\\s\\x0B\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', '', 'g')) AS survivor FROM documents) SELECT * FROM h WHERE doc_id <> survivor"),
    "JN-07": (lambda sp, d: read(sp, d, "customer").join(read(sp, d, "nation"), c("c_nationkey") == c("n_nationkey"), "left").groupBy("n_name").agg(n_rows().alias("n")), "SELECT n_name, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"),
    "JN-08": (lambda sp, d: docs(sp, d).join(read(sp, d, "labels").withColumnRenamed("doc_id", "ordinal"), c("doc_id") == c("ordinal"), "left").select("doc_id", c("ordinal").isNotNull().alias("audited")), "SELECT d.doc_id, l.doc_id IS NOT NULL AS audited FROM documents d LEFT JOIN labels l USING (doc_id)"),
    "JN-09": (lambda sp, d: docs(sp, d).filter("doc_id % 2 = 0").join(docs(sp, d).filter("doc_id % 6 = 0").select("doc_id"), "doc_id", "left_semi").agg(n_rows().alias("shared")), "SELECT count(*) AS shared FROM documents WHERE doc_id % 6 = 0"),
    "JN-10": (_audit, "SELECT coalesce(o_orderkey, l_orderkey) AS id, CASE WHEN o_orderstatus IS NULL THEN 'missing_fact' WHEN l_linestatus IS NULL THEN 'missing_index' WHEN o_orderstatus <> l_linestatus THEN 'status_differs' ELSE 'ok' END AS issue FROM orders FULL JOIN (SELECT * FROM lineitem WHERE l_linenumber = 1) ON o_orderkey = l_orderkey"),
    "JN-11": (_remaining, "WITH t AS (SELECT url, arg_max(struct_pack(z := size, s := status), struct_pack(a := status = 'submitted', b := size, c := status)) AS t FROM (SELECT url, length(html) + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS size, CASE WHEN page_id % 2 = 0 THEN 'submitted' ELSE 'processed' END AS status FROM pages WHERE page_id % 3 <> 0) GROUP BY url) SELECT page_id, CASE WHEN t.url IS NULL THEN 'remaining' WHEN t.t.z <> length(html) THEN 'changed' ELSE t.t.s END AS state FROM pages p LEFT JOIN t ON t.url = p.url"),
    "JN-12": (_reuse, "SELECT sha, event_id FROM (SELECT sha256(user_id::VARCHAR) AS sha, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events WHERE event_type <> 'error') WHERE rn = 1"),
    "AG-01": (lambda sp, d: docs(sp, d, "lang", "source").select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), (s.empty(c(n).cast("string")) == "").alias("missing")) for n in ("doc_id", "text", "lang", "source")])).alias("x")).groupBy("x.field").agg(n_rows().alias("n"), F.count_if("x.missing").alias("missing")), "SELECT field, count(*) AS n, count(*) FILTER (v IS NULL OR v = '') AS missing FROM (SELECT unnest(['doc_id', 'text', 'lang', 'source']) AS field, unnest([doc_id::VARCHAR, text, lang, source]) AS v FROM documents) GROUP BY field"),
    "AG-02": (lambda sp, d: docs(sp, d).select(F.explode(w.found_terms(c("text"), DATA_TERMS)).alias("term")).groupBy("term").agg(n_rows().alias("n")), f"SELECT term, count(*) AS n FROM (SELECT unnest({_hits('text', DATA_TERMS)}) AS term FROM documents) GROUP BY term"),
    "AG-03": (lambda sp, d: dd.duplicate_groups(docs(sp, d), F.sha1(c("text").cast("binary")), "doc_id"), "SELECT sha1(text) AS key, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, key LIMIT 1000"),
    "AG-04": (lambda sp, d: dd.canonical(docs(sp, d).withColumn("url", F.concat(F.lit("x"), (c("doc_id") % 5).cast("string"))), "text", "url", "doc_id"), "SELECT CASE WHEN length(text) < 50 THEN 'url:x' || (doc_id % 5) ELSE sha1(text) END AS key, arg_max(doc_id, struct_pack(a := length(text), b := -doc_id)) AS canonical_doc_id, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY 1"),
    "AG-05": (_greedy, None),
    "AG-07": (_line_frequency, f"SELECT source AS \"group\", line, count(*) AS n_docs FROM ({_LF}) GROUP BY ALL HAVING count(*) > 1"),
    "AG-08": (_summary, "SELECT count(*) AS documents, count(*) FILTER (text = '') AS empty, sum(length(text))::BIGINT AS chars, round(avg(length(text)), 6) AS mean, median(length(text)) AS median, min(length(text)) AS shortest, max(length(text)) AS longest, arg_min(doc_id, struct_pack(a := length(text), b := doc_id)) AS shortest_id FROM documents"),
    "AG-09": (_comparison, f"WITH x AS (SELECT source, length(text) AS b, length({_AFTER}) AS a FROM documents) SELECT source, count(*) AS documents, sum(b - a)::BIGINT AS removed, " + ", ".join(f"count(*) FILTER ((b - a) / greatest(b, 1) > {k / 100}) AS over_{k}" for k in (10, 30, 50, 80)) + " FROM x GROUP BY source"),
    "AG-10": (lambda sp, d: _cleaned(sp, d).agg(n_rows().alias("documents"), F.count_if(c("text") != c("after")).alias("changed"), F.count_if(c("after") == "").alias("emptied")), f"SELECT count(*) AS documents, count(*) FILTER (text <> {_AFTER}) AS changed, count(*) FILTER ({_AFTER} = '') AS emptied FROM documents"),
    "AG-11": (_stats, "SELECT org, channel, count(*) AS n, count(DISTINCT url) AS urls FROM (SELECT url, CASE WHEN d = 'example.com' THEN 'Com' WHEN d = 'example.org' THEN 'Org' WHEN ends_with(d, 'example.com') THEN 'Com' WHEN ends_with(d, 'example.org') THEN 'Org' ELSE d END AS org, regexp_extract(url, '//[^/]*/([a-z]{2})/', 1) AS channel FROM (SELECT url, replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), 'www.', '') AS d FROM pages)) GROUP BY ALL"),
    "AG-12": (_duplicate_counts, "WITH k AS (SELECT l_partkey, count(*) AS k FROM lineitem GROUP BY 1) SELECT sum(k)::BIGINT AS records, count(*) AS distinct_values, count(*) FILTER (k > 1) AS repeated_values, sum(CASE WHEN k > 1 THEN k ELSE 0 END)::BIGINT AS in_repeats, sum(CASE WHEN k > 1 THEN k - 1 ELSE 0 END)::BIGINT AS surplus FROM k"),
    "AG-13": (lambda sp, d: _routed(sp, d).groupBy("route").agg(n_rows().alias("n")), f"SELECT route, count(*) AS n FROM ({_ROUTE}) GROUP BY route"),
    "AG-14": (lambda sp, d: _cleaned(sp, d).agg((F.count_if(F.length("after") >= 75) / n_rows()).alias("retention"), F.count_if(c("after").rlike("https?://")).alias("with_urls")), f"SELECT count(*) FILTER (length({_AFTER}) >= 75) / count(*) AS retention, count(*) FILTER (regexp_matches({_AFTER}, 'https?://')) AS with_urls FROM documents"),
    "AG-15": (lambda sp, d: docs(sp, d).unionByName(literal(sp, *MARKDOWN)).select(w.markdown_tables(c("text")).alias("t")).agg(F.sum("t.n_tables").alias("tables"), F.bool_and(c("t.n_rows") >= c("t.n_tables")).alias("can_enter_next_step")), f"SELECT sum(len(regexp_extract_all(k, 'P*S[PS]*')))::BIGINT AS tables, bool_and(coalesce(list_sum(list_transform(regexp_extract_all(k, 'P*S[PS]*'), lambda b: length(b) - 1)), 0) >= len(regexp_extract_all(k, 'P*S[PS]*'))) AS can_enter_next_step FROM (SELECT array_to_string(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN regexp_matches(l, '^\\s*\\|*\\s*:?-{{3,}}:?\\s*(?:\\|\\s*:?-{{3,}}:?\\s*)+\\|*\\s*$') THEN 'S' WHEN contains(l, '|') THEN 'P' ELSE '-' END), '') AS k FROM (SELECT text FROM documents UNION ALL SELECT x.t FROM (VALUES {values(MARKDOWN[1])}) x(i, t)))"),
    "AG-16": (lambda sp, d: read(sp, d, "events").groupBy("event_type").agg(n_rows().alias("n"), F.count_distinct("user_id").alias("users")), "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type"),
    "AG-17": (lambda sp, d: _llm(sp, d).groupBy("policy_status").agg(n_rows().alias("n")), "SELECT CASE WHEN doc_id % 11 = 0 THEN 'retry' WHEN quality * 0.5 + 0.3 < 0.6 THEN 'low_quality' WHEN toxic = 1 THEN 'topic_excluded' WHEN doc_id % 6 < 4 THEN 'manual_review' ELSE 'keep' END AS policy_status, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1"),
    "AG-19": (lambda sp, d: read(sp, d, "pages").groupBy((F.octet_length("url") > 40).alias("long")).agg(n_rows().alias("n"), F.max(F.length("url")).alias("longest")), "SELECT octet_length(encode(url)) > 40 AS long, count(*) AS n, max(length(url))::INTEGER AS longest FROM pages GROUP BY 1"),
    "AG-20": (lambda sp, d: QUERIES["P-24"][0](sp, d).select(F.explode(F.split("missing", ",")).alias("kind")).groupBy("kind").agg(n_rows().alias("n")), "SELECT kind, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN NOT regexp_matches(lower(left(html, 5000)), '<html|<body|<!doctype') THEN 'raw_html' END, CASE WHEN NOT contains(html, '<img') THEN 'images' END], lambda x: x IS NOT NULL)) AS kind FROM pages) GROUP BY kind"),
    "AG-21": (lambda sp, d: read(sp, d, "pages").groupBy("url").agg(n_rows().alias("n")).filter("n > 1"), "SELECT url, count(*) AS n FROM pages GROUP BY url HAVING count(*) > 1"),
    "WN-01": (lambda sp, d: dd.unique_ids(docs(sp, d, "source"), "source", "doc_id").select("doc_id", "unique_id"), "SELECT doc_id, CASE WHEN k = 1 THEN source ELSE source || '_' || k END AS unique_id FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents)"),
    "WN-02": (lambda sp, d: docs(sp, d, "source", "n_chars").withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))).filter("k = 1").select("source", "doc_id"), "SELECT source, arg_max(doc_id, struct_pack(a := n_chars, b := -doc_id)) AS doc_id FROM documents GROUP BY source"),
    "WN-03": (lambda sp, d: docs(sp, d, "source").groupBy("source").agg(F.min("doc_id").alias("first")).withColumn("group_no", F.dense_rank().over(Window.orderBy("first"))), "SELECT source, first, dense_rank() OVER (ORDER BY first)::INTEGER AS group_no FROM (SELECT source, min(doc_id) AS first FROM documents GROUP BY source)"),
    "WN-04": (lambda sp, d: docs(sp, d).select("doc_id", F.posexplode(w.position_ratio(F.split("text", "\n", -1))).alias("i", "ratio")).select("doc_id", "i", F.round("ratio", 6).alias("ratio")), "SELECT doc_id, (k - 1)::INTEGER AS i, round((k - 1) / greatest(n - 1, 1), 6) AS ratio FROM (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents), unnest(range(1, n + 1)) AS u(k)"),
    "WN-05": (lambda sp, d: read(sp, d, "conversations").withColumn("again", F.coalesce(c("role") == F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(False))).select("conv_id", "turn", "again"), "SELECT conv_id, turn, coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn), false) AS again FROM conversations"),
    "WN-06": (lambda sp, d: docs(sp, d, "lang").groupBy("lang").agg(F.min("doc_id").alias("first")), "SELECT lang, min(doc_id) AS first FROM documents GROUP BY lang"),
    "ST-01": (lambda sp, d: read(sp, d, "lineitem").groupBy("l_partkey").agg(n_rows().alias("n")).orderBy(F.desc("n"), "l_partkey").limit(100), "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 100"),
    "ST-02": (_top_lines, f"SELECT line, count(*) AS n_docs FROM ({_LF}) GROUP BY line ORDER BY n_docs DESC, line LIMIT 100"),
    "ST-03": (lambda sp, d: docs(sp, d).orderBy("doc_id").limit(20).select("doc_id"), "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 20"),
    "SM-01": (lambda sp, d: docs(sp, d).orderBy(F.xxhash64("doc_id", F.lit(20260721))).limit(100).select("doc_id"), None),
    "SM-02": (lambda sp, d: _cleaned(sp, d).withColumn("kind", F.when(c("text") == c("after"), "unchanged").otherwise("changed")).withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("doc_id")))).filter("k <= 20").select("doc_id", "kind"), None),
    "SO-01": (_unified, "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'a' AS lane, 0 AS nation FROM customer UNION ALL SELECT s_suppkey, '', 0.0, 'b', s_nationkey FROM supplier"),
    "SO-02": (lambda sp, d: read(sp, d, "events").select("event_id", F.map_concat(F.create_map(F.lit("type"), c("event_type")), F.create_map(F.lit("lane"), F.lit("x")))["type"].alias("type")), "SELECT event_id, event_type AS type FROM events"),
    "SO-03": (lambda sp, d: docs(sp, d).select("doc_id").union(read(sp, d, "labels").select("doc_id")), "SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels"),
    "SO-04": (lambda sp, d: docs(sp, d).select("doc_id").union(docs(sp, d).select("doc_id")).exceptAll(read(sp, d, "labels").select("doc_id")), "SELECT doc_id FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM documents) EXCEPT ALL SELECT doc_id FROM labels"),
    "SO-05": (lambda sp, d: docs(sp, d).select("doc_id", F.array_join(F.array_intersect(w.found_terms(c("text"), DATA_TERMS), F.array(F.lit("That"), F.lit("| "))), ",").alias("both")), f"SELECT doc_id, array_to_string({_hits('text', ['| ', 'That'])}, ',') AS both FROM documents" if DATA_TERMS.index("| ") < DATA_TERMS.index("That") else None),
    "SO-06": (lambda sp, d: read(sp, d, "conversations").groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles")), "SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY conv_id"),
    "SK-08": (lambda sp, d: _routed(sp, d).groupBy("route").agg(F.min("doc_id").alias("first"), n_rows().alias("n")), f"SELECT route, min(doc_id) AS first, count(*) AS n FROM ({_ROUTE}) GROUP BY route"),
    "SK-09": (lambda sp, d: _routed(sp, d).select("doc_id", F.explode(F.array_intersect(F.split("flags", ","), F.array(F.lit("short_text"), F.lit("nav_noise"), F.lit("has_image")))).alias("flag")), f"SELECT doc_id, flag FROM (SELECT doc_id, unnest(string_split(flags, ',')) AS flag FROM ({_ROUTE})) WHERE flag IN ('short_text', 'nav_noise', 'has_image')"),
    "SK-10": (lambda sp, d: docs(sp, d, "lang", "source").filter("text <> ''").select(c("doc_id").cast("string").alias("id"), "text", F.to_json(F.struct("lang", "source")).alias("metadata")), "SELECT doc_id::VARCHAR AS id, text, '{\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}' AS metadata FROM documents WHERE text <> ''"),
    "SK-11": (_export_fields, "SELECT event_id AS id, json_extract_string(props, '$.k') AS k, props IS NULL AS missing FROM events"),
    "SK-12": (lambda sp, d: read(sp, d, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("text")), "SELECT page_id, url, coalesce(html, '') AS text FROM pages"),
    "SK-13": (lambda sp, d: read(sp, d, "orders").orderBy("o_orderkey").drop("o_custkey", "o_orderdate").select("o_orderkey", "o_orderstatus"), "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey"),
    "SK-14": (lambda sp, d: read(sp, d, "pages").withColumn("k", F.lower("url")).withColumn("collides", F.count(F.lit(1)).over(Window.partitionBy("k")) > 1).select("page_id", "collides"), "SELECT page_id, count(*) OVER (PARTITION BY lower(url)) > 1 AS collides FROM pages"),
    "SK-15": (lambda sp, d: read(sp, d, "supplier").select("s_nationkey", "s_name").orderBy("s_nationkey", "s_name"), "SELECT s_nationkey, s_name FROM supplier ORDER BY ALL"),
}
