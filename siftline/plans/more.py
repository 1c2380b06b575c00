"""Queries for HTML operators, state, sources and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import files
from ..functions import html_text as h
from ..functions import python_text as p
from ..functions import scalars as s
from ..operators import lines as w
from ..sources import jsonl, sinks
from ..streaming import callbacks
from . import stages
from .build import Query, literal, projection, read
from .lines import DATA_TERMS
from .records import docs

c = F.col


def n_rows():
    return F.count(F.lit(1))

TABLES = ("page_id bigint, html string", [(-1, "<html><body><h1>T</h1><table><tr><th>a</th><th>b</th></tr><tr><td rowspan=2>1</td><td>2</td></tr><tr><td>3</td></tr></table><a href='/x/f.pdf?y=1'>f</a><img src='i.png' alt='i'></body></html>"), (-2, ""), (-3, "plain")])


def pages(spark, d) -> DataFrame:
    return read(spark, d, "pages").select("page_id", "html").unionByName(literal(spark, *TABLES))


def _events(spark, d):
    return read(spark, d, "events").select("event_id", "user_id", "event_type")


_STATE = "WITH e AS (SELECT user_id AS request_id, event_id AS seq, event_type <> 'error' AS ok FROM events), f AS (SELECT request_id, count(*) AS n_events, min(seq) FILTER (ok) AS first_ok, max(seq) AS latest_seq FROM e GROUP BY 1) SELECT f.request_id, n_events, coalesce(first_ok, latest_seq) AS canonical_seq, first_ok IS NOT NULL AS succeeded, latest_seq, (SELECT count(*) FROM e WHERE e.request_id = f.request_id AND NOT ok AND seq > first_ok) AS late_failures FROM f"


def _uncertain(spark, d):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    rows = read(spark, d, "events").withColumn("status", F.when(c("event_id") % 3 == 0, "submitting").when(c("event_id") % 3 == 1, "submit_unknown").otherwise("success"))
    return callbacks.submission_uncertain(rows, "ts", "status", now).select("event_id", "new_status")


def _compare_and_set(spark, d):
    tasks = read(spark, d, "orders").select("o_orderkey", c("o_orderstatus").alias("status"))
    changes = read(spark, d, "orders").filter("o_orderkey % 2 = 0").select("o_orderkey", F.lit("O").alias("expected"), F.lit("F").alias("new"))
    return callbacks.compare_and_set(tasks, changes, "o_orderkey")


def _preflight(spark, d):
    rows = read(spark, d, "pages").select("page_id", c("html").cast("binary").alias("content"), F.when(c("page_id") % 4 == 0, ".pdf").when(c("page_id") % 4 == 1, ".html").when(c("page_id") % 4 == 2, ".doc").otherwise(".txt").alias("ext"))
    body = F.when(c("page_id") % 8 >= 4, F.substring("content", 200, 100000)).otherwise(c("content"))
    return rows.select("page_id", files.preflight(body, c("ext")).alias("status"))


def _upsert(spark, d):
    old = read(spark, d, "events").filter("event_id % 2 = 0").select("user_id", "event_id", "event_type")
    new = read(spark, d, "events").filter("event_id % 2 = 1").select("user_id", "event_id", "event_type")
    return callbacks.upsert(old, new, "user_id", "event_id")


def _timeouts(spark, d):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    rows = read(spark, d, "events").withColumn("status", F.when(c("event_id") % 3 == 0, "submitted").otherwise("success"))
    return callbacks.timed_out(rows, "ts", "status", now).select("event_id", "new_status")


def _lines(spark, d):
    """The test table as JSON text through the line parser, with bad lines among them."""
    rows = docs(spark, d).select(F.lit("f").alias("file"), c("doc_id").alias("line_no"), F.when(c("doc_id") % 10 == 0, "{bad").when(c("doc_id") % 10 == 1, "[1]").when(c("doc_id") % 10 == 2, " ").otherwise(F.to_json(F.struct("doc_id", "text"))).alias("line"))
    return rows


def _article_input(spark, d):
    return read(spark, d, "pages").select(c("page_id").alias("doc_id"), F.lit("t").alias("title"), "url", F.lit("").alias("text"), "html")


def _deduplicated(spark, d):
    kept, gone = stages.canonical_only(_article_input(spark, d).withColumn("clean_text", F.col("html")))
    return kept.select("doc_id", F.lit("kept").alias("status")).union(gone.select("doc_id", F.lit("quarantined")))


def _retry(spark, d):
    first = lambda df: df.withColumn("success", c("doc_id") % 3 != 0)
    return stages.retry_rounds(docs(spark, d).select("doc_id"), first, 2).groupBy("round", "success").agg(n_rows().alias("n"))


QUERIES: dict[str, Query] = {
    "H-01": (lambda sp, d: pages(sp, d).select("page_id", s.clean_basic(h.html_to_text(c("html"))).alias("text")), None),
    "H-02": (lambda sp, d: pages(sp, d).select("page_id", h.without_boilerplate(c("html"), (".ad",)).alias("text")), None),
    "H-03": (lambda sp, d: pages(sp, d).select("page_id", h.article(c("html"), ("article",)).alias("a")).select("page_id", "a.text", "a.selector", F.round("a.confidence", 6).alias("confidence")), None),
    "H-04": (lambda sp, d: read(sp, d, "pages").select(s.domain_of(c("url")).alias("domain"), h.article(c("html"), ("article",)).alias("a")).groupBy("domain", c("a.selector").alias("selector")).agg(n_rows().alias("n")), None),
    "H-05": (lambda sp, d: pages(sp, d).select("page_id", F.posexplode(h.tables(c("html"))).alias("i", "t")).select(F.concat(c("page_id").cast("string"), F.lit("#t"), F.lpad((c("i") + 1).cast("string"), 3, "0")).alias("table_id"), F.size("t").alias("n_rows"), F.array_join(F.get("t", 0), "|").alias("header")), None),
    "H-06": (lambda sp, d: pages(sp, d).select("page_id", F.size(h.links(c("html"), F.lit("http://x/"), "image")).cast("long").alias("images")), None),
    "H-07": (lambda sp, d: pages(sp, d).select("page_id", F.array_join(F.transform(h.links(c("html"), F.lit("http://x/")), lambda x: x["url"]), ",").alias("files")), None),
    "H-08": projection("pages", "page_id", {"table": (lambda: h.has_table(c("html")), "regexp_matches(html, '(?i)<\\s*table\\b')")}, TABLES),
    "H-09": (lambda sp, d: pages(sp, d).select("page_id", h.to_markdown(c("html")).alias("markdown")), None),
    "H-10": (lambda sp, d: pages(sp, d).select("page_id", h.table_counts(c("html")).alias("t")).select("page_id", "t.tables", "t.rows", "t.cells"), "SELECT page_id, len(regexp_extract_all(html, '(?i)<table\\b')) AS tables, len(regexp_extract_all(html, '(?i)<tr\\b')) AS rows, len(regexp_extract_all(html, '(?i)<t[dh]\\b')) AS cells FROM (SELECT page_id, html FROM pages UNION ALL VALUES " + ", ".join(f"({i}, '{t.replace(chr(39), chr(39) * 2)}')" for i, t in TABLES[1]) + ")"),
    "H-11": (lambda sp, d: pages(sp, d).select("page_id", h.extract_main(c("html")).alias("text")), None),
    "H-12": projection("pages", "page_id", {"valid": (lambda: h.looks_like_html(c("html")), "regexp_matches(lower(left(html, 5000)), '<html|<body|<!doctype html')")}, TABLES),
    "F-03": (lambda sp, d: read(sp, d, "events").select("event_id", F.array_join(p.flatten_keys(c("props")), ",").alias("keys")), "SELECT event_id, coalesce(array_to_string(list_sort(json_keys(props)), ','), '') AS keys FROM events"),
    "F-04": projection("events", "event_id", {"missing": (lambda: s.empty(c("props")).isin("", "[]", "{}"), "coalesce(props, '') IN ('', '[]', '{}')")}),
    "F-06": projection("documents", "doc_id", {"fingerprint": (lambda: p.fingerprint(c("text")), "sha256(regexp_replace(nfc_normalize(text), '[\\s\\x0B\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', '', 'g'))")}),
    "F-18": (lambda sp, d: docs(sp, d).select("doc_id", s.clean_basic(p.unescape(c("text"))).alias("text")), None),
    "F-23": projection("documents", "doc_id", {"title": (lambda: p.normalize_title(F.get(F.split("text", "\n"), 0)), "regexp_replace(regexp_replace(lower(string_split(text, chr(10))[1]), '\\s+', '', 'g'), '[，,。.、；;：:！!？?‘’“”\"''（）()【】\\[\\]《》<>〈〉—_·•|/\\\\-]', '', 'g')")}),
    "F-32": (lambda sp, d: literal(sp, *TABLES).select("page_id", F.to_json(h.tables(c("html"))).alias("tables")), "SELECT * FROM (VALUES (-1::BIGINT, '[[[\"a\",\"b\"],[\"1\",\"2\"],[\"1\",\"3\"]]]'), (-2, '[]'), (-3, '[]')) t(page_id, tables)"),
    "IO-01": (lambda sp, d: jsonl.parse_lines(_lines(sp, d), "doc_id long, text string").select("line_no", F.coalesce("record.doc_id", F.lit(-1).cast("long")).alias("doc_id"), "error", "raw"), "SELECT doc_id AS line_no, CASE WHEN doc_id % 10 > 2 THEN doc_id ELSE -1 END AS doc_id, CASE WHEN doc_id % 10 < 2 THEN 'not a JSON object' END AS error, CASE doc_id % 10 WHEN 0 THEN '{bad' WHEN 1 THEN '[1]' END AS raw FROM documents WHERE doc_id % 10 <> 2"),
    "IO-02": (lambda sp, d: jsonl.parse_lines(_lines(sp, d), "doc_id long, text string", "error").groupBy("error").agg(n_rows().alias("n")), "SELECT CASE doc_id % 10 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'not a JSON object' WHEN 2 THEN 'blank line' END AS error, count(*) AS n FROM documents GROUP BY 1"),
    "IO-05": (lambda sp, d: jsonl.validate(jsonl.parse_lines(_lines(sp, d), "doc_id long, text string")), "SELECT 'f' AS file, count(*) AS n, count(*) FILTER (doc_id % 10 < 2) AS bad FROM documents WHERE doc_id % 10 <> 2"),
    "IO-14": (lambda sp, d: docs(sp, d).join(read(sp, d, "pages").select(c("page_id").alias("doc_id"), "html"), "doc_id", "left").select("doc_id", c("html").isNotNull().alias("has_raw")), "SELECT doc_id, html IS NOT NULL AS has_raw FROM documents LEFT JOIN pages ON page_id = doc_id"),
    "IO-11": (lambda sp, d: docs(sp, d, "lang").select("doc_id", F.coalesce(F.create_map(F.lit("de"), F.lit("German"), F.lit("en"), F.lit("English"))[c("lang")], c("lang")).alias("label")), "SELECT doc_id, CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' ELSE lang END AS label FROM documents"),
    "SS-01": (lambda sp, d: callbacks.latest_state(_events(sp, d), "user_id", "event_id", c("event_type") != "error"), _STATE),
    "SS-02": (lambda sp, d: callbacks.latest_state(_events(sp, d), "user_id", "event_id", c("event_type") == "purchase").filter("late_failures > 0").select("request_id", "late_failures"), _STATE.replace("event_type <> 'error'", "event_type = 'purchase'").replace("SELECT f.request_id", "SELECT request_id, late_failures FROM (SELECT f.request_id") + ") WHERE late_failures > 0"),
    "SS-03": (_timeouts, "SELECT event_id, CASE WHEN event_id % 3 = 0 AND ts < TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 120 MINUTE THEN 'callback_timeout' WHEN event_id % 3 = 0 THEN 'submitted' ELSE 'success' END AS new_status FROM events"),
    "SS-04": (_uncertain, "SELECT event_id, CASE WHEN event_id % 3 = 0 AND old THEN 'submit_unknown' WHEN event_id % 3 = 1 AND old THEN 'submit_unknown_timeout' WHEN event_id % 3 = 0 THEN 'submitting' WHEN event_id % 3 = 1 THEN 'submit_unknown' ELSE 'success' END AS new_status FROM (SELECT event_id, ts < TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 120 MINUTE AS old FROM events)"),
    "SS-06": (_compare_and_set, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status, o_orderkey % 2 = 0 AND o_orderstatus = 'O' AS applied FROM orders"),
    "P-19": (_preflight, "SELECT page_id, CASE WHEN page_id % 8 < 4 AND page_id % 4 <> 1 THEN 'html_disguised' WHEN page_id % 4 IN (0, 2) THEN 'magic_mismatch' ELSE 'ok' END AS status FROM pages"),
    "P-20": (lambda sp, d: read(sp, d, "pages").select("page_id", files.true_extension(F.when(c("page_id") % 2 == 0, c("html").cast("binary")).otherwise(F.unhex(F.lit("255044462D312E34")))).alias("extension")), "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '.html' ELSE '.pdf' END AS extension FROM pages"),
    "IO-03": (lambda sp, d: jsonl.parse_lines(_lines(sp, d), "doc_id long, text string").filter("error IS NULL").select("record.doc_id", F.length("record.text").alias("n")), "SELECT doc_id, length(text)::INTEGER AS n FROM documents WHERE doc_id % 10 > 2"),
    "SS-07": (_upsert, "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id"),
    "SS-08": (lambda sp, d: _events(sp, d).join(callbacks.latest_state(_events(sp, d), "user_id", "event_id", c("event_type") != "error").select(c("request_id").alias("user_id"), "succeeded"), "user_id", "left").select("event_id", F.when(c("succeeded"), "success").otherwise("active").alias("status")), "SELECT event_id, CASE WHEN bool_or(event_type <> 'error') OVER (PARTITION BY user_id) THEN 'success' ELSE 'active' END AS status FROM events"),
    "SS-11": (_retry, "SELECT 0 AS round, true AS success, count(*) AS n FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT 2, false, count(*) FROM documents WHERE doc_id % 3 = 0"),
    "SG-A": (lambda sp, d: stages.article_pipeline(_article_input(sp, d), DATA_TERMS)[0].select("id", F.length("text").alias("n"), "metadata.label"), None),
    "SG-A10": (_deduplicated, "SELECT page_id AS doc_id, CASE WHEN page_id = min(page_id) OVER (PARTITION BY html) THEN 'kept' ELSE 'quarantined' END AS status FROM pages"),
    "SG-D": (lambda sp, d: stages.lane_pipeline(docs(sp, d)).select("doc_id", F.length("text").alias("n")), None),
    "CFG-01": (lambda sp, d: stages.build(["text_length_filter", "document_deduplicator"], {"text_length_filter": {"min_len": 100}})(docs(sp, d)).select("doc_id"), "SELECT min(doc_id) AS doc_id FROM documents WHERE length(text) BETWEEN 100 AND 3000000 GROUP BY text"),
    "SK-10b": (lambda sp, d: sinks.export_documents(docs(sp, d, "lang"), "doc_id", "text", ["lang"]).select("id", "metadata.lang"), "SELECT doc_id::VARCHAR AS id, lang FROM documents WHERE text <> ''"),
    "W-11b": (lambda sp, d: docs(sp, d).select("doc_id", w.deterministic_clean(p.unescape(c("text")), F.lit("")).alias("text")), None),
}
