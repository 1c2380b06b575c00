"""Queries for site rules, submission slots, policies and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import workflow as f
from ..sources import sinks
from .build import Query, literal, read, values

c = F.col
RULES = [
    {"id": "licence", "pattern": "Licensed under.*", "region": "footer", "source": "src1*"},
    {"id": "short", "pattern": r"\S+\.", "region": "header", "domain": "e?"},
    {"id": "off", "pattern": ".*", "risk": "high", "enabled": False},
]
_P = "((i - 1)::DOUBLE / greatest(n - 1, 1))"
_LINES = "(SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, len(ls) AS n, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))"
_RULE = f"CASE WHEN regexp_matches(l, 'https?://|\\]\\(') THEN NULL WHEN regexp_full_match(trim(l), 'Licensed under.*') AND starts_with(source, 'src1') AND {_P} >= 0.65 THEN 'licence' WHEN regexp_full_match(trim(l), '\\S+\\.') AND regexp_full_match(lang, 'e.') AND {_P} <= 0.35 THEN 'short' END"


def _site_rules(spark, d):
    return read(spark, d, "documents").select("doc_id", f.site_rules(c("text"), c("source"), c("lang"), RULES).alias("r"))


def _hits(spark, d):
    return _site_rules(spark, d).select("doc_id", F.explode("r.hits").alias("h")).select("doc_id", c("h.rule").alias("rule"), c("h.line").cast("long").alias("line"), c("h.text").alias("text"))


_TASKS = "SELECT o_orderkey AS task, o_custkey % 97 AS batch, o_custkey % 97 % 5 AS pool, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'active' ELSE 'pending' END AS status FROM orders"


def _slots(spark, d):
    status = F.when(c("o_orderstatus") == "F", "done").when(c("o_orderstatus") == "P", "active").otherwise("pending")
    tasks = read(spark, d, "orders").select(c("o_orderkey").alias("task"), (c("o_custkey") % 97).alias("batch"), (c("o_custkey") % 97 % 5).alias("pool"), status.alias("status"))
    return f.admit(tasks, 12, 90).select("task", "batch", "pool", "status", "admitted")


_POLICY = ("data string, external boolean, allowed boolean", [(x, e, a) for x in ("public", "internal", "confidential", "secret") for e in (True, False) for a in (True, False)])


def _fields(spark, d):
    return sinks.export_json_fields(read(spark, d, "events").select("event_id", "props"), "props", {"key": "k"}, "skip", keep=["event_id"])


def _presubmit(spark, d):
    ends = F.element_at(F.split("url", r"\."), -1)
    rows = read(spark, d, "pages").select("page_id", F.when(c("page_id") % 2 == 0, "pdf").otherwise("exe").alias("x"), F.octet_length("html").cast("long").alias("size"), F.sha2("html", 256).alias("h"), ends.alias("ends"))
    return rows.select("page_id", f.presubmit(c("x"), c("size"), c("h"), c("h").startswith("0"), c("h").startswith("1"), ["pdf", "docx"], 3000).alias("status"))


QUERIES: dict[str, Query] = {
    "W-12s": (lambda s, d: _site_rules(s, d).select("doc_id", c("r.text").alias("text"), F.size("r.hits").cast("long").alias("n")), f"SELECT doc_id, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (r IS NULL), '') AS text, count(r) AS n FROM (SELECT *, {_RULE} AS r FROM {_LINES}) GROUP BY doc_id"),
    "W-12h": (_hits, f"SELECT doc_id, r AS rule, (i - 1)::BIGINT AS line, l AS text FROM (SELECT *, {_RULE} AS r FROM {_LINES}) WHERE r IS NOT NULL"),
    "SS-05": (_slots, f"WITH t AS ({_TASKS}), a AS (SELECT *, status = 'pending' AND count(*) FILTER (status = 'active') OVER (PARTITION BY batch) + count(*) FILTER (status = 'pending') OVER (PARTITION BY batch ORDER BY task ROWS UNBOUNDED PRECEDING) <= 12 AS ok FROM t) SELECT task, batch, pool, status, ok AND count(*) FILTER (status = 'active') OVER (PARTITION BY pool) + count(*) FILTER (ok) OVER (PARTITION BY pool ORDER BY task ROWS UNBOUNDED PRECEDING) <= 90 AS admitted FROM a"),
    "SS-10": (_presubmit, "SELECT page_id, CASE WHEN page_id % 2 <> 0 THEN 'unsupported' WHEN octet_length(encode(html)) NOT BETWEEN 1 AND 3000 OR html IS NULL THEN 'preflight_failed' WHEN starts_with(sha256(html), '0') THEN 'skipped_duplicate' WHEN starts_with(sha256(html), '1') THEN 'waiting' ELSE 'pending' END AS status FROM pages"),
    "SK-11s": (_fields, "SELECT event_id, json_extract_string(props, '$.k') AS key FROM events WHERE json_exists(props, '$.k')"),
    "P-18": (lambda s, d: literal(s, *_POLICY).withColumn("verdict", f.outbound(c("data"), c("external"), c("allowed"))), f"SELECT *, CASE WHEN data = 'secret' THEN 'unknown_classification' WHEN NOT external THEN 'allowed' WHEN data <> 'public' THEN 'refused_classification' WHEN NOT allowed THEN 'refused_not_allowed' ELSE 'allowed' END AS verdict FROM (VALUES {values(_POLICY[1])}) AS v(data, external, allowed)"),
    "F-38": (lambda s, d: read(s, d, "orders").select("o_orderkey", f.duration(F.floor(c("o_totalprice")) / 4 - 60).alias("took")), "SELECT o_orderkey, CASE WHEN s < 60 THEN printf('%.2f 秒', s) WHEN s < 3600 THEN printf('%d 分 %.2f 秒', floor(s / 60)::BIGINT, s - 60 * floor(s / 60)) ELSE printf('%d 小时 %d 分 %.2f 秒', floor(s / 3600)::BIGINT, floor(s / 60)::BIGINT % 60, s - 60 * floor(s / 60)) END AS took FROM (SELECT o_orderkey, greatest(floor(o_totalprice) / 4 - 60, 0) AS s FROM orders)"),
}
