import json
import random
import re

import pytest
from pyspark.sql import functions as F

from siftline.functions import terms
from siftline.operators import lines as w
from siftline.operators import workflow as f
from siftline.sources import jsonl, sinks


def brute_rules(lines, source, domain, rules):
    """Line by line, as the docstring says."""
    total, named = max(len(lines) - 1, 1), {}

    def inside(rule, i):
        low, high = rule.get("start", 0.0), rule.get("end", 1.0)
        low = 0.65 if rule.get("region") == "footer" and low == 0 else low
        high = 0.35 if rule.get("region") == "header" and high == 1 else high
        return low <= i / total <= high

    scoped = [r for r in rules if r.get("enabled", True) and re.fullmatch(r.get("source", "*").replace("*", ".*"), source) and re.fullmatch(r.get("domain", "*").replace("*", ".*"), domain)]
    for rule in scoped:
        i = 0
        while "block" in rule and i < len(lines):
            if re.fullmatch(rule["block"][0], lines[i].strip()) and inside(rule, i):
                end = next((k for k in range(i + 1, len(lines)) if re.fullmatch(rule["block"][1], lines[k].strip())), None)
                if end is None:
                    break
                named.update({k: rule for k in range(i, end + 1)})
                i = end
            i += 1
    hits = []
    for i, line in enumerate(lines):
        link = bool(re.search(r"https?://|\]\(", line))
        found = named.get(i)
        if found and found.get("keep_links", True) and link:
            found = None
        for rule in scoped:
            if found is None and "block" not in rule and inside(rule, i) and not (rule.get("keep_links", True) and link):
                if line.strip() in rule["lines"] if "lines" in rule else re.fullmatch(rule["pattern"], line.strip()):
                    found = rule
        if found:
            hits.append((found["id"], i, line))
    gone = {i for _, i, _ in hits}
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), hits


RULES = [
    {"id": "b1", "block": ("begin", "end"), "source": "s*"}, {"id": "b2", "block": ("begin", "stop"), "domain": "x.*", "keep_links": False},
    {"id": "top", "lines": ["nav", "end"], "region": "header"}, {"id": "foot", "pattern": "n.*", "region": "footer"}, {"id": "mid", "pattern": "stop", "start": 0.2, "end": 0.8},
    {"id": "never", "pattern": ".*", "risk": "high", "enabled": False},
]


def test_site_rules_match_brute_force(spark):
    random.seed(3)
    words = ["nav", "text", "begin", "end", "stop", " end ", "see http://a/b", "note", ""]
    rows = [(i, "\n".join(random.choices(words, k=random.randint(1, 14))), random.choice(["site", "other"]), random.choice(["x.cn", "y"])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, domain string")
    out = {r.doc_id: r.r for r in df.select("doc_id", f.site_rules(F.col("text"), F.col("source"), F.col("domain"), RULES).alias("r")).collect()}
    for i, text, source, domain in rows:
        assert (out[i].text, [tuple(h) for h in out[i].hits]) == brute_rules(text.split("\n"), source, domain, RULES)
    for wrong in ([{"id": "a", "pattern": "x", "risk": "high"}], [{"id": "a", "pattern": "x"}, {"id": "a", "pattern": "y"}]):
        with pytest.raises(ValueError):
            f.site_rules(F.col("text"), F.col("source"), F.col("domain"), wrong)


def test_slots_are_taken_one_by_one(spark):
    random.seed(4)
    tasks = [(i, random.randrange(6), random.choice(["pending", "pending", "active", "done"])) for i in range(200)]
    df = spark.createDataFrame([(i, b, b % 2, s) for i, b, s in tasks], "task long, batch int, pool int, status string")
    got = {r.task for r in f.admit(df, 12, 30).filter("admitted").collect()}
    batch, pool, want = [0] * 6, [0] * 2, set()
    for _, b, s in tasks:
        batch[b] += s == "active"
        pool[b % 2] += s == "active"
    for i, b, s in tasks:
        if s == "pending" and batch[b] < 12 and pool[b % 2] < 30:
            want.add(i)
            batch[b] += 1
            pool[b % 2] += 1
    assert got == want and want


def test_json_fields_by_record(spark):
    rows = [(1, '{"a": {"b": 1}, "c": null}'), (2, '{"a": {}, "c": "x"}'), (3, '{"c": 5}'), (4, None)]
    df = spark.createDataFrame(rows, "i int, j string")
    fields = {"b": "a.b", "c": "c"}
    assert [(r.i, r.b, r.c) for r in sinks.export_json_fields(df, "j", fields, "null", ["i"]).collect()] == [(1, "1", None), (2, None, "x"), (3, None, "5"), (4, None, None)]
    assert [r.i for r in sinks.export_json_fields(df, "j", fields, "skip", ["i"]).collect()] == [1]
    with pytest.raises(Exception, match="missing field: a.b"):
        sinks.export_json_fields(df, "j", fields, "error").collect()
    with pytest.raises(ValueError):
        sinks.export_json_fields(df, "j", [("x", "a.b"), ("x", "c")])
    assert {r.path: r.n for r in sinks.missing_counts(df, "j", ["a.b", "c"]).collect()} == {"a.b": 3, "c": 1}


def test_paths_maps_and_reports(spark, tmp_path):
    for name in ("b.jsonl", "a.jsonl", "c.txt"):
        (tmp_path / name).write_text("{}\n")
    (tmp_path / "map.csv").write_text("doc_id,asset_name\n1,\n2,x\n")
    (tmp_path / "map.json").write_text('[{"doc_id": 1, "asset_name": null}]')
    found = jsonl.expand(spark, [f"file://{tmp_path}/b.jsonl", f"file://{tmp_path}", f"file://{tmp_path}/*.txt", f"file://{tmp_path}/none*"])
    assert [x.rpartition("/")[2] for x in found] == ["b.jsonl", "a.jsonl", "c.txt"]
    assert [tuple(r) for r in jsonl.asset_map(spark, f"{tmp_path}/map.csv").collect()] == [("1", ""), ("2", "x")]
    assert jsonl.asset_map(spark, f"{tmp_path}/map.json").first().asDict() == {"doc_id": "1", "asset_name": ""}
    text, table = sinks.report(spark.range(3).agg(F.count(F.lit(1)).alias("n")), "Count")
    assert json.loads(text) == {"n": 3} and "| n | 3 |" in table


def test_durations(spark):
    df = spark.createDataFrame([(-1.0,), (4.0,), (61.5,), (7325.25,)], "s double")
    assert [r.t for r in df.select(f.duration(F.col("s")).alias("t")).collect()] == ["0.00 秒", "4.00 秒", "1 分 1.50 秒", "2 小时 2 分 5.25 秒"]


def test_terms_keep_their_private_use_characters():
    private = lambda texts: sorted({f"{ord(ch):04x}" for x in texts for ch in x if 0xE000 <= ord(ch) <= 0xF8FF})
    assert private(terms.HARD_LITERALS) == ["e0a1", "e0a4", "e104", "e1bb", "e21b"]
    assert private(terms.FOOTER_TERMS) == private([w.TAIL_START]) == ["e100", "e1bb", "e21b", "e50d"]
