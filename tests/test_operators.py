"""Golden cases and brute-force comparisons for what SQL cannot express."""

import json

import pytest
from pyspark.sql import functions as F

from siftline.functions import files
from siftline.functions import html_text as h
from siftline.functions import python_text as p
from siftline.functions import scalars as s
from siftline.operators import dedup, records
from siftline.operators import lines as w
from siftline.plans import registry, stages
from siftline.sources import jsonl, sinks
from siftline.streaming import callbacks


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("接种 率 为 8 5 .2 % ,较 去年上升;", "接种率为8 5.2%，较去年上升；"),
        ("会议于2 024年3 月 1 5日召开( 第2次) .", "会议于2024年3月15日召开（第2次）."),
        ("Vitamin C / D - 3 levels, see Table 2", "Vitamin C/D-3 levels, see Table 2"),
        ("打印本页\n正文", "\n正文"),
        ("甲，\n乙", "甲，乙"),
    ],
)
def test_text_rules(spark, given, want):
    assert one(spark, records.replace_all(F.col("t")), t=given) == want


def test_greedy_dedup_equals_the_sequential_rule(spark):
    import random

    random.seed(3)
    rows = [(i, random.choice(["", None, *[f"u{k}" for k in range(25)]]), random.choice([None, "", *[f"b{k}" for k in range(40)]])) for i in range(300)]
    urls, bodies, want = set(), set(), {}
    for i, u, b in rows:
        want[i] = "duplicate_url" if u and u in urls else "duplicate_body" if (b or "") in bodies else None
        if want[i] is None:
            bodies.add(b or "")
            if u:
                urls.add(u)
    got = {r.i: r.reason for r in dedup.greedy_dedup(spark.createDataFrame(rows, "i long, u string, b string"), "i", "u", "b").collect()}
    assert got == want
    chain = [(1, "u1", "b1"), (2, "u2", "b1"), (3, "u2", "b3")]
    got = dedup.greedy_dedup(spark.createDataFrame(chain, "i long, u string, b string"), "i", "u", "b").collect()
    assert {r.i: r.reason for r in got} == {1: None, 2: "duplicate_body", 3: None}


def test_document_cleaning(spark):
    cut = one(spark, w.truncate_head(F.col("t")), t="关于通知 发布时间：2024-03-05 10:20 来源：某委 分享到： 正文开始了\n后文")
    assert cut == "正文开始了\n后文"
    assert one(spark, w.truncate_head(F.col("t")), t="首页\n联系我们\n真正的正文在这里，没有导航词\n第二行") == "联系我们\n真正的正文在这里，没有导航词\n第二行"[5:]
    text = "正文" * 60 + "\n第二段\n版权所有 某单位\n邮编 100000"
    assert one(spark, w.truncate_tail(F.col("t")), t=text) == "正文" * 60 + "\n第二段"
    assert one(spark, w.truncate_tail(F.col("t")), t="版权所有 " + "正文" * 60) == "版权所有 " + "正文" * 60


def test_deterministic_cleaning(spark):
    text = "标题\n标题\n甲\n甲\n标题\n![x](data:image/png;base64,AAAA)\n\n\n\n\n乙　"
    assert one(spark, w.deterministic_clean(F.col("t"), F.lit("标题")), t=text) == "标题\n甲\n\n\n乙" or one(spark, w.deterministic_clean(F.col("t"), F.lit("标题")), t=text) == "标题\n甲\n\n乙"


def test_protection_comes_back(spark):
    text = "# 标题\n|a|b|c|\n|1|2|3|\n普通\n第 5 号\n" + "长" * 60
    df = spark.createDataFrame([(text,)], "t string").withColumn("p", w.protect_lines(F.col("t"), F.lit(""), F.lit("k")))
    row = df.select(F.transform("p", lambda x: x["kind"]).alias("k"), w.restore_lines(F.transform("p", lambda x: x["shown"]), F.col("p")).alias("back"), w.restore_lines(F.slice(F.transform("p", lambda x: x["shown"]), 2, 9), F.col("p")).alias("lost")).first()
    assert row.k == ["heading", "table", "table", None, "document_number", "long_line"] and row.back == text and row.lost is None


def test_noise_deletion_is_all_or_nothing():
    text = "首页\n正文一\n正文二\n首页二\n" + "字" * 100
    run = lambda segments, **k: p._delete(text, segments, {"navigation"}, 0.9, k.get("ratio", 0.3), 50)
    good = {"noise_type": "navigation", "start_line": 1, "exact_lines": ["首页"], "confidence": 0.95}
    assert run([good])["status"] == "cleaned" and run([good])["removed_lines"] == 1
    assert run([good, {**good, "confidence": 0.1}])["issues"] == ["segment_1:confidence_below_threshold"]
    assert run([{**good, "exact_lines": ["| a | b |"]}])["issues"] == ["segment_0:table_structure_protected"]
    assert run([{**good, "exact_lines": ["nowhere"]}])["issues"] == ["segment_0:exact_block_match_count:0"]
    assert run([good], ratio=0.001)["issues"][0].startswith("removed_ratio_exceeds_limit") and run([])["status"] == "no_noise_reported"


def test_html_trees():
    root = h.parse("<body><div class='x content'>" + "long text " * 20 + "<p>a<p>b</div><nav>menu</nav><table><tr><td rowspan=2>1<td colspan=2>2<tr><td>3<td>4</table></body>")
    node, name, confidence = h.choose_article(root, ("div.content",))
    assert name == "body" and confidence < 1
    table = next(n for n in root.walk() if n.name == "table")
    assert h.grid(table) == [["1", "2", "2"], ["1", "3", "4"]]
    assert "| 1 | 2 | 2 |\n| --- | --- | --- |\n| 1 | 3 | 4 |" in h.markdown(root)
    assert "menu" not in root.text(skip=h.CHROME) and h.parse(None).text() == ""
    assert h.markdown(h.parse("<h2>T</h2><p>x<sup>1</sup> <a href='u'>l</a></p>")) == "## T\n\nx[1] [l](u)"
    assert h.parse("<div>" * 5000 + "deep").text() == "deep"


def test_jsonl_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('﻿{"doc_id": 1}\n\n{bad\n[1]\n{"doc_id": 2}\n', encoding="utf-8")
    rows = {r.line_no: r for r in jsonl.read_jsonl(spark, str(tmp_path / "in"), "doc_id long").collect()}
    assert rows[1].record.doc_id == 1 and rows[5].record.doc_id == 2 and rows[3].error and rows[4].error and 2 not in rows
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "in"), "doc_id long", mode="failfast").collect()
    df = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", ["z"])], "id long, route string, flags array<string>")
    sinks.write_routes(df, str(tmp_path / "routes"))
    sinks.write_quarantine(df, str(tmp_path / "q"), "flags", ["x", "y"])
    assert sorted(x.name for x in (tmp_path / "q").iterdir() if x.is_dir()) == ["flag=x", "flag=y"]
    with pytest.raises(Exception):
        sinks.write_routes(df, str(tmp_path / "routes"))
    assert sinks.export_fields(df, {"n": "id", "m": "none"}, "null").first().m is None
    with pytest.raises(ValueError):
        sinks.export_fields(df, {"m": "none"})
    (tmp_path / "d" / "one").mkdir(parents=True)
    (tmp_path / "d" / "one" / "metadata.json").write_text("{}")
    (tmp_path / "d" / "one" / "raw.md").write_text("no")
    (row,) = jsonl.sidecars(spark, str(tmp_path / "d")).collect()
    assert row.metadata == "{}" and row.quality is None


def test_stream_equals_batch(spark, tmp_path):
    data = [(1, 1, False), (1, 2, True), (1, 3, False), (2, 1, False), (3, 5, True), (2, 9, False)]
    schema = "k long, seq long, ok boolean"
    for i, part in enumerate((data[:3], data[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in"))
    query = callbacks.callback_stream(stream, "k", "seq", F.col("ok")).writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    last = {r.request_id: tuple(r) for r in spark.sql("SELECT * FROM states ORDER BY n_events").collect()}
    batch = {r.request_id: tuple(r) for r in callbacks.latest_state(spark.createDataFrame(data, schema), "k", "seq", F.col("ok")).collect()}
    assert last == batch and batch[1] == (1, 3, 2, True, 3, 1)


def test_registry_and_stages(spark):
    df = spark.createDataFrame([(1, "x" * 60), (2, "x" * 60), (3, "y" * 120)], "doc_id long, text string")
    run = registry.build(["text_length_filter", {"document_deduplicator": {}}], {"text_length_filter": {"min_len": 50}})
    assert sorted(r.doc_id for r in run(df).collect()) == [1, 3]
    with pytest.raises(ValueError):
        registry.build(["no_such_operator"])
    with pytest.raises(ValueError):
        registry.build(["text_length_filter"], {"other": {}})
    rounds = stages.retry_rounds(df.select("doc_id"), lambda x: x.withColumn("success", F.col("doc_id") == 1), 2)
    assert sorted((r.doc_id, r.round, r.success) for r in rounds.collect()) == [(1, 0, True), (2, 2, False), (3, 2, False)]
    pages = spark.createDataFrame([(1, "t", "http://a/x", "", "<body><p>" + "text " * 40 + "</p></body>"), (2, "t", "http://a/y", "", "<body><p>" + "text " * 40 + "</p></body>"), (3, "t", "", None, "")], "doc_id long, title string, url string, text string, html string")
    kept, gone = stages.article_pipeline(pages, ["首页"])
    assert [r.id for r in kept.collect()] == ["1"] and [r.doc_id for r in gone.collect()] == [2]


def test_scalars(spark):
    assert one(spark, s.publish_date(F.col("a"), F.col("b")), a="x_20240102_1", b="") == "2024-01-02"
    assert one(spark, s.parse_date(F.col("a")), a="2024年3月5日") == "2024-03-05" and one(spark, s.parse_date(F.col("a")), a="soon") == "soon"
    assert one(spark, p.normalize_title(F.col("a")), a="　Ａ b，C。") == "abc"
    assert json.loads(one(spark, F.to_json(p.sensitive_hits(F.col("a"), s.SENSITIVE)), a="邮箱 a@b.cn"))[0]["type"] == "email"
    assert one(spark, p.drop_repeated_sentences(F.col("a")), a="A long sentence with many words. Short. A long sentence with many words. Short.") == "A long sentence with many words. Short. Short."
    with pytest.raises(Exception):
        one(spark, s.safe_request_id(F.col("a")), a=" ")


def test_files(spark):
    import io
    import zipfile

    def office(folder, damage=False):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("[Content_Types].xml", "x")
            z.writestr(f"{folder}/document.xml", "y" * 500)
        data = bytearray(out.getvalue())
        if damage:
            data[data.find(b"yyyy") + 5] ^= 1
        return bytes(data)

    rows = [
        (b"", ".pdf", "empty"), (b"%PDF-1.4 x %%EOF", ".pdf", "ok"), (b"%PDF-1.4 x", ".pdf", "truncated"), (b"%PDF-1.4 /Encrypt %%EOF", ".pdf", "encrypted"), (b"<HTML>", ".pdf", "html_disguised"), (b"x", ".pdf", "magic_mismatch"),
        (office("word"), ".docx", "ok"), (office("xl"), ".docx", "wrong_structure"), (office("word", True), ".docx", "crc_error"), (b"PK\x03\x04rest", ".docx", "bad_zip"), (bytes.fromhex("D0CF11E0A1B11AE1") + b"x", ".docx", "encrypted"),
        (bytes.fromhex("D0CF11E0A1B11AE1"), ".doc", "manual_review"), (b"x", ".doc", "magic_mismatch"), (b" \n", ".txt", "blank_text"), (b"t", ".txt", "ok"), (b"y" * 50, ".bin", "too_large"),
    ]
    df = spark.createDataFrame([(i, bytearray(b), e) for i, (b, e, _) in enumerate(rows)], "i int, b binary, e string")
    got = df.select("i", files.preflight(F.col("b"), F.col("e"), 10_000).alias("s")).orderBy("i").collect()
    assert [r.s for r in got][:-1] == [w for *_, w in rows][:-1]
    assert df.filter("i = 15").select(files.preflight(F.col("b"), F.col("e"), 10)).first()[0] == "too_large"
    assert files.true_extension_of(office("ppt")) == ".pptx" and files.true_extension_of(b"\x00\xff") == ".unknown" and files.true_extension_of("文本\n".encode()) == ".txt"


def test_file_listings(spark, tmp_path):
    for name in ("c_20240101_000000.jsonl", "c_20240301_120000.jsonl", "c_20240201_000000.jsonl", "other.txt"):
        (tmp_path / name).write_text("{}")
    assert jsonl.latest_file(spark, str(tmp_path)).endswith("c_20240301_120000.jsonl")
    found = jsonl.attachments(spark, str(tmp_path), (".txt",)).collect()
    assert [r.size for r in found] == [2]
    paths = spark.createDataFrame([(1, "x/a.html"), (2, "none.html")], "id long, raw string")
    listing = spark.createDataFrame([("/r/a.html",), ("/q/x/a.html",)], "path string")
    assert [(r.id, r.path) for r in jsonl.resolve(paths, listing, ["/r", "/q"]).collect()] == [(1, "/q/x/a.html")]
