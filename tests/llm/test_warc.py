import gzip

from siftline.llm import warc as w
from siftline.llm._common import new_path


def records(n=5):
    out = []
    for i in range(n):
        body = b"page %d " % i * 40
        out.append(w.record("response", f"urn:key:{i}", "http://x/", body, w.digest(body), len(body)))
    return out


def seen(data):
    return [x[1].headers["warc-record-id"][-2] if x[0] == "record" else "gap" for x in w.salvage(data)]


def test_salvage_compressed():
    z = [gzip.compress(r) for r in records()]
    assert seen(b"".join(z)) == list("01234")
    broken = bytearray(b"".join(z))
    broken[len(z[0]) + 30] ^= 255
    gaps = [x for x in w.salvage(bytes(broken)) if x[0] == "gap"]
    assert seen(bytes(broken)) == ["0", "gap", "2", "3", "4"] and gaps[0][1:3] == (len(z[0]), len(z[0]) + len(z[1]))
    assert seen(b"".join(z)[:-20]) == ["0", "1", "2", "3", "gap"]
    assert seen(z[0] + b"garbage" + z[1]) == ["0", "gap", "1"]


def test_salvage_plain():
    r = records()
    assert seen(b"junk" + b"".join(r) + b"tail") == ["gap", *"01234", "gap"]
    cut = b"".join(r[:2]) + r[2][:200] + b"".join(r[3:])
    assert seen(cut) == ["0", "1", "gap", "3", "4"]
    short = b"".join(r[:2]) + r[2][:-80] + b"".join(r[3:])
    assert seen(short)[-2:] == ["3", "4"] and "gap" in seen(short)
    flipped = bytearray(b"".join(r))
    flipped[len(r[0]) + len(r[1]) - 20] ^= 1
    assert seen(bytes(flipped)) == ["0", "gap", "2", "3", "4"]
    assert seen(b"") == []


def test_round_trip_with_revisits(spark):
    rows = [(1, "http://a/\nb", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", "other"), (5, "u", "x" * 200_000), (9, "u", "WARC/1.0\r\nfake")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = w.write_archives(w.with_revisits(df, "page_id", "url", "html"), new_path(spark, "warc"), archive_bytes=500)
    found, gaps = w.read_archives(spark, paths)
    assert gaps.count() == 0
    by = {r.record_id: r for r in found.collect()}
    assert len(by) == 7 and by["urn:key:2"].kind == "revisit" and by["urn:key:2"].refers_to == "urn:key:1"
    assert by["urn:key:4"].refers_to == "urn:key:3" and by["urn:key:null"].payload == b"other"
    assert by["urn:key:2"].payload_bytes == len("<p>é</p>".encode()) and by["urn:key:2"].payload_digest == w.digest("<p>é</p>".encode())
    assert bytes(by["urn:key:9"].payload).decode() == "WARC/1.0\r\nfake"


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    paths = w.write_archives(w.with_revisits(df, "page_id", "url", "html"), new_path(spark, "warc"))
    assert w.read_archives(spark, paths)[0].collect() == []


def test_clashing_names_ties_and_a_second_attempt(spark):
    rows = [(1, "u", "same", "x", 3)] * 3 + [(2, "u", "same", "y", 4), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string, key int")
    out = w.with_revisits(df, "page_id", "url", "html")
    folder = new_path(spark, "warc")
    for _ in range(2):  # written again: the same files
        assert w.write_archives(out, folder) == folder
    found = w.read_archives(spark, folder)[0].collect()
    assert sorted((r.record_id, r.kind) for r in found) == [("urn:key:1", "response")] * 3 + [("urn:key:2", "revisit"), ("urn:key:null", "response")]
