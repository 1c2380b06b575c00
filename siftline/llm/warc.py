"""WARC archives: a writer with revisit records, and a salvage reader.

Writing: records of equal payloads (of at least ``min_bytes``) are found by their SHA-1; the one with the smallest key is
a response, the others are revisits that refer to it. Each task writes its rows to archives of bounded size in the
shared folder, one gzip member per record. An archive is written under a hidden name of the attempt and then renamed to the
one that its task's number gives, so a task that is run again, or twice, leaves whole files only, each once, and the folder
is what is read.

Reading: archives are read with Spark's binary file source (any file system that Spark reads). Every record is checked:
gzip's own check sum, version line, header block, Content-Length, block digest. After a failed check the reader looks for the
next valid gzip member or version line, goes on from there, and logs the bytes in between as a gap. Nothing that can
still be read is lost, and no damaged record passes as whole.

Edge cases: null payloads are empty; null keys are written as the key ``null`` and come back null; repeated rows are
records of their own, all responses if their key is the smallest; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_batches, new_path, table

#: Bytes after which a task begins its next archive; an archive is one row when it is read.
ARCHIVE_BYTES = 32 << 20
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/[01]\.\d+\r?\n")
_GZIP = b"\x1f\x8b\x08"

RECORD = "file string, offset long, kind string, record_id string, refers_to string, uri string, payload_digest string, payload_bytes long, payload binary"


def digest(data: bytes) -> str:
    """Upper-case base 32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, uri: str, payload: bytes, payload_digest: str, payload_bytes: int, refers_to: str | None = None) -> bytes:
    """The bytes of a response or revisit record. A revisit repeats the HTTP header, which keeps the payload's length."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}", "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]+", "%20", uri or "")]
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Found:
    offset: int
    headers: dict
    payload: bytes
    http: dict = field(default_factory=dict)


def _headers(lines: list[bytes]) -> dict | None:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return None
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(data: bytes, at: int) -> tuple[Found, int] | str:
    """The record at ``at`` and where it ends, or what is wrong with it."""
    version = _VERSION.match(data, at)
    if not version:
        return "no version line"
    stop = re.compile(rb"\r?\n\r?\n").search(data, version.end() - 1)
    if not stop:
        return "header block does not end"
    if _VERSION.search(data, version.end(), stop.end()):
        return "header is cut off by the next record"
    headers = _headers(data[version.end() : stop.start()].splitlines())
    if headers is None or "warc-type" not in headers or "warc-record-id" not in headers:
        return "malformed header"
    length = headers.get("content-length", "")
    if not length.isdigit():
        return "no content length"
    begin, end = stop.end(), stop.end() + int(length)
    if end > len(data):
        return "record is cut off"
    block = data[begin:end]
    said = headers.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != digest(block):
        return "block digest differs"
    tail = re.compile(rb"\r?\n\r?\n").match(data, end)
    if not tail and end < len(data):
        return "record does not end where its length says"
    head, _, payload = block.partition(b"\r\n\r\n")
    http = _headers(head.split(b"\r\n")[1:]) if head.startswith(b"HTTP/") else None
    said = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "response" and said.startswith("sha1:") and said[5:] != digest(payload if http is not None else block):
        return "payload digest differs"
    return Found(at, headers, payload if http is not None else block, http or {}), (tail.end() if tail else end)


def _member(data: bytes, at: int) -> tuple[bytes, int] | str:
    """A gzip member's content and end, its check sum included."""
    unzip, out = zlib.decompressobj(wbits=31), []
    while not unzip.eof:
        piece = data[at : at + 32_768]  # small pieces: what follows the member is copied only once
        if not piece:
            return "gzip member is cut off"
        try:
            out.append(unzip.decompress(piece))
        except zlib.error as error:
            return f"gzip: {error}"
        at += len(piece)
    return b"".join(out), at - len(unzip.unused_data)


def salvage(data: bytes):
    """Yield ('record', Found) for each valid record of an archive and ('gap', start, end, reason) for lost bytes."""
    at, gap, why = 0, None, ""
    while at < len(data):
        records, problem = [], ""  # problem: why nothing valid begins here
        if data.startswith(_GZIP, at):
            unpacked = _member(data, at)
            if isinstance(unpacked, str):
                problem = unpacked
            else:
                inner, end = unpacked
                for kind, *rest in salvage_plain(inner):
                    if kind == "record":
                        rest[0].offset = at
                        records.append(rest[0])
                    else:
                        problem = f"inside a member: {rest[2]}"
                if records or not problem:
                    yield from ([("gap", gap, at, why)] if gap is not None else [])
                    gap = None
                    yield from (("record", r) for r in records)
                    if problem:
                        yield "gap", at, end, problem
                    at = end
                    continue
                gap, why = (at, problem) if gap is None else (gap, why)
                at = end
                continue
        else:
            parsed = parse_record(data, at)
            if not isinstance(parsed, str):
                yield from ([("gap", gap, at, why)] if gap is not None else [])
                gap = None
                yield "record", parsed[0]
                at = parsed[1]
                continue
            problem = parsed
        gap, why = (at, problem) if gap is None else (gap, why)
        version = _VERSION.search(data, at + 1)
        at = min(x for x in (data.find(_GZIP, at + 1), version.start() if version else -1, len(data)) if x > at or x == len(data))
    if gap is not None:
        yield "gap", gap, len(data), why


def salvage_plain(data: bytes):
    """As :func:`salvage`, for bytes without compression."""
    at, gap, why = 0, None, ""
    while at < len(data):
        parsed = parse_record(data, at)
        if isinstance(parsed, str):
            gap, why = (at, parsed) if gap is None else (gap, why)
            version = _VERSION.search(data, at + 1)
            at = version.start() if version else len(data)
            continue
        if gap is not None:
            yield "gap", gap, at, why
            gap = None
        yield "record", parsed[0]
        at = parsed[1]
    if gap is not None:
        yield "gap", gap, len(data), why


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write rows (key string, uri, payload string, sha1, refers string or null) to archives in ``folder``, and return it.

    Nothing but a count reaches the driver. A task sorts its rows and names its archives by its number, so what it writes
    and where follows from its rows alone, and an attempt that runs again puts the same archives in the same places.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)

    def run(batches):
        import uuid

        from pyarrow import fs
        from pyspark import TaskContext

        system, base = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))  # Hadoop's names of the scheme
        part, attempt, names = TaskContext.get().partitionId(), uuid.uuid4().hex, []
        stream, size = None, 0

        def close():
            if stream is not None:
                stream.close()
                made, name = f"{base}/.{attempt}-{len(names):05d}", f"{base}/{part:05d}-{len(names):05d}.warc.gz"
                try:
                    system.move(made, name)
                except OSError:
                    # some file systems don't move over a file: then an earlier attempt's equal archive stays
                    if system.get_file_info(name).type == fs.FileType.NotFound:
                        raise
                    system.delete_file(made)
                names.append(name)

        for batch in batches:
            for key, uri, payload, sha1, refers in zip(*[batch.column(i) for i in range(5)]):
                body = (payload.as_py() or "").encode()
                own = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                refers = refers.as_py()
                data = record("revisit" if refers else "response", f"urn:key:{key.as_py()}", uri.as_py(), b"" if refers else body, own, len(body), f"urn:key:{refers}" if refers else None)
                if stream is None:
                    stream, size = system.open_output_stream(f"{base}/.{attempt}-{len(names):05d}"), 0
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(data) + packer.flush()
                stream.write(data)
                size += len(data)
                if size >= archive_bytes:
                    close()
                    stream = None
        close()
        yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], names=["n"])

    rows.sortWithinPartitions("sha1", "key", "uri", "refers").mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return folder


def read_archives(spark: SparkSession, paths: str | list[str], payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of archives, or of folders of them: see ``RECORD``; gaps have file, start, stop and reason. An archive is one task's row."""
    raw = spark.read.format("binaryFile").load(paths).select("path", "content")
    schema = f"{RECORD}, gap_start long, gap_stop long, gap_reason string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for path, content in zip(*batch.columns):
                rows, size = [], 0
                for kind, *rest in salvage(content.as_py()):
                    if kind == "gap":
                        rows.append([path.as_py(), *[None] * 8, *rest])
                    else:
                        h, http = rest[0].headers, rest[0].http
                        length = http.get("content-length", "")
                        payload = rest[0].payload
                        rows.append([path.as_py(), rest[0].offset, h["warc-type"], h["warc-record-id"].strip("<>"), h.get("warc-refers-to", "").strip("<>") or None, h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(length) if length.isdigit() else len(payload), payload if payloads else None, None, None, None])
                        size += len(payload)
                    if size > 8 << 20:
                        yield frame(rows)
                        rows, size = [], 0
                yield frame(rows)

    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]

    def frame(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)

    found = raw.mapInArrow(run, schema)
    return found.filter("gap_start IS NULL").drop("gap_start", "gap_stop", "gap_reason"), found.filter("gap_start IS NOT NULL").select("file", F.col("gap_start").alias("start"), F.col("gap_stop").alias("stop"), F.col("gap_reason").alias("reason"))


def with_revisits(df: DataFrame, key: str, uri: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """(key string, uri, payload, sha1, refers): refers is the key of the response that a revisit stands for.

    The smallest key of each payload is found by an aggregate that combines before its shuffle. Rows that repeat that key
    are all responses.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = df.select(F.col(key).alias("k"), F.col(uri).alias("uri"), body.alias("payload"), F.sha1(body.cast("binary")).alias("sha1"))
    low = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(F.min(F.struct(F.col("k").isNull().alias("none"), "k")).alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha1", F.col("low.k").alias("low"))
    rows = rows.join(low, "sha1", "left")
    refers = F.when(F.col("low").isNotNull() & ~F.col("low").eqNullSafe(F.col("k")), F.col("low").cast("string"))
    return rows.select(F.coalesce(F.col("k").cast("string"), F.lit("null")).alias("key"), "uri", "payload", "sha1", refers.alias("refers"))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    paths = write_archives(with_revisits(pages, "page_id", "url", "html"), new_path(spark, "warc"))
    records, _ = read_archives(spark, paths, payloads=False)
    page = lambda c: F.expr(f"try_cast(substring({c}, {len('urn:key:') + 1}) AS BIGINT)")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), page("refers_to").alias("refers_to"))


def oracle() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    # base 32 from the hexadecimal digits: every 5 of them are 4 letters
    part = lambda k: f"'{letters}'[((('0x' || substr(h, {{i}} * 5 + 1, 5))::BIGINT >> {15 - 5 * k}) & 31) + 1]"
    four = " || ".join(part(k) for k in range(4))
    b32 = " || ".join(four.replace("{i}", str(i)) for i in range(8))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, min(page_id) AS low FROM p GROUP BY h)
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes, {b32} AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> low THEN low END AS refers_to
FROM p JOIN m USING (h)"""
