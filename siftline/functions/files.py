"""Checks on file contents: preflight before parsing, and the true type behind an unknown extension."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BYTES = 100 << 20
#: First bytes of file types, and the folder that tells Office documents apart.
MAGIC = [(b"%PDF-", ".pdf"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", ".ole"), (b"\x89PNG\r\n\x1a\n", ".png"), (b"\xff\xd8\xff", ".jpg"), (b"GIF8", ".gif"), (b"{\\rtf", ".rtf"), (b"Rar!", ".rar"), (b"7z\xbc\xaf\x27\x1c", ".7z")]
OFFICE = {"word/": ".docx", "xl/": ".xlsx", "ppt/": ".pptx"}
_OLE = "D0CF11E0A1B11AE1"


def office_type(content: bytes) -> str:
    """.docx, .xlsx or .pptx of a whole archive, .zip of another whole one, or why it isn't whole."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = archive.namelist()
            if any(i.flag_bits & 1 for i in archive.infolist()):
                return "encrypted"
            if archive.testzip():
                return "crc_error"
    except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError, EOFError):
        return "bad_zip"
    if "[Content_Types].xml" in names:
        return next((e for folder, e in OFFICE.items() if any(n.startswith(folder) for n in names)), ".zip")
    return ".zip"


def true_extension_of(content: bytes | None) -> str:
    content = content or b""
    for first, extension in MAGIC:
        if content.startswith(first):
            return extension
    if content.startswith(b"PK\x03\x04"):
        found = office_type(content)
        return found if found.startswith(".") else ".zip"
    head = content[:1024].lstrip().lower()
    if head.startswith((b"<!doctype html", b"<html")):
        return ".html"
    try:
        return ".txt" if content.strip() and content.decode("utf-8").isprintable() or b"\n" in content and content.decode("utf-8") else ".unknown"
    except UnicodeDecodeError:
        return ".unknown"


def _of_bytes(function):
    @F.arrow_udf(T.StringType())
    def run(values: pa.Array) -> pa.Array:
        return pa.array([function(x.as_py() or b"") for x in values], pa.string())

    return run


def true_extension(content: Column) -> Column:
    return _of_bytes(true_extension_of)(content)


def preflight(content: Column, extension: Column, max_bytes: int = MAX_BYTES) -> Column:
    """ok, or why a file isn't sent to a parser. Only archives are opened in Python; everything else is native."""
    size, first = F.octet_length(content), F.hex(F.substring(content, 1, 8))
    head = F.lower(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"))
    tail = F.decode(F.substring(content, F.greatest(size - 2047, F.lit(1)), F.lit(2048)), "ISO-8859-1")
    html = head.rlike(r"^\s*(?:<!doctype html|<html)") & ~extension.isin(".html", ".htm")
    pdf = F.when(~first.startswith("255044462D"), "magic_mismatch").when(F.decode(content, "ISO-8859-1").contains("/Encrypt"), "encrypted").when(~tail.contains("%%EOF"), "truncated").otherwise("ok")
    kind = _of_bytes(office_type)(F.when(extension.isin(*OFFICE.values()) & first.startswith("504B0304"), content))
    office = F.when(first == _OLE, "encrypted").when(~first.startswith("504B0304"), "magic_mismatch").when(kind == extension, "ok").when(kind.startswith("."), "wrong_structure").otherwise(kind)
    legacy = F.when(first == _OLE, "manual_review").otherwise("magic_mismatch")
    blank = F.when(F.trim(F.regexp_replace(F.decode(content, "ISO-8859-1"), r"\s", "")) == "", "blank_text").otherwise("ok")
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "empty").when(size > max_bytes, "too_large").when(html, "html_disguised")
        .when(extension == ".pdf", pdf).when(extension.isin(*OFFICE.values()), office).when(extension.isin(".doc", ".xls", ".ppt"), legacy).when(extension.isin(".txt", ".md", ".csv"), blank).otherwise("ok")
    )


def repaired_name(path: Column, found: Column) -> Column:
    """The path with its suffix replaced by the true one, where that is known and differs."""
    now = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return F.when(found.isin(".unknown", ".ole") | (now == found), path).otherwise(F.concat(F.regexp_replace(path, r"\.[^./]+$", ""), found))
