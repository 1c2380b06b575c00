"""JSON lines and sidecar folders as DataFrames, with file and line number, and nothing lost: bad lines are rows too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(file, line_no, line): files are read whole, so that line numbers are real; a byte order mark is dropped."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    lines = F.split(F.regexp_replace("value", "^﻿|\r?\n$", ""), "\r?\n", -1)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.posexplode(lines).alias("i", "line")).select("file", (F.col("i") + 1).alias("line_no"), "line")


def parse_lines(lines: DataFrame, schema: str | T.StructType, blank: str = "skip") -> DataFrame:
    """(file, line_no, record, error, raw): error is null for a record; ``blank`` lines are skipped or errors."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    if blank == "skip":
        lines = lines.filter(F.trim("line") != "")
    parsed = lines.withColumn("r", F.from_json("line", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r._bad").isNotNull() | F.col("r").isNull() | ~F.ltrim("line").startswith("{")
    error = F.when(F.trim("line") == "", "blank line").when(bad, "not a JSON object")
    record = F.when(~bad, F.struct(*[F.col(f"r.{f.name}") for f in schema.fields]))
    return parsed.select("file", "line_no", record.alias("record"), error.alias("error"), F.when(bad, F.left("line", F.lit(1000))).alias("raw"))


def read_jsonl(spark: SparkSession, path: str, schema: str, mode: str = "permissive", blank: str = "skip") -> DataFrame:
    """``mode`` failfast raises on the first bad line when the plan runs; permissive keeps it with its error."""
    rows = parse_lines(read_lines(spark, path), schema, blank)
    if mode == "failfast":
        wrong = F.raise_error(F.concat(F.lit("bad line in "), "file", F.lit(":"), F.col("line_no").cast("string")))
        rows = rows.withColumn("record", F.when(F.col("error").isNull(), F.col("record")).otherwise(wrong.cast(rows.schema["record"].dataType)))
    return rows


def validate(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("bad"))


def latest_file(spark: SparkSession, folder: str, pattern: str = r"[^/]*_\d{8}_\d{6}\.jsonl$") -> str | None:
    """The greatest name of the dated files of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path").filter(F.col("path").rlike(pattern))
    return files.agg(F.max_by("path", F.regexp_extract("path", r"(\d{8}_\d{6})", 1))).first()[0]


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """(dir, metadata, quality, content): one row per folder with a metadata.json; the others are optional."""
    raw = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("p"), "value")
    named = raw.select(F.regexp_extract("p", r"^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("p", r"([^/]*)$", 1).alias("name"), "value")
    known = named.filter(F.col("name").isin("metadata.json", "quality.json", "content.md"))
    pick = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    return known.groupBy("dir").agg(pick("metadata.json").alias("metadata"), pick("quality.json").alias("quality"), pick("content.md").alias("content")).filter("metadata IS NOT NULL")


def attachments(spark: SparkSession, folder: str, extensions: tuple[str, ...] = (), recursive: bool = True) -> DataFrame:
    """(path, extension, size, modified, sha256) of files, without lock files; sorted by name without case."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    rows = raw.select("path", F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("extension"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    rows = rows.filter(~F.col("path").rlike(r"/~\$[^/]*$"))
    return (rows.filter(F.col("extension").isin(*extensions)) if extensions else rows).orderBy(F.lower("path"))


def resolve(paths: DataFrame, listing: DataFrame, roots: list[str]) -> DataFrame:
    """(id, path): the first candidate of each raw path that is listed. ``paths``: id, raw; ``listing``: path."""
    tries = F.array(F.col("raw"), *[F.concat(F.lit(r.rstrip("/") + "/"), "raw") for r in roots], *[F.concat(F.lit(r.rstrip("/") + "/"), F.element_at(F.split("raw", "/"), -1)) for r in roots])
    rows = paths.select("id", F.posexplode(tries).alias("rank", "path"))
    return rows.join(listing.select("path").distinct(), "path").groupBy("id").agg(F.min_by("path", "rank").alias("path"))


def expand(spark: SparkSession, values: list[str]) -> list[str]:
    """Files that paths, folders (their *.jsonl) and globs name, in order and each once. Driver-side: names only."""
    jvm, out = spark.sparkContext._jvm, []
    for value in values:
        path = jvm.org.apache.hadoop.fs.Path(value)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(path) and system.getFileStatus(path).isDirectory():
            path = jvm.org.apache.hadoop.fs.Path(path, "*.jsonl")
        found = sorted(x.getPath().toString() for x in system.globStatus(path) or [])
        out += found if found or "*" in value else [value]
    return list(dict.fromkeys(out))


def asset_map(spark: SparkSession, path: str) -> DataFrame:
    """A manual asset map from CSV or JSON, with all columns as strings and nulls empty."""
    df = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.json(path, multiLine=True, primitivesAsString=True)
    return df.na.fill("")
