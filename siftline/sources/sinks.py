"""Sinks: Spark writers with the guards that a corpus needs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """JSON lines; refuses to overwrite; Spark's commit protocol makes it all or nothing."""
    df.write.mode("errorifexists").option("ignoreNullFields", not keep_nulls).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def write_routes(df: DataFrame, path: str, route: str = "route") -> None:
    """One folder per route, in one pass."""
    df.write.mode("errorifexists").partitionBy(route).json(path)


def write_quarantine(df: DataFrame, path: str, flags: str, allowed: list[str]) -> None:
    """Each row once under every allowed flag that it carries."""
    rows = df.withColumn("flag", F.explode(F.array_intersect(F.col(flags), F.array(*map(F.lit, allowed)))))
    rows.write.mode("errorifexists").partitionBy("flag").json(path)


def export_fields(df: DataFrame, fields: dict[str, str], missing: str = "error") -> DataFrame:
    """Project dotted paths under new names; a path that the schema lacks is an error or a null, or, with skip, so
    is missing in every record. Where records differ in their fields, see :func:`export_json_fields`."""
    if missing not in ("error", "null", "skip"):
        raise ValueError(f"unknown policy: {missing}")
    have = set()

    def walk(schema, path=""):
        for f in schema.fields:
            have.add(path + f.name)
            if hasattr(f.dataType, "fields"):
                walk(f.dataType, f"{path}{f.name}.")

    walk(df.schema)
    absent = [p for p in fields.values() if p not in have]
    if absent and missing == "error":
        raise ValueError(f"no such fields: {absent}")
    if absent and missing == "skip":
        df = df.limit(0)
    return df.select(*[(F.col(p) if p in have else F.lit(None).cast("string")).alias(name) for name, p in fields.items()])


def json_presence(column: str, path: str) -> Column:
    """Whether the JSON object in ``column`` has a field at the dotted path; a null value is there, an absent key isn't."""
    parent, _, name = path.rpartition(".")
    inner = F.get_json_object(column, f"$.{parent}") if parent else F.col(column)
    return F.coalesce(F.array_contains(F.json_object_keys(inner), name), F.lit(False))


def export_json_fields(df: DataFrame, column: str, fields: dict[str, str] | list[tuple[str, str]], missing: str = "error", keep: list[str] | None = None) -> DataFrame:
    """Project dotted paths of a JSON column under new names, by record: a missing path is an error when the row is read, a
    null, or skips that record. Names may not repeat."""
    pairs = list(fields.items()) if isinstance(fields, dict) else fields
    names = [*(keep or []), *[n for n, _ in pairs]]
    if missing not in ("error", "null", "skip"):
        raise ValueError(f"unknown policy: {missing}")
    if len(set(names)) < len(names):
        raise ValueError(f"names repeat: {names}")
    if missing == "skip":
        for _, path in pairs:
            df = df.filter(json_presence(column, path))
    value = lambda path: F.get_json_object(column, f"$.{path}")
    if missing == "error":
        value = lambda path: F.when(json_presence(column, path), F.get_json_object(column, f"$.{path}")).otherwise(F.raise_error(F.lit(f"missing field: {path}")))
    return df.select(*(keep or []), *[value(path).alias(name) for name, path in pairs])


def missing_counts(df: DataFrame, column: str, paths: list[str]) -> DataFrame:
    """(path, n): how many records miss each path."""
    counts = df.agg(*[F.count_if(~json_presence(column, p)).alias(f"c{i}") for i, p in enumerate(paths)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"c{i}").alias("n")) for i, p in enumerate(paths)])).alias("x")).select("x.*")


def report(df: DataFrame, title: str = "") -> tuple[str, str]:
    """A one-row aggregate as JSON and as a Markdown table."""
    row = df.first().asDict(recursive=True)
    table = "\n".join([f"# {title}", "", "| name | value |", "|---|---|", *[f"| {k} | {v} |" for k, v in row.items()], ""])
    return json.dumps(row, ensure_ascii=False, indent=2, default=str), table


def export_documents(df: DataFrame, doc_id: str, text: str, metadata: list[str]) -> DataFrame:
    """(id, text, metadata struct); documents without text are left out."""
    return df.filter(F.coalesce(F.col(text), F.lit("")) != "").select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), F.struct(*metadata).alias("metadata"))
