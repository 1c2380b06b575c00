"""Small builders for the query catalog: a projection and its equivalent SQL side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quoted(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


def literal(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few fixed rows as SQL literals (no Python worker, no shuffle)."""
    fields = [x.strip().rsplit(" ", 1) for x in schema.split(",")]
    parts = [F.struct(*[F.lit(v).cast(kind).alias(name) for (name, kind), v in zip(fields, row)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def projection(table: str, keys: str, columns: dict[str, tuple[Callable[[], Column], str]], cases: tuple[str, list[tuple]] | None = None, where: tuple[Callable[[], Column], str] | None = None) -> Query:
    """``columns``: name -> (function giving the Column, SQL). ``keys`` are kept columns, separated by commas.

    ``cases``: (schema, rows) of literal rows with the columns that the projection reads, appended to the table.
    """
    kept = [k.strip() for k in keys.split(",")]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read(spark, sf_dir, table)
        if cases:
            names = [x.strip().rsplit(" ", 1)[0] for x in cases[0].split(",")]
            df = df.select(*names).unionByName(literal(spark, *cases))
        if where:
            df = df.filter(where[0]())
        return df.select(*kept, *[f().alias(name) for name, (f, _) in columns.items()])

    source = table
    if cases:
        names = ", ".join(x.strip().rsplit(" ", 1)[0] for x in cases[0].split(","))
        source = f"(SELECT {names} FROM {table} UNION ALL VALUES {values(cases[1])})"
    sql = f"SELECT {keys}, " + ", ".join(f"{s} AS {name}" for name, (_, s) in columns.items()) + f" FROM {source}"
    return query, sql + (f" WHERE {where[1]}" if where else "")
