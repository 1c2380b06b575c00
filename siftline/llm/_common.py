"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship



def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is missing and all runs in one process (tests, a laptop) a temporary folder is made and stored in the
    session; on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="siftline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there and nothing is computed twice.

    Unlike ``checkpoint()`` the rows are computed once, stay columnar and compressed, and survive lost executors.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.siftline_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made and that nothing reads any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.siftline_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_go(spark: SparkSession):
    """Shuffle files are deleted when the execution that made them ends, instead of when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def private(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that clash with no column of ``df`` (compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        full = f"__{name}"
        while full.lower() in taken:
            full = f"_{full}"
        taken.add(full.lower())
        out.append(full)
    return out


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often, also inside lambdas, the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(df: DataFrame) -> DataFrame:
    """``df`` as a single column ``row``, so that no column of it can clash with a helper column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


#: Bytes of rows that Spark puts into one Arrow batch for a Python worker.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes as well as by rows: a worker's memory then doesn't depend on how long texts are.

    The setting is read when a query starts, so it stays in the session; a session that has one keeps it. Everything that
    runs Python on executors calls this, so the package's sources are sent along.
    """
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def column_at(batch, path: str):
    """A column of an Arrow batch by name, or a field of a struct column by dotted name."""
    name, _, inner = path.partition(".")
    column = batch.column(batch.schema.get_field_index(name))
    if not inner:
        return column
    import pyarrow.compute as pc

    return pc.struct_field(column, inner)
