"""Make this package importable on executors that have no copy of it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's sources to Spark's own file server once per application; executors fetch them from there."""
    context = spark.sparkContext
    if context.applicationId in _DONE:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="siftline-")) / "siftline.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _DONE.add(context.applicationId)
