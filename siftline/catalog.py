"""All registered queries outside the training-data subpackage, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from .shipping import ship

#: Modules with QUERIES: name -> (function of (spark, sf_dir), SQL or None).
MODULES = ("siftline.plans.flagship", "siftline.plans.scalars", "siftline.plans.lines", "siftline.plans.records", "siftline.plans.more", "siftline.plans.workflow")


def _all() -> dict[str, tuple[Callable, str | None]]:
    out: dict[str, tuple[Callable, str | None]] = {}
    for name in MODULES:
        for key, value in importlib.import_module(name).QUERIES.items():
            if key in out:
                raise ValueError(f"two queries are named {key}")
            out[key] = value
    return out


def shipped(query: Callable) -> Callable:
    """The query, with the package's sources sent to the executors first."""

    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable]:
    return {k: shipped(f) for k, (f, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _all().items() if sql}
