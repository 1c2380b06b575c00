"""The callback state machine: per request, events are counted, the first success sticks, and waiting times out.

``latest_state`` is the batch form (one aggregate that combines before its shuffle); ``callback_stream`` keeps the same
state in Structured Streaming, and its last row per key equals the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUT = "request_id long, n_events long, canonical_seq long, succeeded boolean, latest_seq long, late_failures long"


def latest_state(events: DataFrame, key: str, seq: str, success: Column) -> DataFrame:
    """n_events, canonical_seq (first success, else latest event), succeeded, latest_seq, late_failures (failures after it)."""
    rows = events.select(F.col(key).alias("request_id"), F.col(seq).alias("seq"), success.alias("ok"))
    first = rows.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.min(F.when(F.col("ok"), F.col("seq"))).alias("first_ok"), F.max("seq").alias("latest_seq"),
    )
    late = rows.filter("NOT ok").join(first.filter("first_ok IS NOT NULL").select("request_id", "first_ok"), "request_id").filter("seq > first_ok").groupBy("request_id").agg(F.count(F.lit(1)).alias("late_failures"))
    out = first.join(late, "request_id", "left")
    return out.select("request_id", "n_events", F.coalesce("first_ok", "latest_seq").alias("canonical_seq"), F.col("first_ok").isNotNull().alias("succeeded"), "latest_seq", F.coalesce("late_failures", F.lit(0)).alias("late_failures"))


def timed_out(tasks: DataFrame, since: str, status: str, now: Column, minutes: int = 120, waiting: tuple[str, ...] = ("submitted", "processing")) -> DataFrame:
    """Add new_status: callback_timeout where a waiting task is older than ``minutes``."""
    old = F.col(since) < now - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return tasks.withColumn("new_status", F.when(F.col(status).isin(*waiting) & old, "callback_timeout").otherwise(F.col(status)))


def submission_uncertain(tasks: DataFrame, since: str, status: str, now: Column, minutes: int = 120) -> DataFrame:
    """Add new_status: a stale submitting task becomes submit_unknown, and a stale submit_unknown one times out; neither is
    ever sent again by itself."""
    old = F.col(since) < now - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    stale = F.when(old & (F.col(status) == "submit_unknown"), "submit_unknown_timeout").when(old & (F.col(status) == "submitting"), "submit_unknown")
    return tasks.withColumn("new_status", F.coalesce(stale, F.col(status)))


def compare_and_set(tasks: DataFrame, changes: DataFrame, key: str, status: str = "status") -> DataFrame:
    """(key, status, applied): ``changes`` has key, expected and new; a change counts only where the status is as expected."""
    joined = tasks.join(changes.select(F.col(key), "expected", "new"), key, "left")
    ok = F.coalesce(F.col("expected") == F.col(status), F.lit(False))
    return joined.select(key, F.when(ok, F.col("new")).otherwise(F.col(status)).alias(status), ok.alias("applied"))


def upsert(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """The latest version of each key."""
    both = current.unionByName(changes)
    others = [c for c in both.columns if c not in (key, version)]
    latest = both.groupBy(key).agg(F.max(F.struct(version, *others)).alias("x"))
    return latest.select(key, f"x.{version}", *[f"x.{c}" for c in others])


def _advance(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    n, first, latest, late = state.get if state.exists else (0, -1, -1, 0)
    for frame in frames:
        for seq, ok in sorted(zip(frame["seq"].tolist(), frame["ok"].tolist())):
            n, latest = n + 1, max(latest, seq)
            if ok and first < 0:
                first = seq
            elif not ok and first >= 0:
                late += 1
    state.update((n, first, latest, late))
    yield pd.DataFrame({"request_id": [key[0]], "n_events": [n], "canonical_seq": [first if first >= 0 else latest], "succeeded": [first >= 0], "latest_seq": [latest], "late_failures": [late]})


def callback_stream(events: DataFrame, key: str, seq: str, success: Column) -> DataFrame:
    """A row per key and trigger with the state after it. Events of a key have to arrive in order of ``seq``."""
    rows = events.select(F.col(key).cast("long").alias("request_id"), F.col(seq).cast("long").alias("seq"), success.alias("ok"))
    return rows.groupBy("request_id").applyInPandasWithState(_advance, OUT, "n long, first long, latest long, late long", "update", "NoTimeout")
