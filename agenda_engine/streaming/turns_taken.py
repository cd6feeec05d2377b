"""The rotation as state by source: outcomes stream in, each source's row is kept in the state store, and what nobody tries for long is let go by a timer.

A micro-batch touches only the sources that it holds outcomes of, and those whose time is up; what it emits are their rows. Equal to
operators.rotation.update over the same waves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from agenda_engine.functions.shipping import ship
from agenda_engine.operators.rotation import FORGET_DAYS, outcome_status

MOMENTS = ("last_try", "last_success", "last_block")
STATE = "last_try long, last_success long, state string, failures int, blocks int, last_block long, successes int, last_error string"
NAMES = [f.split()[0] for f in STATE.split(", ")]
DAY_MS = 86_400_000


def after(old: tuple | None, status: str, error: str | None, at: int) -> tuple:
    """A source's row after a turn; moments are microseconds."""
    row = dict(zip(NAMES, old, strict=True)) if old else dict.fromkeys(NAMES) | {"failures": 0, "blocks": 0, "successes": 0}
    done = status in ("ok", "sin_publicaciones")
    row |= {"last_try": at, "state": status, "failures": 0 if done else row["failures"] + (status == "error"), "blocks": row["blocks"] + (status == "bloqueada"), "successes": row["successes"] + (status == "ok")}
    row |= ({"last_success": at} if done else {}) | ({"last_block": at} if status == "bloqueada" else {})
    if status in ("error", "ok"):
        row["last_error"] = error if status == "error" else None
    return tuple(row[n] for n in NAMES)


def turns(outcomes: DataFrame, forget_days: int = FORGET_DAYS) -> DataFrame:
    """source_id, the row of its rotation and gone (let go, by then without a row), for each source that a micro-batch changes; update mode.

    outcomes: a stream of source_id, n_items, error and at (a timestamp). The watermark is the latest `at`; an outcome from before it is still taken,
    in the order of the micro-batch.
    """
    ship(outcomes.sparkSession)
    told = outcomes.withWatermark("at", "0 seconds").select(
        F.col("source_id").cast("string").alias("source_id"), "at", F.unix_micros("at").alias("us"), outcome_status(F.col("error"), F.col("n_items")).alias("status"),
        F.substring(F.trim(F.regexp_replace("error", r"\s+", " ")), 1, 200).alias("error"),
    )

    def work(key: tuple, tables: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(*key, *[None] * len(NAMES), True)], columns=["source_id", *NAMES, "gone"])
            return
        row = state.get if state.exists else None
        for us, status, error in sorted((r for t in tables for r in zip(t.us, t.status, t.error, strict=True)), key=lambda r: r[0]):
            row = after(row, status, error, int(us))
        state.update(row)
        state.setTimeoutTimestamp(max(row[0] // 1000 + max(1, forget_days) * DAY_MS, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame([(*key, *row, False)], columns=["source_id", *NAMES, "gone"]).astype({c: "Int64" for c in MOMENTS})

    kept = told.groupBy("source_id").applyInPandasWithState(work, f"source_id string, {STATE}, gone boolean", STATE, "update", GroupStateTimeout.EventTimeTimeout)
    return kept.select("source_id", *(F.timestamp_micros(n).cast("timestamp_ntz").alias(n) if n in MOMENTS else n for n in NAMES), "gone")


def start(outcomes: DataFrame, folder: str, checkpoint: str, forget_days: int = FORGET_DAYS):
    """Starts a query that takes what is there and stops; each micro-batch writes the rows it changed under its number, so a replay writes the same place."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={number}")

    return turns(outcomes, forget_days).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
