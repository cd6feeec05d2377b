"""The catalogue as a stream: each micro-batch of events reconciles with the last snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.operators.state import HISTORY, KEEP_DAYS, reconcile
from agenda_engine.sources.sinks import current_snapshot, has_snapshot, write_snapshot


def empty_archive(events: DataFrame) -> DataFrame:
    """An archive of no rows with the columns of some events and those of the state."""
    state = f"event_id string, first_seen_at string, last_seen_at string, history {HISTORY}"
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema if f.name not in ("event_id", "first_seen_at", "last_seen_at", "history")]
    return events.sparkSession.createDataFrame([], ", ".join([*own, state]))


def start(events: DataFrame, folder: str, checkpoint: str, clock: str = "at", keep_days: int = KEEP_DAYS):
    """Starts a query that takes what is there and stops; the batch's own `at` is its moment.

    A batch writes the version of its number. One that is replayed after a failure finds that version and names it again, so it never
    reconciles with its own output; the first batch begins with an empty archive.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        at = rows.agg(F.max(clock)).first()[0]
        if at is None:
            return
        new = rows.drop(clock)
        old = current_snapshot(spark, folder) if has_snapshot(spark, folder) else empty_archive(new)
        write_snapshot(reconcile(new, old, str(at), keep_days=keep_days), folder, f"batch-{batch_id:09d}")

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
