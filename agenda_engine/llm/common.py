"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from agenda_engine.functions.durable import cut, scratch
from agenda_engine.functions.shipping import ship

__all__ = ["SPACES", "cut", "each_batch", "parts", "pick", "release", "scratch"]

#: A word is a run of anything but these characters.
SPACES = " \t\n\x0b\f\r"
#: Bytes of a batch that are worked on at once; a longer text is one part.
PART = 4 << 20


def pick(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that an operator works on, as doc_id and text; whatever else there is stays outside, so no name clashes."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))


def release() -> None:
    """Hands memory that batches no longer use back to the system; Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about PART bytes."""
    rows = max(1, batch.num_rows * PART // max(1, batch.nbytes))
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def each_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, done: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow with one batch out for each part of a batch; done() ends a task."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                if (out := work(part)) is not None:
                    yield out
        if done:
            done()
        release()

    return df.mapInArrow(run, schema)
