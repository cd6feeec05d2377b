"""Centroid clustering by Elkan's bounds, with distances in whole numbers.

A vector's components become floor(64 x). Every vector keeps an upper bound of the distance to its centroid and a lower bound to each centroid. When
centroids move, the bounds move with them; a centroid is skipped for a vector where its lower bound, or half the distance between the two
centroids, is strictly over the upper bound. Bounds are rounded away from a wrong skip, and a skip needs a strict inequality, so a centroid at
an equal distance is always looked at. What is looked at is compared by exact squared distances in integers, ties to the smaller number.

A round reads the vectors with their bounds, decides, and writes them anew; the sums of its clusters are formed in each task, one row for each cluster,
before they meet. The driver holds the centroids alone. A table is dropped as soon as the next one stands.

Defined results: vectors that are null, of another length, or with a null or non-finite component take no part; repeated rows are vectors of their
own, and a vector without an id can be in a cluster but is never a starting centroid before others; with fewer vectors than centroids, there are as
many centroids as vectors; an empty table gives an empty result. Components beyond 2^27 after scaling are an error, since their squared
distances may not fit in a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, release, scratch

SCALE, LARGEST = 64, 1 << 27
#: Relative room for the rounding of square roots and sums in doubles.
ROOM = 1e-12
#: Rows that a task works on at once.
CHUNK = 8192
STATE = "vec_id long, v binary, cluster int, upper double, lower binary, distance long, computed int"
NAMES = ["vec_id", "v", "cluster", "upper", "lower", "distance", "computed"]


def _up(x: np.ndarray) -> np.ndarray:
    return x * (1 + ROOM) + ROOM


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(x * (1 - ROOM) - ROOM, 0)


def _short(x: np.ndarray) -> np.ndarray:
    """Lower bounds as 32-bit floats, not over the given ones."""
    return (x * (1 - 3e-7)).astype("<f4")


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to a centroid, or to a row each."""
    apart = rows - centroid
    return np.einsum("ij,ij->i", apart, apart)


@dataclass(frozen=True)
class Step:
    """The centroids of a round, and how far each has moved since the last, as an upper bound; none have before the first."""

    centroids: np.ndarray
    moved: np.ndarray | None

    def assign(self, rows: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """cluster, upper, lower, exact squared distance and number of distances computed of each row."""
        n, k = len(rows), len(self.centroids)
        each = np.arange(n)
        if self.moved is None:
            exact = np.stack([squared(rows, c) for c in self.centroids], axis=1)
            cluster = exact.argmin(axis=1)
            return cluster, _up(np.sqrt(exact[each, cluster])), _down(np.sqrt(exact)), exact[each, cluster], np.full(n, k)
        lower = _down(lower - self.moved)
        upper = _up(upper + self.moved[cluster])
        half = _down(np.sqrt(np.stack([squared(self.centroids, c) for c in self.centroids])) / 2)
        own = squared(rows, self.centroids[cluster])  # the upper bound made tight; the last round returns it
        upper = np.minimum(upper, _up(np.sqrt(own)))
        lower[each, cluster] = _down(np.sqrt(own))
        wanted = (lower <= upper[:, None]) & (half[cluster] <= upper[:, None])
        wanted[each, cluster] = False
        best, place = own.copy(), cluster.copy()
        for c in range(k):
            at = np.flatnonzero(wanted[:, c])
            if len(at):
                exact = squared(rows[at], self.centroids[c])
                lower[at, c] = _down(np.sqrt(exact))
                nearer = (exact < best[at]) | ((exact == best[at]) & (c < place[at]))
                best[at[nearer]], place[at[nearer]] = exact[nearer], c
        return place, _up(np.sqrt(best)), lower, best, wanted.sum(axis=1) + 1


def whole(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (whole components) of all vectors that take part."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x"))
    sound = rows.where(f"size(x) = {dim} and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    return sound.select("vec_id", F.transform("x", lambda c: F.when(F.abs(c * SCALE) <= LARGEST, F.floor(c * SCALE)).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))).alias("v"))


def _binary(rows: np.ndarray) -> pa.Array:
    wide = rows.dtype.itemsize * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * wide), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _rows(column: pa.Array, kind: str, wide: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), wide)


def _packed(rows: DataFrame, dim: int) -> DataFrame:
    """The state before the first round, vectors as 32-bit integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            flat = batch.column(1).flatten().to_numpy().reshape(n, dim).astype("<i4")
            none = np.zeros(n, np.int64)
            yield pa.record_batch([batch.column(0), _binary(flat), pa.array(none, pa.int32()), pa.array(none, pa.float64()), pa.array([b""] * n, pa.binary()), pa.array(none), pa.array(none, pa.int32())], NAMES)

    return rows.mapInArrow(work, STATE)


def _round(state: DataFrame, step: Step, dim: int) -> DataFrame:
    k = len(step.centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for lo in range(0, whole_batch.num_rows, CHUNK):
                batch = whole_batch.slice(lo, CHUNK)
                rows = _rows(batch.column(1), "<i4", dim).astype(np.int64)
                lower = np.zeros((len(rows), k)) if step.moved is None else _rows(batch.column(4), "<f4", k).astype(np.float64)
                cluster, upper, lower, exact, computed = step.assign(rows, batch.column(2).to_numpy(), batch.column(3).to_numpy(), lower)
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(upper), _binary(_short(lower)), pa.array(exact), pa.array(computed, pa.int32())], NAMES)
        release()

    return state.mapInArrow(work, STATE)


def _sums(state: DataFrame, k: int, dim: int) -> tuple[list[int], list[int], list[list[int]]]:
    """Sizes, sums of squared distances and sums of components of all clusters, exact; each task brings a row for each of its clusters."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, far, total = [0] * k, [0] * k, np.zeros((k, dim), object)
        for whole_batch in batches:
            for lo in range(0, whole_batch.num_rows, CHUNK):
                batch = whole_batch.slice(lo, CHUNK)
                rows, cluster, exact = _rows(batch.column(1), "<i4", dim).astype(np.int64), batch.column(2).to_numpy(), batch.column(5).to_numpy()
                for c in np.unique(cluster):
                    own = cluster == c
                    size[c] += int(own.sum())
                    far[c] += int(exact[own].sum(dtype=object))
                    total[c] += rows[own].sum(axis=0)
        held = [c for c in range(k) if size[c]]
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array([size[c] for c in held], pa.int64()), pa.array([far[c] for c in held], pa.int64()), pa.array([[int(x) for x in total[c]] for c in held], pa.list_(pa.int64()))], ["cluster", "n", "far", "total"])

    told = state.select(*NAMES).mapInArrow(work, "cluster int, n long, far long, total array<long>")
    each = told.select("cluster", F.posexplode(F.concat(F.array("n", "far"), "total")).alias("i", "x")).groupBy("cluster", "i").agg(F.sum("x").alias("x")).collect()
    made = np.zeros((k, dim + 2), object)
    for r in each:  # at most k (dim + 2) numbers
        made[r.cluster, r.i] = r.x
    return list(made[:, 0]), list(made[:, 1]), made[:, 2:].tolist()


def _starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest digests."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(mark.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in first], np.int64)


def kmeans(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray, list[int]]:
    """The vectors with cluster, distance and the distances computed in the last round; the centroids they were assigned to; and the inertia of each.

    The table stays in the shared folder until its scope ends.
    """
    spark: SparkSession = vectors.sparkSession
    ship(spark)
    rows = whole(vectors, dim, id_col, vector_col)
    centroids = _starts(rows, k, seed)
    if not len(centroids):
        return _packed(rows, dim), centroids, []
    state, moved = _packed(rows, dim), None
    with scratch(spark) as keep, ExitStack() as tables:
        for turn in range(rounds + 1):
            own = ExitStack()
            own.enter_context(scratch(spark))
            state = (cut if turn < rounds else keep)(_round(state, Step(centroids, moved), dim))
            tables.close()  # the table before this one
            tables.push(own)
            size, far, total = _sums(state, len(centroids), dim)
            if turn < rounds:
                fresh = np.array([[t // n for t in of] if n else list(c) for n, of, c in zip(size, total, centroids, strict=True)], np.int64)
                moved, centroids = _up(np.sqrt(squared(fresh, centroids))), fresh
    return state, centroids, far


def assigned(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that takes part."""
    state, centroids, far = kmeans(vectors, **settings)
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def of(values: list, kind: str):
        return F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster"))

    return state.select("vec_id", "cluster", "distance", of(far, "long").alias("cluster_inertia"), F.lit(sum(far)).cast("long").alias("inertia"), of(marks, "string").alias("centroid_sha256"), "computed")
