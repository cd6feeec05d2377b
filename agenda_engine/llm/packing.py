"""Packing of tokenised documents into sequences by patterns fitted with non-negative least squares.

A pattern is a multiset of one to three piece lengths that fills a sequence exactly. The histogram of lengths,
at most one number for each length up to the capacity, is all that the plan needs: non-negative least squares
fit a repeat count to every pattern, up to the optimum. Counts are rounded so that what one pattern loses its neighbour gets,
and the pieces that remain, about as many as there are lengths whatever the input, are packed best fit by decreasing
length, on the histogram too.

The plan then says which ranks of a length go where; ranks are given within hashed parts of each length, so a
length that a third of all pieces have is not ranked in one task.

Defined results: a null or empty text is one piece that holds the end id alone; texts of any length are cut
into full pieces with the shorter one first; repeated rows are packed as often as they occur; an empty table
gives no sequences; any further columns of the input are ignored.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agenda_engine.llm.bpe import PATTERN, byte_letters, encoder
from agenda_engine.llm.common import cut, each_batch, pick

#: Segments that a worker remembers; pieces of one length that are ranked together, about.
MEMORY, RANKED = 300_000, 2_000
#: Steps of the fit, at most, and the gradient at which it ends; reserves of short pieces to choose from, in 64ths of a sequence.
STEPS, SLACK, RESERVES = 5_000, 0.01, (0, 4, 8, 12)


class _Known(dict):
    """Segments and the little-endian ids of each."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, segment: str) -> bytes:
        ids = self[segment] = np.array(self.encode(segment, allowed_special="all"), "<u4").tobytes()
        return ids


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The vocabulary of a tokenizer file in the fast library, and what this worker remembers; ids equal those of the file's own library."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    of_letter = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    ranks = {bytes(of_letter[c] for c in piece): i for piece, i in content["model"]["vocab"].items() if piece not in special}
    return _Known(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special).encode)


def ids_of(text: str, path: str) -> bytes:
    """The ids of a text as little-endian 32-bit numbers."""
    known, parts = _encoder(path), encoder(path)
    if len(known) > MEMORY:
        known.clear()
    if parts.crossing.search(text):
        return np.array(known.encode(text, allowed_special="all"), "<u4").tobytes()
    return b"".join(map(known.__getitem__, parts.segments(text)))


def bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of n tokens: full ones, with what is over in front."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and its ids if asked for; one pass, no shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tail, out, kept = np.array([end], "<u4").tobytes(), [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = ids_of(text or "", path) + tail
            for i, (start, length) in enumerate(bounds(len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + length)]
                out.append((doc_id, i, start, length, zlib.crc32(part)))
                if keep_ids:
                    kept.append(np.frombuffer(part, "<u4").astype(np.int32))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.record_batch(columns + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, names + ["ids"] * keep_ids)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return each_batch(pick(docs, id_col, text_col), work, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def patterns(capacity: int, present: np.ndarray) -> np.ndarray:
    """All ways to fill a sequence with at most three of the present lengths, rows of three; 0 stands for no piece."""
    there = np.zeros(capacity + 1, bool)
    there[present] = True
    there[0] = True
    out = []
    for longest in np.flatnonzero(there)[::-1]:
        if 3 * longest < capacity:
            break
        rest = capacity - longest
        second = np.arange((rest + 1) // 2, min(longest, rest) + 1)
        third = rest - second
        ok = there[second] & there[third] & ((second > 0) | (third == 0))
        out.append(np.stack([np.full(ok.sum(), longest), second[ok], third[ok]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit(counts: np.ndarray, ways: np.ndarray, steps: int = STEPS, least: float = SLACK) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that minimise the squared distance of the sum of x * pattern to the histogram.

    Projected gradient steps with momentum, which starts anew where it leads away, until no pattern's gradient breaks
    the optimality conditions by more than `least`: none below 0, and 0 for each pattern in use.
    """
    wanted, n = counts.astype(float), len(counts)
    wanted[0] = 0.0

    def total(x: np.ndarray) -> np.ndarray:
        out = np.bincount(ways.ravel(), np.repeat(x, ways.shape[1]), n)
        out[0] = 0.0
        return out

    x = np.zeros(len(ways))
    if not len(ways):
        return x
    turned = np.ones(len(ways))
    for _ in range(30):  # the largest eigenvalue bounds a step
        turned = total(turned)[ways].sum(axis=1)
        largest = float(np.linalg.norm(turned))
        turned /= largest
    largest *= 1.05
    ahead, pace = x, 1.0
    for k in range(steps):
        new = np.maximum(ahead - (total(ahead) - wanted)[ways].sum(axis=1) / largest, 0.0)
        if ((ahead - new) * (new - x)).sum() > 0:
            x, ahead, pace = new, new, 1.0
        else:
            faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
            x, ahead, pace = new, new + (pace - 1) / faster * (new - x), faster
        if k % 50 == 49:
            slope = (total(x) - wanted)[ways].sum(axis=1)
            if slope.min() > -least and np.abs(slope[x > 0]).max(initial=0.0) < least:
                break
    return x


def rounded(x: np.ndarray, ways: np.ndarray, counts: np.ndarray) -> tuple[list[tuple[int, list[int]]], np.ndarray]:
    """Whole repeat counts of the patterns, and the histogram that they leave.

    Patterns go by their longest piece and then by the next, and each takes what the running sum has grown by in whole
    numbers, so what rounding takes from one pattern its neighbour gets; no length is used more often than it occurs.
    """
    left, out = counts.astype(np.int64).copy(), []
    order = np.lexsort((ways[:, 1], -ways[:, 0]))
    whole = np.diff(np.floor(np.cumsum(x[order]) + 0.5 + 1e-9).astype(np.int64), prepend=0)
    for p, n in zip(order[whole > 0].tolist(), whole[whole > 0].tolist(), strict=True):
        inside = [int(v) for v in ways[p] if v]
        repeats = min(n, *(int(left[v]) // inside.count(v) for v in inside))
        if repeats > 0:
            out.append((repeats, inside))
            for v in inside:
                left[v] -= repeats
    return out, left


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit by decreasing length, on counts: (sequences, lengths in each)."""
    free: dict[int, list[tuple[int, list[int]]]] = {}
    for length in range(capacity, 0, -1):
        todo = int(counts[length])
        while todo:
            room = min((s for s in free if s >= length), default=None)
            if room is None:
                each = min(capacity // length, todo)
                free.setdefault(capacity - each * length, []).append((todo // each, [length] * each))
                todo -= todo // each * each
                continue
            n, inside = free[room].pop()
            if n > todo:
                free[room].append((n - todo, inside))
                n = todo
            elif not free[room]:
                del free[room]
            free.setdefault(room - length, []).append((n, [*inside, length]))
            todo -= n
    return [x for group in free.values() for x in group]


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(sequences, lengths in each) for a whole histogram: fitted patterns, rounded, and then the residual, best fit."""
    fitted, rest = plans(counts, capacity)
    return fitted + rest


def plans(counts: np.ndarray, capacity: int) -> tuple[list[tuple[int, list[int]]], list[tuple[int, list[int]]]]:
    """The sequences of fitted patterns, and those of the residual.

    Pieces shorter than a reserve stay out of the patterns, to fill what the residual leaves. Of a few reserves the one
    with the fewest sequences is taken, and of equals the one whose patterns place the most pieces.
    """
    best, volume = None, -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    for reserve in sorted({capacity * part // 64 for part in RESERVES}):
        kept = counts.astype(np.int64).copy()
        kept[:reserve] = 0
        ways = patterns(capacity, np.flatnonzero(kept))
        fitted, left = rounded(fit(kept, ways), ways, kept)
        rest = best_fit(counts - kept + left, capacity)
        key = (sum(n for n, _ in fitted) + sum(n for n, _ in rest), -sum(n * len(inside) for n, inside in fitted))
        if best is None or key < best[0]:
            best = (key, fitted, rest)
        if key[0] == volume:  # no packing has fewer
            break
    return best[1], best[2]


def places(filled: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows of length, first rank, first sequence, offset: where the ranks of each length go. As many rows as lengths in the plan."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, inside in filled:
        offset = 0
        for length in inside:
            rows.append((length, rank.get(length, 0), sequence, offset))
            rank[length] = rank.get(length, 0) + repeats
            offset += length
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def assign(cut_pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces of a written table.

    To the driver goes one number for each length; the plan that comes back is bounded by the capacity.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut_pieces.groupBy("length").count().collect():
        counts[length] = n
    parts = int(min(4096, 1 + counts.sum() // RANKED))
    where = places(plan(counts, capacity))
    key = (where[:, 0] << 40) | where[:, 1]
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).alias("part")
    dealt = cut_pieces.select("*", part)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "part").count().select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(inside)).join(base, ["length", "part"])
    own = list(cut_pieces.columns)
    names = [*own, "sequence_id", "offset"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = batch.column("length").to_numpy(), batch.column("at").to_numpy()
        row = where[np.searchsorted(key, (length << 40) | rank, side="right") - 1]
        columns = [batch.column(c) for c in own]
        return pa.record_batch([*columns, pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])], names)

    ranked = ranked.select(*own, (F.col("rank") + F.col("base") - 1).cast("long").alias("at"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut_pieces.schema)
    return each_batch(ranked, work, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, capacity: int = 1024, end: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokenises and packs: a row for every piece with the sequence and the offset that it goes to."""
    return assign(cut(pieces(docs, path, capacity, end, id_col, text_col, keep_ids)), capacity)
