"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)), so all pairwise
interactions cost one pass over the features of a document. Features are the distinct hashed words of the whole
text with damped, length-normalised counts, buckets of structure statistics, and a bucket of the text's size
as the only metadata; labels, language, source and id are never features.

The machine is fitted on a bounded sample of the labelled rows: documents in the order of a hash of their id, at most
SAMPLE of them and no more than have VALUES features together. A document of the sample counts with all its features,
as in scoring, and what reaches the driver has a fixed bound. A quarter of the sample is not fitted but calibrates the
margins, with both classes weighted alike, so that a cut means the same whatever share of the labels is low.
Scoring reads every document whole and is one pass without a shuffle.

Defined results: a null text counts as empty and gets a score like any other; a label that is null or no 0 or
1 teaches nothing; a document that is labelled twice counts twice; with labels of one class or none the score
is that share (0.5 for none); repeated rows keep a row each; any further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.llm.common import SPACES, cut, each_batch, pick, scratch

#: Bounds of the sample, the hashed space, and the fit.
SAMPLE, VALUES, SPACE, RANK = 6_000, 8_000_000, 1 << 16, 6
EPOCHS, RATE, DECAY, BATCH = 6, 0.15, 2e-5, 64
#: Words that a worker remembers the slots of.
MEMORY = 300_000
EDGES = np.array([0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])
STATS = ("upper", "digit", "mark", "symbol", "pipe", "shout", "space", "repeat_words", "repeat_windows", "repeat_lines", "line_length", "word_length", "size")
WIDTH = len(EDGES) + 1


def held_out(id_col: str | Column = "doc_id") -> Column:
    """True for the fifth of the rows that teaches nothing: crc32 of the id as text, modulo 5, is 0."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def structure(text: str, words: list[bytes]) -> list[float]:
    """Statistics of a text between 0 and about 1, in the order of STATS."""
    n, size = max(1, len(words)), max(1, len(text))
    raw = np.frombuffer(text.encode(), np.uint8)
    by = np.bincount(raw, minlength=256)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    windows = set(zip(words, words[1:], words[2:], strict=False))
    marks = sum(int(by[ord(c)]) for c in ".,;:?'\"()-")
    symbols = sum(int(by[ord(c)]) for c in "#*$%&<>=~^_{}[]\\/@+")
    return [
        by[65:91].sum() / size, by[48:58].sum() / size, marks / n, symbols / n, by[ord("|")] / n, by[ord("!")] / n, sum(map(text.count, SPACES)) / size,
        1 - len(set(words)) / n, 1 - len(windows) / max(1, len(words) - 2), 1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, len(text) / max(1, len(lines)) / 2000), min(1.0, size / n / 20), min(1.0, np.log1p(len(text)) / 14),
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    text = text or ""
    words = text.encode().lower().split()
    known, crc = _slots, zlib.crc32
    slots = []
    for w in words:
        slot = known.get(w)
        if slot is None:
            if len(known) > MEMORY:
                known.clear()
            slot = known[w] = crc(w) % SPACE
        slots.append(slot)
    index, count = np.unique(np.array(slots, np.int64), return_counts=True)
    value = np.sqrt(count)
    value = value / max(1e-9, np.sqrt((value * value).sum()))
    stats = structure(text, words)
    bucket = SPACE + np.arange(len(STATS)) * WIDTH + np.searchsorted(EDGES, stats)
    return np.concatenate([index, bucket]), np.concatenate([value, np.full(len(STATS), 0.5)])


_slots: dict[bytes, int] = {}


def forget() -> None:
    """Ends what this worker remembers of words."""
    _slots.clear()


@dataclass
class Machine:
    """The parameters of a factorisation machine, and the calibration of its margins."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The machine's sum for each row of features, in time linear in their number."""
        start = np.cumsum([0, *(len(i) for i, _ in rows)])[:-1]
        index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
        linear = np.add.reduceat(self.weight[index] * value, start)
        each = self.factor[index] * value[:, None]
        total, square = np.add.reduceat(each, start), np.add.reduceat(each * each, start)
        return self.bias + linear + 0.5 * (total**2 - square).sum(axis=1)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The calibrated probability of label 1 for each row of features."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(rows) + self.offset, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with both classes weighted alike and a small penalty on the standardised slope."""
    mean, spread = x.mean(), max(1e-9, x.std())
    z = np.stack([(x - mean) / spread, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(b @ z, -30, 30)))
        grad = z @ (weight * (y - p)) - np.array([0.1, 0.0]) * b
        hess = (z * (weight * p * (1 - p) + 1e-9)) @ z.T + np.diag([0.1, 1e-6])
        b = b + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(b[0] / spread), float(b[1] - b[0] * mean / spread)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Fits a machine on three of four rows and calibrates it on the fourth, where both parts hold both classes."""
    tuning = np.arange(len(rows)) % 4 == 1
    machine = descend([r for r, t in zip(rows, tuning, strict=True) if not t], labels[~tuning])
    if 0 < labels[tuning].sum() < tuning.sum() and 0 < labels[~tuning].sum() < (~tuning).sum():
        machine.slope, machine.offset = logistic(machine.margins([r for r, t in zip(rows, tuning, strict=True) if t]), labels[tuning])
    return machine


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Machine:
    """Fits a machine by AdaGrad on mini-batches."""
    n = SPACE + len(STATS) * WIDTH
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    machine = Machine(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), np.zeros(n), rng.normal(0, 0.03, (n, RANK)))
    if share in (0.0, 1.0) or not len(labels):
        return Machine(30.0 * (2 * share - 1), np.zeros(n), np.zeros((n, RANK)))
    g_weight, g_factor = np.full(n, 1e-2), np.full((n, RANK), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            size = np.array([len(rows[r][0]) for r in part])
            start = np.cumsum([0, *size])[:-1]
            index, value = np.concatenate([rows[r][0] for r in part]), np.concatenate([rows[r][1] for r in part])
            each = machine.factor[index] * value[:, None]
            total = np.add.reduceat(each, start)
            y = machine.bias + np.add.reduceat(machine.weight[index] * value, start) + 0.5 * (total**2 - np.add.reduceat(each * each, start)).sum(axis=1)
            wrong = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - labels[part]
            pull = np.repeat(wrong, size) * value / len(part)
            slot, place = np.unique(index, return_inverse=True)
            grad = np.bincount(place, pull, len(slot)) + DECAY * machine.weight[slot]
            spread = pull[:, None] * (np.repeat(total, size, axis=0) - each)
            grads = np.stack([np.bincount(place, spread[:, f], len(slot)) for f in range(RANK)], axis=1) + DECAY * machine.factor[slot]
            g_weight[slot] += grad**2
            g_factor[slot] += grads**2
            machine.weight[slot] -= RATE * grad / np.sqrt(g_weight[slot])
            machine.factor[slot] -= RATE * grads / np.sqrt(g_factor[slot])
            machine.bias -= 0.05 * float(wrong.mean())
    return machine


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, values: int = VALUES, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Fits a machine on the labelled rows that are not held out, at most `sample` of them and at most `values` features."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id")).select(F.col("doc_id").alias("of"), F.col(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("of"), "of", "label").limit(sample)
    met = pick(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).select("doc_id", "text", "label")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [features(t) for t in batch.column(1).to_pylist()]
        columns = [pa.array([i.astype(np.int32) for i, _ in made], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in made], pa.list_(pa.float32()))]
        return pa.record_batch([batch.column(0), batch.column(2), *columns], ["doc_id", "label", "i", "v"])

    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    with scratch(docs.sparkSession):
        featured = cut(each_batch(met, work, "doc_id long, label int, i array<int>, v array<float>"))
        sizes = featured.orderBy(*order).limit(2 * sample).select(F.size("i").alias("n")).toPandas()["n"]
        rows = featured.orderBy(*order).limit(int((sizes.cumsum() <= values).sum())).toArrow()
    made = [(np.asarray(i, np.int64), np.asarray(v, np.float64)) for i, v in zip((x.values.to_numpy() for x in rows.column("i")), (x.values.to_numpy() for x in rows.column("v")), strict=True)]
    return fit(made, rows.column("label").to_numpy().astype(float))


def _scorer(docs: DataFrame, machine: Machine, batch: int = 256):
    """A function from texts to scores, for use in tasks."""
    packed = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weight.astype(np.float32), machine.factor.astype(np.float32), machine.slope, machine.offset))

    def scores(texts: list[str | None]) -> np.ndarray:
        here = Machine(*packed.value)
        return np.concatenate([here.score([features(t) for t in texts[lo : lo + batch]]) for lo in range(0, len(texts), batch)]).astype(float)

    return scores


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    scores = _scorer(docs, machine)

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([rows.column(0), pa.array(scores(rows.column(1).to_pylist()))], ["doc_id", "score"])

    return each_batch(pick(docs, id_col, text_col), work, "doc_id long, score double", forget)


def keep(docs: DataFrame, machine: Machine, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows, with all columns, whose score reaches the threshold; one pass, no shuffle."""
    scores, place = _scorer(docs, machine), docs.columns.index(text_col)

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pa.array(scores(rows.column(place).to_pylist()) >= threshold))

    return each_batch(docs, work, docs.schema, forget)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
