"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, spell words character by character, so that an expression is known
in forms that no labelled text has. Both back off to one shared model. With g a gram of at most ORDER characters of
a word (its start and end are characters too), h all of g but the last, and D a discount between 0 and 1,
  P_c(g) = max(c_c(g) - D, 0) / c_c(h) + D types_c(h) / c_c(h) P(g),
  P(g)   = max(n(g) - D, 0) / n(h) + D types(h) / n(h) P(g without its first character),
where c_c counts the grams in the words of a class, and n in the words of all documents, labelled or not, each word
once a document, at the highest order; at lower orders n counts the characters seen before a gram, down to single
characters, behind which all characters are alike. A gram that neither class has seen in its surroundings
weighs nothing: both classes give it the same shared probability.

The ratio of a word is that of the products over its grams. A toxic text is mostly ordinary words, so its
likelihood takes a word as toxic with a chance of SHARE and as ordinary else. The log-likelihoods of both are
divided by the number of words and compared; training rows that gave no counts calibrate the logistic that turns the
difference into the score.

Class counts come from a bounded sample, at most SAMPLE documents of each class chosen by a hash of their id. The
model holds the grams of that sample and nothing else of the corpus, since all others cancel out; no gram
of the sample is left out, however rare. The shared counts cover all documents. Scoring reads every text whole and is
one pass without a shuffle.

Defined results: a null text counts as empty; a text without words gets the score of a difference of 0; a
label that is null or no 0 or 1 teaches nothing; a document that is labelled twice counts twice; with a class missing
every score is the share of toxic rows (0.5 without labels); repeated rows keep a row each; any further columns of the
input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, each_batch, parts, pick, release, scratch
from agenda_engine.llm.quality import held_out, logistic

WORD = re.compile(r"[^\W_]+")
#: Documents of each class, at most; characters of a gram; the chance of a toxic word in a toxic text; words that a worker remembers.
SAMPLE, ORDER, SHARE, MEMORY = 4_000, 5, 0.03, 300_000


def words(text: str | None) -> list[str]:
    """The words of a text, in lower case."""
    return WORD.findall((text or "").lower())


def grams(word: str, order: int = ORDER) -> list[str]:
    """One gram for each character of a word and for its end; a space stands for start and end."""
    said = f" {word} "
    return [said[:k] for k in range(2, min(order, len(said) + 1))] + [said[i : i + order] for i in range(len(said) - order + 1)]


def counted(of_words: dict[str, int]) -> Counter:
    """The grams of some words, each as often as its word."""
    out: Counter = Counter()
    for word, n in of_words.items():
        for g in grams(word):
            out[g] += n
    return out


class _Words(dict):
    """What a worker remembers of words: the log ratio of the two mixtures for each."""

    def __init__(self, ratio):
        super().__init__()
        self.ratio = ratio

    def __missing__(self, word: str) -> float:
        x = self[word] = math.log1p(SHARE * math.expm1(min(self.ratio(word), 50.0)))
        return x


@dataclass
class Model:
    """Log ratios of toxic to ordinary: of each gram that a class has seen, and of any other gram behind a known beginning; and the calibration."""

    seen: dict[str, float]
    behind: dict[str, float]
    slope: float = 0.0
    offset: float = 0.0

    def ratio(self, word: str) -> float:
        """The log ratio of a word's probabilities."""
        behind, total = self.behind, 0.0
        each = grams(word)
        for g, x in zip(each, map(self.seen.get, each), strict=True):
            total += behind.get(g[:-1], 0.0) if x is None else x
        return total

    def differences(self, texts: Iterable[str | None], known: _Words | None = None) -> np.ndarray:
        """For each text the difference of the two log-likelihoods, toxic less ordinary, per word; 0 without words."""
        out, known = [], _Words(self.ratio) if known is None else known
        for text in texts:
            said = words(text)
            if len(known) > MEMORY:
                known.clear()
            out.append(math.fsum(map(known.__getitem__, said)) / len(said) if said else 0.0)
        return np.array(out, float)

    def score(self, texts: Iterable[str | None], known: _Words | None = None) -> np.ndarray:
        """Between 0 and 1, higher for the toxic."""
        return 1 / (1 + np.exp(-np.clip(self.slope * squeezed(self.differences(texts, known)) + self.offset, -30, 30)))


def squeezed(x: np.ndarray) -> np.ndarray:
    """Differences on a scale that is even on both sides of what words have by chance."""
    return np.arcsinh(x / SHARE)


def shared_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n) over all documents: grams of the highest order, each word once a document."""

    ship(docs.sparkSession)

    def told(held: Counter) -> pa.RecordBatch:
        found = counted(held)
        return pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for part in (p for b in batches for p in parts(b)):
            for text in part.column(0).to_pylist():
                held.update(set(words(text)))
            if len(held) > MEMORY:
                yield told(held)
                held.clear()
        yield told(held)
        del held
        release()

    return docs.select(docs[text_col].alias("text")).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def lower(level: DataFrame, order: int) -> DataFrame:
    """The counts of the order below: of each gram the characters seen before it; grams at the start of a word have none and keep their counts."""
    longer = F.length("gram") == order
    each = level.select(F.when(longer, F.expr("substring(gram, 2)")).otherwise(F.col("gram")).alias("gram"), F.when(longer, F.lit(1).cast("long")).otherwise(F.col("n")).alias("n"))
    return each.groupBy("gram").agg(F.sum("n").alias("n"))


def discount(once: int, twice: int) -> float:
    """The discount that grams seen once and twice suggest, kept off 0 and 1."""
    return min(0.95, max(0.1, once / (once + 2 * twice) if once else 0.5))


def shared_model(top: DataFrame, wanted: DataFrame) -> dict[str, float]:
    """P(g) of each wanted gram. To the driver go counts for the ends of wanted grams only."""
    found, discounts, level = {}, {}, top
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            level = cut(lower(level, order + 1))
        split = level.select("gram", "n", F.expr("substring(gram, 1, length(gram) - 1)").alias("h"))
        before = split.groupBy("h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        ends = wanted.select(F.expr(f"right(gram, {order})").alias("gram")).distinct().withColumn("h", F.expr("substring(gram, 1, length(gram) - 1)"))
        rows = ends.join(split.select("gram", "n"), "gram", "left").join(before, "h", "left").na.fill(0).select("gram", "n", "total", "types").toArrow().to_pydict()
        found[order] = dict(zip(rows["gram"], zip(rows["n"], rows["total"], rows["types"], strict=True), strict=True))
        once, twice, all_grams = level.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count(F.lit(1))).first()
        discounts[order] = discount(once, twice)
    out, alike = {}, 1 / (all_grams + 1)  # the last level is that of single characters
    for g in found[ORDER]:
        p = alike
        for order in range(1, len(g) + 1):
            n, total, types = found[order][g[-order:]]
            p = (max(n - discounts[order], 0) + discounts[order] * types * p) / total if total else p
        out[g] = p
    return out


def _sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, label and tuning (True for rows of the calibration) of the chosen training rows."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id")).select(F.col("doc_id").alias("of"), F.col(label).cast("int").alias("label"))
    order = [F.xxhash64("of"), "of"]
    chosen = known.where("label = 0").orderBy(*order).limit(sample).unionByName(known.where("label = 1").orderBy(*order).limit(sample))
    met = pick(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    return met.select("doc_id", "text", "label", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1).alias("tuning"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Counts and calibrates. To the driver go the grams of the sample and a number for each tuning row."""
    with scratch(docs.sparkSession):
        return _train(docs, labels, label, sample, id_col, text_col)


def _train(docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str, text_col: str) -> Model:
    rows = cut(_sample(docs, labels, label, sample, id_col, text_col))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [Counter(), Counter()]
        for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n[kind].update(words(text))
        found = [counted(c) for c in n]
        every = list({**found[0], **found[1]})
        return pa.record_batch([pa.array(every, pa.string()), *(pa.array([c[g] for g in every], pa.int64()) for c in found)], ["gram", "c0", "c1"])

    taught = each_batch(rows.where("not tuning").select("text", "label"), work, "gram string, c0 long, c1 long")
    taught = cut(taught.groupBy("gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")))
    shares = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counts = taught.toArrow().to_pydict()
    if not (any(counts["c0"]) and any(counts["c1"])):
        return _constant(shares)
    model = class_models(counts["gram"], (counts["c0"], counts["c1"]), shared_model(cut(shared_counts(docs, text_col)), taught.select("gram")))
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def differ(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(1), pa.array(packed.value.differences(batch.column(0).to_pylist()))], ["label", "x"])

    tuned = each_batch(rows.where("tuning").select("text", "label"), differ, "label int, x double").toPandas()
    packed.destroy()
    if tuned["label"].nunique() < 2:
        return _constant(shares)
    model.slope, model.offset = logistic(squeezed(tuned["x"].to_numpy(float)), tuned["label"].to_numpy(float))
    return model


def class_models(every: list[str], counts: tuple[list[int], list[int]], shared: dict[str, float]) -> Model:
    """The log ratios of the two class models over the grams of either class."""
    discounts, totals, types = [], [], []
    for c in counts:
        discounts.append(discount(sum(x == 1 for x in c), sum(x == 2 for x in c)))
        total, kinds = defaultdict(int), defaultdict(int)
        for g, x in zip(every, c, strict=True):
            total[g[:-1]] += x
            kinds[g[:-1]] += x > 0
        totals.append(total)
        types.append(kinds)

    def backoff(c: int, h: str) -> float:
        return discounts[c] * types[c][h] / totals[c][h] if totals[c][h] else 1.0

    behind = {h: math.log(backoff(1, h) / backoff(0, h)) for h in {g[:-1] for g in every}}
    seen = {}
    for i, g in enumerate(every):
        h = g[:-1]
        p = [(max(counts[c][i] - discounts[c], 0) / totals[c][h] if totals[c][h] else 0.0) + backoff(c, h) * shared[g] for c in (0, 1)]
        seen[g] = math.log(p[1] / p[0])
    return Model(seen, behind)


def _constant(shares: dict[int, int]) -> Model:
    """The same score for every text: the share of toxic rows."""
    toxic, ordinary = shares.get(1, 0), shares.get(0, 0)
    share = toxic / (toxic + ordinary) if toxic + ordinary else 0.5
    return Model({}, {}, 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row; one pass, no shuffle."""
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = packed.value
        known = _Words(model.ratio)
        for part in (p for b in batches for p in parts(b)):
            yield pa.record_batch([part.column(0), pa.array(model.score(part.column(1).to_pylist(), known))], ["doc_id", "score"])
        del known
        release()

    ship(docs.sparkSession)
    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs, train(docs, labels, id_col=id_col, text_col=text_col), id_col, text_col)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
