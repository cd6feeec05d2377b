"""Ranked lexical search over a two-level quantised index, with scores in whole numbers.

The index has a row for each document with what the items ask for: term numbers and frequencies. The first level is one byte for
each term of a document, its saturated frequency rounded upward to 255 steps: the weights of an item's terms times these bytes are an upper bound of the
document's score, and the same with one step less a lower bound. The second level is the frequency itself, from which the exact integer score is
computed for every document whose upper bound reaches the k-th best lower bound of the item so far. A task keeps the k best of each item
and passes only these on.

Items are searched in blocks of at most BLOCK bytes of text, or one longer item, which bounds what is broadcast: a block's terms and weights. Each
block is a pass over the texts without a shuffle of texts or postings; what is shuffled are counts for each asked term and the best k of each task.

Defined results: a null text has no term and is no document of the statistics; repeated rows are documents of their own, as are repeated items;
an item without terms, or of which no document has a term with a weight, has no row; equal scores go to the smaller doc_id, null ids first;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, parts, pick, release

# Fixed values of the measure: saturation, length norm, and the scale of the whole numbers.
SATURATED, STEEP, BASE_LENGTH, OWN_LENGTH = 1_000_000_000, 12, 75, 25
#: One step of a byte; a saturated frequency is under a million.
STEP = -(-1_000_000 // 255)
#: Bytes of item texts of a block; pairs of an item's term and a posting that are added up at once.
BLOCK, ADDED = 1 << 22, 1 << 21
#: A to Z in lower case, all but letters, digits and what is not ASCII as a space.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode().translate(TABLE).split()


def saturation(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """The whole-number share of a term's weight that a document earns."""
    return SATURATED * tf // (1000 * tf + STEEP * norm)


@dataclass
class Block:
    """Items to search for at once: their terms as numbers of a vocabulary, with the times each is asked."""

    items: list[tuple[int, int | None]] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    asked: list[dict[int, int]] = field(default_factory=list)

    def add(self, row: Row) -> None:
        own: Counter = Counter()
        for t in terms(row.text):
            own[self.vocabulary.setdefault(t, len(self.vocabulary))] += 1
        self.items.append(row.item_id)
        self.asked.append(dict(own))


def blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """Items in blocks; the driver holds one at a time."""
    now, size = Block(), 0
    for row in items.toLocalIterator():
        own = len((row.text or "").encode())
        if now.items and size + own > most:
            yield now
            now, size = Block(), 0
        now.add(row)
        size += own
    if now.items:
        yield now


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all its terms), ids and tfs of the asked terms, for each document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for batch in batches:
            for part in parts(batch):
                rows, lengths, ends, ids, tfs = [], [], [0], [], []
                for at, text in enumerate(part.column(1)):
                    said = terms(text.as_py())
                    if said:
                        own = Counter(t for t in map(asked.get, said) if t is not None)
                        rows.append(at)
                        lengths.append(len(said))
                        ids += own.keys()
                        tfs += own.values()
                        ends.append(len(ids))
                offsets = pa.array(ends, pa.int32())
                yield pa.record_batch([
                    part.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ], ["doc_id", "n", "ids", "tfs"])
        release()

    return docs.mapInArrow(work, "doc_id long, n long, ids array<int>, tfs array<int>")


@dataclass(frozen=True)
class Asked:
    """A block as arrays: for each item its terms, and for each the weight times the times it is asked."""

    items: list
    term: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    size: int
    n_docs: int
    n_terms: int

    @classmethod
    def of(cls, block: Block, df: dict[int, int], n_docs: int, n_terms: int) -> Asked:
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        rows = [(t, i, weight[t] * n) for i, own in enumerate(block.asked) for t, n in own.items() if weight.get(t)]
        flat = np.array(rows, np.int64).reshape(-1, 3)
        flat = flat[np.lexsort((flat[:, 1], flat[:, 0]))]
        return cls(block.items, flat[:, 0], flat[:, 1], flat[:, 2], len(block.vocabulary), n_docs, n_terms)

    def norm(self, n: np.ndarray) -> np.ndarray:
        return BASE_LENGTH + OWN_LENGTH * n * self.n_docs // self.n_terms


class Best:
    """The k best documents of each item that a task has seen."""

    def __init__(self, asked: Asked, k: int):
        self.asked, self.k = asked, k
        self.bar = np.zeros(len(asked.items), np.int64)  # the k-th best exact score, 0 before there are k
        self.item, self.doc, self.null, self.score = (np.zeros(0, d) for d in (np.int64, np.int64, bool, np.int64))
        self.scored = 0

    def add(self, doc: np.ndarray, null: np.ndarray, n: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Documents of a part, and their postings in order of row."""
        asked = self.asked
        norm = asked.norm(n)
        earned = saturation(tf, norm[row])
        level = -(-earned // STEP)
        order = np.argsort(term, kind="stable")
        first, last = np.searchsorted(term[order], asked.term), np.searchsorted(term[order], asked.term, "right")
        by_item = np.argsort(asked.item, kind="stable")
        cells = max(1, ADDED // max(1, len(doc)))  # items whose bounds fit
        item_of = asked.item[by_item]
        for lo in range(0, len(asked.items), cells):
            own = by_item[np.searchsorted(item_of, lo) : np.searchsorted(item_of, lo + cells)]
            if not len(own):
                continue
            high, low = (np.zeros((min(cells, len(asked.items) - lo), len(doc)), np.int64) for _ in range(2))
            met = np.flatnonzero((last - first)[own])
            for j in own[met]:
                at = order[first[j] : last[j]]  # a document has a term once
                rows = row[at]
                step = level[at] * asked.weight[j]
                high[asked.item[j] - lo, rows] += step
                low[asked.item[j] - lo, rows] += step - asked.weight[j]
            self._rescore(lo, high * STEP, low * STEP, doc, null, row, term, earned)

    def _rescore(self, lo: int, high: np.ndarray, low: np.ndarray, doc: np.ndarray, null: np.ndarray, row: np.ndarray, term: np.ndarray, earned: np.ndarray) -> None:
        asked, k = self.asked, self.k
        many = high.shape[0]
        bar = self.bar[lo : lo + many]
        if high.shape[1] >= k:
            bar = np.maximum(bar, np.partition(low, low.shape[1] - k, axis=1)[:, -k])
        item, who = np.nonzero((high >= bar[:, None]) & (high > 0))
        if not len(item):
            return
        self.scored += len(item)
        starts = np.searchsorted(row, np.arange(len(doc) + 1))
        size = (starts[1:] - starts[:-1])[who]
        pair = np.repeat(np.arange(len(who)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[who], size)
        key = asked.term * len(asked.items) + asked.item  # in order
        want = term[at] * len(asked.items) + (item + lo)[pair]
        place = np.minimum(np.searchsorted(key, want), len(key) - 1)
        score = np.zeros(len(who), np.int64)
        np.add.at(score, pair, np.where(key[place] == want, asked.weight[place] * earned[at], 0))
        good = score > 0
        self._keep(item[good] + lo, doc[who[good]], null[who[good]], score[good])

    def _keep(self, item: np.ndarray, doc: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        item, doc, null, score = (np.concatenate(x) for x in ((self.item, item), (self.doc, doc), (self.null, null), (self.score, score)))
        order = np.lexsort((doc, ~null, -score, item))
        item, doc, null, score = item[order], doc[order], null[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        self.item, self.doc, self.null, self.score = item[kept], doc[kept], null[kept], score[kept]
        full = rank[kept] == self.k - 1
        self.bar[self.item[full]] = self.score[full]


def best_of(index: DataFrame, asked: Asked, k: int) -> DataFrame:
    """item (number in its block), doc_id and score: the k best of each item in each task."""
    sent = index.sparkSession.sparkContext.broadcast(asked)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(sent.value, k)
        for batch in batches:
            size = np.diff(batch.column("ids").offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), size)
            id_of = batch.column("doc_id")
            best.add(
                id_of.fill_null(0).to_numpy(), id_of.is_null().to_numpy(zero_copy_only=False), batch.column("n").to_numpy(),
                row, batch.column("ids").flatten().to_numpy().astype(np.int64), batch.column("tfs").flatten().to_numpy().astype(np.int64),
            )
        yield pa.record_batch([pa.array(best.item, pa.int32()), pa.array(best.doc, pa.int64(), mask=best.null), pa.array(best.score, pa.int64())], ["item", "doc_id", "score"])
        release()

    return index.select("doc_id", "n", "ids", "tfs").mapInArrow(work, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest score of each item.

    Three numbers go to the driver for a block, and a count for each of its terms.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = pick(docs, id_col, text_col)
    asked_for = items.select(items[item_col].cast("long").alias("item_id"), items[text_col].alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    for one in blocks(asked_for, block):
        index = cut(postings(texts, one.vocabulary))
        whole = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not whole.docs:
            break
        df = dict(index.select(F.explode("ids").alias("t")).groupBy("t").count().toLocalIterator())
        best = best_of(index, Asked.of(one, df, whole.docs, whole.terms), k)
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = F.get(F.array(*map(F.lit, one.items)).cast("array<long>"), F.col("item"))
        out = out.unionByName(ranked.select(named.alias("item_id"), "rank", "doc_id", "score"))
    return out
