"""One document of each group of near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates are texts that agree on a band: ROWS minhashes of the set, of BANDS bands. A pair at exactly 0.8 shares no
band with probability (1 - 0.8^5)^25, which is 5e-5, and one at 0.9 with 2e-10. Every link is verified on the whole sets, in integers.

Texts of equal sets collapse first. Then cells are compared in two rounds. The first takes the FIRST bands only and
deals a large cell to random blocks, so its work is linear and joins all but the odd members of a large group. The
second takes all cells that still hold more than one component, and compares every pair of different components:
the blocks of a cell's largest component meet those of the others, but not each other. Sets are made again for texts
that share a cell only, and pairs are never written.

Defined results: a null text or one without words has an empty set, and those are copies of each other; a text with
fewer words than a shingle is one shingle; of a component stays one row, of the smallest id, and one without an id
only where no member has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, each_batch, pick, release, scratch
from agenda_engine.llm.simhash import shingles
from agenda_engine.operators.components import components

WORDS, BANDS, ROWS, FIRST, BLOCK = 5, 25, 5, 4, 256
CELL = ("band", "cell", "i", "j")


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return np.unique(shingles(text, words, 42))


def bands(held: np.ndarray) -> list[int]:
    """A signed long for each band of a set; none for an empty one."""
    import xxhash

    if not len(held):
        return []
    turn = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for lo in range(0, len(held), 512):
        np.minimum(least, (held[lo : lo + 512, None] * turn).min(axis=0), out=least)
    digests = [xxhash.xxh64_intdigest(row.tobytes()) for row in least.reshape(BANDS, ROWS)]
    return np.array(digests, np.uint64).view(np.int64).tolist()


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is 0.8 or more."""
    x, y = len(a), len(b)
    return 5 * min(x, y) >= 4 * max(x, y) and 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (x + y)


def _sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, key (a digest of the set) and bands of every row; one pass, no shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
        keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        return pa.record_batch([batch.column(0), batch.column(2), keys, pa.array(map(bands, sets), pa.list_(pa.int64()))], ["doc_id", "text_hash", "key", "bands"])

    return each_batch(pick(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")), work, "doc_id long, text_hash long, key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key and held (the set) for the rows of wanted: doc_id, text_hash, key."""
    texts = pick(docs, id_col, text_col).withColumn("hash", F.xxhash64("text")).withColumnRenamed("doc_id", "of")
    met = texts.join(wanted, F.col("of").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))).select("key", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["key", "held"])

    return each_batch(met, work, "key binary, held array<long>")


def _links(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that join different components (column of) within the rows of one CELL."""
    ship(dealt.sparkSession)
    rows = dealt.join(sets, "key").select(*CELL, "key", "of", "held").repartition(*CELL).sortWithinPartitions(*CELL, "key")

    def ends(table: pa.Table) -> np.ndarray:
        keys = np.stack([table.column(c).to_numpy() for c in CELL])
        return np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1

    def solve(table: pa.Table) -> pa.RecordBatch:
        held, keys, of = table.column("held").combine_chunks(), table.column("key").to_pylist(), table.column("of").to_pylist()
        held = pa.concat_arrays(held.chunks) if isinstance(held, pa.ChunkedArray) else held
        values, at = held.values.to_numpy().view(np.uint64), held.offsets.to_numpy()
        edge = [0, *ends(table).tolist(), table.num_rows]
        a, b = [], []
        for lo, hi in zip(edge, edge[1:], strict=False):
            root: dict[bytes, bytes] = {}

            def find(x: bytes, root=root) -> bytes:
                while (up := root.get(x, x)) != x:
                    x = up
                return x

            for i in range(lo + 1, hi):
                for j in range(lo, i):
                    x, y = find(of[i]), find(of[j])
                    if x != y and near(values[at[i] : at[i + 1]], values[at[j] : at[j + 1]]):
                        root[max(x, y)] = min(x, y)
                        a.append(keys[i])
                        b.append(keys[j])
        return pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            if (new := ends(rest)).size:  # all but the last group are whole
                yield solve(rest.slice(0, int(new[-1])))
                rest = rest.slice(int(new[-1]))
        if rest is not None and rest.num_rows:
            yield solve(rest)
        del rest
        release()

    return rows.mapInArrow(run, "a binary, b binary")


def _blocks(n: str) -> Column:
    return F.expr(f"cast(({n} + {BLOCK - 1}) div {BLOCK} as int)")


def _mine(blocks: str) -> Column:
    """The block of a row among some, other in each band."""
    return F.pmod(F.xxhash64("key", "band"), F.greatest(F.col(blocks), F.lit(1))).cast("int")


def _random_blocks(met: DataFrame) -> DataFrame:
    """Rows of the first round: each in one block of its cell."""
    one = met.where(F.col("band") < FIRST).withColumn("blocks", _blocks("n"))
    return one.select("band", "cell", _mine("blocks").alias("i"), F.lit(0).alias("j"), "key", F.col("key").alias("of"))


def _pairs_of_blocks(met: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows of the second round: in cells of more than one component, every block with all that it must meet."""
    known = met.join(linked.withColumnRenamed("node", "key"), "key", "left").select("band", "cell", "key", F.coalesce("component", "key").alias("of"))
    shares = known.groupBy("band", "cell", "of").agg(F.count(F.lit(1)).alias("n"))
    cells = shares.groupBy("band", "cell").agg(F.max(F.struct("n", "of")).alias("large"), F.sum("n").alias("all")).where(F.col("large.n") < F.col("all"))
    cells = cells.select("band", "cell", F.col("large.of").alias("large"), _blocks("large.n").alias("n_large"), _blocks("(all - large.n)").alias("n_small"))
    small, mine = F.sequence(F.lit(0), F.col("n_small") - 1), F.col("mine")
    inside = F.transform(small, lambda j: F.struct(mine.alias("i"), j.alias("j")))
    cross = F.transform(F.sequence(F.lit(0), F.col("n_large") - 1), lambda i: F.struct(i.alias("i"), mine.alias("j")))
    # pairs of the others' blocks, under numbers below 0; a pair of a block with itself is part of its meeting the first large block
    other = F.transform(F.filter(small, lambda o: o != mine), lambda o: F.struct((-1 - F.least(mine, o)).alias("i"), F.greatest(mine, o).alias("j")))
    rows = known.join(cells, ["band", "cell"]).withColumn("mine", F.when(F.col("of") == F.col("large"), _mine("n_large")).otherwise(_mine("n_small")))
    met_in = F.when(F.col("of") == F.col("large"), inside).otherwise(F.concat(cross, other))
    return rows.select("band", "cell", "key", "of", F.explode(met_in).alias("at")).select("band", "cell", "at.i", "at.j", "key", "of")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and component (the same for near copies) of every row."""
    marked = cut(_sketches(docs, id_col, text_col))
    one = cut(marked.where(F.size("bands") > 0).dropDuplicates(["key"]))
    cells = one.select("key", F.posexplode("bands").alias("band", "cell"))
    crowded = cells.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(cells.join(crowded, ["band", "cell"]))
    wanted = one.join(met.select("key").distinct(), "key").select("doc_id", "text_hash", "key")
    sets = cut(_sets(docs, wanted, id_col, text_col).dropDuplicates(["key"]))
    first = cut(_links(_random_blocks(met), sets))
    linked = components(first)
    second = _links(_pairs_of_blocks(met, linked), sets)
    linked = components(linked.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second)).withColumnRenamed("node", "key")
    return marked.join(linked, "key", "left").select("doc_id", "text_hash", F.coalesce("component", "key").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all columns, of the smallest id of each component; of equal rows one stays."""
    with scratch(docs.sparkSession) as keep:
        marked = keep(groups(docs, id_col, text_col))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = marked.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("best")).where("n > 1")
    known = marked.join(best, "component").select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), row.eqNullSafe(F.col("best")).alias("stays")).distinct()
    met = docs.join(known, docs[id_col].eqNullSafe(F.col("of_doc")) & (F.xxhash64(docs[text_col]) == F.col("of_text")), "left")
    one = met.where("stays").dropDuplicates([id_col, "of_text"])
    return met.where("of_text is null").unionByName(one).select(*docs.columns)
