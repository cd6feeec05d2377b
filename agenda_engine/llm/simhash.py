"""Near-duplicates by SimHash, with links found through a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 32 segments of two bits. The Manhattan distance of two such
points is at most the Hamming distance of the fingerprints, so points further apart than the radius cannot
link. The grid: the axes are dealt to `groups` groups, and a cell is the part of a point on all but `radius`
of them. Two points within the radius differ on at most `radius` axes, so they share at least one cell, and the
range join is an equi-join on cells. Pairs of a cell are tested by Manhattan distance and then exactly.

Copies collapse first: only distinct fingerprints enter the grid. Cells of one fingerprint end there. Pairs
are never written: a task compares the points of a cell with numpy and writes a spanning forest, and a cell
with more than BLOCK points is dealt out as pairs of blocks.

Defined results: a null text or one without words has fingerprint 0 and links like any other; a text with
fewer words than a shingle is one shingle; rows without an id get a fingerprint and share their component;
repeated rows keep a row each; any further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, each_batch, pick, release, scratch
from agenda_engine.operators.components import components


GROUPS, BLOCK = 6, 2048
EVEN = 0x5555555555555555


def shingles(text: str | None, words: int = 3, seed: int = 42) -> np.ndarray:
    """The XXH64 of each shingle of a text, in order."""
    import xxhash

    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    count = max(len(tokens) - words + 1, 1)
    stop = (ends[words - 1 :] if len(tokens) >= words else ends[-1:]) - 1
    start = np.concatenate([[0], ends[: count - 1]])
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(joined[a:b], seed) for a, b in zip(start.tolist(), stop.tolist(), strict=True)], np.uint64, count)


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text: a bit is set if over half of the shingles' XXH64 have it."""
    hashes = shingles(text, words, seed)
    count = len(hashes)
    if not count:
        return 0
    ones = np.zeros(64, np.int64)
    for lo in range(0, count, 65536):
        ones += np.unpackbits(hashes[lo : lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and fp (a signed long with the fingerprint's bits) of every row; one pass, no shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, words, seed) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.record_batch([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return each_batch(pick(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")), work, "doc_id long, text_hash long, fp long")


def embedding(fp):
    """The bit counts of the 32 two-bit segments, two bits each in one long. Works on columns."""
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN)), fp.bitwiseAND(F.lit(EVEN))
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseXOR(low))


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The Manhattan distance of embeddings: counts 0, 1, 2 differ by 1 where their low bits differ, by 2 where only the high ones do."""
    x, even = a ^ b, np.uint64(EVEN)
    low, high = x & even, (x >> np.uint64(1)) & even
    return np.bitwise_count(low).astype(np.int16) + 2 * np.bitwise_count(high & ~low).astype(np.int16)


def masks(radius: int, groups: int = GROUPS) -> list[int]:
    """The bits of each cell: all ways to leave `radius` of the groups out, as signed longs."""
    edge = [2 * round(32 * i / groups) for i in range(groups + 1)]
    part = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(groups)]
    full = [sum(part[i] for i in keep) for keep in combinations(range(groups), groups - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in full]


def _forest(a: np.ndarray, point: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by group: for each row, the smallest row that its links reach within the group; only rows that reach a smaller one."""
    label = np.arange(len(a))
    shift = 1
    live = np.flatnonzero(group[1:] == group[:-1])
    while live.size:
        other = live + shift
        test = label[live] != label[other]
        i, j = live[test], other[test]
        near = manhattan(point[i], point[j]) <= radius
        i, j = i[near], j[near]
        linked = np.bitwise_count(a[i] ^ a[j]) <= radius
        i, j = i[linked], j[linked]
        while i.size:  # hang the larger root on the smaller one until both ends agree
            ri, rj = label[i], label[j]
            np.minimum.at(label, np.maximum(ri, rj), np.minimum(ri, rj))
            while ((up := label[label]) != label).any():
                label = up
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
        shift += 1
        live = live[live + shift < len(a)]
        live = live[group[live] == group[live + shift]]
    child = np.flatnonzero(label != np.arange(len(a)))
    return child, label[child]


def links(distinct: DataFrame, radius: int = 3, groups: int = GROUPS) -> DataFrame:
    """(a, b): a spanning forest of the links within each cell, by node, over rows of fp (distinct) and node."""
    ship(distinct.sparkSession)
    point = embedding(F.col("fp"))
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("grid"), point.bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(masks(radius, groups)))))
    dealt = distinct.select("fp", "node", cells.alias("c")).select("c.*", "fp", "node")
    # a written table, so that the join has two shuffles of its own and a crowded cell can be split
    crowded = cut(dealt.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = dealt.join(crowded, ["grid", "cell"]).withColumn("blocks", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).alias("mine")
    pairs = met.select("grid", "cell", "fp", "node", "blocks", mine).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    keyed = pairs.select("grid", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp", "node")
    sorted_rows = keyed.repartition("grid", "cell", "i", "j").sortWithinPartitions("grid", "cell", "i", "j", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rest = rows if rest is None else pa.concat_tables([rest, rows])
            key = np.stack([rest.column(c).to_numpy() for c in ("grid", "cell", "i", "j")])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if new.size:  # all but the last group are whole
                yield solve(rest.slice(0, int(new[-1]) + 1))
                rest = rest.slice(int(new[-1]) + 1)
        if rest is not None and rest.num_rows:
            yield solve(rest)
        del rest
        release()

    def solve(rows: pa.Table) -> pa.RecordBatch:
        key = np.stack([rows.column(c).to_numpy() for c in ("grid", "cell", "i", "j")])
        group = np.concatenate([[0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))])
        fp, node = rows.column("fp").to_numpy().view(np.uint64), rows.column("node").to_numpy()
        even = np.uint64(EVEN)
        high, low = (fp >> np.uint64(1)) & even, fp & even
        child, root = _forest(fp, ((high & low) << np.uint64(1)) | (high ^ low), group, radius)
        return pa.record_batch([pa.array(node[child]), pa.array(node[root])], ["a", "b"])

    return sorted_rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, fp and component_id (the smallest doc_id that links reach) of every row."""
    marked = cut(fingerprints(docs, words, seed, id_col, text_col))
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("node")))
    with scratch(docs.sparkSession) as keep:
        linked = keep(components(links(distinct.where("node is not null"), radius)))
    known = distinct.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marked.join(known, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all columns, of the smallest id of each component; of equal rows one stays.

    A row without an id goes if its component has an id.
    """
    with scratch(docs.sparkSession) as keep:
        marked = keep(near_duplicates(docs, words, radius, id_col=id_col, text_col=text_col))
    same = marked.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("component_id"))
    known = same.where(~F.col("doc_id").eqNullSafe(F.col("component_id")) | (F.col("rows") > 1))
    known = known.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays"))
    met = docs.join(known, docs[id_col].eqNullSafe(F.col("of_doc")) & (F.xxhash64(docs[text_col]) == F.col("of_text")), "left")
    one = met.where("stays").dropDuplicates([id_col, "of_text"])
    return met.where("of_text is null").unionByName(one).select(*docs.columns)
