"""Nearest neighbours by largest inner product, over randomly rotated one-bit codes.

A vector is stored as the signs of its randomly rotated direction, packed, with two correction scalars: its
length, and the inner product of its direction with the sign vector. The rotation is that of a space of D dimensions, four
times those of the vectors and at least BITS, in which the vectors are padded with zeros, so a code has more bits than the
vector has components and a smaller error. For a rotated query direction q and signs s / sqrt(D), <s, q> / <s, o> estimates <o, q>
without bias, and the error exceeds EPS * sqrt((1 - <s, o>^2) / (<s, o>^2 * (D - 1))) with a chance that falls as
exp(-c * EPS^2). A vector whose upper bound is under the lower bounds of enough others is no neighbour; all others are
reranked, with the original vectors, in double precision. A neighbour is thus lost only where its estimate is off by about
twice the bound.

Vectors are encoded once. Codes, scalars and original vectors are dealt out in blocks of bounded size to meet the
blocks of queries; a task rules out by codes what it can, reranks the rest and passes on the best of each query, so what it
passes on does not grow with the vectors. Equal vectors are one candidate with its smallest ids, as many as an answer can hold.

Defined results: vectors that are null, zero, of another dimension than the most common one, or with a null
or non-finite component take no part, as query or candidate; a query's own id is never its neighbour, in
repeated rows either; equal scores go to the smaller id, and repeated rows of an id count once with the best
score; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, each_batch, release

#: Rows of a block of candidates and of queries, at most; rows of either that are estimated at once.
CANDIDATES, QUERIES, CHUNK, STEP = 65_536, 16_384, 4096, 512
#: Queries of a block where there are few; numbers that are multiplied at once in reranking.
FEW, EXACT = 1024, 1 << 22
#: Bits of a code, at least; width of the bounds.
BITS, EPS = 1024, 2.0


@lru_cache(maxsize=2)
def rotation(dim: int, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """The first `dim` rows of a random orthogonal matrix of a multiple of 8 rows, at least `bits` and four times `dim`, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((-(-max(4 * dim, bits) // 8) * 8, dim)))
    return (q * np.sign(np.diag(r))).T


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length and <s, o> of each row."""
    length = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / length[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def bounds(turned: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the inner product of each rotated query and each code."""
    bits = turned.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(bits))
    estimate = (turned @ signs.T) * (length / own).astype(np.float32)
    error = (eps * np.sqrt(np.maximum(1 - own**2, 0) / (own**2 * max(bits - 1, 1))) + 1e-5) * length  # estimates are in single precision
    error = np.sqrt((turned * turned).sum(axis=1))[:, None] * error.astype(np.float32)
    return estimate - error, estimate + error


def survivors(queries: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, k: int, eps: float = EPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate, lower and upper bound of all pairs of a block whose upper bound reaches the k-th lower bound of the query."""
    turned = (queries @ rotation(queries.shape[1])).astype(np.float32)
    bar = np.full((len(queries), k), -np.inf, np.float32)  # the k best lower bounds so far, the least first
    found = []
    for at in range(0, len(codes), CHUNK):
        part = slice(at, at + CHUNK)
        for lo in range(0, len(queries), STEP):
            rows = slice(lo, lo + STEP)
            low, high = bounds(turned[rows], codes[part], length[part], own[part], eps)
            both = np.concatenate([bar[rows], low], axis=1)
            bar[rows] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
            q, c = np.nonzero(high >= bar[rows, :1])
            found.append((q + lo, c + at, low[q, c], high[q, c]))
    q, c, low, high = (np.concatenate([f[i] for f in found]) for i in range(4)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.float32))
    still = high >= bar[q, 0]
    return q[still], c[still], low[still], high[still]


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def reranked(queries: np.ndarray, vectors: np.ndarray, least: np.ndarray, at: np.ndarray, who: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate and score of the k best pairs of each query, ties to the smaller of `least`."""
    many = max(1, EXACT // queries.shape[1])
    score = np.concatenate([exact(queries[at[lo : lo + many]], vectors[who[lo : lo + many]]) for lo in range(0, len(at), many)] or [np.zeros(0)])
    order = np.lexsort((least[who], -score, at))
    at, who, score = at[order], who[order], score[order]
    best = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[best], who[best], score[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def _sound(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v and q of all rows that take part."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where("vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").limit(1).collect()
    return rows.where(F.size("v") == (dims[0].dim if dims else 0))


def encoded(sound: DataFrame, k: int) -> DataFrame:
    """vid, v, ids (its k + 1 smallest), code, length and own of each distinct vector, as a written table."""
    order = Window.partitionBy("v").orderBy("vec_id")
    few = sound.select("vec_id", "v").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    distinct = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = _matrix(pa.chunked_array([batch.column(0)]))
        codes, length, own = encode(vectors, rotation(vectors.shape[1]))
        return pa.record_batch([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(own)], ["v", "ids", "code", "length", "own"])

    kinds = f"v {distinct.schema['v'].dataType.simpleString()}, ids array<bigint>, code binary, length double, own double"
    return cut(each_batch(distinct, work, kinds).withColumn("vid", F.monotonically_increasing_id()))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", eps: float = EPS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among all other rows.

    is_query is a condition on id_col. One number goes to the driver for each dimension found, and two counts.
    """
    spark = vectors.sparkSession
    ship(spark)
    sound = _sound(vectors, is_query, id_col, vector_col)
    base = encoded(sound, k)
    asked = cut(sound.where("q").select(F.col("vec_id").alias("query_id"), "v").distinct().withColumn("qid", F.monotonically_increasing_id()))
    n, nq = base.count(), asked.count()
    spread = 2 * spark.sparkContext.defaultParallelism
    candidate_blocks = max(1, -(-n // CANDIDATES))
    query_blocks = max(1, -(-nq // QUERIES), min(-(-spread // candidate_blocks), -(-nq // FEW)))

    def blocks(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    def mine(of: str, many: int) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(many)).cast("int")

    candidates = base.select("vid", "v", "code", "length", "own", F.get("ids", F.lit(0)).alias("least"), mine("vid", candidate_blocks).alias("cb"), blocks(query_blocks).alias("qb"))
    queries = asked.select("qid", "v", mine("qid", query_blocks).alias("qb"), blocks(candidate_blocks).alias("cb"))

    def pair(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names)
        asked_for, vectors, ids, least = _matrix(q.column("v")), _matrix(c.column("v")), c.column("vid").to_numpy(), c.column("least").to_numpy()
        codes = np.frombuffer(b"".join(c.column("code").to_pylist()), np.uint8).reshape(c.num_rows, -1)
        at, who, _, _ = survivors(asked_for, codes, c.column("length").to_numpy(), c.column("own").to_numpy(), k + 1, eps)
        at, who, score = reranked(asked_for, vectors, least, at, who, k + 1)
        out = pa.table([pa.array(q.column("qid").to_numpy()[at]), pa.array(ids[who]), pa.array(least[who]), pa.array(score)], names)
        release()
        return out

    names = ["qid", "vid", "least", "score"]
    found = queries.groupBy("cb", "qb").cogroup(candidates.groupBy("cb", "qb")).applyInArrow(pair, "qid long, vid long, least long, score double")
    # one of the k + 1 best may be the query itself
    first = found.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "least"))).where(F.col("n") <= k + 1)
    met = first.select("qid", "vid", "score").join(asked.select("qid", "query_id"), "qid").join(base.select("vid", "ids"), "vid")
    scored = met.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
