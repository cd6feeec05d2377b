"""Token counts without token ids.

A SentencePiece BPE model never merges across the start of a run of spaces where no piece has a space after
another character, so a text falls apart into pre-tokens there. Pieces are counted once for every distinct
pre-token of the corpus and joined to the frequencies of the pre-tokens of each document.

A few pre-tokens make up most of a text. Those that most documents hold, at most `hot` of them, go to every worker in a table,
which adds up what they give each document; the rest go through a shuffled join. How many documents a pre-token must be in to
be one of these follows from a histogram of such numbers, so no key of the join is in more rows than that. Pre-tokens longer than
LONG characters are joined by their SHA-256.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows keep a row each; any further
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.shipping import ship
from agenda_engine.llm.common import cut, each_batch, parts, pick, release

#: The first space of each run; a literal U+2581 is a space to the model, so no boundary lies behind one.
BOUNDARY = re.compile("(?<=[^ ▁]) ")
#: Pre-tokens in the table of each worker, at most; characters that a join's key has at most; pre-tokens that a worker counts at once.
HOT, LONG, MEMORY = 150_000, 64, 300_000


@lru_cache(maxsize=2)
def _model(path: str):
    """The model of this worker, checked for the boundary property."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(re.search("[^▁]▁", model.id_to_piece(i)) for i in range(model.get_piece_size()) if not model.is_byte(i)):
        raise ValueError("a piece of this model crosses the start of a run of spaces")
    return model


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text that is not empty."""
    if text[0] != " " and "  " not in text and "▁" not in text:
        return text.split(" ")
    return BOUNDARY.split(text)


def key(pretoken: str) -> str:
    """What a pre-token is joined by: itself, or a digest that is longer than any short one."""
    return pretoken if len(pretoken) <= LONG else hashlib.sha256(pretoken.encode()).hexdigest() + "#"


def corpus(rows: DataFrame) -> DataFrame:
    """(pretoken, n_docs) over all documents; each task adds up its own first."""

    def told(held: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["pretoken", "n_docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for part in (p for b in batches for p in parts(b)):
            for text in part.column(0).to_pylist():
                held.update(set(pretokens(text)))
            if len(held) > MEMORY:
                yield told(held)
                held.clear()
        yield told(held)
        del held
        release()

    return rows.where("text <> ''").select("text").mapInArrow(run, "pretoken string, n_docs long").groupBy("pretoken").agg(F.sum("n_docs").alias("n_docs"))


def pieces(of: DataFrame, path: str) -> DataFrame:
    """Adds n_pieces to rows of pretoken and n_docs: the model's pieces behind the space that its dummy prefix gives.

    The empty pre-token is that space alone, one piece; the model itself gives an empty text none.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _model(path).encode(batch.column(0).to_pylist(), num_threads=1)
        return pa.record_batch([*batch.columns, pa.array([max(1, len(x)) for x in ids], pa.int64())], ["pretoken", "n_docs", "n_pieces"])

    return each_batch(of.select("pretoken", "n_docs"), work, "pretoken string, n_docs long, n_pieces long")


def often(known: DataFrame, hot: int) -> DataFrame:
    """The rows of `known` in the most documents, at most `hot`: all above a step of a histogram, so no sort and no single task."""
    step = F.floor(4 * F.log2("n_docs")).cast("int")
    total, least = 0, None
    for row in sorted(known.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):
        total += row["count"]
        if total > hot:
            break
        least = row.step
    return known.where(step >= least) if least is not None else known.limit(0)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every input row.

    Shuffles: distinct pre-tokens of each task; frequencies of rare pre-tokens in each document, by pre-token; one partial
    sum for each document and task. Rows are told apart by id and text, and equal rows by how often they occur.
    """
    ship(docs.sparkSession)
    rows = pick(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = F.when(F.length("pretoken") <= LONG, F.col("pretoken")).otherwise(F.concat(F.sha2("pretoken", 256), F.lit("#")))
    known = cut(pieces(corpus(rows), path).select(short.alias("key"), "n_docs", "n_pieces"))
    top = often(known, hot).select("key", "n_pieces").toArrow()
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(top.column("key").to_pylist(), top.column("n_pieces").to_pylist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = table.value
        for part in (p for b in batches for p in parts(b)):
            out = []
            for doc_id, text, text_hash in zip(*(c.to_pylist() for c in part.columns), strict=True):
                total = 0
                for pretoken, n in Counter(pretokens(text)).items() if text else ():
                    k = key(pretoken)
                    if (own := held.get(k)) is None:
                        out.append((doc_id, text_hash, k, n, 0, 0, 0))
                    else:
                        total += n * own
                # a row of the document's own, under a key that no pre-token has and that spreads
                out.append((doc_id, text_hash, f"{text_hash:>{LONG + 24}}", 0, total, 1, len(text.encode())))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.record_batch(columns, names)
        release()

    names = ["doc_id", "text_hash", "key", "n", "own", "copies", "n_bytes"]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    freq = rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, key string, n long, own long, copies long, n_bytes long")
    met = freq.join(known.select("key", "n_pieces"), "key", "left")
    total = met.groupBy("doc_id", "text_hash").agg(
        F.sum(F.col("n") * F.coalesce("n_pieces", F.lit(0)) + F.col("own")).alias("n"), F.sum("copies").alias("copies"), F.max("n_bytes").alias("n_bytes")
    )
    each = total.select("doc_id", "n_bytes", F.expr("n div copies").alias("n_tokens"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return each.drop("copy")
