"""A corpus through five stages: quality, near-duplicates, repeated passages, personal data, packing.

Each stage takes all that the one before kept, and its decisions take effect. All but the last return the
columns of documents; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.llm import copies, packing, pii, quality, simhash, suffix
from agenda_engine.llm.common import cut, scratch
from agenda_engine.llm.queries import tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects (a score under 0.3)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.train(docs, labels)).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies.

    Groups are those of op1_simhash first; of what is left, texts that no fingerprint of 64 bits brings together but whose five-word
    Jaccard similarity is 0.8 or more go as well.
    """
    left = cut(simhash.keep_one(docs.select(*COLUMNS)))
    return copies.keep_one(left).select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that an earlier document holds; a document that is one keeps its row with no text."""
    kept = suffix.deduplicate(docs, carry=("lang", "source"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that disclose it."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_copies", keep_one_of_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("personal_data", sanitise),
    ("packing", pack),
]

#: No stage could be told in SQL without the models and the tokenizer; a test holds every stage and run() against plain versions on a small corpus.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; what a stage wrote on its way is dropped behind it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
