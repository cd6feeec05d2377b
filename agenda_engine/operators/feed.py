"""What changed from one version of a catalogue to the next, as rows that can be applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.sources.sinks import versions

OP, VERSION = "_op", "_version"


def mark(columns: list[str]) -> Column:
    """256 bits of a row's values; a null, an empty text and an empty list differ."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def difference(old: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """_op (insert, update or delete) and the columns of `new` for every key that is not the same in both; a delete has its key alone.

    Both have a key once. Of the old side only keys and marks of rows are shuffled; a column that one side lacks counts as null there.
    """
    rest = sorted({*old.columns, *new.columns} - {key})
    kinds = {f.name: f.dataType for f in (*old.schema, *new.schema)}

    def whole(rows: DataFrame) -> DataFrame:
        return rows.select(key, *(F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in rest))

    before = whole(old).select(F.col(key).alias("_key"), mark(rest).alias("_was"))
    met = whole(new).withColumn("_is", mark(rest)).join(before, F.col(key) == F.col("_key"), "full")
    op = F.when(F.col("_was").isNull(), "insert").when(F.col("_is").isNull(), "delete").when(F.col("_was") != F.col("_is"), "update")
    return met.withColumn(OP, op).where(F.col(OP).isNotNull()).select(OP, F.coalesce(key, "_key").alias(key), *(c for c in new.columns if c != key))


def applied(base: DataFrame, changes: DataFrame, key: str = "event_id") -> DataFrame:
    """The version that changes make of the one before."""
    columns = [c for c in changes.columns if c not in (OP, VERSION)]
    kept = base.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.where(F.col(OP) != "delete").select(*columns), allowMissingColumns=True).select(*columns)


def read_feed(spark: SparkSession, folder: str, after: int = 0, key: str = "event_id") -> DataFrame | None:
    """The changes of every version that was named after number `after`, with _version; None if there is none.

    The version before is read with the first of them alone, so a reader that keeps the last number it saw reads what is new.
    """
    told = versions(spark, folder)
    numbers = sorted(told)
    out = None
    for i, n in enumerate(numbers):
        if n > after:
            new = spark.read.parquet(told[n])
            old = spark.read.parquet(told[numbers[i - 1]]) if i else new.limit(0)
            step = difference(old, new, key).withColumn(VERSION, F.lit(n))
            out = step if out is None else out.unionByName(step, allowMissingColumns=True)
    return out
