"""Ranks over whole tables and within keys, however many rows a key has."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.durable import cut

#: monotonically_increasing_id() counts within a partition in its low bits.
PLACES = 33


def ranks(rows: DataFrame, order: list[str | Column], keys: tuple[str, ...] = (), name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Rows with their rank from 1 in an order without ties: over the whole table, or within keys.

    Rows are dealt to ranges of (keys, order) by sampled splitters and sorted there, so neither the table nor a key meets in one task. A row's
    place is the sum of the rows in the ranges before its own, one number for each range on the driver, and its place in its range; its
    rank in a key is counted from the key's first place. The ranged table is written, so that its places hold.
    """
    by = [*map(F.col, keys), *order]
    many = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.repartitionByRange(many, *by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()))
    of = F.shiftright("_place", PLACES).cast("int")
    sizes = {r.k: r.n for r in dealt.groupBy(of.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = dict(zip(sorted(sizes), accumulate((sizes[k] for k in sorted(sizes)), initial=0), strict=False))
    offsets = F.array(*(F.lit(before.get(k, 0)).cast("long") for k in range(max(before, default=0) + 1)))
    placed = dealt.withColumn("_place", F.get(offsets, of) + F.col("_place").bitwiseAND(F.lit((1 << PLACES) - 1)))
    if not keys:
        return placed.withColumn(name, F.col("_place") + 1).drop("_place")
    first = placed.groupBy(*keys).agg(F.min("_place").alias("_first"))
    return placed.join(first, list(keys)).withColumn(name, F.col("_place") - F.col("_first") + 1).drop("_place", "_first")
