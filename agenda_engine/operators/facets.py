"""Facet counts over catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranked(rows: DataFrame, limit: int | None) -> DataFrame:
    out = rows.orderBy(F.col("count").desc(), F.col("first_pos"))
    return out if limit is None else out.limit(limit)


def value_facet(rows: DataFrame, column: str, position: str, limit: int | None = None) -> DataFrame:
    """Counts of each non-empty value, most frequent first, ties by the first position.

    Nulls and empty strings are not counted. One partially aggregated shuffle on the value.
    """
    kept = rows.where(F.col(column).isNotNull() & (F.col(column) != ""))
    counted = kept.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("count"), F.min(position).alias("first_pos"))
    return _ranked(counted, limit)


def list_facet(rows: DataFrame, values: Column, position: str, limit: int | None = 20) -> DataFrame:
    """value_facet over the elements of an array; a row counts once for every element.

    Ties are broken by the first row and then by the element's place in it.
    """
    each = rows.select(F.col(position).alias("p"), F.posexplode(values).alias("i", "key")).where("key is not null and key != ''")
    counted = each.groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct("p", "i")).alias("first_pos"))
    return _ranked(counted, limit)
