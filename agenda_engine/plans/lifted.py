"""The test tables lifted into catalogue shapes, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "1997-06-14 10:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables, lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events: from the order's day to the last shipment, in the customer's nation."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    spans = items.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n_items"))
    homes = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    met = orders.join(spans, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
    key = F.col("o_orderkey")
    return met.select(
        key.alias("position"), key.alias("event_id"), F.col("o_orderdate").alias("starts"), F.when(F.col("last_ship") > F.col("o_orderdate"), F.col("last_ship")).alias("ends"),
        F.col("o_orderpriority").alias("category"), F.col("n_name").alias("department"), F.col("c_mktsegment").alias("city"), (F.col("o_orderstatus") == "F").alias("is_free"),
        F.when(key % 3 != 0, F.col("o_totalprice")).alias("price_from"), F.when(key % 6 == 1, F.col("o_totalprice") * 2).alias("price_to"),
        (key % 2 == 0).alias("has_image"), (key % 5 == 0).alias("has_video"),
        (key % 3 + 1).cast("int").alias("source_tier"), F.when(key % 7 == 0, "cancelado").when(key % 11 == 0, "postergado").otherwise("programado").alias("status"), F.col("n_items"),
    )


CATALOGUE = """
WITH spans AS (SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n_items FROM lineitem GROUP BY l_orderkey), cat AS (
  SELECT o_orderkey AS position, o_orderkey AS event_id, o_orderdate AS starts, CASE WHEN last_ship > o_orderdate THEN last_ship END AS ends,
    o_orderpriority AS category, n_name AS department, c_mktsegment AS city, o_orderstatus = 'F' AS is_free,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price_from, CASE WHEN o_orderkey % 6 = 1 THEN o_totalprice * 2 END AS price_to,
    o_orderkey % 2 = 0 AS has_image, o_orderkey % 5 = 0 AS has_video, (o_orderkey % 3 + 1)::INTEGER AS source_tier,
    CASE WHEN o_orderkey % 7 = 0 THEN 'cancelado' WHEN o_orderkey % 11 = 0 THEN 'postergado' ELSE 'programado' END AS status, n_items
  FROM orders LEFT JOIN spans ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
), life AS (
  SELECT *, CASE WHEN starts IS NULL THEN 'sin_fecha' WHEN starts <= TIMESTAMP '1997-06-14 10:00:00' AND TIMESTAMP '1997-06-14 10:00:00' <= ends THEN 'en_curso'
    WHEN starts::DATE = DATE '1997-06-14' THEN 'hoy' WHEN starts > TIMESTAMP '1997-06-14 10:00:00' THEN 'proximo' ELSE 'finalizado' END AS lifecycle,
    (starts::DATE - DATE '1997-06-14')::INTEGER AS days_until FROM cat
), up AS (
  SELECT *, lifecycle IN ('proximo', 'hoy', 'en_curso') AS is_upcoming, coalesce(ends::DATE, starts::DATE) AS last_day FROM life
)
"""


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with lifecycle, days_until and is_upcoming at NOW."""
    from agenda_engine.functions import clock

    now = clock.moment(NOW)
    rows = catalogue(spark, sf_dir).withColumns({"lifecycle": clock.lifecycle(F.col("starts"), F.col("ends"), now), "days_until": clock.days_until(F.col("starts"), now)})
    return rows.withColumn("is_upcoming", F.col("lifecycle").isin("proximo", "hoy", "en_curso"))
