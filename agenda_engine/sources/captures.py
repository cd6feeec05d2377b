"""Captured inputs: raw capture files, the catalogue of sources, rotation state."""

from __future__ import annotations

import json
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agenda_engine.functions import clock

ITEM = """struct<source_id:string,source_name:string,source_url:string,item_url:string,text:string,title:string,published_at:string,region_hint:string,
city_hint:string,source_class:string,tier:int,source_icon_url:string,image_urls:array<string>,video_url:string,video_thumbnail_url:string,video_type:string,
facebook_event_url:string,external_links:array<string>,structured_data:string>"""
CAPTURE = f"scraped_at string, results map<string,struct<items:array<{ITEM}>,error:string>>, _corrupt_record string"


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The content of capture files in one scan, with the place of each file in the list: of a path that is given twice the last."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def named(path: Column) -> Column:
        return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")

    places = [(str(make(p).getFileSystem(conf).makeQualified(make(p)).toUri().toString()), i, p) for i, p in enumerate(paths)]
    order = spark.createDataFrame(places, "uri string, file int, path string").groupBy(named(F.col("uri")).alias("uri")).agg(F.max(F.struct("file", "path")).alias("f")).select("uri", "f.*")
    content = spark.read.schema(CAPTURE).option("multiLine", True).option("mode", "PERMISSIVE").json(paths)
    return content.select(named(F.col("_metadata.file_path")).alias("uri"), "results", "_corrupt_record").join(order, "uri").drop("uri")


def read_captures(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_id, items, error) of several capture files: of a source in two files the later one counts, unreadable files are left out (see rejected)."""
    if not paths:
        return spark.createDataFrame([], f"source_id string, items array<{ITEM}>, error string")
    named_ = _read(spark, paths).where("results is not null").select("file", F.explode("results").alias("source_id", "r"))
    last = Window.partitionBy("source_id").orderBy(F.col("file").desc())
    return named_.withColumn("n", F.row_number().over(last)).where("n = 1").select("source_id", "r.items", "r.error")


def rejected(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, path) of the capture files that hold no results that can be read."""
    return _read(spark, paths).groupBy("file", "path").agg(F.bool_or(F.col("results").isNotNull()).alias("read")).where("not read").select("file", "path")


def items(captures: DataFrame) -> DataFrame:
    """One row for each captured item, with its place in its source."""
    return captures.select("source_id", F.posexplode("items").alias("item_no", "item")).select(F.col("source_id").alias("captured_from"), "item_no", "item.*")


def read_config(spark: SparkSession, path: str) -> dict:
    """The document of settings and sources, a YAML or JSON file: configuration, so it is small and read on the driver."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue of sources from a YAML or JSON file, with the place of each in it."""
    columns = "id string, name string, type string, source_class string, tier int, url string, region string, city string, icon_url string, parser string, max_items int, max_salas int, follow_links boolean"
    names = [c.split()[0] for c in columns.split(", ")]
    listed = read_config(spark, path).get("sources") or []
    return spark.createDataFrame([(*(s.get(n) for n in names), i) for i, s in enumerate(listed)], columns + ", place int")


def source_status(error: Column) -> Column:
    """ok, skipped, blocked or error, by the text of an error."""
    text = F.lower(error)
    return (
        F.when(F.coalesce(error, F.lit("")) == "", "ok").when(text.startswith("omitida"), "skipped")
        .when(text.contains("bloque") | text.contains("ocult") | text.contains("blocked"), "blocked").otherwise("error")
    )


def source_rows(sources: DataFrame, captures: DataFrame) -> DataFrame:
    """Every source of the catalogue with what was captured of it; one that is absent was skipped."""
    met = sources.join(captures, sources["id"] == captures["source_id"], "left")
    status = F.when(F.col("source_id").isNull(), "skipped").otherwise(source_status(F.col("error")))
    return met.select(sources["*"], status.alias("status"), F.coalesce(F.size("items"), F.lit(0)).alias("items_raw"), "error")


def source_counts(sources: DataFrame, captures: DataFrame, analysis: DataFrame, samples: int = 3) -> DataFrame:
    """What became of every source: status, items, events, rejects, its first icon, and samples of its first rejects.

    analysis: analysed items with captured_from and item_no. A source that was not captured was skipped.
    """
    told = F.struct("item_no", "reason", "score", "category", F.col("item_url").alias("url"), (F.size("image_urls") > 0).alias("has_image"), F.substring(_compact(F.col("text")), 1, 400).alias("text_preview"))
    icon = F.coalesce("source_icon_url", F.lit("")) != ""
    counted = analysis.groupBy("captured_from").agg(
        F.count(F.lit(1)).alias("raw_items"), F.count_if("accepted").alias("events"), F.min_by("source_icon_url", F.when(icon, F.col("item_no"))).alias("seen_icon")
    )
    first = analysis.where("not accepted").withColumn("n", F.row_number().over(Window.partitionBy("captured_from").orderBy("item_no"))).where(F.col("n") <= samples)
    rejects = first.groupBy("captured_from").agg(F.sort_array(F.collect_list(told)).alias("r")).select("captured_from", F.transform("r", lambda x: x.dropFields("item_no")).alias("rejected_samples"))
    met = sources.join(captures.select("source_id", "error"), sources["id"] == F.col("source_id"), "left").join(counted, sources["id"] == counted["captured_from"], "left").drop("captured_from")
    met = met.join(rejects, sources["id"] == rejects["captured_from"], "left").drop("captured_from")
    raw, events = F.coalesce("raw_items", F.lit(0)), F.coalesce("events", F.lit(0))
    return met.select(
        *(sources[c] for c in ("id", "name", "url", "type", "source_class", "tier", "region", "city")), F.coalesce("seen_icon", sources["icon_url"]).alias("icon_url"),
        F.when(F.col("source_id").isNull(), "skipped").otherwise(source_status(F.col("error"))).alias("status"), raw.alias("raw_items"), events.alias("events"), (raw - events).alias("rejected"),
        "rejected_samples", F.when(F.coalesce("error", F.lit("")) != "", F.substring(_compact(F.col("error")), 1, 500)).alias("error"),
    )


def _compact(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


ROTATION = "struct<ultimo_intento:string,ultimo_exito:string,ultimo_estado:string,fallos_seguidos:int,bloqueos:int,ultimo_bloqueo:string,exitos:int,ultimo_error:string>"


def read_rotation(spark: SparkSession, path: str) -> DataFrame:
    """The rotation as operators use it, from its published JSON file; none where the file is missing or no such document."""
    schema = f"actualizado string, fuentes map<string,{ROTATION}>"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    files = spark.read.schema(schema).option("multiLine", True).json(path) if there else spark.createDataFrame([], schema)
    each = files.where("fuentes is not null").select(F.explode("fuentes").alias("source_id", "s"))

    def moment(name: str) -> Column:
        return clock.local_moment(F.col(f"s.{name}"), -240)

    return each.select(
        "source_id", moment("ultimo_intento").alias("last_try"), moment("ultimo_exito").alias("last_success"), F.col("s.ultimo_estado").alias("state"), F.coalesce("s.fallos_seguidos", F.lit(0)).alias("failures"),
        F.coalesce("s.bloqueos", F.lit(0)).alias("blocks"), moment("ultimo_bloqueo").alias("last_block"), F.coalesce("s.exitos", F.lit(0)).alias("successes"), F.col("s.ultimo_error").alias("last_error"),
    )
