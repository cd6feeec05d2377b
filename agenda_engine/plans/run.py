"""A run from end to end: configuration, captures and pages in; a new version of the catalogue, the rotation and the published files out.

`python -m agenda_engine.plans.run --config sources.yaml --captures a.json,b.json --out folder --at '2026-08-14 10:00:00'` does one;
with --plan it prints the turns of the next wave instead.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.functions.durable import cut, scratch
from agenda_engine.functions.gazetteer import DEPARTMENTS
from agenda_engine.operators import catalogue, events, posts, resolve, rotation, serving, state
from agenda_engine.operators.order import ranks
from agenda_engine.sources import captures, sinks, sites

# Fixed values of the published format.
SOCIAL = "facebook_public"
UI_GROUPS = (
    ("when", "Cuándo", "single", "calendar"), ("categories", "Tipo de evento", "multi", "category"), ("departments", "Departamento", "multi", "map"),
    ("cities", "Ciudad", "multi", "location_city"), ("price", "Precio", "single", "payments"), ("media", "Multimedia", "multi", "photo_library"), ("tags", "Temas", "multi", "sell"),
)
FILTERS = ("categories", "cities", "departments", "when", "price", "media", "tags", "source_classes")
#: Filters whose number of values has a bound by construction.
FEW = ("categories", "when", "price", "media", "tags")
REACH = {"fuentes_totales": "sources_total", "con_datos_alguna_vez": "seen_ever", "horas_promedio_sin_datos": "hours_mean", "horas_maximo_sin_datos": "hours_max"}
UNREACHED = {"nunca_vistas": "never_seen", "bloqueadas_en_la_ultima_corrida": "blocked_last_time", "con_fallos_persistentes": "failing"}
#: The files of a run in its folder; the last two are its memory.
FULL, LITE, STATUS, TABLE, ROTATION, VERSIONS = "catalogue.json", "catalogue_lite.json", "sources.json", "catalogue.csv", "_state/rotation.json", "_state/catalogue"


@dataclass(frozen=True)
class Settings:
    """What a run may be told; the defaults are those of a configuration that says nothing."""

    zone: str = "America/La_Paz"
    threshold: float = resolve.THRESHOLD
    archive_threshold: float = state.THRESHOLD
    keep_days: int = state.KEEP_DAYS
    samples: int = 3
    show_finished: bool = True
    cap: int | None = state.CAP

    @classmethod
    def of(cls, config: dict) -> Settings:
        """The settings of a configuration document; what it does not name keeps its default, other names are passed over."""
        names = {
            "timezone": ("zone", str), "umbral_fusion": ("threshold", float), "umbral_historial": ("archive_threshold", float), "conservar_pasados_dias": ("keep_days", int),
            "max_muestras_rechazadas": ("samples", int), "incluir_finalizados": ("show_finished", bool),
        }
        said = config.get("settings") or {}
        return cls(**{to: kind(said[k]) for k, (to, kind) in names.items() if said.get(k) is not None})


def page_captures(pages: DataFrame, sources: DataFrame, at: str) -> DataFrame:
    """The items of captured pages as captured items, with what their source says of itself."""
    own = sources.select(
        F.col("id").alias("source_id"), F.col("name").alias("source_name"), F.col("url").alias("source_url"), F.col("region").alias("region_hint"), F.col("city").alias("city_hint"), "source_class", "tier"
    )
    read = sites.read_all(pages, sources, at.replace(" ", "T"))
    return read.join(own, "source_id").withColumn("captured_from", F.col("source_id"))


def gathered(sources: DataFrame, results: DataFrame, pages: DataFrame | None, at: str) -> tuple[DataFrame, DataFrame]:
    """(source_id, error, n_items) of every source that was captured, and the items in catalogue order, with a position each.

    Results of sources that are not in the catalogue are left out; pages of a source go before its results. A social source is not read from pages.
    """
    told = cut(posts.results_of(results, sources))
    turns, found = told.select("source_id", "error", F.coalesce(F.size("items"), F.lit(0)).alias("n_items")), captures.items(told)
    if pages is not None:
        read_from = sources.where(F.col("type") != SOCIAL)
        held = pages.join(read_from.select(F.col("id").alias("source_id")), "source_id", "left_semi")
        seen = held.select("source_id").distinct()
        of_pages = cut(page_captures(held, read_from, at))
        counted = of_pages.groupBy("captured_from").agg(F.count(F.lit(1)).cast("int").alias("n_items"))
        met = seen.join(counted, F.col("source_id") == F.col("captured_from"), "left").select("source_id", F.lit(None).cast("string").alias("error"), F.coalesce("n_items", F.lit(0)).alias("n_items"))
        turns = turns.join(seen, "source_id", "left_anti").unionByName(met)
        found = found.join(seen.withColumnRenamed("source_id", "captured_from"), "captured_from", "left_anti").unionByName(of_pages, allowMissingColumns=True)
    placed = found.join(sources.select(F.col("id").alias("captured_from"), "place"), "captured_from")
    order = [F.col("place"), F.col("captured_from"), F.col("item_no")]
    return cut(turns), ranks(placed, order, name="position").drop("place")


def reach(sources: DataFrame, turns: DataFrame, at: str, ids: DataFrame) -> dict:
    """How much of the social sources is being reached, as the document tells it. turns: the rotation; ids: its lists as rows, with a rank in each."""
    one = rotation.coverage(sources, turns, at).select(*REACH.values()).first()
    lists = {name: (ids.where(F.col("list") == kind).select("rank", F.col("source_id").alias("value")), None) for name, kind in UNREACHED.items()}
    return {name: one[c] for name, c in REACH.items()} | lists


def document(shown: DataFrame, status: DataFrame, coverage: dict, at: str, settings: Settings) -> dict:
    """The published catalogue as one document for sinks.write_payload. shown: catalogue rows with their rank; status: sources with their rank.

    Values that are few by construction (counts, categories, departments) are collected; every list that grows with the catalogue stays a table.
    """
    found = cut(serving.facets(shown, at, "rank", "starts_at", "ends_at"))
    lists = cut(serving.sections(shown, at, "rank", "starts_at", "ends_at"))

    few: dict[str, list] = {name: [] for name in FEW}
    for r in found.where(F.col("facet").isin(*FEW)).orderBy("facet", "place").collect():
        few[r.facet].append({"key": r.key, "label": r.label, "count": r["count"]})

    def filtered(name: str) -> list | tuple:
        if name in FEW:
            return few[name]
        return found.where(F.col("facet") == name).select(F.col("place").alias("rank"), "key", "label", "count"), None

    def listed(name: str) -> tuple:
        return lists.where(F.col("section") == name).select(F.col("position").alias("rank"), F.col("event_id").alias("value")), None

    def by(rows: DataFrame, key: str) -> dict:
        return {r.pop(key): r for r in (x.asDict() for x in rows.collect())}

    departments = shown.sparkSession.createDataFrame([(d,) for d in DEPARTMENTS], "department string")
    covered = by(serving.department_coverage(shown, status, departments), "department")
    return {
        "schema_version": serving.SCHEMA_VERSION, "generated_at": catalogue.stamped(at), "timezone": settings.zone, "summary": serving.summary_of_run(shown, status).first().asDict(),
        "filters": {"ui_groups": [dict(zip(("key", "label", "selection", "icon"), g, strict=True)) for g in UI_GROUPS]} | {name: filtered(name) for name in FILTERS},
        "sections": {name: listed(name) for name in serving.SECTIONS}, "coverage_by_department": {d: covered[d] for d in DEPARTMENTS},
        "coverage_by_category": dict(sorted(by(serving.category_coverage(shown), "category").items())), "coverage": coverage,
        "events": (shown.drop("position"), None), "sources": (status, None),
    }


def lite_document(full: dict, shown: DataFrame) -> dict:
    """The compact document beside a full one: upcoming events alone, with the columns of a list of cards."""
    up = shown.where("is_upcoming")
    counts = up.agg(F.count(F.lit(1)).alias("events_total"), F.count_if(F.col("lifecycle") == "hoy").alias("events_today")).first().asDict()
    shared = {k: full[k] for k in ("schema_version", "generated_at", "timezone")}
    more = {k: full[k] for k in ("filters", "sections", "coverage_by_department", "coverage_by_category")}
    return shared | {"summary": counts} | more | {"events": (serving.lite(shown, "rank"), None)}


def publish(spark: SparkSession, sources: DataFrame, results: DataFrame, folder: str, at: str, pages: DataFrame | None = None, settings: Settings = Settings()) -> dict:
    """One run: names a new version of the catalogue in `folder`, updates the rotation and writes the four published files; returns the summary.

    sources: as of captures.read_sources, with place; results: as of captures.read_captures; pages: source_id, url, html, is_root. `at` is the wall clock of the
    run. Memory goes first and files after it, each file under its name when it is whole, so a run that is lost part way leaves the last files as they were
    and is done again. Where no social source had a turn the rotation that is kept counts for coverage.
    """
    base = folder.rstrip("/")
    with scratch(spark):
        sources = cut(sources)
        turns, items = gathered(sources, results, pages, at)
        social = sources.where(F.col("type") == SOCIAL)
        outcomes = posts.results_of(turns, social)
        kept = cut(rotation.update(captures.read_rotation(spark, f"{base}/{ROTATION}"), outcomes, at))
        sinks.write_rotation(kept, catalogue.stamped(at), f"{base}/{ROTATION}")

        analysis = events.analysed(items, at)
        made = events.events_of(analysis, catalogue.stamped(at), at, ["position"])
        archive = sinks.current_snapshot(spark, f"{base}/{VERSIONS}") if sinks.has_snapshot(spark, f"{base}/{VERSIONS}") else None
        built = catalogue.settled(made, archive, at, settings.threshold, settings.keep_days, settings.cap, settings.archive_threshold)
        version = spark.read.parquet(sinks.write_snapshot(built, f"{base}/{VERSIONS}"))

        order = [F.col("starts_at").asc_nulls_last(), F.coalesce("confidence", F.lit(0.0)).desc(), F.col("position")]
        shown = cut(ranks(version if settings.show_finished else version.where("is_upcoming"), order))
        counted = captures.source_counts(sources, turns, analysis, settings.samples)
        samples = F.coalesce("rejected_samples", F.array().cast(counted.schema["rejected_samples"].dataType))
        status = cut(counted.join(sources.select("id", F.col("place").alias("rank")), "id").withColumn("rejected_samples", samples))
        asked = social.select(F.col("id").alias("source_id"))
        coverage = reach(asked, kept, at, cut(ranks(rotation.unreached(asked, kept), [F.col("source_id")], ("list",)))) if not social.isEmpty() else {}

        full = document(shown, status, coverage, at, settings)
        sinks.write_payload(f"{base}/{FULL}", full, spark)
        sinks.write_payload(f"{base}/{LITE}", lite_document(full, shown), spark)
        sinks.write_payload(f"{base}/{STATUS}", {k: full[k] for k in ("generated_at", "coverage", "sources")}, spark)
        sinks.write_csv_file(shown, list(serving.CSV_COLUMNS), [F.col("rank")], f"{base}/{TABLE}")
        return full["summary"]


def planned(spark: SparkSession, sources: DataFrame, folder: str, at: str, size: int = 1, groups: int = 8, alone: int = 8) -> str:
    """The turns of the next wave of social sources as one line of JSON, by what the rotation in `folder` knows."""
    known = captures.read_rotation(spark, f"{folder.rstrip('/')}/{ROTATION}")
    met = sources.where(F.col("type") == SOCIAL).select(F.col("id").alias("source_id"), "source_class", "tier").join(known, "source_id", "left")
    score = rotation.priority(F.col("last_success"), F.col("source_class"), F.coalesce("tier", F.lit(3)), F.col("failures"), clock.moment(at))
    return rotation.wave_matrix(rotation.plan_wave(met.withColumn("score", score), size=size, groups=groups, alone=alone)).first()["matrix"]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """The command."""
    told = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    told.add_argument("--config", required=True, help="settings and sources, YAML or JSON")
    told.add_argument("--out", required=True, help="folder of the published files and of the memory of runs")
    told.add_argument("--at", required=True, help="wall clock of the run, 'YYYY-MM-DD HH:MM:SS'")
    told.add_argument("--captures", default="", help="capture files, joined by commas; the later one counts")
    told.add_argument("--pages", help="table of captured pages, Parquet")
    told.add_argument("--only", help="ids of sources, joined by commas")
    told.add_argument("--without-social", action="store_true", help="leave the social sources out")
    told.add_argument("--plan", action="store_true", help="print the next wave and do nothing else")
    told.add_argument("--group-size", type=int, default=1)
    told.add_argument("--groups", type=int, default=8)
    told.add_argument("--alone", type=int, default=8)
    a = told.parse_args(argv)
    spark = spark or SparkSession.builder.appName("run").getOrCreate()
    sources = posts.of_sources(captures.read_sources(spark, a.config), [s.strip() for s in a.only.split(",") if s.strip()] if a.only else None)
    if a.plan:
        print("matriz=" + planned(spark, sources, a.out, a.at, a.group_size, a.groups, a.alone))
        return
    sources = sources.where(F.col("type") != SOCIAL) if a.without_social else sources
    results = captures.read_captures(spark, [p.strip() for p in a.captures.split(",") if p.strip()])
    summary = publish(spark, sources, results, a.out, a.at, spark.read.parquet(a.pages) if a.pages else None, Settings.of(captures.read_config(spark, a.config)))
    print("\n".join(f"{k}: {v}" for k, v in summary.items()))


if __name__ == "__main__":
    main()
