"""What a catalogue serves: labels, scores, sections, coverage and the compact projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.operators.facets import list_facet, value_facet

# Fixed values of the published format.
PRICE_KEYS = ("gratis", "pagado", "por_confirmar")
MEDIA_KEYS = ("con_foto", "con_video")
WHEN_KEYS = ("hoy", "esta_semana", "este_mes", "todos")
SECTIONS = ("today", "tomorrow", "this_weekend", "free", "featured")
QUALITY_POINTS = {
    "starts_at": 24, "has_image": 14, "venue": 10, "source_tier_1": 9, "price": 8, "corroborated": 8, "has_video": 7,
    "city": 6, "source_tier_2": 5, "organizer": 5, "showtimes": 5, "formats": 2, "address": 2,
}
FEATURED_SCORE = 65
CATEGORY_LABELS = {
    "concierto": "Conciertos", "festival": "Festivales", "feria": "Ferias y expos", "teatro": "Teatro", "danza": "Danza", "deporte": "Deportes", "gastronomia": "Gastronomía", "cine": "Cine",
    "exposicion": "Exposiciones", "literatura": "Literatura y libros", "turismo": "Turismo y patrimonio", "conferencia": "Conferencias", "taller": "Talleres y cursos", "infantil": "Para niños",
    "religioso": "Religiosos", "nightlife": "Vida nocturna", "moda": "Moda", "tecnologia": "Tecnología", "otro": "Otros",
}
LIFECYCLE_LABELS = {"hoy": "Hoy", "en_curso": "En curso", "proximo": "Próximos", "finalizado": "Finalizados", "sin_fecha": "Sin fecha confirmada"}
PRICE_LABELS = {"gratis": "Gratis", "pagado": "Con entrada", "por_confirmar": "Precio por confirmar"}
MEDIA_LABELS = {"con_foto": "Con foto", "con_video": "Con video"}
TAGS = 24
SCHEMA_VERSION = "1.1"
CSV_COLUMNS = (
    "event_id", "title", "category", "starts_at", "display_date", "lifecycle", "days_until", "department", "city", "venue", "address", "is_free",
    "price_from", "price_to", "price_label", "status", "confidence", "source_count", "image_url", "video_url", "url", "ticket_urls",
)
LITE_COLUMNS = (
    "event_id", "title", "category", "category_label", "starts_at", "starts_at_ms", "ends_at_ms", "multi_day", "display_date",
    "lifecycle", "lifecycle_label", "days_until", "is_upcoming", "city", "department", "venue", "image_url", "has_video",
    "video_thumbnail_url", "is_free", "price_from", "currency", "price_label", "organizer", "showtimes", "formats", "occurrences",
    "content_genre", "duration_minutes", "age_restriction", "director", "cast", "quality_score", "is_featured", "status", "source_count",
)


def present(column: str | Column) -> Column:
    """True for a text that is not empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c != "", F.lit(False))


def _true(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False))


def _counted(rows: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One row for each key from one pass of conditional counts, in the order given."""
    one = rows.agg(*(F.count_if(c).alias(k) for k, c in counts.items()))
    parts = (F.struct(F.lit(i).alias("position"), F.lit(k).alias("key"), F.col(k).alias("count")) for i, k in enumerate(counts))
    return one.select(F.inline(F.array(*parts)))


def price_facet(rows: DataFrame) -> DataFrame:
    """Free, paid and unknown prices; each row counts once."""
    free, paid = _true("is_free"), F.col("price_from").isNotNull()
    return _counted(rows, dict(zip(PRICE_KEYS, (free, ~free & paid, ~free & ~paid), strict=True)))


def media_facet(rows: DataFrame) -> DataFrame:
    """Rows with a photo and with a video."""
    return _counted(rows, dict(zip(MEDIA_KEYS, (_true("has_image"), _true("has_video")), strict=True)))


def _span(starts: str, ends: str) -> tuple[Column, Column]:
    first = F.to_date(starts)
    return first, F.coalesce(F.to_date(ends), first)


def time_facet(rows: DataFrame, now: str, starts: str = "starts", ends: str = "ends") -> DataFrame:
    """Overlapping buckets: today, the next seven days, the next thirty, and all."""
    first, last = _span(starts, ends)
    today = F.to_date(clock.moment(now))
    within = [(first <= F.date_add(today, n)) & (last >= today) for n in (0, 7, 30)]
    return _counted(rows, dict(zip(WHEN_KEYS, (*within, F.lit(True)), strict=True)))


def summary(rows: DataFrame) -> DataFrame:
    """The counts of a catalogue's head, in one pass."""
    shown = _true("is_upcoming")
    return rows.agg(
        F.count(F.lit(1)).alias("events_total"),
        F.count_if(shown).alias("events_upcoming"),
        *(F.count_if(shown & F.col("lifecycle").eqNullSafe(k)).alias(f"events_{k}") for k in ("hoy", "en_curso", "proximo", "sin_fecha")),
        F.count_if(F.col("lifecycle").eqNullSafe("finalizado")).alias("events_finalizado"),
        F.count_if(shown & _true("is_free")).alias("events_free"),
        F.count_if(shown & _true("has_image")).alias("events_with_image"),
        F.count_if(shown & _true("has_video")).alias("events_with_video"),
    )


def summary_of_run(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The fourteen counts of a published catalogue, one row: events shown, and sources by status."""
    up = _true("is_upcoming")
    events = rows.agg(
        F.count(F.lit(1)).alias("events_total"), F.count_if(up).alias("events_upcoming"), F.count_if(F.col("lifecycle").eqNullSafe("hoy")).alias("events_today"),
        F.count_if(present("starts_at")).alias("events_with_date"), F.count_if(up & _true("is_free")).alias("events_free"), F.count_if(_true("has_image")).alias("events_with_image"),
        F.count_if(_true("has_video")).alias("events_with_video"), F.count_if(_true("corroborated")).alias("events_corroborated"), F.count_if(_true("seen_this_run")).alias("events_seen_this_run"),
    )
    states = (F.count_if(F.col("status").eqNullSafe(s)).alias(f"sources_{s}") for s in ("ok", "blocked", "error", "skipped"))
    both = events.unionByName(sources.agg(F.count(F.lit(1)).alias("sources_total"), *states), allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def facets(rows: DataFrame, now: str, position: str = "position", starts: str = "starts", ends: str = "ends") -> DataFrame:
    """(facet, place, key, label, count): every filter of a published catalogue, over its upcoming rows."""
    up = rows.where(_true("is_upcoming"))

    def placed(name: str, found: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
        order = Window.orderBy(F.col("count").desc(), "first_pos")  # as many rows as the facet has values
        return found.select(F.lit(name).alias("facet"), (F.row_number().over(order) - 1).alias("place"), "key", label(F.col("key"), labels or {}, F.col("key")).alias("label"), "count")

    def fixed(name: str, found: DataFrame, labels: dict[str, str]) -> DataFrame:
        return found.select(F.lit(name).alias("facet"), F.col("position").alias("place"), "key", label(F.col("key"), labels, F.col("key")).alias("label"), "count")

    values = {"categories": "category", "cities": "city", "departments": "department", "source_classes": "source_class"}
    parts = [placed(n, value_facet(up, c, position), CATEGORY_LABELS if c == "category" else None) for n, c in values.items()]
    parts.append(placed("tags", list_facet(up, F.col("tags"), position, TAGS)))
    parts += [fixed("when", time_facet(up, now, starts, ends), {}), fixed("price", price_facet(up), PRICE_LABELS), fixed("media", media_facet(up), MEDIA_LABELS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def label(key: Column, labels: dict[str, str], other: Column) -> Column:
    """The label of a key, or something else."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in labels.items() for x in pair)), key), other) if labels else other


def sections(rows: DataFrame, now: str, position: str = "position", starts: str = "starts", ends: str = "ends") -> DataFrame:
    """(section, position, event_id) of upcoming rows: five overlapping lists, in catalogue order.

    Lists stay rows, so a section of any length never has to fit one task.
    """
    first, last = _span(starts, ends)
    today = F.to_date(clock.moment(now))
    saturday, sunday = clock.weekend(clock.moment(now))
    tomorrow = F.date_add(today, 1)
    holds = (
        (first <= today) & (last >= today), (first <= tomorrow) & (last >= tomorrow), (first <= sunday) & (last >= saturday),
        _true("is_free"), _true("is_featured"),
    )
    named = F.array_compact(F.array(*(F.when(c, F.lit(s)) for s, c in zip(SECTIONS, holds, strict=True))))
    upcoming = rows.where(_true("is_upcoming") & F.col("event_id").isNotNull())
    return upcoming.select(F.explode(named).alias("section"), F.col(position).alias("position"), "event_id")


def coverage(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Four counts for every row of a dimension, zero where there is no event."""
    up = _true("is_upcoming")
    counts = {"events_total": F.lit(True), "events_upcoming": up, "events_with_image": up & _true("has_image"), "events_with_video": up & _true("has_video")}
    got = rows.groupBy(key).agg(*(F.count_if(c).alias(k) for k, c in counts.items()))
    return keys.select(key).join(got, key, "left").select(key, *(F.coalesce(k, F.lit(0)).alias(k) for k in counts))


def department_coverage(rows: DataFrame, sources: DataFrame, departments: DataFrame, key: str = "department") -> DataFrame:
    """Six counts for every department: events, and the sources of that region."""
    told = source_coverage(sources.withColumnRenamed("region", key), departments, key)
    return coverage(rows, departments, key).join(told, key)


def category_coverage(rows: DataFrame) -> DataFrame:
    """Label and four counts of every category that occurs."""
    held = rows.where(present("category"))
    return coverage(held, held.select("category").distinct(), "category").withColumn("label", label(F.col("category"), CATEGORY_LABELS, F.col("category")))


def source_coverage(sources: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Sources and sources in order for every row of a dimension."""
    got = sources.groupBy(key).agg(F.count(F.lit(1)).alias("sources_total"), F.count_if(F.col("status").eqNullSafe("ok")).alias("sources_ok"))
    return keys.select(key).join(got, key, "left").na.fill(0, ["sources_total", "sources_ok"])


def quality_score() -> Column:
    """How useful a card is, 0 to 100, from what it has; needs the columns of a served event."""
    any_price = _true("is_free") | F.col("price_from").isNotNull() | (F.coalesce(F.size("ticket_urls"), F.lit(0)) > 0)
    has = {
        "starts_at": present("starts_at"), "has_image": _true("has_image"), "venue": present("venue"), "source_tier_1": F.col("source_tier").eqNullSafe(1),
        "price": any_price, "corroborated": _true("corroborated"), "has_video": _true("has_video"), "city": present("city"),
        "source_tier_2": F.col("source_tier").eqNullSafe(2), "organizer": present("organizer"),
        "showtimes": (F.coalesce(F.size("showtimes"), F.lit(0)) > 0) | (F.coalesce(F.size("occurrences"), F.lit(0)) > 0),
        "formats": F.coalesce(F.size("formats"), F.lit(0)) > 0, "address": present("address") | present("location_query"),
    }
    return sum((F.when(c, F.lit(QUALITY_POINTS[k])).otherwise(0) for k, c in has.items()), F.lit(0))


def featured(score: Column) -> Column:
    """Upcoming, neither cancelled nor postponed, and useful enough."""
    off = F.coalesce(F.col("status").isin("cancelado", "postergado"), F.lit(False))
    return _true("is_upcoming") & ~off & (score >= FEATURED_SCORE)


def amount(value: Column) -> Column:
    """A price as text, without decimals where it has none."""
    return F.when(value == F.floor(value), value.cast("long").cast("string")).otherwise(value.cast("string"))


def price_label(is_free: Column, low: Column, high: Column) -> Column:
    """'Entrada libre', 'Bs 80', 'Bs 80 - 120', or null."""
    ranged = F.coalesce((high != 0) & (high != low), F.lit(False))
    return (
        F.when(F.coalesce(is_free, F.lit(False)), "Entrada libre")
        .when(low.isNull(), F.lit(None))
        .when(ranged, F.concat(F.lit("Bs "), amount(low), F.lit(" - "), amount(high)))
        .otherwise(F.concat(F.lit("Bs "), amount(low)))
    )


def enriched(rows: DataFrame) -> DataFrame:
    """Adds labels, quality score, featured mark and price label to catalogue rows, which then have every column of the compact form."""
    lists = ("showtimes", "formats", "occurrences", "cast", "ticket_urls")
    texts = ("organizer", "content_genre", "director", "age_restriction", "video_thumbnail_url", "address", "location_query", "venue", "starts_at", "city")
    has = set(rows.columns)
    step = rows.withColumns(
        {c: F.coalesce(F.col(c) if c in has else F.lit(None).cast("array<string>"), F.array().cast("array<string>")) for c in lists}
        | {c: F.lit(None).cast("string") for c in texts if c not in has} | {c: F.lit(None).cast(k) for c, k in (("duration_minutes", "int"), ("corroborated", "boolean")) if c not in has}
        | ({} if "is_upcoming" in has else {"is_upcoming": F.col("lifecycle").isin("proximo", "hoy", "en_curso")})
    )
    step = step.withColumns({
        "category_label": label(F.coalesce("category", F.lit("otro")), CATEGORY_LABELS, F.lit("Otros")), "quality_score": quality_score(),
        "lifecycle_label": label(F.coalesce("lifecycle", F.lit("sin_fecha")), LIFECYCLE_LABELS, F.lit("Sin fecha confirmada")),
        "price_label": price_label(F.col("is_free"), F.col("price_from"), F.col("price_to")),
    })
    return step.withColumn("is_featured", featured(F.col("quality_score")))


def lite(rows: DataFrame, *more: str) -> DataFrame:
    """The compact columns of upcoming rows, and further ones; columns that a catalogue lacks come as nulls."""
    return rows.where(_true("is_upcoming")).select(*(F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in (*LITE_COLUMNS, *more)))
