"""From captured items to events: one analysis of each item, the accept rule, and the event with all its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.functions.durable import cut, dealt, in_small_methods
from agenda_engine.functions.free_dates import free_moment
from agenda_engine.functions.text import compatible, fold
from agenda_engine.operators import dates, extraction, places
from agenda_engine.operators.resolve import video

#: What structured sources state, as JSON in an item's structured_data.
STRUCTURED = (
    "starts_at string, ends_at string, all_day boolean, doors_time string, venue string, address string, city string, department string, latitude double, longitude double, "
    "organizer string, audience string, age_restriction string, duration_minutes int, showtimes array<string>, formats array<string>, occurrences array<string>, content_genre string, "
    "director string, cast array<string>, is_free boolean, price_from double, price_to double, currency string, price_text string, ticket_urls array<string>, phones array<string>"
)
ITEM_TEXTS = (
    "source_id", "source_name", "source_url", "item_url", "text", "title", "published_at", "region_hint", "city_hint", "source_class", "source_icon_url", "video_url",
    "video_thumbnail_url", "video_type", "facebook_event_url", "structured_data",
)
# Fixed values of the published format.
DESCRIPTION, ORIGINAL, UID_TEXT, LONGEST_TITLE, SHORTEST_LINE, OWN_TITLE = 2500, 8000, 400, 120, 12, 10
LINE_NOISE = r"(?U)[^\w\sÁÉÍÓÚÑáéíóúñ¡!¿?'\"().,:&/-]"
OFFSET_MINUTES = -240
PRICE_AROUND = 40
SHORT = "texto_muy_corto"


def whole(items: DataFrame) -> DataFrame:
    """Items with every column that reading them needs; those that are not there come as nulls or empty lists, a tier as 3."""
    has = set(items.columns)
    texts = {c: (F.col(c) if c in has else F.lit(None)).cast("string") for c in ITEM_TEXTS}
    lists = {c: F.coalesce(F.col(c) if c in has else F.lit(None).cast("array<string>"), F.array().cast("array<string>")) for c in ("image_urls", "external_links")}
    rest = [c for c in items.columns if c not in texts and c not in lists and c != "tier"]
    tier = F.coalesce((F.col("tier") if "tier" in has else F.lit(None)).cast("int"), F.lit(3))
    return items.select(*(c.alias(k) for k, c in (texts | lists).items()), tier.alias("tier"), *rest)


def published(said: Column, now: Column) -> Column:
    """When an item was published, as a wall-clock moment: 'hace 2 h', 'ayer', 'hoy', ISO forms, and free forms in English or Spanish; null where nothing dates."""
    plain, form = fold(said), r"\bhace\s+(\d+)\s*(min|minuto|h|hora|d|dia)"
    count, unit = F.regexp_extract(plain, form, 1).try_cast("int"), F.regexp_extract(plain, form, 2)
    minutes = count * F.when(unit == "min", 1).when(unit == "h", 60).otherwise(1440)
    zero = F.lit("yyyy-MM-dd HH:mm:ss")
    ago = F.to_timestamp_ntz(F.date_format(F.timestamp_add("MINUTE", -minutes, now.cast("timestamp")), "yyyy-MM-dd HH:mm:ss"), zero)
    yesterday = now - F.expr("interval 1 day")
    return (
        F.when(plain == "", F.lit(None)).when(unit != "", ago).when(plain.contains("ayer"), yesterday).when(plain.contains("hoy"), now)
        .otherwise(F.coalesce(clock.local_moment(said, OFFSET_MINUTES), free_moment(said, now, OFFSET_MINUTES)))
    )


def price_text(text: Column, is_free: Column, priced: Column) -> Column:
    """The words around the first price, or 'Entrada libre'."""
    pattern = "(?i)" + extraction.PRICE
    at = F.regexp_instr(text, F.lit(pattern))
    start = F.greatest(F.lit(1), at - PRICE_AROUND)
    end = at + F.length(F.regexp_substr(text, F.lit(pattern))) + PRICE_AROUND
    around = F.trim(F.regexp_replace(F.substring(text, start, end - start), r"(?U)\s+", " "))
    return F.when(priced, F.when(at > 0, around)).when(is_free, "Entrada libre")


def title(own: Column, text: Column, category: Column, display_date: Column) -> Column:
    """The item's own title if it says enough, else the first line that does, else one made of category and date; cut at a word."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r\u000B\u000C\u001C-\u001E\u0085\u2028\u2029]"), lambda v: F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(v, LINE_NOISE, " "), r"(?U)\s+", " ")), r"^[ .,;:\-·|]+", ""), r"[ .,;:\-·|]+$", ""))
    line = F.get(F.filter(lines, lambda v: F.length(v) >= SHORTEST_LINE), F.lit(0))
    stated = F.when(F.length(F.trim(own)) > OWN_TITLE, F.trim(own))
    label = F.replace(category, F.lit("_"), F.lit(" "))
    label = F.concat(F.upper(F.substring(label, 1, 1)), F.substring(label, 2, 100))
    made = F.concat(label, F.coalesce(F.concat(F.lit(" · "), display_date), F.lit(" en Bolivia")))
    base = F.coalesce(stated, line, made)
    cut = F.regexp_replace(F.substring(base, 1, LONGEST_TITLE - 3), r" [^ ]*$", "")
    return F.when(F.length(base) > LONGEST_TITLE, F.concat(cut, F.lit("…"))).otherwise(base)


def analysed(items: DataFrame, now: str) -> DataFrame:
    """Adds what an item's text says, its score, reasons, reason and whether it is accepted; the analysis holds for rejected items too.

    items: as captured; columns that are missing count as unsaid. A text under 25 characters is rejected as too short.
    The result is a written table: events, rejects and counts come from one analysis, and no filter on it is
    pushed back through all of its expressions.
    """
    at = clock.moment(now)
    step = whole(dealt(items)).withColumn("text", compatible(F.col("text"))).withColumn("_anchor", F.to_date(F.coalesce(published(F.col("published_at"), at), at)))
    step = extraction.analyse(step.withColumn("_links", F.col("external_links")), extra="_links").drop("_links")
    step = dates.when(step, "plain", "_anchor").withColumnRenamed("confidence", "date_confidence")
    step = places.locate(step, "text", "plain").withColumnsRenamed({c: f"t_{c}" for c in ("venue", "city", "department", "address")})
    dated, none = F.col("starts").isNotNull(), F.lit("")
    cycle = clock.lifecycle(F.col("starts"), F.col("ends"), at)
    upcoming = cycle.isin("proximo", "hoy", "en_curso")
    linked, pictured, placed = F.coalesce("facebook_event_url", none) != "", F.size("image_urls") > 0, F.col("t_venue").isNotNull()
    special = F.coalesce("source_class", none)
    step = step.withColumn("_score", extraction.relevance(dated, upcoming, ~F.col("all_day"), F.col("date_confidence") == "exacta", placed, pictured, linked, special))
    short, usable = F.length("text") < extraction.SHORTEST, dated | linked
    told = [
        F.when(dated, F.when(upcoming, "fecha_futura").otherwise("fecha_pasada")).otherwise("sin_fecha"), F.when(dated & ~F.col("all_day"), "hora_explicita"),
        F.when(F.col("category") != "otro", F.concat(F.lit("categoria_"), "category")), F.when(placed, "sede_detectada"),
        F.when(F.col("price_from").isNotNull() | F.col("is_free"), "informacion_de_entradas"), F.when((F.size("ticket_urls") > 0) | linked, "enlace_de_entradas"),
        F.when(F.col("calls") > 0, "lenguaje_de_convocatoria"), F.when(pictured, "tiene_afiche"), F.when(special.isin(*extraction.SPECIALISED), "fuente_especializada"),
        F.when(F.col("past") > 0, "lenguaje_en_pasado"), F.when(F.col("off_topic") > 0, "tema_no_es_evento"),
    ]
    step = step.withColumns({
        "score": F.when(short, 0).otherwise(F.col("_score")), "reasons": F.when(short, F.array(F.lit(SHORT))).otherwise(F.array_compact(F.array(*told))),
        "reason": F.when(short, SHORT).otherwise(extraction.reject_reason(F.col("_score"), usable)), "category": F.when(short, "otro").otherwise(F.col("category")),
    })
    with in_small_methods(items.sparkSession):
        return cut(step.withColumn("accepted", F.col("reason") == "aceptado").drop("_score", "_anchor"))


def media(images: Column, videos: Column) -> list[Column]:
    """The columns of images and videos, flat for lists of cards and together for one card."""
    first, shown = F.get(images, F.lit(0)), F.get(videos, F.lit(0))
    block = F.struct(images.alias("images"), first.alias("main_image_url"), F.size(images).alias("image_count"), videos.alias("videos"))
    return [
        images.alias("image_urls"), first.alias("image_url"), (F.size(images) > 0).alias("has_image"), videos.alias("videos"), shown["url"].alias("video_url"),
        shown["thumbnail_url"].alias("video_thumbnail_url"), (F.size(videos) > 0).alias("has_video"), block.alias("media"),
    ]


def construct(items: DataFrame, scraped_at: str, now: str) -> DataFrame:
    """The events of the accepted items, one row each; further columns of items (such as position) stay.

    What a structured source states goes before what a text says. A stated start replaces all that the text tells of time,
    unless it or the stated end is no ISO moment.
    """
    own = [c for c in items.columns if c not in ITEM_TEXTS and c not in ("tier", "image_urls", "external_links")]
    return events_of(analysed(items, now), scraped_at, now, own)


def events_of(analysis: DataFrame, scraped_at: str, now: str, own: list[str]) -> DataFrame:
    """The events of analysed rows that were accepted."""
    at, s = clock.moment(now), F.col("s")
    empty = F.array().cast("array<string>")
    step = analysis.where("accepted").withColumn("s", F.from_json("structured_data", STRUCTURED))
    start, end = clock.wall_moment(s["starts_at"]), clock.wall_moment(s["ends_at"])
    stated = start.isNotNull() & (end.isNotNull() | (F.coalesce(s["ends_at"], F.lit("")) == ""))

    def offset(iso: Column) -> Column:
        return F.coalesce(clock.offset_text(iso), F.lit("-04:00"))

    def told(moment: Column, iso: Column) -> Column:
        return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), iso)

    step = step.withColumn("_stated", F.coalesce(stated, F.lit(False)))
    step = step.withColumns({
        "w_start": F.when(F.col("_stated"), start).otherwise(F.col("starts")), "w_end": F.when(F.col("_stated"), end).otherwise(F.col("ends")),
        "o_start": F.when(F.col("_stated"), offset(s["starts_at"])).otherwise("-04:00"), "o_end": F.when(F.col("_stated"), offset(s["ends_at"])).otherwise("-04:00"),
        "l_start": F.when(F.col("_stated"), clock.local_moment(s["starts_at"], OFFSET_MINUTES)).otherwise(F.col("starts")),
        "l_end": F.when(F.col("_stated"), clock.local_moment(s["ends_at"], OFFSET_MINUTES)).otherwise(F.col("ends")),
        "all_day": F.when(F.col("_stated"), F.coalesce(s["all_day"], F.lit(False))).otherwise(F.col("all_day")),
        "doors": F.when(F.col("_stated"), F.coalesce(F.nullif(s["doors_time"], F.lit("")), F.col("doors"))).otherwise(F.col("doors")),
        "date_said": F.when(F.col("_stated"), s["starts_at"]).otherwise(F.coalesce("said", F.lit(""))),
        "t_confidence": extraction.confidence(F.col("tier"), F.col("date_confidence"), F.col("t_venue").isNotNull(), (F.size("ticket_urls") > 0) | (F.coalesce("facebook_event_url", F.lit("")) != ""), F.col("score")),
    })
    step = step.withColumn("multi_day", F.when(F.col("_stated"), F.coalesce(F.to_date("w_end") != F.to_date("w_start"), F.lit(False))).otherwise(F.col("multi_day")))
    step = step.withColumn("display_date", clock.display_date(F.col("w_start"), F.col("w_end"), F.col("multi_day"), F.col("all_day")))

    def first(name: str, other: Column) -> Column:
        return F.coalesce(F.nullif(s[name], F.lit("")), other)

    place = {c: first(c, F.col(f"t_{c}")) for c in ("department", "city", "venue", "address")}
    priced = F.col("price_from").isNotNull()
    text = F.col("text")
    videos = F.when(F.coalesce("video_url", F.lit("")) != "", F.array(video(F.col("video_url"), F.col("video_thumbnail_url"), F.col("video_type"), F.col("source_id"))))
    videos = F.coalesce(videos, F.slice(F.array(video(F.lit(""), F.lit(""), F.lit(""), F.lit(""))), F.lit(1), F.lit(0)))
    return step.select(
        *own, F.substring(F.sha1(F.concat_ws("|", F.coalesce("source_id", F.lit("")), F.coalesce("item_url", F.lit("")), F.substring(text, 1, UID_TEXT))), 1, 16).alias("id"),
        "source_id", "source_name", "source_url", "source_class", F.col("tier").alias("source_tier"), "source_icon_url", F.coalesce(F.nullif("item_url", F.lit("")), F.col("source_url")).alias("url"),
        "facebook_event_url", "published_at", F.lit(scraped_at).alias("scraped_at"),
        title(F.col("title"), text, F.col("category"), F.col("display_date")).alias("title"), F.substring(text, 1, DESCRIPTION).alias("description"), F.substring(text, 1, ORIGINAL).alias("original_text"),
        "category", F.col("secondary").alias("subcategories"), F.col("hashtags").alias("tags"), "artists",
        told(F.col("w_start"), F.col("o_start")).alias("starts_at"), told(F.col("w_end"), F.col("o_end")).alias("ends_at"),
        clock.epoch_ms(F.col("l_start"), OFFSET_MINUTES).alias("starts_at_ms"), clock.epoch_ms(F.col("l_end"), OFFSET_MINUTES).alias("ends_at_ms"),
        F.when(F.col("_stated"), "exacta").otherwise(F.col("date_confidence")).alias("date_confidence"), F.col("date_said").alias("date_source_text"), F.col("all_day"), F.col("multi_day"),
        F.col("doors").alias("doors_time"), "display_date", clock.days_until(F.col("w_start"), at).alias("days_until"), clock.lifecycle(F.col("l_start"), F.col("l_end"), at).alias("lifecycle"),
        *(c.alias(k) for k, c in place.items()), s["latitude"].alias("latitude"), s["longitude"].alias("longitude"),
        places.map_query(place["venue"], place["address"], place["city"], place["department"]).alias("location_query"),
        F.coalesce(s["is_free"], F.col("is_free")).alias("is_free"), F.coalesce(s["price_from"], F.col("price_from")).alias("price_from"), F.coalesce(s["price_to"], F.col("price_to")).alias("price_to"),
        first("currency", F.col("currency")).alias("currency"), first("price_text", price_text(text, F.col("is_free"), priced)).alias("price_text"),
        F.array_distinct(F.concat(F.coalesce(s["ticket_urls"], empty), "ticket_urls")).alias("ticket_urls"), F.col("outlets").alias("ticket_outlets"),
        *(s[c].alias(c) for c in ("organizer", "audience", "age_restriction", "duration_minutes")), *(F.coalesce(s[c], empty).alias(c) for c in ("showtimes", "formats", "occurrences")),
        *(s[c].alias(c) for c in ("content_genre", "director")), F.coalesce(s["cast"], empty).alias("cast"), F.array_distinct(F.concat(F.coalesce(s["phones"], empty), "phones")).alias("phones"),
        "status", F.col("score").alias("relevance_score"), F.col("t_confidence").alias("confidence"), F.col("reasons").alias("filter_reasons"), (F.col("tier") == 1).alias("is_official"),
        *media(F.col("image_urls"), videos), F.when(F.size(videos) > 0, F.col("video_type")).alias("video_type"),
    )


def last_wins(rows: DataFrame, key: list[str], order: str, columns: list[str]) -> DataFrame:
    """One row for each key: the columns of its last row, and the place (first_pos) of its first."""
    last = F.max_by(F.struct(*columns), order)
    return rows.groupBy(*key).agg(last.alias("_row"), F.min(order).alias("first_pos")).select(*key, *(F.col("_row")[c].alias(c) for c in columns), "first_pos")
