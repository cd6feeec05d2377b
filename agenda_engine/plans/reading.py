"""Queries from what was captured to what is published: places, titles, events, pages, merging, and the published counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.functions.durable import dealt
from agenda_engine.functions.text import compatible, fold
from agenda_engine.operators import catalogue as whole
from agenda_engine.operators import events, places, posts, resolve, serving
from agenda_engine.plans.book import query
from agenda_engine.plans.lifted import CATALOGUE, NOW, table, timed
from agenda_engine.sources import captures, pages, sinks, sites


def _cases(column: str, values: list, key: str) -> Column:
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(F.col(key) % len(values) == i, F.lit(v)).otherwise(out)
    return out.alias(column)

ENGLISH_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def _sql_cases(values: list, key: str) -> str:
    told = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {told} END"


# Places and texts

_SAID = [
    "Gran show en el Teatro Achá, av. Heroínas 123", "Feria en Quillacollo, entrada libre", "Tocada en la plaza Abaroa de Sopocachi", "Noche de salsa",
    "Concierto en Santa Cruz de la Sierra, calle Sucre 45 esq. Bolívar", "Taller en el centro pedagogico y cultural simon i. patino", "En la feria de orurotown",
]
_FOUND = {
    "venue": ["Teatro Achá", None, "plaza Abaroa de Sopocachi", None, None, "Centro Pedagógico y Cultural Simón I. Patiño", None],
    "city": ["Cochabamba", "Quillacollo", None, "Yacuiba", "Santa Cruz de la Sierra", "Cochabamba", None],
    "department": ["Cochabamba", "Cochabamba", "La Paz", "Tarija", "Santa Cruz", "Cochabamba", None],
    "address": ["av. Heroínas 123", None, None, None, "calle Sucre 45 esq. Bolívar", None, None],
    "location_query": [
        "Teatro Achá, av. Heroínas 123, Cochabamba, Bolivia", "Quillacollo, Cochabamba, Bolivia", "plaza Abaroa de Sopocachi, La Paz, Bolivia", "Yacuiba, Tarija, Bolivia",
        "calle Sucre 45 esq. Bolívar, Santa Cruz de la Sierra, Santa Cruz, Bolivia", "Centro Pedagógico y Cultural Simón I. Patiño, Cochabamba, Bolivia", None,
    ],
}


@query("SELECT c_custkey, " + ", ".join(f"{_sql_cases(v, 'c_custkey')} AS {k}" for k, v in _FOUND.items()) + " FROM customer")
def places_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue, city, department, address and map query of announcements."""
    k = F.col("c_custkey")
    said = dealt(table(spark, sf_dir, "customer").select(k)).select(k, _cases("text", _SAID, "c_custkey"), F.when(k % 7 == 3, "Tarija").alias("region_hint"), F.when(k % 7 == 3, "Yacuiba").alias("city_hint"))
    found = places.locate(said.withColumn("plain", fold(F.col("text"))), "text", "plain")
    return found.select("c_custkey", "venue", "city", "department", "address", places.map_query(*(F.col(c) for c in ("venue", "address", "city", "department"))).alias("location_query"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Cine Center Santa Cruz' WHEN c_custkey % 3 = 1 THEN 'Cine Center Cochabamba' END AS venue FROM customer""")
def longest_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest of several aliases that stand in a text."""
    text = F.when(F.col("c_custkey") % 3 == 0, "estreno en cine center santa cruz hoy").when(F.col("c_custkey") % 3 == 1, "estreno en cine center hoy").otherwise("estreno en el cine centerx")
    return table(spark, sf_dir, "customer").select("c_custkey", places.known_venue(text).alias("venue"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Título propio ' || c_custkey WHEN 1 THEN 'Banda ' || c_custkey || ' en vivo, hoy' ELSE 'Feria · Sábado 1 de agosto · 20:00' END AS title FROM customer""")
def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item's own title, its first telling line, or one made of category and date."""
    k = F.col("c_custkey")
    own = F.when(k % 3 == 0, F.concat(F.lit("  Título propio "), k))
    text = F.when(k % 3 == 2, "¡hey!\n# # #").otherwise(F.concat(F.lit("***\n♪ Banda "), k, F.lit(" en vivo, hoy ♪\nmás")))
    return dealt(table(spark, sf_dir, "customer").select(k)).select(k, events.title(own, text, F.lit("feria"), F.lit("Sábado 1 de agosto · 20:00")).alias("title"))


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN TIMESTAMP '1997-06-14 10:00:00' - (c_custkey % 50) * INTERVAL 1 MINUTE WHEN 1 THEN TIMESTAMP '1997-06-14 10:00:00' - (c_custkey % 20) * INTERVAL 1 HOUR
    WHEN 2 THEN TIMESTAMP '1997-06-13 10:00:00' WHEN 3 THEN TIMESTAMP '1997-06-14 10:00:00' WHEN 4 THEN TIMESTAMP '1997-06-01 15:30:00' END AS published FROM customer""")
def publication_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When posts were published, from the words and forms that say so."""
    k = F.col("c_custkey")
    said = (
        F.when(k % 6 == 0, F.concat(F.lit("Hace "), k % 50, F.lit(" min"))).when(k % 6 == 1, F.concat(F.lit("hace "), k % 20, F.lit(" h"))).when(k % 6 == 2, "Ayer a las 19:30")
        .when(k % 6 == 3, "hoy").when(k % 6 == 4, "1997-06-01T19:30:00+00:00").otherwise("quién sabe")
    )
    return dealt(table(spark, sf_dir, "customer").select(k)).select(k, events.published(said, clock.moment(NOW)).alias("published"))


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 7 THEN NULL ELSE o_orderdate::DATE + CASE o_orderkey % 8 WHEN 0 THEN INTERVAL 15 HOUR + INTERVAL 30 MINUTE WHEN 1 THEN INTERVAL 21 HOUR + INTERVAL 5 MINUTE
    WHEN 3 THEN INTERVAL 8 HOUR + INTERVAL 45 MINUTE WHEN 6 THEN INTERVAL 20 HOUR ELSE INTERVAL 0 HOUR END END AS published FROM orders""")
def free_publication_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication times in free forms, English and Spanish, written from dates and read back."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    spanish, english = (F.element_at(F.array(*map(F.lit, names)), F.month(day)) for names in (clock.MONTHS, ENGLISH_MONTHS))
    said = [
        F.date_format(day, "EEE, d MMM yyyy '19:30:00 GMT'"), F.concat(F.lit("Posted on "), english, F.lit(" "), F.dayofmonth(day), F.lit("th, "), F.year(day), F.lit(" at 9:05 PM")), F.date_format(day, "MM/dd/yyyy"),
        F.concat(F.lit("Publicado el "), F.dayofmonth(day), F.lit(" de "), spanish, F.lit(" de "), F.year(day), F.lit(", 08:45")), F.date_format(day, "dd.MM.yyyy"), F.concat(F.dayofmonth(day), F.lit(" "), F.upper(F.substring(english, 1, 3)), F.lit(". "), F.year(day)),
        F.concat(spanish, F.lit(" "), F.dayofmonth(day), F.lit(", "), F.year(day), F.lit(" a las 8 pm")), F.lit("en algún momento"),
    ]
    text = F.coalesce(*(F.when(k % 8 == i, s) for i, s in enumerate(said)))
    return dealt(table(spark, sf_dir, "orders").select(k, day)).select(k, events.published(text, clock.moment(NOW)).alias("published"))


@query("SELECT c_custkey, 'Año ' || c_custkey || chr(10) || 'fin ½ 1⁄2 ... TM A' AS text FROM customer".replace("½ ", ""))
def compatible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in compatibility form: letters and marks composed, look-alikes to what they stand for, lines kept."""
    text = F.concat(F.lit(" Año \t "), F.col("c_custkey"), F.lit("\nﬁn ½ … ™ Ａ "))
    return dealt(table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", compatible(text).alias("text"))


@query("""SELECT c_custkey, 'Gran noche ' || c_custkey || chr(10) || 'Te esperamos' AS text, c_custkey % 2 = 0 AS hint, CASE WHEN c_custkey % 3 = 0 THEN 'https://x.bo/a.jpg' END AS image, c_custkey % 4 = 0 AS relevant FROM customer""")
def post_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts without interface noise, hints of an event, images that show something, relevant texts."""
    k = F.col("c_custkey")
    parts = F.array(F.lit("Me gusta"), F.concat(F.lit("Gran   noche "), k), F.lit("12K"), F.lit("Mi Fuente"), F.lit("Te esperamos"), F.lit("te esperamos."), F.lit(" · "), F.lit("Ver más"))
    link = F.when(k % 3 == 0, " https://x.bo/a.jpg").when(k % 3 == 1, "https://x.bo/emoji.php?x").otherwise("data:x")
    return dealt(table(spark, sf_dir, "customer").select(k)).select(
        k, posts.without_noise(parts, F.lit(" mi fuente ")).alias("text"), posts.hints_at_event(F.when(k % 2 == 0, "Súper CONCIERTOS").otherwise("nada")).alias("hint"), posts.image(link).alias("image"),
        F.lower(F.when(k % 4 == 0, "Las Actividades").otherwise("nada")).rlike(posts.any_of(pages.RELEVANT)).alias("relevant"),
    )


@query("""SELECT s_suppkey, s_nationkey % 2 = 0 AS is_web, p.n FROM supplier LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY 1) p ON s_nationkey = p.k
    WHERE s_suppkey % 3 = 0 AND s_nationkey % 2 = 0""")
def source_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by id and type, and the results of those that stay."""
    sources = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_nationkey") % 2 == 0, "generic_web").otherwise("facebook_public").alias("type"), "s_nationkey")
    kept = posts.of_sources(sources.where("id % 3 = 0"), kind="generic_web")
    results = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("source_id"), "s_nationkey")
    n = results.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return posts.results_of(results, kept).join(n, "s_nationkey").select(F.col("source_id").alias("s_suppkey"), (F.col("s_nationkey") % 2 == 0).alias("is_web"), "n")


# Events

_DAY = "day(o_orderdate) || ' de ' || m[month(o_orderdate)] || ' de ' || year(o_orderdate)"
_MONTHS = "(SELECT [" + ", ".join(f"'{m}'" for m in clock.MONTHS) + "] AS m)"
_TEXT = "'Gran concierto de Banda' || (o_orderkey % 97) || ' en el Teatro Achá, ' || " + _DAY + " || ', 20:30. Preventa Bs ' || (o_orderkey % 90 + 10) || '. Te esperamos! #Gira' || (o_orderkey % 10)"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as announcements of a concert on the order's day; every fifth with a structured start, every seventh too short, every ninth off topic."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    month = F.element_at(F.array(*map(F.lit, clock.MONTHS)), F.month(day))
    text = F.concat(
        F.lit("Gran concierto de Banda"), k % 97, F.lit(" en el Teatro Achá, "), F.dayofmonth(day), F.lit(" de "), month, F.lit(" de "), F.year(day), F.lit(", 20:30. Preventa Bs "), k % 90 + 10,
        F.lit(". Te esperamos! #Gira"), k % 10,
    )
    data = F.when(k % 5 == 0, F.lit('{"starts_at": "1998-01-02T19:00:00-04:00", "venue": "Sala X", "price_from": 0, "is_free": true, "ticket_urls": ["https://t.bo/1"], "cast": ["A", "B"]}'))
    return table(spark, sf_dir, "orders").select(
        k.alias("position"), F.concat(F.lit("s"), k % 4).alias("source_id"), F.lit("Fuente").alias("source_name"), F.lit("https://f.bo").alias("source_url"), F.concat(F.lit("https://f.bo/"), k).alias("item_url"),
        F.when(k % 7 == 0, "corto").when(k % 9 == 0, "Corte de luz y accidente de tránsito en la avenida, sin novedad").otherwise(text).alias("text"), F.concat(F.lit("Banda"), k % 97, F.lit(" en vivo")).alias("title"),
        F.when(k % 4 == 0, "eventos").otherwise("media").alias("source_class"), (k % 3 + 1).cast("int").alias("tier"), F.when(k % 2 == 0, F.array(F.lit("https://i.bo/1.jpg"))).alias("image_urls"), data.alias("structured_data"),
    )


_SCORED = f"""
WITH i AS (
  SELECT o_orderkey AS k, o_orderdate, {_TEXT} AS text, strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 20:30', '%Y-%m-%d %H:%M') AS starts FROM orders, {_MONTHS}
), s AS (
  SELECT *, starts > TIMESTAMP '1997-06-14 10:00:00' OR starts::DATE = DATE '1997-06-14' AS ahead, k % 7 <> 0 AND k % 9 <> 0 AS told FROM i
), g AS (
  SELECT *, least(100, CASE WHEN told THEN (CASE WHEN ahead THEN 34 ELSE 6 END + 10 + 4 + 16 + 12 + 13 + 6) ELSE 0 END + CASE WHEN told AND k % 2 = 0 THEN 6 ELSE 0 END + CASE WHEN told AND k % 4 = 0 THEN 8 ELSE 0 END) AS score FROM s
)
"""


@query(_SCORED + """SELECT k AS position, score::INTEGER AS score, CASE WHEN k % 7 = 0 THEN 'texto_muy_corto' WHEN k % 9 = 0 THEN 'sin_fecha_ni_enlace_de_evento' WHEN score >= 55 THEN 'aceptado' ELSE 'relevancia_insuficiente' END AS reason,
    CASE WHEN k % 7 = 0 THEN ['texto_muy_corto'] WHEN k % 9 = 0 THEN list_filter(['sin_fecha', CASE WHEN k % 2 = 0 THEN 'tiene_afiche' END, CASE WHEN k % 4 = 0 THEN 'fuente_especializada' END, 'tema_no_es_evento'], lambda x: x IS NOT NULL)
      ELSE list_filter([CASE WHEN ahead THEN 'fecha_futura' ELSE 'fecha_pasada' END, 'hora_explicita', 'categoria_concierto', 'sede_detectada', 'informacion_de_entradas', 'lenguaje_de_convocatoria',
        CASE WHEN k % 2 = 0 THEN 'tiene_afiche' END, CASE WHEN k % 4 = 0 THEN 'fuente_especializada' END], lambda x: x IS NOT NULL) END AS reasons FROM g""")
def relevance_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, reasons and reason of every announcement."""
    return events.analysed(_items(spark, sf_dir), NOW).select("position", "score", "reason", "reasons")


@query(_SCORED + f""", e AS (
    SELECT *, k % 5 = 0 AS stated, CASE WHEN k % 5 = 0 THEN TIMESTAMP '1998-01-02 19:00:00' ELSE starts END AS w FROM g WHERE told AND score >= 55
  )
  SELECT k AS position, substr(sha1('s' || (k % 4) || '|https://f.bo/' || k || '|' || text), 1, 16) AS id, 'https://f.bo/' || k AS url, 'Banda' || (k % 97) || ' en vivo' AS title, text AS description, 'concierto' AS category, ['teatro'] AS subcategories,
    ['Gira' || (k % 10)] AS tags, strftime(w, '%Y-%m-%dT%H:%M:%S') || '-04:00' AS starts_at, epoch_ms(w + INTERVAL 4 HOUR) AS starts_at_ms, 'exacta' AS date_confidence, false AS all_day, false AS multi_day,
    upper(substr(d[isodow(w)], 1, 1)) || substr(d[isodow(w)], 2) || ' ' || day(w) || ' de ' || m[month(w)] || ' · ' || strftime(w, '%H:%M') AS display_date, (w::DATE - DATE '1997-06-14')::INTEGER AS days_until,
    CASE WHEN w::DATE = DATE '1997-06-14' THEN 'hoy' WHEN w > TIMESTAMP '1997-06-14 10:00:00' THEN 'proximo' ELSE 'finalizado' END AS lifecycle,
    CASE WHEN stated THEN 'Sala X' ELSE 'Teatro Achá' END AS venue, 'Cochabamba' AS city, 'Cochabamba' AS department, CASE WHEN stated THEN 'Sala X' ELSE 'Teatro Achá' END || ', Cochabamba, Bolivia' AS location_query,
    stated AS is_free, CASE WHEN stated THEN 0::DOUBLE ELSE (k % 90 + 10)::DOUBLE END AS price_from, 'BOB' AS currency, trim(substr(text, strpos(text, 'Bs ') - 40, 40 + 5 + 40)) AS price_text,
    CASE WHEN stated THEN ['https://t.bo/1'] ELSE [] END AS ticket_urls, ['Preventa'] AS ticket_outlets, CASE WHEN stated THEN ['A', 'B'] ELSE [] END AS "cast", 'programado' AS status, score::INTEGER AS relevance_score,
    least(42 + CASE k % 3 WHEN 0 THEN 20 WHEN 1 THEN 12 ELSE 0 END + 14 + 7 + CASE WHEN score >= 80 THEN 6 ELSE 0 END, 98) / 100.0::DOUBLE AS confidence, k % 3 = 0 AS is_official, k % 2 = 0 AS has_image,
    CASE WHEN k % 2 = 0 THEN 'https://i.bo/1.jpg' END AS image_url, false AS has_video FROM e, {_MONTHS}, (SELECT ['lunes', 'martes', 'miércoles', 'jueves', 'viernes', 'sábado', 'domingo'] AS d)""")
def event_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements as events, the stated before the inferred."""
    made = events.construct(_items(spark, sf_dir), "1997-06-14T10:00:00-04:00", NOW)
    return made.select(
        "position", "id", "url", "title", "description", "category", "subcategories", "tags", "starts_at", "starts_at_ms", "date_confidence", "all_day", "multi_day", "display_date", "days_until", "lifecycle",
        "venue", "city", "department", "location_query", "is_free", "price_from", "currency", "price_text", "ticket_urls", "ticket_outlets", "cast", "status", "relevance_score", "confidence", "is_official",
        "has_image", "image_url", "has_video",
    )


@query(_SCORED + """SELECT 's' || (k % 4) AS id, count(*) AS raw_items, count(*) FILTER (told AND score >= 55) AS events, count(*) - count(*) FILTER (told AND score >= 55) AS rejected, 'ok' AS status,
    least(3, count(*) FILTER (NOT told OR score < 55))::INTEGER AS samples FROM g GROUP BY ALL UNION ALL SELECT 'none', 0, 0, 0, 'skipped', 0""")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, events and rejects of every source, one that was not captured included."""
    analysis = events.analysed(_items(spark, sf_dir).withColumns({"captured_from": F.col("source_id"), "item_no": F.col("position")}), NOW)
    columns = "id string, name string, url string, type string, source_class string, tier int, region string, city string, icon_url string"
    sources = spark.createDataFrame([(i, i, None, None, None, 1, None, None, None) for i in ("s0", "s1", "s2", "s3", "none")], columns)
    caught = spark.createDataFrame([(i, None) for i in ("s0", "s1", "s2", "s3")], "source_id string, error string")
    counted = captures.source_counts(sources, caught, analysis)
    return counted.select("id", "raw_items", "events", "rejected", "status", F.greatest(F.coalesce(F.size("rejected_samples"), F.lit(0)), F.lit(0)).alias("samples"))


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as posts: pairs of two sources tell of one concert each."""
    k = F.col("p_partkey")
    h = F.floor(k / 2)
    day = F.date_add(F.lit("2026-08-20").cast("date"), (h % 90).cast("int"))
    month = F.element_at(F.array(*map(F.lit, clock.MONTHS)), F.month(day))
    text = F.concat(F.lit("Gran concierto de Banda"), h, F.lit(" en el Teatro Achá, "), F.dayofmonth(day), F.lit(" de "), month, F.lit(" de 2026, 20:30. Te esperamos! Entradas Bs 50"))
    return table(spark, sf_dir, "part").select(
        k.alias("position"), F.concat(F.lit("s"), k % 2).alias("source_id"), F.concat(F.lit("Fuente "), k % 2).alias("source_name"), F.lit("https://f.bo").alias("source_url"), F.concat(F.lit("https://f.bo/"), k).alias("item_url"),
        text.alias("text"), F.concat(F.lit("Banda"), h, F.lit(" en vivo")).alias("title"), F.lit("media").alias("source_class"), (k % 2 + 1).cast("int").alias("tier"),
    )


@query("""WITH p AS (SELECT p_partkey // 2 AS h, count(*) AS n, bool_or(p_partkey % 2 = 0) AS official, bool_or(p_partkey % 2 = 1) AS special FROM part GROUP BY 1)
    SELECT 'Banda' || h || ' en vivo' AS title, strftime(DATE '2026-08-20' + (h % 90)::INTEGER, '%Y-%m-%d') || 'T20:30:00-04:00' AS starts_at, n AS merged_count, n AS source_count, n >= 2 AS corroborated,
      CASE WHEN n = 1 THEN 'una_fuente' ELSE 'oficial_y_especializada' END AS verification, 'primera_deteccion' AS reason, true AS seen_this_run, 'Conciertos' AS category_label, 'Próximos' AS lifecycle_label, 'Bs 50' AS price_label,
      CASE WHEN n = 2 THEN ['s0', 's1'] WHEN official THEN ['s0'] ELSE ['s1'] END AS sources FROM p""")
def catalogue_from_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From captured posts to the served catalogue: read, merged, reconciled with an empty archive, labelled."""
    made = whole.build(_told(spark, sf_dir), None, "2026-08-14 10:00:00", cap=None)
    return made.select(
        "title", "starts_at", "merged_count", "source_count", "corroborated", "verification", F.get("history", F.lit(0))["reason"].alias("reason"), "seen_this_run", "category_label", "lifecycle_label", "price_label",
        F.transform("sources", lambda s: s["id"]).alias("sources"),
    )


# Pages


def _page(spark: SparkSession, sf_dir: str, name: str, html: Column, where: str = "p_partkey % 10 <> 0") -> DataFrame:
    """Parts as pages of sources, ten parts to a source: the tenth is its root and links to the others."""
    k = F.col("p_partkey")
    one = table(spark, sf_dir, "part").select(k, F.floor(k / 10).alias("s"))
    detail = one.where(where).select(F.concat(F.lit("f"), "s").alias("source_id"), _url(name, k).alias("url"), html.alias("html"), F.lit(False).alias("is_root"))
    linked = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.concat(F.lit('<a href="'), _url(name, F.col("s") * 10 + i), F.lit('">Ver evento</a>'))), " ")
    root = one.select("s").distinct().select(
        F.concat(F.lit("f"), "s").alias("source_id"), F.concat(F.lit("https://sitio.bo/raiz"), "s").alias("url"), F.concat(F.lit('<body><a href="https://otro.bo/evento">otro evento</a> '), linked, F.lit("</body>")).alias("html"), F.lit(True).alias("is_root")
    )
    return detail.unionByName(root)


def _url(name: str, k: Column) -> Column:
    """The address of a part's page on a site of some kind."""
    forms = {
        "plain": ("https://sitio.bo/evento/", ""), sites.MUNICIPAL: ("https://sitio.bo/eventos/0123abcd-0000-0000-0000-0000", "abcdef"), sites.CITY: ("https://sitio.bo/agendajiwaki/event/e", ""),
        sites.CINEMA: ("https://sitio.bo/cine/sala-s", ""),
    }
    before, behind = forms[name]
    return F.concat(F.lit(before), F.lpad(k.cast("string"), 8, "0"), F.lit(behind))


def _page_sources(spark: SparkSession, sf_dir: str, parser: str | None) -> DataFrame:
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 10).alias("s")).distinct().select(
        F.concat(F.lit("f"), "s").alias("id"), F.lit("Sitio").alias("name"), F.concat(F.lit("https://sitio.bo/raiz"), "s").alias("url"), none.alias("region"), none.alias("city"), none.alias("icon_url"),
        F.lit(parser).cast("string").alias("parser"), F.lit(100).alias("max_items"), F.lit(100).alias("max_salas"),
    )


_LISTED = "WITH p AS (SELECT p_partkey AS k, p_partkey // 10 AS s, lpad(p_partkey::VARCHAR, 8, '0') AS code FROM part WHERE p_partkey % 10 <> 0)"


@query(_LISTED + """SELECT 'f' || s AS source_id, 'https://sitio.bo/evento/' || code AS item_url, CASE WHEN k % 2 = 0 THEN 'Festival ' || k ELSE 'Ficha ' || k END AS title, CASE WHEN k % 2 = 0 THEN '2026-09-01' ELSE '2026-08-01' END AS published_at,
    CASE WHEN k % 2 = 0 THEN NULL ELSE ['https://sitio.bo/foto' || k || '.jpg', 'https://sitio.bo/otra.jpg'] END AS images, CASE WHEN k % 2 = 0 THEN '80.0' END AS price_from, k % 2 = 1 AS has_player FROM p""")
def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic reader: structured events where a page has them, else its body, images and video, in the order of the root's links."""
    k = F.col("p_partkey").cast("string")
    event = F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":"Festival","name":"Festival '), k, F.lit('","startDate":"2026-09-01","offers":{"price":"80"}}]}</script><script type="application/ld+json">{bad</script>'))
    plain = F.concat(
        F.lit('<head><title>Sitio</title><meta property="og:image" content="/foto'), k, F.lit('.jpg"><meta name="date" content="2026-08-01"></head><body><header><img src="/logo.png">Menú</header><main><h1>Ficha '), k,
        F.lit("</h1><p>Una actividad con cuerpo bastante largo, para que se tome por contenido de la página y no por otra cosa cualquiera &amp; más, ciento veinte letras.</p>"
              '<img src="otra.jpg" data-src="/otra.jpg"><iframe src="https://youtube.com/embed/x"></iframe></main><footer>pie</footer></body>'),
    )
    html = F.when(F.col("p_partkey") % 2 == 0, event).otherwise(plain)
    found = pages.read_sources_pages(_page(spark, sf_dir, "plain", html), _page_sources(spark, sf_dir, None)).where("item_url not like '%raiz%'")
    shown = F.when(F.size("image_urls") > 0, F.col("image_urls"))
    return found.select("source_id", "item_url", "title", "published_at", shown.alias("images"), F.get_json_object("structured_data", "$.price_from").alias("price_from"), (F.coalesce("video_type", F.lit("")) == "web_embed").alias("has_player"))


@query(_LISTED + """SELECT 'f' || s AS source_id, 'Obra ' || k AS title, '2026-09-' || lpad((k % 28 + 1)::VARCHAR, 2, '0') || 'T19:30:00-04:00' AS starts_at, '2026-10-02T21:00:00-04:00' AS ends_at, ['19:30', '21:00'] AS showtimes,
    'Sala ' || k AS venue, 'Calle ' || k AS address, 'Ballet ' || k AS organizer, (k % 50 + 10)::DOUBLE AS price_from, (k % 50 + 40)::DOUBLE AS price_to, 'Bs ' || (k % 50 + 10) || ' - ' || (k % 50 + 40) AS price_text, ['71234567'] AS phones,
    'Santa Cruz' AS department FROM p""")
def municipal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The details of a municipal agenda: showings, place, labels, prices, phones."""
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit("<main><h1>Obra "), k, F.lit("</h1><p>Sábado, "), F.col("p_partkey") % 28 + 1, F.lit(" de septiembre, 19:30</p><p>2 de octubre – 3 de octubre, 21:00</p><a href='/lugares/x'>Sala "), k, F.lit("</a><span>Calle "), k,
        F.lit("</span><b>Organizador</b><i>Ballet "), k, F.lit("</i><p>"), F.col("p_partkey") % 50 + 40, F.lit(" Bs - "), F.col("p_partkey") % 50 + 10, F.lit(" Bs</p><p>+591 71234567</p></main>"),
    )
    found = sites.read_sites(_page(spark, sf_dir, sites.MUNICIPAL, html), _page_sources(spark, sf_dir, sites.MUNICIPAL), "2026-08-27T09:00:00")
    d = F.from_json("structured_data", events.STRUCTURED)
    return found.select("source_id", "title", *(d[c].alias(c) for c in ("starts_at", "ends_at", "showtimes", "venue", "address", "organizer", "price_from", "price_to", "price_text", "phones", "department")))


@query(_LISTED + """SELECT 'f' || s AS source_id, 'Charla ' || k AS title, CASE WHEN k % 3 <> 0 THEN '2026-09-0' || (k % 9 + 1) || 'T18:45:00-04:00' END AS starts_at, 'Museo ' || k AS venue, 'La Paz' AS city, 'https://vimeo.com/' || k AS video_url FROM p""")
def city_agenda_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The details of a city agenda: day and hour near each other, a short text that names a kind of venue, a video."""
    k = F.col("p_partkey").cast("string")
    at = F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("<p>2026-09-0"), F.col("p_partkey") % 9 + 1, F.lit(" a horas 18:45</p>"))).otherwise("<p>2026-09-01, a una hora que todavía está por confirmarse 18:45</p>")
    html = F.concat(F.lit("<article><h1>Charla "), k, F.lit("</h1>"), at, F.lit("<div>Museo "), k, F.lit("</div><iframe src='https://vimeo.com/"), k, F.lit("'></iframe></article>"))
    found = sites.read_sites(_page(spark, sf_dir, sites.CITY, html), _page_sources(spark, sf_dir, sites.CITY), "2026-08-27T09:00:00")
    d = F.from_json("structured_data", events.STRUCTURED)
    return found.select("source_id", "title", *(d[c].alias(c) for c in ("starts_at", "venue", "city")), "video_url")


@query(_LISTED + """, f AS (SELECT s, k, code, unnest([1, 2]) AS film FROM p), n AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY k, film) AS item_no FROM f)
    SELECT 'f' || s AS source_id, item_no::INTEGER AS item_no, 'Film ' || film AS title, 'https://sitio.bo/cine/film-' || film || '_' || film AS item_url, CASE film WHEN 1 THEN ['14:00', '21:30'] ELSE ['09:05'] END AS showtimes,
      CASE film WHEN 1 THEN ['2D DOBLADA'] ELSE [] END AS formats, '2026-08-27T' || CASE film WHEN 1 THEN '14:00' ELSE '09:05' END || ':00-04:00' AS starts_at, 'Sala ' || k AS venue, 'Ciudad ' || k AS city, 'Av. ' || k AS address,
      CASE WHEN film = 1 AND k % 10 = 1 THEN 'Drama' END AS content_genre, CASE WHEN film = 1 AND k % 10 = 1 THEN 101 END AS duration_minutes, CASE WHEN film = 1 AND k % 10 = 1 THEN ['Ana', 'Luis'] END AS "cast" FROM n""")
def cinema_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Films of every room with hours and formats, and what the film's own page adds to its first item."""
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit("<h1>Sala "), k, F.lit("</h1><h2>Ciudad "), k, F.lit("</h2><a href='https://maps.google.com/x'>Av. "), k,
        F.lit("</a><a href='/cine/film-1_1'>Film 1</a><p>2D DOBLADA</p><p>14:00 - 21:30</p><p>14:00</p><a href='/cine/film-2_2'>Film 2</a><span>9:05</span><h3>Lo último</h3><a href='/cine/film-3_3'>Film 3</a><p>10:00</p>"),
    )
    sources = _page_sources(spark, sf_dir, sites.CINEMA)
    film = F.lit("<main><p>Género: Drama</p><p>Duración: 101 min</p><p>Actores: Ana, Luis</p></main>")
    films = sources.select(F.col("id").alias("source_id"), F.lit("https://sitio.bo/cine/film-1_1").alias("url"), film.alias("html"), F.lit(False).alias("is_root"))
    every = _page(spark, sf_dir, sites.CINEMA, html).unionByName(films)
    found = sites.enriched(sites.read_sites(every, sources, "2026-08-27T09:00:00"), every)
    d = F.from_json("structured_data", events.STRUCTURED)
    return found.select("source_id", "item_no", "title", "item_url", *(d[c].alias(c) for c in ("showtimes", "formats", "starts_at", "venue", "city", "address", "content_genre", "duration_minutes", "cast")))


@query(_LISTED + "SELECT CASE s % 4 WHEN 0 THEN 'santa_cruz_agenda' WHEN 1 THEN 'jiwaki' WHEN 2 THEN 'bolivia_com_cine' ELSE 'generic' END AS reader, count(*) AS items FROM p GROUP BY 1")
def parser_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's pages by the reader that the source names, the generic one where it names none."""
    k = F.col("p_partkey").cast("string")
    bodies = {
        sites.MUNICIPAL: F.concat(F.lit("<main><h1>Obra "), k, F.lit("</h1></main>")), sites.CITY: F.concat(F.lit("<main><h1>Charla "), k, F.lit("</h1></main>")),
        sites.CINEMA: F.concat(F.lit("<h1>Sala</h1><a href='/cine/film-"), k, F.lit("_1'>Film</a> 10:00")), "plain": F.concat(F.lit("<body>Agenda de actividades "), k, F.lit("</body>")),
    }
    number, made, told = F.substring("source_id", 2, 20).cast("long") % 4, None, None
    for i, (name, html) in enumerate(bodies.items()):
        part = _page(spark, sf_dir, name, html).where(number == i)
        made = part if made is None else made.unionByName(part)
        named = _page_sources(spark, sf_dir, None if name == "plain" else name).where(F.substring("id", 2, 20).cast("long") % 4 == i)
        told = named if told is None else told.unionByName(named)
    found = sites.read_all(made, told, "2026-08-27T09:00:00").where("item_url not like '%raiz%'")
    reader = F.when(number == 0, sites.MUNICIPAL).when(number == 1, sites.CITY).when(number == 2, sites.CINEMA).otherwise("generic")
    return found.groupBy(reader.alias("reader")).agg(F.count(F.lit(1)).alias("items"))


# Merging


@query("""WITH r AS (SELECT *, p_partkey % 3 + 1 AS tier, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey % 3, p_partkey) AS k FROM part),
    s AS (SELECT p_brand, list(x ORDER BY t, k) AS sources FROM (SELECT p_brand, 's' || (p_partkey % 6) AS x, min(tier) AS t, arg_min(k, (tier, k)) AS k FROM r GROUP BY ALL) GROUP BY 1),
    u AS (SELECT p_brand, list(x ORDER BY k)[1:12] AS all_urls FROM (SELECT p_brand, 'u' || (p_partkey % 40) AS x, min(k) AS k FROM r GROUP BY ALL) GROUP BY 1),
    v AS (SELECT p_brand, list(x ORDER BY k)[1:8] AS videos FROM (SELECT p_brand, 'v' || (p_partkey % 30) AS x, min(k) AS k FROM r WHERE p_partkey % 4 = 0 GROUP BY ALL) GROUP BY 1),
    t AS (SELECT p_brand, list(x ORDER BY k)[1:5] AS tags FROM (SELECT p_brand, lower(p_type) AS y, arg_min(p_type, k) AS x, min(k) AS k FROM r GROUP BY p_brand, lower(p_type)) GROUP BY 1),
    d AS (SELECT p_brand, CASE WHEN arg_min(p_partkey % 5 <> 0, k) THEN arg_min(p_partkey, k) ELSE coalesce(arg_min(p_partkey, k) FILTER (p_partkey % 5 <> 0), arg_min(p_partkey, k)) END AS p FROM r GROUP BY 1)
    SELECT p_brand AS cluster, sources, all_urls, coalesce(videos, []) AS videos, tags, 'c' || p AS date_confidence, p % 2 = 0 AS all_day FROM d JOIN s USING (p_brand) JOIN u USING (p_brand) JOIN t USING (p_brand) LEFT JOIN v USING (p_brand)""")
def merge_lists_and_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources and addresses by tier, videos, list unions, and the columns that follow from the first date; here a cluster is a brand."""
    k, none = F.col("p_partkey"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "part").select(
        k.alias("position"), F.col("p_brand").alias("cluster"), (k % 3 + 1).cast("int").alias("source_tier"), F.concat(F.lit("s"), k % 6).alias("source_id"), F.concat(F.lit("u"), k % 40).alias("url"),
        F.when(k % 4 == 0, F.concat(F.lit("v"), k % 30)).alias("video_url"), none.alias("video_thumbnail_url"), none.alias("video_type"), none.alias("source_name"), none.alias("source_class"), none.alias("source_url"),
        none.alias("source_icon_url"), none.alias("published_at"), F.array("p_type").alias("tags"), F.when(k % 5 != 0, "2026-08-20").alias("starts_at"), F.concat(F.lit("c"), k).alias("date_confidence"), (k % 2 == 0).alias("all_day"),
        F.lit(0.5).alias("confidence"), F.lit(1).alias("relevance_score"), F.array().cast("array<string>").alias("image_urls"), none.alias("description"),
    )
    ranked = resolve.ranked(rows)
    dated = ranked.groupBy("cluster").agg(*resolve.dated_columns(["date_confidence", "all_day"]))
    videos = resolve.merged_videos(ranked).select("cluster", F.transform("videos", lambda v: v["url"]).alias("videos"))
    sources = resolve.merged_sources(ranked).select("cluster", F.transform("sources", lambda s: s["id"]).alias("sources"), "all_urls")
    met = dated.join(sources, "cluster").join(resolve.ordered_unions(ranked, {"tags": 5}), "cluster").join(videos, "cluster", "left")
    return met.withColumn("videos", F.coalesce("videos", F.array().cast("array<string>")))


# What is published


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return timed(spark, sf_dir).withColumns({
        "starts_at": F.col("starts").cast("string"), "corroborated": k % 3 == 0, "seen_this_run": k % 4 != 0, "source_class": F.when(k % 2 == 0, "media").otherwise("eventos"),
        "tags": F.array(F.concat(F.lit("t"), k % 30), F.concat(F.lit("T"), k % 7)), "title": F.concat(F.lit("Evento "), k), "venue": F.lit(None).cast("string"),
    })


def _run_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    homes = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return homes.select(k.alias("id"), F.col("n_name").alias("region"), F.when(k % 4 == 0, "ok").when(k % 4 == 1, "blocked").when(k % 4 == 2, "error").otherwise("skipped").alias("status"))


@query(CATALOGUE + """SELECT count(*) AS events_total, count(*) FILTER (is_upcoming) AS events_upcoming, count(*) FILTER (lifecycle = 'hoy') AS events_today, count(starts) AS events_with_date, count(*) FILTER (is_upcoming AND is_free) AS events_free,
    count(*) FILTER (has_image) AS events_with_image, count(*) FILTER (has_video) AS events_with_video, count(*) FILTER (event_id % 3 = 0) AS events_corroborated, count(*) FILTER (event_id % 4 <> 0) AS events_seen_this_run,
    (SELECT count(*) FROM supplier) AS sources_total, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 0) AS sources_ok, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 1) AS sources_blocked,
    (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 2) AS sources_error, (SELECT count(*) FROM supplier WHERE s_suppkey % 4 = 3) AS sources_skipped FROM up""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourteen counts of a published catalogue."""
    return serving.summary_of_run(_published(spark, sf_dir), _run_sources(spark, sf_dir))


@query(CATALOGUE + """, u AS (SELECT * FROM up WHERE is_upcoming), v AS (
      SELECT 'categories' AS facet, category AS key, count(*) AS count, min(position) AS f, 0::BIGINT AS i FROM u WHERE category <> '' GROUP BY category UNION ALL SELECT 'cities', city, count(*), min(position), 0 FROM u WHERE city <> '' GROUP BY city
      UNION ALL SELECT 'departments', department, count(*), min(position), 0 FROM u WHERE department <> '' GROUP BY department
      UNION ALL SELECT 'source_classes', CASE WHEN event_id % 2 = 0 THEN 'media' ELSE 'eventos' END, count(*), min(position), 0 FROM u GROUP BY ALL
      UNION ALL (SELECT 'tags', key, count(*), min((position, i))[1], min((position, i))[2] FROM (SELECT position, unnest(['t' || (event_id % 30), 'T' || (event_id % 7)]) AS key, unnest([0, 1]) AS i FROM u) GROUP BY key)
    ), w AS (SELECT facet, row_number() OVER (PARTITION BY facet ORDER BY count DESC, f, i) - 1 AS place, key, key AS label, count FROM v),
    x AS (SELECT count(*) FILTER (is_free) AS free, count(*) FILTER (NOT is_free AND price_from IS NOT NULL) AS paid, count(*) FILTER (NOT is_free AND price_from IS NULL) AS ask, count(*) FILTER (has_image) AS image, count(*) FILTER (has_video) AS video,
      count(*) FILTER (starts::DATE <= DATE '1997-06-14' AND last_day >= DATE '1997-06-14') AS a, count(*) FILTER (starts::DATE <= DATE '1997-06-21' AND last_day >= DATE '1997-06-14') AS b,
      count(*) FILTER (starts::DATE <= DATE '1997-07-14' AND last_day >= DATE '1997-06-14') AS c, count(*) AS d FROM u)
    SELECT facet, place::INTEGER AS place, key, label, count FROM w WHERE facet <> 'tags' OR place < 24
    UNION ALL SELECT 'price', unnest([0, 1, 2])::INTEGER, unnest(['gratis', 'pagado', 'por_confirmar']), unnest(['Gratis', 'Con entrada', 'Precio por confirmar']), unnest([free, paid, ask]) FROM x
    UNION ALL SELECT 'media', unnest([0, 1])::INTEGER, unnest(['con_foto', 'con_video']), unnest(['Con foto', 'Con video']), unnest([image, video]) FROM x
    UNION ALL SELECT 'when', unnest([0, 1, 2, 3])::INTEGER, unnest(['hoy', 'esta_semana', 'este_mes', 'todos']), unnest(['hoy', 'esta_semana', 'este_mes', 'todos']), unnest([a, b, c, d]) FROM x""".replace("min((position, i))[1]", "struct_extract(min((position, i)), 1)").replace("min((position, i))[2]", "struct_extract(min((position, i)), 2)"))
def published_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every filter of a published catalogue."""
    return serving.facets(_published(spark, sf_dir), NOW)


@query(CATALOGUE + """, e AS (SELECT department, count(*) AS events_total, count(*) FILTER (is_upcoming) AS events_upcoming, count(*) FILTER (is_upcoming AND has_image) AS events_with_image, count(*) FILTER (is_upcoming AND has_video) AS events_with_video FROM up GROUP BY 1),
    s AS (SELECT n_name AS department, count(s_suppkey) AS sources_total, count(*) FILTER (s_suppkey % 4 = 0) AS sources_ok FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey GROUP BY 1)
    SELECT department, coalesce(events_total, 0) AS events_total, coalesce(events_upcoming, 0) AS events_upcoming, coalesce(events_with_image, 0) AS events_with_image, coalesce(events_with_video, 0) AS events_with_video, sources_total, sources_ok
    FROM s LEFT JOIN e USING (department)""")
def coverage_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six counts for every department."""
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("department"))
    return serving.department_coverage(_published(spark, sf_dir), _run_sources(spark, sf_dir), names)


@query(CATALOGUE + """, q AS (SELECT *, 24 + CASE WHEN has_image THEN 14 ELSE 0 END + CASE WHEN has_video THEN 7 ELSE 0 END + CASE WHEN city <> '' THEN 6 ELSE 0 END + CASE WHEN is_free OR price_from IS NOT NULL THEN 8 ELSE 0 END
      + CASE source_tier WHEN 1 THEN 9 WHEN 2 THEN 5 ELSE 0 END + CASE WHEN event_id % 3 = 0 THEN 8 ELSE 0 END AS quality_score FROM up WHERE is_upcoming)
    SELECT event_id, 'Evento ' || event_id AS title, category, 'Otros' AS category_label, lifecycle, CASE lifecycle WHEN 'hoy' THEN 'Hoy' WHEN 'en_curso' THEN 'En curso' ELSE 'Próximos' END AS lifecycle_label, days_until, city, department, is_free, price_from,
      quality_score::INTEGER AS quality_score, is_upcoming AND status = 'programado' AND quality_score >= 65 AS is_featured, status, []::VARCHAR[] AS showtimes FROM q""")
def lite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compact form with its labels, scores and empty lists."""
    return serving.lite(serving.enriched(_published(spark, sf_dir))).select(
        "event_id", "title", "category", "category_label", "lifecycle", "lifecycle_label", "days_until", "city", "department", "is_free", "price_from", "quality_score", "is_featured", "status", "showtimes"
    )


@query(CATALOGUE + """SELECT event_id::VARCHAR AS event_id, 'Evento ' || event_id AS title, category, lifecycle, coalesce(days_until::VARCHAR, '') AS days_until, coalesce(department, '') AS department, coalesce(city, '') AS city, '' AS venue, '' AS address,
    is_free::VARCHAR AS is_free, status, CASE WHEN event_id % 2 = 0 THEN 'a | b' ELSE '' END AS ticket_urls, '' AS url FROM up""")
def csv_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 22 columns of the spreadsheet, of which those are held against SQL that are no floating-point numbers or dates as texts."""
    rows = serving.enriched(_published(spark, sf_dir)).withColumn("ticket_urls", F.when(F.col("event_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")))
    for c in serving.CSV_COLUMNS:
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string"))
    told = sinks.csv_rows(rows, list(serving.CSV_COLUMNS))
    return told.select("event_id", "title", "category", "lifecycle", "days_until", "department", "city", "venue", "address", "is_free", "status", "ticket_urls", "url")
