"""What a post says: category, state, prices, links, phones, hashtags, names, and its relevance, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions import lexicon
from agenda_engine.functions.text import first_distinct, fold, hits, let, occurs

# Patterns on folded text (prices, free entry) and on raw text (addresses, phones, hashtags, names).
FREE = r"\b(?:entrada|ingreso|acceso|admision|evento)\s+(?:es\s+)?(?:libre|gratuita?|gratis|liberado|sin costo)\b|\bgratis\b|\bgratuito\b|\bfree\b|\bsin costo\b"
PRICE = r"\bbs\.?\s*/?\s*(\d{1,4}(?:[.,]\d{1,2})?)|(\d{1,4}(?:[.,]\d{1,2})?)\s*(?:bs\.?\b|bolivianos?\b)"
URL = r"(?i)https?://[^\s<>\"'\)\]]+"
MOBILE, LANDLINE = r"(?<!\d)[67]\d{7}(?!\d)", r"(?<!\d)[2-4][\s\-]?\d{6,7}(?!\d)"
HASHTAG = r"(?U)#(\w{3,30})"
NAME = r"([^.,;:\n!¡?¿]{3,60})"
NAME_FORMULAS = (
    rf"(?iU)\bpresent(?:a|an|amos)\s+a\s+{NAME}", rf"(?iU)\bcon\s+la\s+presencia\s+de\s+{NAME}", rf"(?iU)\bartista\s+invitad[oa]\s*[:\-]?\s*{NAME}",
    rf"(?iU)\ben\s+concierto\s*[:\-]\s*{NAME}", rf"(?iU)\bteloner[oa]s?\s*[:\-]?\s*{NAME}",
)
NAME_ENDS = (
    r"(?iU)\s+(?:en\s+(?:concierto|vivo|el|la|los|las)|est[ae]\b|pr[oó]xim[oa]\b|el\s+(?:d[ií]a|pr[oó]ximo|lunes|martes|mi[eé]rcoles|jueves|viernes|s[aá]bado|domingo)"
    r"|a\s+las\b|desde\s+las\b|por\s+primera\s+vez\b|junto\s+a\b|llega\b|vuelve\b).*$"
)
LOWEST_PRICE, HIGHEST_PRICE = 1.0, 5000.0
# Points of the relevance score, and the bar.
POINTS = {"future": 34, "past_date": 6, "explicit_time": 10, "exact_date": 4, "category": 16, "venue": 12, "price": 13, "link": 11, "image": 6, "specialised": 8}
CALL_POINTS, CALL_MOST, PAST_POINTS, PAST_MOST, OFF_POINTS, OFF_MOST = 6, 14, 14, 34, 18, 40
SPECIALISED = ("eventos", "ticketera", "venue", "cultura_oficial", "cartelera_cine")
BAR, SHORTEST = 55, 25


def category(folded: Column) -> Column:
    """struct<category, secondary>: the category with the most patterns hit, earlier ones first on ties, and up to four others that were hit."""
    scored = F.array(*(F.struct((-hits(folded, p)).alias("n"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, (k, p) in enumerate(lexicon.CATEGORIES.items())))
    def told(found: Column) -> Column:
        best = F.array_min(found)["k"]
        others = F.transform(F.filter(found, lambda s: s["k"] != best), lambda s: s["k"])
        return F.struct(F.coalesce(best, F.lit("otro")).alias("category"), F.slice(others, 1, 4).alias("secondary"))

    return F.get(F.transform(F.array(F.filter(scored, lambda s: s["n"] < 0)), told), 0)


def state(folded: Column) -> Column:
    """The first state that any pattern announces, or programado."""
    out = F.lit("programado")
    for name, patterns in reversed(lexicon.STATES.items()):
        out = F.when(hits(folded, patterns) > 0, name).otherwise(out)
    return out


def outlets(folded: Column) -> Column:
    """Up to six outlets that are named."""
    return F.slice(F.array_compact(F.array(*(F.when(occurs(folded, p), F.lit(name)) for name, p in lexicon.OUTLETS.items()))), 1, 6)


def prices(folded: Column) -> Column:
    """struct<is_free, price_from, price_to, currency>: the least and, of several, the greatest sensible price."""
    every = F.regexp_extract_all(folded, F.lit(PRICE), F.lit(0))
    numbers = F.transform(every, lambda v: F.replace(F.regexp_extract(v, r"\d{1,4}(?:[.,]\d{1,2})?", 0), F.lit(","), F.lit(".")).try_cast("double"))

    def told(sound: Column) -> Column:
        some = F.size(sound) > 0
        return F.struct(
            (~some & folded.rlike(FREE)).alias("is_free"), F.array_min(sound).alias("price_from"),
            F.when(F.size(sound) > 1, F.array_max(sound)).alias("price_to"), F.when(some, "BOB").alias("currency"),
        )

    return let(F.filter(numbers, lambda v: (v >= LOWEST_PRICE) & (v <= HIGHEST_PRICE)), told)


def links(text: Column, extra: Column | None = None) -> Column:
    """struct<all_urls, ticket_urls>: up to twelve addresses of the text and the extra ones, up to six that sell tickets."""
    every = F.regexp_extract_all(text, F.lit(URL), F.lit(0))
    every = F.concat(every, F.coalesce(extra, F.array().cast("array<string>"))) if extra is not None else every
    sells = F.filter(every, lambda u: F.array_max(F.array(*(F.contains(F.lower(u), F.lit(d)) for d in lexicon.TICKET_DOMAINS))))
    return F.struct(first_distinct(every, 12).alias("all_urls"), first_distinct(sells, 6).alias("ticket_urls"))


def phones(text: Column) -> Column:
    """Up to four mobile and landline numbers in the order of the text, without separators."""
    found = F.regexp_extract_all(text, F.lit(f"{MOBILE}|{LANDLINE}"), F.lit(0))
    return first_distinct(F.transform(found, lambda v: F.regexp_replace(v, r"[ \-]", "")), 4)


def hashtags(text: Column) -> Column:
    """Up to twelve hashtags."""
    return first_distinct(F.regexp_extract_all(text, F.lit(HASHTAG), F.lit(1)), 12)


def artists(text: Column) -> Column:
    """Up to six names that explicit formulas announce, formula by formula, cut where the name clearly ends."""
    found = F.concat(*(F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in NAME_FORMULAS))
    neat = F.transform(found, lambda v: F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(v, r"(?U)\s+", " ")), NAME_ENDS, ""), r"^[ .,;:\-·|\"']+|[ .,;:\-·|\"']+$", ""))
    return first_distinct(F.filter(neat, lambda v: F.length(v).between(3, 60) & ~F.startswith(F.lower(v), F.lit("todos"))), 6)


def analyse(items: DataFrame, text: str = "text", extra: str | None = None) -> DataFrame:
    """Adds what the text says (and, of links, a further list); the folded text is computed once, below everything that reads it."""
    raw, plain = F.coalesce(F.col(text), F.lit("")), F.col("plain")
    step = items.withColumn("plain", fold(F.col(text)))
    said = step.withColumns({
        "kind": category(plain), "price": prices(plain), "links": links(raw, F.col(extra) if extra else None), "status": state(plain), "outlets": outlets(plain), "phones": phones(raw),
        "hashtags": hashtags(raw), "artists": artists(raw), "calls": hits(plain, lexicon.CALLS), "past": hits(plain, lexicon.PAST), "off_topic": hits(plain, lexicon.OFF_TOPIC),
    })
    return said.select("*", "kind.category", "kind.secondary", "price.is_free", "price.price_from", "price.price_to", "price.currency", "links.all_urls", "links.ticket_urls").drop("kind", "price", "links")


def relevance(dated: Column, upcoming: Column, timed: Column, exact: Column, venue: Column, image: Column, event_link: Column, source_class: Column) -> Column:
    """The additive score, 0 to 100, over the columns of analyse() and what dates and places added."""

    def add(points: str, condition: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), POINTS[points]).otherwise(0)

    total = (
        add("future", dated & upcoming) + add("past_date", dated & ~upcoming) + add("explicit_time", timed) + add("exact_date", exact)
        + add("category", F.col("category") != "otro") + add("venue", venue) + add("price", F.col("price_from").isNotNull() | F.col("is_free"))
        + add("link", event_link | (F.size("ticket_urls") > 0)) + F.least(F.col("calls") * CALL_POINTS, F.lit(CALL_MOST)) + add("image", image)
        + add("specialised", source_class.isin(*SPECIALISED))
        - F.least(F.col("past") * PAST_POINTS, F.lit(PAST_MOST)) - F.least(F.col("off_topic") * OFF_POINTS, F.lit(OFF_MOST))
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), total))


def reject_reason(score: Column, usable: Column) -> Column:
    """Why an item is no event, or aceptado; usable: it has a date or an event link of its own."""
    return (
        F.when((score >= BAR) & usable, "aceptado")
        .when(~usable, "sin_fecha_ni_enlace_de_evento")
        .when((F.col("past") > 0) & (score < BAR), "parece_cronica_de_algo_que_ya_paso")
        .when(F.col("off_topic") > 0, "tema_ajeno_a_eventos")
        .when(F.col("category") == "otro", "sin_senal_de_evento_en_el_texto")
        .otherwise("relevancia_insuficiente")
    )


def confidence(tier: Column, date_confidence: Column, venue: Column, link: Column, score: Column) -> Column:
    """How sure it is that an event is real and read well, in whole hundredths to keep sums exact."""
    points = (
        F.lit(42) + F.when(tier == 1, 20).when(tier == 2, 12).otherwise(0)
        + F.when(date_confidence == "exacta", 14).when(date_confidence == "aproximada", 7).when(date_confidence == "relativa", 3).otherwise(0)
        + F.when(venue, 7).otherwise(0) + F.when(link, 7).otherwise(0) + F.when(score >= 80, 6).otherwise(0)
    )
    return F.least(points, F.lit(98)) / F.lit(100.0)
