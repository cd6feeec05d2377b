"""Where something happens: venue, city, department, address and a query for a map, as column expressions."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.gazetteer import ADDRESS_PATTERN, CITIES, COUNTRY, DEPARTMENT_ALIASES, DEPARTMENTS, VENUE_PATTERN, VENUES
from agenda_engine.functions.text import fold, let
from agenda_engine.functions.trie import Lexicon

TRIMMED = r"^[ .,;:\-]+|[ .,;:\-]+$"


@lru_cache(maxsize=1)
def lexicons() -> dict[str, Lexicon]:
    """The gazetteer as lexicons: venues and cities by the longest alias, departments and the cities of hints in the order of their lists."""
    cities = [(a, name) for name, (aliases, _) in CITIES.items() for a in aliases]
    return {
        "venue": Lexicon(_longest_first([(a, name) for name, (aliases, _, _) in VENUES.items() for a in aliases])), "city": Lexicon(_longest_first(cities)), "city_hint": Lexicon(cities),
        "department": Lexicon([(a, name) for name, aliases in DEPARTMENT_ALIASES.items() for a in aliases]),
    }


def _longest_first(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return sorted(pairs, key=lambda p: -len(p[0]))


def known_venue(folded: Column) -> Column:
    """The known venue with the longest alias in a folded text; of equals the first of the list."""
    return lexicons()["venue"].first(folded)


def _looked_up(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def named_venue(text: Column) -> Column:
    """A kind of venue with a name behind it, of 6 to 70 characters."""
    said = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, VENUE_PATTERN, 0), r"(?U)\s+", " "), TRIMMED, "")
    return F.when(F.length(said).between(6, 70), said)


def city(folded: Column, hint: Column) -> Column:
    """The city that a text names, longest alias first, else that of the source's hint."""
    return F.coalesce(lexicons()["city"].first(folded), lexicons()["city_hint"].first(hint))


def department(folded: Column, hint: Column) -> Column:
    """The first department that a text tells of, else the hint itself, else what the hint tells of."""
    own = _looked_up(hint, {_plain(d): d for d in DEPARTMENTS})
    return F.coalesce(lexicons()["department"].first(folded), own, lexicons()["department"].first(hint))


def _plain(name: str) -> str:
    return name.lower().replace("í", "i")


def address(text: Column) -> Column:
    """A street address of 6 to 90 characters."""
    said = F.regexp_replace(F.regexp_replace(F.regexp_extract(text, ADDRESS_PATTERN, 0), r"(?U)\s+", " "), TRIMMED, "")
    return F.when(F.length(said).between(6, 90), said)


def locate(items: DataFrame, text: str, folded: str, region_hint: str = "region_hint", city_hint: str = "city_hint") -> DataFrame:
    """Adds venue, city, department and address: the venue rules, then the text, then the hints of the source."""
    raw, plain, own = F.coalesce(F.col(text), F.lit("")), F.col(folded), items.columns
    step = items.select(*own, known_venue(plain).alias("_venue"), fold(F.col(city_hint)).alias("_city"), fold(F.col(region_hint)).alias("_region"))
    of_city, of_department = {v: c for v, (_, c, _) in VENUES.items()}, {v: d for v, (_, _, d) in VENUES.items()}
    step = step.select(*own, "_venue", "_region", F.coalesce("_venue", named_venue(raw)).alias("venue"), F.coalesce(_looked_up(F.col("_venue"), of_city), city(plain, F.col("_city"))).alias("city"))
    told = F.coalesce(_looked_up(F.col("_venue"), of_department), _looked_up(F.col("city"), {c: d for c, (_, d) in CITIES.items()}), department(plain, F.col("_region")))
    return step.select(*own, "venue", "city", told.alias("department"), address(raw).alias("address"))


def map_query(venue: Column, street: Column, town: Column, region: Column) -> Column:
    """Up to three different parts and the country, or null where nothing is known."""
    told = F.transform(F.array(venue, street, town, region), lambda p: F.struct(p.alias("said"), fold(p).alias("plain")))
    known = let(told, lambda every: F.filter(every, lambda p: p["plain"] != ""))
    once = let(known, lambda parts: F.filter(parts, lambda p, i: F.array_position(F.transform(parts, lambda q: q["plain"]), p["plain"]) == i + 1))
    some = F.exists(F.array(venue, street, town, region), lambda p: F.coalesce(p != "", F.lit(False)))
    return F.when(some, F.array_join(F.concat(F.transform(F.slice(once, 1, 3), lambda p: p["said"]), F.array(F.lit(COUNTRY))), ", "))
