"""When a text says something happens: days, ranges and hours in Spanish, from folded text.

The grammar is laid out in steps of columns, so that no expression is repeated inside another.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.lexicon import MONTHS, WEEKDAYS

# Days of grace, and the words of the grammar.
GRACE_DAYS = 3
_MONTH = "(" + "|".join(sorted(MONTHS, key=len, reverse=True)) + ")"
_WEEKDAY = "(" + "|".join(WEEKDAYS) + ")"
_YEAR = r"(?:\s+(?:de[l]?\s+)?(\d{4}))?"
# Fixed values too: how posters write days and hours; groups are numbered from 1.
ISO = r"\b(20\d{2})-([01]\d)-([0-3]\d)\b"
ACROSS = rf"\b(?:del?\s+)?([0-3]?\d)\s+de\s+{_MONTH}{_YEAR}\s*(?:al|hasta el|-|–|—)\s*([0-3]?\d)\s+de\s+{_MONTH}{_YEAR}"
WITHIN = rf"\b(?:del?\s+)?([0-3]?\d)\s*(?:al|hasta el|a|-|–|—)\s*([0-3]?\d)\s+de\s+{_MONTH}\b{_YEAR}"
SINGLE = rf"\b(?:{_WEEKDAY}\s+)?([0-3]?\d)\s+de\s+{_MONTH}\b{_YEAR}"
NUMERIC = r"(?<![\d/.-])([0-3]?\d)[/\-.]([01]?\d)(?:[/\-.](\d{2,4}))?(?![\d/.-])"
NAMED = rf"\b(este|esta|proximo|proxima|el)\s+{_WEEKDAY}\b"
_SUFFIX = r"(a\.?m\.?|p\.?m\.?|hrs?\.?|horas)"
_PART = r"de\s+la\s+(manana|tarde|noche)"
CLOCK = rf"\b(?:a\s+(?:las|hrs\.?)\s+|horas?\s+|hrs\.?\s+)?([0-2]?\d)[:.]([0-5]\d)\s*{_SUFFIX}?"
LED = rf"\b(?:a\s+las|desde\s+las|a\s+hrs\.?)\s+([0-2]?\d)\s*{_SUFFIX}?(?:\s*{_PART})?"
TRAILED = rf"\b([0-2]?\d)\s*(?:{_SUFFIX}|{_PART})"
LED_NEEDS, TRAILED_NEEDS = ("las", "hr"), ("am", "a.m", "pm", "p.m", "hr", "horas", "la")
DOORS = r"\b(?:puertas?|apertura|ingreso|admision|acceso)\s*(?:se\s+abren?\s*)?(?:a\s+(?:las|hrs\.?)\s*)?[:\-]?\s*([0-2]?\d)(?:[:.]([0-5]\d))?"
SHOW = r"\b(?:show|concierto|funcion|inicio|comienza|empieza|arranca|start)\s*(?:a\s+(?:las|hrs\.?)\s*)?[:\-]?\s*([0-2]?\d)(?:[:.]([0-5]\d))?"


def _group(text: Column, pattern: str, group: int) -> Column:
    """A group of the first match, null where there is none or it took no part."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _number(text: Column, pattern: str, group: int) -> Column:
    return _group(text, pattern, group).try_cast("int")


def _month(name: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in MONTHS.items() for x in pair)), name)


def make_day(year: Column, month: Column, day: Column) -> Column:
    """A day, or null where the calendar has none such."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def resolve_day(day: Column, month: Column, year: Column, anchor: Column) -> Column:
    """A day whose year may be unsaid: then the first of this year and the next that is not past the grace days."""
    said = F.when(year < 100, year + 2000).otherwise(year)
    this, following = make_day(F.year(anchor), month, day), make_day(F.year(anchor) + 1, month, day)
    limit = F.date_sub(anchor, GRACE_DAYS)
    guess = F.when(this >= limit, this).when(following >= limit, following)
    return F.when(day.isNull() | month.isNull(), F.lit(None)).when(year.isNotNull(), make_day(said, month, day)).otherwise(guess)


def days(rows: DataFrame, folded: str, anchor: str) -> DataFrame:
    """Adds first_day, last_day and day_kind: the first usable of ISO, range across months, range within one, single, numeric and relative days.

    Of each form only its first match counts; if that is no day, the next form is tried.
    """
    text, at, own = F.col(folded), F.col(anchor), rows.columns
    # a form is looked for once, and what it says is read from the words that were found
    found = {"across": ACROSS, "within": WITHIN, "single": SINGLE, "numeric": NUMERIC, "named": NAMED}
    rows = rows.select(*own, *(_group(text, p, 0).alias(f"_{k}") for k, p in found.items()))
    across, within, single, numeric, named = (F.col(f"_{k}") for k in found)
    read = {
        "iso": F.transform(F.regexp_extract_all(text, F.lit(ISO), F.lit(0)), lambda d: F.try_to_date(d, "yyyy-MM-dd")),
        "a_d1": _number(across, ACROSS, 1), "a_m1": _month(_group(across, ACROSS, 2)), "a_y1": _number(across, ACROSS, 3),
        "a_d2": _number(across, ACROSS, 4), "a_m2": _month(_group(across, ACROSS, 5)), "a_y2": _number(across, ACROSS, 6),
        "w_d1": _number(within, WITHIN, 1), "w_d2": _number(within, WITHIN, 2), "w_m": _month(_group(within, WITHIN, 3)), "w_y": _number(within, WITHIN, 4),
        "s_d": _number(single, SINGLE, 2), "s_m": _month(_group(single, SINGLE, 3)), "s_y": _number(single, SINGLE, 4),
        "n_d": _number(numeric, NUMERIC, 1), "n_m": _number(numeric, NUMERIC, 2), "n_y": _number(numeric, NUMERIC, 3),
        "r_how": _group(named, NAMED, 1), "r_day": F.element_at(F.create_map(*(F.lit(x) for pair in WEEKDAYS.items() for x in pair)), _group(named, NAMED, 2)),
    }
    step = rows.select(*own, *(c.alias(f"_{k}") for k, c in read.items()))

    def c(name: str) -> Column:
        return F.col(f"_{name}")

    step = step.withColumns({
        "_a1": resolve_day(c("a_d1"), c("a_m1"), c("a_y1"), at), "_w1": resolve_day(c("w_d1"), c("w_m"), c("w_y"), at),
        "_s1": resolve_day(c("s_d"), c("s_m"), c("s_y"), at), "_n1": F.when(c("n_m").between(1, 12), resolve_day(c("n_d"), c("n_m"), c("n_y"), at)),
        "_ahead": F.pmod(c("r_day") - F.weekday(at), F.lit(7)),
    })
    step = step.withColumns({
        "_a2": resolve_day(c("a_d2"), c("a_m2"), F.coalesce(c("a_y2"), F.year(c("a1")) + F.when(c("a_m2") >= c("a_m1"), 0).otherwise(1)), at),
        "_w2": resolve_day(c("w_d2"), c("w_m"), F.coalesce(c("w_y"), F.year(c("w1"))), at),
        "_r1": F.when(text.rlike(r"\bpasado\s+manana\b"), F.date_add(at, 2)).when(text.rlike(r"\bmanana\b"), F.date_add(at, 1)).when(text.rlike(r"\bhoy\b"), at)
        .otherwise(F.date_add(at, F.when((c("ahead") == 0) & c("r_how").isin("proximo", "proxima"), 7).otherwise(c("ahead")))),
    })
    iso, second = F.get(c("iso"), 0), F.get(c("iso"), 1)
    forms = (
        (iso.isNotNull(), iso, F.when(second > iso, second), "iso"), (c("a2") >= c("a1"), c("a1"), c("a2"), "range"), (c("w2") >= c("w1"), c("w1"), c("w2"), "range"),
        (c("s1").isNotNull(), c("s1"), None, "day"), (c("n1").isNotNull(), c("n1"), None, "numeric"), (c("r1").isNotNull(), c("r1"), None, "relative"),
    )
    first, last, kind = F.lit(None).cast("date"), F.lit(None).cast("date"), F.lit(None).cast("string")
    for ok, a, b, name in reversed(forms):
        first, kind = F.when(ok, a).otherwise(first), F.when(ok, name).otherwise(kind)
        last = F.when(ok, F.lit(None).cast("date") if b is None else b).otherwise(last)
    return step.select(*own, first.alias("first_day"), last.alias("last_day"), kind.alias("day_kind"))


def hour_24(hour: Column, minute: Column, suffix: Column, part: Column) -> Column:
    """'HH:MM' of a stated hour: pm, tarde and noche add twelve, am and manana do not, and a bare 1 to 11 is in the evening."""
    suffix, part = F.replace(F.coalesce(suffix, F.lit("")), F.lit("."), F.lit("")), F.coalesce(part, F.lit(""))
    late = F.startswith(suffix, F.lit("p")) | part.isin("tarde", "noche")
    early = F.startswith(suffix, F.lit("a")) | (part == "manana")
    bare = (suffix == "") & (part == "") & hour.between(1, 11)
    h = F.when(late & (hour < 12), hour + 12).when(late, hour).when(early & (hour == 12), 0).when(early, hour).when(bare, hour + 12).otherwise(hour)
    return F.when(h.between(0, 23) & minute.between(0, 59), F.format_string("%02d:%02d", h.cast("int"), minute.cast("int")))


def _hours(folded: Column, pattern: str, minute: int | None, suffix: int | None, part: int | None, needs: tuple[str, ...] = ()) -> Column:
    """All stated hours of a form, as 'HH:MM', in order; a form that needs one of some texts is looked for where any of them stands."""
    whole = F.regexp_extract_all(folded, F.lit(pattern), F.lit(0))
    if needs:
        whole = F.when(reduce(or_, (folded.contains(n) for n in needs)), whole).otherwise(F.array().cast("array<string>"))

    def read(text: Column) -> Column:
        at = _number(text, pattern, minute) if minute else F.lit(0)
        none = F.lit(None).cast("string")
        return hour_24(_number(text, pattern, 1), at, _group(text, pattern, suffix) if suffix else none, _group(text, pattern, part) if part else none)

    return F.filter(F.transform(whole, read), lambda h: h.isNotNull())


def hours(rows: DataFrame, folded: str) -> DataFrame:
    """Adds start_time and doors_time: an announced show, else the first clock time other than the doors', else an hour by its words, else the doors."""
    text, own, none, zero = F.col(folded), rows.columns, F.lit(None).cast("string"), F.lit(0)
    rows = rows.select(*own, _group(text, DOORS, 0).alias("_doors"), _group(text, SHOW, 0).alias("_announced"))
    doors, show = F.col("_doors"), F.col("_announced")
    step = rows.select(
        *own, hour_24(_number(doors, DOORS, 1), F.coalesce(_number(doors, DOORS, 2), zero), none, none).alias("doors_time"),
        hour_24(_number(show, SHOW, 1), F.coalesce(_number(show, SHOW, 2), zero), none, none).alias("_show"),
        F.concat(_hours(text, CLOCK, 2, 3, None), _hours(text, LED, None, 2, 3, LED_NEEDS), _hours(text, TRAILED, None, 2, 3, TRAILED_NEEDS)).alias("_stated"),
    )
    other = F.get(F.expr("filter(_stated, h -> doors_time is null or h <> doors_time)"), 0)
    return step.select(*own, "doors_time", F.coalesce("_show", other, "doors_time").alias("start_time"))


def _said(text: Column) -> Column:
    """The words that a day was read from, by its form."""
    forms = {"iso": ISO, "range": f"{ACROSS}|{WITHIN}", "day": SINGLE, "numeric": NUMERIC, "relative": rf"\bpasado\s+manana\b|\bmanana\b|\bhoy\b|{NAMED}"}
    out = F.lit(None).cast("string")
    for kind, pattern in forms.items():
        out = F.when(F.col("day_kind") == kind, F.trim(F.regexp_extract(text, pattern, 0))).otherwise(out)
    return out


def when(rows: DataFrame, folded: str, anchor: str) -> DataFrame:
    """Adds starts, ends, doors, all_day, multi_day, confidence (desconocida where no day is found) and said, the words of the day.

    anchor is the day that relative words and unsaid years count from: that of publication, or today.
    """
    step = hours(days(rows, folded, anchor), folded)
    first, last, time = F.col("first_day"), F.col("last_day"), F.col("start_time")
    starts = F.to_timestamp_ntz(F.concat_ws(" ", first.cast("string"), F.coalesce(time, F.lit("00:00"))), F.lit("yyyy-MM-dd HH:mm"))
    ends = F.to_timestamp_ntz(F.concat(last.cast("string"), F.lit(" 23:59")), F.lit("yyyy-MM-dd HH:mm"))
    ranged = F.coalesce(last != first, F.lit(False))
    sure = F.when(F.col("day_kind") == "relative", "relativa").when(time.isNotNull(), "exacta").otherwise("aproximada")
    return step.select(
        *rows.columns, F.when(first.isNotNull(), starts).alias("starts"), F.when(ranged, ends).alias("ends"), F.when(first.isNotNull(), F.col("doors_time")).alias("doors"),
        (first.isNotNull() & time.isNull()).alias("all_day"), ranged.alias("multi_day"), F.when(first.isNull(), "desconocida").otherwise(sure).alias("confidence"), _said(F.col(folded)).alias("said"),
    )
