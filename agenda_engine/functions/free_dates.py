"""Dates and hours in free text, English or Spanish, as column expressions.

A text is read once by token classes: numbers in the order of a date, a month's name with a day or a year, a weekday, an hour, an offset. The first
class that gives a day that exists counts; what is missing comes from the moment of reading, an hour that is missing is midnight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agenda_engine.functions.text import fold, let

# Names of months and weekdays in folded texts, each beginning with its short form or one of them.
MONTHS = {
    "jan(?:uary)?": 1, "ene(?:ro)?": 1, "feb(?:ruary|rero)?": 2, "mar(?:ch|zo)?": 3, "apr(?:il)?": 4, "abr(?:il)?": 4, "may(?:o)?": 5, "jun(?:e|io)?": 6, "jul(?:y|io)?": 7, "aug(?:ust)?": 8, "ago(?:sto)?": 8,
    "sep(?:t|tember|tiembre)?": 9, "set(?:iembre)?": 9, "oct(?:ober|ubre)?": 10, "nov(?:ember|iembre)?": 11, "dec(?:ember)?": 12, "dic(?:iembre)?": 12,
}
WEEKDAYS = {
    "mon(?:day)?|lunes": 1, "tue(?:s|sday)?|martes": 2, "wed(?:nesday)?|miercoles": 3, "thu(?:rs|rsday)?|jueves": 4, "fri(?:day)?|viernes": 5, "sat(?:urday)?|sabado": 6, "sun(?:day)?|domingo": 7,
}
MONTH = rf"(?<![a-z])({'|'.join(MONTHS)})(?![a-z])[.]?"
YEAR_FIRST = r"(?<!\d)(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)"
NUMBERS = r"(?<![\d./-])(\d{1,2})([/.-])(\d{1,2})[/.-](\d{4}|\d{2})(?![\d/])"
DAY_MONTH = rf"(?<![\d:])(\d{{1,2}})(?:st|nd|rd|th|º)?[\s-]*(?:de\s+|of\s+)?{MONTH}(?:[\s,-]*(?:del?\s+|of\s+)?(\d{{4}})(?!\d))?"
MONTH_DAY = rf"{MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?(?![\d:])(?:[\s,]+(\d{{4}})(?!\d))?"
MONTH_YEAR = rf"(?<!\d(?:st|nd|rd|th|º)?[\s-]{{0,2}}(?:de\s|of\s)?){MONTH}[\s,]*(?:del?\s+|of\s+)?(\d{{4}})(?!\d)"
CLOCK = r"(?<![\d:])([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d))?(?:[.]\d+)?\s*(a[.]?m|p[.]?m)?(?![a-z])"
HOUR_ALONE = r"(?<![\d:])(1[0-2]|0?[1-9])\s*(a[.]?m|p[.]?m)(?![a-z])"
OFFSET = r":[0-5]\d(?::[0-5]\d)?(?:[.]\d+)?\s*(?:a[.]?m[.]?|p[.]?m[.]?)?\s*(z|utc|gmt)?([+-]\d{2}:?\d{2})?(?![\d])"


def _numbered(said: Column, names: dict[str, int]) -> Column:
    """The number of a name."""
    out = F.lit(None).cast("int")
    for form, n in names.items():
        out = F.when(said.rlike(f"^(?:{form})$"), n).otherwise(out)
    return out


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))


def _years(said: Column) -> Column:
    """A year of two digits in this century, or in the last where it is 70 or more."""
    return F.when(F.length(said) == 2, said.try_cast("int") + F.when(said.try_cast("int") >= 70, 1900).otherwise(2000)).otherwise(said.try_cast("int"))


def _date(t: Column, now: Column) -> Column:
    first, second = _number(t, NUMBERS, 1), _number(t, NUMBERS, 3)
    day_first = (first > 12) | (F.regexp_extract(t, NUMBERS, 2) == ".")
    year = F.year(now)
    of_month = _day(_number(t, MONTH_YEAR, 2), _numbered(F.regexp_extract(t, MONTH_YEAR, 1), MONTHS), F.lit(1))
    in_month = let(of_month, lambda m: F.least(F.date_add(F.to_date(m), F.dayofmonth(now) - 1), F.last_day(F.to_date(m))).cast("timestamp_ntz"))
    weekday = let(_numbered(F.regexp_extract(t, rf"(?<![a-z])({'|'.join(WEEKDAYS)})(?![a-z])", 1), WEEKDAYS), lambda w: F.date_add(F.to_date(now), F.pmod(w - (F.weekday(now) + 1), F.lit(7))).cast("timestamp_ntz"))
    return F.coalesce(
        _day(_number(t, YEAR_FIRST, 1), _number(t, YEAR_FIRST, 2), _number(t, YEAR_FIRST, 3)),
        let(_years(F.regexp_extract(t, NUMBERS, 4)), lambda y: _day(y, F.when(day_first, second).otherwise(first), F.when(day_first, first).otherwise(second))),
        _day(F.coalesce(_number(t, DAY_MONTH, 3), year), _numbered(F.regexp_extract(t, DAY_MONTH, 2), MONTHS), _number(t, DAY_MONTH, 1)),
        _day(F.coalesce(_number(t, MONTH_DAY, 3), year), _numbered(F.regexp_extract(t, MONTH_DAY, 1), MONTHS), _number(t, MONTH_DAY, 2)),
        in_month, weekday,
    )


def _seconds(t: Column) -> Column:
    """Seconds since midnight of the first hour in a text, or null."""
    hour, half = F.coalesce(_number(t, CLOCK, 1), _number(t, HOUR_ALONE, 1)), F.when(t.rlike(CLOCK), F.regexp_extract(t, CLOCK, 4)).otherwise(F.regexp_extract(t, HOUR_ALONE, 2))
    of_day = F.when(half.startswith("p") & (hour < 12), hour + 12).when(half.startswith("a") & (hour == 12), 0).otherwise(hour)
    return of_day * 3600 + F.coalesce(_number(t, CLOCK, 2), F.lit(0)) * 60 + F.coalesce(_number(t, CLOCK, 3), F.lit(0))


def free_moment(said: Column, now: Column, offset_minutes: int) -> Column:
    """The moment that a text tells of, as a wall clock at an offset; null where nothing in it dates."""

    def read(t: Column) -> Column:
        stated = F.regexp_extract(t, OFFSET, 2)
        away = F.when(stated != "", (F.substring(stated, 2, 2).cast("int") * 60 + F.substring(F.replace(stated, F.lit(":"), F.lit("")), 4, 2).cast("int")) * F.when(stated.startswith("-"), -1).otherwise(1))
        away = F.coalesce(away, F.when(F.regexp_extract(t, OFFSET, 1) != "", 0))
        shift = F.coalesce((F.lit(offset_minutes) - away) * 60, F.lit(0))

        def at(x: Column) -> Column:
            whole = F.coalesce(x["date"], F.when(x["seconds"].isNotNull(), F.date_trunc("day", now).cast("timestamp_ntz")))
            return whole + F.make_dt_interval(secs=(F.coalesce(x["seconds"], F.lit(0)) + x["shift"]).cast("decimal(18,6)"))

        return let(F.struct(_date(t, now).alias("date"), _seconds(t).alias("seconds"), shift.alias("shift")), at)

    return let(fold(said), read)
