"""Time relative to one injected moment; nothing here reads a wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published format.
WEEKDAYS = ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
NEVER_SEEN_HOURS = 100000.0


def moment(now: str) -> Column:
    """A literal wall-clock moment without zone, from 'YYYY-MM-DD HH:MM:SS'."""
    return F.to_timestamp_ntz(F.lit(now))


def iso_moment(iso: Column) -> Column:
    """An ISO text as a moment of its own offset; null for anything else, years and bare times included."""
    sound = iso.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(sound, F.try_to_timestamp(iso))


ISO = r"^\s*(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2})?(?:\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?\s*$"


def wall_moment(iso: Column) -> Column:
    """The wall-clock moment that an ISO text writes, in whatever offset; midnight for a bare day, null for anything else."""
    part = [F.regexp_extract(iso, ISO, k) for k in (1, 2, 3)]
    time = F.concat(F.when(part[1] == "", "00:00").otherwise(part[1]), F.when(part[2] == "", ":00").otherwise(part[2]))
    return F.when(iso.rlike(ISO), F.try_to_timestamp(F.concat(part[0], F.lit(" "), time), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))


def offset_text(iso: Column) -> Column:
    """The offset that an ISO text writes, as '+HH:MM'; null for none."""
    said = F.regexp_replace(F.nullif(F.regexp_extract(iso, ISO, 4), F.lit("")), "^Z$", "+00:00")
    return F.regexp_replace(said, r"^([+-]\d{2})(\d{2})$", "$1:$2")


def local_moment(iso: Column, offset_minutes: int) -> Column:
    """The wall-clock moment, at an offset, of an ISO text; one without an offset of its own is taken as it stands."""
    said = offset_text(iso)
    own = F.substring(said, 2, 2).cast("int") * 60 + F.substring(said, 5, 2).cast("int")
    own = F.when(F.startswith(said, F.lit("-")), -own).otherwise(own)
    shift = F.coalesce(F.lit(offset_minutes) - own, F.lit(0))
    return wall_moment(iso) + F.make_dt_interval(F.lit(0), F.lit(0), shift)


def epoch_ms(moment: Column, offset_minutes: int = 0) -> Column:
    """Milliseconds since 1970 of a wall-clock moment at an offset."""
    day, second = F.unix_date(F.to_date(moment)).cast("long"), F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return ((day * 86400 + second - offset_minutes * 60) * 1000).cast("long")


def iso_day(iso: Column) -> Column:
    """The calendar day that an ISO text names, in its own offset."""
    return F.try_to_date(F.substring(iso, 1, 10), "yyyy-MM-dd")


def lifecycle(starts: Column, ends: Column, now: Column) -> Column:
    """sin_fecha, en_curso (between start and end), hoy (on its own day), proximo or finalizado at a moment."""
    return (
        F.when(starts.isNull(), "sin_fecha")
        .when(F.coalesce((starts <= now) & (now <= ends), F.lit(False)), "en_curso")
        .when(F.to_date(starts) == F.to_date(now), "hoy")
        .when(starts > now, "proximo")
        .otherwise("finalizado")
    )


def days_until(starts: Column, now: Column) -> Column:
    """Calendar days from now to the start; negative once it is past."""
    return F.datediff(F.to_date(starts), F.to_date(now))


def weekend(now: Column) -> tuple[Column, Column]:
    """Saturday and Sunday of this weekend, or of the next; on a Sunday it is still this one."""
    today = F.to_date(now)
    ahead = F.when(F.weekday(today) == 6, -1).otherwise(F.pmod(F.lit(5) - F.weekday(today), F.lit(7)))
    saturday = F.date_add(today, ahead)
    return saturday, F.date_add(saturday, 1)


def _name(names: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), index)


def display_date(starts: Column, ends: Column, multi_day: Column, all_day: Column) -> Column:
    """'Domingo 23 de agosto · 20:00', 'Del 5 al 7 de septiembre', or the form that crosses months."""
    day, month = F.dayofmonth(starts).cast("string"), _name(MONTHS, F.month(starts))
    last, last_month = F.dayofmonth(ends).cast("string"), _name(MONTHS, F.month(ends))
    same = (F.month(starts) == F.month(ends)) & (F.year(starts) == F.year(ends))
    ranged = F.when(same, F.concat(F.lit("Del "), day, F.lit(" al "), last, F.lit(" de "), month)).otherwise(
        F.concat(F.lit("Del "), day, F.lit(" de "), month, F.lit(" al "), last, F.lit(" de "), last_month)
    )
    single = F.concat(F.initcap(_name(WEEKDAYS, F.weekday(starts) + 1)), F.lit(" "), day, F.lit(" de "), month)
    timed = F.concat(single, F.lit(" · "), F.date_format(starts, "HH:mm"))
    return F.when(starts.isNull(), F.lit(None)).when(multi_day & ends.isNotNull(), ranged).when(all_day, single).otherwise(timed)


def hours_since(seen: Column, now: Column) -> Column:
    """Hours from a moment to now, at least 0; a large fixed number where there is none."""
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(seen.cast("timestamp"))
    # greatest() passes over nulls, so a missing moment is told apart before it
    return F.when(micros.isNull(), NEVER_SEEN_HOURS).otherwise(F.greatest(F.lit(0.0), micros / F.lit(3.6e9)))
