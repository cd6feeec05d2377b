"""Free forms of dates and hours, English and Spanish."""

from __future__ import annotations

from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.functions.free_dates import free_moment
from agenda_engine.operators import events

# now is 2026-08-14 10:00, a Friday
CASES = {
    "2026-08-12": "2026-08-12 00:00:00", "2026/8/2": "2026-08-02 00:00:00", "2026.08.12": "2026-08-12 00:00:00", "published 2026-08-12 at 9:05": "2026-08-12 09:05:00", "2026-08-12T19:30:00Z": "2026-08-12 15:30:00",
    "2026-08-12T19:30:00+02:00": "2026-08-12 13:30:00", "2026-08-12 19:30:15.250 -0400": "2026-08-12 19:30:15", "2026-08-12 01:00 UTC": "2026-08-11 21:00:00", "08/12/2026": "2026-08-12 00:00:00", "8/2/26": "2026-08-02 00:00:00",
    "25/12/2026": "2026-12-25 00:00:00", "12.08.2026": "2026-08-12 00:00:00", "12-25-2025": "2025-12-25 00:00:00", "1/2/75": "1975-01-02 00:00:00", "12 August 2026": "2026-08-12 00:00:00", "12 Aug 2026": "2026-08-12 00:00:00",
    "Wed, 12 Aug 2026 19:30:00 GMT": "2026-08-12 15:30:00", "12th of August, 2026": "2026-08-12 00:00:00", "1st August": "2026-08-01 00:00:00", "August 12, 2026": "2026-08-12 00:00:00", "Aug. 12 2026": "2026-08-12 00:00:00",
    "August 3rd": "2026-08-03 00:00:00", "Posted on Sept 5, 2025 at 7:45 PM": "2025-09-05 19:45:00", "5 Sep 2025 12:10 am": "2025-09-05 00:10:00", "5 Sep 2025 12:10 p.m.": "2025-09-05 12:10:00", "Updated: 03 March 2026 - 08:00": "2026-03-03 08:00:00",
    "12 de agosto de 2026": "2026-08-12 00:00:00", "12 de agosto del 2026": "2026-08-12 00:00:00", "Miércoles 12 de agosto de 2026, 19:30": "2026-08-12 19:30:00", "3 de ENERO": "2026-01-03 00:00:00", "3 ene 2027": "2027-01-03 00:00:00",
    "agosto 12, 2026": "2026-08-12 00:00:00", "2 de setiembre, 8 pm": "2026-09-02 20:00:00", "30 de dic. de 2025": "2025-12-30 00:00:00", "1 de mayo 10:00 am": "2026-05-01 10:00:00", "publicado el 7 de junio a las 21:15": "2026-06-07 21:15:00",
    "August 2025": "2025-08-14 00:00:00", "February 2026": "2026-02-14 00:00:00", "octubre de 2026": "2026-10-14 00:00:00", "Dec, 2024": "2024-12-14 00:00:00", "Friday": "2026-08-14 00:00:00", "monday 9:00": "2026-08-17 09:00:00",
    "el sábado a las 20:00": "2026-08-15 20:00:00", "jueves": "2026-08-20 00:00:00", "Sun 7pm": "2026-08-16 19:00:00", "19:30": "2026-08-14 19:30:00", "a las 7 pm": "2026-08-14 19:00:00", "12 am": "2026-08-14 00:00:00", "7:05:09": "2026-08-14 07:05:09",
    "29 February 2024": "2024-02-29 00:00:00", "29 February 2025": None, "31/31/2026": None, "2026-13-01": None, "quién sabe": None, "": None, None: None, "marzal": None, "42": None, "25:99": None, "decente y mayor": None, "May 2026": "2026-05-14 00:00:00",
    "12-Aug-2026": "2026-08-12 00:00:00", "12Aug2026": "2026-08-12 00:00:00",
}


def test_free_forms(spark):
    now = clock.moment("2026-08-14 10:00:00")
    rows = spark.createDataFrame([(t,) for t in CASES], "t string").select("t", F.date_format(free_moment(F.col("t"), now, events.OFFSET_MINUTES), "yyyy-MM-dd HH:mm:ss").alias("m")).collect()
    assert len(CASES) >= 60 and {r.t: r.m for r in rows} == CASES


def test_publication_takes_words_before_forms(spark):
    now = clock.moment("2026-08-14 10:00:00")
    said = {"Ayer a las 19:30": "2026-08-13 10:00:00", "hace 2 h": "2026-08-14 08:00:00", "hoy": "2026-08-14 10:00:00", "Wed, 12 Aug 2026 19:30:00 GMT": "2026-08-12 15:30:00", "12 August 2026": "2026-08-12 00:00:00"}
    rows = spark.createDataFrame([(t,) for t in said], "t string").select("t", F.date_format(events.published(F.col("t"), now), "yyyy-MM-dd HH:mm:ss").alias("m")).collect()
    assert {r.t: r.m for r in rows} == said
