"""The catalogue across runs: stable ids, changes, history, carry-over and expiry against the last snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.functions.durable import cut, dealt, shuffled
from agenda_engine.functions.text import fold, jaccard, words
from agenda_engine.operators.resolve import alike, rare_words
from agenda_engine.operators.taking import MOST, taken
from agenda_engine.operators.turns import BOUND, greedy

# Words that tell nothing here, points of a match, and limits.
STOP_WORDS = ("de", "la", "el", "los", "las", "en", "y", "del", "con", "por", "para", "un", "una", "gran", "evento", "bolivia", "vivo", "presenta", "entrada")
POINTS = {"day": 0.30, "venue": 0.22, "other_venue": -0.12, "city": 0.08, "category": 0.06, "url": 0.20, "words": 0.34}
THRESHOLD, KEEP_DAYS, HISTORY_LENGTH, CAP, DESCRIPTION_CHARS = 0.62, 4, 40, 3000, 500
#: What the score of a row reads.
KEYS = ["m_day", "m_city", "m_venue", "m_urls", "m_words", "category"]
HISTORY = "array<struct<at:string,reason:string,status:string,lifecycle:string,starts_at:string,price_from:double,source_count:int,changes:array<string>>>"


def plain(text: Column) -> Column:
    """Folded, with anything but letters, digits and spaces as spaces; addresses stay."""
    return F.trim(F.regexp_replace(fold(text), "[^a-z0-9]+", " "))


def keyed(events: DataFrame) -> DataFrame:
    """Adds what matching reads, once a row: day, folded city and venue, addresses and words."""
    said = F.concat_ws(
        " ", F.coalesce("title", F.lit("")), F.array_join(F.coalesce("artists", F.array().cast("array<string>")), " "),
        F.substring(F.coalesce("description", F.lit("")), 1, DESCRIPTION_CHARS), F.coalesce("venue", F.lit("")),
    )
    urls = F.coalesce(F.when(F.size("all_urls") > 0, F.col("all_urls")), F.array("url"))
    return events.withColumns({
        "m_day": F.substring(F.coalesce("starts_at", F.lit("")), 1, 10), "m_city": plain(F.col("city")), "m_venue": plain(F.col("venue")),
        "m_urls": F.array_compact(urls), "m_words": F.array_except(words(fold(said), 4), F.array(*map(F.lit, STOP_WORDS))),
    })


def score(a: str, b: str) -> Column:
    """How likely two aliased keyed rows are one event, 0 to 1; points are added in a fixed order, in doubles."""

    def x(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def same(name: str) -> Column:
        return (x(a, name) != "") & (x(a, name) == x(b, name))

    def differ(name: str) -> Column:
        return (x(a, name) != "") & (x(b, name) != "") & (x(a, name) != x(b, name))

    def add(points: str, condition: Column) -> Column:
        return F.when(condition, F.lit(POINTS[points])).otherwise(F.lit(0.0))

    venue = F.when(same("m_venue"), F.lit(POINTS["venue"])).when(differ("m_venue"), F.lit(POINTS["other_venue"])).otherwise(F.lit(0.0))
    total = add("day", same("m_day")) + venue + add("city", same("m_city")) + add("category", x(a, "category").eqNullSafe(x(b, "category")))
    total = total + add("url", F.arrays_overlap(x(a, "m_urls"), x(b, "m_urls"))) + F.least(jaccard(x(a, "m_words"), x(b, "m_words")), F.lit(POINTS["words"]))
    return F.when(differ("m_day") | differ("m_city"), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def stable_id(events: DataFrame) -> Column:
    """'evt_' and fourteen digits from what announcements of one event share; over keyed rows."""
    head = F.array_join(F.slice(F.array_sort("m_words"), 1, 6), " ")
    return F.concat(F.lit("evt_"), F.substring(F.sha1(F.concat_ws("|", "m_day", "m_city", "m_venue", F.coalesce("category", F.lit("")), head)), 1, 14))


def candidates(now: DataFrame, old: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(n, o): pairs that can reach the threshold, from equi-joins on what their points need.

    Two dated rows share the day, and a venue, an address or so many words that the rest of the points does not suffice without;
    rows of which one is undated share a venue or an address, and a word where the threshold is so low that words suffice.
    """
    told = ["m_day", "m_venue", "m_urls", "m_words"]
    n, o = now.select("position", *told), old.select("position", *told)
    n_dated, o_dated, n_bare, o_bare = n.where("m_day <> ''"), o.where("m_day <> ''"), n.where("m_day = ''"), o.where("m_day = ''")

    def met(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
        return a.withColumnRenamed("position", "n").join(b.withColumnRenamed("position", "o"), list(keys)).select("n", "o")

    def venues(rows: DataFrame) -> DataFrame:
        return rows.where("m_venue <> ''").select("position", "m_day", "m_venue")

    def urls(rows: DataFrame) -> DataFrame:
        return rows.select("position", "m_day", F.explode("m_urls").alias("url"))

    needed = threshold - POINTS["day"] - POINTS["city"] - POINTS["category"]
    if needed > 0:
        both = n_dated.select((F.col("position") * 2).alias("position"), "m_day", "m_words").unionByName(o_dated.select((F.col("position") * 2 + 1).alias("position"), "m_day", "m_words"))
        rare = rare_words(both, "m_words", min(needed, POINTS["words"]) * (1 - 1e-9))
        sides = [rare.where(F.col("position") % 2 == k).withColumn("position", F.expr("position div 2")) for k in (0, 1)]
        parts = [met(*sides, "m_day", "word"), met(venues(n_dated), venues(o_dated), "m_day", "m_venue"), met(urls(n_dated), urls(o_dated), "m_day", "url")]
    else:
        parts = [met(n_dated.select("position", "m_day"), o_dated.select("position", "m_day"), "m_day")]
    for a, b in ((n_bare, o), (n_dated, o_bare)):
        parts += [met(venues(a).drop("m_day"), venues(b).drop("m_day"), "m_venue"), met(urls(a).drop("m_day"), urls(b).drop("m_day"), "url")]
        if threshold <= POINTS["words"] + POINTS["city"] + POINTS["category"]:
            parts.append(met(a.select("position", F.explode("m_words").alias("word")), b.select("position", F.explode("m_words").alias("word")), "word"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def class_scores(now: DataFrame, old: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, score): pairs of classes of current and archived rows that reach the threshold, each by its first row."""
    a, b = (rows.where(F.col("position") == F.col("m_class")) for rows in (now, old))
    met = candidates(a, b, threshold).join(a.alias("a"), F.col("n") == F.col("a.position")).join(b.alias("b"), F.col("o") == F.col("b.position"))
    return met.select(F.col("n").alias("a"), F.col("o").alias("b"), score("a", "b").alias("score")).where(F.col("score") >= threshold)


def matched(now: DataFrame, old: DataFrame, threshold: float = THRESHOLD, bound: int = BOUND, most: int = MOST) -> DataFrame:
    """(n, o): current rows in order take the archived row that is left with the best score, the earlier one on ties; both sides keyed, with m_class.

    Where words alone cannot reach the threshold no pair is laid out, but for rows that are linked to more than `most`.
    """

    def by_pairs(now: DataFrame, old: DataFrame) -> DataFrame:
        return greedy(now.select(F.col("position").alias("n"), F.col("m_class").alias("a")), old.select(F.col("position").alias("o"), F.col("m_class").alias("b")), class_scores(now, old, threshold), bound)

    if threshold <= POINTS["words"] + POINTS["city"] + POINTS["category"]:
        return by_pairs(now, old)
    return taken(now, old, threshold, POINTS, by_pairs, most)


def changes(old: str, new: str) -> Column:
    """What a reader would want to hear of: state, day, price and venue."""
    o, n = (lambda c: F.col(f"{old}.{c}")), (lambda c: F.col(f"{new}.{c}"))
    day = [F.substring(F.coalesce(x("starts_at"), F.lit("")), 1, 10) for x in (o, n)]
    said = F.concat(F.lit("estado:"), F.coalesce(o("status"), F.lit("None")), F.lit("->"), F.coalesce(n("status"), F.lit("None")))
    return F.array_compact(F.array(
        F.when(~o("status").eqNullSafe(n("status")), said), F.when(day[0] != day[1], F.lit("fecha_cambiada")),
        F.when(~o("price_from").eqNullSafe(n("price_from")), F.lit("precio_cambiado")),
        F.when(~o("venue").eqNullSafe(n("venue")) & (F.coalesce(n("venue"), F.lit("")) != ""), F.lit("sede_cambiada")),
    ))


def history_entry(at: str, reason: str, changed: Column) -> Column:
    """One entry of a history, over the columns of a current row."""
    return F.struct(
        F.lit(at).alias("at"), F.lit(reason).alias("reason"), F.col("status"), F.col("lifecycle"), F.col("starts_at"),
        F.col("price_from").cast("double").alias("price_from"), F.coalesce("source_count", F.lit(1)).cast("int").alias("source_count"), changed.alias("changes"),
    )


def appended(history: Column, entry: Column, add: Column) -> Column:
    """A history with an entry where it is wanted, its last HISTORY_LENGTH kept."""
    whole = F.when(add, F.array_append(history, entry)).otherwise(history)
    return F.slice(whole, F.greatest(F.lit(1), F.size(whole) - (HISTORY_LENGTH - 1)), F.lit(HISTORY_LENGTH))


def last_entries(rows: DataFrame, key: str, order: str, entry: str, most: int = HISTORY_LENGTH) -> DataFrame:
    """(key, history): the last entries of each key in order; the others never leave their partition."""
    last = Window.partitionBy(key).orderBy(F.col(order).desc())
    kept = rows.select(key, order, entry).withColumn("n", F.row_number().over(last)).where(F.col("n") <= most)
    return kept.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, entry))).alias("h")).select(key, F.transform("h", lambda s: s[entry]).alias("history"))


def with_time(events: DataFrame, now: str) -> DataFrame:
    """Recomputes what depends on the moment: lifecycle, days_until, is_upcoming."""
    at, starts, ends = clock.moment(now), F.to_timestamp_ntz(F.substring("starts_at", 1, 16), F.lit("yyyy-MM-dd'T'HH:mm")), F.to_timestamp_ntz(F.substring("ends_at", 1, 16), F.lit("yyyy-MM-dd'T'HH:mm"))
    timed = events.withColumns({"lifecycle": clock.lifecycle(starts, ends, at), "days_until": clock.days_until(starts, at)})
    return timed.withColumn("is_upcoming", F.col("lifecycle").isin("proximo", "hoy", "en_curso"))


def alive(now: str, keep_days: int = KEEP_DAYS) -> Column:
    """True for a row that nobody saw this run and that is kept: dated rows until some days after the end, undated ones after the last sight."""
    limit = clock.moment(now) - F.expr(f"interval {max(0, keep_days)} days")
    ended = F.to_timestamp_ntz(F.substring(F.coalesce("ends_at", "starts_at"), 1, 16), F.lit("yyyy-MM-dd'T'HH:mm"))
    seen = F.to_timestamp_ntz(F.substring(F.coalesce("last_seen_at", "first_seen_at"), 1, 16), F.lit("yyyy-MM-dd'T'HH:mm"))
    return F.coalesce(F.when(F.col("starts_at").isNotNull(), ended >= limit).otherwise(seen >= limit), F.lit(False))


def read_snapshot(spark: SparkSession, path: str, schema, missing_ok: bool = True) -> DataFrame:
    """The last snapshot; an empty one where there is none yet. A snapshot that cannot be read is an error, never an empty catalogue."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if missing_ok and not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def reconcile(current: DataFrame, archive: DataFrame, at: str, threshold: float = THRESHOLD, keep_days: int = KEEP_DAYS, cap: int | None = CAP, bound: int = BOUND) -> DataFrame:
    """The whole catalogue after a run: what was seen, with the ids and histories of what it matches, and what is carried.

    Both sides have a position. `at` is 'YYYY-MM-DD HH:MM:SS'; rows carry it as an ISO text.
    """
    stamp = at.replace(" ", "T")
    with shuffled(current.sparkSession):
        now, old = (cut(alike(cut(rows), KEYS, "m_class")) for rows in (with_time(keyed(dealt(current)), at), keyed(dealt(archive))))
        pairs = cut(matched(now, old, threshold, bound))
    joined = now.alias("a").join(pairs.hint("merge"), F.col("a.position") == F.col("n"), "left").join(old.alias("b").hint("merge"), F.col("o") == F.col("b.position"), "left")
    made = ("position", "source_count", "event_id", "first_seen_at", "last_seen_at", "history", "lifecycle", "days_until", "is_upcoming", "seen_this_run", "changed_this_run", "history_count")
    base = [c for c in current.columns if c not in made]
    told = joined.select(
        "a.position", *(F.col(f"a.{c}") for c in base), "a.lifecycle", "a.days_until", "a.is_upcoming", *(F.col(f"a.m_{c}") for c in ("day", "city", "venue", "words")),
        F.greatest(F.coalesce("a.source_count", F.lit(1)), F.coalesce("b.source_count", F.lit(1))).cast("int").alias("source_count"),
        F.col("o").isNotNull().alias("known"), F.col("b.event_id").alias("old_id"), F.coalesce("b.first_seen_at", F.lit(stamp)).alias("first_seen_at"),
        F.coalesce("b.history", F.array().cast(HISTORY)).alias("old_history"), F.when(F.col("o").isNotNull(), changes("b", "a")).otherwise(F.array().cast("array<string>")).alias("changed_this_run"),
    )
    first = F.when(F.col("known"), "actualizacion").otherwise("primera_deteccion")
    entry = history_entry(stamp, "", F.when(F.col("known"), F.col("changed_this_run"))).withField("reason", first)
    add = ~F.col("known") | (F.size("changed_this_run") > 0)
    seen = told.select(
        "position", *base, "lifecycle", "days_until", "is_upcoming", "source_count", F.coalesce("old_id", stable_id(told)).alias("event_id"), "first_seen_at",
        F.lit(stamp).alias("last_seen_at"), F.lit(True).alias("seen_this_run"), "changed_this_run", appended(F.col("old_history"), entry, add).alias("history"),
    )
    left = old.join(pairs.select(F.col("o").alias("position")).hint("merge"), "position", "left_anti")
    carried = with_time(left.where(alive(at, keep_days)), at).withColumns({
        "seen_this_run": F.lit(False), "changed_this_run": F.array().cast("array<string>"), "last_seen_at": F.coalesce("last_seen_at", "first_seen_at"),
        "position": F.col("position") + F.lit(1 << 40),
    })
    whole = seen.unionByName(carried.select(*(c for c in seen.columns if c in carried.columns)), allowMissingColumns=True)
    once = Window.partitionBy("event_id").orderBy(F.col("seen_this_run").desc(), "position")
    kept = whole.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n").withColumn("history_count", F.size("history"))
    ordered = kept.orderBy(F.col("starts_at").asc_nulls_last(), F.coalesce("confidence", F.lit(0.0)).desc(), "position")
    return ordered if cap is None else ordered.limit(cap)
