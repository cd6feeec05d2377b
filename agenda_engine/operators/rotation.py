"""Which sources get the next turns, and what a turn taught about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.operators.order import ranks

# Weights and dampings of the priority.
CLASS_WEIGHT = {"ticketera": 2.0, "eventos": 1.8, "venue": 1.5, "cultura_oficial": 1.3, "municipio": 1.1, "media": 1.0}
TIER_WEIGHT = {1: 1.5, 2: 1.2, 3: 1.0}
FAILURES_DAMP = ((5, 0.15), (3, 0.35), (2, 0.7))
FORGET_DAYS = 45


def _lookup(value: Column, table: dict) -> Column:
    out = F.lit(1.0)
    for k, v in table.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def priority(last_success: Column, source_class: Column, tier: Column, failures: Column, now: Column) -> Column:
    """Hours without data, weighted by class and tier, damped by failures in a row."""
    damp = F.lit(1.0)
    for least, factor in reversed(FAILURES_DAMP):
        damp = F.when(F.coalesce(failures, F.lit(0)) >= least, factor).otherwise(damp)
    return clock.hours_since(last_success, now) * _lookup(source_class, CLASS_WEIGHT) * _lookup(tier, TIER_WEIGHT) * damp


def plan_wave(scored: DataFrame, id_col: str = "source_id", score: str = "score", size: int = 2, groups: int = 20, alone: int = 6) -> DataFrame:
    """(source_id, rank, slot, group_no): the first sources alone, the next dealt round-robin over the other groups, the rest deferred.

    Sources are ranked by sampled ranges, so no task sees them all; their number comes with one count.
    """
    size, groups = max(1, size), max(1, groups)
    alone = max(0, min(alone, groups))
    ranked = ranks(scored.select(id_col, score), [F.col(score).desc(), F.col(id_col)]).withColumn("rank", F.col("rank").cast("int"))
    ranked = ranked.withColumn("total", F.lit(scored.count()).cast("int"))
    shared = F.least(F.greatest(F.col("total") - F.least(F.col("total"), F.lit(alone)), F.lit(0)), F.lit((groups - alone) * size))
    solos = F.least(F.col("total"), F.lit(alone))
    dealt = F.greatest(F.least(F.lit(groups) - solos, F.ceil(shared / size)), F.lit(1))
    slot = F.when(F.col("rank") <= solos, "alone").when(F.col("rank") <= solos + shared, "shared").otherwise("deferred")
    group_no = F.when(slot == "alone", F.col("rank")).when(slot == "shared", solos + F.pmod(F.col("rank") - solos - 1, dealt) + 1)
    return ranked.select(id_col, score, "rank", slot.alias("slot"), group_no.cast("int").alias("group_no"))


def wave_matrix(wave: DataFrame, id_col: str = "source_id") -> DataFrame:
    """One row: the compact JSON {"include":[{nombre, orden, fuentes}]} of a wave."""
    dealt = wave.where("group_no is not null").groupBy("group_no").agg(F.sort_array(F.collect_list(F.struct("rank", id_col))).alias("s"))
    named = F.struct(F.format_string("g%02d", "group_no").alias("nombre"), (F.col("group_no") - 1).alias("orden"), F.array_join(F.col(f"s.{id_col}"), ",").alias("fuentes"))
    one = dealt.agg(F.sort_array(F.collect_list(F.struct("group_no", named.alias("g")))).alias("all"))
    return one.select(F.to_json(F.struct(F.col("all.g").alias("include"))).alias("matrix"))


def outcome_status(error: Column, items: Column) -> Column:
    """The state that a turn leaves: an error's text decides, then whether anything came."""
    text = F.lower(error)
    blocked = text.contains("bloque") | text.contains("ocult") | text.contains("blocked")
    failed = F.when(text.startswith("omitida"), "omitida").when(blocked, "bloqueada").otherwise("error")
    return F.when(F.coalesce(error, F.lit("")) != "", failed).when(F.coalesce(items, F.lit(0)) > 0, "ok").otherwise("sin_publicaciones")


def update(rotation: DataFrame, outcomes: DataFrame, at: str, forget_days: int = FORGET_DAYS) -> DataFrame:
    """The rotation after a wave. A block penalises nobody, a skip changes no counter, an empty turn is a turn.

    rotation: source_id, last_try, last_success, state, failures, blocks, last_block, successes, last_error.
    outcomes: source_id, n_items, error. Sources not tried within `forget_days` are forgotten.
    """
    now = clock.moment(at)
    new = outcomes.select("source_id", outcome_status(F.col("error"), F.col("n_items")).alias("new_state"), F.col("error").alias("new_error"))
    met = rotation.join(new, "source_id", "full")
    state, tried = F.col("new_state"), F.col("new_state").isNotNull()
    done = F.coalesce(state.isin("ok", "sin_publicaciones"), F.lit(False))
    failures = F.when(done, 0).otherwise(F.coalesce("failures", F.lit(0)) + F.when(state == "error", 1).otherwise(0))
    error = F.when(state == "error", F.substring(F.trim(F.regexp_replace("new_error", r"\s+", " ")), 1, 200)).when(state == "ok", F.lit(None)).otherwise(F.col("last_error"))
    after = met.select(
        "source_id",
        F.when(tried, now).otherwise(F.col("last_try")).alias("last_try"),
        F.when(done, now).otherwise(F.col("last_success")).alias("last_success"),
        F.coalesce("new_state", "state").alias("state"),
        failures.cast("int").alias("failures"),
        (F.coalesce("blocks", F.lit(0)) + F.when(state == "bloqueada", 1).otherwise(0)).cast("int").alias("blocks"),
        F.when(state == "bloqueada", now).otherwise(F.col("last_block")).alias("last_block"),
        (F.coalesce("successes", F.lit(0)) + F.when(state == "ok", 1).otherwise(0)).cast("int").alias("successes"),
        error.alias("last_error"),
    )
    return after.where(clock.hours_since(F.col("last_try"), now) <= 24 * max(1, forget_days))


def unreached(sources: DataFrame, rotation: DataFrame) -> DataFrame:
    """(list, source_id): the three lists of coverage() as rows, for catalogues of sources that are too long for a row."""
    met = sources.select("source_id").join(rotation, "source_id", "left")
    lists = {"never_seen": F.col("last_success").isNull(), "blocked_last_time": F.col("state") == "bloqueada", "failing": F.col("failures") >= 3}
    return met.select(F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in lists.items())))).alias("list"), "source_id")


def coverage(sources: DataFrame, rotation: DataFrame, now: str) -> DataFrame:
    """One row: how much of the catalogue of sources is being reached. The lists hold source ids of a configuration."""
    met = sources.select("source_id").join(rotation, "source_id", "left")
    seen = F.col("last_success").isNotNull()
    hours = F.when(seen, clock.hours_since(F.col("last_success"), clock.moment(now)))

    def listed(condition: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.col("source_id"))))

    return met.agg(
        F.count(F.lit(1)).alias("sources_total"), F.count_if(seen).alias("seen_ever"), listed(~seen).alias("never_seen"),
        listed(F.col("state") == "bloqueada").alias("blocked_last_time"), listed(F.col("failures") >= 3).alias("failing"),
        F.round(F.avg(hours), 1).alias("hours_mean"), F.round(F.max(hours), 1).alias("hours_max"),
    )
