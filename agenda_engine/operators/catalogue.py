"""The main query whole: captured items become the served catalogue of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.durable import cut, scratch
from agenda_engine.operators import events, resolve, serving, state

# Fixed values of the published format: what a merged row takes from which version.
FILLED_TEXTS = (
    "starts_at", "ends_at", "display_date", "doors_time", "venue", "address", "city", "department", "currency", "price_text", "facebook_event_url", "location_query", "organizer", "audience",
    "age_restriction", "content_genre", "director",
)
FILLED_VALUES = ("starts_at_ms", "ends_at_ms", "price_to", "duration_minutes", "latitude", "longitude")
OF_DATE = ("date_confidence", "all_day", "multi_day", "lifecycle", "days_until", "date_source_text")
OF_BEST = (
    "id", "title", "description", "original_text", "category", "source_id", "source_name", "source_url", "source_class", "source_tier", "source_icon_url", "url", "published_at", "scraped_at",
    "relevance_score", "filter_reasons", "is_official",
)
LISTS = {
    "image_urls": 24, "subcategories": 6, "tags": 15, "artists": 10, "ticket_urls": 8, "ticket_outlets": 8, "showtimes": 32, "formats": 16, "occurrences": 64, "cast": 24, "phones": 6,
}


def merged(rows: DataFrame, threshold: float = resolve.THRESHOLD) -> DataFrame:
    """One row for each happening of some events, with the position of its first."""
    with scratch(rows.sparkSession) as keep:
        ranked = keep(resolve.ranked(resolve.clusters(rows, threshold)))
    base = resolve.merge(ranked, list(FILLED_TEXTS), LISTS, list(FILLED_VALUES), list(OF_DATE))
    best = ranked.groupBy("cluster").agg(*(F.min_by(c, "rank").alias(c) for c in OF_BEST), F.min("position").alias("position"))
    met = base.join(best, "cluster").join(resolve.merged_sources(ranked), "cluster").join(resolve.merged_videos(ranked), "cluster", "left")
    none = F.slice(F.array(resolve.video(*(F.lit(""),) * 4)), F.lit(1), F.lit(0))
    shown = events.media(F.col("image_urls"), F.coalesce("videos", none))
    kept = [c for c in met.columns if c not in ("image_urls", "videos", "cluster")]
    return met.select(*kept, *shown)


def build(
    items: DataFrame, archive: DataFrame | None, at: str, threshold: float = resolve.THRESHOLD, keep_days: int = state.KEEP_DAYS, cap: int | None = state.CAP, archive_threshold: float = state.THRESHOLD,
) -> DataFrame:
    """The served catalogue after a run over captured items (with a position each); archive: the last catalogue, None for the first run.

    Of events with one id the last counts, at the place of the first.
    """
    return settled(events.construct(items, stamped(at), at), archive, at, threshold, keep_days, cap, archive_threshold)


def stamped(at: str) -> str:
    """A run's moment as the catalogue tells it."""
    return at.replace(" ", "T") + "-04:00"


def settled(
    made: DataFrame, archive: DataFrame | None, at: str, threshold: float = resolve.THRESHOLD, keep_days: int = state.KEEP_DAYS, cap: int | None = state.CAP, archive_threshold: float = state.THRESHOLD,
) -> DataFrame:
    """build() from events that are made already."""
    own = [c for c in made.columns if c not in ("id", "position")]
    once = events.last_wins(made, ["id"], "position", own).withColumnRenamed("first_pos", "position")
    current = cut(merged(cut(once), threshold))
    if archive is None:
        kinds = f"event_id string, first_seen_at string, last_seen_at string, history {state.HISTORY}"
        archive = made.sparkSession.createDataFrame([], ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in current.schema), kinds]))
    return serving.enriched(state.reconcile(current, archive, at, archive_threshold, keep_days=keep_days, cap=cap))
