"""Greedy one-to-one matching of current and archived rows without their pairs: what can match shares a day, a venue or an address, and is scored where it meets.

Days, venues and addresses that rows have in common are linked, and what is linked is settled in one task, row by row, from lists of the
words that its options have. So memory grows with rows, though the work of a day still grows with the square of its classes of rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.durable import cut
from agenda_engine.functions.shipping import ship
from agenda_engine.operators.turns import connected

#: Rows that are settled in one task at most; what is linked to more is matched by pairs.
MOST = 250_000
#: Linked rows that have a group of their own; smaller ones are packed.
OWN = 2_000
#: Views of a day's options by venue, town and category that a task keeps.
KEPT = 64


def linked(now: DataFrame, old: DataFrame) -> DataFrame:
    """(side, position, component) of keyed rows of which one of the other side shares a day, or, an undated one among them, a venue or an address; side 0 is now."""
    sides = [rows.select(F.lit(k).alias("side"), "position", "m_day", "m_venue", "m_urls") for k, rows in ((0, now), (1, old))]
    none = F.array().cast("array<string>")

    def some(column: str, mark: str):
        return F.when(F.col(column) != "", F.array(F.concat(F.lit(mark), F.col(column)))).otherwise(none)

    keys = F.concat(some("m_day", "d "), some("m_venue", "v "), F.transform("m_urls", lambda u: F.concat(F.lit("u "), u)))
    each = cut(sides[0].unionByName(sides[1]).select("side", "position", (F.col("m_day") == "").alias("bare"), F.explode(keys).alias("key")))
    met = each.groupBy("key").agg(F.bool_or("bare").alias("bare"), F.count_distinct("side").alias("sides")).where("sides = 2 and (bare or startswith(key, 'd '))")
    hubs = cut(met.select("key", F.monotonically_increasing_id().alias("hub")))
    own = cut(each.join(hubs, "key").groupBy("side", "position").agg(F.min("hub").alias("first"), F.collect_set("hub").alias("hubs")))
    placed = cut(connected(own.select(F.col("first").alias("a"), F.explode("hubs").alias("b")).where("a <> b").distinct()))
    return own.join(placed, F.col("first") == F.col("node"), "left").select("side", "position", F.coalesce("component", "first").alias("component"))


class _Options:
    """The options that a day's rows can take, or an undated row: lists of their words and addresses, and their points by venue, town and category."""

    def __init__(self, at: np.ndarray, day: str, told: dict[str, list], points: dict[str, float]):
        self.at, self.told, self.points = at, told, points
        lists: dict[str, dict] = {"words": {}, "urls": {}}
        for i, o in enumerate(at.tolist()):
            for name, held in lists.items():
                for x in set(told[name][o]):
                    held.setdefault(x, []).append(i)
        self.words, self.urls = ({x: np.array(i) for x, i in held.items()} for held in lists.values())
        self.length = np.array([len(told["words"][o]) for o in at.tolist()], dtype=np.float64)
        self.day = np.array([points["day"] if day and told["day"][o] == day else 0.0 for o in at.tolist()])
        # numbers for texts, 0 for the empty one
        self.codes: dict[str, dict[str | None, int]] = {c: {"": 0} for c in ("venue", "town", "category")}
        self.cols = {c: np.array([k.setdefault(told[c][o], len(k)) for o in at.tolist()]) for c, k in self.codes.items()}
        self.kept: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def fixed(self, venue: str, town: str, category: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The points but for addresses and words, added in the order of score(), and where the towns differ."""
        key = (venue, town, category)
        if key not in self.kept:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            p, v, t, g = self.points, *self.cols.values()
            of_v, of_t, of_g = (k.get(x, -1) for k, x in zip(self.codes.values(), key, strict=True))
            by_venue = np.where(v == of_v, p["venue"], np.where(v > 0, p["other_venue"], 0.0)) if venue else np.zeros(len(v))
            by_town = np.where(t == of_t, p["city"], 0.0) if town else np.zeros(len(t))
            self.kept[key] = self.day + by_venue + by_town + np.where(g == of_g, p["category"], 0.0), (t > 0) & (t != of_t) & bool(town)
        return self.kept[key]

    def scores(self, venue: str, town: str, category: str | None, words: list, urls: list) -> np.ndarray:
        total, apart = self.fixed(venue, town, category)
        both = np.zeros(len(self.at))
        for w in words:
            if (held := self.words.get(w)) is not None:
                both[held] += 1
        linked_ = np.zeros(len(self.at))
        for u in urls:
            if (held := self.urls.get(u)) is not None:
                linked_[held] = self.points["url"]
        alike = both / np.maximum(len(words) + self.length - both, 1.0)
        return np.where(apart, 0.0, np.clip(total + linked_ + np.minimum(alike, self.points["words"]), 0.0, 1.0))


def _settle(now: dict[str, list], old: dict[str, list], threshold: float, points: dict[str, float]) -> list[tuple[int, int]]:
    """(n, o): rows in order take the option left with the best score, the earlier one on ties; the first row of a class tells what all of it say."""
    options: dict[int, list[int]] = {}
    for o, c in sorted(zip(old["position"], old["class"], strict=True), reverse=True):
        options.setdefault(c, []).append(o)  # the first at the end
    firsts = [i for i, (p, c) in enumerate(zip(old["position"], old["class"], strict=True)) if p == c]
    told = {k: [v[i] for i in firsts] for k, v in old.items()}
    held = [options[c] for c in told["class"]]
    head = np.array([h[-1] for h in held], dtype=np.int64)
    free = np.ones(len(held), dtype=bool)
    of_day: dict[str, list[int]] = {}
    for i, d in enumerate(told["day"]):
        of_day.setdefault(d, []).append(i)
    views: dict[str, _Options] = {}
    said = {c: i for i, (p, c) in enumerate(zip(now["position"], now["class"], strict=True)) if p == c}
    taken = []
    for n, c in sorted(zip(now["position"], now["class"], strict=True)):
        i = said[c]
        day = now["day"][i]
        if day not in views:
            at = np.array(sorted(of_day.get(day, []) + of_day.get("", [])) if day else range(len(held)), dtype=np.int64)
            views[day] = _Options(at, day, told, points)
        view = views[day]
        if not len(view.at):
            continue
        score = np.where(free[view.at], view.scores(now["venue"][i], now["town"][i], now["category"][i], now["words"][i], now["urls"][i]), -1.0)
        best = score.max()
        if best < threshold:
            continue
        ties = view.at[score == best]
        k = int(ties[np.argmin(head[ties])])
        taken.append((n, held[k].pop()))
        if held[k]:
            head[k] = held[k][-1]
        else:
            free[k] = False
    return taken


def _settled(threshold: float, points: dict[str, float]) -> Callable[[pa.Table], pa.Table]:
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("component")
        ends = [0, *(np.flatnonzero(np.diff(table.column("component").to_numpy())) + 1).tolist(), table.num_rows]
        found = []
        for a, b in zip(ends, ends[1:], strict=False):
            part = table.slice(a, b - a)
            now, old = (part.filter(pc.equal(part.column("side"), k)).drop_columns(["component", "side"]).to_pydict() for k in (0, 1))
            found += _settle(now, old, threshold, points)
        return pa.table([pa.array([n for n, _ in found], pa.int64()), pa.array([o for _, o in found], pa.int64())], ["n", "o"])

    return work


def taken(now: DataFrame, old: DataFrame, threshold: float, points: dict[str, float], by_pairs: Callable[[DataFrame, DataFrame], DataFrame], most: int = MOST) -> DataFrame:
    """(n, o) of the greedy match of keyed rows with their m_class; rows that are linked to more than `most` go to by_pairs(now, old)."""
    spark = now.sparkSession
    ship(spark)
    of = linked(*(rows.where(F.col("position") == F.col("m_class")) for rows in (now, old)))

    def placed(rows: DataFrame, side: int) -> DataFrame:
        return rows.join(of.where(F.col("side") == side).select(F.col("position").alias("m_class"), "component"), "m_class")

    def told(rows: DataFrame, side: int) -> DataFrame:
        first = F.col("position") == F.col("m_class")
        facts = {"day": "m_day", "venue": "m_venue", "town": "m_city", "category": "category", "words": "m_words", "urls": "m_urls"}
        return placed(rows, side).select(
            "component", F.lit(side).alias("side"), "position", F.col("m_class").alias("class"), *(F.when(first, F.col(c)).alias(k) for k, c in facts.items())
        )

    every = cut(told(now, 0).unionByName(told(old, 1)))
    sizes = cut(every.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.count_distinct("side").alias("sides")).where("sides = 2").select("component", "size"))
    parts = 4 * spark.sparkContext.defaultParallelism
    bucket = F.when(F.col("size") >= OWN, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(parts)))
    few = every.join(sizes.where(F.col("size") <= most), "component").withColumn("bucket", bucket).drop("size")
    # a fixed number of parts: what a task computes has nothing to do with the bytes that it reads
    found = few.repartition(parts, "bucket").groupBy("bucket").applyInArrow(lambda t: _settled(threshold, points)(t.drop_columns(["bucket"])), "n long, o long")
    large = sizes.where(F.col("size") > most).select("component")
    if not large.limit(1).count():
        return found
    return found.unionByName(by_pairs(*(placed(rows, k).join(large, "component").drop("component") for k, rows in enumerate((now, old)))))
