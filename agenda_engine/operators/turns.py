"""Choices that depend on an order of turns, over classes of equal rows: first fit, and greedy one-to-one matching.

Rows that nothing tells apart form a class, and what is known of pairs is kept for pairs of classes, so a happening that a third of all rows
tell of in the same words is one class and no pair. Connected components of the classes share nothing. Those within BOUND (rows and pairs of
classes together) are packed into tasks and settled there in the order of turns. A larger component is settled in blocks of its next rows, each
block within about BOUND: what comes first never depends on what comes later, so every block is final, and what it leaves for later
rows is one value for each class. A tie of any size, rows of one class that want the rows of one other class, is settled by rank at once.
No step has a limit of rounds, no component over the bound meets in one task, and nothing but counts comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agenda_engine.functions.durable import cut, scratch
from agenda_engine.functions.shipping import ship
from agenda_engine.operators.components import components
from agenda_engine.operators.order import ranks

#: Rows and pairs of classes that a task settles at once.
BOUND = 1_000_000
#: The least part of a large component that a block may be, as a power of two.
PARTS = 30
TOLD = "kind int, x long, y long, score double"


def forest(edges: DataFrame) -> DataFrame:
    """(a, b): edges that connect what the given ones connect: each node of a task with the smallest that it reaches there."""
    ship(edges.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        for batch in batches:
            pairs = np.unique(np.stack([c.to_numpy() for c in batch.columns], axis=1), axis=0)
            for a, b in pairs.tolist():
                a, b = top(a), top(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        ends = [(x, t) for x in root if (t := top(x)) != x]
        yield pa.record_batch([pa.array([x for x, _ in ends], pa.int64()), pa.array([t for _, t in ends], pa.int64())], ["a", "b"])

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(work, "a long, b long")


def connected(edges: DataFrame, bound: int = BOUND) -> DataFrame:
    """(node, component) of every node of some edges (a, b), the smallest node of a component being its name.

    Each task first keeps a forest of its edges. What is left is joined in one task where it is within the bound, by rounds of joins else.
    """
    left = cut(forest(edges))
    if left.count() <= bound:
        held = forest(left.coalesce(1)).select(F.col("a").alias("node"), F.col("b").alias("component"))
    else:
        held = components(left)
    held = cut(held)
    return held.unionByName(held.select(F.col("component").alias("node"), "component").distinct())


def _packed(told: DataFrame, total: int, bound: int, solve, schema: str) -> DataFrame:
    """What `solve` makes of tables of told rows (component, kind, x, y, score), whole components together, about a bound in each."""
    spread = told.sparkSession.sparkContext.defaultParallelism
    buckets = max(spread, -(-2 * total // bound))
    return told.groupBy(F.pmod(F.xxhash64("component"), F.lit(buckets)).alias("bucket")).applyInArrow(solve, schema)


def _block_ends(rows: DataFrame, weight: Column, bound: int) -> DataFrame:
    """(component, last): the last turn of the next block of each component; rows: component, turn and what `weight` reads."""
    parts = F.array(*(F.lit(2.0**-k) for k in range(PARTS + 1)))
    told = rows.groupBy("component").agg(F.sum(weight).alias("w"), F.percentile_approx("turn", parts, F.lit(100_000)).alias("ends"))
    return told.select("component", F.get("ends", F.least(F.lit(PARTS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("w") / bound)))).cast("int")).alias("last"))


def _tell(df: DataFrame, kind: int, x: str, y: str, score: str | None = None) -> DataFrame:
    return df.select("component", F.lit(kind).alias("kind"), F.col(x).alias("x"), F.col(y).alias("y"), (F.col(score) if score else F.lit(0.0)).alias("score"))


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sized(sizes: DataFrame, bound: int) -> tuple[int, DataFrame | None]:
    """The size of all components within the bound, and the components beyond it, if there are any; these are few, at most the whole size over the bound."""
    over = F.col("size") > bound
    told = sizes.agg(F.sum(F.when(~over, F.col("size"))).alias("few"), F.count_if(over).alias("many")).first()
    return told.few or 0, F.broadcast(sizes.where(over).select("component")) if told.many else None


# First fit

#: What a task is told: 0 position and class, 1 a pair of classes, 2 a class and what it can join already, 3 a class that lasts into the day of a group,
#: 4 one that starts on it, 5 a group and the first cluster of those that started on its day, 6 or that lasted into it; with venue and town from 3 on.
NOTED = ("component", "kind", "x", "y", "venue", "town")
ANY = -2


def _fit(table: pa.Table) -> pa.Table:
    """(position, of, cluster) of told rows, see NOTED."""
    kind, x, y, venue, town = (table.column(c).to_numpy() for c in NOTED[1:])

    def of(*kinds: int) -> zip:
        held = np.isin(kind, kinds)
        return zip(kind[held].tolist(), x[held].tolist(), y[held].tolist(), venue[held].tolist(), town[held].tolist(), strict=True)

    beside: dict[int, list[int]] = {}
    for _, a, b, _, _ in of(1):
        beside.setdefault(a, []).append(b)
        beside.setdefault(b, []).append(a)
    joins = {c: cluster for _, c, cluster, _, _ in of(2)}  # the first cluster that holds a match of a class
    days: dict[int, list[tuple[int, bool]]] = {}
    place: dict[int, tuple[int, int]] = {}
    for k, c, g, v, t in of(3, 4):
        days.setdefault(c, []).append((g, k == 4))
        place[c] = v, t
    # the first cluster by group, venue and town, either of them also as ANY
    started: dict[tuple[int, int, int], int] = {}
    lasting: dict[tuple[int, int, int], int] = {}

    def put(held: dict, g: int, v: int, t: int, cluster: int) -> None:
        for key in ((g, v, t), (g, ANY, t), (g, v, ANY), (g, ANY, ANY)):
            if held.get(key, cluster) >= cluster:
                held[key] = cluster

    def got(held: dict, g: int, v: int, t: int, most: int) -> int:
        for w in (v, -1) if v >= 0 else (ANY,):
            for u in (t, -1) if t >= 0 else (ANY,):
                most = min(most, held.get((g, w, u), most))
        return most

    for k, g, cluster, v, t in of(5, 6):
        put(lasting, g, v, t, cluster)
        if k == 5:
            put(started, g, v, t, cluster)
    order = np.argsort(x[kind == 0])
    positions, classes = x[kind == 0][order].tolist(), y[kind == 0][order].tolist()
    found = []
    for p, c in zip(positions, classes, strict=True):
        mine = min(p, joins.get(c, p))
        own = days.get(c, ())
        if own:
            v, t = place[c]
            for g, starts in own:
                mine = got(lasting if starts else started, g, v, t, mine)
        found.append(mine)
        if mine < joins.get(c, p + 1):
            joins[c] = mine
        for g, starts in own:
            put(lasting, g, v, t, mine)
            if starts:
                put(started, g, v, t, mine)
        for other in beside.get(c, ()):
            if mine < joins.get(other, mine + 1):
                joins[other] = mine
    return pa.table([pa.array(positions, pa.int64()), pa.array(classes, pa.int64()), pa.array(found, pa.int64())], ["position", "of", "cluster"])


FITTED = "position long, of long, cluster long"
NO_GROUPS = "of long, group long, starts boolean, venue long, town long"


def _note(df: DataFrame, kind: int | Column, x: str, y: str, placed: bool = False) -> DataFrame:
    """Rows as _fit() reads them."""
    where = [F.col(c).cast("long").alias(c) if placed else F.lit(-1).cast("long").alias(c) for c in ("venue", "town")]
    return df.select("component", (F.lit(kind) if isinstance(kind, int) else kind).alias("kind"), F.col(x).alias("x"), F.col(y).alias("y"), *where)


def _notes(rows: DataFrame, pairs: DataFrame, groups: DataFrame) -> DataFrame:
    return _union(_note(rows, 0, "position", "of"), _note(pairs, 1, "a", "b"), _note(groups, F.when(F.col("starts"), 4).otherwise(3), "of", "group", True))


def first_fit(rows: DataFrame, edges: DataFrame, bound: int = BOUND, groups: DataFrame | None = None) -> DataFrame:
    """(position, cluster): each row joins the first cluster that holds a match of it, in order of position.

    rows: position and of (its class, the smallest position of a row like it); rows of a class match each other. edges: (a, b), pairs of
    different classes whose rows match. groups: (of, group, starts, venue, town), classes that match the others of a group of which one or the other
    starts there and neither venue nor town is another, -1 standing for any; these need not be among the edges. cluster is the position of its first member.
    """
    spark = rows.sparkSession
    ship(spark)
    with scratch(spark) as keep:
        pairs = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
        groups = spark.createDataFrame([], NO_GROUPS) if groups is None else cut(groups)
        nodes = connected(_union(pairs.select((F.col("a") * 2).alias("a"), (F.col("b") * 2).alias("b")), groups.select((F.col("of") * 2).alias("a"), (F.col("group") * 2 + 1).alias("b"))), bound)
        placed = cut(nodes.where(F.pmod("node", F.lit(2)) == 0).select(F.shiftright("node", 1).alias("of"), "component"))
        degree = _union(pairs.select(F.col("b").alias("of")), groups.select("of")).groupBy("of").agg(F.count(F.lit(1)).alias("degree"))
        told = cut(rows.select("position", "of").join(placed.join(degree, "of", "left"), "of", "left"))
        alone, told = told.where("component is null").select("position", F.col("of").alias("cluster")), told.where("component is not null")
        pairs, groups = cut(pairs.join(placed.withColumnRenamed("of", "a"), "a")), cut(groups.join(placed, "of"))
        sizes = cut(_union(*(t.groupBy("component").agg(F.count(F.lit(1)).alias("k")) for t in (told, pairs, groups))).groupBy("component").agg(F.sum("k").alias("size")))
        total, large = _sized(sizes, bound)
        few = (told, pairs, groups) if large is None else tuple(t.join(large, "component", "left_anti") for t in (told, pairs, groups))
        done = [alone, _packed(_notes(*few), total, bound, _fit, FITTED).select("position", "cluster")]
        if large is not None:
            done += _blocks_fit(*(t.join(large, "component") for t in (told, pairs, groups)), bound)
        return keep(_union(*done))


def _blocks(rows: DataFrame, weight: Column, bound: int) -> DataFrame:
    """Rows with the number of their block, from 0 in each component by position, the weights of a block being about a bound."""
    ranked = ranks(rows.withColumn("_w", weight), [F.col("position")], ("component",))
    step = F.greatest(F.lit(1), F.floor(F.lit(bound / 8) / F.col("_mean")))
    cells = ranked.join(ranked.groupBy("component").agg(F.mean("_w").alias("_mean")), "component").withColumn("_cell", F.floor((F.col("rank") - 1) / step)).drop("rank", "_mean")
    before = Window.partitionBy("component").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = cells.groupBy("component", "_cell").agg(F.sum("_w").alias("_w")).withColumn("block", F.floor(F.coalesce(F.sum("_w").over(before), F.lit(0)) / bound))
    return cells.drop("_w").join(sums.drop("_w"), ["component", "_cell"]).drop("_cell")


def _by_block(rows: DataFrame) -> DataFrame:
    """Written in the order of blocks, so that a block is read without the others."""
    return cut(rows.repartitionByRange("block").sortWithinPartitions("block"))


def _blocks_fit(rows: DataFrame, pairs: DataFrame, groups: DataFrame, bound: int) -> list[DataFrame]:
    """First fit over large components, a block of each at a time; what a class can join, and what a group holds, is carried from block to block.

    What a block reads of pairs and groups is laid out by block before, each with the blocks that its classes have rows in.
    """
    rows = _by_block(_blocks(rows, F.coalesce("degree", F.lit(0)) + 1, bound))
    of_class = cut(rows.select("block", "of").distinct())
    sides = pairs.select("component", F.inline(F.array(F.struct(F.col("a").alias("of"), F.col("b").alias("other")), F.struct(F.col("b").alias("of"), F.col("a").alias("other")))))
    beside, member = _by_block(sides.join(of_class, "of")), _by_block(groups.join(of_class, "of"))
    last = of_class.agg(F.max("block")).first()[0]
    done, reached, held = [], None, None
    for k in range(last + 1):
        block, near, inside = (t.where(F.col("block") == k).drop("block") for t in (rows, beside, member))
        classes = block.select("component", "of").distinct()
        both = near.where("of < other").join(classes.select(F.col("of").alias("other")), "other", "left_semi").select("component", F.col("of").alias("a"), F.col("other").alias("b"))
        told = [_notes(block, both, inside)]
        if k:
            told.append(_note(reached.join(classes, "of"), 2, "of", "cluster"))
            told.append(_note(held.join(inside.select("component", "group").distinct(), "group"), F.when(F.col("starts"), 5).otherwise(6), "group", "cluster", True))
        fitted = cut(_packed(_union(*told), bound, bound, _fit, FITTED))
        done.append(fitted.select("position", "cluster"))
        if k == last:
            break
        own = fitted.groupBy("of").agg(F.min("cluster").alias("cluster"))
        met = [own, near.join(own, "of").select(F.col("other").alias("of"), "cluster"), *([reached] if k else [])]
        reached = cut(_union(*met).groupBy("of").agg(F.min("cluster").alias("cluster")))
        now = [inside.join(own, "of").select("group", "starts", "venue", "town", "cluster"), *([held] if k else [])]
        held = cut(_union(*now).groupBy("group", "starts", "venue", "town").agg(F.min("cluster").alias("cluster")))
    return done


# Greedy one-to-one matching


def _choose(table: pa.Table) -> pa.Table:
    """(n, o) of told rows: 0 a row and its class, 1 an option and its class, 2 a pair of classes with its score."""
    kind, x, y, score = (table.column(c).to_numpy() for c in ("kind", "x", "y", "score"))
    options: dict[int, list[int]] = {}
    order = np.lexsort((-x[kind == 1], y[kind == 1]))
    for o, c in zip(x[kind == 1][order].tolist(), y[kind == 1][order].tolist(), strict=True):
        options.setdefault(c, []).append(o)  # the first of a class at the end
    wishes: dict[int, list[list[int]]] = {}
    a, b, s = x[kind == 2], y[kind == 2], score[kind == 2]
    last = None
    for at in np.lexsort((s, a)).tolist():
        if last != (mark := (a[at], s[at])):
            wishes.setdefault(int(a[at]), []).append([])  # the best score at the end
        wishes[int(a[at])][-1].append(int(b[at]))
        last = mark
    order = np.argsort(x[kind == 0])
    taken = []
    for n, c in zip(x[kind == 0][order].tolist(), y[kind == 0][order].tolist(), strict=True):
        levels = wishes.get(c, [])
        while levels:
            levels[-1] = open_ = [k for k in levels[-1] if options.get(k)]
            if open_:
                taken.append((n, options[min(open_, key=lambda k: options[k][-1])].pop()))
                break
            levels.pop()
    return pa.table([pa.array([n for n, _ in taken], pa.int64()), pa.array([o for _, o in taken], pa.int64())], ["n", "o"])


def greedy(rows: DataFrame, options: DataFrame, scored: DataFrame, bound: int = BOUND) -> DataFrame:
    """(n, o): rows in order of n take the option that is left with the best score, the earlier o on ties.

    rows: n and a (its class); options: o and b (its class); scored: (a, b, score), pairs of classes. Classes are whole numbers of any kind.
    """
    spark = rows.sparkSession
    ship(spark)
    with scratch(spark) as keep:
        wish, n_left, o_left = cut(scored.select("a", "b", "score")), rows.select("n", "a"), options.select("o", "b")
        done = []
        while True:
            nodes = cut(connected(wish.select((F.col("a") * 2).alias("a"), (F.col("b") * 2 + 1).alias("b")), bound))
            of_a, of_b = (nodes.where(F.pmod("node", F.lit(2)) == k).select(F.shiftright("node", 1).alias(c), "component") for k, c in ((0, "a"), (1, "b")))
            w, n, o = cut(wish.join(of_a, "a")), cut(n_left.join(of_a, "a")), cut(o_left.join(of_b, "b"))
            each = _union(*(t.groupBy("component").agg(F.count(F.lit(1)).alias("k")) for t in (w, n, o)))
            sizes = cut(each.groupBy("component").agg(F.sum("k").alias("size")))
            total, large = _sized(sizes, bound)
            few = (w, n, o) if large is None else tuple(t.join(large, "component", "left_anti") for t in (w, n, o))
            done.append(_packed(_union(_tell(few[1], 0, "n", "a"), _tell(few[2], 1, "o", "b"), _tell(few[0], 2, "a", "b", "score")), total, bound, _choose, "n long, o long"))
            if large is None:
                return keep(_union(*done))
            w, n, o = (t.join(large, "component") for t in (w, n, o))
            by_rank = cut(_ties(w, n, o))
            n, o = n.join(by_rank, "n", "left_anti"), o.join(by_rank, "o", "left_anti")
            last, chosen = _block_choice(w, n, o, bound)
            chosen = cut(chosen)
            done += [by_rank, chosen]
            n_left = cut(n.join(last, "component", "left").where("last is null or n > last").select("n", "a"))  # who found nothing in its turn never will
            o_left = cut(o.join(chosen, "o", "left_anti").select("o", "b"))
            wish = cut(w.join(n_left.select("a").distinct(), "a", "left_semi").join(o_left.select("b").distinct(), "b", "left_semi").select("a", "b", "score"))


def _ties(wish: DataFrame, n: DataFrame, o: DataFrame) -> DataFrame:
    """(n, o) that are settled by rank: rows of a class that want one class best, before any row of another class that could take from it.

    Of a class of options only the class of rows with the earliest turn can be sure of anything; its rows before the first turn of the next
    class take the options in order.
    """
    turns = n.groupBy("a").agg(F.min("n").alias("turn"))
    free = o.select("b").distinct()
    met = wish.join(free, "b").join(turns, "a")
    best = met.groupBy("a").agg(F.max("score").alias("score"))
    top = met.join(best, ["a", "score"]).groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("k")).where("k = 1").select("a", "b")
    first = met.groupBy("b").agg(F.min(F.struct("turn", "a")).alias("f")).select("b", F.col("f.a").alias("a"))
    sure = top.join(first, ["a", "b"])
    next_ = met.join(first.withColumnRenamed("a", "one"), "b").where("a <> one").groupBy("b").agg(F.min("turn").alias("next"))
    sure = cut(sure.join(next_, "b", "left"))
    mine = ranks(n.join(sure, "a").where("next is null or n < next").select("n", "b"), [F.col("n")], ("b",))
    theirs = ranks(o.join(sure.select("b"), "b").select("o", "b"), [F.col("o")], ("b",))
    return mine.join(theirs, ["b", "rank"]).select("n", "o")


def _block_choice(wish: DataFrame, n: DataFrame, o: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """(component, last) and (n, o): the choices of the next rows of each component, up to a last turn."""
    degree = wish.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    per_class = o.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.count_distinct("b")).alias("each"))
    weighed = n.join(degree, "a").join(per_class, "component").withColumn("turn", F.col("n"))
    last = F.broadcast(cut(_block_ends(weighed, 1 + F.col("degree") * F.col("each"), bound)))
    block = cut(n.join(last, "component").where("n <= last"))
    most = block.groupBy("component").agg(F.count(F.lit(1)).alias("most"))
    wanted = cut(wish.join(block.select("a").distinct(), "a", "left_semi"))
    near = ranks(o.join(wanted.select("b").distinct(), "b", "left_semi"), [F.col("o")], ("b",)).join(most, "component").where("rank <= most")
    told = _union(_tell(block, 0, "n", "a"), _tell(near, 1, "o", "b"), _tell(wanted, 2, "a", "b", "score"))
    return last, _packed(told, bound, bound, _choose, "n long, o long")


def alike(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(n, a), (o, b) and (a, b, score) of a table of pairs (n, o, score): rows with equal options are a class, and options that equal classes want alike."""

    def classes(rows: DataFrame, key: str, other: str, name: str) -> DataFrame:
        marks = [F.sum(F.xxhash64(F.lit(seed), other, "score").cast("decimal(20,0)")) for seed in (1, 2)]
        told = rows.groupBy(key).agg(F.count(F.lit(1)).alias("k"), marks[0].alias("p"), marks[1].alias("q"))
        first = told.groupBy("k", "p", "q").agg(F.min(key).alias(name))
        return told.join(first, ["k", "p", "q"]).select(key, name)

    rows = cut(classes(pairs, "n", "o", "a"))
    by_class = cut(pairs.join(rows, "n").select("a", "o", "score").distinct())
    options = cut(classes(by_class, "o", "a", "b"))
    return rows, options, by_class.join(options, "o").select("a", "b", "score").distinct()
