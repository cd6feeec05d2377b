"""First fit and greedy matching over classes against the sequence of turns, in one task, in blocks and by rank; ranks against row numbers."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from agenda_engine.operators import order, resolve, turns

#: Blocks of a few rows, and all in one task.
BOUNDS = [60, turns.BOUND]


def fitted(rows, edges):
    """The first cluster that holds a match, row by row; rows: position and class."""
    met = {frozenset(e) for e in edges}
    clusters = []
    for p, c in sorted(rows):
        for held in clusters:
            if any(q == c or frozenset((q, c)) in met for _, q in held):
                held.append((p, c))
                break
        else:
            clusters.append([(p, c)])
    return {p: held[0][0] for held in clusters for p, _ in held}


def frame(spark, rows, kinds):
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.mark.parametrize("bound", BOUNDS)
def test_first_fit_equals_the_sequence(spark, bound):
    rng = random.Random(bound)
    rows, edges = [], []
    for base, size, many, links in ((0, 70, 10, 20), (100, 20, 15, 12), (200, 10, 1, 0)):  # few large classes, many small ones, one class alone
        of = [rng.randrange(many) for _ in range(size)]
        first = {c: base + of.index(c) for c in set(of)}
        rows += [(base + i, first[c]) for i, c in enumerate(of)]
        names = sorted(first.values())
        edges += [tuple(rng.sample(names, 2)) for _ in range(links)]
    rows.append((500, 500))
    got = turns.first_fit(frame(spark, rows, "position long, of long"), frame(spark, edges, "a long, b long"), bound)
    assert {r.position: r.cluster for r in got.collect()} == fitted(rows, edges)


@pytest.mark.parametrize("bound", [120, turns.BOUND])
def test_a_long_chain_with_decoys_settles(spark, bound):
    """Each row matches the one before it, and an early row of its own."""
    chain = list(range(100, 170))
    edges = list(zip(chain, chain[1:], strict=False)) + [(i, c) for i, c in enumerate(chain[1:])]
    rows = [(p, p) for p in sorted({p for e in edges for p in e})]
    got = turns.first_fit(frame(spark, rows, "position long, of long"), frame(spark, edges, "a long, b long"), bound)
    assert {r.position: r.cluster for r in got.collect()} == fitted(rows, edges)


def test_posts_of_one_happening_are_one_class(spark):
    """1500 posts in the same words, and twenty in others, give no pair for each two of them."""
    said = [(p, "Banda Luna en concierto", "gran noche de estreno") for p in range(1500)] + [(2000 + p, f"Banda Luna presenta disco{p}", "gran noche de estreno") for p in range(20)]
    rows = [(p, title, [], text, "Teatro Uno", "La Paz", None, "2026-08-20T20:00:00-04:00", None) for p, title, text in said]
    df = spark.createDataFrame(rows, "position long, title string, artists array<string>, description string, venue string, city string, department string, starts_at string, ends_at string")
    keyed = resolve.alike(resolve.keyed(df), ["k_said", "k_name", "k_venue", "k_city", "k_first", "k_last"])
    assert keyed.select("of").distinct().count() == 21
    assert resolve.match_edges(keyed.where("position = of")).count() <= 21 * 20 / 2
    assert {r.cluster for r in resolve.clusters(df).select("cluster").distinct().collect()} == {0}


def chosen(rows, options, scored):
    """The best option that is left, row by row."""
    score = {(a, b): s for a, b, s in scored}
    left, out = dict(options), {}
    for n, a in sorted(rows):
        open_ = [(-score[a, b], o) for o, b in left.items() if (a, b) in score]
        if open_:
            out[n] = min(open_)[1]
            del left[out[n]]
    return out


def greedily(spark, rows, options, scored, bound):
    got = turns.greedy(frame(spark, rows, "n long, a long"), frame(spark, options, "o long, b long"), frame(spark, scored, "a long, b long, score double"), bound)
    return {r.n: r.o for r in got.collect()}


@pytest.mark.parametrize("bound", BOUNDS)
def test_greedy_equals_the_sequence(spark, bound):
    rng = random.Random(9 + bound)
    rows = [(n, rng.choice([n, rng.randrange(4)])) for n in range(40)]
    options = [(o, rng.choice([o, rng.randrange(4), rng.randrange(4)])) for o in range(45)]
    mine, theirs = sorted({a for _, a in rows}), sorted({b for _, b in options})
    pairs = {(a, b): rng.choice([0.62, 0.7, 0.7, 0.81, 0.93]) for a in mine for b in rng.sample(theirs, 4)}
    scored = [(a, b, s) for (a, b), s in pairs.items()]
    assert greedily(spark, rows, options, scored, bound) == chosen(rows, options, scored)


def test_a_full_tie_settles_by_rank(spark, monkeypatch):
    rounds = []
    ties = turns._ties
    monkeypatch.setattr(turns, "_ties", lambda *a: rounds.append(1) or ties(*a))
    rows, options = [(2 * n, 1) for n in range(2000)], [(3 * o, 7) for o in range(1900)]
    got = greedily(spark, rows, options, [(1, 7, 0.7)], 100)
    assert got == {2 * i: 3 * i for i in range(1900)} and len(rounds) <= 10


@pytest.mark.parametrize("bound", [60, turns.BOUND])
def test_pairs_with_equal_options_become_classes(spark, bound):
    rng = random.Random(4)
    pairs = [(n, o, 0.7) for n in range(0, 30) for o in range(25)] + [(n, o, rng.choice([0.7, 0.8])) for n in range(30, 40) for o in rng.sample(range(20, 40), 5)]
    rows, options, scored = turns.alike(frame(spark, pairs, "n long, o long, score double"))
    assert scored.count() < len(pairs) / 5
    got = {r.n: r.o for r in turns.greedy(rows, options, scored, bound).collect()}
    assert got == chosen([(n, n) for n in range(40)], [(o, o) for o in range(40)], pairs)


def test_no_pairs_at_all(spark):
    rows = frame(spark, [(1, 1), (2, 1), (3, 3)], "position long, of long")
    assert {r.position: r.cluster for r in turns.first_fit(rows, spark.createDataFrame([], "a long, b long")).collect()} == {1: 1, 2: 1, 3: 3}
    assert greedily(spark, [(1, 1)], [(1, 1)], [(2, 2, 0.5)], 10) == {}


@pytest.mark.parametrize("n", [0, 1, 500])
def test_ranks_equal_row_numbers(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([0, 0, 0, 1, None]), rng.choice([None, 1.0, 2.0])) for i in range(n)]
    df = spark.createDataFrame(rows, "i long, k int, s double").repartition(4)
    by = [F.col("s").desc_nulls_last(), F.col("i")]
    want = df.select("i", F.row_number().over(Window.orderBy(*by)).alias("rank")).collect()
    assert sorted((r.i, r.rank) for r in order.ranks(df, by, partitions=7).collect()) == sorted((r.i, r.rank) for r in want)
    kept = df.where("k is not null")
    want = kept.select("i", F.row_number().over(Window.partitionBy("k").orderBy(*by)).alias("rank")).collect()
    assert sorted((r.i, r.rank) for r in order.ranks(kept, by, ("k",), partitions=7).collect()) == sorted((r.i, r.rank) for r in want)


@pytest.mark.parametrize("bound", BOUNDS)
def test_groups_fit_as_their_pairs_would(spark, bound):
    """Classes of a group match where one of them starts there and venue and town agree; no pair of them is laid out."""
    rng = random.Random(3 + bound)
    rows = [(p, p if rng.random() < 0.8 or p < 5 else rng.randrange(5)) for p in range(90)]
    classes = sorted({c for _, c in rows})
    place = {c: (rng.choice([-1, 7, 9]), rng.choice([-1, 3, 4])) for c in classes}
    groups = [(c, g, rng.random() < 0.6, *place[c]) for c in classes for g in rng.sample(range(12), 2)]
    edges = [tuple(rng.sample(classes, 2)) for _ in range(25)]
    agree = [all(min(x, y) < 0 or x == y for x, y in zip(place[a[0]], place[b[0]], strict=True)) for a in groups for b in groups]
    met = [(a[0], b[0]) for (a, b), ok in zip(((a, b) for a in groups for b in groups), agree, strict=True) if ok and a[0] < b[0] and a[1] == b[1] and (a[2] or b[2])]
    told = frame(spark, groups, "of long, group long, starts boolean, venue long, town long")
    got = turns.first_fit(frame(spark, rows, "position long, of long"), frame(spark, edges, "a long, b long"), bound, told)
    assert {r.position: r.cluster for r in got.collect()} == fitted(rows, edges + met)


def test_matches_are_settled_without_pairs(spark, monkeypatch):
    """Scored pairs of a day and venue grew with the square of its rows and filled the disk; rows that are linked settle in one task, by the same choices."""
    from agenda_engine.operators import state

    rng = random.Random(21)
    columns = "position long, title string, artists array<string>, description string, venue string, city string, category string, starts_at string, ends_at string, url string, all_urls array<string>"
    names, rows = ["luna llena", "rio bravo", "sol naciente", "mar adentro"], []
    for p in range(140):
        day = None if rng.random() < 0.15 else f"2026-08-{rng.randint(1, 4):02d}T20:00:00-04:00"
        urls = [f"u{rng.randint(0, 9)}"] if rng.random() < 0.3 else []
        rows.append((p, f"{rng.choice(names)} {rng.choice(names)}", [], "gran noche orquesta", rng.choice(["Uno", "Dos", None, ""]), rng.choice(["La Paz", "Oruro", None]), rng.choice(["concierto", None, ""]), day, None, None, urls))
    df = state.keyed(frame(spark, rows, columns))
    now, old = (resolve.alike(df.where(f"position % 2 = {k}"), state.KEYS, "m_class").cache() for k in (0, 1))
    every = now.alias("a").crossJoin(old.alias("b")).select(F.col("a.position").alias("n"), F.col("b.position").alias("o"), state.score("a", "b").alias("s"))
    for threshold in (0.55, 0.62, 0.9):
        scored = [tuple(r) for r in every.where(F.col("s") >= threshold).collect()]
        want = chosen([(n, n) for n in range(0, 140, 2)], [(o, o) for o in range(1, 140, 2)], scored)
        assert {r.n: r.o for r in state.matched(now, old, threshold, most=0).collect()} == want and len(want) > 5
        with monkeypatch.context() as m:
            m.setattr(state, "class_scores", None)  # no pair is scored
            assert {r.n: r.o for r in state.matched(now, old, threshold).collect()} == want
