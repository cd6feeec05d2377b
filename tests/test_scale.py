"""What keeps queries whole on larger tables: rows are dealt over the cores, characters cost one test, pairs are not made twice."""

from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from agenda_engine.functions import text
from agenda_engine.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["compatible_text", "post_cleaning", "places_found", "price_roundtrip"])
def test_one_file_is_read_into_many_tasks(spark, name):
    """A table of one file and one row group came to one task, with all that its columns cost."""
    assert QUERIES[name](spark, SF).select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_a_character_outside_of_a_class_costs_one_test(spark):
    told = text._any_of([chr(p) for p in range(0x100, 0x3000, 3)])
    assert re.match(r"\[\\x\{100\}-\\x\{2ffe\}&&\[", told)
    held = spark.createDataFrame([(chr(p),) for p in range(1, 0x3100)], "c string").where(F.col("c").rlike(told)).collect()
    assert {ord(r.c) for r in held} == set(range(0x100, 0x3000, 3))


def test_tables_of_characters_are_dealt(spark):
    """Every character is found where its number puts it, and forms come out as the standard says."""
    chars = [chr(p) for p in range(0x80, 0x3100) if not unicodedata.combining(chr(p)) and unicodedata.normalize("NFKC", chr(p)).strip() == unicodedata.normalize("NFKC", chr(p))]
    rows = spark.createDataFrame([(f"x{c}y",) for c in chars], "t string").select("t", text.compatible(F.col("t")).alias("c")).collect()
    told = {r.t: r.c for r in rows}
    assert [t for t, c in told.items() if c != unicodedata.normalize("NFKC", t)] == []


def test_boundaries_of_words_as_sql_has_them(spark, tmp_path):
    """A letter that is not of ASCII ended no word: 'ßund' has a boundary before 'und' in SQL."""
    import duckdb

    from agenda_engine.plans.registry import ORACLES

    texts = ["xßund y", "auf und ab", "pørque que", "queß", "theł", "ment", "momentœ", "lesз", "日the本", "la la", "la dede", "ctionø tion", "", "the_ und", "ðthe"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    told = {r.doc_id: r.hits for r in QUERIES["pattern_hits"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert told == dict(con.execute(ORACLES["pattern_hits"]).fetchall())


def test_pairs_are_made_from_classes(spark, tmp_path):
    """Parts of one name are one class: no more than classes meet, and every pair comes out once, over blocks too."""
    from agenda_engine.operators import resolve

    members = spark.createDataFrame([(c, c * 100 + k, n) for c, n in ((1, 7), (2, 5), (3, 1)) for k in range(n)], "class long, p_partkey long, n long")
    pairs = spark.createDataFrame([(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (1, 2, 0.5)], "c long, d long, s double")
    got = [(r.a, r.b, r.s) for r in resolve.expanded(members, pairs, block=2).collect()]
    one, two = [100 + k for k in range(7)], [200 + k for k in range(5)]
    want = [(a, b, 1.0) for g in (one, two) for a in g for b in g if a < b] + [(a, b, 0.5) for a in one for b in two]
    assert sorted(got) == sorted(want)
    plan = QUERIES["jaccard_pairs"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan


def test_a_span_costs_two_rows(spark):
    """Days of a span are not laid out."""
    assert "sequence(" not in QUERIES["day_span_join"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_items_are_analysed_in_many_tasks(spark):
    """What is analysed is a written table: one file each task, and there was one."""
    assert len(QUERIES["relevance_reasons"](spark, SF).inputFiles()) > 1


def test_one_look_tells_whether_any_pattern_occurs():
    patterns = [r"\bferia\b", r"\bexpo", r"\b(?:un|dos) circos?\b", r"sin borde|con borde", r"\ba|b\b", r"\b[|(]x"]
    for said in ("la feria", "laferia", "expone", "un circo", "con borde", "xb", "(x", "nada", ""):
        assert bool(re.search(text.any_hit(patterns), said)) == any(re.search(p, said) for p in patterns)


def test_rows_of_one_venue_meet_by_name_only(spark):
    """Rows that share day and venue were all laid beside each other over words that all of them have; those of two venues still meet."""
    from agenda_engine.operators import resolve

    said = [(k, f"Banda{k}", "gran noche septiembre esperamos todos juntos", "Sala Uno") for k in range(30)] + [(100, "Banda7", "gran noche septiembre esperamos todos juntos", "Sala Dos"), (101, "Otra", "nada parecido aquí", "Sala Dos")]
    none = "cast(null as string)"
    rows = spark.createDataFrame(said, "position long, title string, description string, venue string").selectExpr(
        "*", "array() as artists", f"{none} as city", f"{none} as department", "'2026-09-01T20:00:00-04:00' as starts_at", f"{none} as ends_at"
    )
    met = {(r.a, r.b) for r in resolve.candidates(resolve.keyed(rows.withColumn("artists", F.col("artists").cast("array<string>")))).collect()}
    assert (7, 100) in met
    assert not any(b < 100 for _, b in met)


def test_a_written_table_leaves_no_shuffle(spark):
    """What a step had shuffled stayed on disk beside the table that it wrote, until the driver collected garbage."""
    import time

    from agenda_engine.functions import durable

    def shuffles():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in str(blocks.mkString(" ")).split() if b.startswith("shuffle_")}

    before, set_before = shuffles(), spark.conf.get(durable.FREES, None)
    table = durable.cut(spark.range(20_000).repartition(8).groupBy((F.col("id") % 999).alias("k")).count())
    until = time.monotonic() + 5
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before and table.count() == 999
    assert spark.conf.get(durable.FREES, None) == set_before


@pytest.mark.parametrize("name", ["reconcile_greedy", "cluster_greedy"])
def test_tables_of_rows_do_not_pass_through_the_driver(spark, monkeypatch, name):
    """Tables that grow with the input were estimated small and broadcast through the driver, eleven in one statement at sf0.1."""
    from agenda_engine.operators import components, resolve, state, turns

    plans = []
    for module in (components, resolve, state, turns):
        cut = module.cut
        monkeypatch.setattr(module, "cut", lambda df, cut=cut: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    found = QUERIES[name](spark, SF)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and [p for p in plans if "BroadcastExchange" in p] == []
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_rounds_of_components_are_few_and_small(spark, monkeypatch):
    """Edges that are settled cost no round, and a round shuffles three times: the driver keeps every statement's plan and tasks."""
    from agenda_engine.operators import components as own

    shuffles = []

    def cut(df, real=own.cut):
        df.collect()  # the plan that ran, where a shuffle that is read again is made once
        ran = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        shuffles.append(ran.count(" Exchange hashpartitioning") - ran.count("ReusedExchange"))
        return real(df)

    monkeypatch.setattr(own, "cut", cut)
    stars = [(10 * c + k, 10 * c) for c in range(5) for k in range(1, 9)]
    got = {r.node: r.component for r in own.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == dict(stars) and len(shuffles) == 1
    chain = [(k, k + 1) for k in range(9)] + [(9, 4), (7, 7)]
    got = {r.node: r.component for r in own.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(1, 10), 0) and 3 <= len(shuffles) <= 6
    assert max(shuffles) <= 3
    assert own.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _told(spark, rows):
    """Keyed rows of (position, title, description, venue, first day, last day)."""
    from agenda_engine.operators import resolve

    none = "cast(null as string)"
    df = spark.createDataFrame(rows, "position long, title string, description string, venue string, starts_at string, ends_at string")
    return resolve.keyed(df.selectExpr("*", "cast(array() as array<string>) as artists", f"{none} as city", f"{none} as department"))


def test_rows_that_share_a_name_and_a_day_are_no_pairs(spark):
    """A name's word and a day were a pair for each two rows that have them, with all that a match reads in each; they are a group."""
    from agenda_engine.operators import resolve

    rows = _told(spark, [(k, f"Luna Banda{k}", f"palabra{k} otra{k} cosa{k}", "Sala Uno", "2026-09-01", None) for k in range(40)])
    assert resolve.match_pairs(rows).count() == 0
    assert resolve.days(rows).count() == 40 and resolve.match_edges(rows).count() == 40 * 39 / 2


def test_a_span_meets_another_venue_on_a_day_that_is_its_alone(spark):
    """What lasted into a day on which one other venue begins something was never laid beside it."""
    from agenda_engine.operators import resolve

    rows = _told(spark, [(1, "Luna", "gran noche septiembre esperamos todos juntos", "Sala Uno", "2026-09-01", "2026-09-03"), (2, "Luna", "gran noche septiembre esperamos todos juntos", "Sala Dos", "2026-09-02", None)])
    assert [(r.a, r.b) for r in resolve.match_edges(rows).collect()] == [(1, 2)]


def test_undated_rows_meet_on_what_they_must_share(spark):
    """Pairs of a Jaccard from words that are all frequent, of rows of any length, are those of a cross join."""
    import random

    from agenda_engine.operators import resolve

    rng = random.Random(5)
    sets = [rng.sample(range(9), rng.randint(1, 9)) for _ in range(70)] + [rng.sample(range(9, 30), rng.randint(10, 20)) for _ in range(40)]
    sets += [s[:-1] + [99 + i] for i, s in enumerate(sets[60:])]
    rows = spark.createDataFrame([(p, [f"w{x}" for x in s]) for p, s in enumerate(sets)], "position long, k_said array<string>")
    for common in (0, 12, 1000):
        told, rare = resolve.numbered(rows, "k_said", common)
        got = [(r.a, r.b) for r in resolve.similar(told, told, 0.55, rare, F.col("s.position") < F.col("l.position")).collect()]
        want = [(a, b) for a, s in enumerate(sets) for b, t in enumerate(sets) if a < b and len(set(s) & set(t)) / len(set(s) | set(t)) >= 0.55]
        assert sorted(got) == want and len(want) > 50


def test_a_pattern_is_tried_where_what_it_needs_stands(spark):
    """Every pattern of a lexicon was tried on every text that any of them hits; a plain search for what it needs goes before, and counts stay."""
    from agenda_engine.functions import lexicon

    assert [text.needed(p) for p in (r"\bferia del libro\b", r"\bstand ?up\b", r"\bgastronomic", r"\b(?:un|dos) circos?\b", "a|b", r"(?i)abc", r"ab+c", r"x[abc]yz{2}w", r"\d{2,4}", "abc*")] == [
        "feria del libro", "stand", "gastronomic", " circo", "", "", "ab", "x", "", "ab"]
    every = [p for named in lexicon.CATEGORIES.values() for p in named] + [*lexicon.CALLS, *lexicon.PAST, *lexicon.OFF_TOPIC]
    assert sum(len(text.needed(p)) > 1 for p in every) > len(every) * 0.8
    said = ["gran concierto de banda en el teatro", "feria del libro y expo", "standup", "stand up", "se realizo la feria, gracias a todos", "corte de luz y bloqueo", "laferia", "", None]
    rows = spark.createDataFrame([(t,) for t in said], "t string")
    plain = sum((F.col("t").rlike(p).cast("int") for p in every), F.lit(0))
    assert [r.a for r in rows.select(text.hits(F.col("t"), every).alias("a")).collect()] == [r.b for r in rows.select(plain.alias("b")).collect()]


def test_an_analysis_runs_in_methods_that_are_compiled(spark, monkeypatch):
    """All patterns of an item in one stage were one method that the JVM only interprets."""
    from agenda_engine.operators import events

    limits = []
    monkeypatch.setattr(events, "cut", lambda df, real=events.cut: limits.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) or real(df))
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    assert QUERIES["relevance_reasons"](spark, SF).count() > 0
    assert limits == ["8000"] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
