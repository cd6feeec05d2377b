"""Scenarios of the catalogue, each operator against a small plain version of itself."""

from __future__ import annotations

import datetime as dt
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from agenda_engine.functions import clock
from agenda_engine.functions.text import first_distinct, fold, jaccard
from agenda_engine.operators import dates, extraction, resolve, rotation, serving, state
from agenda_engine.operators.components import components
from agenda_engine.sources import captures, sinks, web

NOW = "2026-08-14 10:00:00"


def test_fold_equals_decomposition(spark):
    said = ["ÁRBOL  Ñandú", "𝐂𝐨𝐧𝐜𝐢𝐞𝐫𝐭𝐨 ｆｕｌｌ", "línea\n\n dos\t", "", None, "çÇ ö ü ẽ", "① ²"]
    got = [r.f for r in spark.createDataFrame([(s,) for s in said], "t string").select(fold(F.col("t")).alias("f")).collect()]
    plain = ["".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c)).lower() for s in said]
    assert got == [re.sub(r"\s+", " ", p).strip() for p in plain]


def test_ordered_distinct_and_jaccard(spark):
    row = spark.sql("select array('Uno.', ' uno', 'Dos', '', 'dos,', 'Tres') as v, array('a','b') as a, array('b','c') as b, array() as e").select(
        first_distinct(F.col("v")).alias("all"), first_distinct(F.col("v"), 2).alias("two"), jaccard(F.col("a"), F.col("b")).alias("j"), jaccard(F.col("a"), F.col("e").cast("array<string>")).alias("z")
    ).first()
    assert (row["all"], row.two, row.z) == (["Uno", "Dos", "Tres"], ["Uno", "Dos"], 0.0) and row.j == pytest.approx(1 / 3)


@pytest.mark.parametrize(
    ("text", "starts", "ends", "doors", "confidence"),
    [
        ("Noche de rock el sábado 23 de agosto, puertas 19:00, show 20:30", "2026-08-23 20:30", None, "19:00", "exacta"),
        ("Feria del 5 al 7 de septiembre", "2026-09-05 00:00", "2026-09-07 23:59", None, "aproximada"),
        ("del 28 de agosto al 2 de septiembre", "2026-08-28 00:00", "2026-09-02 23:59", None, "aproximada"),
        ("del 30 de diciembre al 2 de enero", "2026-12-30 00:00", "2027-01-02 23:59", None, "aproximada"),
        ("15/03/2027 a las 8 pm", "2027-03-15 20:00", None, None, "exacta"),
        ("este viernes a las 8 de la noche", "2026-08-14 20:00", None, None, "relativa"),
        ("próximo viernes", "2026-08-21 00:00", None, None, "relativa"),
        ("pasado mañana 9 am", "2026-08-16 09:00", None, None, "relativa"),
        ("2026-09-05 y 2026-09-07", "2026-09-05 00:00", "2026-09-07 23:59", None, "aproximada"),
        ("12 de agosto", "2026-08-12 00:00", None, None, "aproximada"),
        ("10 de agosto", "2027-08-10 00:00", None, None, "aproximada"),
        ("el 31 de febrero", None, None, None, "desconocida"),
        ("31 de febrero o el 4/9", "2026-09-04 00:00", None, None, "aproximada"),
        ("concierto 12 de agosto", "2026-08-12 12:00", None, None, "exacta"),
        ("19.10 hrs", "2026-10-19 19:10", None, None, "exacta"),
        ("hoy a las 08:00", "2026-08-14 20:00", None, None, "relativa"),
        ("", None, None, None, "desconocida"),
    ],
)
def test_date_grammar(spark, text, starts, ends, doors, confidence):
    rows = spark.createDataFrame([(text,)], "text string").select(fold(F.col("text")).alias("p"), F.lit("2026-08-14").cast("date").alias("a"))
    r = dates.when(rows, "p", "a").first()
    told = [x and x.strftime("%Y-%m-%d %H:%M") for x in (r.starts, r.ends)]
    assert (*told, r.doors, r.confidence) == (starts, ends, doors, confidence)


def test_lifecycle_and_display(spark):
    at = dt.datetime
    rows = [(None, None), (at(2026, 8, 14, 8), at(2026, 8, 14, 12)), (at(2026, 8, 14, 8), None), (at(2026, 8, 15), None), (at(2026, 8, 10), at(2026, 8, 20)), (at(2026, 8, 10), None)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    assert [r.l for r in df.select(clock.lifecycle(F.col("s"), F.col("e"), clock.moment(NOW)).alias("l")).collect()] == ["sin_fecha", "en_curso", "hoy", "proximo", "en_curso", "finalizado"]
    shown = [r.d for r in df.select(clock.display_date(F.col("s"), F.col("e"), F.col("e").isNotNull(), F.lit(False)).alias("d")).collect()]
    assert shown[2] == "Viernes 14 de agosto · 08:00" and shown[4] == "Del 10 al 20 de agosto"


@pytest.mark.parametrize(("now", "saturday"), [("2026-08-14 10:00:00", "2026-08-15"), ("2026-08-15 10:00:00", "2026-08-15"), ("2026-08-16 10:00:00", "2026-08-15"), ("2026-08-17 10:00:00", "2026-08-22")])
def test_weekend(spark, now, saturday):
    assert str(spark.range(1).select(clock.weekend(clock.moment(now))[0].alias("s")).first().s) == saturday


def test_analysis_and_relevance(spark):
    posters = [
        ("Gran concierto de rock en vivo. Entradas Bs 50, Bs. 80,50 y 100 bs. Te esperamos! #Rock https://ticket.bo/x 71234567", "eventos"), ("Se realizó la feria, gracias a todos", "media"), ("Corte de luz y bloqueo por el paro", "media"), (None, None),
    ]
    said = extraction.analyse(spark.createDataFrame(posters, "text string, source_class string"))
    no = F.lit(False)
    scored = said.withColumn("score", extraction.relevance(F.col("text").startswith("Gran"), F.lit(True), no, no, no, no, no, F.coalesce("source_class", F.lit("")))).collect()
    assert (scored[0].category, scored[0].price_from, scored[0].price_to, scored[0].ticket_urls, scored[0].phones) == ("concierto", 50.0, 100.0, ["https://ticket.bo/x"], ["71234567"])
    assert scored[0].score == 34 + 16 + 13 + 11 + 6 + 8
    assert scored[1].score == 0 and scored[2].off_topic == 3 and scored[3].score == 0


def test_rotation_deals_every_source_in_turn(spark):
    rows = spark.createDataFrame([(f"s{i:02d}", float(60 - i)) for i in range(60)], "source_id string, score double")
    wave = {r.source_id: r for r in rotation.plan_wave(rows).collect()}
    assert sum(r.slot == "alone" for r in wave.values()) == 6 and sum(r.slot == "shared" for r in wave.values()) == 28 and sum(r.slot == "deferred" for r in wave.values()) == 26
    assert [wave[f"s{i:02d}"].group_no for i in (6, 19, 20, 33)] == [7, 20, 7, 20]
    assert rotation.wave_matrix(rotation.plan_wave(rows.limit(3))).first().matrix == '{"include":[{"nombre":"g01","orden":0,"fuentes":"s00"},{"nombre":"g02","orden":1,"fuentes":"s01"},{"nombre":"g03","orden":2,"fuentes":"s02"}]}'


def test_what_was_never_seen_goes_first_and_what_was_never_tried_is_forgotten(spark):
    at, seen = "2026-08-14 10:00:00", dt.datetime(2026, 8, 1, 10)
    rows = spark.createDataFrame([("never", None), ("long", seen), ("ahead", dt.datetime(2026, 8, 20))], "source_id string, last_success timestamp_ntz")
    hours = {r.source_id: r.h for r in rows.select("source_id", clock.hours_since(F.col("last_success"), clock.moment(at)).alias("h")).collect()}
    assert hours == {"never": clock.NEVER_SEEN_HOURS, "long": 312.0, "ahead": 0.0}
    known = "source_id string, last_try timestamp_ntz, last_success timestamp_ntz, state string, failures int, blocks int, last_block timestamp_ntz, successes int, last_error string"
    kept = rotation.update(spark.createDataFrame([("a", seen, *(None,) * 7), ("b", *(None,) * 8)], known), spark.createDataFrame([], "source_id string, n_items int, error string"), at)
    assert [r.source_id for r in kept.collect()] == ["a"]


def test_quality_score_is_a_hundred_when_all_is_there(spark):
    full = {"starts_at": "x", "has_image": True, "has_video": True, "venue": "v", "city": "c", "is_free": True, "price_from": 1.0, "ticket_urls": ["u"], "source_tier": 1, "corroborated": True, "organizer": "o", "showtimes": ["s"], "occurrences": ["x"], "formats": ["f"], "address": "a", "location_query": "q"}
    assert spark.createDataFrame([full]).select(serving.quality_score().alias("q")).first().q == 100


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)


def _events(rng, n):
    names = ["luna llena", "rio bravo", "sol naciente", "mar adentro"]
    for p in range(n):
        start = None if rng.random() < 0.15 else f"2026-08-{rng.randint(1, 4):02d}T20:00:00-04:00"
        end = f"2026-08-{rng.randint(1, 6):02d}T23:00:00-04:00" if start and rng.random() < 0.3 else None
        name = rng.choice(names)
        yield (p, f"{name} {rng.choice(names)} en concierto", [], f"gran noche {name} orquesta", rng.choice(["Teatro Uno", "Teatro Dos", None]), rng.choice(["La Paz", "Oruro", None]), None, start, end)


def test_clusters_equal_greedy_first_fit(spark):
    rows = list(_events(random.Random(7), 60))
    df = spark.createDataFrame(rows, "position long, title string, artists array<string>, description string, venue string, city string, department string, starts_at string, ends_at string")
    keyed = resolve.keyed(df).cache()
    pairs = keyed.alias("l").crossJoin(keyed.alias("r")).where("l.position < r.position").where(resolve.matches("l", "r")).select("l.position", "r.position").collect()
    edges = {(a, b) for a, b in pairs}
    found = {(r.a, r.b) for r in resolve.match_edges(keyed).collect()}
    assert found == edges
    clusters: list[list[int]] = []
    for p in range(60):
        for c in clusters:
            if any((q, p) in edges for q in c):
                c.append(p)
                break
        else:
            clusters.append([p])
    want = {p: c[0] for c in clusters for p in c}
    assert {r.position: r.cluster for r in resolve.clusters(df).collect()} == want


def test_reconcile_keeps_ids_and_notes_changes(spark):
    columns = "position long, title string, artists array<string>, description string, venue string, city string, category string, starts_at string, ends_at string, url string, all_urls array<string>, price_from double, status string, confidence double, source_count int"
    first = [(0, "Luna Llena", ["Luna"], "gran noche", "Teatro", "La Paz", "concierto", "2026-08-20T20:00:00-04:00", None, "u1", ["u1"], 50.0, "programado", 0.8, 2), (1, "Feria", [], "feria grande", "Plaza", "Oruro", "feria", "2026-08-01T10:00:00-04:00", None, "u2", ["u2"], None, "programado", 0.7, 1)]
    none = spark.createDataFrame([], columns + f", event_id string, first_seen_at string, last_seen_at string, history {state.HISTORY}")
    one = state.reconcile(spark.createDataFrame(first, columns), none, "2026-08-01 12:00:00")
    again = [(0, *first[0][1:12], "cancelado", 0.8, 1)]
    archive = spark.createDataFrame(one.collect(), one.schema)
    two = {r.title: r for r in state.reconcile(spark.createDataFrame(again, columns), archive, "2026-08-14 10:00:00").collect()}
    before = {r.title: r for r in one.collect()}
    luna = two["Luna Llena"]
    assert luna.event_id == before["Luna Llena"].event_id and luna.first_seen_at == "2026-08-01T12:00:00" and luna.changed_this_run == ["estado:programado->cancelado"]
    assert luna.source_count == 2 and luna.history_count == 2 and "Feria" not in two


def test_snapshots_are_versions(spark, tmp_path):
    folder = str(tmp_path / "catalogue")
    sinks.write_snapshot(spark.range(3), folder)
    sinks.write_snapshot(spark.range(5), folder)
    assert sinks.current_snapshot(spark, folder).count() == 5
    assert state.read_snapshot(spark, str(tmp_path / "none"), "id long").count() == 0


def test_structured_events_are_found_at_any_depth(spark):
    html = """<script type="application/ld+json">{"@graph":[{"@type":"Place","name":"x"},{"@type":["Thing","MusicEvent"],"name":"Uno","location":{"name":"Sala","address":{"streetAddress":"Calle 1","addressLocality":"Oruro"}},
      "offers":[{"price":"80"},{"price":"50.5","priceCurrency":"BOB","url":"u"}],"image":["i1","i2"]}]}</script><script type="application/ld+json">{broken</script>
      <script type="application/ld+json">{"@type":"ItemList","itemListElement":[{"item":{"@type":"Festival","name":"Dos","offers":{"price":0}}}]}</script>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>nothing</p>")], "page_id long, html string")
    got = {r.title: r for r in web.flatten_events(pages).select("page_id", *web.event_columns(F.col("event"))).collect()}
    assert set(got) == {"Uno", "Dos"}
    assert (got["Uno"].venue, got["Uno"].address, got["Uno"].offer.price_from, got["Uno"].offer.price_to, got["Uno"].image_url) == ("Sala", "Calle 1, Oruro", 50.5, 80.0, "i1")
    assert got["Dos"].offer.is_free


def test_captures_take_the_later_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"scraped_at":"x","results":{"s1":{"items":[{"text":"old"}],"error":null},"s2":{"items":[],"error":"posible bloqueo"}}}')
    (tmp_path / "b.json").write_text('{"scraped_at":"y","results":{"s1":{"items":[{"text":"new"},{"text":"newer"}],"error":null}}}')
    (tmp_path / "c.json").write_text("{broken")
    read = captures.read_captures(spark, [str(tmp_path / f) for f in ("a.json", "b.json", "c.json")])
    assert [r.text for r in captures.items(read).orderBy("item_no").collect()] == ["new", "newer"]
    sources = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "id string")
    assert {r.id: r.status for r in captures.source_rows(sources, read).collect()} == {"s1": "ok", "s2": "blocked", "s3": "skipped"}


def test_csv_has_a_mark_and_joined_lists(spark, tmp_path):
    rows = spark.createDataFrame([("Año", ["a", "b"], None)], "title string, urls array<string>, venue string")
    sinks.write_csv(rows, ["title", "urls", "venue"], str(tmp_path / "out"))
    text = max((f.read_text("utf-8") for f in (tmp_path / "out").glob("*.csv")), key=len)  # an empty partition may leave a file with the header alone
    assert text == "﻿title,urls,venue\nAño,a | b,\"\"\n"


def test_reconcile_candidates_lose_no_pair(spark):
    rows = []
    for p, title, _, said, venue, city, _, start, end in _events(random.Random(11), 50):
        rows.append((p, title, [], said, venue, city, None, start, end, None, [f"u{p % 9}"] if p % 4 == 0 else []))
    df = spark.createDataFrame(rows, "position long, title string, artists array<string>, description string, venue string, city string, category string, starts_at string, ends_at string, url string, all_urls array<string>")
    now, old = state.keyed(df.where("position % 2 = 0")).cache(), state.keyed(df.where("position % 2 = 1")).cache()
    every = now.alias("a").crossJoin(old.alias("b")).select(F.col("a.position").alias("n"), F.col("b.position").alias("o"), state.score("a", "b").alias("s")).collect()
    for threshold in (0.4, 0.62, 0.9):
        found = {(r.n, r.o) for r in state.candidates(now, old, threshold).collect()}
        assert {(r.n, r.o) for r in every if r.s >= threshold} <= found


def test_the_stream_takes_batches_and_replays(spark, tmp_path):
    from agenda_engine.streaming import upserts

    columns = "position long, title string, artists array<string>, description string, venue string, city string, category string, starts_at string, ends_at string, url string, all_urls array<string>, price_from double, status string, confidence double, source_count int, at string"
    source, folder = tmp_path / "in", str(tmp_path / "out")

    def put(name, status, at):
        rows = [(0, "Luna Llena", ["Luna"], "gran noche", "Teatro", "La Paz", "concierto", "2026-08-20T20:00:00-04:00", None, "u1", ["u1"], 50.0, status, 0.8, 1, at)]
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").json(str(source))
        stream = spark.readStream.schema(columns).json(str(source))
        upserts.start(stream, folder, str(tmp_path / name)).awaitTermination(60)

    put("log", "programado", "2026-08-01 12:00:00")
    first = sinks.current_snapshot(spark, folder).collect()
    assert len(first) == 1 and first[0].history_count == 1
    put("log", "cancelado", "2026-08-02 12:00:00")
    second = sinks.current_snapshot(spark, folder).collect()
    assert len(second) == 1 and second[0].event_id == first[0].event_id and second[0].history_count == 2
    version = sinks.write_snapshot(spark.range(3), folder, "batch-000000001")  # a replay of what is there
    assert sinks.current_snapshot(spark, folder).collect() == second and version.endswith("batch-000000001")


def test_rotation_goes_to_its_file_and_back(spark, tmp_path):
    path = str(tmp_path / "rotation.json")
    assert captures.read_rotation(spark, path).count() == 0
    rows = spark.createDataFrame([("s1", dt.datetime(2026, 8, 1, 10), None, "error", 2, 0, None, 1, "HTTP 500")], "source_id string, last_try timestamp_ntz, last_success timestamp_ntz, state string, failures int, blocks int, last_block timestamp_ntz, successes int, last_error string")
    sinks.write_rotation(rows, "2026-08-01T10:00:00-04:00", path)
    assert captures.read_rotation(spark, path).collect() == rows.collect()


def test_captures_of_one_name_in_two_folders(spark, tmp_path):
    for k, text in enumerate(("old", "new")):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "a.json").write_text(f'{{"scraped_at":"x","results":{{"s1":{{"items":[{{"text":"{text}"}}],"error":null}}}}}}')
    read = captures.read_captures(spark, [str(tmp_path / str(k) / "a.json") for k in range(2)])
    assert [r.text for r in captures.items(read).collect()] == ["new"]


def test_events_nested_ten_deep_are_found(spark):
    inner = '{"@type":"Event","name":"Hondo"}'
    for k in range(10):
        inner = f'{{"@graph":[{inner}]}}' if k % 2 else f'{{"item":{inner}}}'
    pages = spark.createDataFrame([(1, f'<script type="application/ld+json">{inner}</script>')], "page_id long, html string")
    assert [r.title for r in web.flatten_events(pages).select(*web.event_columns(F.col("event"))).collect()] == ["Hondo"]


def test_compatibility_form_equals_the_standard(spark):
    from agenda_engine.functions.text import compatible

    said = ["ﬁn de año\t ya", "Café y piña", "½ litro … ™ ①", "línea\n\n dos ", "", None, "Ａｂｃ"]
    got = [r.c for r in spark.createDataFrame([(s,) for s in said], "t string").select(compatible(F.col("t")).alias("c")).collect()]
    assert got == [re.sub(r"[ \t]+", " ", unicodedata.normalize("NFKC", s or "")).strip() for s in said]
    folded = [r.f for r in spark.createDataFrame([("ﬁn ½ … ™ Ĳ",)], "t string").select(fold(F.col("t")).alias("f")).collect()]
    assert folded == ["fin 1⁄2 ... tm ij"]
