"""Runs from end to end: two in a row over captures and pages, against their parts."""

from __future__ import annotations

import csv
import json

import pytest

from agenda_engine.plans import run
from agenda_engine.sources import captures, sinks

CONFIG = {
    "settings": {"timezone": "America/La_Paz", "max_muestras_rechazadas": 1, "unknown": 3},
    "sources": [
        {"id": "fb_two", "name": "Dos", "type": "facebook_public", "source_class": "venue", "tier": 2, "url": "https://f.example/two", "region": "Oruro"},
        {"id": "fb_one", "name": "Uno", "type": "facebook_public", "source_class": "eventos", "tier": 1, "url": "https://f.example/one", "region": "La Paz", "city": "La Paz"},
        {"id": "fb_none", "name": "Sin turno", "type": "facebook_public", "source_class": "media", "tier": 3, "url": "https://f.example/none", "region": "Beni"},
        {"id": "web", "name": "Web", "type": "web", "source_class": "eventos", "tier": 1, "url": "https://w.example/", "region": "Oruro", "city": "Oruro"},
    ],
}
LUNA = "Gran concierto de Luna Llena en La Paz, 20 de agosto de 2026 a las 20:00. Entradas Bs 50. Teatro Municipal. Te esperamos!"
FERIA = "Feria del libro en Oruro, 22 de agosto de 2026 a las 19:00, ingreso libre y gratuito. Te esperamos en la plaza!"
PAGE = """<html><head><title>Agenda</title><script type="application/ld+json">{"@type":"MusicEvent","name":"Sol Naciente en vivo","startDate":"2026-08-25T20:00:00-04:00",
"description":"Un concierto grande el 25 de agosto de 2026 a las 20:00, entradas a la venta","location":{"name":"Sala Azul","address":{"addressLocality":"Oruro"}},"offers":{"price":"80","priceCurrency":"BOB"}}</script></head><body></body></html>"""


def _item(source, text, **more):
    return {"source_id": source, "source_name": source, "source_url": f"https://f.example/{source}", "item_url": f"https://f.example/{source}/{abs(hash(text)) % 97}", "text": text, "source_class": "eventos", "tier": 1, "image_urls": ["https://i.example/a.jpg"]} | more


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("run")


@pytest.fixture(scope="module")
def two_runs(spark, folder):
    (folder / "sources.json").write_text(json.dumps(CONFIG))
    first = {"fb_one": {"items": [_item("fb_one", LUNA), _item("fb_one", "corto"), _item("fb_one", "tambien")], "error": None}, "fb_two": {"items": [_item("fb_two", FERIA)], "error": None}, "gone": {"items": [_item("gone", LUNA)], "error": None}}
    second = {"fb_one": {"items": [_item("fb_one", LUNA.replace("Bs 50", "Bs 70"))], "error": None}, "fb_two": {"items": [], "error": "posible bloqueo"}}
    for name, results in (("a", first), ("b", second)):
        (folder / f"{name}.json").write_text(json.dumps({"scraped_at": "x", "results": results}))
    spark.createDataFrame([("web", "https://w.example/", PAGE, True)], "source_id string, url string, html string, is_root boolean").write.parquet(str(folder / "pages"))
    out, seen = str(folder / "out"), []
    for name, at in (("a", "2026-08-14 10:00:00"), ("b", "2026-08-15 10:00:00")):
        more = ["--pages", str(folder / "pages")] if name == "a" else []
        run.main(["--config", str(folder / "sources.json"), "--captures", str(folder / f"{name}.json"), "--out", out, "--at", at, *more], spark)
        seen.append({f: (folder / "out" / f).read_text("utf-8") for f in (run.FULL, run.LITE, run.STATUS, run.TABLE, run.ROTATION)})
    return seen


def test_the_first_run_publishes_what_was_captured(two_runs):
    full, status = json.loads(two_runs[0][run.FULL]), json.loads(two_runs[0][run.STATUS])
    assert sorted(e["starts_at"][:16] for e in full["events"]) == ["2026-08-20T20:00", "2026-08-22T19:00", "2026-08-25T20:00"]
    assert full["summary"] | {"events_corroborated": 0} == full["summary"] and full["summary"]["events_total"] == full["summary"]["events_upcoming"] == full["summary"]["events_seen_this_run"] == 3
    assert (full["generated_at"], full["timezone"], full["summary"]["sources_total"], full["summary"]["sources_ok"], full["summary"]["sources_skipped"]) == ("2026-08-14T10:00:00-04:00", "America/La_Paz", 4, 3, 1)
    assert [s["id"] for s in full["sources"]] == ["fb_two", "fb_one", "fb_none", "web"] and status["sources"] == full["sources"] and status["coverage"] == full["coverage"]
    one = full["sources"][1]
    assert (one["raw_items"], one["events"], one["rejected"], len(one["rejected_samples"]), one["rejected_samples"][0]["reason"]) == (3, 1, 2, 1, "texto_muy_corto")
    assert full["coverage"] == {"fuentes_totales": 3, "con_datos_alguna_vez": 2, "horas_promedio_sin_datos": 0.0, "horas_maximo_sin_datos": 0.0, "nunca_vistas": ["fb_none"], "bloqueadas_en_la_ultima_corrida": [], "con_fallos_persistentes": []}


@pytest.mark.parametrize("n", range(2))
def test_a_document_agrees_with_its_events(two_runs, n):
    full, lite = (json.loads(two_runs[n][f]) for f in (run.FULL, run.LITE))
    up = [e for e in full["events"] if e["is_upcoming"]]
    starts = [e["starts_at"] for e in full["events"]]
    assert starts == sorted(starts)
    for name, column in (("categories", "category"), ("cities", "city"), ("departments", "department"), ("source_classes", "source_class")):
        held = [e.get(column) for e in up if e.get(column)]
        want = sorted(set(held), key=lambda v: (-held.count(v), held.index(v)))
        assert [(x["key"], x["count"]) for x in full["filters"][name]] == [(v, held.count(v)) for v in want]
    assert full["sections"]["free"] == [e["event_id"] for e in up if e["is_free"]] and full["sections"]["featured"] == [e["event_id"] for e in up if e["is_featured"]]
    assert list(full["sections"]) == ["today", "tomorrow", "this_weekend", "free", "featured"] and len(full["coverage_by_department"]) == 9
    assert full["coverage_by_department"]["La Paz"]["events_total"] == sum(e["department"] == "La Paz" for e in full["events"])
    assert list(full["coverage_by_category"]) == sorted({e["category"] for e in full["events"]})
    assert [e["event_id"] for e in lite["events"]] == [e["event_id"] for e in up] and all(len(e) == 36 for e in lite["events"])
    assert lite["summary"]["events_total"] == len(up) and lite["filters"] == full["filters"] and lite["sections"] == full["sections"]
    rows = list(csv.reader(two_runs[n][run.TABLE].removeprefix("﻿").splitlines()))
    assert len(rows[0]) == 22 and [r[0] for r in rows[1:]] == [e["event_id"] for e in full["events"]]


def test_the_second_run_keeps_ids_carries_and_counts_turns(spark, folder, two_runs):
    before, after = ({e["starts_at"][:10]: e for e in json.loads(two_runs[n][run.FULL])["events"]} for n in range(2))
    assert {k: e["event_id"] for k, e in after.items()} == {k: e["event_id"] for k, e in before.items()}
    luna, feria = after["2026-08-20"], after["2026-08-22"]
    assert luna["seen_this_run"] and luna["price_from"] == 70.0 and luna["history_count"] == 2 and not feria["seen_this_run"] and feria["history_count"] == 1
    status = {s["id"]: s["status"] for s in json.loads(two_runs[1][run.STATUS])["sources"]}
    assert status == {"fb_two": "blocked", "fb_one": "ok", "fb_none": "skipped", "web": "skipped"}
    turns = json.loads(two_runs[1][run.ROTATION])["fuentes"]
    assert list(turns) == ["fb_one", "fb_two"] and turns["fb_one"]["exitos"] == 2 and turns["fb_two"]["bloqueos"] == 1 and turns["fb_two"]["ultimo_exito"] == "2026-08-14T10:00:00-04:00"
    assert len(sinks.versions(spark, str(folder / "out" / run.VERSIONS))) == 2


def test_the_next_wave_takes_who_was_never_seen_first(spark, folder, two_runs, capsys):
    run.main(["--config", str(folder / "sources.json"), "--out", str(folder / "out"), "--at", "2026-08-15 12:00:00", "--plan", "--alone", "1", "--groups", "2", "--group-size", "2"], spark)
    wave = json.loads(capsys.readouterr().out.removeprefix("matriz="))["include"]
    assert wave[0]["fuentes"] == "fb_none" and sorted(wave[1]["fuentes"].split(",")) == ["fb_one", "fb_two"]


def test_a_run_with_nothing_publishes_empty_documents(spark, tmp_path):
    sources = captures.read_sources(spark, _config(tmp_path))
    summary = run.publish(spark, sources, captures.read_captures(spark, []), str(tmp_path / "out"), "2026-08-14 10:00:00")
    full = json.loads((tmp_path / "out" / run.FULL).read_text("utf-8"))
    assert summary["events_total"] == 0 and summary["sources_skipped"] == 4 and full["events"] == [] and full["filters"]["cities"] == [] and json.loads((tmp_path / "out" / run.ROTATION).read_text())["fuentes"] == {}


def _config(tmp_path) -> str:
    (tmp_path / "sources.json").write_text(json.dumps(CONFIG))
    return str(tmp_path / "sources.json")
