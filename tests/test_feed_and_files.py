"""Feeds of versions replayed, documents and tables as one file, and many capture files in one scan."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from agenda_engine.operators import feed
from agenda_engine.sources import captures, sinks

ROW = "event_id string, title string, tags array<string>, price double"


def test_a_feed_rebuilds_every_version(spark, tmp_path):
    rng, folder = random.Random(3), str(tmp_path / "catalogue")
    held: dict[str, tuple] = {}
    seen = []
    for _ in range(5):
        for k in rng.sample(range(30), 8):
            held.pop(f"e{k}", None)
        for k in rng.sample(range(30), 10):
            held[f"e{k}"] = (f"e{k}", rng.choice(["a", "b", None]), rng.choice([["x"], [], None]), rng.choice([1.0, None]))
        sinks.write_snapshot(spark.createDataFrame(list(held.values()), ROW), folder)
        seen.append(dict(held))
    changes = feed.read_feed(spark, folder).cache()
    now = spark.createDataFrame([], ROW)
    for n, want in enumerate(seen, 1):
        step = changes.where(F.col(feed.VERSION) == n)
        before = seen[n - 2] if n > 1 else {}
        ops = {r.event_id: r[feed.OP] for r in step.collect()}
        assert ops == {k: "insert" if k not in before else "delete" if k not in want else "update" for k in {*before, *want} if before.get(k) != want.get(k)}
        now = feed.applied(now, step)
        assert {r.event_id: tuple(r) for r in now.collect()} == want
    assert {r[feed.VERSION] for r in feed.read_feed(spark, folder, after=3).collect()} == {4, 5}
    assert feed.read_feed(spark, folder, after=5) is None and sinks.versions(spark, str(tmp_path / "none")) == {}


def test_a_column_that_comes_is_a_change(spark):
    old, new = spark.createDataFrame([("a", 1), ("b", 2)], "event_id string, x int"), spark.createDataFrame([("a", 1, None), ("b", 2, "y")], "event_id string, x int, z string")
    assert [tuple(r) for r in feed.difference(old, new).collect()] == [("update", "b", 2, "y")]


def test_the_payload_is_one_document(spark, tmp_path):
    rows = [(i, f"título {i}", [f"u{i}"] if i % 2 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, title string, urls array<string>").repartition(7)
    path = str(tmp_path / "payload.json")
    for _ in range(2):  # a second run replaces the first
        sinks.write_payload(path, {"summary": {"n": 50, "ñ": [1]}, "events": (df, [F.col("id").desc()]), "none": (df.limit(0), [F.col("id")]), "last": "x"}, spark)
    assert json.loads((tmp_path / "payload.json").read_text("utf-8")) == {
        "summary": {"n": 50, "ñ": [1]}, "events": [{"id": i, "title": t, "urls": u} for i, t, u in reversed(rows)], "none": [], "last": "x",
    }
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["payload.json"]


def test_the_table_is_one_file_with_one_mark(spark, tmp_path):
    df = spark.createDataFrame([(2, "b, c", ["x", "y"]), (1, 'a "q"', None), (3, None, [])], "id int, title string, urls array<string>").repartition(3)
    sinks.write_csv_file(df, ["title", "urls"], [F.col("id")], str(tmp_path / "t.csv"))
    import csv

    text = (tmp_path / "t.csv").read_text("utf-8")
    assert text.startswith("﻿title,urls\n") and text.count("﻿") == 1
    assert list(csv.reader(text.splitlines()[1:], escapechar="\\", doublequote=False)) == [['a "q"', ""], ["b, c", "x | y"], ["", ""]]


def test_many_capture_files_are_one_scan(spark, tmp_path):
    paths = []
    for i in range(40):
        path = tmp_path / f"a b{39 - i}.json"  # names in another order than the list
        path.write_text("{broken" if i % 10 == 3 else json.dumps({"scraped_at": "x", "results": {f"s{i % 7}": {"items": [{"text": str(i)}], "error": None}}}))
        paths.append(str(path))
    paths.append(paths[0])
    read = captures.read_captures(spark, paths)
    want = {}
    for i in [*range(40), 0]:
        if i % 10 != 3:
            want[f"s{i % 7}"] = str(i)
    assert {r.source_id: r["items"][0].text for r in read.collect()} == want
    assert read._jdf.queryExecution().sparkPlan().toString().count("FileScan json") == 1
    assert sorted(r.file for r in captures.rejected(spark, paths).collect()) == [3, 13, 23, 33]
