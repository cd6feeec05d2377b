"""The rotation as a stream's state against the same waves one after the other."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from agenda_engine.operators import rotation
from agenda_engine.streaming import turns_taken

KINDS = "source_id string, last_try timestamp_ntz, last_success timestamp_ntz, state string, failures int, blocks int, last_block timestamp_ntz, successes int, last_error string"


def test_the_stream_equals_the_waves(spark, tmp_path):
    rng, source, out = random.Random(1), tmp_path / "in", str(tmp_path / "out")
    columns = "source_id string, n_items int, error string, at timestamp"
    want = spark.createDataFrame([], KINDS)
    for wave, day in enumerate((1, 3, 20, 60)):
        at = dt.datetime(2026, 1, 1, 9) + dt.timedelta(days=day)
        rows = [(f"s{k}", rng.choice([0, 3]), rng.choice([None, None, "", "Omitida por turno", "posible bloqueo", "HTTP  500"]), at) for k in rng.sample(range(12), 6)]
        made = spark.createDataFrame(rows, columns)
        made.coalesce(1).write.mode("append").parquet(str(source))
        want = spark.createDataFrame(rotation.update(want, made, at.strftime("%Y-%m-%d %H:%M:%S")).collect(), KINDS)
        turns_taken.start(spark.readStream.schema(columns).parquet(str(source)), out, str(tmp_path / "log")).awaitTermination(90)
    changes = spark.read.parquet(out)
    last = changes.withColumn("n", F.row_number().over(Window.partitionBy("source_id").orderBy(F.col("batch").desc()))).where("n = 1")
    told = KINDS.replace(" timestamp_ntz", "").replace(" string", "").replace(" int", "").split(", ")
    assert sorted(tuple(r) for r in last.where("not gone").select(*told).collect()) == sorted(tuple(r) for r in want.select(*told).collect())
    assert last.where("gone").count() == changes.select("source_id").distinct().count() - want.count() > 0
    assert changes.where("not gone").count() == 24  # each wave rewrites its own sources alone
