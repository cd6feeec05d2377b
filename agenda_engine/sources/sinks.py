"""Published files: documents, tables and the snapshot of the catalogue."""

from __future__ import annotations

import json
import time
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agenda_engine.operators.order import ranks


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def write_snapshot(events: DataFrame, folder: str, version: str | None = None) -> str:
    """Writes a version of the catalogue beside the others and then names it; readers see the one before until then.

    The name is a small table of its own under a number that grows, moved into place in one step, so readers find the last or
    the one before. A version that is given its name is written once: a second call finds it and names it again.
    """
    spark, base = events.sparkSession, folder.rstrip("/")
    files, make = _files(spark, base)
    version = f"{base}/{version or f'v{time.time_ns()}'}"
    if not files.exists(make(f"{version}/_SUCCESS")):
        events.write.mode("overwrite").parquet(version)
    number, claimed = max([0, *_numbers(spark, base)]) + 1, 0
    draft = f"{base}/.names-{uuid.uuid4().hex}"
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.json(draft)
    files.mkdirs(make(f"{base}/names"))
    # a number is claimed by a file that only one writer can create; a rename onto a folder that exists would nest inside it on some file systems
    while not files.createNewFile(make(f"{base}/claims/{number:09d}")):
        if number in _numbers(spark, base) or claimed >= 3:
            raise RuntimeError("another writer named a version at the same time")
        number, claimed = number + 1, claimed + 1  # left by a writer that was lost before it named anything
    if not files.rename(make(draft), make(f"{base}/names/{number:09d}")):
        raise RuntimeError("another writer named a version at the same time")
    return version


def _numbers(spark: SparkSession, base: str) -> list[int]:
    files, make = _files(spark, base)
    return [int(s.getPath().getName()) for s in files.listStatus(make(f"{base}/names"))] if files.exists(make(f"{base}/names")) else []


def current_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The version that the folder's last name stands for."""
    base = folder.rstrip("/")
    return spark.read.parquet(spark.read.schema("version string").json(f"{base}/names/{max(_numbers(spark, base)):09d}").first()["version"])


def versions(spark: SparkSession, folder: str) -> dict[int, str]:
    """The place of every version that a folder names, by its number."""
    base = folder.rstrip("/")
    if not _numbers(spark, base):
        return {}
    named = spark.read.schema("version string").json(f"{base}/names/*").select(F.regexp_extract("_metadata.file_path", "/names/([0-9]+)/", 1).cast("int").alias("n"), "version")
    return {r.n: r.version for r in named.collect()}


def has_snapshot(spark: SparkSession, folder: str) -> bool:
    """Whether a folder names any version."""
    return bool(_numbers(spark, folder.rstrip("/")))


def write_rotation(rotation: DataFrame, at: str, path: str) -> None:
    """Writes the rotation as one JSON document, keys sorted, on any file system that Spark knows; its rows are written in parallel."""
    names = {
        "bloqueos": "blocks", "exitos": "successes", "fallos_seguidos": "failures", "ultimo_bloqueo": "last_block", "ultimo_error": "last_error", "ultimo_estado": "state",
        "ultimo_exito": "last_success", "ultimo_intento": "last_try",
    }
    moments = {f.name for f in rotation.schema if f.dataType.typeName().startswith("timestamp")}
    told = {k: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-04:00")) if c in moments else F.col(c) for k, c in names.items()}
    ranked = ranks(rotation, [F.col("source_id")])
    key = F.to_json(F.array("source_id"))
    entry = F.concat(F.when(F.col("rank") == 1, "").otherwise(","), F.substr(key, F.lit(2), F.length(key) - 2), F.lit(": "), F.to_json(F.struct(*(c.alias(k) for k, c in told.items())), {"ignoreNullFields": "false"}))
    head = f'{{\n"actualizado": {json.dumps(at)},\n"fuentes": {{\n'
    write_joined(path, [head, ranked.select("rank", entry.alias("line")), "}\n}\n"], rotation.sparkSession)


def csv_rows(events: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as texts: lists joined with ' | ', nulls empty."""
    kinds = dict(events.dtypes)
    return events.select(*((F.array_join(c, " | ") if kinds[c].startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in columns))


def write_csv(events: DataFrame, columns: list[str], folder: str) -> None:
    """Writes the rows as CSV files with a header; a byte order mark opens each, for spreadsheets."""
    named = csv_rows(events, columns).withColumnRenamed(columns[0], "﻿" + columns[0])
    named.write.option("header", True).option("quoteAll", False).mode("overwrite").csv(folder)


def write_joined(path: str, pieces: list[str | DataFrame], spark: SparkSession) -> None:
    """Writes one file of texts and tables, in order, on any file system that Spark knows.

    A table has a column `line` and a `rank` that orders it; it is written in parallel, in ranges of its rank, and its parts are then
    copied into the file as streams of bytes, so no row comes to the driver. The file appears under its name when it is whole.
    """
    files, make = _files(spark, path)
    jvm, draft = spark.sparkContext._jvm, f"{path}.{uuid.uuid4().hex}"
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = files.create(make(f"{draft}/whole"))
    for i, piece in enumerate(pieces):
        if isinstance(piece, str):
            out.write(bytearray(piece.encode()))
            continue
        piece.repartitionByRange(many, "rank").sortWithinPartitions("rank").select("line").write.text(f"{draft}/{i}")
        for part in sorted(s.getPath().toString() for s in files.listStatus(make(f"{draft}/{i}")) if s.getPath().getName().startswith("part-")):
            held = files.open(make(part))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(held, out, 1 << 16, False)
            held.close()
    out.close()
    files.delete(make(path), True)
    moved = files.rename(make(f"{draft}/whole"), make(path))
    files.delete(make(draft), True)
    if not moved:
        raise RuntimeError(f"{path} could not be written")


def write_csv_file(events: DataFrame, columns: list[str], order: list[str | Column], path: str) -> None:
    """Writes the rows as one CSV file in an order, with a header and one byte order mark before it."""
    ranked = ranks(events, order)
    lines = csv_rows(ranked.select("rank", *columns), ["rank", *columns]).select(F.col("rank").cast("long"), F.to_csv(F.struct(*columns), {"emptyValue": ""}).alias("line"))
    write_joined(path, ["\ufeff" + ",".join(columns) + "\n", lines], events.sparkSession)


def _pieces(value: object) -> list[str | DataFrame]:
    """The parts of a document in order: texts, and tables of lines."""
    if isinstance(value, dict) and value:
        out: list[str | DataFrame] = []
        for i, (name, held) in enumerate(value.items()):
            out += [("{\n" if not i else ",\n") + json.dumps(name, ensure_ascii=False) + ": ", *_pieces(held)]
        return [*out, "\n}"]
    if not isinstance(value, tuple):
        return [json.dumps(value, ensure_ascii=False, indent=2)]
    rows, order = value
    ranked = rows if order is None else ranks(rows, order)
    least = ranked.agg(F.min("rank")).first()[0]
    told = [c for c in rows.columns if c != "rank" or order is not None]
    alone = F.to_json(F.array("value")) if told == ["value"] else None
    said = F.to_json(F.struct(*told), {"ignoreNullFields": "false"}) if alone is None else F.substr(alone, F.lit(2), F.length(alone) - 2)
    return ["[\n", ranked.select("rank", F.concat(F.when(F.col("rank") == least, "").otherwise(","), said).alias("line")), "]"]


def write_payload(path: str, document: dict, spark: SparkSession) -> None:
    """Writes one JSON document; other values than tables are small and written as they are.

    A (table, order) at any depth becomes a list of its rows in that order, or of its values where `value` is its only column; (table, None) is
    a table that has its own `rank`, without ties, which is not told.
    """
    write_joined(path, [*_pieces(document), "\n"], spark)


def write_lines(events: DataFrame, folder: str) -> None:
    """Writes rows as JSON lines, in parallel."""
    events.write.mode("overwrite").json(folder)


def write_document(document: dict, path: str) -> None:
    """Writes a small document of aggregates, readable and with its accents."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(document, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
