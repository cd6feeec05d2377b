"""Tables that end a lineage and outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that this process has written and not dropped, by scope; the outermost list is the process itself.
_scopes: list[list[str]] = [[]]
#: Spark drops the shuffles of a statement at its end where this is set, else when the driver happens to collect garbage.
FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new local one where that is unset and all runs in this process."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="agenda-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of a session that hold inside it."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffled(spark: SparkSession):
    """What is written inside it joins by shuffles, but where a broadcast is asked for.

    A table that grows with the input is estimated by its files and the columns that are read of it, often far below what its rows
    take, and as a broadcast it would pass whole through the driver, several at once.
    """
    return _set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})


def in_small_methods(spark: SparkSession):
    """What is written inside it runs in methods that the JVM compiles: many costly expressions in one stage become one method beyond its limit of 8000 bytes, which is interpreted."""
    return _set(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


def _write(df: DataFrame, scope: list[str]) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/agenda-{uuid.uuid4().hex}"
    scope.append(path)
    with _set(spark, {FREES: "true"}):  # what is written is read from its table from here on
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Writes a table into the shared folder and reads it back: lineage ends there, and a lost executor loses nothing."""
    return _write(df, _scopes[-1])


def spread(df: DataFrame) -> DataFrame:
    """A table in as many parts as there are cores, where it has fewer; costly expressions over a small file then run side by side."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows dealt over the cores before costly expressions: a file with one row group is read by one task, however many parts the scan has."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _drop(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Drops the tables that are cut inside it at its end, but for those that the function it gives writes: these belong to the scope around it."""
    outer = _scopes[-1]
    own: list[str] = []
    _scopes.append(own)
    try:
        yield lambda df: _write(df, outer)
    finally:
        _scopes.remove(own)
        _drop(spark, own)


def drop_all(spark: SparkSession) -> None:
    """Drops every table that this process has cut; results that were made from them and not written are lost."""
    for scope in _scopes:
        _drop(spark, scope)
