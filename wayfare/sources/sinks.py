"""Writing layers and exports."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}
_NOTED: list[list[str]] = []  # folders made inside each open ``cleaned`` block


def noted(path: str) -> str:
    """``path``, remembered as intermediate by the ``cleaned`` blocks around."""
    for made in _NOTED:
        made.append(path)
    return path


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables that are made inside the block, when it ends.

    For code that writes its result inside the block to a folder of its own; tables that are
    still to be read must not depend on what was made.
    """
    made: list[str] = []
    _NOTED.append(made)
    try:
        yield
    finally:
        _NOTED[:] = [x for x in _NOTED if x is not made]
        for path in made:
            remove(spark, path)


def rebalanced(table: DataFrame, *by: str) -> DataFrame:
    """Bring rows of the same partition value together before a partitioned write.

    Each value gets files of the advisory size: without it every task would write one
    small file per value. Adaptive execution splits the partitions that come out too
    large, so a value with a third of the rows is written by many tasks.
    """
    return table.hint("rebalance", *[F.col(column) for column in by])


FILES_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _files_at_once(spark: SparkSession, number: int) -> Iterator[None]:
    """Let a task that writes a partitioned table keep some files open, unless the session says
    how many. Rows are then not sorted by partition; a task that meets more values sorts the rest."""
    before = spark.conf.get(FILES_AT_ONCE)
    if before != "0":
        yield
        return
    spark.conf.set(FILES_AT_ONCE, str(number))
    try:
        yield
    finally:
        spark.conf.set(FILES_AT_ONCE, before)


def write_layer(table: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the stored table at ``path`` and return it as read back."""
    writer = table.write.mode("overwrite").partitionBy(*partition_by)
    with _files_at_once(table.sparkSession, 8) if partition_by else nullcontext():
        writer.parquet(path)
    # The schema is known: no file needs to be opened to find it.
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_counted(
    table: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, Any]]:
    """``write_layer``, and what was seen on the way: ``rows``, and ``metrics`` (aggregates).

    The rows are observed by the tasks that write them, after the last shuffle, so a task that
    is run again counts once. Columns in ``drop`` are for the metrics and are not written.
    """
    seen = Observation()
    asked = {"rows": F.count(F.lit(1)), **(metrics or {})}
    watched = table.observe(seen, *[value.alias(name) for name, value in asked.items()])
    stored = write_layer(watched.drop(*drop), path, partition_by)
    found = seen.get
    # Spark leaves the observation out of the plan of a table that it knows to be empty.
    return stored, {name: found.get(name, 0 if name == "rows" else None) for name in asked}


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path in its terms."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder of this library, in whatever store it is; false if there was none."""
    system, place = _file_system(spark, path)
    return system.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it is missing."""
    system, place = _file_system(spark, path)
    return [x.getPath().getName() for x in system.listStatus(place)] if system.exists(place) else []


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, and the folders above it."""
    system, place = _file_system(spark, path)
    system.create(place, True).close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder."""
    system, place = _file_system(spark, source)
    if not system.rename(place, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source}")


def write_csv(table: DataFrame, path: str, order: Sequence = ()) -> None:
    """One CSV file of this name with header, rows in the given order. For report-sized results.

    Spark writes it in a folder beside; then it takes the place of an older file in one step (in
    stores that can rename), so a reader finds the old report or the new one. If that fails, the
    old one stays.
    """
    spark = table.sparkSession
    single = table.repartition(1)
    if order:
        single = single.sortWithinPartitions(*order)
    folder = f"{path}.{uuid.uuid4().hex}"
    try:
        single.write.option("header", True).csv(folder)
        parts = [name for name in names_in(spark, folder) if name.startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one file in {folder}, found {len(parts)}")
        _replace(spark, f"{folder}/{parts[0]}", path)
    finally:
        remove(spark, folder)


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    system, place = _file_system(spark, target)
    if system.exists(place) and system.getFileStatus(place).isDirectory():
        system.delete(place, True)  # a report as older versions wrote it
    options = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
    options[0] = hadoop.fs.Options.Rename.OVERWRITE
    context = hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(hadoop.fs.Path(source), place, options)


def export_reports(
    reports: Mapping[str, tuple[DataFrame, Sequence]], directory: str
) -> list[str]:
    """Write each named report to the file ``directory/<name>.csv``; returns the paths."""
    paths = []
    for name, (report, order) in reports.items():
        path = f"{directory.rstrip('/')}/{name}.csv"
        write_csv(report, path, order)
        paths.append(path)
    return paths


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names for intermediate tables.

    Without such a setting a session on this machine gets one temporary folder; a cluster
    must have one that all executors reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="wayfare-")
        base = _LOCAL_FOLDERS[application]
    return noted(f"{base.rstrip('/')}/wayfare-{uuid.uuid4().hex}")


def stored(table: DataFrame, name: str) -> DataFrame:
    """Write a table that several branches read, and return it as read back.

    Cuts the lineage with a column store: each reader takes only its own columns, and
    lost executors are replaced by reading files again.
    """
    return write_layer(table, f"{shared_folder(table.sparkSession)}/{name}")
