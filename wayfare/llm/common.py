"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.sinks import noted

CHUNK_BYTES = 1 << 20  # text that a task handles at a time; one longer text is a chunk of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()
_LOCAL_FOLDERS: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of the application, once; a few dozen kB."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        target = f"{tempfile.mkdtemp(prefix='wayfare-code-')}/wayfare_code"
        context.addPyFile(shutil.make_archive(target, "zip", root, "wayfare"))
        _SHIPPED.add(context.applicationId)


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text leaves 1 when divided by 3.

    A NULL id has no crc32 and is not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def shared_path(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names for intermediate tables.

    Only where the setting is unset and all tasks run on this machine, as in tests, a folder
    of its own is made for the application.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="wayfare-llm-")
        base = _LOCAL_FOLDERS[context.applicationId]
    return noted(f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}")


def stored(frame: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: cuts the lineage."""
    path = shared_path(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def released(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which a worker gives free memory back.

    Workers outlive their tasks; what an idle one holds on to is missing elsewhere.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if option := getattr(ctypes.CDLL(None), "mallopt", None):
            option(-3, 1 << 20)  # blocks from 1 MB are mapped on their own, and unmapped when freed
        yield from run(batches)
        release()

    return wrapped


def release() -> None:
    """Give memory that is no longer used back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of a part is at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        yield from cut(batch, sizes.to_numpy(False), limit)


def cut(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``sizes`` add up to at most ``limit``, or one row."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, with NULL as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


BROADCAST_IDS = 4_000_000  # ids (32 MB) that are sent to all tasks; more are joined by shuffle


def few(ids: DataFrame) -> DataFrame:
    """A table of ids to join with: broadcast if counted to be few, else left to a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def tasks_for(total: int, per_task: int) -> int:
    """Number of partitions so that each gets about ``per_task`` of ``total``."""
    return max(1, -(-int(total) // per_task))
