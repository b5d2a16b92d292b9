"""History of refreshes: one folder per run, and two logs that are only appended to.

A run counts once its SUCCESS row is in the log. Readers take the last such run, so they
see either all tables of the old run or all of the new one, and a run that fails midway
leaves the old one as it was.

``retain`` deletes the folders of older runs. A reader that must not lose its tables holds a
lease on their run: an empty file that names the time it ends, so that a reader which dies
does not keep a run for ever.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.sources.sinks import move, names_in, remove, touch

# Names of the logs and states of a run.
RUN_LOG = "audit.pipeline_run"
LOAD_LOG = "audit.load_audit"
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"

_RUN_SCHEMA = (
    "run_id string, run_name string, status string, started_at timestamp, "
    "finished_at timestamp, message string"
)
_LOAD_SCHEMA = (
    "run_id string, layer_name string, object_name string, row_count bigint, status string, "
    "message string, logged_at timestamp"
)
_SCHEMAS = {RUN_LOG: _RUN_SCHEMA, LOAD_LOG: _LOAD_SCHEMA}


def table_path(root: str, name: str) -> str:
    """``<root>/<layer>/<table>``."""
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def run_folder(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{RUNS}/{run_id}"


def read_log(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(table_path(root, name))


def latest_run(spark: SparkSession, root: str) -> str:
    """Id of the last run that succeeded. One row comes back to the driver."""
    done = read_log(spark, root, RUN_LOG).where(F.col("status") == SUCCESS)
    run_id = done.agg(F.max_by("run_id", "finished_at")).first()[0]
    if run_id is None:
        raise LookupError(f"no refresh below {root} has succeeded")
    return run_id


RUNS, LEASES = "runs", "leases"
LEASE = timedelta(days=1)
ABANDONED = timedelta(days=7)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class ExpiredRunError(LookupError):
    """The tables of a run were deleted before a lease on it was taken."""


@contextmanager
def leased(
    spark: SparkSession, root: str, run_id: str | None = None, length: timedelta = LEASE
) -> Iterator[str]:
    """Hold a run (the last that succeeded) while its tables are read; gives the run's id.

    The lease is taken first and the folder looked for after it, as ``retain`` looks for leases
    after it has chosen what to delete: either the reader sees that the run is gone, or the run
    stays.
    """
    run_id = run_id or latest_run(spark, root)
    until = _now() + length
    path = f"{root.rstrip('/')}/{LEASES}/{run_id}/{until:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    touch(spark, path)
    try:
        if run_id not in names_in(spark, f"{root.rstrip('/')}/{RUNS}"):
            raise ExpiredRunError(f"run {run_id} has been deleted")
        yield run_id
    finally:
        remove(spark, path)


def _held(spark: SparkSession, root: str, run_id: str, now: datetime) -> bool:
    """Whether a lease on a run has not ended yet."""
    names = names_in(spark, f"{root.rstrip('/')}/{LEASES}/{run_id}")
    return any(name.split("-")[0] > f"{now:%Y%m%dT%H%M%S%f}" for name in names)


def retain(
    spark: SparkSession, root: str, keep: int = 3, abandoned: timedelta = ABANDONED
) -> list[str]:
    """Delete the folders of runs that nobody needs; returns their ids.

    The last ``keep`` runs that succeeded stay, runs with a lease, and runs that are under way:
    those that have begun and not ended, unless that was longer than ``abandoned`` ago. The logs
    keep their rows. One row per run comes back to the driver. A folder is first moved aside, so
    no reader finds a run of which some tables are gone.
    """
    if keep < 1:
        raise ValueError("the last run must be kept")
    now = _now()
    states = {
        row["run_id"]: row
        for row in read_log(spark, root, RUN_LOG)
        .groupBy("run_id")
        .agg(
            F.max(F.when(F.col("status") == SUCCESS, F.col("finished_at"))).alias("succeeded"),
            F.max((F.col("status") != STARTED).cast("int")).alias("ended"),
            (F.min("started_at") > F.lit(now - abandoned)).alias("recent"),
        )
        .collect()
    }
    done = sorted((r for r in states.values() if r["succeeded"]), key=lambda r: r["succeeded"])
    needed = {row["run_id"] for row in done[-keep:]}
    needed |= {x for x, r in states.items() if not r["ended"] and r["recent"]}
    base = root.rstrip("/")
    gone = []
    for name in names_in(spark, f"{base}/{RUNS}"):
        if name.startswith(_ASIDE):
            remove(spark, f"{base}/{RUNS}/{name}")  # left by a cleaning that did not end
        elif name not in needed and not _held(spark, root, name, now):
            move(spark, f"{base}/{RUNS}/{name}", f"{base}/{RUNS}/{_ASIDE}{name}")
            if _held(spark, root, name, now):  # taken in between: its reader may have seen the run
                move(spark, f"{base}/{RUNS}/{_ASIDE}{name}", f"{base}/{RUNS}/{name}")
                continue
            remove(spark, f"{base}/{RUNS}/{_ASIDE}{name}")
            remove(spark, f"{base}/{LEASES}/{name}")
            gone.append(name)
    return sorted(gone)


_ASIDE = ".deleting-"


@dataclass(frozen=True)
class Run:
    """One refresh that is under way."""

    spark: SparkSession
    root: str
    name: str
    run_id: str
    started_at: datetime

    @classmethod
    def start(cls, spark: SparkSession, root: str, name: str) -> Run:
        now = datetime.now(timezone.utc)
        run = cls(spark, root, name, f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}", now)
        run._log(STARTED)
        return run

    @property
    def folder(self) -> str:
        return run_folder(self.root, self.run_id)

    def succeed(self) -> None:
        self._log(SUCCESS, datetime.now(timezone.utc))

    def fail(self, object_name: str, error: BaseException) -> None:
        """Keep a trace of the object that was being made and of what went wrong."""
        message = (str(error).splitlines() or [""])[0] or type(error).__name__
        failed = self.spark.range(1).select(
            F.lit(object_name.split(".")[0]).alias("layer_name"),
            F.lit(object_name).alias("object_name"),
            F.lit(0).cast("long").alias("row_count"),
            F.lit(FAILED).alias("status"),
        )
        self.log_loads(failed, message)
        self._log(FAILED, datetime.now(timezone.utc), message)

    def log_loads(self, counts: DataFrame, message: str | None = None) -> None:
        """Append row counts of objects (``layer_name, object_name, row_count, status``)."""
        counts.select(
            F.lit(self.run_id).alias("run_id"),
            "layer_name",
            "object_name",
            "row_count",
            "status",
            F.lit(message).cast("string").alias("message"),
            F.current_timestamp().alias("logged_at"),
        ).coalesce(1).write.mode("append").parquet(table_path(self.root, LOAD_LOG))

    def _log(
        self, status: str, finished_at: datetime | None = None, message: str | None = None
    ) -> None:
        self.spark.range(1, numPartitions=1).select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.name).alias("run_name"),
            F.lit(status).alias("status"),
            F.lit(self.started_at).cast("timestamp").alias("started_at"),
            F.lit(finished_at).cast("timestamp").alias("finished_at"),
            F.lit(message).cast("string").alias("message"),
        ).write.mode("append").parquet(table_path(self.root, RUN_LOG))
