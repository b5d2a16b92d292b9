"""Session settings that the layers are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime plans: merge small shuffle partitions, split large ones, rebalance writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A table stored by a few routes is written without sorting it by route.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Wall-clock times have no zone; load stamps are kept in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Building a plan from Python asks the driver for a stack trace per column otherwise.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# For a cluster: larger splits mean fewer tasks that each send a set of partial sums, and
# many first shuffle partitions that adaptive execution merges down to the advisory size.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
}


def chosen_settings(master: str, given: set[str]) -> dict[str, str]:
    """Settings to apply to a session: those of a cluster unless all tasks run on this
    machine, and none that the user has ``given``."""
    alone = master == "local" or master.startswith("local[")
    settings = SETTINGS if alone else CLUSTER_SETTINGS
    return {key: value for key, value in settings.items() if key not in given}


def apply_settings(spark: SparkSession) -> None:
    context = spark.sparkContext
    given = {key for key, _ in context.getConf().getAll()}
    for key, value in chosen_settings(context.master, given).items():
        spark.conf.set(key, value)


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wayfare")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
