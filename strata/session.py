"""Spark session settings shared by every job.

The settings are the ones the operators rely on for repeatable results:
UTC session zone (date functions), ANSI mode (strict casts), adaptive
query execution (runtime partition coalescing, skew-join splitting and
broadcast promotion). Nothing here hard-codes cluster sizing; those values come from the launch
configuration. One worth setting on a single machine when tables have
thousands of partition folders is
``spark.sql.sources.parallelPartitionDiscovery.parallelism`` (the number of
tasks that list folders, 10000 by default): a few per core.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job needs for the semantics of the operators.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


# A join whose one side is selected by a filter drops the other side's rows by a Bloom filter of its keys
# before the shuffle: at most 4 million keys are told apart (4 MB); with more it lets rows through.
RUNTIME_FILTER_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "8MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "33554432",
}

# Shuffle files of a finished query are deleted at once; else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# A task that meets at most so many partitions writes to all of them at a time, instead of sorting its rows (and spilling them) first.
OPEN_PARTITIONS_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "8"}


def get_spark(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if the session has none.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; that setting is always honoured. Only a local session without it
    gets a fresh scratch folder; any other master without it is an error,
    since each executor would write to its own disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master!r} share")
        current = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name)


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def runtime_filters(spark: SparkSession):
    """Run the queries inside with ``RUNTIME_FILTER_CONF``; the session's settings are put back."""
    return _settings(spark, RUNTIME_FILTER_CONF)


def shuffles_removed(spark: SparkSession):
    """Run the queries inside with ``SHUFFLE_CLEANUP_CONF``; the session's settings are put back.

    For queries whose result is written or collected once: run again, they shuffle anew.
    """
    return _settings(spark, SHUFFLE_CLEANUP_CONF)


def partitions_kept_open(spark: SparkSession):
    """Run the writes inside with ``OPEN_PARTITIONS_CONF``, for rows that already lie by partition; the session's settings are put back."""
    return _settings(spark, OPEN_PARTITIONS_CONF)
