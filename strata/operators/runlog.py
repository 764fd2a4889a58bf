"""Load log (K8, K9) and the queries on it.

The log is an append-only table: one small file per recorded batch, each
row one status change of one load (UPLOADING, SUCCESS, FAILED). It holds run
metadata, a few rows per load, never data.

Once a layer has more than :data:`SNAPSHOT_FILES` appended files, the append that
sees it merges all files there are into a snapshot, so a read opens a bounded
number of small files however long the log grows. A merge replaces exactly the
files that it has read: what other drivers append meanwhile stays. One driver at
a time merges (a claim beside the log).
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from strata.operators import claims
from strata.sources.paths import beside, children, read_text, write_text

# Status words and layer names of the load log.
UPLOADING, SUCCESS, FAILED = "UPLOADING", "SUCCESS", "FAILED"
LAYERS = ("bronze", "silver", "gold")
FAULTY = "faulty"
NO_ERROR = "None"

LOG_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("file_name", StringType(), False),
    StructField("source", StringType(), False),
    StructField("destination", StringType(), False),
    StructField("status", StringType(), False),
    StructField("load_type", StringType(), False),
    StructField("processed_at", TimestampType(), True),
    StructField("error", StringType(), True),
    StructField("layer", StringType(), False),
])

# Appended files of a layer that are left unmerged.
SNAPSHOT_FILES = 32
# For how long nobody else merges after a driver died doing so.
MERGE_SECONDS = 3600.0

_seq = itertools.count()


def layer_of(name: str | Column) -> Column:
    """Route a layer name to its log partition; unknown names go to ``faulty``."""
    c = F.lower(F.col(name) if isinstance(name, str) else name)
    return F.when(c.isin(*LAYERS), c).otherwise(F.lit(FAULTY))


def _layer_py(layer: str) -> str:
    return layer.lower() if layer and layer.lower() in LAYERS else FAULTY


def next_id() -> int:
    """Increasing id: microseconds since the epoch, then a per-process counter."""
    return time.time_ns() // 1000 * 1000 + next(_seq) % 1000


def log_rows(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """Log rows from driver-side status records (a handful per load)."""
    rows = []
    for r in records:
        rows.append((
            int(r.get("id") or next_id()), r["file_name"], r["source"], r["destination"], r["status"],
            r["load_type"], r.get("processed_at") or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            str(r.get("error") if r.get("error") is not None else NO_ERROR), _layer_py(r.get("layer", "")),
        ))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def append_log(rows: DataFrame, log_path: str, snapshot_files: int | None = None) -> None:
    """Append log rows, partitioned by layer (one table, one folder a layer).

    Rows are gathered by layer; AQE makes one file of a few rows and splits a
    layer that is large. The files are written beside the log and then renamed
    into it: appends of several drivers do not share the committer's folder,
    which the first one to end would remove. A layer with more than
    ``snapshot_files`` (:data:`SNAPSHOT_FILES`) appended files has the log merged.
    """
    from strata.sinks.writer import append_files

    spark, limit = rows.sparkSession, SNAPSHOT_FILES if snapshot_files is None else snapshot_files
    append_files(rows.hint("rebalance", "layer"), log_path, ["layer"])
    appended: dict[str, int] = {}
    for name in set(_files(spark, log_path)) - _snapshot(spark, log_path):
        layer = name.partition("/")[0]
        appended[layer] = appended.get(layer, 0) + 1
    if max(appended.values(), default=0) > limit:
        compact_log(spark, log_path)


def _files(spark: SparkSession, log_path: str) -> list[str]:
    """The log's files, relative to it: a listing a layer."""
    return [f"{layer}/{name}" for layer in children(spark, log_path) for name in children(spark, f"{log_path.rstrip('/')}/{layer}")]


def _snapshot(spark: SparkSession, log_path: str) -> set[str]:
    """The files that there were after the last merge."""
    return set(json.loads(read_text(spark, beside(log_path, "snapshot")) or "[]"))


def record(spark: SparkSession, log_path: str, **fields) -> None:
    append_log(log_rows(spark, [fields]), log_path)


def read_log(spark: SparkSession, log_path: str, layer: str | None = None) -> DataFrame:
    """The log, optionally one layer (a partition filter).

    A row that a retried writer appended again (same id, status and file), or that
    is there both merged and not, counts once. A read that a merge overtakes fails for want of
    the files replaced, it never misses rows.
    """
    from strata.sinks.writer import read_table

    df = read_table(spark, log_path, schema=LOG_SCHEMA).dropDuplicates(["id", "status", "file_name"])
    return df if layer is None else df.where(F.col("layer") == _layer_py(layer))


def compact_log(spark: SparkSession, log_path: str) -> bool:
    """Merge the log's files into a few per layer; False if another driver is doing so.

    The files there are now are read, written merged beside the log, and replaced in one step
    (:mod:`strata.sinks.writer`): a crash leaves the old files or the merged ones for every
    reader of :func:`read_log`, and the next merge finishes the move. Files appended meanwhile are left alone.
    """
    from strata.sinks.writer import recover, replace_files

    folder = beside(log_path, "claims")
    held = claims.take(spark, folder, ["merge"], MERGE_SECONDS)
    if not held:
        return False
    try:
        recover(spark, log_path)
        names = _files(spark, log_path)
        if names:
            root = log_path.rstrip("/")
            rows = spark.read.schema(LOG_SCHEMA).option("basePath", root).parquet(*[f"{root}/{n}" for n in names])
            replace_files(rows.dropDuplicates(["id", "status", "file_name"]), log_path, ["layer"], names)
            write_text(spark, beside(log_path, "snapshot"), json.dumps(_files(spark, log_path)))
    finally:
        claims.release(spark, folder, held)
    return True


def successful(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == SUCCESS)


def pending(items: DataFrame, log: DataFrame, on: str = "file_name") -> DataFrame:
    """Items whose ``on`` value has no SUCCESS row in the log (idempotent ingest)."""
    done = successful(log).select(on).distinct()
    return items.join(done, on=on, how="left_anti")


def is_loaded(log: DataFrame, file_name: str) -> bool:
    """Whether ``file_name`` has a SUCCESS row."""
    return successful(log).where(F.col("file_name") == F.lit(file_name)).limit(1).count() > 0


def successful_destinations(log: DataFrame, pattern: str) -> DataFrame:
    """Distinct destinations of successful loads whose file name contains ``pattern``.

    ``pattern`` is literal text (``_`` and ``%`` are not wildcards).
    """
    return (successful(log).where(F.col("file_name").contains(F.lit(pattern)))
            .select("destination").distinct())


def latest_destinations(log: DataFrame, n: int, pattern: str) -> DataFrame:
    """Distinct destinations among the ``n`` latest successful loads matching ``pattern``.

    The ``n`` latest loads are taken first and de-duplicated after, so fewer
    than ``n`` destinations can come back. Ties on time break by ``id``.
    Spark plans the ranked filter as a top-k, not a global sort.
    """
    w = Window.orderBy(F.col("processed_at").desc(), F.col("id").desc())
    return (successful(log).where(F.col("file_name").contains(F.lit(pattern)))
            .withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= n)
            .select("destination").distinct())
