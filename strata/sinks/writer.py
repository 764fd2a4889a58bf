"""Table writes (K1-K7) and the logged write wrapper (K8).

Writes go through Spark's file committer: a failed or retried task leaves
no partial output behind. Partitioned writes are first clustered by the
partition columns so each task writes few folders (no small-file storm).
Whether an overwrite replaces the table or only the partitions it holds is an
option of each write, never a setting of the session.

An overwrite never works on the table's own files. The new version is written
in full beside the table (``_stage_<name>-<id>``), then one small pointer file
(``_swap_<name>``, put in place by a rename) names it: from that moment on it is
the table for everyone who reads through :func:`read_table`, and it is moved in
by renames (or, where a store cannot rename folders in one step, rewritten from
the staged copy). A job that dies before the pointer leaves the old table, one
that dies after it the new one; :func:`recover`, which every later write calls
first, finishes the move.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import runlog
from strata.operators.upsert import merge
from strata.session import scratch_path, shuffles_removed
from strata.sources.paths import beside, children, delete, move, path_exists, read_text, renames_at_once, table_exists, write_text

# The points of an overwrite at which ``on_step`` is told how far it has come.
STEPS = ("staged", "switched", "moved")
_NO_STEP = lambda step: None


@dataclass(frozen=True)
class Swap:
    """A staged version on its way into the table; what the pointer file holds.

    ``overwrite``: ``static`` replaces the table, ``dynamic`` the partitions that are
    staged and those in ``remove``, ``files`` the files in ``remove``. ``remove`` is relative to the table.
    """

    staged: str
    parts: list[str]
    fmt: str
    overwrite: str
    remove: list[str] = field(default_factory=list)


def _cols(partition_cols: str | Sequence[str] | None) -> list[str]:
    if partition_cols is None:
        return []
    return [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)


def write(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_cols: str | Sequence[str] | None = None,
    fmt: str = "parquet",
    cluster: bool = True,
    on_step: Callable[[str], None] = _NO_STEP,
) -> None:
    """Write ``df`` in ``fmt`` with ``mode``; partitioned when columns are given.

    ``overwrite`` replaces the whole table, whatever the session's partition
    overwrite mode: partitions that ``df`` lacks are gone afterwards, and ``df``
    may read the table that it replaces. With ``cluster`` a partitioned write is first rebalanced by the
    partition columns: AQE merges small partitions and splits a hot one
    (a day holding a third of the rows is written by several tasks), so a
    day lands in a few files instead of one file per task per day. ``on_step``
    is told of each of :data:`STEPS` of an overwrite.
    """
    if mode == "overwrite":
        _replace(df, path, _cols(partition_cols), fmt, "static", cluster, on_step=on_step)
    else:
        _save(df, path, mode, _cols(partition_cols), fmt, "static", cluster)


def _save(df: DataFrame | Swap, path: str, mode: str, parts: list[str], fmt: str, overwrite: str, cluster: bool = True) -> None:
    """Write rows to ``path``, or move a staged version in."""
    if isinstance(df, Swap):
        _move_in(SparkSession.active(), df, path)
        return
    w = (df.hint("rebalance", *parts) if parts and cluster else df).write.format(fmt).mode(mode)
    if parts:
        w = w.partitionBy(*parts).option("partitionOverwriteMode", overwrite)
    with shuffles_removed(df.sparkSession):
        w.save(path)


def _replace(df: DataFrame, path: str, parts: list[str], fmt: str, overwrite: str, cluster: bool = True,
             remove: Sequence[str] = (), on_step: Callable[[str], None] = _NO_STEP) -> None:
    spark = df.sparkSession
    staged = f"{beside(path, 'stage')}-{uuid.uuid4().hex}"
    _save(df, staged, "overwrite", parts, fmt, "static", cluster)
    on_step("staged")
    recover(spark, path)  # only now: ``df`` may read a version that is on its way
    _swap(spark, Swap(staged, parts, fmt, overwrite, list(remove)), path, on_step)


def replace_files(df: DataFrame, path: str, parts: Sequence[str], names: Sequence[str]) -> None:
    """Put ``df`` in the place of the files ``names`` (relative to the table); all other files stay."""
    _replace(df, path, list(parts), "parquet", "files", remove=names)


def append_files(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    """Append a few files to the table at ``path``, safely beside appends of other drivers.

    A writer that dies on the way leaves what it had already renamed, so rows
    must be such that a part of them, or the same ones again, do no harm.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    staged = f"{beside(path, 'stage')}-{uuid.uuid4().hex}"
    _save(df, staged, "overwrite", list(parts), "parquet", "static", cluster=False)
    for folder in _leaves(spark, staged, len(parts)):
        for name in children(spark, f"{staged}/{folder}"):
            inside = f"{folder}/{name}" if folder else name
            move(spark, f"{staged}/{inside}", f"{path}/{inside}")
    delete(spark, staged)


def _swap(spark: SparkSession, new: Swap, path: str, on_step: Callable[[str], None] = _NO_STEP) -> None:
    """Switch the pointer to the staged version, then move it in; the pointer stands until that is done."""
    write_text(spark, beside(path, "swap"), json.dumps(asdict(new)))
    on_step("switched")
    _save(new, path, "overwrite", new.parts, new.fmt, new.overwrite)
    on_step("moved")
    delete(spark, beside(path, "swap"))
    delete(spark, new.staged)


def _leaves(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``root``, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{c}" if f else c for f in found for c in children(spark, f"{root}/{f}" if f else root)]
    return found


def _move_in(spark: SparkSession, new: Swap, path: str) -> None:
    """Put the staged version in place. May be run again from any point at which it was cut off."""
    path = path.rstrip("/")
    there = path_exists(spark, new.staged)
    if new.overwrite == "files":
        for folder in _leaves(spark, new.staged, len(new.parts)) if there else []:
            for name in children(spark, f"{new.staged}/{folder}"):
                inside = f"{folder}/{name}" if folder else name
                move(spark, f"{new.staged}/{inside}", f"{path}/{inside}")
    elif there and not renames_at_once(spark, path):
        w = spark.read.format(new.fmt).load(new.staged).write.format(new.fmt).mode("overwrite")
        (w.partitionBy(*new.parts).option("partitionOverwriteMode", new.overwrite) if new.parts else w).save(path)
    elif there and new.overwrite == "dynamic":
        for folder in _leaves(spark, new.staged, len(new.parts)):
            move(spark, f"{new.staged}/{folder}", f"{path}/{folder}")
    elif there:
        move(spark, new.staged, path)
    for gone in new.remove:
        delete(spark, f"{path}/{gone}")


def pointer(spark: SparkSession, path: str) -> Swap | None:
    """The version on its way into the table at ``path``, if a write is at that point (or was cut off there)."""
    text = read_text(spark, beside(path, "swap"))
    return None if text is None else Swap(**json.loads(text))


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a swap of the table at ``path`` that was cut off; whether there was one.

    The staged rows hold all of what is replaced, so moving them in again is
    right however far the swap had come.
    """
    new = pointer(spark, path)
    if new is None:
        return False
    _swap(spark, new, path)
    return True


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``, in place or on its way."""
    return pointer(spark, path) is not None or table_exists(spark, path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """The table's current version, also while a new one is being moved in or after its writer died."""
    new, path = pointer(spark, path), path.rstrip("/")

    def reader():
        r = spark.read.format(fmt)
        return r if schema is None else r.schema(schema)

    if new is None or not path_exists(spark, new.staged):
        return reader().load(path)
    if new.overwrite == "static" or not path_exists(spark, path):
        return reader().load(new.staged)
    # what of the new version has not moved yet, and what it leaves alone. In this order: a
    # file that moves between the two listings is in both, and reading it fails; it is not in neither
    left = any(children(spark, f"{new.staged}/{f}") for f in _leaves(spark, new.staged, len(new.parts)))
    fresh = reader().load(new.staged) if left else None
    if new.overwrite == "files":
        gone = F.lit(False)
        for name in new.remove:
            gone = gone | F.endswith(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), F.lit(f"/{name}"))
        kept = reader().load(path).where(~gone)
    else:
        replaced = {*_leaves(spark, new.staged, len(new.parts)), *new.remove}
        folders = [f"{path}/{f}" for f in _leaves(spark, path, len(new.parts)) if f not in replaced]
        kept = reader().option("basePath", path).load(folders) if folders else None
    both = [t for t in (kept, fresh) if t is not None]
    return both[0] if len(both) == 1 else both[0].unionByName(both[1], allowMissingColumns=True)


def leftovers(spark: SparkSession, path: str) -> list[str]:
    """Staged folders of writes to ``path`` that died before their pointer was set; safe to delete when no write is running."""
    folder, _, name = path.rstrip("/").rpartition("/")
    new = pointer(spark, path)
    return [f"{folder}/{c}" for c in children(spark, folder, hidden=True)
            if c.startswith(f"_stage_{name}-") and (new is None or f"{folder}/{c}" != new.staged)]


def replace_partitions(df: DataFrame, path: str, partition_cols: str | Sequence[str], fmt: str = "parquet",
                       emptied: Sequence[str] = (), on_step: Callable[[str], None] = _NO_STEP, cluster: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (re-running a month is idempotent).

    ``emptied`` names partition folders (``day=2024-01-01``) that hold no row any
    more: those that ``df`` lacks as well are removed in the same step.
    """
    parts, spark = _cols(partition_cols), df.sparkSession
    staged = f"{beside(path, 'stage')}-{uuid.uuid4().hex}"
    _save(df, staged, "overwrite", parts, fmt, "static", cluster)
    on_step("staged")
    recover(spark, path)
    there = set(_leaves(spark, staged, len(parts))) if emptied else set()
    _swap(spark, Swap(staged, parts, fmt, "dynamic", [e for e in emptied if e not in there]), path, on_step)


def stage_path(df: DataFrame, name: str = "stage", fmt: str = "parquet") -> str:
    """Write ``df`` under the shared checkpoint folder; where."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_removed(df.sparkSession):
        df.write.format(fmt).mode("overwrite").save(path)
    return path


def stage(df: DataFrame, name: str = "stage", fmt: str = "parquet") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor later costs a re-read, not a rerun of
    the whole upstream plan. The folder is the cluster's
    ``spark.checkpoint.dir``, visible to all executors.
    """
    return df.sparkSession.read.format(fmt).load(stage_path(df, name, fmt))


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_cols: str | Sequence[str] | None = None,
    fmt: str = "parquet",
    on_step: Callable[[str], None] = _NO_STEP,
) -> DataFrame | None:
    """Merge ``source`` into the table at ``path`` on ``keys`` (update all / insert all).

    ``source`` is evaluated once (staged). Only files that hold a row with one
    of its keys are read in full and replaced; they are found by a pass over the
    key columns, of the partitions that the source names if the partition
    columns are keys. All other files keep their names. A source with new
    columns rewrites the table, so that its files agree. A table that cannot be
    read raises; only one that does not exist is created.

    Returns the distinct values of the partition columns whose partitions
    changed (None without partition columns).
    """
    parts = _cols(partition_cols)
    recover(spark, path)
    source = stage(source, "upsert-source", fmt)
    if not table_exists(spark, path):
        write(source, path, "overwrite", parts, fmt)
        return source.select(*parts).distinct() if parts else None
    keyed = parts and set(parts) <= set(keys)
    target = _touched(spark, path, parts, source, fmt) if keyed else spark.read.format(fmt).load(path)
    files = _files_with(target, source, keys)
    whole = set(source.columns) - set(target.columns) or any(set(f) & _GLOB for f in files)
    if whole:
        old = spark.read.format(fmt).load(path)
        changed = _changed(old, source, keys, parts)
        _replace(merge(old, source, keys), path, parts, fmt, "static", on_step=on_step)
        return changed
    old = spark.read.format(fmt).schema(target.schema).option("basePath", path).load(files) if files else target.limit(0)
    changed = None if not parts else source.select(*parts).distinct() if keyed else _changed(old, source, keys, parts)
    base = _plain(spark, path)
    _replace(merge(old, source, keys), path, parts, fmt, "files", remove=[f[len(base) + 1:] for f in files], on_step=on_step)
    return changed


def _plain(spark: SparkSession, path: str) -> str:
    """``path`` as Spark names it in ``_metadata.file_path``, unescaped."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return unquote(p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()).replace("file:///", "file:/")


def _files_with(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files of ``target`` that hold a row with a key of ``source`` (a name a file; only key columns are read)."""
    wanted = source.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys]).distinct()
    held = target.select(*keys, F.col("_metadata.file_path").alias("__file")).join(wanted, list(keys), "left_semi")
    return sorted(unquote(r[0]).replace("file:///", "file:/") for r in held.select("__file").distinct().collect())


def _changed(old: DataFrame, source: DataFrame, keys: Sequence[str], parts: list[str]) -> DataFrame | None:
    """Partition values of source rows and of the rows that they replace; written down, for the table is about to change."""
    if not parts:
        return None
    replaced = old.join(source.select(*keys).distinct(), list(keys), "left_semi").select(*parts)
    same = source.select(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in parts])
    return stage(replaced.unionByName(same).distinct(), "upsert-changed")


_GLOB = set("{}[]*?\\")
_GLOB_SPECIAL = set("{}[]*?\\,/=%:#\"' ")


def _touched(spark: SparkSession, path: str, parts: list[str], source: DataFrame, fmt: str) -> DataFrame:
    """Rows of the target's partitions that ``source`` touches.

    One partition column with plain values: only the folders named by the
    source are listed (a glob of those that exist). Otherwise a semi join on
    the partition columns, which prunes at run time.
    """
    values = source.select(*parts).distinct()
    if len(parts) == 1:
        # at most one row for each partition folder of the source
        texts = [r[0] for r in values.select(F.col(parts[0]).cast("string")).collect()]
        if texts and not any(t is None or set(t) & _GLOB_SPECIAL for t in texts):
            there = {n.partition("=")[2] for n in children(spark, path)}
            known = sorted(there & set(texts))
            if not known:
                return spark.read.format(fmt).load(path).limit(0)
            return (spark.read.format(fmt).option("basePath", path)
                    .load(f"{path.rstrip('/')}/{parts[0]}={{{','.join(known)}}}"))
    table, same = spark.read.format(fmt).load(path), None
    for c in parts:
        e = table[c].eqNullSafe(values[c])
        same = e if same is None else same & e
    return table.join(values, same, "left_semi")


def logged(
    spark: SparkSession,
    log_path: str,
    action: Callable[[], None],
    *,
    file_name: str,
    source: str,
    destination: str,
    load_type: str,
    layer: str,
    on_error: str = "raise",
) -> bool:
    """Run ``action`` between UPLOADING and SUCCESS/FAILED log rows.

    A failure is logged with its message and then re-raised, unless
    ``on_error="continue"``. Returns whether the action succeeded.
    """
    base = dict(file_name=file_name, source=source, destination=destination, load_type=load_type, layer=layer)
    runlog.record(spark, log_path, status=runlog.UPLOADING, **base)
    try:
        action()
    except Exception as e:  # noqa: BLE001 - logged, then re-raised by default
        runlog.record(spark, log_path, status=runlog.FAILED, error=str(e), **base)
        if on_error == "raise":
            raise
        return False
    runlog.record(spark, log_path, status=runlog.SUCCESS, **base)
    return True
