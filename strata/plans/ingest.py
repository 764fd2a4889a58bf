"""Bronze ingest over a month range (C1: S9 -> S10 -> S11 -> S1 -> P1 -> K3 -> K8).

One Spark job for all pending months instead of one job per month: the
month list is a DataFrame, already-loaded months drop out by an anti join
with the load log, the pending folders are read together (grouped only by
physical schema), conformed, and written with dynamic partition overwrite,
so re-running a month replaces exactly that month.

Rows that hold a value which does not fit its declared type can be set aside
(``rejects``) instead of failing their month. What came in, went out and was
lost is counted by the pass that writes the rows (``counts``), and months can
be claimed (``claims``), so that two drivers never load one at the same time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from strata.operators import claims as claiming
from strata.operators import runlog
from strata.operators.broadcast import estimated_bytes
from strata.sinks.writer import append_files, replace_partitions
from strata.sources.landing import read_conformed
from strata.sources.months import with_source_names
from strata.sources.paths import delete, path_exists


# Columns that exist only between reading and writing.
_LOST, _FILE, _ROW = "_rejected_values", "_rejected_file", "_rejected_row"
# Landed folders of at most so many files, or of files of at least so many bytes, are written as they are read.
FILES_PER_FOLDER, SMALL_FILE = 4, 8 << 20
COUNTS_SCHEMA = "load_id long, item string, metric string, rows long"


def plan_months(months: DataFrame, source_name: str, landing: str, target: str, log: DataFrame | None) -> DataFrame:
    """Per pending month: file name, landed folder, target folder."""
    named = with_source_names(months, source_name, landing, target)
    return named if log is None else runlog.pending(named, log)


def _names(schema: Mapping[str, DataType] | StructType) -> list[str]:
    return schema.fieldNames() if isinstance(schema, StructType) else list(schema)


def _scattered(df: DataFrame, folders: int) -> bool:
    """Whether ``df`` is read from many small files, which a write should gather.

    A landed file belongs to one month, so a write that moves no rows makes at
    most one file of each part of a file that a task reads.
    """
    n = len(df.inputFiles())
    return n > FILES_PER_FOLDER * folders and estimated_bytes(df) < n * SMALL_FILE


def ingest(
    spark: SparkSession,
    months: DataFrame,
    landing: str,
    target: str,
    schema: Mapping[str, DataType],
    log_path: str,
    source_name: str,
    landed_path=lambda root, ym: f"{root.rstrip('/')}/year_month={ym}",
    strict: bool = True,
    rejects: str | None = None,
    counts: str | None = None,
    claims: str | None = None,
    claim_seconds: float = 6 * 3600,
) -> list[str]:
    """Ingest every pending month of ``months``; return the months loaded.

    Every month is logged with its own landed folder and target folder,
    UPLOADING before anything is read. Months that are not there are FAILED,
    and stay pending, without holding up the others. If the job over all
    others fails, they are loaded one by one, so that a bad month fails alone
    (its whole error text is logged); an error never takes a loaded month back.

    ``rejects`` names a table for rows with a value that its column's type cannot
    hold: only the others reach ``target``, and each rejected row is kept with the
    file it came from, the values that were lost (column, value as text) and the
    landed row as JSON; rows kept and rows rejected add up to the rows landed, and
    loading a month again replaces its rejects. Landed files are read again only
    for months that the writing pass found rejected rows in. Column names that
    start with ``_rejected_`` are not available to landed files then.

    ``counts`` names a table of (load_id, item, metric, rows): rows_in, rows_out
    and rejected for each month loaded, and cast_failed for each declared column
    (with ``strict`` casts a failure ends the load, so there are none). They come
    from the writing pass itself, after its shuffle, so a task that runs again is
    counted once.

    ``claims`` names a folder in which months are claimed for ``claim_seconds``
    before they are read; months claimed by others are left to them, and a load
    whose claim was lost on the way stops before it replaces anything. Drivers
    read and stage at the same time and take turns in changing the tables.

    The pending list is metadata (one row a month) and is collected to name
    the folders to read; the data itself never passes through the driver.
    """
    def still_to_do() -> dict:
        log = runlog.read_log(spark, log_path, "bronze") if path_exists(spark, log_path) else None
        return {r["year_month"]: r for r in plan_months(months, source_name, landing, target, log).orderBy("year_month").collect()}

    todo, held = still_to_do(), []
    if todo and claims is not None:
        held = claiming.take(spark, claims, [r["file_name"] for r in todo.values()], claim_seconds)
        mine = {c.name for c in held}
        # another driver may have loaded a month and given it up between the look at the log and the claim
        todo = {ym: r for ym, r in still_to_do().items() if r["file_name"] in mine} if mine else {}
    try:
        return _load_all(spark, todo, landing, target, schema, log_path, landed_path, strict, rejects, counts, claims, claim_seconds, held) if todo else []
    finally:
        if held:
            claiming.release(spark, claims, held)


def _load_all(spark, todo, landing, target, schema, log_path, landed_path, strict, rejects, counts, claims, claim_seconds, held) -> list[str]:
    """Load the months of ``todo`` (claimed, if months are claimed)."""
    def note(yms: list[str], status: str, error: str | None = None) -> None:
        if yms:
            runlog.append_log(runlog.log_rows(spark, [
                dict(file_name=todo[ym]["file_name"], source=landed_path(landing, ym), layer="bronze", load_type="overwrite",
                     destination=f"{target.rstrip('/')}/year={todo[ym]['year']}/month={todo[ym]['month']}/", status=status, error=error)
                for ym in yms]), log_path)

    locks: list[claiming.Claim] = []

    def check(step: str) -> None:
        """Before the tables change: one driver at a time, and only with its claims."""
        if held and step == "staged":
            locks.append(claiming.wait_for(spark, claims, "tables", claim_seconds))
            gone = claiming.lost(spark, claims, held)
            if gone:
                raise claiming.ClaimLost(f"claims lost before the write: {', '.join(gone)}")

    counted = counts is not None or rejects is not None
    tracked = rejects is not None or (counted and not strict)

    def read(yms: list[str], **how) -> DataFrame:
        return read_conformed(spark, [landed_path(landing, ym) for ym in yms], schema, strict=strict and rejects is None,
                              base_path=landing, rejects=_LOST if tracked else None, **how)

    def load(yms: list[str]) -> None:
        try:
            _load(yms)
        finally:
            if locks:
                claiming.release(spark, claims, [locks.pop()])

    def _load(yms: list[str]) -> None:
        parts, seen = F.split("year_month", "-"), Observation()
        df = read(yms).withColumn("year", parts[0].cast("int")).withColumn("month", parts[1].cast("int"))
        lost = F.size(_LOST) > 0 if tracked else F.lit(False)
        if counted:
            month = lambda ym: F.col("year_month").cast("string") == ym
            measures = [F.count_if(month(ym)).alias(f"rows_in {ym}") for ym in yms] + [F.count_if(month(ym) & lost).alias(f"lossy {ym}") for ym in yms]
            if tracked:
                measures += [F.count_if(F.array_contains(F.col(f"{_LOST}.column"), c)).alias(f"cast_failed {c}") for c in _names(schema)]
            # counted behind the shuffle of the write, in the tasks that write
            df = df.hint("rebalance", "year", "month").observe(seen, *measures)
        kept = (df.where(~lost) if rejects is not None else df).drop("year_month", _LOST)
        folder = lambda ym: f"year={todo[ym]['year']}/month={todo[ym]['month']}"
        replace_partitions(kept, target, ["year", "month"], emptied=[folder(ym) for ym in yms] if rejects is not None else (),
                           on_step=check, cluster=not counted and _scattered(df, len(yms)))
        found = seen.get if counted else {}
        if rejects is not None:
            set_aside([ym for ym in yms if found[f"lossy {ym}"]], [folder(ym) for ym in yms])
        if counts is not None:
            write_counts(yms, found)

    def set_aside(yms: list[str], folders: list[str]) -> None:
        """Replace the rejects of the months loaded; only months with rejected rows are read again."""
        if yms:
            bad = read(yms, provenance=(_FILE, _ROW)).where(F.size(_LOST) > 0)
            parts = F.split("year_month", "-")
            bad = bad.select(F.col(_FILE).alias("source_file"), F.col(_LOST).alias("rejected"), F.col(_ROW).alias("landed_row"),
                             parts[0].cast("int").alias("year"), parts[1].cast("int").alias("month"))
            replace_partitions(bad, rejects, ["year", "month"], emptied=folders)
        elif path_exists(spark, rejects):
            for f in folders:
                delete(spark, f"{rejects.rstrip('/')}/{f}")

    def write_counts(yms: list[str], found: dict) -> None:
        load_id, rows = runlog.next_id(), []
        for ym in yms:
            rejected = found[f"lossy {ym}"] if rejects is not None else 0
            item, rows_in = todo[ym]["file_name"], found[f"rows_in {ym}"]
            rows += [(load_id, item, "rows_in", rows_in), (load_id, item, "rows_out", rows_in - rejected), (load_id, item, "rejected", rejected)]
        rows += [(load_id, c, "cast_failed", found.get(f"cast_failed {c}", 0)) for c in _names(schema)]
        append_files(spark.createDataFrame(rows, COUNTS_SCHEMA).coalesce(1), counts)

    note(list(todo), runlog.UPLOADING)
    there = [ym for ym in todo if path_exists(spark, landed_path(landing, ym))]
    for ym in todo:
        if ym not in there:
            note([ym], runlog.FAILED, f"nothing landed at {landed_path(landing, ym)}")
    try:
        if there:
            load(there)
    except claiming.ClaimLost as e:
        note(there, runlog.FAILED, str(e))
        raise
    except Exception:  # noqa: BLE001 - each month for itself; its error is logged below
        loaded = []
        for ym in there:
            try:
                load([ym])
            except claiming.ClaimLost as e:
                note([ym], runlog.FAILED, str(e))
                raise
            except Exception as e:  # noqa: BLE001
                note([ym], runlog.FAILED, str(e))
            else:
                loaded.append(ym)
                note([ym], runlog.SUCCESS)
        return loaded
    note(there, runlog.SUCCESS)
    return there
