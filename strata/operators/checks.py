"""Data checks (A8, C13): counts, and content by order-free checksums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.identity import row_hash

SAME, LOST, EXTRA, CHANGED = "same", "lost", "extra", "changed"


def row_count_check(source: DataFrame, target: DataFrame, name: str = "row_count") -> DataFrame:
    """One row: source and target row counts and whether ``source >= target``.

    Filters and dedup only remove rows, so a target larger than its source
    means duplication downstream. Each side is a partial + final count; the
    two one-row results meet in a final aggregate (no join).
    """
    s = source.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("source"))
    t = target.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("target"))
    both = s.unionByName(t)
    src_n = F.sum(F.when(F.col("side") == "source", F.col("n")))
    tgt_n = F.sum(F.when(F.col("side") == "target", F.col("n")))
    return both.agg(
        F.lit(name).alias("check_name"),
        src_n.alias("source_rows"),
        tgt_n.alias("target_rows"),
        (src_n >= tgt_n).alias("passed"),
    )


def _print(df: DataFrame, columns: Sequence[str]) -> Column:
    """60 bits of the row's SHA-256 as a number."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.conv(F.substring(row_hash(columns, null_token="\\N", types=types), 1, 15), 16, 10).cast("decimal(38,0)")


def content_sums(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per value of ``by``: ``n_rows`` and ``checksum``, the sum of its rows' hashes.

    A sum knows no order and counts copies, so equal multisets have equal sums
    however they are partitioned; partial sums are made before the shuffle, a row a task and group.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(_print(df, columns)).alias("checksum"))


def reconcile(source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Whether ``target`` holds the rows of ``source``, group by group of ``by``.

    ``status``: same, lost (fewer rows), extra (more rows) or changed (as many,
    but others: a lost row that another one hides). Groups of either side appear;
    a null group is a group. :func:`differing_rows` names the rows.
    """
    sides = [content_sums(d, by, columns).select(*by, F.lit(i).alias("__side"), "n_rows", "checksum") for i, d in enumerate((source, target))]
    both = sides[0].unionByName(sides[1])
    of = lambda side, c: F.coalesce(F.sum(F.when(F.col("__side") == side, F.col(c))), F.lit(0))
    s_n, t_n = F.col("source_rows"), F.col("target_rows")
    equal = F.col("__source") == F.col("__target")
    return (both.groupBy(*by).agg(of(0, "n_rows").alias("source_rows"), of(1, "n_rows").alias("target_rows"), of(0, "checksum").alias("__source"), of(1, "checksum").alias("__target"))
            .withColumn("status", F.when(t_n < s_n, LOST).when(t_n > s_n, EXTRA).when(equal, SAME).otherwise(CHANGED))
            .select(*by, "source_rows", "target_rows", "status"))


def differing_rows(source: DataFrame, target: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows behind :func:`reconcile`: ``columns``, and ``surplus``: how many more of them the target has (negative: lacks).

    Only groups that differ are compared row by row.
    """
    odd = reconcile(source, target, by, columns).where(F.col("status") != SAME).select(*[F.col(c).alias(f"__{c}") for c in by])
    keep = list(dict.fromkeys([*by, *columns]))

    def of(df: DataFrame, sign: int) -> DataFrame:
        same = None
        for c in by:
            e = F.col(c).eqNullSafe(F.col(f"__{c}"))
            same = e if same is None else same & e
        rows = df.select(*keep).join(odd, same, "left_semi")
        return rows.groupBy(*keep).agg((F.count(F.lit(1)) * sign).alias("n"))

    return of(source, -1).unionByName(of(target, 1)).groupBy(*keep).agg(F.sum("n").alias("surplus")).where("surplus <> 0")
