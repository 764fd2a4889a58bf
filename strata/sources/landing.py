"""Landed file scans (S1, S2, S3) with schema conform over mixed files.

A single parquet scan over files that disagree on a column's physical type
(``double`` in one month, ``bigint`` in another) fails. Files are therefore
grouped by footer schema (one distributed job reads the footers), each group
is one scan, each scan is conformed to the declared schema, and the groups are
unioned by name. Files of one schema, the usual case, stay one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from strata.operators.conform import conform
from strata.sources.footers import group_by_schema


def read_leaf(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One month folder: its own columns only (no partition columns)."""
    return spark.read.format(fmt).load(path)


def read_root(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The whole dataset; ``key=value`` folders become columns and prune on filters."""
    return spark.read.format(fmt).load(root)


def read_conformed(
    spark: SparkSession,
    paths: Sequence[str],
    schema: Mapping[str, DataType] | StructType,
    fmt: str = "parquet",
    strict: bool = True,
    base_path: str | None = None,
    rejects: str | None = None,
    provenance: tuple[str, str] | None = None,
) -> DataFrame:
    """Read ``paths`` (files or folders), conform each schema group, union by name.

    ``rejects`` as in :func:`conform`; ``provenance`` names two columns to add:
    the file that a row came from, and the landed row itself as JSON.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("read_conformed: no paths")
    reader = spark.read.format(fmt)
    if base_path:
        reader = reader.option("basePath", base_path)
    groups = group_by_schema(spark, paths) if fmt == "parquet" else [paths]
    if not groups:  # folders without a data file
        raise FileNotFoundError(f"no {fmt} file under {paths[0]}" + (f" and {len(paths) - 1} others" if len(paths) > 1 else ""))

    def landed(group: list[str]) -> DataFrame:
        df = reader.load(group)
        if provenance is None:
            return df
        file, row = provenance
        return df.select("*", F.col("_metadata.file_path").alias(file), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(row))

    frames = [conform(landed(group), schema, strict=strict, rejects=rejects) for group in groups]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
