"""Partition folders of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NULL = "__HIVE_DEFAULT_PARTITION__"


def _value(folder: Column, key: str) -> Column:
    """The value that ``key=...`` stands for: unescaped, the null folder as null."""
    raw = F.regexp_extract(folder, rf"(?:^|/){key}=([^/]*)", 1)
    # Spark escapes special characters as %XX; a plus sign stands for itself
    plain = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != _NULL, plain)


def partitions(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Sorted distinct partition folders ``(partition, key columns ...)`` that hold data files.

    One row a file comes from Spark's distributed listing (no file is opened
    and no row read); folders are cut out, made distinct and sorted by Spark.
    ``partition`` is the folder below ``root`` as it is named on disk, the key
    columns hold plain values as strings.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
             .load(root).select("path"))
    base = root.rstrip("/").split("://", 1)[-1].split(":", 1)[-1]
    inside = F.expr(f"substring(path, instr(path, '{base}') + {len(base) + 1})")
    folders = files.select(F.regexp_replace(inside, "/?[^/]*$", "").alias("partition")).distinct()
    first = folders.first()  # one name tells the keys
    keys = [p.partition("=")[0] for p in first[0].split("/") if "=" in p] if first else []
    return folders.select("partition", *[_value(F.col("partition"), k).alias(k) for k in keys]).orderBy("partition")


def partition_dirs(spark: SparkSession, root: str, pattern: str = "*.parquet") -> list[str]:
    """The folders of :func:`partitions` as a list (one name a folder)."""
    return [r["partition"] for r in partitions(spark, root, pattern).collect()]
