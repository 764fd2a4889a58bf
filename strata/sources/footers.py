"""Parquet footers read by the cluster: which files agree on their columns and types."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(file, folder) of the data files under ``paths``, from Spark's distributed listing; no file is opened."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
              .load(list(paths)).select(F.col("path").alias("file")))
    return listed.withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))


def footers(listed: DataFrame) -> DataFrame:
    """``listed`` with each file's ``n_rows`` and ``schema_print``: its column names (without case) and physical types, sorted.

    One job, and only footers are read: a task opens some files one after the other.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            prints, counts = [], []
            for uri in batch.column("file").to_pylist():
                plain = re.sub(r"^file:/+", "/", uri)
                store, path = fs.FileSystem.from_uri(plain) if "://" in plain else (fs.LocalFileSystem(), plain)
                meta = pq.read_metadata(path, filesystem=store)
                prints.append("; ".join(sorted(f"{f.name.lower()} {f.type}" for f in meta.schema.to_arrow_schema())))
                counts.append(meta.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("folder"), pa.array(counts, pa.int64()), pa.array(prints, pa.string())],
                                             names=["file", "folder", "n_rows", "schema_print"])

    return listed.mapInArrow(read, "file string, folder string, n_rows long, schema_print string")


def group_by_schema(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Folders (or files, where a folder's files disagree) that share a schema, a list a schema, in name order.

    What reaches the driver is a row a folder, and a row a file only of folders that are mixed.
    """
    mixed = F.size(F.collect_set("schema_print")) > 1
    by_folder = footers(files(spark, paths)).groupBy("folder").agg(
        F.collect_set("schema_print").alias("prints"), F.when(mixed, F.collect_list(F.struct("schema_print", "file"))).alias("mixed"))
    groups: dict[str, list[str]] = {}
    for r in sorted(by_folder.collect(), key=lambda r: r["folder"]):
        if r["mixed"] is None:
            groups.setdefault(r["prints"][0], []).append(r["folder"])
        else:
            for m in sorted(r["mixed"], key=lambda m: m["file"]):
                groups.setdefault(m["schema_print"], []).append(m["file"])
    return list(groups.values())
