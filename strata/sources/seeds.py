"""Seed files (S5, S7): small typed CSVs with a header, and stored dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV seed read with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_seed(df: DataFrame, path: str) -> None:
    """Write a frame as a seed CSV with a header (tests, exports)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_dimension(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
