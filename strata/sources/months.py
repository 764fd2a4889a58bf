"""Month ranges and the names derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_range_of(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """``year_month`` (``yyyy-MM``) for every month in ``[start, end)`` of each bounds row.

    The end month is left out. ``start >= end`` gives no rows.
    """
    s = F.trunc(F.col(start), "month")
    e = F.trunc(F.col(end), "month")
    seq = F.when(s < e, F.sequence(s, F.add_months(e, -1), F.expr("INTERVAL 1 MONTH"))).otherwise(
        F.array().cast("array<date>"))
    return bounds.select(F.explode(seq).alias("month_start")).select(
        F.date_format("month_start", "yyyy-MM").alias("year_month"), "month_start")


def month_range(spark: SparkSession, start_year: int, start_month: int, end_year: int, end_month: int) -> DataFrame:
    """Months from ``start`` up to, not including, ``end``."""
    bounds = spark.range(1).select(
        F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1)).alias("start"),
        F.make_date(F.lit(end_year), F.lit(end_month), F.lit(1)).alias("end"),
    )
    return month_range_of(bounds)


def file_name(source_name: str, year_month: Column | str = "year_month", ext: str = "parquet") -> Column:
    ym = F.col(year_month) if isinstance(year_month, str) else year_month
    return F.concat(F.lit(f"{source_name}_"), ym, F.lit(f".{ext}"))


def with_source_names(months: DataFrame, source_name: str, source_root: str, target_root: str) -> DataFrame:
    """File name, source address and target month directory for each month."""
    parts = F.split(F.col("year_month"), "-")
    fn = file_name(source_name)
    return months.select(
        "year_month",
        fn.alias("file_name"),
        F.concat(F.lit(source_root.rstrip("/") + "/"), fn).alias("source"),
        F.concat(F.lit(target_root.rstrip("/") + "/year="), parts[0], F.lit("/month="), parts[1], F.lit("/"))
        .alias("destination"),
        parts[0].cast("int").alias("year"),
        parts[1].cast("int").alias("month"),
    )
