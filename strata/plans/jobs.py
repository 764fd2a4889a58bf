"""The lake's jobs over written tables: bronze -> dimensions -> silver -> gold -> check.

Paths come from one ``Lake`` description (a registry of named datasets), the
Spark-side counterpart of a datasets YAML. Every write is wrapped in the load
log (UPLOADING, then SUCCESS or FAILED).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.functions.dates import DateLike
from strata.operators.checks import reconcile, row_count_check
from strata.operators.dimensions import calendar
from strata.plans import fact as fact_jobs
from strata.plans import model
from strata.plans.dims import DimensionSpec, build_all
from strata.plans.ingest import ingest
from strata.sinks.writer import logged
from strata.sources.catalog import Catalog, Dataset
from strata.sources.months import month_range
from strata.sources.seeds import read_seed


@dataclass
class Lake:
    root: str
    landing: str
    source_name: str = "yellow_tripdata"
    seeds: Mapping[str, tuple[str, StructType]] = field(default_factory=dict)
    # first and last day of the date dimension; none is built without them
    calendar_range: tuple[DateLike, DateLike] | None = None
    # JSON file of datasets (see Catalog.from_file), read by ``catalog``; the built-in layout without it
    registry: Catalog | None = None

    @property
    def log(self) -> str:
        return f"{self.root}/_load_log"

    def catalog(self) -> Catalog:
        if self.registry is not None:
            return self.registry
        cat = Catalog()
        cat.add(Dataset("yellow_trip", f"{self.root}/bronze/yellow_trip", "parquet", "bronze",
                        partition_columns=("year", "month")))
        for name in model.DIMENSION_KEYS:
            cat.add(Dataset(name, f"{self.root}/silver/{name}", "parquet", "silver"))
        cat.add(Dataset("dim_date", f"{self.root}/silver/dim_date", "parquet", "silver"))
        cat.add(Dataset("fact_yellow_trip", f"{self.root}/silver/fact_yellow_trip", "parquet", "silver",
                        depends_on=("yellow_trip", *model.DIMENSION_KEYS), partition_columns=("partition_day",)))
        cat.add(Dataset("tbl_yellow_trips_dashboard", f"{self.root}/gold/tbl_yellow_trips_dashboard", "parquet",
                        "gold", depends_on=(*model.DIMENSION_KEYS, "fact_yellow_trip"),
                        partition_columns=("activity_date",)))
        return cat


def bronze_job(spark: SparkSession, lake: Lake, start: tuple[int, int], end: tuple[int, int]) -> list[str]:
    """Months in ``[start, end)`` not loaded yet, landed under ``landing/year_month=YYYY-MM``."""
    months = month_range(spark, start[0], start[1], end[0], end[1])
    return ingest(spark, months, lake.landing, lake.catalog()["yellow_trip"].path, model.BRONZE_SCHEMA,
                  lake.log, lake.source_name)


def dimension_job(spark: SparkSession, lake: Lake, incremental: bool = True) -> dict[str, DataFrame]:
    """All seeded dimensions and the calendar; existing ones are extended, never renumbered; every write is logged."""
    cat = lake.catalog()
    specs = []
    if lake.calendar_range is not None:
        lo, hi = lake.calendar_range
        specs.append(DimensionSpec("dim_date", "date_key", None, seed=lambda s: calendar(s, lo, hi), path=cat["dim_date"].path,
                                   order=len(lake.seeds), enabled=cat["dim_date"].enabled, source="calendar"))
    for order, (name, (path, schema)) in enumerate(lake.seeds.items()):
        key, sk = model.DIMENSION_KEYS[name]
        specs.append(DimensionSpec(name, key, sk, seed=lambda s, p=path, sc=schema: read_seed(s, p, sc),
                                   path=cat[name].path, order=order, enabled=cat[name].enabled, source=path))
    return build_all(spark, specs, incremental=incremental, log_path=lake.log)


def silver_job(spark: SparkSession, lake: Lake, refresh: str = "full", as_of: DateLike = None,
               months: int = 2, **kw) -> DataFrame | None:
    """The trip fact: one overwrite job (``full``) or an upsert of recent months (``incremental``).

    Returns the days that an incremental refresh changed (None after a full one), for :func:`gold_job`.

    ``dedup_scope="source"`` drops exact copies only within the month they were
    landed in (bronze ``year`` and ``month``); the default drops them over all.
    """
    cat = lake.catalog()
    deps = cat.load_dependencies(spark, "fact_yellow_trip")
    bronze = deps.pop("yellow_trip")
    dest, changed = cat["fact_yellow_trip"].path, []
    if refresh == "full":
        def action():
            fact_jobs.refresh_full(bronze, deps, dest, as_of, **kw)
    elif refresh == "incremental":
        def action():
            changed.append(fact_jobs.refresh_incremental(spark, bronze, deps, dest, months, as_of, **kw))
    else:
        raise ValueError("refresh must be 'full' or 'incremental'")
    logged(spark, lake.log, action, file_name="fact_yellow_trip", source=cat["yellow_trip"].path,
           destination=dest, load_type="overwrite" if refresh == "full" else "merge", layer="silver")
    return changed[0] if changed else None


def gold_job(spark: SparkSession, lake: Lake, days: DataFrame | None = None) -> None:
    """The daily mart, whole or (with ``days``, what :func:`silver_job` returned) for the days that changed."""
    cat = lake.catalog()
    deps = cat.load_dependencies(spark, "tbl_yellow_trips_dashboard")
    fact = deps.pop("fact_yellow_trip")
    dest = cat["tbl_yellow_trips_dashboard"].path
    def action():
        if days is None:
            fact_jobs.mart_job(fact, deps, dest)
        else:
            fact_jobs.mart_days(fact, deps, dest, days)

    logged(spark, lake.log, action, file_name="tbl_yellow_trips_dashboard", source=cat["fact_yellow_trip"].path, destination=dest,
           load_type="overwrite" if days is None else "days", layer="gold")


def validate_job(spark: SparkSession, lake: Lake) -> DataFrame:
    """Bronze rows >= silver rows, as a one-row result."""
    cat = lake.catalog()
    return row_count_check(cat.load(spark, "yellow_trip"), cat.load(spark, "fact_yellow_trip"), "fact_yellow_trip")


def reconcile_job(spark: SparkSession, lake: Lake, as_of: DateLike = None, **kw) -> DataFrame:
    """Silver against bronze by content, a row a day: the ids that bronze gives today and the ids that the fact holds."""
    cat = lake.catalog()
    deps = cat.load_dependencies(spark, "fact_yellow_trip")
    expected = fact_jobs.build_fact(deps.pop("yellow_trip"), deps, as_of, **kw).select("partition_day", "trip_id")
    return reconcile(expected, cat.load(spark, "fact_yellow_trip"), ["partition_day"], ["trip_id"])
