"""Queries over the driver's test tables, one per inventory item.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables (or data Spark derives from them). Queries that exercise writers
write under the session's shared checkpoint folder and read the result back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, TimestampNTZType

from strata.operators import runlog
from strata.operators.checks import reconcile, row_count_check
from strata.operators.conform import cast_failures, conform
from strata.operators.dimensions import build_dimension, date_dimension, extend_dimension
from strata.operators.filters import recent, valid_dates
from strata.operators.identity import dedup, with_row_hash
from strata.operators.lookup import Lookup, lookup_keys
from strata.operators.reshape import rename, with_date_parts
from strata.operators.upsert import merge
from strata.plans import adapter, model
from strata.plans.dims import DimensionSpec, build_all
from strata.plans.fact import build_fact, build_mart, mart_days, mart_job, refresh_full, refresh_incremental
from strata.plans.ingest import ingest
from strata.session import partitions_kept_open, scratch_path
from strata.sinks.writer import STEPS, read_table, recover, replace_partitions, stage, write
from strata.sinks.writer import upsert as upsert_table
from strata.sources.catalog import Catalog, Dataset
from strata.sources.footers import files, footers
from strata.sources.landing import read_leaf
from strata.sources.months import month_range_of, with_source_names
from strata.sources.partitions import partitions
from strata.sources.seeds import read_seed, write_seed

# Fixed query parameters.
AS_OF = "2001-07-15"
RANGE_LO, RANGE_HI = "1996-01-01", "2000-12-31"
SUM_COLS = ["total_distance", "total_fare_amount", "total_tip_amount", "total_amount"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return adapter.table(spark, sf_dir, name)


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"q-{name}-{uuid.uuid4().hex[:12]}")


def _fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    dims = adapter.dimensions(spark, sf_dir)
    return build_fact(adapter.dirty_trips(spark, sf_dir), dims, first_valid=adapter.FIRST_VALID), dims


# ---------------------------------------------------------------- star schema
def daily_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 over C9: trips -> fact -> daily mart (double sums rounded to cents)."""
    fact, dims = _fact(spark, sf_dir)
    m = build_mart(fact, dims)
    return m.withColumns({c: F.round(c, 2) for c in SUM_COLS})


def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver fact rows."""
    return _fact(spark, sf_dir)[0]


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor, rate code and payment sks on every trip (counts per key combination)."""
    dims = adapter.dimensions(spark, sf_dir)
    looked = lookup_keys(adapter.trips(spark, sf_dir), [
        Lookup(dims["dim_vendor"], "vendor_id", "vendor_sk", "VendorID"),
        Lookup(dims["dim_rate_code"], "rate_code_id", "rate_code_sk", "RatecodeID"),
        Lookup(dims["dim_payment_method"], "payment_method_id", "payment_method_sk", "payment_type"),
    ])
    keys = ["VendorID", "vendor_sk", "RatecodeID", "rate_code_sk", "payment_type", "payment_method_sk"]
    return looked.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


def role_playing_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One location dimension in two roles."""
    loc = adapter.dimensions(spark, sf_dir)["dim_location"]
    looked = lookup_keys(adapter.trips(spark, sf_dir), [
        Lookup(loc, "location_id", "location_sk", "PULocationID", "pu_location_sk"),
        Lookup(loc, "location_id", "location_sk", "DOLocationID", "do_location_sk"),
    ])
    keys = ["PULocationID", "pu_location_sk", "DOLocationID", "do_location_sk"]
    return looked.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: SHA-256 id over the 20 trip columns, NULLs included."""
    t = with_row_hash(adapter.trips(spark, sf_dir), model.BRONZE_COLUMNS, out="trip_id")
    return t.select("trip_id", "VendorID", "tpep_pickup_datetime", "store_and_fwd_flag", "extra")


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: exact-duplicate removal over trips with injected copies."""
    return dedup(adapter.dirty_trips(spark, sf_dir))


def valid_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose order date lies in a closed date range."""
    o = _t(spark, sf_dir, "orders")
    return valid_dates(o, "o_orderdate", RANGE_LO, RANGE_HI).select("o_orderkey", "o_orderdate", "o_totalprice")


def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from the first day of the month two months before AS_OF."""
    o = _t(spark, sf_dir, "orders")
    return recent(o, "o_orderdate", 2, AS_OF).select("o_orderkey", "o_orderdate")


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename and derive year, month, day, partition day."""
    o = rename(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), {"o_orderdate": "pickup_datetime"})
    return with_date_parts(o, "pickup_datetime")


EVENT_SCHEMA = {
    "event_id": LongType(), "ts": TimestampNTZType(), "user_id": IntegerType(), "event_type": StringType(),
    "value": IntegerType(), "session_fee": DoubleType(),
}


def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast declared columns (names matched without case), add missing ones."""
    e = _t(spark, sf_dir, "events").withColumnRenamed("value", "VALUE").withColumnRenamed("user_id", "User_Id")
    return conform(e, EVENT_SCHEMA)


def cast_failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values a lenient conform would turn into NULL, by column."""
    e = _t(spark, sf_dir, "events")
    return cast_failures(e, {"value": IntegerType(), "props": IntegerType(), "event_type": LongType(),
                             "user_id": IntegerType()})


# ------------------------------------------------------------------ dimensions
def dense_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense surrogate key over orders in key order."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return build_dimension(o, "o_orderkey", "order_sk")


def extend_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 (A6, J7, W2, U1): even customer keys exist; odd ones arrive later."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    existing = build_dimension(c.where(F.col("c_custkey") % 2 == 0), "c_custkey", "customer_sk")
    return extend_dimension(existing, c, "c_custkey", "customer_sk")


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the order-date range of the data."""
    o = _t(spark, sf_dir, "orders")
    return date_dimension(o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")))


def dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four trip dimensions and the calendar of the order dates written and read back, in one shape."""
    root = _scratch(spark, "dims")
    seeds = adapter.seed_frames(spark, sf_dir)
    specs = [
        DimensionSpec(name, *model.DIMENSION_KEYS[name], seed=lambda s, n=name: seeds[n], path=f"{root}/{name}",
                      order=i)
        for i, name in enumerate(model.DIMENSION_KEYS)
    ]
    specs.append(DimensionSpec("dim_date", "date_key", None, seed=lambda s: date_dim(s, sf_dir), path=f"{root}/dim_date", order=len(specs)))
    log = f"{root}-log"
    build_all(spark, specs, log_path=log)
    built = build_all(spark, specs, log_path=log)  # again: nothing is added or renumbered
    done = runlog.successful(runlog.read_log(spark, log, "silver")).count()
    if done != 2 * len(specs):
        raise AssertionError(f"{done} dimension writes logged, not {2 * len(specs)}")
    label = {"dim_location": "zone"}
    frames = []
    for name, df in built.items():
        if name == "dim_date":
            frames.append(df.select(F.lit(name).alias("dimension"), F.lit(None).cast("int").alias("sk"), F.col("date_key").cast("int").alias("natural_key"),
                                    F.date_format("date", "yyyy-MM-dd").alias("label")))
            continue
        nk, sk = model.DIMENSION_KEYS[name]
        frames.append(df.select(F.lit(name).alias("dimension"), F.col(sk).alias("sk"),
                                F.col(nk).alias("natural_key"), F.col(label.get(name, "description")).alias("label")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ----------------------------------------------------------------- upsert
def _upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, sf_dir, "orders").drop("o_orderstatus")
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    source = (o.where(F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp_ntz"))
              .drop("o_custkey")
              .withColumn("o_totalprice", F.col("o_totalprice") + 1)
              .withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, F.lit(None))
                          .otherwise(F.col("o_orderpriority")))
              .withColumn("o_source", F.lit("update")))
    return target, source


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-all / insert-all with schema evolution, as a DataFrame."""
    target, source = _upsert_sides(spark, sf_dir)
    return merge(target, source, ["o_orderkey"])


def incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: full fact for older pickups, then the recent window upserted; read back."""
    path = _scratch(spark, "fact")
    dims = adapter.dimensions(spark, sf_dir)
    raw = stage(adapter.dirty_trips(spark, sf_dir), "trips")  # read several times, joined once
    older = raw.where(F.col(model.PICKUP) < F.lit("2001-06-01").cast("timestamp_ntz"))
    refresh_full(older, dims, path, first_valid=adapter.FIRST_VALID)
    refresh_incremental(spark, raw, dims, path, months=2, as_of=AS_OF, first_valid=adapter.FIRST_VALID)
    return spark.read.parquet(path).select(*model.FACT_COLUMNS)


# -------------------------------------------------------------- writes, scans
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K3, K6: write events by day, replace the last days without errors, read back."""
    path = _scratch(spark, "events")
    e = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    write(e, path, "overwrite", ["day"])
    late = e.where((F.col("day") >= F.lit("2024-01-25").cast("date")) & (F.col("event_type") != "error"))
    replace_partitions(late, path, ["day"])
    return spark.read.parquet(path)


def partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct partition folders of a written table, sorted."""
    path = _scratch(spark, "events-by-day")
    write(_t(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), path, "overwrite", ["day"])
    return partitions(spark, path)


def dataset_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry lookup of a dataset's upstream tables; rows per table."""
    cat = Catalog()
    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        cat.add(Dataset(name, f"{sf_dir.rstrip('/')}/{name}.parquet", "parquet", "bronze"))
    cat.add(Dataset("trips", "", "parquet", "silver", depends_on=("lineitem", "orders", "customer", "supplier")))
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("dataset"), "row_count")
              for n, df in cat.load_dependencies(spark, "trips").items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def seed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as a header CSV and read back with a declared schema."""
    from pyspark.sql.types import StructField, StructType

    path = _scratch(spark, "nation-csv")
    write_seed(_t(spark, sf_dir, "nation"), path)
    schema = StructType([StructField("n_nationkey", IntegerType()), StructField("n_name", StringType()),
                         StructField("n_regionkey", IntegerType())])
    return read_seed(spark, path, schema)


def _month_bounds(spark: SparkSession, sf_dir: str, extra_months: int = 0) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.agg(F.min("o_orderdate").alias("start"),
                 F.add_months(F.max("o_orderdate"), extra_months).alias("end"))


def month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the order-date range (end month left out) and names per month."""
    months = month_range_of(_month_bounds(spark, sf_dir))
    return with_source_names(months, "yellow_tripdata", "https://example.invalid/trip-data", "bronze/yellow_trip")


def _orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log derived from orders: one status row per order, in its order month."""
    o = _t(spark, sf_dir, "orders")
    ym = F.date_format("o_orderdate", "yyyy-MM")
    status = (F.when(F.col("o_orderstatus") == "F", runlog.SUCCESS)
              .when(F.col("o_orderstatus") == "O", runlog.UPLOADING).otherwise(runlog.FAILED))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("yellow_tripdata_"), ym, F.lit(".parquet")).alias("file_name"),
        F.lit("landing").alias("source"),
        F.concat(F.lit("bronze/"), ym).alias("destination"),
        status.alias("status"),
        F.lit("overwrite").alias("load_type"),
        F.col("o_orderdate").cast("timestamp").alias("processed_at"),
        F.lit(runlog.NO_ERROR).alias("error"),
        F.lit("bronze").alias("layer"),
    )


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with no successful load in the log (range runs 6 months past the data)."""
    months = with_source_names(month_range_of(_month_bounds(spark, sf_dir, 6)), "yellow_tripdata", "src", "bronze")
    return runlog.pending(months, _orders_log(spark, sf_dir)).select("year_month", "file_name")


def _events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.col("event_type"), F.lit("_file")).alias("file_name"),
        F.lit("events").alias("source"),
        F.concat(F.lit("dest/"), F.col("user_id").cast("string")).alias("destination"),
        F.when(F.col("event_type") != "error", runlog.SUCCESS).otherwise(runlog.FAILED).alias("status"),
        F.lit("append").alias("load_type"),
        F.col("ts").cast("timestamp").alias("processed_at"),
        F.lit(runlog.NO_ERROR).alias("error"),
        F.col("event_type").alias("layer_name"),
    )


def _routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log row for each event, routed to a layer (unknown names -> faulty)."""
    layer_name = {"click": "bronze", "view": "Silver", "purchase": "GOLD"}
    named = F.coalesce(*[F.when(F.col("layer_name") == k, F.lit(v)) for k, v in layer_name.items()],
                       F.concat(F.lit("x_"), F.col("layer_name")))
    rows = _events_log(spark, sf_dir).withColumn("layer", runlog.layer_of(named))
    return rows.select(*runlog.LOG_SCHEMA.fieldNames())


def _read_back(spark: SparkSession, path: str) -> DataFrame:
    return runlog.read_log(spark, path).withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8/K9: log rows routed to a layer, appended and read back."""
    path = _scratch(spark, "log")
    runlog.append_log(_routed_events(spark, sf_dir), path)
    return _read_back(spark, path)


def log_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8/K9: the same rows in seven appends, merged whenever a layer has more than two files
    since the last merge; a batch is appended twice, as by a writer that is run again."""
    path, rows = _scratch(spark, "log"), _routed_events(spark, sf_dir)
    for batch in (0, 1, 2, 3, 3, 4, 5):
        runlog.append_log(rows.where(F.pmod("id", F.lit(6)) == batch), path, snapshot_files=2)
    return _read_back(spark, path)


def latest_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14 (P8, W3, A9, T2): destinations of the 50 latest successful loads matching 'i'."""
    return runlog.latest_destinations(_events_log(spark, sf_dir), 50, "i")


def successful_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All destinations of successful loads matching 'ur'."""
    return runlog.successful_destinations(_events_log(spark, sf_dir), "ur")


ORDERS_SCHEMA = {
    "o_orderkey": LongType(), "o_custkey": LongType(), "o_orderstatus": StringType(),
    "o_totalprice": DoubleType(), "o_orderdate": TimestampNTZType(), "o_orderpriority": StringType(),
}


def _landed_months(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The folder in which the orders landed by month, 1999 with another layout; and the orders."""
    o = _t(spark, sf_dir, "orders").withColumn("year_month", F.date_format("o_orderdate", "yyyy-MM"))
    landing = _scratch(spark, "landing")
    is99 = F.col("year_month").startswith("1999")
    o.where(~is99).write.partitionBy("year_month").parquet(landing)
    (o.where(is99).select(F.col("o_orderkey"), F.col("o_custkey").cast("int"), "o_orderstatus",
                          F.col("o_totalprice").alias("O_TotalPrice"), "o_orderdate", "year_month")
     .write.mode("append").partitionBy("year_month").parquet(landing))
    return landing, o


def _landed_orders(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Landing, bronze and log folders after two ingests of the orders landed by month."""
    landing, o = _landed_months(spark, sf_dir)
    target, log = _scratch(spark, "bronze"), _scratch(spark, "ingest-log")
    months = month_range_of(o.agg(F.min("o_orderdate").alias("start"),
                                  F.add_months(F.max("o_orderdate"), 1).alias("end")))
    ingest(spark, months, landing, target, ORDERS_SCHEMA, log, "orders")
    again = ingest(spark, months, landing, target, ORDERS_SCHEMA, log, "orders")
    if again:
        raise AssertionError(f"second ingest reloaded {len(again)} months")
    return landing, target, log


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 (S1, S2, S9-S11, P1, K3, K8): orders landed by month, 1999 months with
    another physical layout (int key, other name case, a column missing);
    ingested once, ingested again (nothing pending), read back from the root."""
    return spark.read.parquet(_landed_orders(spark, sf_dir)[1])


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8, C14, C15 on the log that an ingest writes: each month's own folders; ids and times left out."""
    landing, target, log = _landed_orders(spark, sf_dir)
    rows = runlog.read_log(spark, log)
    latest = runlog.latest_destinations(rows, 3, "orders_").withColumn("latest", F.lit(True))
    named = rows.join(latest, "destination", "left").withColumn("latest", F.coalesce("latest", F.lit(False)))
    plain = lambda c, folder, name: F.replace(F.col(c), F.lit(folder), F.lit(name)).alias(c)
    return named.select("file_name", plain("source", landing, "landing"), plain("destination", target, "bronze"), "status", "load_type", "error", "layer", "latest")


def _ingest_with_rejects(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Bronze, rejects and counts after an ingest of orders of which some land with a price or a customer that is no number."""
    o = _t(spark, sf_dir, "orders")
    landing, names = _scratch(spark, "landing"), ("bronze", "rejects", "counts", "ingest-log", "claims")
    target, rejects, counts, log, claims = (_scratch(spark, n) for n in names)
    spoiled = o.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 89 == 0, F.lit("x")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("n/a "), "o_orderkey")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))
    write(spoiled, landing, "overwrite", "year_month")
    months = month_range_of(o.agg(F.min("o_orderdate").alias("start"), F.add_months(F.max("o_orderdate"), 1).alias("end")))
    ingest(spark, months, landing, target, ORDERS_SCHEMA, log, "orders", rejects=rejects, counts=counts, claims=claims)
    return target, rejects, counts


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that conform and rows set aside with their lost values and their file; together the rows landed."""
    target, rejects, _ = _ingest_with_rejects(spark, sf_dir)
    lost = F.array_join(F.array_sort(F.transform("rejected", lambda x: F.concat(x["column"], F.lit("="), x["value"]))), ";")
    kept = spark.read.parquet(target).select("o_orderkey", "o_custkey", "o_totalprice", "year", "month", F.lit(None).cast("string").alias("lost"),
                                             F.lit(None).cast("string").alias("source_month"))
    bad = spark.read.parquet(rejects).select(
        F.get_json_object("landed_row", "$.o_orderkey").cast("long").alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey"),
        F.lit(None).cast("double").alias("o_totalprice"), "year", "month", lost.alias("lost"),
        F.regexp_extract("source_file", "year_month=([0-9-]+)/", 1).alias("source_month"))
    return kept.unionByName(bad)


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, out and rejected by month, failed casts by column, as the writing pass counted them."""
    return spark.read.parquet(_ingest_with_rejects(spark, sf_dir)[2]).drop("load_id")


def leaf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed folder read by itself has its own columns only, without those of the folders above."""
    o = _t(spark, sf_dir, "orders").withColumn("status", F.col("o_orderstatus"))
    landing = _scratch(spark, "landing-by-status")
    write(o, landing, "overwrite", ["status"])
    return read_leaf(spark, f"{landing}/status=F")


def full_refresh_shrinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written for all days, then refreshed without the last ones, holds none of them."""
    path = _scratch(spark, "fact-shrinks")
    dims, raw = adapter.dimensions(spark, sf_dir), stage(adapter.dirty_trips(spark, sf_dir), "trips")  # read several times, joined once
    refresh_full(raw, dims, path, first_valid=adapter.FIRST_VALID)
    refresh_full(raw.where(F.col(model.PICKUP) < F.lit("2000-01-01").cast("timestamp_ntz")), dims, path, first_valid=adapter.FIRST_VALID)
    return spark.read.parquet(path).select(*model.FACT_COLUMNS)


def upsert_moves_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: rows whose partition changes in an upsert on a key without the partition column move, none is left behind."""
    path = _scratch(spark, "orders-by-status")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write(o, path, "overwrite", ["o_orderstatus"])
    moved = o.where("o_orderkey % 7 = 0").withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upsert_table(spark, moved, path, ["o_orderkey"], ["o_orderstatus"])
    return spark.read.parquet(path)


def dedup_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 per source month: every trip landed twice in its month, over several part files, and once in the month after."""
    path = _scratch(spark, "trips-by-month")

    def landed(trips: DataFrame, later: int) -> DataFrame:
        month = F.add_months(F.trunc(model.PICKUP, "month"), later)
        return trips.withColumn("year", F.year(month)).withColumn("month", F.month(month))

    parts = list(model.BRONZE_PARTITION)
    write(landed(adapter.trips(spark, sf_dir), 0), path, "overwrite", parts)
    # what landed first lies by month, so it lands again without a shuffle or sort, each time in files of its own
    first = spark.read.parquet(path)
    with partitions_kept_open(spark):
        for later in (0, 1):
            write(landed(first, later), path, "append", parts, cluster=False)
    return build_fact(spark.read.parquet(path), adapter.dimensions(spark, sf_dir), first_valid=adapter.FIRST_VALID, dedup_scope="source", by_day=True)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 as a stream: orders land by month in two waves; each run ingests only new files."""
    from pyspark.sql.types import StructField, StructType

    from strata.streaming.ingest_stream import BATCH_COL, ingest_stream

    o = _t(spark, sf_dir, "orders").withColumn("year_month", F.date_format("o_orderdate", "yyyy-MM"))
    landing, target = _scratch(spark, "stream-landing"), _scratch(spark, "stream-bronze")
    ckpt, log = _scratch(spark, "stream-ckpt"), _scratch(spark, "stream-log")
    read_schema = StructType([StructField(n, t) for n, t in ORDERS_SCHEMA.items()] +
                             [StructField("year_month", StringType())])
    derive = (lambda df: df.withColumn("year", F.split("year_month", "-")[0].cast("int"))
              .withColumn("month", F.split("year_month", "-")[1].cast("int")).drop("year_month"))
    early = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    args = dict(read_schema=read_schema, target=target, checkpoint=ckpt, schema=ORDERS_SCHEMA,
                partition_cols=["year", "month"], log_path=log, derive=derive)
    o.where(early).write.partitionBy("year_month").parquet(landing)
    ingest_stream(spark, landing, **args)
    o.where(~early).write.mode("append").partitionBy("year_month").parquet(landing)
    ingest_stream(spark, landing, **args)
    ingest_stream(spark, landing, **args)  # nothing new: no rows added
    return spark.read.parquet(target).drop(BATCH_COL)


def lake_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1, C8, C10, C12, C13 over written tables: trips land by month, seeds land as
    CSV; bronze, dimensions, silver fact and gold mart are built and the mart read back."""
    from strata.plans.jobs import Lake, bronze_job, dimension_job, gold_job, silver_job, validate_job

    root, landing, seed_root = _scratch(spark, "lake"), _scratch(spark, "lake-landing"), _scratch(spark, "seeds")
    trips = adapter.dirty_trips(spark, sf_dir)
    write(trips.withColumn("year_month", F.date_format(model.PICKUP, "yyyy-MM")), landing, "overwrite", "year_month")
    seeds = {}
    schemas = {"dim_vendor": model.VENDOR_SEED, "dim_rate_code": model.RATE_CODE_SEED,
               "dim_payment_method": model.PAYMENT_SEED, "dim_location": model.LOCATION_SEED}
    for name, frame in adapter.seed_frames(spark, sf_dir).items():
        write_seed(frame, f"{seed_root}/{name}")
        seeds[name] = (f"{seed_root}/{name}", schemas[name])
    lake = Lake(root, landing, seeds=seeds, calendar_range=("1996-01-01", "2002-12-31"))
    span = spark.read.parquet(landing).agg(F.min(model.PICKUP).alias("lo"), F.max(model.PICKUP).alias("hi")).first()
    hi = span["hi"]
    bronze_job(spark, lake, (span["lo"].year, span["lo"].month), (hi.year + hi.month // 12, hi.month % 12 + 1))
    dimension_job(spark, lake)
    silver_job(spark, lake, "full", first_valid=adapter.FIRST_VALID)
    gold_job(spark, lake)
    check = validate_job(spark, lake).first()
    if not check["passed"]:
        raise AssertionError(f"row count check failed: {check}")
    gold = spark.read.parquet(lake.catalog()["tbl_yellow_trips_dashboard"].path)
    return gold.withColumns({c: F.round(c, 2) for c in SUM_COLS})


class _CutOff(Exception):
    """Stands for a driver that dies at a step of a write."""


def _dies_at(step: str):
    def on_step(at: str) -> None:
        if at == step:
            raise _CutOff(step)
    return on_step


def overwrite_cut_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, K6: an overwrite of the orders by status that dies at each of its steps: what is read then, and after recovery."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    newer = o.where("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    out = None
    for step in STEPS:
        path = _scratch(spark, f"cut-off-{step}")
        write(o, path, "overwrite", ["o_orderstatus"])
        try:
            write(newer, path, "overwrite", ["o_orderstatus"], on_step=_dies_at(step))
        except _CutOff:
            seen = stage(read_table(spark, path), "cut-off-seen")  # before recovery moves the files
        recover(spark, path)
        for name, df in (("read", seen), ("recovered", spark.read.parquet(path))):
            rows = df.select(F.lit(step).alias("step"), F.lit(name).alias("seen"), *o.columns)
            out = rows if out is None else out.unionByName(rows)
    return out


def dimension_cut_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension of a dimension that dies at each step of its write, then runs again: keys stay what they were."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    out = None
    for step in STEPS:
        path = _scratch(spark, f"dim-cut-off-{step}")
        spec = lambda rows, p=path: DimensionSpec("dim_customer", "c_custkey", "customer_sk", lambda s: rows, p)
        build_all(spark, [spec(c.where(F.col("c_custkey") % 2 == 0))])
        try:
            build_all(spark, [spec(c)], on_step=_dies_at(step))
        except _CutOff:
            dim = build_all(spark, [spec(c)])["dim_customer"].withColumn("step", F.lit(step))
        out = dim if out is None else out.unionByName(dim)
    return out


def mart_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 after C11: a mart of older days, brought up to date for the days that an incremental fact refresh changed."""
    fact_path, mart_path = _scratch(spark, "mart-fact"), _scratch(spark, "mart")
    dims, raw = adapter.dimensions(spark, sf_dir), stage(adapter.dirty_trips(spark, sf_dir), "trips")  # read several times, joined once
    older = raw.where(F.col(model.PICKUP) < F.lit("2001-06-01").cast("timestamp_ntz"))
    refresh_full(older, dims, fact_path, first_valid=adapter.FIRST_VALID)
    mart_job(read_table(spark, fact_path), dims, mart_path)
    days = refresh_incremental(spark, raw, dims, fact_path, months=2, as_of=AS_OF, first_valid=adapter.FIRST_VALID)
    mart_days(read_table(spark, fact_path), dims, mart_path, days)
    return read_table(spark, mart_path).withColumns({c: F.round(c, 2) for c in SUM_COLS})


def reconcile_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 by content: the orders against a copy in which some are missing, some doubled and some changed, a row a day."""
    o = _t(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    key = F.col("o_orderkey")
    copies = F.when(key % 97 == 0, F.array().cast("array<int>")).when(key % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    faulty = (o.withColumn("o_totalprice", F.when(key % 83 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
              .withColumn("copy", F.explode(copies)).drop("copy"))
    return reconcile(o, faulty, ["day"], ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


def footer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 planning: rows and schema of every landed month, from the files' footers alone."""
    landing = _landed_months(spark, sf_dir)[0]
    month = F.regexp_extract("folder", "year_month=([^/]*)$", 1)
    has = lambda what: F.bool_and(F.col("schema_print").contains(what))
    return footers(files(spark, [landing])).groupBy(month.alias("year_month")).agg(
        F.sum("n_rows").alias("n_rows"), has("o_custkey int32").alias("narrow_key"), has("o_orderpriority ").alias("has_priority"))


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows >= silver rows."""
    fact, _ = _fact(spark, sf_dir)
    return row_count_check(adapter.dirty_trips(spark, sf_dir), fact, "fact_yellow_trip")


QUERIES = {
    "daily_mart": daily_mart,
    "fact_build": fact_build,
    "key_lookup": key_lookup,
    "role_playing_lookup": role_playing_lookup,
    "row_hash": row_hash,
    "dedup_rows": dedup_rows,
    "valid_date_range": valid_date_range,
    "recent_window": recent_window,
    "date_parts": date_parts,
    "conform_schema": conform_schema,
    "cast_failures": cast_failure_counts,
    "dense_key": dense_key,
    "extend_dimension": extend_dim,
    "date_dimension": date_dim,
    "dimensions": dimensions,
    "upsert": upsert,
    "incremental_fact": incremental_fact,
    "partition_overwrite": partition_overwrite,
    "partition_list": partition_list,
    "dataset_dependencies": dataset_dependencies,
    "seed_scan": seed_scan,
    "month_range": month_range,
    "pending_files": pending_files,
    "load_log": load_log,
    "log_snapshots": log_snapshots,
    "latest_destinations": latest_destinations,
    "successful_destinations": successful_destinations,
    "bronze_ingest": bronze_ingest,
    "stream_ingest": stream_ingest,
    "ingest_log": ingest_log,
    "ingest_rejects": ingest_rejects,
    "ingest_counts": ingest_counts,
    "leaf_scan": leaf_scan,
    "full_refresh_shrinks": full_refresh_shrinks,
    "upsert_moves_partition": upsert_moves_partition,
    "dedup_by_month": dedup_by_month,
    "lake_end_to_end": lake_end_to_end,
    "row_count_check": row_count,
    "overwrite_cut_off": overwrite_cut_off,
    "dimension_cut_off": dimension_cut_off,
    "mart_incremental": mart_incremental,
    "reconcile_days": reconcile_days,
    "footer_scan": footer_scan,
}
