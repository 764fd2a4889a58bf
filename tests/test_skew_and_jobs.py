"""Hot keys (a third of all rows on one key) and the layered jobs on written tables."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strata.operators.identity import dedup
from strata.operators.mart import Label, star_aggregate
from strata.operators.upsert import merge
from strata.plans.dims import DimensionSpec, build_all
from strata.sinks.writer import write
from strata.sources.catalog import Catalog


def test_hot_duplicate_row_collapses_in_dedup(spark):
    n = 9000
    base = spark.range(n).select(F.col("id"), (F.col("id") % 5).alias("g"))
    hot = spark.range(n // 2).select(F.lit(-1).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("g"))
    assert dedup(base.unionByName(hot)).count() == n + 1


def test_hot_label_group_in_mart(spark):
    fact = spark.range(12000).select((F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50)).alias("sk"),
                                     F.lit(1.5).alias("x"))
    dim = spark.range(60).select(F.col("id").cast("int").alias("sk"), F.format_string("L%d", "id").alias("lab"))
    out = star_aggregate(fact, [Label(dim, "sk", "lab", "sk", "label")], ["label"],
                         {"n": F.count(F.lit(1)), "s": F.sum("x")})
    got = {r.label: (r.n, r.s) for r in out.collect()}
    assert got["L1"][0] == 4000 + sum(1 for i in range(12000) if i % 3 != 0 and i % 50 == 1)
    assert sum(v[0] for v in got.values()) == 12000


def test_hot_source_key_inserts_without_error(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.range(3000).select(F.lit(7).alias("k"), F.col("id").cast("string").alias("v"))
    assert merge(target, source, ["k"]).count() == 3001


def test_hot_day_written_by_several_tasks(spark, tmp_dir):
    hot = spark.range(30000).select(F.col("id"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    cold = spark.range(300).select(F.col("id"), F.lit(dt.date(2024, 1, 2)).alias("day"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write(hot.unionByName(cold).repartition(8), tmp_dir, "overwrite", ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{tmp_dir}/day=2024-01-01") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(tmp_dir).count() == 30300


SEED = StructType([StructField("vendor_id", IntegerType()), StructField("description", StringType())])


def test_build_all_extends_without_renumbering(spark, tmp_dir):
    rows = [(1, "a"), (6, "c")]
    spec = lambda data, enabled=True: DimensionSpec(
        "dim_vendor", "vendor_id", "vendor_sk", seed=lambda s: s.createDataFrame(data, SEED),
        path=f"{tmp_dir}/dim_vendor", enabled=enabled)
    first = build_all(spark, [spec(rows), spec(rows, enabled=False)])
    assert sorted(tuple(r) for r in first["dim_vendor"].collect()) == [(1, 1, "a"), (2, 6, "c")]
    second = build_all(spark, [spec(rows + [(2, "b")])])
    assert sorted(tuple(r) for r in second["dim_vendor"].collect()) == [(1, 1, "a"), (2, 6, "c"), (3, 2, "b")]
    rebuilt = build_all(spark, [spec(rows + [(2, "b")])], incremental=False)
    assert sorted(tuple(r) for r in rebuilt["dim_vendor"].collect()) == [(1, 1, "a"), (2, 2, "b"), (3, 6, "c")]


def test_catalog_from_mapping_loads_dependencies(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/a")
    spark.range(5).write.parquet(f"{tmp_dir}/b")
    cat = Catalog.from_mapping({
        "a": {"path": f"{tmp_dir}/a", "format": "parquet", "layer": "bronze"},
        "b": {"path": f"{tmp_dir}/b", "format": "parquet", "layer": "bronze"},
        "c": {"path": f"{tmp_dir}/c", "layer": "silver", "depends_on": ["a", "b"]},
    })
    deps = cat.load_dependencies(spark, "c")
    assert {k: v.count() for k, v in deps.items()} == {"a": 3, "b": 5}


def test_fact_dedup_per_source_file(spark, tmp_dir):
    from strata.operators.identity import with_source_file
    from strata.plans import fact, model

    ts = dt.datetime(2020, 5, 1, 8, 0)
    cols = {c: None for c in model.BRONZE_COLUMNS}
    trip = dict(cols, VendorID=1, tpep_pickup_datetime=ts, tpep_dropoff_datetime=ts + dt.timedelta(minutes=9),
                passenger_count=1, trip_distance=2.0, PULocationID=1, DOLocationID=2, payment_type=1, fare_amount=9.5)
    schema = StructType([StructField(c, t) for c, t in model.BRONZE_SCHEMA.items()])
    one = spark.createDataFrame([tuple(trip[c] for c in model.BRONZE_COLUMNS)] * 2, schema)
    one.coalesce(1).write.parquet(f"{tmp_dir}/m1")
    one.limit(1).coalesce(1).write.parquet(f"{tmp_dir}/m2")
    bronze = with_source_file(spark.read.parquet(f"{tmp_dir}/m1", f"{tmp_dir}/m2"))
    dims = {
        "dim_vendor": spark.createDataFrame([(1, 1, "v")], "vendor_sk int, vendor_id int, description string"),
        "dim_rate_code": spark.createDataFrame([(1, 1, "r")], "rate_code_sk int, rate_code_id int, description string"),
        "dim_payment_method": spark.createDataFrame([(1, 1, "p")],
                                                    "payment_method_sk int, payment_method_id int, description string"),
        "dim_location": spark.createDataFrame([(1, 1, "b", "z", "s"), (2, 2, "b", "z", "s")],
                                              "location_sk int, location_id int, borough string, zone string, "
                                              "service_zone string"),
    }
    per_file = fact.build_fact(bronze, dims, as_of="2024-01-01", dedup_scope="source", scope_columns=["_source_file"])
    whole = fact.build_fact(bronze, dims, as_of="2024-01-01")
    assert per_file.count() == 2 and whole.count() == 1
    assert per_file.columns == model.FACT_COLUMNS
    assert {r.trip_id for r in per_file.collect()} == {whole.first().trip_id}
    r = whole.first()
    assert (r.vendor_sk, r.pu_location_sk, r.do_location_sk, r.rate_code_sk) == (1, 1, 2, None)


def test_landed_months_are_written_as_read_unless_they_are_many_small_files(spark, tmp_dir):
    from strata.plans import ingest

    months = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, "2024-01").otherwise("2024-02").alias("year_month"))
    for files, scattered in ((2, False), (12, True)):
        months.repartition(files).write.partitionBy("year_month").parquet(f"{tmp_dir}-{files}")
        assert ingest._scattered(spark.read.parquet(f"{tmp_dir}-{files}"), 2) == scattered


def test_lake_query_lands_each_month_in_one_file(spark, monkeypatch):
    from strata.plans import jobs, registered
    from tests.conftest import SF_SMALL

    class Landed(Exception):
        pass

    def landed(spark, lake, start, end):
        files = spark.read.parquet(lake.landing).groupBy("year_month").agg(F.count_distinct("_metadata.file_path").alias("n"))
        raise Landed(files.agg(F.max("n")).first()[0], start, end)

    monkeypatch.setattr(jobs, "bronze_job", landed)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        registered.lake_end_to_end(spark, SF_SMALL)
    except Landed as seen:
        most, start, end = seen.args
    pickups = registered.adapter.dirty_trips(spark, SF_SMALL).agg(F.min("tpep_pickup_datetime"), F.max("tpep_pickup_datetime")).first()
    assert most == 1 and start == (pickups[0].year, pickups[0].month)
    assert end == (pickups[1].year + pickups[1].month // 12, pickups[1].month % 12 + 1)


def test_days_compared_apart_or_spread_give_the_same_rows(spark, monkeypatch):
    from strata.plans import adapter, fact
    from tests.conftest import SF_SMALL

    dims = adapter.dimensions(spark, SF_SMALL)
    raw = adapter.dirty_trips(spark, SF_SMALL).withColumn("year", F.lit(1)).withColumn("month", F.explode(F.array(F.lit(1), F.lit(2))))
    days = raw.groupBy(F.to_date("tpep_pickup_datetime").alias("day")).count()
    middle = days.approxQuantile("count", [0.5], 0.0)[0]
    for scope in ("global", "source"):
        build = lambda **kw: sorted(map(str, fact.build_fact(raw, dims, first_valid=adapter.FIRST_VALID, dedup_scope=scope, **kw).collect()))  # noqa: B023, E731
        want = build()
        for limit in (0, int(middle), 1 << 20):  # all days spread, some, none
            monkeypatch.setattr(fact, "DAY_ROWS", limit)
            assert build(by_day=True) == want


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    import time

    from strata.session import SHUFFLE_CLEANUP_CONF
    from strata.sinks.writer import stage

    blocks = lambda: {b for b in str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")).split() if b.startswith("shuffle_")}
    settings = {k: spark.conf.get(k) for k in SHUFFLE_CLEANUP_CONF}
    days = spark.range(2000).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("day"))
    before = blocks()
    write(days.dropDuplicates(["id"]), tmp_dir, "overwrite", ["day"])
    assert stage(days.groupBy("day").count()).count() == 5
    spark.read.parquet(tmp_dir).groupBy("day").count().toPandas()  # a query outside shuffles as before
    for _ in range(50):
        if len(left := {b.split("_")[1] for b in blocks() - before}) <= 2:  # the shuffles of the two reads
            break
        time.sleep(0.2)
    assert len(left) <= 2
    assert {k: spark.conf.get(k) for k in settings} == settings


def test_dedup_by_month_lands_without_a_fixed_number_of_tasks(spark, monkeypatch):
    from strata.plans import registered
    from tests.conftest import SF_SMALL

    class Landed(Exception):
        pass

    plans = []

    def written(df, *a, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *a, **kw)

    def built(bronze, *a, **kw):
        raise Landed(bronze)

    monkeypatch.setattr(registered, "write", written)
    monkeypatch.setattr(registered, "build_fact", built)
    try:
        registered.dedup_by_month(spark, SF_SMALL)
    except Landed as seen:
        landed = seen.args[0]
    assert not any("RoundRobin" in p for p in plans) and not any("Generate explode" in p for p in plans)
    trips = registered.adapter.trips(spark, SF_SMALL)
    month = F.trunc("tpep_pickup_datetime", "month")
    ahead = ((F.col("year") * 12 + F.col("month")) - (F.year(month) * 12 + F.month(month))).alias("ahead")
    n = trips.count()
    assert {r["ahead"]: r["count"] for r in landed.groupBy(ahead).count().collect()} == {0: 2 * n, 1: n}
    twice = landed.where(ahead == 0).groupBy(*trips.columns).agg(F.count_distinct("_metadata.file_path").alias("files"))
    assert twice.agg(F.min("files")).first()[0] >= 2  # the copies of a trip lie in files of their own
