"""Physical-plan checks: the plan shapes the scale design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.lookup import Lookup, lookup_keys
from strata.plans import adapter, fact
from strata.sinks.writer import write
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookups_are_broadcast_hash_joins(spark):
    dims = adapter.dimensions(spark, SF_SMALL)
    looked = lookup_keys(adapter.trips(spark, SF_SMALL), [
        Lookup(dims["dim_vendor"], "vendor_id", "vendor_sk", "VendorID"),
        Lookup(dims["dim_location"], "location_id", "location_sk", "PULocationID", "pu_location_sk"),
    ])
    p = plan(looked)
    assert p.count("BroadcastHashJoin") >= 2 and "LeftOuter" in p


def test_oversized_lookup_side_is_not_broadcast(spark):
    big = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") + 1).alias("sk"))
    facts = spark.range(0, 1000).select((F.col("id") % 300).alias("fk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(lookup_keys(facts, [Lookup(big, "k", "sk", "fk")], max_bytes=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p


def test_validity_filter_reaches_the_scan(spark):
    dims = adapter.dimensions(spark, SF_SMALL)
    f = fact.build_fact(adapter.trips(spark, SF_SMALL), dims, first_valid=adapter.FIRST_VALID)
    p = plan(f)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in p


def test_day_filter_prunes_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "id int, day date")
    write(df, tmp_dir, "overwrite", ["day"])
    q = spark.read.parquet(tmp_dir).where(F.col("day") == F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in plan(q)
    assert [r.id for r in q.collect()] == [2]


def test_mart_has_one_aggregate_shuffle_after_lookups(spark):
    dims = adapter.dimensions(spark, SF_SMALL)
    m = fact.build_mart(fact.build_fact(adapter.dirty_trips(spark, SF_SMALL), dims,
                                        first_valid=adapter.FIRST_VALID), dims)
    p = m._jdf.queryExecution().sparkPlan().toString()
    # partial + final aggregate for the mart, partial + final for the dedup
    assert p.count("HashAggregate") == 4


def test_full_refresh_moves_rows_before_ids_are_added(spark, tmp_dir):
    from strata.sinks.writer import stage

    dims = {k: stage(d) for k, d in adapter.dimensions(spark, SF_SMALL).items()}
    raw = adapter.dirty_trips(spark, SF_SMALL)
    p = plan(fact.build_fact(raw, dims, first_valid=adapter.FIRST_VALID, by_day=True))
    assert p.index("sha2(") < p.index("REBALANCE_PARTITIONS_BY_COL")  # the root comes first
    fact.refresh_full(raw, dims, tmp_dir, first_valid=adapter.FIRST_VALID)
    got, want = spark.read.parquet(tmp_dir), fact.build_fact(raw, dims, first_valid=adapter.FIRST_VALID)
    files = got.groupBy("partition_day").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_recent_rows_filter_what_they_are_joined_from(spark, monkeypatch):
    from strata import session
    from strata.operators.filters import recent
    from strata.plans import model

    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    monkeypatch.setitem(session.RUNTIME_FILTER_CONF, key, "0")
    monkeypatch.setitem(session.RUNTIME_FILTER_CONF, "spark.sql.autoBroadcastJoinThreshold", "-1")  # no table is large here
    before = spark.conf.get(key)
    fresh = lambda: recent(adapter.dirty_trips(spark, SF_SMALL), model.PICKUP, 2, "2001-07-15")
    with session.runtime_filters(spark):
        filtered = fresh()
        assert "might_contain" in plan(filtered)
        rows = sorted(map(str, filtered.collect()))
    assert spark.conf.get(key) == before and "might_contain" not in plan(fresh())
    assert rows == sorted(map(str, fresh().collect()))


def test_a_refresh_moves_trips_once_and_by_day(spark):
    from strata.operators.broadcast import is_bounded

    dims = adapter.dimensions(spark, SF_SMALL)
    assert all(is_bounded(d) for d in dims.values())  # else a refresh moves rows by day only after ids and keys are added
    p = plan(fact.build_fact(adapter.dirty_trips(spark, SF_SMALL), dims, first_valid=adapter.FIRST_VALID, by_day=True))
    assert p.count("REBALANCE_PARTITIONS_BY_COL") == 1 and "hashpartitioning(VendorID" not in p


def test_customers_beyond_the_bound_are_joined_to_orders_not_to_trips(spark, monkeypatch):
    want = sorted(map(str, adapter.trips(spark, SF_SMALL).collect()))
    monkeypatch.setattr(adapter, "bounded_broadcast", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = adapter.trips(spark, SF_SMALL)
        lines = plan(trips).splitlines()
        got = sorted(map(str, trips.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if "hashpartitioning(o_custkey" in line)
    below = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    assert not any("l_orderkey" in line for line in lines[at:below]) and any("o_custkey" in line for line in lines[at:below])
    assert got == want
