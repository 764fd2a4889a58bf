"""Upsert semantics, partitioned writes, load log, ingest over mixed files."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from strata.operators import runlog
from strata.operators.upsert import merge
from strata.sinks.writer import logged, replace_partitions, upsert, write
from strata.sources.landing import read_conformed
from strata.sources.partitions import partition_dirs


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()),
                  key=lambda t: tuple((x is None, x) for x in t))


# ------------------------------------------------------------------- merge
def test_merge_update_insert_null_overwrite_and_evolution(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, v string, t_only int")
    source = spark.createDataFrame([(2, None, "x"), (3, "c", "y"), (None, "m", "z")], "k int, v string, s_only string")
    out = merge(target, source, ["k"])
    assert out.columns == ["k", "v", "t_only", "s_only"]
    assert rows(out) == rows(spark.createDataFrame(
        [(1, "a", 10, None), (2, None, 20, "x"), (3, "c", None, "y"), (None, "n", 0, None), (None, "m", None, "z")],
        "k int, v string, t_only int, s_only string"))


def test_merge_rejects_two_source_rows_for_one_target(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception):
        merge(target, source, ["k"]).collect()


def test_merge_allows_repeated_source_keys_that_insert(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    assert merge(target, source, ["k"]).count() == 3


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    t=st.dictionaries(st.integers(0, 20), st.one_of(st.none(), st.integers(0, 9)), max_size=12),
    s=st.dictionaries(st.integers(0, 20), st.one_of(st.none(), st.integers(0, 9)), max_size=12),
)
def test_merge_matches_dict_model(spark, t, s):
    target = spark.createDataFrame(list(t.items()), "k int, v int")
    source = spark.createDataFrame(list(s.items()), "k int, v int")
    want = dict(t)
    want.update(s)
    assert dict(merge(target, source, ["k"]).collect()) == want


# --------------------------------------------------------- writes and upsert
def _day_frame(spark, data):
    return spark.createDataFrame(data, "id string, v double, day date")


def test_partitioned_upsert_rewrites_only_touched_days(spark, tmp_dir):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    base = _day_frame(spark, [("a", 1.0, d1), ("b", 2.0, d1), ("c", 3.0, d2)])
    write(base, tmp_dir, "overwrite", ["day"])
    d1_files = sorted(os.listdir(f"{tmp_dir}/day={d1}"))
    src = _day_frame(spark, [("c", 30.0, d2), ("d", 4.0, d2), ("e", 5.0, d3)])
    upsert(spark, src, tmp_dir, ["id", "day"], ["day"])
    got = spark.read.parquet(tmp_dir)
    assert rows(got, "id", "v") == [("a", 1.0), ("b", 2.0), ("c", 30.0), ("d", 4.0), ("e", 5.0)]
    assert sorted(os.listdir(f"{tmp_dir}/day={d1}")) == d1_files  # untouched day not rewritten


def test_upsert_into_missing_table_creates_it(spark, tmp_dir):
    src = _day_frame(spark, [("a", 1.0, dt.date(2024, 1, 1))])
    upsert(spark, src, f"{tmp_dir}/new", ["id", "day"], ["day"])
    assert spark.read.parquet(f"{tmp_dir}/new").count() == 1


def test_unpartitioned_upsert_rewrites_table(spark, tmp_dir):
    write(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), tmp_dir)
    upsert(spark, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), tmp_dir, ["k"])
    assert rows(spark.read.parquet(tmp_dir)) == [(1, "a"), (2, "B"), (3, "c")]


def test_full_refresh_twice_equals_once(spark, tmp_dir):
    df = _day_frame(spark, [("a", 1.0, dt.date(2024, 1, 1)), ("b", 2.0, dt.date(2024, 1, 2))])
    write(df, tmp_dir, "overwrite", ["day"])
    write(df, tmp_dir, "overwrite", ["day"])
    assert spark.read.parquet(tmp_dir).count() == 2


def test_replace_partitions_keeps_other_days(spark, tmp_dir):
    write(_day_frame(spark, [("a", 1.0, dt.date(2024, 1, 1)), ("b", 2.0, dt.date(2024, 1, 2))]),
          tmp_dir, "overwrite", ["day"])
    replace_partitions(_day_frame(spark, [("z", 9.0, dt.date(2024, 1, 2))]), tmp_dir, ["day"])
    assert rows(spark.read.parquet(tmp_dir), "id") == [("a",), ("z",)]
    assert partition_dirs(spark, tmp_dir) == ["day=2024-01-01", "day=2024-01-02"]


# ------------------------------------------------------------------ run log
def test_logged_write_records_status_and_reraises(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    ok = logged(spark, log, lambda: None, file_name="f1", source="s", destination="d", load_type="overwrite",
                layer="Bronze")

    def boom():
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError):
        logged(spark, log, boom, file_name="f2", source="s", destination="d", load_type="append", layer="bronze")
    assert ok
    assert logged(spark, log, boom, file_name="f3", source="s", destination="d", load_type="append",
                  layer="platinum", on_error="continue") is False
    got = runlog.read_log(spark, log)
    assert rows(got, "file_name", "status", "layer") == [
        ("f1", "SUCCESS", "bronze"), ("f1", "UPLOADING", "bronze"), ("f2", "FAILED", "bronze"),
        ("f2", "UPLOADING", "bronze"), ("f3", "FAILED", "faulty"), ("f3", "UPLOADING", "faulty")]
    assert got.where("status = 'FAILED' AND file_name = 'f2'").collect()[0]["error"] == "disk full"
    assert runlog.is_loaded(got, "f1") and not runlog.is_loaded(got, "f2")


def test_compact_log_keeps_rows(spark, tmp_dir):
    for i in range(5):
        runlog.record(spark, tmp_dir, file_name=f"f{i}", source="s", destination="d", status="SUCCESS",
                      load_type="append", layer="silver" if i % 2 else "bronze")
    before = rows(runlog.read_log(spark, tmp_dir), "id", "file_name", "layer")
    runlog.compact_log(spark, tmp_dir)
    assert rows(runlog.read_log(spark, tmp_dir), "id", "file_name", "layer") == before
    assert len([f for f in os.listdir(f"{tmp_dir}/layer=bronze") if f.endswith(".parquet")]) == 1


def test_latest_destinations_ties_break_by_id_and_pattern_is_literal(spark):
    t = dt.datetime(2024, 1, 1)
    log = runlog.log_rows(spark, [
        dict(id=1, file_name="yellow_tripdata_1", source="s", destination="d1", status="SUCCESS", load_type="o",
             processed_at=t, layer="bronze"),
        dict(id=2, file_name="yellow_tripdata_2", source="s", destination="d2", status="SUCCESS", load_type="o",
             processed_at=t, layer="bronze"),
        dict(id=3, file_name="yellowXtripdata_3", source="s", destination="d3", status="SUCCESS", load_type="o",
             processed_at=t, layer="bronze"),
        dict(id=4, file_name="yellow_tripdata_4", source="s", destination="d2", status="FAILED", load_type="o",
             processed_at=t, layer="bronze"),
    ])
    assert rows(runlog.latest_destinations(log, 1, "yellow_trip")) == [("d2",)]
    assert rows(runlog.successful_destinations(log, "yellow_trip")) == [("d1",), ("d2",)]


def test_latest_destinations_plan_is_top_k(spark):
    log = runlog.log_rows(spark, [dict(id=i, file_name="f", source="s", destination=f"d{i % 3}", status="SUCCESS",
                                       load_type="o", layer="bronze") for i in range(10)])
    plan = runlog.latest_destinations(log, 3, "f")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "TakeOrderedAndProject" in plan


# ------------------------------------------------------------ mixed files
def test_read_conformed_over_mixed_physical_types(spark, tmp_dir):
    spark.createDataFrame([(1, 2.5)], "id long, fare double").write.parquet(f"{tmp_dir}/m=1")
    spark.createDataFrame([(2, 3)], "ID int, fare long").write.parquet(f"{tmp_dir}/m=2")
    spark.createDataFrame([(3,)], "id long").write.parquet(f"{tmp_dir}/m=3")
    out = read_conformed(spark, [f"{tmp_dir}/m=1", f"{tmp_dir}/m=2", f"{tmp_dir}/m=3"],
                         {"id": LongType(), "fare": DoubleType(), "note": StringType()}, base_path=tmp_dir)
    assert rows(out, "id", "fare", "note", "m") == [(1, 2.5, None, 1), (2, 3.0, None, 2), (3, None, None, 3)]


def test_partition_dirs_lists_folders(spark, tmp_dir):
    df = spark.range(6).select(F.col("id"), (F.col("id") % 2).alias("p"), (F.col("id") % 3).alias("q"))
    df.write.partitionBy("p", "q").parquet(tmp_dir)
    assert len(partition_dirs(spark, tmp_dir)) == 6
