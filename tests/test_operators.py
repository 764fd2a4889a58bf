"""Unit tests on small frames for what the test tables lack (NULLs, dirt, edge keys)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from strata.operators.checks import row_count_check
from strata.operators.conform import cast_failures, conform
from strata.operators.dimensions import build_dimension, date_dimension, duplicate_keys, extend_dimension
from strata.operators.filters import recent, valid_dates
from strata.operators.identity import dedup, with_row_hash, with_source_file
from strata.operators import keys
from strata.operators.keys import dense_key
from strata.sources.months import month_range


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()),
                  key=lambda t: tuple((x is None, x) for x in t))


# ------------------------------------------------------------------ conform
def test_conform_matches_names_without_case_and_adds_missing(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "VendorID long, Airport_fee double, extra_col string")
    out = conform(df, {"vendorid": IntegerType(), "airport_fee": DoubleType(), "missing": LongType()})
    assert out.columns == ["vendorid", "airport_fee", "extra_col", "missing"]
    assert dict(out.dtypes) == {"vendorid": "int", "airport_fee": "double", "extra_col": "string",
                                "missing": "bigint"}
    assert out.collect()[0]["missing"] is None


def test_conform_strict_fails_on_nan_to_int_and_lenient_counts(spark):
    df = spark.createDataFrame([(1.7,), (float("nan"),), (None,)], "x double")
    with pytest.raises(Exception):
        conform(df, {"x": IntegerType()}).collect()
    lenient = conform(df, {"x": IntegerType()}, strict=False)
    assert rows(lenient) == [(1,), (None,), (None,)]
    assert cast_failures(df, {"x": IntegerType()}).collect()[0]["x"] == 1


# --------------------------------------------------------------- row hash, dedup
def test_row_hash_default_collides_on_null_position_token_does_not(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "c1 string, c2 string, c3 string")
    plain = [r[0] for r in with_row_hash(df, ["c1", "c2", "c3"]).select("row_id").collect()]
    safe = [r[0] for r in with_row_hash(df, ["c1", "c2", "c3"], null_token="\\N").select("row_id").collect()]
    assert plain[0] == plain[1]
    assert safe[0] != safe[1]


def test_row_hash_negative_zero_only_normalised_with_token(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    plain = {r[0] for r in with_row_hash(df, ["x"]).select("row_id").collect()}
    safe = {r[0] for r in with_row_hash(df, ["x"], null_token="\\N").select("row_id").collect()}
    assert len(plain) == 2 and len(safe) == 1


def test_row_hash_matches_sha2_of_concat(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a int, b string, c double")
    got = with_row_hash(df, ["a", "b", "c"]).collect()[0]["row_id"]
    import hashlib
    assert got == hashlib.sha256(b"1||x||2.5").hexdigest()


def test_hash_ignores_partition_columns_when_listed(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2024, 1), (2, "b", 2024, 2)], "id int, v string, year int, month int")
    df.write.partitionBy("year", "month").parquet(tmp_dir)
    root = spark.read.parquet(tmp_dir)
    leaf = spark.read.parquet(f"{tmp_dir}/year=2024/month=1")
    a = with_row_hash(root.where("id = 1"), ["id", "v"]).collect()[0]["row_id"]
    b = with_row_hash(leaf, ["id", "v"]).collect()[0]["row_id"]
    assert a == b


def test_dedup_global_and_per_source(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert dedup(df).count() == 2
    df.coalesce(1).write.parquet(f"{tmp_dir}/f1")
    df.where("k = 1").coalesce(1).write.parquet(f"{tmp_dir}/f2")
    both = with_source_file(spark.read.parquet(f"{tmp_dir}/f1", f"{tmp_dir}/f2"))
    assert dedup(both, "source").count() == 3  # (1,a) once per file, (2,b) once
    assert dedup(both, "global").count() == 2


def test_dedup_treats_negative_zero_as_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert dedup(df).count() == 1


# ------------------------------------------------------------- filters, months
def test_valid_dates_bounds_and_nulls(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2014, 12, 31, 23, 59),), (dt.datetime(2015, 1, 1, 0, 0),), (None,),
         (dt.datetime(2024, 1, 2, 12, 0),), (dt.datetime(2024, 1, 3, 0, 0),)],
        "ts timestamp_ntz")
    out = valid_dates(df, "ts", "2015-01-01", "2024-01-02")
    assert [r[0] for r in rows(out)] == [dt.datetime(2015, 1, 1), dt.datetime(2024, 1, 2, 12, 0)]


def test_recent_window_starts_two_months_back(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31),), (dt.datetime(2024, 4, 1),), (dt.datetime(2024, 6, 9),)],
                               "ts timestamp_ntz")
    assert rows(recent(df, "ts", 2, "2024-06-15")) == [(dt.datetime(2024, 4, 1),), (dt.datetime(2024, 6, 9),)]


def test_month_range_half_open_and_empty(spark):
    m = month_range(spark, 2015, 1, 2024, 8)
    assert m.count() == 115
    assert rows(m, "year_month")[0] == ("2015-01",) and rows(m, "year_month")[-1] == ("2024-07",)
    assert month_range(spark, 2020, 5, 2020, 3).count() == 0
    assert month_range(spark, 2020, 5, 2020, 5).count() == 0


# ------------------------------------------------------------------ dense keys
@pytest.mark.parametrize("dtype", ["bigint", "string", "date"])
def test_dense_key_buckets_equal_global_row_number(spark, dtype):
    base = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"))
    if dtype == "string":
        base = base.select(F.format_string("k%06d", "k").alias("k"))
    elif dtype == "date":
        base = base.select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("k").cast("int")).alias("k"))
    got = dense_key(base, "k", "sk", buckets=32)
    want = base.withColumn("sk", F.row_number().over(Window.orderBy("k")))
    assert rows(got, "k", "sk") == rows(want, "k", "sk")


@pytest.mark.parametrize("buckets", [2, 65])
@pytest.mark.parametrize("key", ["double(k) / 3", "cast(k as decimal(20, 3))", "to_timestamp_ntz(timestamp_seconds(k))", "concat_ws(',', 'a', k)"])
def test_dense_key_agrees_at_any_number_of_buckets(spark, key, buckets):
    base = spark.range(0, 700).select((F.col("id") * 7919 % 100003 - 400).alias("k")).select(F.expr(key).alias("k"))
    got = dense_key(base, "k", "sk", buckets=buckets)
    want = base.withColumn("sk", F.row_number().over(Window.orderBy("k")))
    assert rows(got, "k", "sk") == rows(want, "k", "sk")


def test_dense_key_buckets_follow_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_BUCKET", 100)
    asked, real = [], keys._boundaries
    monkeypatch.setattr(keys, "_boundaries", lambda df, key, n: asked.append(n) or real(df, key, n))
    for n in (0, 99, 100, 2000):
        out = dense_key(spark.range(n).select((F.col("id") * 3).alias("k")), "k", "sk")
        assert out.where("sk <> k / 3 + 1").count() == 0 and out.count() == n
    assert asked == [1, 1, 2, 21]
    monkeypatch.setattr(keys, "MAX_BUCKETS", 8)
    assert dense_key(spark.range(2000).select(F.col("id").alias("k")), "k", "sk").where("sk <> k + 1").count() == 0
    assert asked[-1] == 8


def test_dense_key_writes_its_input_down_only_if_large_or_changing(spark, monkeypatch):
    staged = []
    monkeypatch.setattr("strata.sinks.writer.stage", lambda df, name: staged.append(name) or df)
    small = spark.range(50).select(F.col("id").alias("k"))
    dense_key(small, "k", "sk")
    assert staged == []
    dense_key(small.withColumn("x", F.rand(3)), "k", "sk")
    dense_key(spark.range(1 << 30).select(F.col("id").alias("k")), "k", "sk", buckets=1)
    assert len(staged) == 2


def test_dense_key_plan_is_partitioned(spark):
    base = spark.range(0, 5000).select(F.col("id").alias("k"))
    plan = dense_key(base, "k", "sk", buckets=17)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(__sk_bucket" in plan


def test_dense_key_offset_and_type(spark):
    df = spark.createDataFrame([(5,), (1,), (3,)], "k int")
    out = dense_key(df, "k", "sk", offset=10)
    assert out.columns[0] == "sk" and dict(out.dtypes)["sk"] == "int"
    assert rows(out, "k", "sk") == [(1, 11), (3, 12), (5, 13)]


@pytest.mark.parametrize("data", [[(1,), (1,), (2,)], [(1,), (None,)]])
def test_dense_key_rejects_duplicate_or_null_keys(spark, data):
    df = spark.createDataFrame(data, "k int")
    with pytest.raises(Exception):
        dense_key(df, "k", "sk").collect()


# ------------------------------------------------------------------ dimensions
SEED = StructType([StructField("vendor_id", IntegerType()), StructField("description", StringType())])


def test_build_dimension_gaps_in_ids(spark):
    seed = spark.createDataFrame([(7, "d"), (1, "a"), (6, "c"), (2, "b")], SEED)
    dim = build_dimension(seed, "vendor_id", "vendor_sk")
    assert dim.columns == ["vendor_sk", "vendor_id", "description"]
    assert rows(dim) == [(1, 1, "a"), (2, 2, "b"), (3, 6, "c"), (4, 7, "d")]


def test_extend_dimension_keeps_old_keys(spark):
    old = build_dimension(spark.createDataFrame([(1, "a"), (6, "c")], SEED), "vendor_id", "vendor_sk")
    incoming = spark.createDataFrame([(1, "a"), (2, "b"), (6, "c"), (9, "z")], SEED)
    ext = extend_dimension(old, incoming, "vendor_id", "vendor_sk")
    assert rows(ext) == [(1, 1, "a"), (2, 6, "c"), (3, 2, "b"), (4, 9, "z")]


def test_extend_empty_dimension_starts_at_one(spark):
    empty = spark.createDataFrame([], "vendor_sk int, vendor_id int, description string")
    incoming = spark.createDataFrame([(4, "x"), (3, "y")], SEED)
    assert rows(extend_dimension(empty, incoming, "vendor_id", "vendor_sk")) == [(1, 3, "y"), (2, 4, "x")]


def test_duplicate_keys_reported(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SEED)
    assert rows(duplicate_keys(df, "vendor_id")) == [(1, 2)]


def test_date_dimension_columns(spark):
    b = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 3))], "lo date, hi date")
    d = {r["date"]: r for r in date_dimension(b).collect()}
    assert len(d) == 5
    r = d[dt.date(2024, 3, 2)]
    assert (r.date_key, r.quarter, r.month_name, r.day_of_week, r.day_name, r.is_weekend) == \
        (20240302, 1, "March", 7, "Saturday", True)
    assert d[dt.date(2024, 2, 29)].is_weekend is False


# -------------------------------------------------------------------- checks
def test_row_count_check(spark):
    src = spark.range(10)
    out = row_count_check(src, src.where("id < 4")).collect()[0]
    assert (out.source_rows, out.target_rows, out.passed) == (10, 4, True)
    bad = row_count_check(src.where("id < 4"), src).collect()[0]
    assert bad.passed is False
