"""What must hold when something goes wrong: read errors, swaps cut off, missing and bad months, no shared folder."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from strata.operators import claims, runlog
from strata.operators.dimensions import build_dimension, extend_dimension
from strata.operators.lookup import Lookup, lookup_keys
from strata.plans.dims import DimensionSpec, build_all
from strata.plans.ingest import ingest
from strata.session import ensure_checkpoint_dir
from strata.sinks import writer
from strata.sources.catalog import Catalog
from strata.sources.months import month_range
from strata.sources.partitions import partitions

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def days(spark, data):
    return spark.createDataFrame(data, "id string, v double, day date")


def test_overwrite_drops_stale_partitions_whatever_the_session_says(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        writer.write(days(spark, [("a", 1.0, D1), ("b", 2.0, D2)]), tmp_dir, "overwrite", ["day"])
        writer.write(days(spark, [("c", 3.0, D1)]), tmp_dir, "overwrite", ["day"])
        assert rows(spark.read.parquet(tmp_dir), "id") == [("c",)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_upsert_moves_a_row_between_partitions(spark, tmp_dir):
    schema = "id int, v string, p string"
    writer.write(spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], schema), tmp_dir, "overwrite", ["p"])
    writer.upsert(spark, spark.createDataFrame([(1, "a2", "p2")], schema), tmp_dir, ["id"], ["p"])
    assert rows(spark.read.parquet(tmp_dir), "id", "v", "p") == [(1, "a2", "p2"), (2, "b", "p2")]


def test_upsert_raises_on_a_table_it_cannot_read(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/day=2024-01-01")
    broken = f"{tmp_dir}/day=2024-01-01/part-0.parquet"
    open(broken, "wb").write(b"not parquet")
    for keys, parts in ((["id", "day"], ["day"]), (["id"], ["day"])):
        with pytest.raises(Exception):
            writer.upsert(spark, days(spark, [("a", 1.0, D1)]), tmp_dir, keys, parts)
        assert open(broken, "rb").read() == b"not parquet" and os.listdir(tmp_dir) == ["day=2024-01-01"]


def test_dimension_raises_on_a_table_it_cannot_read(spark, tmp_dir):
    import os

    os.makedirs(tmp_dir)
    open(f"{tmp_dir}/part-0.parquet", "wb").write(b"not parquet")
    spec = DimensionSpec("d", "k", "sk", lambda s: s.createDataFrame([(1,)], "k int"), tmp_dir)
    with pytest.raises(Exception):
        build_all(spark, [spec])
    assert open(f"{tmp_dir}/part-0.parquet", "rb").read() == b"not parquet"


@pytest.mark.parametrize("keys", [["id", "day"], ["id"]])
def test_a_swap_cut_off_after_the_delete_loses_no_row(spark, tmp_dir, monkeypatch, keys):
    import shutil

    writer.write(days(spark, [("a", 1.0, D1), ("b", 2.0, D1), ("c", 3.0, D2)]), tmp_dir, "overwrite", ["day"])
    real = writer._save

    def dies(df, path, mode, parts, fmt, overwrite, cluster=True):
        if path == tmp_dir:
            shutil.rmtree(f"{tmp_dir}/day=2024-01-01")  # the old files are gone, the new ones not in
            raise RuntimeError("executor lost")
        real(df, path, mode, parts, fmt, overwrite, cluster)

    monkeypatch.setattr(writer, "_save", dies)
    with pytest.raises(RuntimeError):
        writer.upsert(spark, days(spark, [("a", 10.0, D1)]), tmp_dir, keys, ["day"])
    monkeypatch.setattr(writer, "_save", real)
    writer.upsert(spark, days(spark, [("d", 4.0, D3)]), tmp_dir, keys, ["day"])  # finishes the first swap before its own
    assert rows(spark.read.parquet(tmp_dir), "id", "v") == [("a", 10.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)]
    assert writer.recover(spark, tmp_dir) is False


def test_upsert_source_is_evaluated_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    writer.write(days(spark, [("a", 1.0, D1)]), tmp_dir, "overwrite", ["day"])
    source = days(spark, [("a", 2.0, D1), ("b", 3.0, D2)]).mapInArrow(count, "id string, v double, day date")
    writer.upsert(spark, source, tmp_dir, ["id", "day"], ["day"])
    assert seen.value == 2


def test_missing_and_bad_months_fail_alone(spark, tmp_dir):
    import os

    landing, target, log = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/log"
    for ym in ("2024-01", "2024-03", "2024-04"):
        spark.createDataFrame([(int(ym[-1]), 1.5)], "id long, fare double").write.parquet(f"{landing}/year_month={ym}")
    for f in os.listdir(f"{landing}/year_month=2024-03"):
        os.remove(f"{landing}/year_month=2024-03/{f}")
    open(f"{landing}/year_month=2024-03/part-0.parquet", "wb").write(b"no" * 50)
    args = (month_range(spark, 2024, 1, 2024, 5), landing, target, {"id": LongType(), "fare": DoubleType()}, log, "trips")
    assert ingest(spark, *args) == ["2024-01", "2024-04"]
    got = rows(runlog.read_log(spark, log).where("status <> 'UPLOADING'"), "file_name", "status")
    assert got == [("trips_2024-01.parquet", "SUCCESS"), ("trips_2024-02.parquet", "FAILED"),
                   ("trips_2024-03.parquet", "FAILED"), ("trips_2024-04.parquet", "SUCCESS")]
    uploading = runlog.read_log(spark, log).where("status = 'UPLOADING'")
    assert uploading.count() == 4
    assert (f"{landing}/year_month=2024-04", f"{target}/year=2024/month=4/") in rows(uploading, "source", "destination")
    assert rows(spark.read.parquet(target), "id") == [(1,), (4,)]
    spark.createDataFrame([(2, 2.5)], "id long, fare double").write.parquet(f"{landing}/year_month=2024-02")
    assert ingest(spark, *args) == ["2024-02"]  # failed months stay pending


def test_rejected_rows_are_set_aside_and_counted_by_the_writing_pass(spark, tmp_dir):
    landing, target, rejects, counts = (f"{tmp_dir}/{n}" for n in ("landing", "bronze", "rejects", "counts"))
    land = lambda ym, data, types: spark.createDataFrame(data, types).write.mode("overwrite").parquet(f"{landing}/year_month={ym}")
    land("2024-01", [(1, "1.5"), (2, "bad"), (3, None), (None, "worse")], "ID long, fare string")
    land("2024-02", [(4, 2.5)], "id int, fare double")
    land("2024-03", [(5, "no")], "id long, fare string")
    months, schema = month_range(spark, 2024, 1, 2024, 4), {"id": LongType(), "fare": DoubleType(), "tip": DoubleType()}
    how = dict(rejects=rejects, counts=counts)
    assert ingest(spark, months, landing, target, schema, f"{tmp_dir}/log", "t", **how) == ["2024-01", "2024-02", "2024-03"]
    assert rows(spark.read.parquet(target), "id", "fare", "tip", "month") == [(1, 1.5, None, 1), (3, None, None, 1), (4, 2.5, None, 2)]
    assert set(spark.read.parquet(target).columns) == {"id", "fare", "tip", "year", "month"}
    bad = spark.read.parquet(rejects).orderBy("month", "landed_row").collect()
    assert [([tuple(x) for x in r.rejected], r.month) for r in bad] == [([("fare", "bad")], 1), ([("fare", "worse")], 1), ([("fare", "no")], 3)]
    assert all(f"year_month=2024-0{r.month}/" in r.source_file for r in bad)
    assert '"ID":2' in bad[0].landed_row and '"ID":null' in bad[1].landed_row
    got = {(r.item, r.metric): r.rows for r in spark.read.parquet(counts).collect()}
    assert [got["t_2024-01.parquet", m] for m in ("rows_in", "rows_out", "rejected")] == [4, 2, 2]
    assert [got["t_2024-03.parquet", m] for m in ("rows_in", "rows_out", "rejected")] == [1, 0, 1]
    assert (got["fare", "cast_failed"], got["id", "cast_failed"], got["tip", "cast_failed"]) == (3, 0, 0)
    # mended and loaded again: neither old rejects nor old rows stay
    land("2024-01", [(1, "1.5"), (2, "2.0")], "ID long, fare string")
    land("2024-03", [(5, "no"), (6, "no")], "id long, fare string")
    assert len(ingest(spark, months, landing, target, schema, f"{tmp_dir}/log2", "t", **how)) == 3
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,), (4,)]
    assert rows(spark.read.parquet(rejects), "month") == [(3,), (3,)]


def test_counts_need_no_further_scan(spark, tmp_dir):
    """The landed rows are read once: rows read by an ingest that counts are those of one that does not."""
    seen = {}
    spark.range(1000).selectExpr("id", "cast(id AS string) AS fare").write.parquet(f"{tmp_dir}/landing/year_month=2024-01")
    for name, how in (("plain", {}), ("counted", dict(counts=f"{tmp_dir}/counts", rejects=f"{tmp_dir}/rejects"))):
        group = f"{name}-{tmp_dir}"
        spark.sparkContext.setJobGroup(group, name)
        ingest(spark, month_range(spark, 2024, 1, 2024, 2), f"{tmp_dir}/landing", f"{tmp_dir}/{name}", {"id": LongType(), "fare": DoubleType()}, f"{tmp_dir}/log-{name}", "t", **how)
        seen[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("none", "none")
    assert seen["counted"] <= seen["plain"] + 2  # the append of the counts; the rebalance reports its sizes as before
    assert not os.path.exists(f"{tmp_dir}/rejects")


def test_claims_go_to_one_driver_and_pass_on_when_they_end(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    folder, names = f"{tmp_dir}/claims", [f"m{k}" for k in range(20)]
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda _: claims.take(spark, folder, names, 60, now=1000.0), range(4)))
    assert sorted(c.name for t in taken for c in t) == sorted(names)  # each month to exactly one
    assert claims.take(spark, folder, names, 60, now=1059.0) == []
    first = [c for t in taken for c in t]
    with ThreadPoolExecutor(4) as pool:
        later = [c for t in pool.map(lambda _: claims.take(spark, folder, names, 60, now=1061.0), range(4)) for c in t]
    assert sorted(c.name for c in later) == sorted(names) and all(c.generation == 2 for c in later)
    assert sorted(claims.lost(spark, folder, first, now=1030.0)) == sorted(names)
    claims.release(spark, folder, first)  # a late driver takes nothing from its successor
    assert claims.lost(spark, folder, later, now=1062.0) == [] and claims.take(spark, folder, names, 60, now=1062.0) == []
    claims.release(spark, folder, later)
    assert os.listdir(folder) == [] or all(n.startswith(".") for n in os.listdir(folder))


def test_two_drivers_share_the_months(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    for m in range(1, 5):
        spark.createDataFrame([(m,)], "id long").write.parquet(f"{tmp_dir}/landing/year_month=2024-0{m}")
    args = (month_range(spark, 2024, 1, 2024, 5), f"{tmp_dir}/landing", f"{tmp_dir}/bronze", {"id": LongType()}, f"{tmp_dir}/log", "t")
    with ThreadPoolExecutor(2) as pool:
        loaded = [ym for done in pool.map(lambda _: ingest(spark, *args, claims=f"{tmp_dir}/claims"), range(2)) for ym in done]
    assert sorted(loaded) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert rows(spark.read.parquet(f"{tmp_dir}/bronze"), "id") == [(1,), (2,), (3,), (4,)]


def test_a_load_whose_claim_ran_out_replaces_nothing(spark, tmp_dir):
    spark.createDataFrame([(1,)], "id long").write.parquet(f"{tmp_dir}/landing/year_month=2024-01")
    args = (month_range(spark, 2024, 1, 2024, 2), f"{tmp_dir}/landing", f"{tmp_dir}/bronze", {"id": LongType()}, f"{tmp_dir}/log", "t")
    with pytest.raises(claims.ClaimLost):
        ingest(spark, *args, claims=f"{tmp_dir}/claims", claim_seconds=0.01)
    assert not os.path.exists(f"{tmp_dir}/bronze")
    assert ingest(spark, *args, claims=f"{tmp_dir}/claims") == ["2024-01"]


def test_partition_values_are_unescaped_and_null(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a b:c"), (2, None), (3, "x+y"), (4, "2024-01-01")], "id int, p string")
    df.write.partitionBy("p").parquet(tmp_dir)
    assert {r["p"] for r in partitions(spark, tmp_dir).collect()} == {"a b:c", None, "x+y", "2024-01-01"}


def test_calendar_dimension_has_no_surrogate_key_and_grows(spark, tmp_dir):
    spec = lambda n: DimensionSpec("dim_date", "date_key", None, lambda s: s.range(n).select(F.col("id").alias("date_key"), F.lit("x").alias("l")),
                                   f"{tmp_dir}/d", source="calendar")
    build_all(spark, [spec(3)], log_path=f"{tmp_dir}/log")
    out = build_all(spark, [spec(5)], log_path=f"{tmp_dir}/log")["dim_date"]
    assert out.columns == ["date_key", "l"] and rows(out, "date_key") == [(i,) for i in range(5)]
    assert rows(runlog.read_log(spark, f"{tmp_dir}/log"), "status") == [("SUCCESS",)] * 2 + [("UPLOADING",)] * 2


def test_registry_from_a_file(spark, tmp_dir):
    import os

    os.makedirs(tmp_dir)
    with open(f"{tmp_dir}/datasets.json", "w") as f:
        json.dump({"a": {"path": "{root}/a", "layer": "bronze", "mode": "append"}, "b": {"path": "{root}/b", "enabled": False, "depends_on": ["a"]}}, f)
    spark.range(4).write.parquet(f"{tmp_dir}/a")
    cat = Catalog.from_file(spark, f"{tmp_dir}/datasets.json", tmp_dir)
    assert [d.name for d in cat.enabled()] == ["a"] and cat["a"].mode == "append"
    assert cat.load_dependencies(spark, "b")["a"].count() == 4


def test_repeated_log_rows_of_a_retried_batch_count_once(spark, tmp_dir):
    row = runlog.log_rows(spark, [dict(id=7, file_name="f", source="s", destination="d", status="SUCCESS", load_type="stream", layer="bronze")])
    runlog.append_log(row, tmp_dir)
    runlog.append_log(row, tmp_dir)
    assert runlog.read_log(spark, tmp_dir).count() == 1


def test_no_shared_folder_is_an_error_off_one_machine(spark):
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_key_is_the_bucket_plan_at_every_size(spark):
    for n in (3, 5000):
        p = _plan(build_dimension(spark.range(n).withColumnRenamed("id", "k"), "k", "sk"))
        assert "hashpartitioning(__sk_bucket" in p and "SinglePartition" not in p
    keyed = build_dimension(spark.range(5000).select((F.col("id") * 7 % 5000).alias("k")), "k", "sk")
    assert keyed.where("sk <> k + 1").count() == 0
    named = build_dimension(spark.range(300).select(F.format_string("n%04d", "id").alias("k")), "k", "sk")
    assert named.where("int(substring(k, 2, 4)) + 1 <> sk").count() == 0
    more = extend_dimension(keyed.limit(0), spark.range(0).withColumnRenamed("id", "k"), "k", "sk")
    assert more.count() == 0


def test_no_job_runs_while_a_lookup_is_planned(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        dim = spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 1).alias("sk"))
        looked = lookup_keys(spark.range(1000).select((F.col("id") % 300).alias("fk")), [Lookup(dim, "k", "sk", "fk")])
        assert "BroadcastHashJoin" in _plan(looked)
        assert list(jobs.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


