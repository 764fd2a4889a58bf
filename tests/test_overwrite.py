"""Overwrites that die at any step, upserts that leave files alone, marts by changed days, checks by content, footers."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from strata.operators import runlog
from strata.operators.checks import differing_rows, reconcile
from strata.plans import fact
from strata.plans.dims import DimensionSpec, build_all
from strata.sinks import writer
from strata.sources.footers import group_by_schema
from strata.sources.landing import read_conformed
from strata.sources.paths import table_exists

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
DAY = "id string, v double, day date"


class Died(Exception):
    pass


def dies_at(step):
    def on_step(at):
        if at == step:
            raise Died(step)
    return on_step


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or sorted(df.columns))).collect()), key=str)


def frame(spark, data, schema=DAY):
    return spark.createDataFrame(data, schema)


OLD = [("a", 1.0, D1), ("b", 2.0, D1), ("c", 3.0, D2)]


def act(spark, kind, path, step):
    """One write of each kind; and what the table holds before and after it."""
    hook = {} if step is None else {"on_step": dies_at(step)}
    old = sorted(x[:2] for x in OLD)
    if kind == "overwrite":
        writer.write(frame(spark, [("z", 9.0, D3)]), path, "overwrite", ["day"], **hook)
        return old, [("z", 9.0)]
    if kind == "overwrite from itself":
        writer.write(spark.read.parquet(path).where("id <> 'a'"), path, "overwrite", ["day"], **hook)
        return old, [("b", 2.0), ("c", 3.0)]
    if kind == "partitions":
        writer.replace_partitions(frame(spark, [("y", 8.0, D1)]), path, ["day"], emptied=["day=2024-01-02", "day=2024-01-01"], **hook)
        return old, [("y", 8.0)]
    if kind == "upsert":
        writer.upsert(spark, frame(spark, [("a", 10.0, D1), ("n", 5.0, D3)]), path, ["id", "day"], ["day"], **hook)
        return old, [("a", 10.0), ("b", 2.0), ("c", 3.0), ("n", 5.0)]
    writer.upsert(spark, frame(spark, [("a", 10.0, D3)]), path, ["id"], ["day"], **hook)
    return old, [("a", 10.0), ("b", 2.0), ("c", 3.0)]


KINDS = ["overwrite", "overwrite from itself", "partitions", "upsert", "upsert that moves a row"]


@pytest.mark.parametrize("kind", KINDS)
def test_a_write_that_dies_leaves_the_old_or_the_new_table(spark, tmp_dir, kind):
    for step in (*writer.STEPS, None):
        path = f"{tmp_dir}/{step}"
        writer.write(frame(spark, OLD), path, "overwrite", ["day"])
        if step is None:
            old, new = act(spark, kind, path, None)
            assert rows(spark.read.parquet(path), "id", "v") == new and writer.pointer(spark, path) is None
            continue
        with pytest.raises(Died):
            act(spark, kind, path, step)
        old, new = OUTCOMES[kind]
        want = old if step == "staged" else new
        assert rows(writer.read_table(spark, path), "id", "v") == want
        assert writer.recover(spark, path) is (step != "staged") and writer.recover(spark, path) is False
        assert rows(spark.read.parquet(path), "id", "v") == want
        assert len(writer.leftovers(spark, path)) == (step == "staged")


_OLD = sorted(x[:2] for x in OLD)
OUTCOMES = {"overwrite": (_OLD, [("z", 9.0)]), "overwrite from itself": (_OLD, [("b", 2.0), ("c", 3.0)]), "partitions": (_OLD, [("y", 8.0)]),
            "upsert": (_OLD, [("a", 10.0), ("b", 2.0), ("c", 3.0), ("n", 5.0)]), "upsert that moves a row": (_OLD, [("a", 10.0), ("b", 2.0), ("c", 3.0)])}


@pytest.mark.parametrize("step", ["switched", "moved"])
def test_a_move_that_dies_half_way_is_finished(spark, tmp_dir, monkeypatch, step):
    writer.write(frame(spark, OLD), tmp_dir, "overwrite", ["day"])
    real, calls = writer.move, []

    def dies(spark, source, target):
        if "day=" in target:
            calls.append(target)
            if len(calls) == 2:
                raise Died
        real(spark, source, target)

    monkeypatch.setattr(writer, "move", dies)
    with pytest.raises(Died):
        writer.replace_partitions(frame(spark, [("x", 7.0, D1), ("y", 8.0, D2), ("z", 9.0, D3)]), tmp_dir, ["day"])
    monkeypatch.setattr(writer, "move", real)
    want = [("x", 7.0), ("y", 8.0), ("z", 9.0)]
    assert rows(writer.read_table(spark, tmp_dir), "id", "v") == want
    if step == "moved":
        writer.recover(spark, tmp_dir)
    writer.replace_partitions(frame(spark, [("w", 6.0, D3)]), tmp_dir, ["day"])  # the next write finishes the first
    assert rows(spark.read.parquet(tmp_dir), "id", "v") == [("w", 6.0), *want[:2]]


def test_stores_without_folder_renames_rewrite_from_the_staged_copy(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(writer, "renames_at_once", lambda spark, path: False)
    for kind in KINDS:
        path = f"{tmp_dir}/{kind.replace(' ', '-')}"
        writer.write(frame(spark, OLD), path, "overwrite", ["day"])
        assert rows(spark.read.parquet(path), "id", "v") == _OLD
        act(spark, kind, path, None)
        assert rows(spark.read.parquet(path), "id", "v") == OUTCOMES[kind][1]


@pytest.mark.parametrize("step", writer.STEPS)
def test_dimension_keys_survive_a_cut_off(spark, tmp_dir, step):
    spec = lambda ids: DimensionSpec("d", "k", "sk", lambda s: s.createDataFrame([(i,) for i in ids], "k int"), tmp_dir)
    build_all(spark, [spec([3, 1])])
    build_all(spark, [spec([3, 1, 2])])
    with pytest.raises(Died):
        build_all(spark, [spec([0, 1, 2, 3])], on_step=dies_at(step))
    assert rows(build_all(spark, [spec([0, 1, 2, 3])])["d"], "k", "sk") == [(0, 4), (1, 1), (2, 3), (3, 2)]
    assert rows(spark.read.parquet(tmp_dir), "k", "sk") == [(0, 4), (1, 1), (2, 3), (3, 2)]


def test_leftovers_of_an_unfinished_write_are_not_no_table(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/_temporary/0")
    with pytest.raises(RuntimeError, match="unfinished"):
        table_exists(spark, tmp_dir)
    spec = DimensionSpec("d", "k", "sk", lambda s: s.createDataFrame([(1,)], "k int"), tmp_dir)
    with pytest.raises(RuntimeError):
        build_all(spark, [spec])
    with pytest.raises(RuntimeError):
        writer.upsert(spark, frame(spark, OLD), tmp_dir, ["id", "day"], ["day"])


def test_compacting_the_log_that_dies_loses_no_row(spark, tmp_dir, monkeypatch):
    for i in range(4):
        runlog.record(spark, tmp_dir, id=i + 1, file_name=f"f{i}", source="s", destination="d", status="SUCCESS", load_type="x", layer="bronze")
    real = writer._move_in

    def dies(spark, new, path):
        writer.delete(spark, path)
        raise Died

    monkeypatch.setattr(writer, "_move_in", dies)
    with pytest.raises(Died):
        runlog.compact_log(spark, tmp_dir)
    monkeypatch.setattr(writer, "_move_in", real)
    assert rows(runlog.read_log(spark, tmp_dir), "file_name") == [(f"f{i}",) for i in range(4)]
    runlog.record(spark, tmp_dir, id=9, file_name="f9", source="s", destination="d", status="SUCCESS", load_type="x", layer="gold")
    assert runlog.read_log(spark, tmp_dir).count() == 5


def log(spark, path, i, layer="bronze", **how):
    runlog.append_log(runlog.log_rows(spark, [dict(id=i, file_name=f"f{i}", source="s", destination="d", status="SUCCESS", load_type="x", layer=layer)]), path, **how)


def logged_ids(spark, path):
    return sorted(r["id"] for r in runlog.read_log(spark, path).collect())


def test_the_log_is_merged_once_a_layer_has_many_appended_files(spark, tmp_dir):
    for i in range(1, 10):
        log(spark, tmp_dir, i, "bronze" if i % 3 else "gold", snapshot_files=3)
    assert logged_ids(spark, tmp_dir) == list(range(1, 10))
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{tmp_dir}/layer=bronze")) <= 4
    assert runlog.compact_log(spark, tmp_dir) and logged_ids(spark, tmp_dir) == list(range(1, 10))
    assert spark.read.parquet(tmp_dir).count() == 9  # a plain table, too


def test_an_append_during_a_merge_stays(spark, tmp_dir, monkeypatch):
    for i in (1, 2):
        log(spark, tmp_dir, i)
    real = writer._swap

    def later(spark, new, path, *rest):
        monkeypatch.setattr(writer, "_swap", real)
        log(spark, tmp_dir, 3)  # another driver, after the files to merge were read
        assert not runlog.compact_log(spark, tmp_dir)  # and it cannot merge at the same time
        real(spark, new, path, *rest)

    monkeypatch.setattr(writer, "_swap", later)
    assert runlog.compact_log(spark, tmp_dir)
    assert logged_ids(spark, tmp_dir) == [1, 2, 3]


@pytest.mark.parametrize("moved", [False, True])
def test_a_merge_that_is_cut_off_is_finished_by_the_next(spark, tmp_dir, monkeypatch, moved):
    for i in (1, 2, 3):
        log(spark, tmp_dir, i, "gold" if i == 3 else "bronze")
    real = writer.delete

    def dies(spark, path):
        if path.startswith(tmp_dir + "/"):
            raise Died  # merged files are in, the first of those replaced is about to go
        real(spark, path)

    monkeypatch.setattr(writer, "delete" if moved else "_move_in", dies if moved else lambda *a: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        runlog.compact_log(spark, tmp_dir)
    monkeypatch.undo()
    assert logged_ids(spark, tmp_dir) == [1, 2, 3]
    log(spark, tmp_dir, 4)
    assert logged_ids(spark, tmp_dir) == [1, 2, 3, 4]
    assert runlog.compact_log(spark, tmp_dir)
    assert logged_ids(spark, tmp_dir) == [1, 2, 3, 4] and spark.read.parquet(tmp_dir).count() == 4


# ------------------------------------------------------------ upsert by file
def file_times(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_upsert_without_partition_keys_replaces_only_files_with_its_keys(spark, tmp_dir, parts):
    df = spark.range(400).select("id", F.format_string("p%d", F.col("id") % 4).alias("p"), F.lit(0).alias("v"))
    writer.write(df.repartitionByRange(8, "id"), tmp_dir, "overwrite", parts, cluster=False)
    before = file_times(tmp_dir)
    changed = writer.upsert(spark, df.where("id in (3, 7)").withColumn("v", F.lit(1)).withColumn("p", F.lit("new")), tmp_dir, ["id"], parts)
    after = file_times(tmp_dir)
    gone = set(before) - set(after)
    assert 0 < len(gone) <= 2 and all(after[f] == t for f, t in before.items() if f not in gone)
    got = spark.read.parquet(tmp_dir)
    assert got.count() == 400 and rows(got.where("v = 1"), "id", "p") == [(3, "new"), (7, "new")]
    assert (changed is None) if not parts else rows(changed) == [("new",), ("p3",)]


def test_upsert_with_odd_partition_values(spark, tmp_dir):
    df = frame(spark, [(1, "a b:c"), (2, "x+y"), (3, "50%"), (4, None), (5, "1"), (6, "{q}")], "id int, p string").withColumn("v", F.lit(0))
    writer.write(df, tmp_dir, "overwrite", ["p"])
    for i in range(1, 7):
        writer.upsert(spark, df.where(F.col("id") == i).withColumn("v", F.lit(i)), tmp_dir, ["id"], ["p"])
    assert rows(spark.read.parquet(tmp_dir), "id", "p", "v") == [(1, "a b:c", 1), (2, "x+y", 2), (3, "50%", 3), (4, None, 4), (5, "1", 5), (6, "{q}", 6)]


def test_upsert_with_new_columns_reaches_every_file(spark, tmp_dir):
    writer.write(frame(spark, OLD), tmp_dir, "overwrite", ["day"])
    writer.upsert(spark, frame(spark, [("a", 5.0, D1, "x")], DAY + ", extra string"), tmp_dir, ["id", "day"], ["day"])
    assert rows(spark.read.parquet(tmp_dir), "id", "extra") == [("a", "x"), ("b", None), ("c", None)]


# -------------------------------------------------------------- changed days
def test_mart_days_replaces_changed_days_and_drops_empty_ones(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(fact, "build_mart", lambda f, dims: f.groupBy(F.col("day").alias("activity_date")).agg(F.sum("v").alias("v")))
    monkeypatch.setattr(fact.model, "MART_PARTITION", ["activity_date"])
    table = frame(spark, OLD).withColumn("partition_day", F.col("day"))
    fact.mart_job(table, {}, tmp_dir)
    days = frame(spark, [(D2,), (D3,), (D3,), (None,)], "partition_day date")
    fact.mart_days(frame(spark, [("a", 100.0, D1), ("n", 7.0, D3)]).withColumn("partition_day", F.col("day")), {}, tmp_dir, days)
    assert rows(spark.read.parquet(tmp_dir), "activity_date", "v") == [(D1, 3.0), (D3, 7.0)]


# ------------------------------------------------------------ content checks
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3))), max_size=12), st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3))), max_size=12))
def test_reconcile_sees_what_multisets_differ_in(spark, left, right):
    from collections import Counter

    a, b = (spark.createDataFrame(x, "g int, v int") for x in (left, right))
    got = {r.g: r.status for r in reconcile(a, b, ["g"], ["v"]).collect()}
    want = {}
    for g in {x[0] for x in left + right}:
        l, r = (Counter(v for k, v in side if k == g) for side in (left, right))
        n, m = sum(l.values()), sum(r.values())
        want[g] = "lost" if m < n else "extra" if m > n else "same" if l == r else "changed"
    assert got == want
    odd = {(r.g, r.v): r.surplus for r in differing_rows(a, b, ["g"], ["v"]).collect()}
    diff = Counter(right)
    diff.subtract(Counter(left))
    assert odd == {k: n for k, n in diff.items() if n}


def test_reconcile_of_null_groups_and_empty_sides(spark):
    a = spark.createDataFrame([(None, 1.0), (None, None), (1, -0.0)], "g int, v double")
    b = spark.createDataFrame([(None, None), (None, 1.0), (1, 0.0)], "g int, v double")
    assert {r.status for r in reconcile(a, b, ["g"], ["v"]).collect()} == {"same"}
    assert {r.status for r in reconcile(a, b.limit(0), ["g"], ["v"]).collect()} == {"lost"}
    assert reconcile(a.limit(0), b.limit(0), ["g"], ["v"]).count() == 0


# ------------------------------------------------------------------- footers
def test_files_of_many_schemas_are_grouped_in_one_job(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for i in range(300):
        os.makedirs(f"{tmp_dir}/year_month={i:04d}")
        for k in range(2 if i == 7 else 1):
            kind = pa.float64() if i % 3 == 0 or k else pa.int64()
            cols = {"ID": pa.array([i], pa.int64()), "fare": pa.array([1.0], kind) if kind == pa.float64() else pa.array([1], kind)}
            pq.write_table(pa.table(cols if i % 5 else dict(reversed(cols.items()))), f"{tmp_dir}/year_month={i:04d}/part-{k}.parquet")
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        groups = group_by_schema(spark, [tmp_dir])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3 and sorted(map(len, groups)) == [101, 200]
    df = read_conformed(spark, [f"{tmp_dir}/year_month={i:04d}" for i in range(300)], {"id": LongType(), "fare": DoubleType()}, base_path=tmp_dir)
    assert df.count() == 301 and rows(df.agg(F.sum("id"), F.sum("fare")))[0] == (301.0, sum(range(300)) + 7)


def test_no_file_at_all_is_an_error(spark, tmp_dir):
    os.makedirs(tmp_dir)
    with pytest.raises(FileNotFoundError):
        read_conformed(spark, [tmp_dir], {"id": LongType()})
