"""What keeps the pipeline's driver small: few exchanges, each of which takes a thread and a new plan there."""

import random

import pytest

from strata.llm import jaccard_join, mixing
from strata.llm.components import components
from tests.llm.test_operators import DOC


def plain_stars(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    return {x: top(x) for x in root if top(x) != x}


@pytest.mark.parametrize("run", [1, 7, 1 << 20])
def test_components_in_runs_of_any_length(spark, run):
    rng = random.Random(run)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(20)] + [(5, 5), (8, None)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(5), run).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.comp for r in got} == plain_stars([x for x in links if None not in x])


def jobs_of(spark, name, f):
    spark.sparkContext.setJobGroup(name, name)
    try:
        f()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_few_links_take_few_jobs(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert jobs_of(spark, "chain", lambda: components(chain)) <= 10


def test_the_join_ends_when_every_family_is_connected(spark, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[:60 + i % 3]), "en", "s", 0) for i in range(12)]
    told, pairs = [], jaccard_join.family_pairs
    monkeypatch.setattr(jaccard_join, "family_pairs", lambda *a: told.append(pairs(*a)) or told[-1])
    got = jaccard_join.join(spark.createDataFrame(docs, DOC)).collect()
    assert {r.component_id for r in got} == {0}
    assert len(told) == 2 and told[1] is None


def test_the_schedule_of_a_mix_is_a_plan_of_its_own(spark):
    docs = spark.createDataFrame([(i, "a b c d " * (1 + i % 5), "en", f"s{i % 3}", 0) for i in range(60)], DOC)
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("Exchange ") + plan.count("BroadcastExchange ") <= 12


def test_the_slots_drawn_are_computed_once(spark):
    docs = spark.createDataFrame([(i, "a b c d " * (1 + i % 5), "en", f"s{i % 3}", 0) for i in range(60)], DOC)
    drawn = mixing.draws(mixing.cut(mixing.targets(mixing.sizes(docs))), 3)
    assert 0 < drawn._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 5
