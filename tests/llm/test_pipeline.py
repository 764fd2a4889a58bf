"""The corpus pipeline against a brute-force version on a small table, and its edge cases."""

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.common import crc_mod
from tests.conftest import SF_SMALL
from tests.llm.test_operators import DOC, edge_docs, empty_docs, plain_components, plain_hits


def test_pipeline_keeps_what_brute_force_keeps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    model = langid.train(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    told = {i: model.predict(r.text) for i, r in rows.items()}
    left = {i: r for i, r in rows.items() if told[i][0] != "und" and told[i][1] >= corpus_pipeline.MIN_LANGUAGE_SCORE}
    comp = plain_components([(i, r.text) for i, r in left.items()])
    left = {i: r for i, r in left.items() if comp[i][1] == i}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    left = {i: r for i, r in left.items() if not plain_hits(r.text, items)[1]}
    assert set(got) == set(left)
    assert all(got[i].size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) and got[i].taken <= 3 * got[i].size for i, r in left.items())
    taken, target = Counter(), {}
    for r in got.values():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 4 + 0.01 * target[s] for s in target)


def test_stages_keep_columns_and_take_odd_rows(spark):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [4, None]
    for docs, n in ((edge_docs(spark), 4), (empty_docs(spark), 0)):
        at = docs
        for _, step in corpus_pipeline.STAGES[:3]:
            at = step(spark, at, SF_SMALL)
            assert at.columns == docs.columns
        assert at.count() == n
        assert corpus_pipeline.STAGES[3][1](spark, at, SF_SMALL).count() == n


def test_short_texts_of_a_learnt_language_stay(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    short = [(10_000_000 + i, t, None, "s", len(t)) for i, t in enumerate("a de la un en die in es la le on des an es un de".split())]
    docs = docs.unionByName(spark.createDataFrame(short, DOC))
    told = docs.where(F.col("text").rlike(r"\p{L}"))
    kept = corpus_pipeline.language_id(spark, docs, SF_SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in told.collect())


def test_one_of_each_group_stays(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(3, text, "en", "s", 0), (2, text.upper(), "en", "s", 0), (2, text.upper(), "en", "s", 0), (9, "other words", "en", "s", 0), (None, text, "en", "s", 0)], DOC)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()
    assert sorted((str(r.doc_id) for r in kept)) == ["2", "9", "None"]
