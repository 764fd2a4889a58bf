"""Language identification: whole texts, letters, unlisted languages; and what the pipeline's first stage makes of it."""

import corpus_pipeline
from pyspark.sql import functions as F

from strata.llm import langid
from tests.conftest import SF_SMALL

ROWS = "doc_id long, text string, lang string"
WORDS = {"aa": "bala boro kuku zemu", "ab": "bala boro kuki zema", "zz": "thwix prynt glorph skree"}


def rows(spark, n=30, names=WORDS):
    return spark.createDataFrame([(100 * k + i, f"{w} {w.split()[i % 4]} " * 3, lang) for k, (lang, w) in enumerate(names.items()) for i in range(n)], ROWS)


def test_the_end_of_a_long_text_is_learnt_from(spark):
    head = "common menu licence words " * 200  # 5,200 characters that all share
    df = rows(spark).withColumn("text", F.concat(F.lit(head), F.repeat("text", F.lit(40))))
    model = langid.train(df)
    assert {r.lang: r.l.lang for r in df.select("lang", langid.identify(model).alias("l")).collect()} == {k: k for k in WORDS}


def test_only_letters_are_letters(spark):
    model = langid.train(rows(spark))
    for text in ("½ ②", "Ⅷ", "² 3", "_ __", "12 ٣", "", " \n", "́"):
        assert model.predict(text) == ("und", 0.0), text
    for text in ("½ a", "ª", "日", "ß 3"):
        assert model.predict(text)[0] in WORDS


def test_unlisted_languages_join_the_nearest_family(spark):
    model = langid.train(rows(spark))
    assert sorted(map(sorted, model.families.values())) == [["aa", "ab"], ["zz"]]
    assert ("aa", "ab") in model.language_pairs and len(model.family_pairs) == 1


def test_stage_keeps_labelled_rows_fills_labels_and_drops_the_rest(spark):
    df = rows(spark).withColumn("more", F.lit("x"))
    odd = spark.createDataFrame([(9001, "½ ② 12", "aa", "x"), (9002, None, "aa", "x"), (9003, "bala boro kuku zemu bala", None, "x")], ROWS + ", more string")
    kept = corpus_pipeline.language_id(spark, df.unionByName(odd), SF_SMALL)
    got = {r.doc_id: r.lang for r in kept.collect()}
    assert set(got) == {r.doc_id for r in df.collect()} | {9003} and got[9003] == "aa" and kept.columns == [*df.columns]
    only = corpus_pipeline.language_id(spark, df.unionByName(odd), SF_SMALL, kept={"zz"})
    assert {r.lang for r in only.collect()} == {"zz"} and only.count() == 30


def test_stage_matches_brute_force_on_the_table(spark):
    from strata.llm.common import crc_mod

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    told = {r.doc_id: (r.lang, *model.steps(r.text)) for r in docs.collect()}
    right = [t for t in told.values() if t[0] == t[1]]
    f, w = (0.5 * min(t[i] for t in right) for i in (2, 3))
    want = {i for i, t in told.items() if t[1] != "und" and t[2] >= f and t[3] >= w}
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()} == want
    assert len(right) > 0.9 * sum(t[0] is not None for t in told.values())
