"""The corpus pipeline: documents -> language ID -> near duplicates -> decontamination -> mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written to the shared folder and reread as the next stage's ``docs``, so a lost
executor never costs more than the stage it was in. All stages but the last
return the columns of ``documents`` for the documents they keep; the last
returns the mix: doc_id, source, size, source_size, target and taken (words
drawn, repeats counted; 0 for a document that is not drawn) and first_at.

Defined cases: a null or letterless text is rejected by the first stage, which
fills in a null ``lang``; rows
repeating an id and a text are one document after the second; extra columns
travel along through the filtering stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, jaccard_join, langid, mixing
from strata.llm.common import crc_mod, maybe_in
from strata.session import scratch_path
from strata.sinks.writer import stage

# Languages whose documents stay; None: every language that was learnt.
KEPT_LANGUAGES: frozenset[str] | None = None
# A step's bound is this share of the least that it gives any document whose label it finds again.
BOUND_SHARE = 0.5
# The product of both steps has no bound of its own.
MIN_LANGUAGE_SCORE = 0.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, kept: Collection[str] | None = KEPT_LANGUAGES) -> DataFrame:
    """Drop documents in no language that was learnt (or none of ``kept``); a null ``lang`` becomes the prediction.

    Rejected are texts without a letter, predictions outside ``kept``, and texts
    for which the family step or the step within the family is less sure than
    ``BOUND_SHARE`` of the least that it is for any labelled document which it
    gets right: those bounds are taken over all labelled rows, so none of them falls.
    """
    model = langid.train(docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    told = stage(docs.withColumn("__lang", langid.identify(model)), "pipeline-languages")
    right = told.where(F.col("lang") == F.col("__lang.lang"))
    least = right.agg(F.min("__lang.family_score").alias("f"), F.min("__lang.language_score").alias("l")).first()
    sure = (F.col("__lang.family_score") >= BOUND_SHARE * (least["f"] or 0.0)) & (F.col("__lang.language_score") >= BOUND_SHARE * (least["l"] or 0.0))
    wanted = F.col("__lang.lang") != langid.UNDETERMINED
    if kept is not None:
        wanted = wanted & F.col("__lang.lang").isin(*kept)
    return (told.where(wanted & sure & (F.col("__lang.score") >= MIN_LANGUAGE_SCORE))
            .withColumn("lang", F.coalesce("lang", "__lang.lang")).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of linked documents.

    Only rows whose id may be dropped (or is repeated) are shuffled: a bitmap
    of bounded size lets all others pass as they are read.
    """
    groups = stage(jaccard_join.join(docs).select("doc_id", "component_id"), "pipeline-groups")
    by_id = groups.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("__keep"), F.count(F.lit(1)).alias("__n"))
    touched = stage(by_id.where("not __keep or __n > 1").select("doc_id", "__keep"), "pipeline-touched")
    seen = maybe_in(docs, "doc_id", touched)
    rest = seen.where("not __maybe or doc_id is null").drop("__maybe")
    judged = seen.where("__maybe and doc_id is not null").drop("__maybe").join(touched, "doc_id", "left")
    repeated = judged.where("__keep").drop("__keep").dropDuplicates(["doc_id", "text"])
    untouched = judged.where("__keep is null").drop("__keep")
    return rest.unionByName(repeated).unionByName(untouched).select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    found = decontaminate.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("__hits.spans") == 0).drop("__hits")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix over what is left."""
    return mixing.mix(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("benchmark_free", benchmark_free), ("mix", mix)]
# The language model is fitted, which SQL cannot express; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
