"""The registered queries: each operator over its whole table, with production parameters.

Each takes (spark, sf_dir) and derives the digest columns of its contract from
the operator's own output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (ann, ball_tree, decontaminate, html_extract, jaccard_join, langid, lm_score, mixing, repair, token_counts, url_filter, warc,
                        whitening)
from strata.llm.common import crc_mod
from strata.session import scratch_path
from strata.sinks.writer import stage

URL_RULES = [url_filter.UrlRule("block", "net"), url_filter.UrlRule("allow", "example.net", "/en/"),
             url_filter.UrlRule("block", "example.com", "/de/"), url_filter.UrlRule("allow", "org", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = langid.train(docs.where("not held_out"))
    lang = langid.identify(model)
    return docs.select("doc_id", "held_out", lang.alias("l")).select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = warc.mark_revisits(_table(spark, sf_dir, "pages"))
    archives = stage(warc.write_archives(marked, _folder(spark, "warc")), "warc-archives")
    return warc.read_archives(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"), _folder(spark, "tokens"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(_table(spark, sf_dir, "documents"), _folder(spark, "token-files"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_mixing, op3_decontaminate, op4_html_text, op5_langid, op6_warc,
                                   op7_jaccard_join, op8_lm_score, op9_nearest, op10_token_counts, op11_whitening, op12_ranked_search,
                                   op13_token_files)}
