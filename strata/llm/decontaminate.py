"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``WINDOW`` consecutive words of every
benchmark item (an item of fewer words is one shorter pattern). Patterns of
one length form a machine: a shift table says, for the two words under the end
of the search window, how far the search may jump without missing any pattern;
where it may not jump, the bucket of that word pair (keyed again by the first
words) holds the few patterns to compare word by word.

The machines travel to the tasks in chunks of benchmark items of at most
``max_chunk_bytes`` of text each: a larger benchmark makes several passes over
a written copy of the documents, whose hits are united per document, so no size
of benchmark is cut short or fills a worker's memory.

Defined cases: null or wordless texts have no words and no hits; repeated
documents are judged each; repeated item ids count once; a null item id reads
as ``null``; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import utf8
from strata.sinks.writer import stage

WINDOW = 10
MAX_CHUNK_BYTES = 2 << 20  # some 300,000 patterns, 300 MB of tables in a worker
# Bytes of words: digits, letters (A-Z folded) and everything beyond ASCII; the rest becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_HITS = T.StructType([T.StructField("n_words", T.LongType()),
                      T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
                      T.StructField("items", T.ArrayType(T.StringType()))])


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Machine:
    """Wu-Manber tables for patterns of ``m`` words each."""

    def __init__(self, m: int, patterns: dict[tuple, set[str]]):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for p, items in patterns.items():
            for j in range(self.block, m + 1):
                key = p[j - self.block:j]
                self.shift[key] = min(self.shift.get(key, self.far), m - j)
            self.buckets.setdefault(p[m - self.block:], {}).setdefault(p[:self.block], []).append((p, items))

    def scan(self, w: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        m, far, n = self.m, self.far, len(w)
        shift, at = self.shift.get, m
        if self.block == 1:
            for i, x in enumerate(w):
                if (x,) in self.shift:
                    self._compare(w, i + 1, (x,), spans, items)
            return
        while at <= n:
            key = (w[at - 2], w[at - 1])
            jump = shift(key, far)
            if jump:
                at += jump
                continue
            self._compare(w, at, key, spans, items)
            at += 1

    def _compare(self, w: list[bytes], end: int, key: tuple, spans: list, items: set) -> None:
        first = end - self.m
        for p, who in self.buckets[key].get(tuple(w[first:first + self.block]), ()):
            if tuple(w[first:end]) == p:
                spans.append((first, end - 1))
                items.update(who)


def machines(rows: list[tuple[str, bytes]], window: int) -> list[Machine]:
    by_length: dict[int, dict[tuple, set[str]]] = {}
    for item, text in rows:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            by_length.setdefault(m, {}).setdefault(tuple(w[i:i + m]), set()).add(item)
    return [Machine(m, p) for m, p in sorted(by_length.items())]


def _united(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "last": b} for a, b in out]


def _search(spark, chunk: list[tuple[str, bytes]], window: int):
    sent = spark.sparkContext.broadcast(chunk)

    @F.pandas_udf(_HITS)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        built = machines(sent.value, window)
        for batch in texts:
            n, all_spans, all_items = [], [], []
            for text in batch:
                w, spans, items = words(text), [], set()
                for m in built:
                    m.scan(w, spans, items)
                n.append(len(w))
                all_spans.append(_united(spans))
                all_items.append(sorted(items))
            yield pd.DataFrame({"n_words": n, "spans": all_spans, "items": all_items})

    return hits


def _chunks(benchmark: DataFrame, max_chunk_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), utf8(F.col("text")).alias("t"))
    chunk, held = [], 0
    for r in rows.toLocalIterator():  # one partition at a time; a chunk is all that stays
        if chunk and held + len(r["t"]) > max_chunk_bytes:
            yield chunk
            chunk, held = [], 0
        chunk.append((r["i"], bytes(r["t"])))
        held += len(r["t"])
    yield chunk


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
         max_chunk_bytes: int = MAX_CHUNK_BYTES) -> DataFrame:
    """Add ``__hits``: n_words, the united word spans (first, last) of all occurrences, and the sorted ids of their items."""
    chunks = _chunks(benchmark, max_chunk_bytes)
    spark, first, second = docs.sparkSession, next(chunks), next(chunks, None)
    if second is None:
        return docs.withColumn("__hits", _search(spark, first, window)(utf8(F.col(text))))
    # one pass a chunk, each done before the next starts, so that a worker holds one chunk's machines
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "decontaminate-docs")
    found = None
    for k, chunk in enumerate(chain([first, second], chunks)):
        hits = rows.select("__row", _search(spark, chunk, window)(utf8(F.col(text))).alias("h"))
        hits = stage(hits if k == 0 else hits.where(F.size("h.items") > 0), "decontaminate-hits")
        found = hits if found is None else found.union(hits)
    h = F.struct(F.max("h.n_words").alias("n_words"), _unite(F.array_sort(F.flatten(F.collect_list("h.spans")))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("h.items")))).alias("items"))
    # a document's own hits meet, no more
    return rows.join(found.groupBy("__row").agg(h.alias("__hits")), "__row").drop("__row")


def _unite(spans: Column) -> Column:
    """Sorted spans with overlapping ones joined."""
    last = lambda acc: F.element_at(acc, -1)
    joined = lambda acc, s: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(
        F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["last"], s["last"]).alias("last"))))
    return F.aggregate(spans, F.slice(spans, 1, 0), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["first"] <= F.try_element_at(acc, F.lit(-1))["last"] + 1), joined(acc, s)).otherwise(F.concat(acc, F.array(s))))


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The digest of ``find`` per document."""
    h = F.col("__hits")
    n_hit = F.aggregate(h["spans"], F.lit(0).cast("long"), lambda acc, s: acc + s["last"] - s["first"] + 1)
    return find(docs.select("doc_id", "text"), benchmark, **how).select(
        "doc_id", h["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(h["items"], ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
