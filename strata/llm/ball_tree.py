"""Ranked lexical search: exact inner products over ball trees of sparse document vectors.

A document is a sparse vector of saturated term counts, a query the integer
weights of its terms; a score is their inner product. Rows become blocks of
bounded size in the task that reads them. Each block is a ball tree: a node
holds the centroid and radius of its documents, so ``q.c + |q| r``, rounded up,
bounds every score below it. Subtrees are opened best first and left out once
their bound is below the k-th best score found so far (which a task carries
from block to block); leaves are scored exactly, in 64-bit integers.

Only terms of queries reach the vectors: queries travel in chunks of at most
``max_chunk_bytes`` of text, each chunk a pass over the documents (over a
written copy where there are several).

Defined cases: null texts and texts without terms are not documents and are
never found; every row is a document, also with a repeated or null id (null
after all others on equal scores); repeated (item, text) rows are one query,
other rows repeating an item_id are queries of their own; queries without terms
or without any document that shares one have no rows; texts of any length are
counted whole; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import utf8
from strata.sinks.writer import stage

K = 50
ROWS_PER_BLOCK, LEAF = 8_192, 64
MAX_CHUNK_BYTES = 2 << 20
MAX_TASKS = 4_096  # so at most k times this many rows meet for a query
# Bytes of terms: digits, letters (A-Z folded) and everything beyond ASCII; the rest becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UNIT, _SCALE, _FREE, _BY_LENGTH = 1_000_000_000, 1_000, 50, 50  # fixed values of the score


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ---------------------------------------------------------------- ball tree
@dataclass
class Rows:
    """Sparse rows: row i holds ``term[at[i]:at[i + 1]]`` with the whole numbers ``value``; no row is empty."""

    at: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(n)])
        i = np.repeat(self.at[rows] - at[:-1], n) + np.arange(at[-1])
        return Rows(at, self.term[i], self.value[i])


class Tree:
    """Ball tree over ``rows``; ``order`` says which row stands at each place of the reordered ``rows``."""

    def __init__(self, rows: Rows, scale: np.ndarray, leaf: int = LEAF):
        """``scale``: what a term's coordinate is multiplied by (and a query's divided by) for centroids and radii."""
        n, width = len(rows.at) - 1, len(scale)
        self.scale, order = scale, np.arange(n)
        self.lo, self.hi, self.left, self.right, self.radius = [], [], [], [], []
        self.centre: list[tuple[np.ndarray, np.ndarray]] = []
        stack = [(0, n, -1, False)]
        while stack:
            lo, hi, parent, is_right = stack.pop()
            part = rows.take(order[lo:hi])
            u = part.value * scale[part.term]
            c = np.bincount(part.term, u, width) / (hi - lo)
            dot = lambda v: np.add.reduceat(u * v[part.term], part.at[:-1])
            square = np.add.reduceat(u * u, part.at[:-1])
            far = square - 2 * dot(c) + c @ c
            node = len(self.lo)
            held = np.flatnonzero(c)
            self.lo.append(lo)
            self.hi.append(hi)
            self.left.append(-1)
            self.right.append(-1)
            self.centre.append((held, c[held]))
            # rounding never shrinks a ball
            self.radius.append(math.sqrt(max(0.0, float(far.max())) + 1e-11 * (float(square.max()) + float(c @ c))) * (1 + 1e-12))
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            if hi - lo > leaf and far.max() > 1e-9 * square.max():
                # two rows far apart; the half nearer to the first goes left
                def to(i: int) -> np.ndarray:
                    p = np.zeros(width)
                    span = slice(part.at[i], part.at[i + 1])
                    p[part.term[span]] = u[span]
                    return square - 2 * dot(p) + square[i]

                first = to(int(far.argmax()))
                second = to(int(first.argmax()))
                middle = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(first - second, middle)]
                stack += [(lo + middle, hi, node, True), (lo, lo + middle, node, False)]
        self.order, self.rows = order, rows.take(order)

    def bound(self, node: int, q: np.ndarray, norm: float) -> float:
        """No row below ``node`` scores more; ``q``: the query's weights by term, divided by ``scale``."""
        held, c = self.centre[node]
        return (float(q[held] @ c) + norm * self.radius[node]) * (1 + 1e-9) + 1

    def score(self, node: int, weights: np.ndarray) -> np.ndarray:
        lo, hi = self.lo[node], self.hi[node]
        span = slice(self.rows.at[lo], self.rows.at[hi])
        return np.add.reduceat(self.rows.value[span] * weights[self.rows.term[span]], self.rows.at[lo:hi] - self.rows.at[lo])

    def search(self, query: np.ndarray, weights: np.ndarray, best: Best, ids: np.ndarray, absent: np.ndarray) -> int:
        """Offers ``best`` every row that may belong to it; how many leaves were scored. ``query``: term numbers."""
        w = np.zeros(len(self.scale), np.int64)
        w[query] = weights[query]
        q = np.zeros(len(self.scale))
        q[query] = weights[query] / self.scale[query]
        norm = math.sqrt(float(q[query] @ q[query])) * (1 + 1e-12)
        heap, opened = [(-self.bound(0, q, norm), 0)], 0
        while heap and -heap[0][0] >= best.least:
            _, node = heapq.heappop(heap)
            if self.left[node] < 0:
                opened += 1
                s = self.score(node, w)
                good = np.flatnonzero(s >= best.least)
                if len(good):
                    at = self.order[self.lo[node]:self.hi[node]][good]
                    best.offer(s[good], ids[at], absent[at])
            else:
                for child in (self.left[node], self.right[node]):
                    b = self.bound(child, q, norm)
                    if b >= best.least:
                        heapq.heappush(heap, (-b, child))
        return opened


class Best:
    """The ``k`` best (score, id) so far, equal scores by id, rows without one last; ``least``: below this no score enters."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.absent = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        scores, ids, absent = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.absent, absent])
        top = np.lexsort((ids, absent, -scores))[:self.k]
        self.scores, self.ids, self.absent = scores[top], ids[top], absent[top]
        if len(top) == self.k:
            self.least = max(1, int(self.scores[-1]))


# -------------------------------------------------------------------- Spark
def _chunks(items: DataFrame, max_chunk_bytes: int) -> Iterator[list[tuple]]:
    rows = items.select("item_id", utf8(F.col("text")).alias("t")).distinct()
    chunk, held = [], 0
    for r in rows.toLocalIterator():  # one partition at a time; a chunk is all that stays
        if chunk and held + len(r["t"]) > max_chunk_bytes:
            yield chunk
            chunk, held = [], 0
        chunk.append((r["item_id"], list(dict.fromkeys(terms(bytes(r["t"]))))))
        held += len(r["t"])
    if chunk:
        yield chunk


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf) of every document with a term: its number of terms, and those of the vocabulary with their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            keep, n, at, ids, tfs = [], [], [0], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = terms(text)
                if not words:
                    continue
                keep.append(i)
                n.append(len(words))
                found = Counter(filter(known.__contains__, words))
                ids += map(known.__getitem__, found)
                tfs += found.values()
                at.append(len(ids))
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                                              pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                                             names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text")).mapInArrow(
        count, "doc_id long, n long, term array<int>, tf array<long>")


def _pass(docs: DataFrame, chunk: list[tuple], item_type: str, number: int, k: int, rows_per_block: int, leaf: int) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    for w in chain.from_iterable(words for _, words in chunk):
        vocabulary.setdefault(w, len(vocabulary))
    counted = stage(count_terms(docs, vocabulary), "ball-tree-terms")
    total = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_terms = total["n"], total["l"] or 1
    df = dict(counted.select(F.explode("term").alias("t")).groupBy("t").count().collect())  # a row a term of the chunk
    weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
    queries = [np.array([vocabulary[w] for w in words if df.get(vocabulary[w]) and weights[vocabulary[w]] > 0], np.int64) for _, words in chunk]
    sent = docs.sparkSession.sparkContext.broadcast((weights, queries, [i for i, _ in chunk]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, items = sent.value
        scale = np.sqrt(np.maximum(weights, 1).astype(np.float64))
        best = [Best(k) for _ in queries]

        def block(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            term, n = t.column("term").chunk(0), t.column("n").to_numpy()
            at = term.offsets.to_numpy().astype(np.int64)
            tf = t.column("tf").chunk(0).flatten().to_numpy()
            m = _FREE + (_BY_LENGTH * n * n_docs) // n_terms
            value = (_UNIT * tf) // (_SCALE * tf + 20 * np.repeat(m, np.diff(at)))
            ids = t.column("doc_id")
            tree = Tree(Rows(at - at[0], term.flatten().to_numpy().astype(np.int64), value), scale, leaf)
            numbers, absent = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()
            for q, b in zip(queries, best, strict=True):
                if len(q):
                    tree.search(q, weights, b, numbers, absent)

        held, rows = [], 0
        for batch in batches:
            batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("term")), 0))
            for at in range(0, len(batch), rows_per_block):
                part = batch.slice(at, rows_per_block)
                if rows + len(part) > rows_per_block:
                    block(held)
                    held, rows = [], 0
                held.append(part)
                rows += len(part)
        if rows:
            block(held)
        for i, b in enumerate(best):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(b.scores), (number << 32) + i)), pa.array([items[i]] * len(b.scores), kind),
                    pa.array(b.ids, mask=b.absent), pa.array(b.scores)], names=["__query", "item_id", "doc_id", "score"])

    kind = pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string()
    found = counted.coalesce(MAX_TASKS).mapInArrow(search, f"__query long, item_id {item_type}, doc_id long, score long")
    by = Window.partitionBy("__query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, max_chunk_bytes: int = MAX_CHUNK_BYTES, rows_per_block: int = ROWS_PER_BLOCK, leaf: int = LEAF) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, best first."""
    if items.schema["item_id"].dataType.simpleString() not in ("bigint", "int", "string"):
        items = items.withColumn("item_id", F.col("item_id").cast("string"))
    kind = items.schema["item_id"].dataType.simpleString()
    chunks = _chunks(items, max_chunk_bytes)
    first, second = next(chunks, None), next(chunks, None)
    result = ["item_id", "rank", "doc_id", "score"]
    if first is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    if second is None:
        return _pass(docs, first, kind, 0, k, rows_per_block, leaf).select(*result)
    docs, out = stage(docs.select("doc_id", "text"), "ball-tree-docs"), None
    for number, chunk in enumerate(chain([first, second], chunks)):
        found = stage(_pass(docs, chunk, kind, number, k, rows_per_block, leaf).select(*result), "ball-tree-found")
        out = found if out is None else out.unionByName(found)
    return out
