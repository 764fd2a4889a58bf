"""Language-model scores from an Elias-Fano n-gram trie.

Level 1 holds the words of the training texts (by hash, a monotone Elias-Fano
sequence), their exact counts, quantised smoothed log probabilities and
back-off weights, and monotone pointers to level 2: the successors of each
word, stored relative to their context as one monotone sequence (a context's
successor ids are added to the last value of the context before it), with
quantised smoothed probabilities. A query finds the context's range by its
pointers and searches the successor within it.

Model: all bigrams seen (``min_count`` may leave out rare ones), absolute
discounting, the rest of a context's mass spread by the base unigram model (add one half over
the vocabulary and one unknown word), so probabilities sum to one. The start of
a text is a context of its own.

Words are dealt to shards by the top bits of their hash; one task builds one
shard (a bounded share of the words, however large the corpus) and writes it as
one memory-mappable file to the shared folder. Counts go there map-side
combined. A frequent context is in the partial counts of every task, all bound
for one shard, so those are united in a tree before: a shard's task meets at
most ``FAN_IN`` tables that hold each pair once. Nothing of the model passes
the driver but a line per shard.

Defined cases: null and empty texts are one end token; repeated rows count as
often as they occur; without training rows every probability is the unknown
word's.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import utf8
from strata.llm.elias_fano import EliasFano
from strata.llm.files import create, filesystem, open_file
from strata.llm.hashing import WordHashes, words
from strata.session import scratch_path
from strata.sinks.writer import stage

MIN_COUNT = 1
DISCOUNT = 0.75
BYTES_PER_SHARD = 32 << 20
MAX_WORDS = (1 << 32) - 1  # word ids are packed into 32 bits, one of them stands for a text's start
# Partial pair counts are united in a tree: first those of this much text, then FAN_IN of the results at a time.
BYTES_PER_SLICE = 128 << 20
FAN_IN = 8
_CHUNK_WORDS = 1_500_000
_STEP = 1 / 4096  # quantisation of log10 probabilities, down to -16
# Names no word can have: they hold white space.
_END, _START = b" end", b" start"


def _tokens(texts: list[bytes], hashes: WordHashes) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, hashes of their tokens with an end token each, tokens per row) in chunks of bounded size."""
    end = hashes[_END]
    at, parts, sizes, held = 0, [], [], 0
    for i, text in enumerate(texts):
        h = hashes.of(words(text))
        parts += [h, np.array([end], np.uint64)]
        sizes.append(len(h) + 1)
        held += len(h) + 1
        if held >= _CHUNK_WORDS or i == len(texts) - 1:
            yield slice(at, i + 1), np.concatenate(parts), np.array(sizes)
            at, parts, sizes, held = i + 1, [], [], 0


def _contexts(tokens: np.ndarray, sizes: np.ndarray, start) -> np.ndarray:
    """The token before each token, ``start`` before a text's first."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = start
    return out


def _quantise(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.clip(np.rint(-np.log10(p) / _STEP), 0, 65535).astype(np.uint16)


# ------------------------------------------------------------ shard files
def _save(folder: str, stem: str, arrays: dict[str, np.ndarray], facts: dict) -> str:
    """One file: a JSON line of facts and array places, then the arrays, 8-byte aligned."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [str(a.dtype), list(a.shape), at]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(facts | {"arrays": places}).encode()
    head = len(head).to_bytes(8, "little") + head + b" " * (-len(head) % 8)
    uri, out = create(folder, stem, ".trie")
    with out:
        out.write(head)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    return uri


def _load(uri: str) -> tuple[dict, dict[str, np.ndarray]]:
    """Memory-mapped where the shared folder is mounted, else read into memory."""
    store, path = filesystem(uri)
    if store.type_name == "local":
        data = np.memmap(path, np.uint8, "r")
    else:
        with open_file(uri) as f:
            data = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(bytes(data[:8]), "little")
    facts = json.loads(bytes(data[8:8 + size]))
    base = 8 + size + (-size % 8)
    arrays = {}
    for name, (kind, shape, at) in facts["arrays"].items():
        count = int(np.prod(shape)) * np.dtype(kind).itemsize
        arrays[name] = data[base + at:base + at + count].view(kind).reshape(shape)
    return facts, arrays


def _put(name: str, e: EliasFano) -> dict[str, np.ndarray]:
    return {f"{name}.low": e.low, f"{name}.high": e.high}


def _get(name: str, n: int, arrays: dict) -> EliasFano:
    low = arrays[f"{name}.low"]
    return EliasFano.of(n, low.shape[1], low, arrays[f"{name}.high"])


@dataclass
class Words:
    """Level 1 across shards: ids are places in hash order. ``shards``: (shard, uri, words) of each, in order."""

    bits: int
    shards: list[tuple[int, str, int]]

    def __post_init__(self) -> None:
        self.first = np.zeros((1 << self.bits) + 1, np.int64)
        for q, _, n in self.shards:
            self.first[q + 1] = n
        self.first = np.cumsum(self.first)
        self.uris = {q: uri for q, uri, _ in self.shards}
        self.open: dict[int, tuple[EliasFano, np.ndarray]] = {}

    def shard(self, q: int) -> tuple[EliasFano, np.ndarray]:
        if q not in self.open:
            facts, arrays = _load(self.uris[q])
            self.open[q] = _get("words", facts["n"], arrays), arrays["counts"]
        return self.open[q]

    def ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted hashes."""
        ids, counts = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        q = _shard_of(h, self.bits)
        for k in np.unique(q):
            if int(k) in self.uris:
                s = slice(*np.searchsorted(q, (k, k + 1)))
                e, c = self.shard(int(k))
                x = _within(h[s], self.bits)
                at = e.successor(x, np.zeros(len(x), np.int64), np.full(len(x), e.n))
                hit = at < e.n
                hit[hit] = e.at(at[hit]) == x[hit]
                ids[s] = np.where(hit, at + self.first[k], -1)
                counts[s][hit] = c[at[hit]]
        return ids, counts

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted ids."""
        out = np.zeros(len(ids), np.int64)
        q = np.searchsorted(self.first, ids, side="right") - 1
        for k in np.unique(q):
            s = slice(*np.searchsorted(q, (k, k + 1)))
            out[s] = self.shard(int(k))[1][ids[s] - self.first[k]]
        return out


def _shard_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _within(h: np.ndarray, bits: int) -> np.ndarray:
    return h & np.uint64((1 << (64 - bits)) - 1)


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def _small(n: np.ndarray) -> list[bytes]:
    """Counts as bytes, with a list of those that need more."""
    big = np.flatnonzero(n >= 255)
    return [np.minimum(n, 255).astype(np.uint8).tobytes(), big.astype(np.uint32).tobytes() + n[big].astype(np.uint64).tobytes()]


def _unsmall(small: bytes, big: bytes) -> np.ndarray:
    n = np.frombuffer(small, np.uint8).astype(np.int64)
    k = len(big) // 12
    n[np.frombuffer(big, np.uint32, k)] = np.frombuffer(big, np.uint64, k, 4 * k).astype(np.int64)
    return n


# ------------------------------------------------------------ building
def _count_words(texts: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sums: tuple = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for _, t, _ in _tokens(batch.column("text").to_pylist(), hashes):
                h, n = np.unique(t, return_counts=True)
                sums = _sum_by(np.concatenate([sums[0], h]), np.concatenate([sums[1], n]))
            h, n = sums
            q = _shard_of(h, bits)
            rows = []
            for k in np.unique(q):
                s = slice(*np.searchsorted(q, (k, k + 1)))
                rows.append((int(k), h[s].tobytes(), *_small(n[s])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 3, strict=True)], names=["q", "keys", "small", "big"])

    return texts.mapInArrow(run, "q int, keys binary, small binary, big binary")


def _merged(t: pa.Table, kind) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(x, kind) for x in t.column("keys").to_pylist()]
    counts = [_unsmall(a, b) for a, b in zip(t.column("small").to_pylist(), t.column("big").to_pylist(), strict=True)]
    return _sum_by(np.concatenate(keys), np.concatenate(counts))


def _word_shards(counted: DataFrame, bits: int, folder: str) -> DataFrame:
    def build(t: pa.Table) -> pa.Table:
        q = t.column("q")[0].as_py()
        h, n = _merged(t, np.uint64)
        arrays = _put("words", EliasFano.encode(_within(h, bits))) | {"counts": n.astype(np.uint32 if n.max() < 1 << 32 else np.uint64)}
        uri = _save(folder, f"words-{q}", arrays, {"n": len(h)})
        return pa.table({"q": pa.array([q], pa.int32()), "uri": [uri], "n": pa.array([len(h)], pa.int64()), "total": pa.array([int(n.sum())], pa.int64())})

    return counted.groupBy("q").applyInArrow(build, "q int, uri string, n long, total long")


def _count_pairs(texts: DataFrame, vocabulary: Words) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(), vocabulary
        start = int(known.first[-1])  # the id after the last word's
        for batch in batches:
            for _, t, sizes in _tokens(batch.column("text").to_pylist(), hashes):
                h, back = np.unique(t, return_inverse=True)
                ids = known.ids(h)[0].astype(np.uint64)[back]
                pairs, n = np.unique(_contexts(ids, sizes, np.uint64(start)) << np.uint64(32) | ids, return_counts=True)
                context = (pairs >> np.uint64(32)).astype(np.int64)
                q = np.searchsorted(known.first, context, side="right") - 1  # the start's own: one past the last shard
                rows = []
                for k in np.unique(q):
                    s = slice(*np.searchsorted(q, (k, k + 1)))
                    rows.append((int(k), _pack_pairs(context[s], pairs[s]), *_small(n[s])))
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 3, strict=True)], names=["q", "keys", "small", "big"])

    return texts.mapInArrow(run, "q int, keys binary, small binary, big binary")


def _pack_pairs(context: np.ndarray, pairs: np.ndarray) -> bytes:
    """Sorted pairs: each context once with the number of its successors, then the successors."""
    c, m = np.unique(context, return_counts=True)
    return np.array([len(c)], np.uint32).tobytes() + c.astype(np.uint32).tobytes() + m.astype(np.uint32).tobytes() + (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()


def _pair_keys(data: bytes) -> np.ndarray:
    k = int(np.frombuffer(data, np.uint32, 1)[0])
    v = np.frombuffer(data, np.uint32, -1, 4).astype(np.uint64)
    return np.repeat(v[:k], v[k:2 * k].astype(np.int64)) << np.uint64(32) | v[2 * k:]


def _merged_pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    counts = [_unsmall(a, b) for a, b in zip(t.column("small").to_pylist(), t.column("big").to_pylist(), strict=True)]
    return _sum_by(np.concatenate([_pair_keys(x) for x in t.column("keys").to_pylist()]), np.concatenate(counts))


def _united(counted: DataFrame, size: int) -> DataFrame:
    """Partial pair counts of ``size`` bytes of text, united until at most ``FAN_IN`` rows a shard are left."""

    def unite(t: pa.Table) -> pa.Table:
        keys, n = _merged_pairs(t)
        packed = _pack_pairs((keys >> np.uint64(32)).astype(np.int64), keys)
        small, big = _small(n)
        one = {"q": pa.array(t.column("q")[:1].to_pylist(), pa.int32()), "part": pa.array(t.column("part")[:1].to_pylist(), pa.int32())}
        return pa.table(one | {"keys": pa.array([packed], pa.binary()), "small": pa.array([small], pa.binary()), "big": pa.array([big], pa.binary())})

    slices = -(-size // BYTES_PER_SLICE)
    counted = counted.withColumn("part", F.spark_partition_id())
    while slices > 1:
        counted = (counted.withColumn("part", F.col("part") % slices).groupBy("q", "part")
                   .applyInArrow(unite, "q int, part int, keys binary, small binary, big binary"))
        if slices <= FAN_IN:
            break
        slices = -(-slices // FAN_IN)
    return counted.drop("part")


def _pair_shards(counted: DataFrame, vocabulary: Words, total: int, folder: str, min_count: int, discount: float) -> DataFrame:
    def build(t: pa.Table) -> pa.Table:
        q, known = t.column("q")[0].as_py(), vocabulary
        keys, n = _merged_pairs(t)
        base = int(known.first[q]) if q < 1 << known.bits else int(known.first[-1])
        size = int(known.first[q + 1]) - base if q < 1 << known.bits else 1
        context = (keys >> np.uint64(32)).astype(np.int64) - base
        mass = np.bincount(context, n, size)  # all of a context, before pruning
        keep = n >= min_count
        keys, n, context = keys[keep], n[keep], context[keep]
        word = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        seen = (n - discount) / mass[context]
        rest = 1 - np.bincount(context, seen, size)
        some, back = np.unique(word, return_inverse=True)
        p = seen + rest[context] * _base(known.counts_of(some), total, int(known.first[-1]))[back]
        ends = np.cumsum(np.bincount(context, minlength=size))
        pointers = np.concatenate([[0], ends])
        # successors relative to the context before: its last value is added
        largest = np.zeros(size, np.int64)
        filled = np.diff(pointers) > 0
        largest[filled] = word[ends[filled] - 1]
        offset = np.concatenate([[0], np.cumsum(largest)[:-1]])
        arrays = (_put("pointers", EliasFano.encode(pointers.astype(np.uint64))) | _put("next", EliasFano.encode((word + offset[context]).astype(np.uint64)))
                  | {"p": _quantise(p), "back": _quantise(rest)})
        uri = _save(folder, f"pairs-{q}", arrays, {"n": len(word), "contexts": size})
        return pa.table({"q": pa.array([q], pa.int32()), "uri": [uri], "n": pa.array([len(word)], pa.int64())})

    return counted.groupBy("q").applyInArrow(build, "q int, uri string, n long")


def _base(count: np.ndarray, total: int, distinct: int) -> np.ndarray:
    return (count + 0.5) / (total + 0.5 * (distinct + 1))


@dataclass
class Model:
    words: Words
    pairs: dict[int, str]
    total: int

    def __post_init__(self) -> None:
        self.open: dict[int, tuple] = {}

    def shard(self, q: int) -> tuple:
        if q not in self.open:
            facts, a = _load(self.pairs[q])
            self.open[q] = (_get("pointers", facts["contexts"] + 1, a), _get("next", facts["n"], a), a["p"], a["back"])
        return self.open[q]

    def log10(self, context: np.ndarray, word: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 probabilities of words after contexts, both ids, contexts sorted; ``base``: the words' base log10."""
        out = base.copy()
        q = np.searchsorted(self.words.first, context, side="right") - 1
        for k in np.unique(q):
            if int(k) not in self.pairs:
                continue
            s = slice(*np.searchsorted(q, (k, k + 1)))
            pointers, successors, p, back = self.shard(int(k))
            own = context[s] - self.words.first[k]
            some, inverse = np.unique(own, return_inverse=True)
            lo, hi = (pointers.at(some + d).astype(np.int64) for d in (0, 1))
            before = np.zeros(len(some), np.uint64)
            if successors.n:
                before = np.where(lo > 0, successors.at(np.maximum(lo - 1, 0)), np.uint64(0))
            lo, hi, before, weight = lo[inverse], hi[inverse], before[inverse], back[some][inverse]
            x = before + np.maximum(word[s], 0).astype(np.uint64)
            at = successors.successor(x, lo, hi)
            hit = (at < hi) & (word[s] >= 0)
            hit[hit] = successors.at(at[hit]) == x[hit]
            out[s] += -_STEP * weight.astype(np.float64)
            found = np.flatnonzero(hit) + s.start
            out[found] = -_STEP * p[at[hit]].astype(np.float64)
        return out


def train(texts: DataFrame, min_count: int = MIN_COUNT, discount: float = DISCOUNT) -> Model:
    """Fit on every row of ``texts`` (column ``text``, bytes); the trie lies in the shared folder."""
    folder = scratch_path(texts.sparkSession, "lm-trie")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / BYTES_PER_SHARD))))
    shards = stage(_word_shards(_count_words(texts, bits), bits, folder), "lm-words").orderBy("q").collect()  # a line per shard
    vocabulary = Words(bits, [(r["q"], r["uri"], r["n"]) for r in shards])
    total = sum(r["total"] for r in shards)
    if sum(r["n"] for r in shards) >= MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS - 1} distinct words: ids are 32 bits wide")
    if not shards:
        return Model(vocabulary, {}, 0)
    pairs = stage(_pair_shards(_united(_count_pairs(texts, vocabulary), size), vocabulary, total, folder, min_count, discount), "lm-pairs").collect()
    return Model(vocabulary, {r["q"]: r["uri"] for r in pairs}, total)


def score(texts: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns and n_tokens, n_known, base_score, score of every row of ``texts`` (column ``text``, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, m = WordHashes(), model
        distinct = int(m.words.first[-1])
        for batch in batches:
            for rows, t, sizes in _tokens(batch.column("text").to_pylist(), hashes):
                h, back = np.unique(t, return_inverse=True)
                ids, counts = m.words.ids(h)
                base = np.log10(_base(counts, m.total, distinct))
                place = _contexts(back, sizes, len(h))  # contexts as places among the words here; the start is one more
                pairs, inverse = np.unique(place * (len(h) + 1) + back, return_inverse=True)
                context, word = np.divmod(pairs, len(h) + 1)
                context = np.append(ids, distinct)[context]
                known, order = context >= 0, np.argsort(context, kind="stable")
                order = order[known[order]]
                p = base[word]
                p[order] = m.log10(context[order], ids[word[order]], p[order])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                out = {"n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(np.add.reduceat((counts > 0)[back].astype(np.int64), starts)),
                       "base_score": pa.array(np.add.reduceat(base[back], starts)), "score": pa.array(np.add.reduceat(p[inverse], starts))}
                cut = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([*(cut.column(c) for c in keep), *out.values()], names=[*keep, *out])

    kept = texts.select(*keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    return texts.select(*keep, "text").mapInArrow(run, f"{schema}n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """Score all ``docs`` with a model learnt from those for which ``held_out`` does not hold."""
    rows = docs.select("doc_id", held_out.alias("held_out"), utf8(F.col("text")).alias("text"))
    model = train(rows.where(~F.col("held_out")).select("text"))
    return (score(rows, model, "doc_id", "held_out").withColumn("train_tokens", F.lit(model.total).cast("long"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
