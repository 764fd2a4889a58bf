"""N-gram Jaccard join with parity sketches.

A document is the set of its distinct five-word shingles. Two sets A and B of
similarity 0.8 or more differ in at most d = (|A| + |B|) / 9 shingles and their
sizes are within a factor 0.8.

Sketch: the shingles are dealt by hash over the parts of a long bit sketch, in
which each flips one bit, so each shingle that only one of two sets holds
spoils at most one part, and the Hamming distance of two sketches is at most
the size of the symmetric difference.

Pigeonhole join, per size band (sizes up to a power of two): at most d parts of
a document's sketch differ from a linked document's, hence among its first d + 1
non-empty parts, in an order that depends on a part's content alone (fullest
first), one is also among the other's first d + 1. Those parts are the
signatures. A document whose partners may lie in the next band joins there too.

Documents that share a signature meet at the smallest of them (their centre).
Inside the family of a centre, sizes and Hamming distances of 1024-bit sketches
leave the pairs worth verifying. Families are cut into blocks by hash. Two
passes, each with a cut of its own, look inside the blocks only and pass on the
nearest few of each document; these are verified on the texts and the links
joined into components. The last pass takes the families that still hold
several components and lets all their blocks meet, for all pairs across
components, so no link is lost. A family of true near copies, however large,
is connected before that; the last pass compares sketches of what is not.
Equal sets are one class from the start and never form pairs.

Defined cases: a document without words (or text) has no shingles and is alone;
fewer than five words are one shingle; a document without id takes no part
(component null); rows repeating an id and a text are copies.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import maybe_in, utf8
from strata.llm.components import components
from strata.llm.hashing import WordHashes, mix, words
from strata.sinks.writer import stage

SHINGLE = 5
SKETCH_BITS = 1024
FAMILY_BLOCK = 512
NEAREST = (3, 6, None)  # pairs a document passes on in each pass; the last passes on all
BYTES_PER_GROUP = 24 << 20
DOCS_PER_PACK = 4_000  # at most 65,536, since places in a packed row take 16 bits
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_FEATURE, _SIGNATURES = 0, 1
_ROWS = "kind int, q int, doc_id long, n int, node long, data binary"
_SCHEMA = pa.schema([("kind", pa.int32()), ("q", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("data", pa.binary())])


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    w = hashes.of(words(text))
    if not len(w):
        return w
    if len(w) < SHINGLE:
        return mix((w * _ODD[:len(w)]).sum(keepdims=True) + np.uint64(len(w)))
    n = len(w) - SHINGLE + 1
    h = w[:n] * _ODD[0]
    for k in range(1, SHINGLE):
        h += w[k:k + n] * _ODD[k]
    return np.unique(mix(h))


def set_hash(s: np.ndarray) -> int:
    return int((mix(s + _ODD[1]).sum() ^ mix(np.array([len(s)], np.uint64))[0]).astype(np.int64))


def sketch(s: np.ndarray) -> bytes:
    flips = np.bincount(((s >> np.uint64(20)) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def bands(n: int) -> list[tuple[int, int]]:
    """(band, d) of the joins that a set of ``n`` shingles takes part in; d bounds the symmetric difference."""
    band = (n - 1).bit_length()
    top, largest = 1 << band, n * 5 // 4
    out = [(band, (n + min(top, largest)) // 9)]
    return out + [(band + 1, (n + largest) // 9)] if largest > top else out


def signatures(s: np.ndarray) -> np.ndarray:
    """48-bit signatures of the first d + 1 parts of the set's sketch, for each of its bands."""
    out = []
    for band, d in bands(len(s)):
        top = 1 << band
        parts = -(-3 * top // 10) + -(-4096 // top)
        part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        # the bit that a shingle flips, as a random key: the xor of the keys stands for the part's odd bits
        key = mix(((s & np.uint64(0xFFFFFFFF)) + (part << np.uint64(32))) * _ODD[3] + np.uint64(band))
        # parts are ranges of the sorted hashes
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        content = np.bitwise_xor.reduceat(key, starts)
        full = np.diff(np.append(starts, len(s)))
        at = part[starts]
        odd = content != 0
        content, full, at = content[odd], full[odd], at[odd]
        first = np.lexsort((at, -full))[:d + 1]
        out.append(mix(content[first] + at[first] * _ODD[4] + np.uint64(band)) >> np.uint64(16))
    return np.concatenate(out)


def _pack(sig: np.ndarray, who: np.ndarray, nodes: np.ndarray) -> bytes:
    used, who = np.unique(who, return_inverse=True)
    head = np.array([len(sig), len(used)], np.uint32).tobytes()
    return head + nodes[used].tobytes() + who.astype(np.uint16).tobytes() + sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    m, k = np.frombuffer(data, np.uint32, 2)
    nodes = np.frombuffer(data, np.int64, k, 8)
    who = np.frombuffer(data, np.uint16, m, 8 + 8 * int(k))
    low = np.frombuffer(data, np.uint8, 6 * int(m), 8 + 8 * int(k) + 2 * int(m)).reshape(-1, 6)
    sig = np.zeros((int(m), 8), np.uint8)
    sig[:, :6] = low
    return sig.view("<u8").ravel(), nodes[who]


def sketches(docs: DataFrame, groups: int) -> DataFrame:
    """Per document its features; per batch and group of signatures one packed row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), DOCS_PER_PACK):
                n, node, data, seen, sigs = [], [], [], {}, []
                for i in range(at, min(at + DOCS_PER_PACK, len(ids))):
                    s = shingles(texts[i].as_buffer().to_pybytes(), hashes)
                    n.append(len(s))
                    node.append(set_hash(s) if len(s) else 0)
                    data.append(sketch(s) if len(s) else None)
                    if len(s) and ids[i] is not None and node[-1] not in seen:
                        seen[node[-1]] = len(seen)
                        sigs.append(signatures(s))
                m = len(n)
                yield pa.RecordBatch.from_arrays([pa.array([_FEATURE] * m, pa.int32()), pa.nulls(m, pa.int32()), pa.array(ids[at:at + m], pa.int64()),
                                                  pa.array(n, pa.int32()), pa.array(node, pa.int64()), pa.array(data, pa.binary())], schema=_SCHEMA)
                if not sigs:
                    continue
                who = np.repeat(np.arange(len(sigs)), [len(x) for x in sigs])
                sig, nodes = np.concatenate(sigs), np.fromiter(seen, np.int64, len(seen))
                q = (sig % np.uint64(groups)).astype(np.int32)
                order = np.argsort(q, kind="stable")
                cuts = np.flatnonzero(np.diff(q[order])) + 1
                pieces = np.split(order, cuts)
                yield pa.RecordBatch.from_arrays([pa.array([_SIGNATURES] * len(pieces), pa.int32()), pa.array([int(q[p[0]]) for p in pieces], pa.int32()),
                                                  pa.nulls(len(pieces), pa.int64()), pa.nulls(len(pieces), pa.int32()), pa.nulls(len(pieces), pa.int64()),
                                                  pa.array([_pack(sig[p], who[p], nodes) for p in pieces], pa.binary())], schema=_SCHEMA)
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text")).mapInArrow(run, _ROWS)


def _meet(t: pa.Table) -> pa.Table:
    """(centre, node) for all that share a signature of this group."""
    found = [_unpack(x) for x in t.column("data").to_pylist()]
    sig, node = np.concatenate([s for s, _ in found]), np.concatenate([x for _, x in found])
    order = np.argsort(sig, kind="stable")
    sig, node = sig[order], node[order]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    centre = np.repeat(np.minimum.reduceat(node, starts), np.diff(np.append(starts, len(sig))))
    pairs = np.unique(np.stack([centre, node], 1)[centre != node], axis=0)
    return pa.table({"centre": pa.array(pairs[:, 0], pa.int64()), "node": pa.array(pairs[:, 1], pa.int64())})


def _near(x: np.ndarray, n: np.ndarray, comp: np.ndarray, y: np.ndarray, m: np.ndarray, other: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs (row of x, row of y) that sizes and Hamming distance allow, across components; the ``k`` nearest a row."""
    rows, cols = [], []
    step = max(1, (1 << 20) // max(1, len(y) * x.shape[1]))
    for a in range(0, len(x), step):
        far = np.bitwise_count(x[a:a + step, None, :] ^ y[None, :, :]).sum(-1, dtype=np.int64)
        p, q = n[a:a + step, None].astype(np.int64), m[None, :].astype(np.int64)
        good = (9 * far <= p + q) & (100 * np.minimum(p, q) >= 80 * np.maximum(p, q)) & (comp[a:a + step, None] != other[None, :])
        if k is not None and k < len(y):
            near = np.argpartition(np.where(good, far, 1 << 40), k - 1, axis=1)[:, :k]
            i = np.repeat(np.arange(len(near)), k)
            j = near.ravel()
            keep = good[i, j]
            i, j = i[keep], j[keep]
        else:
            i, j = np.nonzero(good)
        rows.append(i + a)
        cols.append(j)
    return np.concatenate(rows), np.concatenate(cols)


def _pairs_of_families(k: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pairs(t: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
            col = lambda c: t.column(c).to_numpy()
            node, n, comp, own, bi, bj = (col(c) for c in ("node", "n", "comp", "own", "bi", "bj"))
            x = np.frombuffer(b"".join(t.column("data").to_pylist()), np.uint64).reshape(len(node), -1)
            a, b = [], []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e - s < 2:
                    continue
                if bi[s] == bj[s]:
                    i, j = _near(x[s:e], n[s:e], comp[s:e], x[s:e], n[s:e], comp[s:e], k)
                    a.append(node[s:e][i])
                    b.append(node[s:e][j])
                else:
                    left, right = s + np.flatnonzero(own[s:e] == bi[s]), s + np.flatnonzero(own[s:e] == bj[s])
                    if len(left) and len(right):
                        i, j = _near(x[left], n[left], comp[left], x[right], n[right], comp[right], k)
                        a.append(node[left][i])
                        b.append(node[right][j])
            u, v = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (a, b))
            both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], names=["a", "b"])

        def starts(t: pa.Table) -> np.ndarray:
            keys = np.stack([t.column(c).to_numpy() for c in ("centre", "bi", "bj")], 1)
            return np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))

        for batch in batches:
            held.append(batch)
            t = pa.Table.from_batches(held)
            if not len(t):
                continue
            at = starts(t)
            if len(at) > 1:  # all but the last family are complete
                yield pairs(t.slice(0, int(at[-1])), at)
                held = t.slice(int(at[-1])).combine_chunks().to_batches()
        if held and (t := pa.Table.from_batches(held)) and len(t):
            yield pairs(t, np.append(starts(t), len(t)))

    return run


def family_pairs(families: DataFrame, comps: DataFrame | None, k: int | None, salt: int) -> DataFrame | None:
    """Distinct pairs (a, b) inside families that may be similar and are not yet connected; None if every family is one component.

    With ``k`` the nearest ``k`` of each document within its block, else all pairs of all blocks.
    """
    f = families
    if comps is None:
        f = f.withColumn("comp", F.col("node"))
    else:
        f = f.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        # written first, so that the join below can split a family that fills a partition
        split = stage(f.groupBy("centre").agg((F.min("comp") != F.max("comp")).alias("split")).where("split").select("centre"), "jaccard-split")
        if split.isEmpty():
            return None
        f = f.join(split, "centre", "left_semi")
    f = f.withColumn("own", F.pmod(F.xxhash64("node", F.lit(salt)), F.col("blocks")).cast("int"))
    if k is None:
        meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("bi"), F.greatest("own", j).alias("bj")))
    else:
        meet = F.array(F.struct(F.col("own").alias("bi"), F.col("own").alias("bj")))
    dealt = f.withColumn("m", F.explode(meet)).select("centre", F.col("m.bi").alias("bi"), F.col("m.bj").alias("bj"), "own", "node", "n", "comp", "data")
    return (dealt.repartition("centre", "bi", "bj").sortWithinPartitions("centre", "bi", "bj")
            .mapInArrow(_pairs_of_families(k), "a long, b long").distinct())


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` with ``linked``: whether 100 |A & B| >= 80 |A | B| on the shingle sets of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, recent = WordHashes(), OrderedDict()

        def of(node: int, text: bytes) -> np.ndarray | None:
            if node in recent:
                recent.move_to_end(node)
                return recent[node]
            s = shingles(text, hashes)
            if set_hash(s) != node:  # another text under the same id
                return None
            recent[node] = s
            if len(recent) > 500:
                recent.popitem(last=False)
            return s

        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))
            out = []
            for i in range(len(a)):
                s, t = of(a[i], x[i]), of(b[i], y[i])
                if s is not None and t is not None:
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    out.append((a[i], b[i], 100 * both >= 80 * (len(s) + len(t) - both)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["a", "b", "linked"])

    t = texts.select("node", "text")
    return (pairs.join(t.withColumnsRenamed({"node": "a", "text": "x"}), "a").join(t.withColumnsRenamed({"node": "b", "text": "y"}), "b")
            .mapInArrow(run, "a long, b long, linked boolean"))


def _texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of one document of each class in ``nodes``."""
    ids = stage(classes.join(nodes, "node", "left_semi").select("node", F.col("first_id").alias("doc_id")), "jaccard-ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    near = maybe_in(rows, "doc_id", ids).where("__maybe").drop("__maybe")
    return near.join(ids, "doc_id").select("node", "text").distinct()


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with the same set) and component_id of every document."""
    size = docs.agg(F.sum(F.octet_length(F.coalesce(F.col("text"), F.lit(""))))).first()[0] or 0
    groups = max(1, -(-size // BYTES_PER_GROUP))
    rows = stage(sketches(docs, groups), "jaccard-sketches")
    features = rows.where(F.col("kind") == _FEATURE)
    classes = stage(features.where("n > 0 and doc_id is not null").groupBy("node")
                    .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("data").alias("data")), "jaccard-classes")
    met = stage(rows.where(F.col("kind") == _SIGNATURES).select("q", "data").groupBy("q").applyInArrow(_meet, "centre long, node long").distinct(), "jaccard-met")
    members = met.union(met.select("centre", F.col("centre").alias("node")).distinct())
    blocks = stage(met.groupBy("centre").agg(F.ceil((F.count(F.lit(1)) + 1) / FAMILY_BLOCK).cast("int").alias("blocks")), "jaccard-blocks")
    families = stage(members.join(blocks, "centre").join(classes.select("node", "n", "data"), "node"), "jaccard-families")

    tried, texts, comps = None, None, None
    for salt, k in enumerate(NEAREST):
        pairs = family_pairs(families, comps, k, salt)
        if pairs is None:  # nor will a later pass find any
            break
        pairs = stage(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
        if pairs.isEmpty():
            continue
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = stage(nodes if texts is None else nodes.join(texts, "node", "left_anti"), "jaccard-nodes")
        if not nodes.isEmpty():
            more = stage(_texts(docs, classes, nodes), "jaccard-texts")
            texts = more if texts is None else texts.union(more)
        checked = stage(verify(pairs, texts), "jaccard-checked")
        links = checked.where("linked").select("a", "b")
        known = links if comps is None else links.union(comps.where("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b")))
        comps = components(known)
        tried = checked.select("a", "b") if tried is None else tried.union(checked.select("a", "b"))

    named = classes.select("node", "first_id")
    if comps is not None:
        joined = named.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        named = joined.join(joined.groupBy("comp").agg(F.min("first_id").alias("component")), "comp").select("node", "first_id", "component")
    else:
        named = named.withColumn("component", F.col("first_id"))
    own = features.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "node")
    held = F.col("n_shingles") > 0
    return (own.join(named, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & held, F.col("first_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    F.when(F.col("doc_id").isNotNull() & held, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))
