"""Whitening, ranked search and grammar files against brute force and exact round trips."""

import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import ball_tree, queries, repair, whitening
from strata.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.test_operators import edge_docs, empty_docs

VECTORS = "vec_id long, embedding array<float>, label int, x string, n string, component string"


# ------------------------------------------------------------- 11 whitening
def plain_whitening(rows, components=16):
    """{(id, text of x): [(deviation, whitened of each component)]} by exact sums and one extended-precision eigh per column."""
    grid = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in grid})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    c = np.array([[float(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    v = c.T @ c / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    k = min(components, int((e > 1e-9 * e.sum()).sum()))
    out = []
    for i, x in grid:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        z = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)]) @ p[:, :k] / np.sqrt(e[:k])
        out.append((i, n, dev, z))
    return out, e[:k] / np.trace(v)


def check_whitening(got, rows):
    want, explained = plain_whitening(rows)
    assert len(got) == len(want) * len(explained)
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    sign = {}
    for i, n, dev, z in want:
        mine = by_id[i, dev]
        for k, w in enumerate(z, 1):
            r = mine[k]
            assert r.n == n and abs(r.explained - explained[k - 1]) <= 1e-9 and r.identity_error <= 1e-9
            if abs(w) > 1e-6:
                assert sign.setdefault(k, np.sign(w * r.whitened)) == np.sign(w * r.whitened)
            assert abs(abs(w) - abs(r.whitened)) <= 1e-6


def test_whitening_matches_plain_eigenvectors(spark):
    got = queries.op11_whitening(spark, SF_SMALL).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check_whitening(got, rows)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, -0.3]), (2, [0.5, -0.2, 0.3]), (2, [0.5, -0.2, 0.3]), (3, [0.0, 0.0, 0.0]), (None, [-0.7, 0.9, 0.25]), (4, [-0.7, 0.9, 0.25]), (5, [0.31, -5.0, 7.0])]
    bad = [(6, None), (7, [0.1, None, 0.2]), (8, [nan, 0.0, 0.0]), (9, [0.0, inf, 0.0]), (10, [1.0]), (11, [])]
    df = spark.createDataFrame([(i, v, None, "a", "b", "c") for i, v in good + bad], VECTORS)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    got = whitening.whiten(df).collect()
    assert len(got) == 7 * 3 and {r.component for r in got} == {1, 2, 3}
    check_whitening(list({(r.vec_id, r.component): r for r in got}.values()), [rows[0], rows[1], *rows[3:]])


def test_whitening_without_variance_or_rows(spark):
    one = spark.createDataFrame([(1, [0.5, 0.5], 0, "", "", ""), (2, [0.5, 0.5], 0, "", "", "")], VECTORS)
    assert whitening.whiten(one).collect() == [] and whitening.whiten(one.limit(0)).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 1.0, float(i)], 0, "", "", "") for i in range(5)], VECTORS)
    got = whitening.whiten(flat).collect()  # one direction only
    assert len(got) == 5 and {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9


@pytest.mark.parametrize("values", [np.linspace(1, 2, 24), np.r_[np.full(8, 3.0), np.full(8, 3 + 1e-9), np.linspace(0.1, 1, 8)],
                                    np.r_[np.full(12, 5.0), np.zeros(12)], 1 + 1e-13 * np.arange(24), 10.0 ** -np.arange(24)])
def test_eigenvectors_are_exact_to_double_precision(values):
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((24, 24)))[0].astype(np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.eigenvectors(a)
    assert np.all(np.diff(e) <= 1e-18 * abs(e[0]))
    assert np.abs(x.T @ x - np.eye(24)).max() < 2.0**-52
    assert np.abs(a @ x - x * e).max() < 2.0**-52 * np.abs(values).max()


def test_products_beyond_doubles_are_exact():
    y = np.array([[1 << 40, 3], [-(1 << 40), 5]], np.int64)
    assert whitening._products(y).tolist() == [[1 << 81, -2 << 40], [-2 << 40, 34]]


# --------------------------------------------------------- 12 ranked search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k=50):
    words = [(i, TERM.findall((t or "").translate(_LOWER))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    counts = [(i, len(w), Counter(w)) for i, w in words]
    df = Counter(t for _, _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, n, c in counts:
            m = 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(TERM.findall((text or "").translate(_LOWER))) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"rows_per_block": 7, "leaf": 2}, {"max_chunk_bytes": 500, "rows_per_block": 50, "leaf": 4}])
def test_search_matches_brute_force(spark, how):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted(map(tuple, ball_tree.search(docs, items, **how).collect()), key=str)
    assert got == plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_search_of_odd_rows(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "only WORDS"), (1, "only WORDS"), (2, None), (3, ""), (None, "x 日本語 ß"), (5, "nowhere")], "item_id long, text string")
    items = items.withColumn("rank", F.lit("clash")).withColumn("doc_id", F.lit("clash"))
    got = sorted(map(tuple, ball_tree.search(docs, items).collect()), key=str)
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(1, "only WORDS"), (None, "x 日本語 ß")])
    assert got == want and len(got) == 5
    assert ball_tree.search(empty_docs(spark), items).count() == 0
    assert ball_tree.search(docs, items.limit(0)).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i * 7919 % 1000, "same words here" if i % 3 else f"other {i}") for i in range(1000)] + [(None, "same words here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "same here")], "item_id long, text string")
    got = [r.doc_id for r in ball_tree.search(docs.repartition(5), items, rows_per_block=100, leaf=8).orderBy("rank").collect()]
    assert got == sorted(i * 7919 % 1000 for i in range(1000) if i % 3)[:50]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 120), st.integers(2, 12), st.integers(1, 9))
def test_tree_finds_the_best_rows(seed, n, width, k):
    rng = np.random.default_rng(seed)
    lists = [np.sort(rng.choice(width, rng.integers(1, width + 1), replace=False)) for _ in range(n)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    rows = ball_tree.Rows(at, np.concatenate(lists), rng.integers(1, 10**6 if seed % 2 else 3, at[-1]))
    weights, ids = rng.integers(0, 20_000, width), rng.permutation(n)
    query = np.flatnonzero(rng.random(width) < 0.6)
    tree, best = ball_tree.Tree(rows, np.sqrt(np.maximum(weights, 1)), leaf=3), ball_tree.Best(k)
    if len(query):
        tree.search(query, weights, best, ids, np.zeros(n, bool))
    scores = [sum(int(rows.value[p]) * int(weights[rows.term[p]]) for p in range(at[i], at[i + 1]) if rows.term[p] in query) for i in range(n)]
    want = sorted((-s, int(i)) for s, i in zip(scores, ids) if s > 0)[:k]
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want


def test_search_prunes():
    rng = np.random.default_rng(5)
    lists = [np.array([c * 20 + j for j in range(20)]) for c in rng.integers(0, 4, 3000)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    rows = ball_tree.Rows(at, np.concatenate(lists), rng.integers(900, 1000, at[-1]))
    tree, best = ball_tree.Tree(rows, np.ones(80), leaf=32), ball_tree.Best(5)
    assert tree.search(np.arange(40, 60), np.ones(80, np.int64), best, np.arange(3000), np.zeros(3000, bool)) < 45


# ----------------------------------------------------------- 13 token files
def plain_tokens(docs):
    from tokenizers import Tokenizer

    library, start, out = Tokenizer.from_file(repair.byte_bpe_file()), 0, []
    for i, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("how", [{}, {"rows_per_bucket": 10}, {"rows_per_bucket": 60, "max_shard_ids": 3_000}])
def test_files_match_direct_encoding(spark, how):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = repair.round_trip(docs, scratch_path(spark, f"rpg-{len(how)}"), **how).collect()
    assert sorted(map(tuple, got)) == plain_tokens([(r.doc_id, r.text) for r in docs.collect()])


def test_files_of_odd_rows(spark):
    docs = edge_docs(spark)
    extra = spark.createDataFrame([(7, "a  b\n\n c\t\td \n e <|endoftext|> f"), (8, " \x85\x1c\xa0x ½ don't WE'LL 's"), (9, " lead and trail ")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    got = repair.round_trip(docs, scratch_path(spark, "rpg-odd")).collect()
    want = plain_tokens([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert repair.round_trip(empty_docs(spark), scratch_path(spark, "rpg-none")).collect() == []


ENCODER = []


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'’ab½é日"), st.characters(codec="utf-8")), max_size=60))
def test_encoder_agrees_with_the_library(text):
    if not ENCODER:
        ENCODER.append(repair.Encoder(repair.byte_bpe_file()))
    e = ENCODER[0]
    for t in (text, text + text, "word " + text):
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.library.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 4000), st.integers(1, 40))
def test_grammar_round_trip_and_random_access(seed, n, alphabet):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, alphabet, n).astype("<u4")
    symbols, rules, first = repair.compress(ids, min_count=2, per_round=7, max_rounds=20)
    assert repair._expand(symbols, rules, first).tolist() == ids.tolist()
    docs = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([n])], names=["doc_id", "n_tokens"])
    shard = repair.Shard.of(repair.pack(ids, docs))
    assert shard.all().tolist() == ids.tolist()
    for _ in range(20):
        a, b = sorted(rng.integers(0, n + 3, 2).tolist())
        assert shard.read(a, b).tolist() == ids[a:b].tolist()


def test_repeats_become_few_symbols():
    ids = np.tile(np.arange(50, dtype=np.uint32), 2000)
    symbols, rules, _ = repair.compress(ids, max_rounds=8)
    assert len(symbols) < len(ids) / 20 and len(rules) < 300


def pair_counts(seq):
    """Occurrences of each pair of neighbours; of a run of overlapping ones every second."""
    counts, last = {}, {}
    for k, pair in enumerate(zip(seq, seq[1:])):
        if last.get(pair) != k - 1 or pair[0] != pair[1]:
            counts[pair], last[pair] = counts.get(pair, 0) + 1, k
    return counts


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 300), st.integers(1, 12), st.integers(1, 4))
def test_every_rule_is_the_most_frequent_pair_until_none_repeats(seed, n, alphabet, copies):
    seq = np.tile(np.random.default_rng(seed).integers(0, alphabet, n).astype("<u4"), copies)
    symbols, rules, first = repair.compress(seq)
    seq = seq.tolist()
    for k, (a, b) in enumerate(rules.tolist()):
        counts = pair_counts(seq)
        assert counts[a, b] == max(counts.values())
        out, i = [], 0
        while i < len(seq):
            hit = seq[i:i + 2] == [a, b]
            out.append(first + k if hit else seq[i])
            i += 2 if hit else 1
        seq = out
    assert symbols.tolist() == seq and max(pair_counts(seq).values(), default=0) < 2


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 150), st.integers(1, 9), st.integers(1, 3)), min_size=1, max_size=4))
def test_shards_compressed_together_get_the_grammars_of_their_own(many):
    shards = [np.tile(np.random.default_rng(seed).integers(0, alphabet, n).astype("<u4"), copies) for seed, n, alphabet, copies in many]
    for ids, (symbols, rules, first) in zip(shards, repair.compress_together(shards), strict=True):
        seq = ids.tolist()
        assert first == max(seq, default=0) + 1
        for k, (a, b) in enumerate(rules.tolist()):
            counts = pair_counts(seq)
            assert counts[a, b] == max(counts.values())
            out, i = [], 0
            while i < len(seq):
                hit = seq[i:i + 2] == [a, b]
                out.append(first + k if hit else seq[i])
                i += 2 if hit else 1
            seq = out
        assert symbols.tolist() == seq and max(pair_counts(seq).values(), default=0) < 2


@pytest.mark.parametrize("least_id", [0, 1 << 24])
def test_symbols_that_repeat_themselves_are_replaced_with_other_pairs(least_id):
    rng = np.random.default_rng(3)
    shards = [np.repeat(rng.integers(least_id, least_id + 60, 6_000), rng.integers(1, 7, 6_000)).astype("<u4") for _ in range(2)]
    for ids, (symbols, rules, first) in zip(shards, repair.compress_together(shards), strict=True):
        assert repair._expand(symbols, rules, first).tolist() == ids.tolist()
        assert max(pair_counts(symbols.tolist()).values()) < 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(st.one_of(st.sampled_from(" \n\t'’ab½é日"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_texts_encoded_together_agree_with_the_library(texts):
    if not ENCODER:
        ENCODER.append(repair.Encoder(repair.byte_bpe_file()))
    e = ENCODER[0]
    texts = [*texts, "plain words, and more\nof them", *(t and f"word {t} end" for t in texts)]
    got = [np.frombuffer(x, "<u4").tolist() for x in e.encode_all(pa.array(texts, pa.string()))]
    assert got == [e.library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_reading_task_takes_several_files(spark):
    docs = spark.createDataFrame([(i, f"some text {i % 7} of a file") for i in range(60)], "doc_id long, text string")
    files = repair.write(docs, scratch_path(spark, "rpg-many"), repair.byte_bpe_file(), max_shard_ids=20).localCheckpoint()
    got = repair.read(repair.starts(files))
    assert files.count() > 2 * repair.FILES_PER_READER and got.rdd.getNumPartitions() == -(-files.count() // repair.FILES_PER_READER)
    assert sorted(map(tuple, got.collect())) == plain_tokens([tuple(r) for r in docs.collect()])


def test_long_repeats_of_a_large_shard():
    ids = np.concatenate([np.tile(np.random.default_rng(5).integers(0, 50_000, 700), 300), np.zeros(10_001, int), np.arange(70_000)]).astype("<u4")
    shard = repair.Shard.of(repair.pack(ids, pa.RecordBatch.from_arrays([pa.array([1]), pa.array([len(ids)])], names=["doc_id", "n_tokens"])))
    assert shard.all().tolist() == ids.tolist() and len(shard.symbols) < 70_100
    assert shard.read(209_000, 211_000).tolist() == ids[209_000:211_000].tolist()


def test_a_damaged_file_is_refused():
    with pytest.raises(ValueError):
        repair.Shard.of(b"what" * 20)
