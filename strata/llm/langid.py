"""Language identification by hierarchical discrimination.

Texts become hashed counts of character trigrams and whole words. A first
linear model picks the language family; inside a family, one-versus-one linear
support vector machines vote between its closely related languages.

Training rows are a bounded sample (``per_language`` labelled texts a language
and ``MAX_TEXTS`` in all, the first by a hash of the id). Whole texts are learnt
from and predicted: tasks count the features of the sampled texts, and their
sparse vectors are what the fit on the driver sees.

Families come from a table; a language that is not listed joins the family of
the learnt language whose mean vector is nearest, if that is near enough, and is
a family of its own otherwise. The model holds 131,073 weights for each pair of
families and each pair of languages within one (1 MB a pair).

Defined cases: a text that is null or has no letter (Unicode class L) is ``und``
with score 0; rows with a null label are not learnt from; with no labelled row
at all every text is ``und``; one learnt language is predicted with score 1;
repeated rows are rows; a very long text weighs as much as a short one in the
fit. Columns other than the text (and, for the fit, label and id) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
PER_LANGUAGE = 1_200
MAX_TEXTS = 40_000
NEAR = 0.6  # cosine of mean vectors from which an unlisted language joins a family
BITS = 16
# Families of related languages (fixed values); a code that is not listed is a family of its own.
FAMILIES = {
    "de": "germanic", "en": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "cs": "slavic", "pl": "slavic", "ru": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic", "hi": "indic", "ur": "indic", "bn": "indic",
}
_GAPS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SALT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def features(text: str) -> np.ndarray:
    """Hashed trigrams (over bytes, words padded by a space) and words; empty if there is no letter."""
    if not text or not any(map(str.isalpha, text)):  # isalpha: Unicode's class L
        return np.empty(0, np.int64)
    data = text.lower().encode("utf-8", "replace").translate(_GAPS)
    words = data.split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    code = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    gaps = np.flatnonzero(b == 32)
    # a word's hash is a difference of running sums, so that all words of a text are hashed at once
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) ** np.uint64(3) * _POWER(len(b)), dtype=np.uint64)])
    whole = (run[gaps[1:]] - run[gaps[:-1] + 1]) * _INVERSE(gaps[:-1])
    tri = code * np.uint32(_SALT[0])
    return np.concatenate([tri >> np.uint32(32 - BITS), ((whole * np.uint64(_SALT[1] << 32 | _SALT[2])) >> np.uint64(64 - BITS)) | np.uint64(1 << BITS)]).astype(np.int64)


_ODD, _ODD_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _table(which: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        t = np.full(max(n, 1 << 12) * 2, base, np.uint64)
        t[0] = 1
        _powers[which] = have = np.cumprod(t, dtype=np.uint64)
    return have


def _POWER(n: int) -> np.ndarray:
    return _table("up", _ODD, n)[:n]


def _INVERSE(at: np.ndarray) -> np.ndarray:
    return _table("down", _ODD_INVERSE, int(at.max(initial=0)) + 1)[at]


def _svm(x: list[np.ndarray], y: np.ndarray, epochs: int = 6, reg: float = 1e-4) -> np.ndarray:
    """Linear SVM by averaged stochastic subgradient steps on unit vectors of root counts (last weight: bias)."""
    w, total, steps = np.zeros((2 << BITS) + 1), np.zeros((2 << BITS) + 1), 0
    rng = np.random.default_rng(17)
    share = {s: 0.5 * len(y) / max(1, (y == s).sum()) for s in (-1, 1)}
    for epoch in range(epochs):
        rate, w_scale = 2.0 / (1 + epoch), 1 - reg
        for i in rng.permutation(len(x)):
            idx, val = x[i]
            margin = y[i] * (w[idx] @ val + w[-1])
            if margin < 1:
                w[idx] += rate * share[y[i]] * y[i] * val
                w[-1] += 0.05 * rate * share[y[i]] * y[i]
        w *= w_scale ** len(x) if reg * len(x) < 1 else 0.5
        total += w
        steps += 1
    return (total / max(1, steps)).astype(np.float64)


def _vector(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx, n = np.unique(f, return_counts=True)
    v = np.sqrt(n)
    return idx, v / np.sqrt((v * v).sum())


@dataclass
class Model:
    """``pairs``: (families, languages within): weight columns of one matrix, each telling its first name from its second."""

    families: dict[str, list[str]]
    family_pairs: list[tuple[str, str]]
    language_pairs: list[tuple[str, str]]
    weights: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        lang, family, within = self.steps(text)
        return lang, family * within

    def steps(self, text: str | None) -> tuple[str, float, float]:
        """Language, and how sure the family step and the step within the family are."""
        f = features(text) if text else ()
        if not len(f) or not self.families:
            return UNDETERMINED, 0.0, 0.0
        idx, val = _vector(f)
        margins = val @ self.weights[idx] + self.weights[-1]
        family, p = _vote(self.family_pairs, margins[:len(self.family_pairs)], list(self.families))
        at = [k for k, (a, _) in enumerate(self.language_pairs) if a in self.families[family]]
        lang, q = _vote([self.language_pairs[k] for k in at], margins[[len(self.family_pairs) + k for k in at]], self.families[family])
        return lang, p, q


def _vote(pairs: list[tuple[str, str]], margins: np.ndarray, names: list[str]) -> tuple[str, float]:
    """Winner by summed pairwise probabilities, and the smallest probability with which it beats another."""
    if len(names) == 1:
        return names[0], 1.0
    points, least = dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
    for (a, b), p in zip(pairs, 1 / (1 + np.exp(-np.clip(3 * margins, -30, 30))), strict=True):
        for name, q in ((a, p), (b, 1 - p)):
            points[name] += float(q)
            least[name] = min(least[name], float(q))
    best = max(names, key=lambda n: points[n])
    return best, least[best]


def _families(vectors: list[tuple[str, tuple[np.ndarray, np.ndarray]]], known: dict[str, str]) -> dict[str, str]:
    """Family of each learnt language: the table's, or that of the nearest language, most similar pairs first."""
    names = sorted({n for n, _ in vectors})
    mean = np.zeros((len(names), 2 << BITS))
    for n, (idx, val) in vectors:
        mean[names.index(n), idx] += val
    mean /= np.maximum(np.sqrt((mean * mean).sum(1, keepdims=True)), 1e-12)
    near = mean @ mean.T
    family = {n: known[n] for n in names if n in known}
    while open_ := [n for n in names if n not in family]:
        pairs = [(near[names.index(a), names.index(b)], a, b) for a in open_ for b in names if b != a]
        score, a, b = max(pairs, default=(0.0, open_[0], None))
        if score < NEAR or b is None:
            family.update({n: n for n in open_})
        else:
            family[a] = family[b] = family.get(b, b)
    return family


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          per_language: int = PER_LANGUAGE, families: dict[str, str] | None = None) -> Model:
    """Fit on at most ``per_language`` rows a language, the first by a hash of ``key``."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"),
                                                          F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("o"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not counts:
        return Model({}, [], [], np.zeros(((2 << BITS) + 1, 0)))
    per_language = max(1, min(per_language, MAX_TEXTS // len(counts)))
    # by the hash alone most rows are out before anything is shuffled; the rank then sets the exact bound
    rate = F.element_at(F.create_map(*[F.lit(x) for n, c in counts.items() for x in (n, min(1.0, 1.5 * per_language / c))]), F.col("lang"))
    likely = rows.where(F.pmod("o", F.lit(1 << 30)) < rate * float(1 << 30)).where(F.col("text").rlike(r"\p{L}"))
    ranked = likely.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("o", "text"))).where(F.col("r") <= per_language)

    @F.pandas_udf("array<binary>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([[i.astype("<i4").tobytes(), v.astype("<f4").tobytes()] if len(i) else None for i, v in (_vector(features(t)) for t in texts)])

    # a partition at a time; a feature takes eight bytes, and nothing but the vectors stays
    sample = [(r["lang"], r["r"], np.frombuffer(r["v"][0], "<i4"), np.frombuffer(r["v"][1], "<f4"))
              for r in ranked.select("lang", "r", counted("text").alias("v")).toLocalIterator() if r["v"]]
    vectors = [(n, (i, v)) for n, _, i, v in sorted(sample, key=lambda x: x[:2])]
    family_of = _families(vectors, FAMILIES if families is None else families)
    by_family: dict[str, list[str]] = {}
    for n in sorted(family_of):
        by_family.setdefault(family_of[n], []).append(n)
    family_pairs = list(combinations(by_family, 2))
    language_pairs = [p for ns in by_family.values() for p in combinations(ns, 2)]

    def fit(of, a: str, b: str) -> np.ndarray:
        rows = [(v, 1 if of(n) == a else -1) for n, v in vectors if of(n) in (a, b)]
        return _svm([v for v, _ in rows], np.array([y for _, y in rows]))

    columns = [fit(family_of.get, a, b) for a, b in family_pairs] + [fit(lambda n: n, a, b) for a, b in language_pairs]
    weights = np.stack(columns, 1) if columns else np.zeros(((2 << BITS) + 1, 0))
    return Model(by_family, family_pairs, language_pairs, weights)


def predictor(model: Model):
    """A column function text -> struct(lang, score, family_score, language_score); the model goes along."""

    @F.pandas_udf("lang string, score double, family_score double, language_score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            told = [model.steps(t) for t in batch]
            yield pd.DataFrame([(n, p * q, p, q) for n, p, q in told], columns=["lang", "score", "family_score", "language_score"])

    return predict


def identify(model: Model, text: str = "text") -> Column:
    return predictor(model)(F.col(text))
