"""Dense surrogate keys 1..n in natural-key order.

``row_number().over(Window.orderBy(key))`` moves every row into one task.
Here rows are cut into value buckets, numbered inside each bucket by a
partitioned window, and shifted by the row count of all lower buckets. The
number of buckets follows the number of rows; their boundaries come from
approximate quantiles of the key. The bucket of a row is a pure function of its
key, so the count pass and the numbering pass agree however often a task is
retried. Buckets are balanced by rank, so a dense run of keys does not pile into
one task. It is the same plan at every size; few rows are one bucket, which
needs neither quantiles nor bucket counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from strata.operators.broadcast import is_bounded

_QUANTILE_TYPES = (
    ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType,
    DecimalType, DateType, TimestampType, TimestampNTZType,
)
# Rows of a bucket, as long as that takes no more than MAX_BUCKETS (10^9 rows); buckets grow beyond.
ROWS_PER_BUCKET = 1 << 18
MAX_BUCKETS = 4096
# Sampled keys a bucket where the type has no quantiles.
_SAMPLED = 64
_BUCKET = "__sk_bucket"
_PREV = "__sk_prev"


def _literals(values: list, dtype) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(ArrayType(dtype))


def _with_bucket(df: DataFrame, key: str, bounds: list) -> DataFrame:
    """Add the number of boundaries below ``key``: a binary search, one projection a halving."""
    if not bounds:
        # 0 as an expression of the key: over a constant, the window below would have no partition key
        return df.withColumn(_BUCKET, F.pmod(F.hash(key), F.lit(1)))
    sorted_bounds, step = _literals(bounds, df.schema[key].dataType), 1 << (len(bounds).bit_length() - 1)
    at = F.lit(0)
    while step:
        mid = at + F.lit(step)
        df = df.withColumn(_BUCKET, at + F.when(
            (mid <= len(bounds)) & (F.col(key) > F.get(sorted_bounds, mid - 1)), F.lit(step)).otherwise(F.lit(0)))
        at, step = F.col(_BUCKET), step >> 1
    return df


def _boundaries(df: DataFrame, key: str, n_buckets: int) -> list:
    """Up to ``n_buckets - 1`` sorted, distinct key boundaries."""
    if n_buckets == 1:
        return []
    if isinstance(df.schema[key].dataType, _QUANTILE_TYPES):
        probs = F.split(F.lit(",".join(str(i / n_buckets) for i in range(1, n_buckets))), ",").cast("array<double>")
        found = df.agg(F.percentile_approx(F.col(key), probs, max(10_000, 10 * n_buckets)).alias("b")).first()["b"] or []
    else:
        # keys without quantile support (strings): quantiles of a bounded sample, the first by hash
        sample = df.select(key).where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(_SAMPLED * n_buckets)
        values = sorted(r[0] for r in sample.collect())
        found = [values[len(values) * i // n_buckets] for i in range(1, n_buckets)] if values else []
    return sorted({b for b in found if b is not None})


def _cheap_to_repeat(df: DataFrame) -> bool:
    """Whether all inputs of ``df`` together are small and it gives the same rows each time."""
    return bool(df._jdf.queryExecution().optimizedPlan().deterministic()) and is_bounded(df)


def dense_key(
    df: DataFrame,
    key: str,
    sk: str,
    offset: int = 0,
    buckets: int | None = None,
    first: bool = True,
    stage_input: bool = True,
) -> DataFrame:
    """Add ``sk`` = 1-based rank of ``key`` (+ ``offset``) as INT.

    ``key`` must be unique and not NULL; a violation fails the job (checked
    inside the numbering pass, no extra scan). The result has ``sk`` first
    when ``first`` is set. There is a bucket for each :data:`ROWS_PER_BUCKET`
    rows unless ``buckets`` says how many. Up to four passes read the input (row
    count, quantiles, bucket counts, numbering), so it is written once to the shared
    checkpoint folder, unless it is computed from a few megabytes; callers whose input is
    itself a plain scan or a few literal rows may skip that with ``stage_input=False``.
    """
    if stage_input and not _cheap_to_repeat(df):
        from strata.sinks.writer import stage

        df = stage(df, "dense-key-input")
    if buckets is None:
        buckets = min(MAX_BUCKETS, 1 + df.count() // ROWS_PER_BUCKET)
    kcol = F.col(key)
    bounds = _boundaries(df, key, buckets)
    tagged = _with_bucket(df, key, bounds)
    starts, acc = [], 0
    if bounds:
        counts = dict(tagged.groupBy(_BUCKET).count().collect())  # a row a bucket
        for b in range(len(bounds) + 1):
            starts.append(acc)
            acc += counts.get(b, 0)
    base = F.get(_literals(starts, LongType()), F.col(_BUCKET)) if bounds else F.lit(0)
    if len(bounds) >= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        tagged = tagged.repartition(len(bounds) + 1, _BUCKET)

    w = Window.partitionBy(_BUCKET).orderBy(kcol)
    rn = F.row_number().over(w)
    numbered = tagged.withColumn(_PREV, F.lag(kcol).over(w)).withColumn(
        sk,
        F.when(kcol.isNull(), F.raise_error(F.lit(f"dense_key: NULL in key column {key}")))
        .when(F.col(_PREV) == kcol, F.raise_error(F.concat(F.lit(f"dense_key: duplicate {key} "), kcol.cast("string"))))
        .otherwise((rn + base + F.lit(offset)).cast("int")),
    ).drop(_BUCKET, _PREV)
    return numbered.select(sk, *[c for c in numbered.columns if c != sk]) if first else numbered
