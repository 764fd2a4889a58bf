"""Star-schema aggregate: label joins on surrogate keys + grouped measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from strata.operators.broadcast import DEFAULT_MAX_BYTES
from strata.operators.lookup import attach


@dataclass(frozen=True)
class Label:
    """Add ``out`` = ``dim.label`` for the row whose ``dim.sk`` equals ``fact.fact_sk``."""

    dim: DataFrame
    sk: str
    label: str
    fact_sk: str
    out: str


def label(fact: DataFrame, labels: Sequence[Label], max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    out = fact
    for lb in labels:
        out = attach(out, lb.dim, lb.sk, lb.fact_sk, {lb.label: lb.out}, max_bytes)
    return out


def star_aggregate(
    fact: DataFrame,
    labels: Sequence[Label],
    groups: Sequence[str | Column],
    measures: Mapping[str, Column],
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Label the fact, then ``groupBy(groups).agg(measures)``.

    Lookups are broadcast (bounded), so the only shuffle is the aggregate's,
    and that one carries partial aggregates (map-side combine): a hot day or
    label costs one row per task, not one per trip. NULL sks give NULL labels,
    which form their own group, as in SQL.
    """
    labelled = label(fact, labels, max_bytes)
    return labelled.groupBy(*groups).agg(*[c.alias(n) for n, c in measures.items()])
