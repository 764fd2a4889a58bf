"""Connected components of a link table: stars within tasks first, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sinks.writer import stage

EDGES_PER_RUN = 1 << 20  # edges that a task holds at a time


def _large_star(e: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest of its neighbourhood."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of them (``u > v`` in every row)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _runs_as_stars(run: int):
    """Each run of edges as stars: every node is tied to the smallest that the edges of its run join it to."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        nodes, at = np.unique(np.concatenate([t.column("u").to_numpy(), t.column("v").to_numpy()]), return_inverse=True)
        a, b, root = at[:len(t)], at[len(t):], np.arange(len(nodes))
        while ((x := root[a]) != (y := root[b])).any():
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while ((up := root[root]) != root).any():
                root = up
        tied = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[i], k) for i, k in zip((tied, root[tied]), t.schema.types, strict=True)], names=["u", "v"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for k in range(0, batch.num_rows, run):
                held.append(batch.slice(k, run))
                if sum(x.num_rows for x in held) >= run:
                    yield stars(held)
                    held = []
        if held:
            yield stars(held)

    return go


def _are_stars(e: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one, and that has none itself."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(e.select("v", F.lit(0)))
    return ends.groupBy("node").agg(F.sum("up").alias("n"), F.min("up").alias("leaf")).where("n > 1 or (n = 1 and leaf = 0)").isEmpty()


def components(links: DataFrame, run: int = EDGES_PER_RUN) -> DataFrame:
    """(node, comp) for every node with a smaller one in its component; comp is the smallest node there.

    Edges that meet in a task become stars there, ``run`` at a time, without a shuffle; few
    links meet in one task and are done. Rounds for what is left grow with the
    logarithm of the component's size; each is written to the shared folder, so
    a lost executor never re-runs earlier rounds. They end as soon as all are stars.
    """
    a, b = links.columns
    e = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    kinds = e.schema.simpleString().removeprefix("struct<").removesuffix(">")
    e = stage(e.mapInArrow(_runs_as_stars(run), kinds.replace(":", " ")), "components")
    while not _are_stars(e):
        e = stage(_small_star(_large_star(e).distinct()), "components")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
