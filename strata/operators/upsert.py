"""Upsert of a source DataFrame into a target DataFrame.

Semantics of "update all on match, insert all otherwise, with schema
evolution":

* a target row whose keys equal a source row's keys is replaced by the
  source row; columns only the target has keep the target value;
* a source row matching no target row is inserted; columns only the target
  has are NULL for it; columns only the source has are added (NULL for
  untouched target rows);
* a source NULL overwrites a target value (selection is by match, never by
  ``coalesce``); NULL keys never match, so such rows insert;
* two source rows matching the same target row fail the job.

Plan shape (no full outer join, so hot keys stay splittable):

1. ``src_keys`` = source keys with their count: a partial aggregate, so a key
   repeated in a third of the source shrinks map-side;
2. untouched target = target LEFT JOIN src_keys where no key matched
   (a matched key with count > 1 raises inside the same pass);
3. updated + inserted = source LEFT JOIN (keys + target-only columns) of the
   target; skipped entirely when the target has no target-only columns;
4. union by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CNT = "__src_n"
_HIT = "__tgt_hit"


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], rprefix: str):
    cond = None
    for k in keys:
        c = left[k] == right[f"{rprefix}{k}"]
        cond = c if cond is None else cond & c
    return cond


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merged table as a DataFrame (target columns first, then new ones)."""
    keys = list(keys)
    tcols = target.columns
    scols = source.columns
    tset, sset = set(tcols), set(scols)
    for k in keys:
        if k not in tset or k not in sset:
            raise ValueError(f"merge key {k!r} must be in both source and target")
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    # Source values take the target's type for shared columns (as MERGE does).
    src = source.select(*[
        (F.col(c).cast(ttypes[c]) if c in tset and ttypes[c] != source.schema[c].dataType else F.col(c)).alias(c)
        for c in scols
    ])
    target_only = [c for c in tcols if c not in sset]
    out_cols = tcols + [c for c in scols if c not in tset]

    src_keys = (
        src.groupBy(*keys).agg(F.count(F.lit(1)).alias(_CNT))
        .select(*[F.col(k).alias(f"__s_{k}") for k in keys], _CNT)
    )
    joined = target.join(src_keys, _key_cond(target, src_keys, keys, "__s_"), "left")
    untouched = (
        joined.where(
            F.when(F.col(_CNT) > 1, F.raise_error(F.lit("merge: several source rows match one target row")))
            .otherwise(F.col(_CNT).isNull())
        )
        .select(*tcols)
    )

    if target_only:
        tgt_side = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys], *target_only)
        changed = src.join(tgt_side, _key_cond(src, tgt_side, keys, "__t_"), "left").select(*scols, *target_only)
    else:
        changed = src

    def align(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        types = {**{f.name: f.dataType for f in src.schema.fields}, **ttypes}
        return df.select(*[F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in out_cols])

    return align(untouched).unionByName(align(changed))
