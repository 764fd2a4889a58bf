"""Schema conform (P1): cast listed columns to their declared types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _as_mapping(schema: Mapping[str, DataType] | StructType) -> dict[str, DataType]:
    if isinstance(schema, StructType):
        return {f.name: f.dataType for f in schema.fields}
    return dict(schema)


def conform(
    df: DataFrame,
    schema: Mapping[str, DataType] | StructType,
    strict: bool = True,
    add_missing: bool = True,
    rejects: str | None = None,
) -> DataFrame:
    """Cast each declared column that exists; pass other columns through.

    Names are matched without case and the declared spelling is emitted
    (``Airport_fee`` becomes ``airport_fee``). Declared columns the input
    lacks are added as typed NULLs when ``add_missing`` is set, so a later
    fixed projection does not fail on an older file. ``strict`` keeps the
    ANSI cast (a bad value fails the job); otherwise ``try_cast`` turns it
    into NULL (count those with :func:`cast_failures`). ``rejects`` names a column
    to add: the row's values that the lenient cast loses, as an array of
    (column, value as text), empty for a row that lost none. One ``select``, so
    the whole conform is a single Project inside whole-stage codegen.
    """
    declared = _as_mapping(schema)
    by_lower = {name.lower(): name for name in declared}
    present: set[str] = set()
    out, lost = [], []
    for c in df.columns:
        canon = by_lower.get(c.lower())
        if canon is None or canon in present:
            out.append(F.col(f"`{c}`"))
            continue
        present.add(canon)
        src = F.col(f"`{c}`")
        typ = declared[canon]
        cast = src.cast(typ) if strict else src.try_cast(typ)
        out.append(cast.alias(canon))
        lost.append(F.when(src.isNotNull() & src.try_cast(typ).isNull(), F.struct(F.lit(canon).alias("column"), src.cast("string").alias("value"))))
    if add_missing:
        for name, typ in declared.items():
            if name not in present:
                out.append(F.lit(None).cast(typ).alias(name))
    if rejects is not None:
        if strict:
            raise ValueError("conform: a strict cast rejects nothing")
        none = F.array().cast("array<struct<column:string,value:string>>")
        out.append((F.array_compact(F.array(*lost)) if lost else none).alias(rejects))
    return df.select(*out)


def cast_failures(df: DataFrame, schema: Mapping[str, DataType] | StructType) -> DataFrame:
    """One row: per declared column, how many non-NULL values ``try_cast`` turns NULL."""
    declared = _as_mapping(schema)
    by_lower = {c.lower(): c for c in df.columns}
    aggs = []
    for name, typ in declared.items():
        src_name = by_lower.get(name.lower())
        if src_name is None:
            continue
        src = F.col(f"`{src_name}`")
        lost = src.isNotNull() & src.try_cast(typ).isNull()
        aggs.append(F.count(F.when(lost, 1)).alias(name))
    if not aggs:
        return df.agg(F.count(F.lit(1)).alias("rows")).drop("rows")
    return df.agg(*aggs)
