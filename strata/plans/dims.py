"""Build all configured dimensions (C8) — initial or incremental load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.operators import runlog
from strata.operators.dimensions import build_dimension, extend_dimension, new_members
from strata.sinks.writer import exists, read_table, write


@dataclass(frozen=True)
class DimensionSpec:
    """One dimension: its natural key, its surrogate key (None: the natural key serves, as in a calendar) and its rows."""

    name: str
    key: str
    sk: str | None
    seed: Callable[[SparkSession], DataFrame]
    path: str
    order: int = 0
    enabled: bool = True
    fmt: str = "parquet"
    source: str = "seed"


def _next_version(spark: SparkSession, spec: DimensionSpec, incremental: bool) -> DataFrame:
    seed = spec.seed(spark)
    # Only a table that does not exist is built anew; one that cannot be read raises
    # here, since building it again would renumber its keys.
    if not (incremental and exists(spark, spec.path)):
        return seed if spec.sk is None else build_dimension(seed, spec.key, spec.sk)
    current = read_table(spark, spec.path, spec.fmt)
    if spec.sk is None:
        return current.unionByName(new_members(current, seed.select(*current.columns), spec.key).select(*current.columns))
    return extend_dimension(current, seed, spec.key, spec.sk)


def build_all(spark: SparkSession, specs: Sequence[DimensionSpec], incremental: bool = True,
              log_path: str | None = None, on_step: Callable[[str], None] | None = None) -> dict[str, DataFrame]:
    """Enabled dimensions in ``order``; each written, then returned as read back.

    With ``incremental`` an existing dimension is extended (old surrogate keys
    never move); otherwise, or when none exists, it is built from its seed.
    With ``log_path`` all are logged UPLOADING before the first write and SUCCESS or
    FAILED (the one that failed, with its error) after the last, one append each. A dimension whose
    overwrite was cut off is the old or the new version, never "none": see
    :mod:`strata.sinks.writer` (``on_step`` is passed on to its ``write``).
    """
    todo = sorted((s for s in specs if s.enabled), key=lambda s: s.order)
    steps = {} if on_step is None else {"on_step": on_step}

    def note(states: dict[str, tuple[str, str | None]]) -> None:
        """One append for the status rows of all dimensions."""
        if log_path is not None and states:
            runlog.append_log(runlog.log_rows(spark, [
                dict(file_name=s.name, source=s.source, destination=s.path, load_type="overwrite", layer="silver", status=states[s.name][0], error=states[s.name][1])
                for s in todo if s.name in states]), log_path)

    note({s.name: (runlog.UPLOADING, None) for s in todo})
    ended: dict[str, tuple[str, str | None]] = {}
    try:
        for spec in todo:
            ended[spec.name] = (runlog.FAILED, "cut off")
            write(_next_version(spark, spec, incremental), spec.path, "overwrite", None, spec.fmt, **steps)
            ended[spec.name] = (runlog.SUCCESS, None)
    except Exception as e:  # noqa: BLE001 - logged, then raised again
        ended[spec.name] = (runlog.FAILED, str(e))
        raise
    finally:
        note(ended)
    return {s.name: read_table(spark, s.path, s.fmt) for s in todo}
