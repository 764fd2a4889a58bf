"""strata: layered (bronze / silver / gold) table building on Spark DataFrames.

Common entry points::

    from strata import get_spark, conform, valid_dates, dedup, with_row_hash
    from strata import build_dimension, extend_dimension, lookup_keys, star_aggregate
    from strata import write, replace_partitions, upsert, merge, row_count_check
"""

from strata.operators.checks import row_count_check
from strata.operators.conform import cast_failures, conform
from strata.operators.dimensions import build_dimension, date_dimension, extend_dimension
from strata.operators.filters import recent, valid_dates
from strata.operators.identity import dedup, with_row_hash, with_source_file
from strata.operators.keys import dense_key
from strata.operators.lookup import Lookup, lookup_keys
from strata.operators.mart import Label, star_aggregate
from strata.operators.upsert import merge
from strata.session import get_spark
from strata.sinks.writer import logged, replace_partitions, upsert, write

__version__ = "0.1.0"

__all__ = [
    "Label", "Lookup", "build_dimension", "cast_failures", "conform", "date_dimension", "dedup", "dense_key",
    "extend_dimension", "get_spark", "logged", "lookup_keys", "merge", "recent", "replace_partitions",
    "row_count_check", "star_aggregate", "upsert", "valid_dates", "with_row_hash", "with_source_file", "write",
]
