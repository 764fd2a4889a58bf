"""Column expressions: built-in Spark functions composed for the operators."""

from strata.functions.dates import as_date, date_part_columns, month_start, seconds_between
from strata.functions.identity import row_hash

__all__ = ["as_date", "date_part_columns", "month_start", "row_hash", "seconds_between"]
