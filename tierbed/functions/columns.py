"""Column expressions shared by the operators. All of them stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(column: Column | str, blank_as_missing: bool = False) -> Column:
    """Cast to string; with ``blank_as_missing`` an empty or blank value is NULL."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(F.trim(text) != "", text) if blank_as_missing else text


def fill_default(
    *columns: Column | str, default: str = "UNKNOWN", blank_as_missing: bool = False
) -> Column:
    """First non-NULL of ``columns``, else ``default``, as a string.

    Each argument is cast before the coalesce. Casting afterwards makes ANSI mode
    try to read the default as the column's own type and fail on a numeric column.
    """
    texts = [as_text(c, blank_as_missing) for c in columns]
    return F.coalesce(*texts, F.lit(default))


def output_slices(
    n_rows: Column | int, max_slices: int = 8, rows_per_slice: int = 500
) -> Column | int:
    """Number of output files for ``n_rows``: one per ``rows_per_slice``, bounded.

    Takes a Python int (to size a write) or a Column (to size many at once).
    """
    if isinstance(n_rows, int):
        return min(max_slices, max(1, n_rows // rows_per_slice))
    wanted = F.floor(n_rows / F.lit(rows_per_slice))
    return F.least(
        F.lit(max_slices).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), wanted)
    )
