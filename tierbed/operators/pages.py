"""Keep the pages before the first empty one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contiguous_prefix(df: DataFrame, page: str = "page", max_pages: int | None = None) -> DataFrame:
    """Rows of pages 1, 2, .. up to the first page that has no rows.

    The first missing page is found without ordering pages: every page stands for
    itself and asks for its successor, and the lowest page that is asked for but
    absent is the gap. It enters the filter as a scalar subquery, so the rows
    themselves are not shuffled. ``df`` is read twice: pass staged data, not a source.
    """
    pages = df.select(F.col(page).cast("bigint").alias("n")).filter(F.col("n") >= 1).distinct()
    found = F.struct(F.col("n"), F.lit(True).alias("present"))
    asked = F.struct((F.col("n") + 1).alias("n"), F.lit(False).alias("present"))
    first_gap = (
        pages.select(F.inline(F.array(found, asked)))
        .groupBy("n")
        .agg(F.bool_or("present").alias("present"))
        .agg(
            F.min(F.when(F.col("present"), F.col("n"))).alias("lowest"),
            F.min(F.when(~F.col("present"), F.col("n"))).alias("gap"),
        )
        .select(F.when(F.col("lowest") == 1, F.col("gap")).otherwise(F.lit(1)).alias("gap"))
    )
    kept = (F.col(page) >= 1) & (F.col(page) < first_gap.scalar())
    if max_pages is not None:
        kept = kept & (F.col(page) <= max_pages)
    return df.filter(kept)


def fetch_totals(df: DataFrame, page: str = "page") -> DataFrame:
    """One row: rows and pages fetched."""
    return df.agg(
        F.count(F.lit(1)).alias("fetched_rows"),
        F.count_distinct(F.col(page)).alias("pages_fetched"),
    )


def prefix_totals(counts: DataFrame, max_pages: int | None = None) -> DataFrame:
    """One row from the rows of each page, ``counts(page, rows)``: ``fetched_rows`` and
    ``pages_fetched`` of the pages before the first absent one, at most ``max_pages``, and
    ``truncated``, whether that left pages out.

    Gap, totals, the gate against empty runs and the sizes of files all follow from ``counts``, so
    the records are not read for them.
    """
    kept = F.lit(True) if max_pages is None else F.col("page") <= max_pages
    return contiguous_prefix(counts.filter(F.col("rows") > 0)).agg(
        F.coalesce(F.sum(F.when(kept, F.col("rows"))), F.lit(0).cast("bigint")).alias("fetched_rows"),
        F.count(F.when(kept, True)).alias("pages_fetched"),
        F.coalesce(F.bool_or(~kept), F.lit(False)).alias("truncated"),
    )
