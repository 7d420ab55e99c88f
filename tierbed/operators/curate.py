"""Rule-driven curation: fallback chains, default fill and run stamps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierbed.functions.columns import fill_default


@dataclass(frozen=True)
class FillRule:
    """``target`` is the first non-NULL of ``sources`` as a string, else ``default``."""

    target: str
    sources: tuple[str, ...]
    default: str = "UNKNOWN"


def stamp_run(df: DataFrame, run_id: str, column: str = "ingestion_run_id") -> DataFrame:
    """Put the run id on every row."""
    return df.withColumn(column, F.lit(run_id))


def curate(
    df: DataFrame, run_id: str, rules: Sequence[FillRule], blank_as_missing: bool = False
) -> DataFrame:
    """Apply ``rules`` and stamp run id and ingestion time; other columns pass through.

    All rules read the input row, not each other's results. A source column that ``df`` lacks
    counts as NULL.
    """
    there = set(df.columns)
    columns = {
        rule.target: fill_default(
            *[s if s in there else F.lit(None) for s in rule.sources], default=rule.default, blank_as_missing=blank_as_missing
        )
        for rule in rules
    }
    columns["ingestion_run_id"] = F.lit(run_id)
    columns["ingestion_ts_utc"] = F.current_timestamp()
    return df.withColumns(columns)
