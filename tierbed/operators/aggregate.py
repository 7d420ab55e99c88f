"""Distinct entities per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_counts(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str = "id",
    out: str = "entity_count",
    ordered: bool = True,
) -> DataFrame:
    """Distinct non-NULL ids per group, largest group first.

    Spark deduplicates (keys, id) before and after the first shuffle and shuffles
    only per-task counts to the group keys, so a group that holds much of the
    table is spread over all tasks. The keys break ties in the order.
    """
    counts = df.groupBy(*keys).agg(F.count_distinct(F.col(id_col)).alias(out))
    return counts.orderBy(F.desc(out), *keys) if ordered else counts
