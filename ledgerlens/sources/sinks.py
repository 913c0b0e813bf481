"""Sinks: cross-tab export (A10) and dated snapshot folders (A2, see bulletins.write_snapshot)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def crosstab(df: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Counts (and optionally a value sum) per key combination (A10): one partial aggregate."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias(f"sum_{value}"))
    return df.groupBy(*keys).agg(*aggs)


def write_crosstab(df: DataFrame, keys: Sequence[str], path: str, value: str | None = None, files: int = 1) -> DataFrame:
    """Write the cross-tab as CSV with a header (A10). The table has one row per key combination,
    so it is coalesced to ``files`` output files after the aggregate (never before it)."""
    out = crosstab(df, keys, value).orderBy(*keys)
    out.coalesce(files).write.mode("overwrite").option("header", True).csv(path)
    return out
