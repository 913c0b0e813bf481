"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_union(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct union of key sets (G1, F3). Sorting is left to the consumer."""
    return left.select(*cols).union(right.select(*cols)).distinct()


def align_union(dfs: Sequence[DataFrame], renames: Sequence[Mapping[str, str]]) -> DataFrame:
    """Union of batches written with different column names: rename each, then union by name,
    a missing column becomes null (G2)."""
    out = None
    for df, ren in zip(dfs, renames, strict=True):
        d = df
        if ren:
            d = d.withColumnsRenamed(dict(ren))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def key_intersect(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys present in both."""
    return left.select(*cols).intersect(right.select(*cols))


def key_except(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys of ``left`` not in ``right`` (distinct)."""
    return left.select(*cols).subtract(right.select(*cols))


def column_union(df: DataFrame, map_col, order_col: str) -> DataFrame:
    """Union of record keys in first-seen order.

    Each key's first appearance is the smallest (row order, position in row) pair, found by a
    partial aggregate; the result has one row per key with its ordinal.
    """
    keyed = df.select(order_col, F.posexplode(F.map_keys(map_col)).alias("pos", "key"))
    first = keyed.groupBy("key").agg(F.min(F.struct(order_col, "pos")).alias("__first"))
    return first.select("key", F.col(f"__first.{order_col}").alias("first_row"), F.col("__first.pos").alias("first_pos"))
