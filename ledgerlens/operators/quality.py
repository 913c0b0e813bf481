"""Data-quality gates (K1-K8). Each check returns a result table
``(check, key, expected, found, passed)``; ``gate`` turns failures into an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RESULT_COLS = ["check", "key", "expected", "found", "passed"]


class GateFailed(RuntimeError):
    pass


def check_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Required columns have no nulls (K1): one aggregate pass, one result row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c))]).alias("key", "found")
    out = counts.select(stacked)
    return out.select(
        F.lit("required").alias("check"), "key", F.lit(0).cast("long").alias("expected"), F.col("found").cast("long"),
        (F.col("found") == 0).alias("passed"),
    )


def check_monotone(counts: DataFrame, order_col: str, count_col: str) -> DataFrame:
    """Row counts never shrink between consecutive snapshots (K2). ``counts`` has one row per snapshot."""
    w = Window.orderBy(order_col)
    prev = F.lag(count_col).over(w)
    return counts.select(
        F.lit("monotone").alias("check"), F.col(order_col).cast("string").alias("key"), prev.cast("long").alias("expected"),
        F.col(count_col).cast("long").alias("found"), F.coalesce(F.col(count_col) >= prev, F.lit(True)).alias("passed"),
    )


def check_known_ids(known: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Every previously known id still resolves (K3): anti join, counted."""
    missing = known.select(key).distinct().join(current.select(key), key, "left_anti")
    n = missing.agg(F.count(F.lit(1)).alias("found"))
    return n.select(
        F.lit("known_ids").alias("check"), F.lit(key).alias("key"), F.lit(0).cast("long").alias("expected"),
        F.col("found").cast("long"), (F.col("found") == 0).alias("passed"),
    )


def gate(result: DataFrame, passed_col: str = "passed") -> DataFrame:
    """Raise ``GateFailed`` if any row failed (K4); the publish step runs only after this returns.
    Only a LIMIT-1 probe of failed rows reaches the driver."""
    bad = result.where(~F.coalesce(F.col(passed_col), F.lit(False))).limit(1).collect()
    if bad:
        raise GateFailed(f"quality gate failed, e.g. {bad[0].asDict()}")
    return result


def assert_measure(df: DataFrame, group_cols: Sequence[str], measure_col: str = "measure") -> None:
    """Distinct measures are never added together: any grouping must keep the measure column (K5)."""
    if measure_col not in group_cols:
        raise GateFailed(f"grouping {list(group_cols)} would add different measures; include '{measure_col}'")


def sum_by_measure(df: DataFrame, group_cols: Sequence[str], value: str, measure_col: str = "measure") -> DataFrame:
    assert_measure(df, group_cols, measure_col)
    return df.groupBy(*group_cols).agg(F.sum(value).alias("total"))


def freshness(df: DataFrame, by: str, ts: str) -> DataFrame:
    """Last timestamp per source and the size of its newest daily batch (K6).

    One pass: rows are counted per (source, day) by a partial aggregate; the newest day and its
    count are then picked from that small table with ``max_by``.
    """
    day = F.to_date(F.col(ts))
    per_day = df.groupBy(by, day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last_ts"))
    return per_day.groupBy(by).agg(
        F.max("last_ts").alias("last_ts"), F.max("day").alias("newest_day"), F.max_by("n", "day").alias("n_newest")
    )


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Duplicate keys (K7): number of keys seen more than once and rows under them."""
    c = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return c.agg(F.count(F.lit(1)).alias("n_dup_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_dup_rows"))


def check_zero_null(df: DataFrame, cols: Sequence[str], entity: str | None = None) -> DataFrame:
    """No-data (null) and zero kept apart: null / zero / present counts per field (K8)."""
    from .aggs import completeness

    return completeness(df, entity, list(cols))
