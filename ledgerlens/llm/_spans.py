"""Positions of regular-expression matches, and other helpers, with DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20  # tables of so much at most are broadcast


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows and bytes are few, else with one for a hash
    join behind a shuffle, which does not sort the texts on the other side."""
    size = F.sum(F.length(F.to_json(F.struct("*"))))
    n, width = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (width or 0) <= BROADCAST_BYTES else df.hint("shuffle_hash")


def text_hash(text: Column) -> Column:
    """Tells rows of one id apart; null for a null text."""
    return F.when(text.isNotNull(), F.xxhash64(text.cast("string")))


def finding(kind: Column, text: Column, pattern: Column, group: int | None = None) -> Column:
    """A kind's matches in a text, the text between them, and one group of each match."""
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.struct(kind.alias("kind"), F.split(text, pattern, -1).alias("between"), whole.alias("matches"),
                    (F.regexp_extract_all(text, pattern, F.lit(group)) if group is not None else whole).alias("values"))


def located(found: DataFrame, keys: list[str], column: str, measure: Callable[[Column], Column] = F.length) -> DataFrame:
    """(keys, kind, start, end, value) of each match in ``column`` (made by ``finding``), in units of ``measure``.

    Matches are never empty; a match's start is the length of all that stands before it, so running
    sums over the pieces give it in one pass."""
    order = Window.partitionBy(*keys, "kind").orderBy("i")
    return (
        found
        .select(*keys, F.col(f"{column}.kind").alias("kind"),
                # outer: a plain explode would push a filter on the arrays' size, computing them again
                F.posexplode_outer(F.arrays_zip(F.slice(f"{column}.between", F.lit(1), F.size(f"{column}.matches")).alias("b"), F.col(f"{column}.matches").alias("m"),
                                          F.col(f"{column}.values").alias("v"))).alias("i", "x"))
        .where("x IS NOT NULL")
        .select(*keys, "kind", "i", measure(F.col("x.b")).alias("b"), measure(F.col("x.m")).alias("m"), F.col("x.v").alias("value"))
        .withColumn("end", (F.sum("b").over(order) + F.sum("m").over(order)).cast("long"))
        .select(*keys, "kind", (F.col("end") - F.col("m")).cast("long").alias("start"), "end", "value"))


def same_rows(keys: list[str], others: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(keys, others):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
