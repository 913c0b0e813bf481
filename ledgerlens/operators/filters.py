"""Projections and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_labels(df: DataFrame, col: str, stop: Sequence[str]) -> DataFrame:
    """Drop stop labels (totals, 'not indicated'; compared lower-case) and blank labels (B2)."""
    c = F.col(col)
    return df.where(c.isNotNull() & (F.trim(c) != "") & ~F.lower(F.trim(c)).isin([s.lower() for s in stop]))


def in_window(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Allowed-period filter (B3); ``isin`` is pushed to the Parquet scan."""
    return df.where(F.col(col).isin(list(values)))


RULES_SCHEMA = "priority int, field string, op string, operand string, label string"
MAX_RULES = 10_000


def rule_label(df: DataFrame, rules: DataFrame, default: str | None = None, override: str | None = None) -> Column:
    """Label of a row by a rules table (B4, H13): the first match by ``priority``, then the other columns.

    ``rules`` has the columns of ``RULES_SCHEMA``: a column of ``df``, one of ``= != < <= > >=`` (as
    numbers where both sides are numbers), ``like``, ``regex``, ``null`` or ``any``, and an operand.
    A non-null ``override`` column wins; without a match the label is ``default``. A rule on a column that ``df``
    lacks never matches. The table is configuration: at most ``MAX_RULES`` rows, which is checked, become
    one array in the plan; the rows of ``df`` are neither joined nor shuffled."""
    listed = sorted((tuple(r) for r in rules.select("priority", "field", "op", "operand", "label").limit(MAX_RULES + 1).collect()), key=lambda r: tuple((x is None, str(x)) if i else (x is None, x) for i, x in enumerate(r)))
    if len(listed) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: join a lookup table instead")
    known = {c.lower(): c for c in df.columns}
    out = F.coalesce(F.col(override)) if override else F.lit(None).cast("string")
    hit = None
    for _, field, op, operand, label in listed:
        if op != "any" and (field or "").lower() not in known:
            continue
        x = F.col(f"`{known[field.lower()]}`") if op != "any" else None
        cond = F.lit(True) if op == "any" else _rule(x, op, operand)
        hit = F.when(cond, F.lit(label)) if hit is None else hit.when(cond, F.lit(label))
    found = F.lit(default).cast("string") if hit is None else hit.otherwise(F.lit(default).cast("string"))
    return F.coalesce(out, found)


def _rule(x: Column, op: str, operand: str | None) -> Column:
    if op == "null":
        return x.isNull()
    text = x.cast("string")
    if op in ("like", "regex"):
        return text.like(operand) if op == "like" else text.rlike(operand)
    try:
        number = float(operand)
        x, y = text.try_cast("double"), F.lit(number)
    except (TypeError, ValueError):
        x, y = text, F.lit(operand)
    ops = {"=": x == y, "!=": x != y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}
    if op not in ops:
        raise ValueError(f"unknown rule operator {op!r}")
    return ops[op]


def quarantine(df: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split defective input into (good, quarantined-with-reason) by a rules table (B4). The union of both is the input."""
    tagged = df.withColumn("quarantine_reason", rule_label(df, rules))
    good = tagged.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason")
    bad = tagged.where(F.col("quarantine_reason").isNotNull())
    return good, bad


def write_quarantine(df: DataFrame, rules: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Both outputs of ``quarantine`` written in one pass, and read back: (good, quarantined)."""
    tagged = df.withColumn("quarantine_reason", rule_label(df, rules))
    tagged.withColumn("split", F.when(F.col("quarantine_reason").isNull(), "good").otherwise("quarantined")).write.partitionBy("split").parquet(path)
    stored = df.sparkSession.read.schema(tagged.schema.add("split", "string")).parquet(path)
    return stored.where("split = 'good'").drop("split", "quarantine_reason"), stored.where("split = 'quarantined'").drop("split")


def register_query(
    df: DataFrame,
    like: str | None = None,
    like_col: str | None = None,
    date_col: str | None = None,
    date_from=None,
    date_to=None,
    entity_col: str | None = None,
    entity=None,
) -> DataFrame:
    """LIKE / date-range / entity predicates."""
    out = df
    if like is not None:
        out = out.where(F.col(like_col).like(like))
    if date_col is not None and date_from is not None:
        out = out.where(F.col(date_col) >= F.lit(date_from))
    if date_col is not None and date_to is not None:
        out = out.where(F.col(date_col) < F.lit(date_to))
    if entity_col is not None and entity is not None:
        out = out.where(F.col(entity_col) == F.lit(entity))
    return out


def title_sweep(df: DataFrame, col: str, include: str, exclude: str | None = None) -> DataFrame:
    """High-precision sweep: include pattern, then drop routine patterns."""
    out = df.where(F.col(col).rlike(include))
    return out.where(~F.col(col).rlike(exclude)) if exclude else out


def slicer(df: DataFrame, col: str, value=None) -> DataFrame:
    """'all' (None) or one category."""
    return df if value is None or value == "all" else df.where(F.col(col) == F.lit(value))


def domain_filter(df: DataFrame, col: str, keep: Sequence | None = None, drop: Sequence | None = None) -> DataFrame:
    """Keep a domain, drop noise categories."""
    out = df
    if keep:
        out = out.where(F.col(col).isin(list(keep)))
    if drop:
        out = out.where(~F.col(col).isin(list(drop)))
    return out


def drop_reserved(entries: Column, reserved: Sequence[str]) -> Column:
    """Metadata keys do not become sections (B10): an array of entries without those of ``reserved``."""
    return F.filter(entries, lambda e: e["key"].isNull() | ~e["key"].isin(list(reserved)))


def siteable(df: DataFrame, flag: str) -> DataFrame:
    """Restrict to rows passing a boolean flag."""
    return df.where(F.col(flag))
