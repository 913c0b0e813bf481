"""Query registry: each entry is a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the
query is expressible in plain SQL, an independent DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    """Decorator: register a query under ``name`` with its oracle SQL and inventory ids."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids)
        return fn

    return deco


class Tables:
    """Lazily reads the test tables of one scale-factor folder.

    One reader per table per query: the file listing (large on a cluster) happens once even when
    a table is referenced by several branches."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]


def sql_canon(x: str, aliases: dict[str, str] | None = None) -> str:
    """DuckDB text of the canonical-label rule (oracle side of functions.labels.canon_label)."""
    k = f"trim(regexp_replace(trim({x}), '\\s+', ' ', 'g'))"
    k = f"regexp_replace({k}, '^\\.+|\\.+$', '', 'g')"
    k = f"regexp_replace({k}, '\\s*&\\s*', ' and ', 'g')"
    k = f"trim(regexp_replace({k}, '\\s+', ' ', 'g'))"
    titled = (
        f"array_to_string(list_transform(string_split({k}, ' '), lambda w: CASE WHEN lower(w) = 'and' THEN 'and' "
        f"ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ')"
    )
    if not aliases:
        return titled
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in aliases.items())
    return f"(CASE lower({k}) {whens} ELSE {titled} END)"
