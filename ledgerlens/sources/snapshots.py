"""Stored dated snapshots as a catalogue: which dates there are, the state at a date, what changed.

A store is a folder of ``snapshot_date=<date>`` folders, as ``bulletins.write_snapshot`` leaves it. Dates
are found from the file listing, contents are read only of the snapshots that a result needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import joins, quality
from ..operators.windows import hot_hashes
from .bulletins import list_files, read_snapshots

DATE = "snapshot_date"


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_date, files, bytes, written_at), a row per stored snapshot, from the file listing alone (A2)."""
    day = F.try_to_date(F.regexp_extract("path", f"{DATE}=([^/]+)/", 1), "yyyy-MM-dd")
    listed = list_files(spark, path).select(day.alias(DATE), "length", "modificationTime").where(F.col(DATE).isNotNull())
    return listed.groupBy(DATE).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("written_at"))


def date_at(spark: SparkSession, path: str, date) -> str | None:
    """The stored date that holds at ``date``: the newest at or before it; none if the store begins later."""
    return catalogue(spark, path).where(F.col(DATE) <= F.lit(date).cast("date")).agg(F.max(DATE).cast("string")).first()[0]


def snapshot_at(spark: SparkSession, path: str, date) -> DataFrame:
    """The snapshot that holds at ``date`` (A2): only its folder is read; no rows if the store begins later."""
    found = date_at(spark, path, date)
    rows = read_snapshots(spark, path)
    return rows.where(F.col(DATE) == F.lit(found).cast("date")) if found else rows.where(F.lit(False))


def diff_between(spark: SparkSession, path: str, old_date, new_date, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed between the snapshots that hold at two dates (C9). Two folders are
    read, with the columns named; before the store begins every key counts as added."""
    return joins.snapshot_diff(snapshot_at(spark, path, old_date), snapshot_at(spark, path, new_date), key, cols)


def change_feed(spark: SparkSession, path: str, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """What each stored snapshot changed against the one before it (C9): (snapshot_date, keys, change, old_*, new_*).

    All snapshots are compared behind one shuffle by key, not pair by pair: a key's rows stand in
    date order, and a gap in the run of stored dates is a removal and a new addition. The first
    snapshot adds all its keys. Of rows equal in key and date one is taken, that with the greatest
    ``cols`` (which need an order); rows of a key that is hot through such repeats are reduced before
    the shuffle. A null is a value like others in a compound key; a row whose whole key is null
    matches no other row: its snapshot adds it and the next one removes it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # one value per stored snapshot
    known = [r[DATE] for r in catalogue(spark, path).select(DATE).orderBy(DATE).collect()]
    stored = F.array(*(F.lit(d) for d in known))
    rows = read_snapshots(spark, path).select((F.array_position(stored, F.col(DATE)) - 1).cast("int").alias("__at"), *keys, F.struct(*cols).alias("__new"))
    no_key = F.expr(" AND ".join(f"`{k}` IS NULL" for k in keys))
    keyed, hashed = rows.where(~no_key), F.xxhash64(*keys)
    if hot := hot_hashes(keyed, keys):
        keyed = keyed.where(~hashed.isin(hot)).unionByName(keyed.where(hashed.isin(hot)).groupBy("__at", *keys).agg(F.max("__new").alias("__new")))
    by_key = Window.partitionBy(*keys).orderBy("__at", "__new")
    last = keyed.withColumn("__twin", F.lead("__at").over(by_key).eqNullSafe(F.col("__at"))).where("NOT __twin").drop("__twin")
    seen = last.select(
        *keys, "__at", "__new", F.lag("__at").over(by_key).alias("__prev"), F.lag("__new").over(by_key).alias("__old"), F.lead("__at").over(by_key).alias("__next"))
    nowhere = F.lit(None).cast("int")
    alone = rows.where(no_key).select(*keys, "__at", "__new", nowhere.alias("__prev"), F.col("__new").alias("__old"), nowhere.alias("__next"))
    none = F.lit(None).cast(rows.schema["__new"].dataType)
    follows = F.col("__prev").eqNullSafe(F.col("__at") - 1)
    event = lambda at, change, old, new: F.struct(at.alias("at"), F.lit(change).alias("change"), old.alias("old"), new.alias("new"))
    events = F.array(
        F.when(~follows, event(F.col("__at"), "added", none, F.col("__new"))),
        F.when(follows & ~F.col("__old").eqNullSafe(F.col("__new")), event(F.col("__at"), "changed", F.col("__old"), F.col("__new"))),
        F.when((F.col("__at") < len(known) - 1) & ~F.col("__next").eqNullSafe(F.col("__at") + 1), event(F.col("__at") + 1, "removed", F.col("__new"), none)))
    each = seen.unionByName(alone).select(*keys, F.explode(F.array_compact(events)).alias("__e"))
    return each.select(
        F.get(stored, F.col("__e.at")).alias(DATE), *keys, F.col("__e.change").alias("change"),
        *(F.col(f"__e.old.{c}").alias(f"old_{c}") for c in cols), *(F.col(f"__e.new.{c}").alias(f"new_{c}") for c in cols))


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """(snapshot_date, n) of every stored snapshot, 0 for one without rows (K2). No column is read, the counts come from the files' footers."""
    counted = read_snapshots(spark, path).groupBy(DATE).agg(F.count(F.lit(1)).alias("n"))
    return catalogue(spark, path).select(DATE).join(counted, DATE, "left").select(DATE, F.coalesce("n", F.lit(0)).alias("n"))


def check_stored_monotone(spark: SparkSession, path: str) -> DataFrame:
    """Row counts never shrink from one stored snapshot to the next (K2)."""
    return quality.check_monotone(row_counts(spark, path), DATE, "n")


def check_stored_ids(spark: SparkSession, path: str, old_date, new_date, key: str) -> DataFrame:
    """Ids of the snapshot that holds at ``old_date`` still resolve in the one at ``new_date`` (K3)."""
    return quality.check_known_ids(snapshot_at(spark, path, old_date), snapshot_at(spark, path, new_date), key)


def refresh_status(spark: SparkSession, stores: Mapping[str, tuple[str, str | Sequence[str], Sequence[str]]]) -> DataFrame:
    """Per gate its last stored date, rows there, and the size of its last delta (K6).

    ``stores``: gate -> (path, key, compared columns). Columns: gate, last_snapshot, previous_snapshot,
    n_rows, n_added, n_changed, n_removed. The two newest snapshots of each store are read."""
    out = None
    for gate, (path, key, cols) in stores.items():
        last = catalogue(spark, path).agg(F.slice(F.reverse(F.sort_array(F.collect_set(F.col(DATE).cast("string")))), 1, 2).alias("d")).first()["d"]
        new, old = (last + [None, None])[:2]
        rows = read_snapshots(spark, path)
        at = lambda d: rows.where(F.col(DATE) == F.lit(d).cast("date")) if d else rows.where(F.lit(False))  # noqa: B023, E731
        counts = joins.snapshot_diff(at(old), at(new), key, cols).agg(*(F.count_if(F.col("change") == c).alias(f"n_{c}") for c in ("added", "changed", "removed")))
        row = at(new).agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(F.broadcast(counts)).select(
            F.lit(gate).alias("gate"), F.lit(new).cast("date").alias("last_snapshot"), F.lit(old).cast("date").alias("previous_snapshot"), "n_rows", "n_added", "n_changed", "n_removed")
        out = row if out is None else out.unionByName(row)
    return out
