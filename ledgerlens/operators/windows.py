"""Window-style operators.

Where a per-key result can be had from an aggregate, an aggregate is used (partial aggregation
makes a hot key cheap). Windows partitioned by a key are used on series already aggregated to
(key, period). Ranking across a whole table runs after aggregation to entities; row-level
ordinals use ``seq_number``, which splits a key by time bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import safe_ratio
from ..session import materialize


def _keys(on) -> list[str]:
    if on is None:
        return []
    return [on] if isinstance(on, str) else list(on)


# E1 / E2
def latest_per_key(
    df: DataFrame,
    key,
    order: Sequence[str],
    carry_max: Sequence[str] = (),
    keep_first: Sequence[str] = (),
    latest_non_null: Sequence[str] = (),
    first_order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple, ties broken by all other columns.

    Per-column rules:

    * ``carry_max``: maximum over all versions (a flag that, once set, survives);
    * ``keep_first``: the value of the oldest version (a column an update does not touch);
    * ``latest_non_null``: the newest non-null value (a fill that never writes a null back).

    ``first_order`` is the ordering that decides "oldest" for ``keep_first`` (default: ``order``).

    Most keys have few rows: those are shuffled as they are, once, and sorted behind the shuffle.
    Hot keys (more than one row in 64, found by a one-row sketch of the keys) are reduced by
    ``max(struct)`` and its like, so each map task sends one row of them.
    """
    keys = _keys(key)
    hashed, hot = F.xxhash64(*keys), hot_hashes(df, keys)
    if not hot:
        return _latest_shuffled(df, keys, order, carry_max, keep_first, latest_non_null, first_order)
    cold = _latest_shuffled(df.where(~hashed.isin(hot)), keys, order, carry_max, keep_first, latest_non_null, first_order)
    return _latest_reduced(df.where(hashed.isin(hot)), keys, order, carry_max, keep_first, latest_non_null, first_order).unionByName(cold)


def hot_hashes(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """``xxhash64`` of the keys that hold more than one row in 64, from a one-row sketch."""
    hashed = f"xxhash64({', '.join(f'`{k}`' for k in keys)})"
    top, n = df.agg(F.expr(f"approx_top_k({hashed}, 64, 10000)"), F.count(F.lit(1))).first()
    return [r["item"] for r in top or [] if 64 * r["count"] > n]


def _latest_shuffled(df, keys, order, carry_max, keep_first, latest_non_null, first_order) -> DataFrame:
    """Newest row per key behind one shuffle. The first row is the one without a predecessor: a
    ``row_number`` filter would be planned with a sort before the shuffle too, which unique keys do not pay back."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in [*order, *rest]))
    whole = Window.partitionBy(*keys)
    ordering = F.struct(*[F.col(c) for c in order])
    rules = {c: F.max(c).over(whole) for c in carry_max}
    rules |= {c: F.min_by(c, F.struct(*[F.col(x) for x in (first_order or order)])).over(whole) for c in keep_first}
    rules |= {c: F.max_by(c, F.when(F.col(c).isNotNull(), ordering)).over(whole) for c in latest_non_null}
    first = F.lag(F.lit(True)).over(newest).isNull().alias("__first")
    out = df.select(*keys, *(rules.get(c, F.col(c)).alias(c) for c in df.columns if c not in keys), first)
    return out.where("__first").drop("__first")


def _latest_reduced(df, keys, order, carry_max, keep_first, latest_non_null, first_order) -> DataFrame:
    """Newest row per key by partial aggregates."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordering = F.struct(*[F.col(c) for c in order])
    first_ordering = F.struct(*[F.col(c) for c in (first_order or order)])
    packed = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("__best")
    special = [F.max(c).alias(f"__x_{c}") for c in carry_max]
    special += [F.min_by(c, first_ordering).alias(f"__x_{c}") for c in keep_first]
    special += [F.max_by(c, F.when(F.col(c).isNotNull(), ordering)).alias(f"__x_{c}") for c in latest_non_null]
    out = df.groupBy(*keys).agg(packed, *special)
    rules = set(carry_max) | set(keep_first) | set(latest_non_null)
    cols = [F.col(f"__x_{c}").alias(c) if c in rules else F.col(f"__best.{c}").alias(c) for c in df.columns if c not in keys]
    return out.select(*keys, *cols)


def upsert(
    base: DataFrame,
    delta: DataFrame,
    key,
    order: Sequence[str],
    carry_max: Sequence[str] = (),
    keep_first: Sequence[str] = (),
    latest_non_null: Sequence[str] = (),
) -> DataFrame:
    """Upsert by key (E1): the newest version wins per key, except that ``carry_max`` flags
    survive, ``keep_first`` columns are never updated and ``latest_non_null`` columns are only
    filled (see ``latest_per_key``)."""
    # existing rows are source 0, incoming rows source 1: on an equal version the incoming row
    # wins, and a never-updated column keeps the existing row's value even when re-applied
    u = base.withColumn("__src", F.lit(0)).unionByName(delta.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    out = latest_per_key(
        u, key, [*order, "__src"], carry_max, keep_first, latest_non_null, first_order=["__src", *order]
    )
    return out.drop("__src")


def supersede(df: DataFrame, key, version: str) -> DataFrame:
    """Latest cumulative value per key supersedes earlier ones; never summed."""
    return latest_per_key(df, key, [version])


# E3 / E4 / E8
def difference_vintages(df: DataFrame, key, period: str, cum: str, out: str = "flow") -> DataFrame:
    """Cumulative vintages -> per-period flow; the first vintage of a key is flagged not derivable."""
    w = Window.partitionBy(*_keys(key)).orderBy(period)
    prev = F.lag(cum).over(w)
    return df.withColumn(out, F.col(cum) - prev).withColumn("derivable", prev.isNotNull())


def growth(df: DataFrame, key, period: str, value: str, n: int = 1, out: str | None = None) -> DataFrame:
    """Growth % against the period ``n`` steps back, by self join on ``period - n`` so holes give null."""
    keys = _keys(key)
    base = df.select(*keys, (F.col(period) + n).alias(period), F.col(value).alias("__base"))
    j = df.join(base, [*keys, period], "left")
    name = out or f"growth_{n}_pct"
    return j.withColumn(name, safe_ratio(F.col(value) - F.col("__base"), F.abs(F.col("__base"))) * 100).withColumnRenamed(
        "__base", f"{value}_base_{n}"
    )


def revisions(df: DataFrame, key, version: str, value: str) -> DataFrame:
    """Revision ledger: rows whose value differs from the previous version's; unchanged not listed."""
    w = Window.partitionBy(*_keys(key)).orderBy(version)
    return (
        df.withColumn("old_value", F.lag(value).over(w))
        .withColumn("old_version", F.lag(version).over(w))
        .where(F.col("old_version").isNotNull() & ~F.col("old_value").eqNullSafe(F.col(value)))
    )


# E5 / E6 / E7 / E9
def rank_by(df: DataFrame, value: str, partition_by=None, tiebreak: Sequence[str] = (), method: str = "rank") -> DataFrame:
    """rank / dense_rank / row_number by value, descending (E5).

    Without ``partition_by``, rank and dense_rank of a numeric value use ``global_rank`` (no
    single-partition window). row_number needs a total order and stays a window: use it after
    aggregation to entities."""
    if not _keys(partition_by) and method in ("rank", "dense_rank") and dict(df.dtypes)[value] in (
        "int", "bigint", "double", "float", "smallint", "tinyint"
    ) or (not _keys(partition_by) and method in ("rank", "dense_rank") and dict(df.dtypes)[value].startswith("decimal")):
        return global_rank(df, value, out=method, ties="min" if method == "rank" else "dense", descending=True)
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*_keys(partition_by)).orderBy(F.col(value).desc(), *[F.col(c) for c in tiebreak])
    return df.withColumn(method if method != "row_number" else "rn", fn().over(w))


def top_n(df: DataFrame, group, order: str, n: int, tiebreak: Sequence[str] = (), rank_col: str = "rk") -> DataFrame:
    """Top ``n`` rows per group (E6). ``row_number() <= n`` is planned with a partial group limit
    before the shuffle, so a hot group sends at most ``n`` rows per map task."""
    w = Window.partitionBy(*_keys(group)).orderBy(F.col(order).desc(), *[F.col(c) for c in tiebreak])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` sorted over the cluster, with its range partition ``__part`` and place ``__at`` in it.

    Rows are range-partitioned by (order, a row number): equal rows are split too, so a value that all
    rows share is spread over the tasks. How many partitions there are follows from the session and the
    data's size. Materialised, since sampled ranges may differ when computed again."""
    at = df.withColumn("__row", F.monotonically_increasing_id())
    at = at.repartitionByRange(*order, "__row").sortWithinPartitions(*order, "__row").withColumn("__at", F.monotonically_increasing_id())
    return materialize(at.withColumn("__part", F.shiftright("__at", 33)).drop("__row"))


def cum_share(
    df: DataFrame,
    value: str,
    tiebreak: Sequence[str] = (),
    base_total: float | None = None,
) -> DataFrame:
    """Cumulative share of the total, largest first: top-k hold x %.

    ``pos`` is the position in (value desc, tiebreak) order and ``cum_share_pct`` the running
    total up to and including the row, over the sum of the rows (or ``base_total``).

    No keyless window over rows: they are sorted over the cluster (``in_order``); a running sum inside
    each partition plus the partitions' offsets (a running sum over a row a partition) give the
    running total and position. Null values come last.
    """
    v = F.col(value)
    rows = in_order(df, [v.desc_nulls_last(), *(F.col(c) for c in tiebreak)])
    per = rows.groupBy("__part").agg(F.sum(value).alias("__s"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("__s").over(whole) if base_total is None else F.lit(float(base_total))
    offsets = per.select(
        "__part", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__s_off"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n_off"), total.alias("__tot"))
    w = Window.partitionBy("__part").orderBy("__at")
    run = rows.withColumn("__run", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__rn", F.row_number().over(w))
    return (
        run.join(F.broadcast(offsets), "__part")  # a row a partition
        .withColumn("pos", (F.col("__n_off") + F.col("__rn")).cast("long"))
        .withColumn("cum_share_pct", safe_ratio(F.col("__s_off") + F.coalesce(F.col("__run"), F.lit(0)), F.col("__tot")) * 100)
        .drop("__part", "__at", "__s_off", "__n_off", "__run", "__rn", "__tot")
    )


def bar_pct(df: DataFrame, value: str, floor: float = 2.0, out: str = "bar_pct") -> DataFrame:
    """Max-normalised bar length in percent with a floor for non-zero values.

    The max is a one-row aggregate broadcast back, not a keyless window.
    """
    mx = df.agg(F.max(value).alias("__mx"))
    pctv = safe_ratio(F.col(value), F.col("__mx")) * 100
    return (
        df.crossJoin(F.broadcast(mx))
        .withColumn(out, F.when(F.col(value) > 0, F.greatest(pctv, F.lit(floor))).otherwise(pctv))
        .drop("__mx")
    )


# E10 / E11 / E12 / E13 / E14 / E15
def crossover(df: DataFrame, key, period: str, a: str, b: str) -> DataFrame:
    """First period where series B exceeds series A, per key."""
    return df.groupBy(*_keys(key)).agg(F.min(F.when(F.col(b) > F.col(a), F.col(period))).alias("crossover_period"))


def latest_report(df: DataFrame, key, report: str, value: str) -> DataFrame:
    """For a period printed in many reports, the value of the latest report wins."""
    return df.groupBy(*_keys(key)).agg(
        F.max_by(F.col(value), F.struct(report, value)).alias(value), F.max(report).alias(report)
    )


def flag_spikes(df: DataFrame, key, value: str, repeated: Column | None = None, spike_share: float = 50.0) -> DataFrame:
    """Per key: largest single-period share, spike flag, and repeated-cell defects.

    ``repeated`` is the defect predicate of one cell (e.g. an amount cell that repeats a count cell).
    """
    aggs = [
        (safe_ratio(F.max(value), F.sum(value)) * 100).alias("max_share_pct"),
        F.count(F.lit(1)).alias("n_periods"),
    ]
    if repeated is not None:
        aggs.append(F.count_if(repeated).alias("n_repeated_cells"))
    out = df.groupBy(*_keys(key)).agg(*aggs)
    return out.withColumn("spike", F.col("max_share_pct") >= spike_share)


def seq_number(
    df: DataFrame, key, order, bucket: Column, out: str = "step", hot_rows: int = 1_000_000, sub_buckets: int | None = None
) -> DataFrame:
    """1-based ordinal of each row inside its key by ``order`` (equal ``order`` tuples get
    consecutive numbers in an arbitrary but fixed order).

    A window over a whole key would put a hot key in one task. Here the key is split by
    ``bucket`` (e.g. the month of ``order``). A (key, bucket) group that still holds more than
    ``hot_rows`` rows is split again into order-preserving sub-buckets at approximate quantiles
    of the first ``order`` column, as many as the largest group's counted rows call for. Null keys,
    buckets and order values are values like others (nulls come first). Those bounds come from a partial aggregate over the hot
    groups only, and are broadcast back (their number is bounded by rows / ``hot_rows``). Rows
    per (key, bucket, sub-bucket) are counted, offsets come from a running sum over that small
    count table, and the ordinal is the row number inside the sub-bucket plus its offset.
    The (key, bucket) counts are materialised once; without hot groups the input is read twice
    (counts, ordinals), with hot groups twice more (bounds, sub-bucket counts), filtered.
    """
    from ..session import materialize
    from .joins import bounded, null_safe_join

    keys = _keys(key)
    ords = _keys(order)
    grp = [*keys, "__b"]
    b = df.withColumn("__b", bucket)
    # one pass over the input: rows per (key, bucket), kept for the hot check and the offsets
    counts = materialize(b.groupBy(*grp).agg(F.count(F.lit(1)).alias("__n")))
    hot = counts.where(F.col("__n") > hot_rows).select(*grp)
    if hot.limit(1).count() == 0:  # reads the small materialised table only
        b = b.withColumn("__s", F.lit(0))
        sub_counts = counts.withColumn("__s", F.lit(0))
    else:
        most = counts.agg(F.max("__n")).first()[0]
        parts = sub_buckets or min(10_000, max(2, -(-2 * most // hot_rows)))
        qs = [i / parts for i in range(1, parts)]
        hot = bounded(hot, 1_000_000)
        bounds = materialize(
            null_safe_join(b.select(*grp, ords[0]), hot, grp, "left_semi")
            .groupBy(*grp).agg(F.array_distinct(F.percentile_approx(ords[0], qs, 10_000)).alias("__q"))
        )
        b = null_safe_join(b, bounded(bounds, 1_000_000), grp, "left")
        b = b.withColumn("__s", F.coalesce(F.size(F.filter(F.col("__q"), lambda x: x < F.col(ords[0]))), F.lit(0))).drop("__q")
        hot_counts = null_safe_join(b, hot, grp, "left_semi").groupBy(*grp, "__s").agg(F.count(F.lit(1)).alias("__n"))
        cold_counts = null_safe_join(counts, hot, grp, "left_anti").withColumn("__s", F.lit(0))
        sub_counts = cold_counts.unionByName(hot_counts)
    part = [*grp, "__s"]
    wo = Window.partitionBy(*keys).orderBy("__b", "__s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sub_counts.withColumn("__off", F.coalesce(F.sum("__n").over(wo), F.lit(0))).drop("__n")
    wi = Window.partitionBy(*part).orderBy(*ords)
    return (
        null_safe_join(b.withColumn("__rn", F.row_number().over(wi)), offsets, part)
        .withColumn(out, F.col("__rn") + F.col("__off"))
        .drop("__b", "__s", "__rn", "__off")
    )


def trajectory(df: DataFrame, key, date: str, tiebreak: Sequence[str] = (), bucket: str = "year") -> DataFrame:
    """Ordered waypoints per key in long form with a step number."""
    return seq_number(df, key, [date, *tiebreak], F.date_trunc(bucket, F.col(date)))


def trajectory_factor(df: DataFrame, key, date: str, value: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First and last value by date and their ratio (E14): min_by / max_by aggregates."""
    order = F.struct(date, *tiebreak)
    return (
        df.groupBy(*_keys(key))
        .agg(
            F.min_by(value, order).alias("first_value"),
            F.max_by(value, order).alias("last_value"),
        )
        .withColumn("factor", safe_ratio(F.col("first_value"), F.col("last_value")))
    )


def quadrant(share_a, share_b, cut_a: float, cut_b: float) -> Column:
    """high/low x high/low class of two shares."""
    a = F.when(share_a >= cut_a, F.lit("high")).otherwise(F.lit("low"))
    b = F.when(share_b >= cut_b, F.lit("high")).otherwise(F.lit("low"))
    return F.concat(a, F.lit("_"), b)


def _ranked_values(df: DataFrame, value: str, ties: str, descending: bool, weight: str | None) -> DataFrame:
    """(__v, __rank, __back, __hot) for each distinct non-null value: its rank, its rank from the other
    end ('min' ties), and whether more than one row in 64 holds it."""
    v = F.col(value)
    counts = df.where(v.isNotNull()).select(v.alias("__v"), (F.col(weight) if weight else F.lit(1)).alias("__w"))
    counts = counts.groupBy("__v").agg(F.sum("__w").cast("long").alias("__n"))
    rows = in_order(counts, [F.col("__v").desc() if descending else F.col("__v").asc()])
    per = rows.groupBy("__part").agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__vals"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # over a row a partition
    whole = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__row_off"), F.coalesce(F.sum("__vals").over(before), F.lit(0)).alias("__val_off"),
        F.sum("__rows").over(whole).alias("__all"))
    inside = Window.partitionBy("__part").orderBy("__at")
    before_it = F.coalesce(F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    r = rows.withColumn("__before", before_it).withColumn("__dense", F.row_number().over(inside)).join(F.broadcast(offsets), "__part")
    first = F.col("__row_off") + F.col("__before")
    rank = {"mean": first + (F.col("__n") + 1) / 2.0, "dense": F.col("__val_off") + F.col("__dense"), "min": first + 1}[ties]
    return r.select("__v", rank.alias("__rank"), (F.col("__all") - first - F.col("__n") + 1).alias("__back"), (64 * F.col("__n") > F.col("__all")).alias("__hot"))


def global_rank(
    df: DataFrame,
    value: str,
    out: str = "rank",
    ties: str = "min",
    descending: bool = False,
    weight: str | None = None,
    back: str | None = None,
) -> DataFrame:
    """Rank of ``value`` over the whole table without a single-partition window.

    ``weight`` names a column holding how many rows each input row stands for (pre-aggregated
    input); by default every row counts once. ``back`` names a column for the rank from the other
    end (ties 'min').

    ``ties``: 'min' (SQL rank), 'mean' (mean of tied positions, for Spearman) or 'dense'.
    Rows with a null value get a null rank.

    1. Per distinct value, count the rows: a partial aggregate, so a value held by a third of all
       rows becomes one row.
    2. Sort the distinct values over the cluster (``in_order``); partition totals give offsets and a
       window per partition the position inside it.
    3. The ranks join back to the rows on the value: the hot values (fewer than 64 by their definition)
       by a broadcast, the others by a shuffle that rows of hot and null values pass spread out.

    The result is exact. Ranks are long (mean ranks double).
    """
    ranked = materialize(_ranked_values(df, value, ties, descending, weight))
    hot = ranked.where("__hot").select(F.col("__v").alias("__hv"), F.col("__rank").alias("__hr"), F.col("__back").alias("__hb"))
    cold = ranked.where("NOT __hot").select("__v", "__rank", "__back", F.lit(0).alias("__zero"))
    j = df.join(F.broadcast(hot), F.col(value) == F.col("__hv"), "left")
    settled = F.col("__hv").isNotNull() | F.col(value).isNull()
    j = j.withColumn("__key", F.when(~settled, F.col(value))).withColumn("__salt", F.when(settled, F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16))).otherwise(0).cast("int"))
    j = j.join(cold, (F.col("__key") == F.col("__v")) & (F.col("__salt") == F.col("__zero")), "left")
    j = j.withColumn(out, F.coalesce("__hr", "__rank"))
    if back:
        j = j.withColumn(back, F.coalesce("__hb", "__back"))
    return j.drop("__hv", "__hr", "__hb", "__key", "__salt", "__v", "__rank", "__back", "__zero")


def value_ranks(df: DataFrame, value: str, out: str = "rank", ties: str = "min", descending: bool = False) -> DataFrame:
    """The (value, rank) table of ``global_rank``: one row per distinct non-null value."""
    return _ranked_values(df, value, ties, descending, None).select(F.col("__v").alias(value), F.col("__rank").alias(out))


def order_by(df: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """Largest first, rows without a value last, ties by key (F1): a range-partitioned sort."""
    return df.orderBy(F.col(value).desc_nulls_last(), *([F.col(key)] if key else []))


def top_entities(df: DataFrame, entity: str, k: int) -> DataFrame:
    """Entities with the most rows, top ``k`` (F2): a partial count per entity, then an ordered
    limit (planned as a per-partition top-k before one small merge). Ties broken by entity."""
    counts = df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(entity)).limit(k)
