"""Aggregations.

All aggregates here are partial/final hash aggregates (map-side combine), so a hot key is reduced
on every map task before the shuffle. Totals are one-row aggregates joined back by a broadcast
cross join; no keyless window (which would put every row in one task) is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import safe_ratio


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def with_total(df: DataFrame, value: str, total_col: str = "total") -> DataFrame:
    """Attach the grand total of ``value`` as a column: one-row aggregate + broadcast cross join."""
    tot = df.agg(F.sum(value).alias(total_col))
    return df.crossJoin(F.broadcast(tot))


def with_group_total(df: DataFrame, by, value: str, total_col: str = "group_total") -> DataFrame:
    """Attach per-group totals: aggregate then equi-join on the group key (skew-safe, unlike a
    window). Rows with a null group are a group of their own."""
    from .joins import null_safe_join

    keys = _keys(by)
    return null_safe_join(df, df.groupBy(*keys).agg(F.sum(value).alias(total_col)), keys)


# D1
def sum_by(df: DataFrame, key, value: str, out: str | None = None, count: str | None = None) -> DataFrame:
    """Sum by canonical key, and the number of rows as ``count``; null amounts count as 0."""
    sums = [F.sum(F.coalesce(F.col(value), F.lit(0.0))).alias(out or value)]
    return df.groupBy(*_keys(key)).agg(*sums, *([F.count(F.lit(1)).alias(count)] if count else []))


# D2
def prefer(primary: DataFrame, fallback: DataFrame, key, basis_primary: str, basis_fallback: str) -> DataFrame:
    """Per key, rows of ``primary`` if it has any, else those of ``fallback``; ``basis`` says which.

    Priority union, then a semi/anti join on the key instead of a rank window.
    """
    keys = _keys(key)
    p = primary.withColumn("basis", F.lit(basis_primary))
    f = fallback.join(primary.select(*keys).distinct(), keys, "left_anti").withColumn("basis", F.lit(basis_fallback))
    return p.unionByName(f)


def prefer_table(primary: DataFrame, fallback: DataFrame, basis_primary: str, basis_fallback: str) -> DataFrame:
    """Whole-table fallback: ``primary`` if it has at least one row, else ``fallback``.

    Decided without a driver-side count: the fallback rows are kept only when a one-row
    emptiness flag of the primary (a broadcast cross join) says it is empty.
    """
    flag = primary.select(F.lit(1).alias("__has")).limit(1)
    has = F.broadcast(flag.groupBy().agg(F.count("__has").alias("__n")))
    p = primary.withColumn("basis", F.lit(basis_primary))
    f = fallback.crossJoin(has).where(F.col("__n") == 0).drop("__n").withColumn("basis", F.lit(basis_fallback))
    return p.unionByName(f)


# D3 / D27 / D36
def share_of_total(df: DataFrame, value: str, out: str = "share_pct", base_total: float | None = None) -> DataFrame:
    """Share of the grand total in percent, from unrounded values (D3).

    The base is the sum of the listed rows, or ``base_total`` (for example a published national
    total when only some places are listed)."""
    if base_total is not None:
        return df.withColumn(out, safe_ratio(F.col(value), F.lit(float(base_total))) * 100)
    return with_total(df, value, "__tot").withColumn(out, safe_ratio(F.col(value), F.col("__tot")) * 100).drop("__tot")


def share_in_group(df: DataFrame, by, value: str, out: str = "share_in_group_pct") -> DataFrame:
    """Share of a row inside its group."""
    return with_group_total(df, by, value, "__gt").withColumn(out, safe_ratio(F.col(value), F.col("__gt")) * 100).drop(
        "__gt"
    )


def intensity(share_a, share_b) -> Column:
    """Share A / share B; null unless both exist and B is non-zero."""
    return safe_ratio(share_a, share_b)


# D4 / D5
def register_stats(df: DataFrame, kind: str, date: str, flag: str | None = None) -> DataFrame:
    """Count, first and last date, flagged count per kind."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    if flag:
        aggs.append(F.sum(F.col(flag).cast("long")).alias("n_flagged"))
    return df.groupBy(kind).agg(*aggs)


def entity_activity(df: DataFrame, entity: str, date: str, catalog: DataFrame | None = None, catalog_key: str | None = None):
    """Releases, first, last per entity; ``in_catalog`` flag via a left join to a catalog."""
    act = df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )
    if catalog is None:
        return act
    cat = catalog.select(F.col(catalog_key or entity).alias(entity)).distinct().withColumn("in_catalog", F.lit(True))
    return act.join(cat, entity, "left").withColumn("in_catalog", F.coalesce("in_catalog", F.lit(False)))


# D6 / D7 / D8 / D9 / D10 / D11
def status_cube(df: DataFrame, dims: Sequence[str], value: str | None = None, kind: str = "rollup", weight: str | None = None) -> DataFrame:
    """Cross-tab with totals: rollup or cube over ``dims``; ``gid`` marks total rows.

    ``weight`` says how many rows a pre-aggregated row stands for, so that the expansion to all
    grouping sets runs over partial sums."""
    g = df.rollup(*dims) if kind == "rollup" else df.cube(*dims)
    aggs = [(F.sum(weight).cast("long") if weight else F.count(F.lit(1))).alias("n"), F.grouping_id().alias("gid")]
    if value:
        aggs.append(F.sum(value).alias(f"sum_{value}"))
    return g.agg(*aggs)


def status_funnel(df: DataFrame, key, status: str, classes: dict[str, Sequence[str]], dead: str | None = None):
    """Conditional counts per class; rate over live rows (dead ones left out of the denominator)."""
    aggs = [F.count_if(F.col(status).isin(list(v))).alias(f"n_{k}") for k, v in classes.items()]
    out = df.groupBy(*_keys(key)).agg(*aggs, F.count(F.lit(1)).alias("n_total"))
    first = next(iter(classes))
    denom = F.col("n_total") - (F.col(f"n_{dead}") if dead else F.lit(0))
    return out.withColumn(f"{first}_rate_pct", safe_ratio(F.col(f"n_{first}"), denom) * 100)


def tally(df: DataFrame, cat: str, domain: DataFrame) -> DataFrame:
    """Count per category over a fixed domain; categories with no rows show 0."""
    counts = df.groupBy(cat).agg(F.count(F.lit(1)).alias("n"))
    return domain.select(cat).join(counts, cat, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def transition_matrix(df: DataFrame, old: str, new: str) -> DataFrame:
    """Counts per (old, new) class pair."""
    return df.groupBy(old, new).agg(F.count(F.lit(1)).alias("n"))


def scoreboard(df: DataFrame, cls: str, member: str, sep: str = ", ") -> DataFrame:
    """Number and sorted list of the distinct members per class.

    Members are made distinct before they are listed, so a list is as long as the member domain."""
    d = df.select(cls, F.col(member).cast("string").alias("__m")).where(F.col("__m").isNotNull()).distinct()
    return d.groupBy(cls).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("__m")), sep).alias("members"))


def used_values(df: DataFrame, c: str, sep: str = ",") -> DataFrame:
    """Sorted set of the distinct values used (D11): distinct first (partial agg), then one small list."""
    d = df.select(F.col(c).cast("string").alias(c)).where(F.col(c).isNotNull()).distinct()
    return d.agg(F.array_join(F.array_sort(F.collect_list(c)), sep).alias(f"{c}_used"))


# D12
def series_profile(df: DataFrame, entity: str, period: str, value: str, periods: DataFrame, missing: str = "zero"):
    """Peak-period share and population CV per entity over a fixed period set.

    ``missing='zero'`` counts a missing period as 0 (entity x period frame from a cross join with
    the small period table); ``'skip'`` uses present periods only. Rows without an entity form an
    entity of their own; a null period counts only if ``periods`` has it.
    """
    from .joins import bounded, null_safe_join

    v = df.groupBy(entity, period).agg(F.sum(value).alias("__v"))
    if missing == "zero":
        # the period list is a calendar: broadcast only after its size is checked
        frame = v.select(entity).distinct().crossJoin(bounded(periods.select(period), 100_000))
        v = null_safe_join(frame, v, [entity, period], "left").withColumn("__v", F.coalesce("__v", F.lit(0.0)))
    return v.groupBy(entity).agg(
        F.sum("__v").alias("total"),
        (safe_ratio(F.max("__v"), F.sum("__v")) * 100).alias("peak_share_pct"),
        F.when(F.avg("__v") != 0, F.stddev_pop("__v") / F.avg("__v")).alias("cv"),
        F.count("__v").alias("n_periods"),
    )


# D17 / D18 / D19
def ledger_total(df: DataFrame, value: str, flag: str) -> DataFrame:
    """Total of all layers and of the flagged ('ready') layers."""
    from .filters import siteable

    ready = siteable(df, flag).agg(F.sum(value).alias("ready_total"))
    return df.agg(F.sum(value).alias("total")).crossJoin(F.broadcast(ready))  # one row each


def sum_positive(df: DataFrame, value, by=None, net: bool = False) -> DataFrame:
    """Sum of positive parts of one or more columns; negatives clipped to 0 first (D18). ``net``
    adds the plain sums."""
    sums = []
    for v in _keys(value):
        sums.append(F.sum(F.greatest(F.col(v), F.lit(0))).alias(f"{v}_positive"))
        if net:
            sums.append(F.sum(v).alias(f"{v}_net"))
    return df.groupBy(*_keys(by)).agg(*sums) if by else df.agg(*sums)


def bucket_mean_ratio(df: DataFrame, bucket: str, num: str, den: str) -> DataFrame:
    """Unweighted mean of row ratios (nulls skipped) next to the pooled ratio."""
    r = safe_ratio(F.col(num), F.col(den))
    return df.groupBy(bucket).agg(
        F.avg(r).alias("mean_ratio"),
        safe_ratio(F.sum(num), F.sum(den)).alias("pooled_ratio"),
        F.count(r).alias("n_rows"),
    )


# D20 / D21
def partner_concentration(ranked: DataFrame, partner: str, value: str, rank_col: str, k: int) -> DataFrame:
    """Per partner: exposure sum, sectors where it is in the top ``k``, sectors where it ranks 1-2.

    ``ranked`` has one row per (sector, partner) with a per-sector rank (see windows.top_n).
    """
    return ranked.groupBy(partner).agg(
        F.sum(F.when(F.col(rank_col) <= k, F.col(value))).alias("exposure"),
        F.count_if(F.col(rank_col) <= k).alias("n_top_k"),
        F.count_if(F.col(rank_col) <= 2).alias("n_top_2"),
    )


def exposure(df: DataFrame, code: str, codes: DataFrame, value: str, by=None) -> DataFrame:
    """Sum of ``value`` over rows whose code is in a code list (semi join)."""
    sel = df.join(codes.select(code).distinct(), code, "left_semi")
    agg = F.sum(value).alias("exposure")
    return sel.groupBy(*_keys(by)).agg(agg) if by else sel.agg(agg)


# D22 / D23 / D24 / D25 / D26
def launch_mix(df: DataFrame, year: str, instrument: str, amount: str, flag: str) -> DataFrame:
    """Count and outlay per year x instrument, with the flagged share of outlay."""
    return df.groupBy(year, instrument).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("outlay"),
        (safe_ratio(F.sum(F.when(F.col(flag), F.col(amount)).otherwise(0.0)), F.sum(amount)) * 100).alias(
            "flagged_share_pct"
        ),
    )


def quarter_digest(df: DataFrame, by, text: str, order, bucket: Column, sep: str = "; ", per_line: int = 100) -> DataFrame:
    """Ordered text list per period, whole, in numbered lines of ``per_line`` entries.

    Ordinals come from ``seq_number`` (hot periods are split by ``bucket``), so no task and no row
    holds a whole period."""
    from .windows import seq_number

    keys = _keys(by)
    rows = seq_number(df, keys, order, bucket, "__i").withColumn("line", F.floor((F.col("__i") - 1) / per_line) + 1)
    lines = rows.groupBy(*keys, "line").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("__i", F.col(text).cast("string").alias("t")))).alias("__l"))
    return lines.select(*keys, "line", "n", F.array_join(F.col("__l.t"), sep).alias("digest"))


def check_grand_total(df: DataFrame, key: str, value: str, total_label: str, tol: float = 0.005) -> DataFrame:
    """Re-sum the body rows and compare with the printed total row."""
    body = df.where(F.col(key) != total_label).agg(F.sum(value).alias("resummed"))
    printed = df.where(F.col(key) == total_label).agg(F.sum(value).alias("printed"))
    j = body.crossJoin(printed)
    return j.withColumn("abs_diff", F.abs(F.col("resummed") - F.col("printed"))).withColumn(
        "passed", F.col("abs_diff") <= F.lit(tol) * F.abs(F.col("printed"))
    )


def backlog(df: DataFrame, key, filed_flag: Column, impl_flag: Column, value: str, count_col: str | None = None) -> DataFrame:
    """Filed, implemented and pending counts and values; conversion % by count.

    ``count_col`` names a row-count column when ``df`` is already partially aggregated (then
    counts are sums of it); otherwise each row counts once."""
    if count_col is None:
        filed_n, impl_n = F.count_if(filed_flag), F.count_if(impl_flag)
    else:
        filed_n = F.coalesce(F.sum(F.when(filed_flag, F.col(count_col))), F.lit(0)).cast("long")
        impl_n = F.coalesce(F.sum(F.when(impl_flag, F.col(count_col))), F.lit(0)).cast("long")
    out = df.groupBy(*_keys(key)).agg(
        filed_n.alias("filed_n"),
        impl_n.alias("impl_n"),
        F.sum(F.when(filed_flag, F.col(value))).alias("filed_value"),
        F.sum(F.when(impl_flag, F.col(value))).alias("impl_value"),
    )
    return (
        out.withColumn("pending_n", F.col("filed_n") - F.col("impl_n"))
        .withColumn("pending_value", F.coalesce("filed_value", F.lit(0.0)) - F.coalesce("impl_value", F.lit(0.0)))
        .withColumn("conversion_pct", safe_ratio(F.col("impl_n"), F.col("filed_n")) * 100)
    )


def completeness(df: DataFrame, entity: str | None, cols: Sequence[str]) -> DataFrame:
    """Null / zero / present counts per field (and entity), long form via unpivot."""
    keys = [entity] if entity else []
    aggs = []
    for c in cols:
        col = F.col(c)
        is_num = dict(df.dtypes)[c] in ("int", "bigint", "double", "float", "smallint", "tinyint") or dict(
            df.dtypes
        )[c].startswith("decimal")
        zero = (col == 0) if is_num else (F.trim(col.cast("string")) == "")
        aggs += [
            F.count_if(col.isNull()).alias(f"{c}__null"),
            F.count_if(zero).alias(f"{c}__zero"),
            F.count_if(col.isNotNull() & ~zero).alias(f"{c}__present"),
        ]
    wide = df.groupBy(*keys).agg(*aggs)
    stacked = F.stack(
        F.lit(len(cols)),
        *[x for c in cols for x in (F.lit(c), F.col(f"{c}__null"), F.col(f"{c}__zero"), F.col(f"{c}__present"))],
    ).alias("field", "n_null", "n_zero", "n_present")
    return wide.select(*keys, stacked)


# D28 / D29 / D30 / D31 / D32 / D33 / D34 / D35
def coverage_counts(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Distinct keys in total, with A, with B and with both."""
    return df.agg(
        F.count_distinct(key).alias("n_keys"),
        F.count_distinct(F.when(F.col(a).isNotNull(), F.col(key))).alias("n_with_a"),
        F.count_distinct(F.when(F.col(b).isNotNull(), F.col(key))).alias("n_with_b"),
        F.count_distinct(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(key))).alias("n_with_both"),
    )


def growth_multiple(a, b) -> Column:
    """Ratio of two growth rates (not of levels)."""
    return safe_ratio(a, b)


def attrition(df: DataFrame, key, status: str, withdrawn: str) -> DataFrame:
    """Withdrawn / all, per key."""
    return df.groupBy(*_keys(key)).agg(
        F.count_if(F.col(status) == withdrawn).alias("n_withdrawn"),
        F.count(F.lit(1)).alias("n_all"),
        (safe_ratio(F.count_if(F.col(status) == withdrawn), F.count(F.lit(1))) * 100).alias("attrition_pct"),
    )


def delivery_pct(df: DataFrame, key: str, delivered: Column, committed: str) -> DataFrame:
    """Delivered % of committed per key plus a total row (rollup)."""
    return df.rollup(key).agg(
        F.sum(F.when(delivered, F.col(committed))).alias("delivered"),
        F.sum(committed).alias("committed"),
        (safe_ratio(F.sum(F.when(delivered, F.col(committed))), F.sum(committed)) * 100).alias("delivered_pct"),
        F.grouping_id().alias("gid"),
    )


def whole_from_share(part, share_pct) -> Column:
    """Back-derived whole from a part and its share in percent."""
    return safe_ratio(part, F.col(share_pct) / 100.0 if isinstance(share_pct, str) else share_pct / 100.0)


def cohort_counts(a: DataFrame, date_a: str, b: DataFrame, date_b: str, names: tuple[str, str], weight_a: str | None = None, weight_b: str | None = None) -> DataFrame:
    """Counts per year on two time bases, full-joined on the year (D35). A weight column says how
    many rows a pre-aggregated row stands for; rows without a date form a year of their own."""

    def per_year(df, date, weight, name):
        n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
        return df.groupBy(F.year(date).alias("yr")).agg(n.alias(name))

    x, y = per_year(a, date_a, weight_a, names[0]), per_year(b, date_b, weight_b, names[1]).withColumnRenamed("yr", "__yr")
    return x.join(y, F.col("yr").eqNullSafe(F.col("__yr")), "full_outer").select(F.coalesce("yr", "__yr").alias("yr"), *names)


def tier_funnel(df: DataFrame, tier: str, order: str, value: str, demand: float | None = None) -> DataFrame:
    """Value per tier, running total over the tier order, demand multiple of each tier.

    The running sum runs after aggregation to tiers (a handful of rows).
    """
    from pyspark.sql import Window

    t = df.groupBy(tier, order).agg(F.sum(value).alias("tier_value"))
    w = Window.orderBy(order, tier).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("running_value", F.sum("tier_value").over(w))
    if demand is not None:
        t = t.withColumn("demand_multiple", safe_ratio(F.lit(demand), F.col("running_value")))
    return t


def spread(df: DataFrame, key: str, value: str, base, out: str = "spread") -> DataFrame:
    """Gap to a base row: value - value of the row whose ``key`` equals ``base``.

    The base is a one-row aggregate (null when the base is absent) broadcast to every row."""
    b = df.agg(F.max(F.when(F.col(key) == F.lit(base), F.col(value))).alias("__base"))
    return df.crossJoin(F.broadcast(b)).withColumn(out, F.col(value) - F.col("__base")).drop("__base")


def balance(out_df: DataFrame, in_df: DataFrame, key: str, out_col: str, in_col: str) -> DataFrame:
    """Bilateral balance = out - in per partner (a partner missing on one side counts 0 there),
    ranked both ways (D30). Inputs are per-partner aggregates; the ranks use ``global_rank``."""
    from .windows import global_rank

    b = out_df.select(key, out_col).join(in_df.select(key, in_col), key, "full_outer").select(
        key, (F.coalesce(F.col(out_col), F.lit(0.0)) - F.coalesce(F.col(in_col), F.lit(0.0))).alias("balance")
    )
    return global_rank(b, "balance", "rank_surplus", descending=True, back="rank_deficit")  # one pass for both ends
