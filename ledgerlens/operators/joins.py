"""Joins (C1-C16).

Rules kept throughout: equi-joins are left to Catalyst/AQE (broadcast when runtime size allows,
sort-merge otherwise); an explicit ``broadcast`` hint is only put on sides whose size is bounded
by construction (inline parameter tables, one-row totals) or checked by ``bounded``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import safe_ratio

# A side is hinted for broadcast only when its counted rows and bytes are within these bounds.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its real rows and bytes are few; otherwise leave the choice to AQE.

    Rows are counted and their text widths summed by a probe that reads at most ``max_rows + 1``
    rows. The optimizer's estimate is no proof (an exploded one-row frame is estimated at a few
    bytes) and is not used. The hint changes the plan, never the result.
    """
    width = F.length(F.to_json(F.struct("*"))) if df.columns else F.lit(0)
    n, size = df.limit(max_rows + 1).select(width.alias("w")).agg(F.count(F.lit(1)), F.sum("w")).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df


def null_safe_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which a null key matches a null key; the keys come from the left side."""
    keys = _keys(on)
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(r, cond, how).drop(*(f"__r_{k}" for k in keys))


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


# ---------------------------------------------------------------------------
# C1 / C2 / C3 / C4 / C5 / C6
# ---------------------------------------------------------------------------


def full_join_provenance(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_name: str = "left",
    right_name: str = "right",
    flag_col: str = "present_in",
    left_probe: str | None = None,
    right_probe: str | None = None,
) -> DataFrame:
    """Full outer join keeping one-sided rows, with provenance ``both | <left>_only | <right>_only``.

    ``left_probe`` / ``right_probe`` name a non-null column on each side used to tell presence
    (defaults: a marker column added here). The join keys come out coalesced.
    """
    keys = _keys(on)
    lp = "__l_present"
    rp = "__r_present"
    l2 = left.withColumn(lp, F.lit(True))
    r2 = right.withColumn(rp, F.lit(True))
    j = l2.join(r2, keys, "full_outer")
    flag = (
        F.when(F.col(lp) & F.col(rp), F.lit("both"))
        .when(F.col(lp), F.lit(f"{left_name}_only"))
        .otherwise(F.lit(f"{right_name}_only"))
    )
    return j.withColumn(flag_col, flag).drop(lp, rp)


def left_lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi-join for a third measure; keys missing on the right give nulls."""
    return left.join(right, _keys(on), "left")


def common_keys(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join: keys present on both sides."""
    return left.join(right, _keys(on), "inner")


def match_supply(
    demand: DataFrame,
    supply: DataFrame,
    on: str | Sequence[str],
    demand_col: str,
    supply_col: str,
    ratio_col: str = "demand_per_stock",
) -> DataFrame:
    """Demand joined with stock; every demand key kept (C4).

    The ratio is pending demand per unit of available stock; it is null when demand is zero or
    negative (nothing pending) and when stock is zero or unknown."""
    j = demand.join(supply, _keys(on), "left")
    d, s = F.col(demand_col), F.col(supply_col)
    return j.withColumn(ratio_col, F.when(d > 0, safe_ratio(d, s)))


def apply_correction(
    base: DataFrame,
    corrections: DataFrame,
    on: str | Sequence[str],
    cols: Sequence[str],
    nested_col: str = "_pre_correction",
) -> DataFrame:
    """Second-source correction: corrected columns take the new value; the old values are kept
    in a nested struct (null for uncorrected rows) (C5). ``corrections`` carries key + ``cols``."""
    keys = _keys(on)
    corr = corrections.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in cols]).withColumn(
        "__corrected", F.lit(True)
    )
    j = base.join(corr, keys, "left")
    old = F.struct(*[F.col(c).alias(c) for c in cols])
    out = j.withColumn(nested_col, F.when(F.col("__corrected"), old))
    for c in cols:
        out = out.withColumn(c, F.when(F.col("__corrected"), F.col(f"__new_{c}")).otherwise(F.col(c)))
    return out.drop("__corrected", *[f"__new_{c}" for c in cols])


def build_panel(base: DataFrame, *sources: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Wide panel: the base key set left-joined with each source in turn."""
    out = base
    for s in sources:
        out = out.join(s, _keys(on), "left")
    return out


# ---------------------------------------------------------------------------
# C7 range join, C8 scenarios
# ---------------------------------------------------------------------------


def parse_ranges(taxonomy: DataFrame, text_col: str) -> DataFrame:
    """'28, 31-38' -> one row per (lo, hi) range; a single number is a one-code range."""
    parts = taxonomy.withColumn("__part", F.explode(F.split(F.col(text_col), r"\s*,\s*")))
    lo = F.trim(F.split_part(F.col("__part"), F.lit("-"), F.lit(1))).try_cast("int")
    hi_txt = F.trim(F.split_part(F.col("__part"), F.lit("-"), F.lit(2)))
    hi = F.coalesce(F.nullif(hi_txt, F.lit("")).try_cast("int"), lo)
    return parts.withColumn("lo", lo).withColumn("hi", hi).drop("__part")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges (lo, hi) of each row key (all other columns) with reversed ends swapped and
    overlapping or touching-at-a-code ranges merged; rows without a readable range go."""
    keys = [c for c in ranges.columns if c not in ("lo", "hi")]
    r = ranges.where("lo IS NOT NULL AND hi IS NOT NULL").select(
        *keys, F.least("lo", "hi").cast("long").alias("lo"), F.greatest("lo", "hi").cast("long").alias("hi"))
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    far = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("__new", F.when(far >= F.col("lo"), 0).otherwise(1))
    r = r.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*keys, "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__island")


def map_code_ranges(df: DataFrame, code_col: str, taxonomy: DataFrame, text_col: str, width: int = 1024) -> DataFrame:
    """Code -> every taxonomy row whose range list contains it, once each.

    One plan at every size: the merged ranges are dealt to code buckets of ``width`` codes, rows
    and ranges meet by equality on the bucket, and the range is checked exactly. Reversed ranges
    count as swapped, overlapping ranges of one taxonomy row as one, fractional codes lie inside a
    range like whole ones, null codes match nothing.
    """
    ranges = merged_ranges(parse_ranges(taxonomy, text_col).drop(text_col))
    bucket = lambda c: F.floor(c / width)
    r = ranges.withColumn("__bucket", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))))
    cond = (bucket(df[code_col]) == r["__bucket"]) & (df[code_col] >= r["lo"]) & (df[code_col] <= r["hi"])
    return df.join(r, cond, "inner").drop("lo", "hi", "__bucket")


def cross_scenarios(demand: DataFrame, scenarios: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Each demand row against every scenario assumption (C8). Scenarios are a small parameter table."""
    return demand.crossJoin(bounded(scenarios, max_rows))


# ---------------------------------------------------------------------------
# C9 snapshot diff, C10 citation resolution
# ---------------------------------------------------------------------------


def snapshot_diff(prev: DataFrame, cur: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Change data capture between two snapshots.

    One row per key that was added, removed or changed (null-safe compare of ``cols``), with
    ``change`` and the old/new values; unchanged keys are not listed.
    """
    keys = _keys(key)
    p = prev.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols]).withColumn("__p", F.lit(True))
    c_ = cur.select(*keys, *[F.col(c).alias(f"new_{c}") for c in cols]).withColumn("__c", F.lit(True))
    j = p.join(c_, keys, "full_outer")
    differs = None
    for c in cols:
        d = ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        differs = d if differs is None else (differs | d)
    change = (
        F.when(F.col("__p").isNull(), F.lit("added"))
        .when(F.col("__c").isNull(), F.lit("removed"))
        .when(differs, F.lit("changed"))
    )
    return j.withColumn("change", change).where(F.col("change").isNotNull()).drop("__p", "__c")


def resolve_citations(
    cites: DataFrame, register: DataFrame, on: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(resolved, unresolved) citations: semi join and anti join against the register."""
    keys = _keys(on)
    reg = register.select(*keys)
    return cites.join(reg, keys, "left_semi"), cites.join(reg, keys, "left_anti")


# ---------------------------------------------------------------------------
# C12 interval join, C13 as-of, C14 reconciliation
# ---------------------------------------------------------------------------


def open_windows(
    items: DataFrame,
    dates: DataFrame,
    start_col: str,
    end_col: str,
    date_col: str,
    max_dates: int = 100_000,
    grid: str | None = None,
) -> DataFrame:
    """Items open at each date: start <= d and (end is null or end >= d); days left to close.

    Dates may repeat. Items without a start are never open.

    * ``grid=None``: any dates, by bins of days. A bin is as wide as the median item is long, or a
      1024th of the dates' span if that is wider, so a typical item lies in two bins and none in more
      than 1025. Items and dates meet on the bin, and the exact condition decides.
    * ``grid='month'|'day'|'year'|...``: every calendar date is a truncation to that unit. Each
      item then expands to the grid points inside its interval (``sequence``), which are
      equi-joined to the calendar (broadcast after a size check): the work is the number of
      (item, date) matches, not the product. Open-ended items run to the last calendar date.
    """
    d = bounded(dates, max_dates)
    if grid is None:
        day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
        span = F.broadcast(dates.agg(F.min(day(date_col)).alias("__lo"), F.max(day(date_col)).alias("__hi")))
        begin, end = F.greatest(day(start_col), F.col("__lo")), F.least(F.coalesce(day(end_col), F.col("__hi")), F.col("__hi"))
        live = items.where(F.col(start_col).isNotNull()).crossJoin(span).withColumn("__b", begin).withColumn("__e", end).where("__b <= __e")
        width = F.broadcast(live.agg(F.greatest(F.coalesce(F.percentile_approx(F.col("__e") - F.col("__b"), 0.5, 1000), F.lit(1)), F.ceil((F.max("__hi") - F.max("__lo")) / 1024), F.lit(1)).cast("long").alias("__width")))
        bin_of = lambda c: F.floor((c - F.col("__lo")) / F.col("__width"))
        binned = live.crossJoin(width).withColumn("__bin", F.explode(F.sequence(bin_of(F.col("__b")), bin_of(F.col("__e"))))).drop("__lo", "__hi", "__width", "__b", "__e")
        asked = dates.crossJoin(span).crossJoin(width).select(*dates.columns, bin_of(day(date_col)).alias("__date_bin"))
        inside = (F.col(start_col) <= F.col(date_col)) & (F.col(end_col).isNull() | (F.col(end_col) >= F.col(date_col)))
        j = binned.join(asked, (F.col("__bin") == F.col("__date_bin")) & inside).drop("__bin", "__date_bin")
    else:
        horizon = F.broadcast(dates.agg(F.max(date_col).alias("__h")))
        it = items.crossJoin(horizon)
        step = F.expr(f"INTERVAL 1 {grid.upper()}")
        dtype = d.schema[date_col].dataType
        # truncate in the calendar's own type (a wall-clock calendar stays wall-clock)
        first = F.date_trunc(grid, F.col(start_col)).cast(dtype)
        first = F.when(first < F.col(start_col), first + step).otherwise(first)
        upper = F.coalesce(F.least(F.col(end_col), F.col("__h")), F.col("__h")).cast(dtype)
        pts = F.when(first <= upper, F.sequence(first, upper, step))
        j = it.withColumn(date_col, F.explode(pts)).drop("__h").join(d, date_col, "inner")
    return j.withColumn("days_to_close", F.datediff(F.col(end_col), F.col(date_col)))


def open_counts(items: DataFrame, dates: DataFrame, start_col: str, end_col: str, date_col: str, grid: str) -> DataFrame:
    """Per calendar date: open items, open-ended ones among them, and the sum of days to close.

    A sweep: each item adds to the first grid point not before its start and takes away at the
    first one after its end; running sums over the grid points give the counts. The work is one
    partial aggregate over the items, whatever the length of their intervals. Items without a start
    are never open; an item that ends before it starts is not either."""
    dtype = dates.schema[date_col].dataType
    step = F.expr(f"INTERVAL 1 {grid.upper()}")

    def floor(c):
        return F.date_trunc(grid, F.col(c)).cast(dtype)

    begin = F.when(floor(start_col) < F.col(start_col), floor(start_col) + step).otherwise(floor(start_col))
    stop = floor(end_col) + step
    day = F.datediff(F.col(end_col), F.lit("1970-01-01").cast("date")).cast("long")
    live = items.where(F.col(start_col).isNotNull() & (F.col(end_col).isNull() | (F.col(end_col) >= F.col(start_col))))
    one = lambda at, sign: F.struct(
        at.cast(dtype).alias("at"), F.lit(sign).alias("n"), F.when(F.col(end_col).isNull(), sign).otherwise(0).alias("ended"), (F.coalesce(day, F.lit(0)) * sign).alias("d"))
    marks = live.select(F.explode(F.array(one(begin, 1), F.when(F.col(end_col).isNotNull(), one(stop, -1)))).alias("m")).where("m IS NOT NULL").select("m.*")
    sums = marks.groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n", "ended", "d")), F.lit(False).alias("asked"))
    asked = dates.select(F.col(date_col).alias("at")).distinct().select("at", *(F.lit(0).cast("long").alias(c) for c in ("n", "ended", "d")), F.lit(True).alias("asked"))
    points = sums.unionByName(asked).groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n", "ended", "d")), F.bool_or("asked").alias("asked"))
    run = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)  # over the grid points, a row each
    total = points.select("at", "asked", *(F.sum(c).over(run).alias(c) for c in ("n", "ended", "d"))).where("asked")
    at_day = F.datediff(F.col("at"), F.lit("1970-01-01").cast("date"))
    return total.select(F.col("at").alias(date_col), F.col("n").alias("n_open"), F.col("ended").alias("n_open_ended"), (F.col("d") - (F.col("n") - F.col("ended")) * at_day).alias("days_to_close_sum"))


def asof_latest(
    facts: DataFrame,
    vintages: DataFrame,
    by: str | Sequence[str],
    fact_time: str,
    vintage_time: str,
    value_cols: Sequence[str],
    bucket: str = "month",
    hot_rows: int = 1_000_000,
    sub_buckets: int | None = None,
) -> DataFrame:
    """For each fact row, the latest vintage row of the same key at or before its time.

    No fact x vintage product is formed. Both sides are unioned, then a running
    ``last(ignorenulls)`` carries the newest vintage forward. The window is partitioned by key
    and a time bucket, so one hot key is spread over its buckets; a (key, bucket) group with
    more than ``hot_rows`` facts is split again at approximate quantiles of time (bounds from a
    partial aggregate over the hot groups, broadcast back). The value entering a (sub-)bucket
    comes from a small table of bucket-final vintages.
    """
    from ..session import materialize

    keys = _keys(by)
    vals = list(value_cols)
    vt = "__t"
    tag = "__is_vintage"
    bkt = "__bucket"
    grp = [*keys, bkt]
    vrow = vintages.select(
        *keys,
        F.col(vintage_time).cast("timestamp").alias(vt),
        F.lit(1).alias(tag),
        F.struct(F.col(vintage_time).alias("__vtime"), *[F.col(c) for c in vals]).alias("__v"),
    )
    fcols = [c for c in facts.columns]
    frow = facts.select(
        *keys,
        F.col(fact_time).cast("timestamp").alias(vt),
        F.lit(0).alias(tag),
        F.lit(None).cast(vrow.schema["__v"].dataType).alias("__v"),
        F.struct(*[F.col(c) for c in fcols]).alias("__f"),
    )
    vrow = vrow.withColumn("__f", F.lit(None).cast(frow.schema["__f"].dataType))
    u = vrow.unionByName(frow).withColumn(bkt, F.date_trunc(bucket, F.col(vt)))

    # facts per (key, bucket), computed once: the list of buckets that need a carry, and the hot check
    fact_counts = materialize(u.where(F.col(tag) == 0).groupBy(*grp).agg(F.count(F.lit(1)).alias("__n")))
    hot = fact_counts.where(F.col("__n") > hot_rows).select(*grp)
    if hot.limit(1).count() == 0:
        u = u.withColumn("__s", F.lit(0))
        fact_buckets = fact_counts.select(*grp).withColumn("__s", F.lit(0))
    else:
        hot = bounded(hot)
        most = fact_counts.agg(F.max("__n")).first()[0]
        parts = sub_buckets or min(10_000, max(2, -(-2 * most // hot_rows)))
        qs = [i / parts for i in range(1, parts)]
        bounds = materialize(
            u.select(*grp, vt).join(hot, grp, "left_semi")
            .groupBy(*grp).agg(F.array_distinct(F.percentile_approx(vt, qs, 10_000)).alias("__q"))
        )
        u = u.join(bounded(bounds), grp, "left")
        u = u.withColumn("__s", F.coalesce(F.size(F.filter(F.col("__q"), lambda x: x < F.col(vt))), F.lit(0))).drop("__q")
        cold = fact_counts.join(hot, grp, "left_anti").select(*grp).withColumn("__s", F.lit(0))
        hot_b = u.where(F.col(tag) == 0).join(hot, grp, "left_semi").select(*grp, "__s").distinct()
        fact_buckets = cold.unionByName(hot_b)
    fine = [*grp, "__s"]

    # last vintage inside each (key, bucket, sub-bucket): a partial aggregate, skew-safe
    last_in_bucket = (
        u.where(F.col(tag) == 1)
        .groupBy(*fine)
        .agg(F.max_by("__v", F.struct(vt, "__v.__vtime")).alias("__bv"))
        .select(*fine, "__bv")
    )
    # value entering each fact (sub-)bucket = newest final vintage of an earlier one: a running
    # last value over the key's bucket rows
    marks = last_in_bucket.unionByName(fact_buckets.withColumn("__bv", F.lit(None).cast(last_in_bucket.schema["__bv"].dataType)))
    marks = marks.groupBy(*fine).agg(F.first("__bv", ignorenulls=True).alias("__bv"))
    earlier = Window.partitionBy(*keys).orderBy(bkt, "__s").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = marks.withColumn("__carry", F.last("__bv", ignorenulls=True).over(earlier)).drop("__bv")

    w = (
        Window.partitionBy(*fine)
        .orderBy(F.col(vt), F.col(tag).desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    run = u.withColumn("__run", F.last("__v", ignorenulls=True).over(w)).where(F.col(tag) == 0)
    run = run.join(carry_in, fine, "left")
    best = F.coalesce(F.col("__run"), F.col("__carry"))
    return run.select("__f.*", *[best[c].alias(c) for c in vals], best["__vtime"].alias(f"asof_{vintage_time}"))


def reconcile(
    a: DataFrame, b: DataFrame, on: str | Sequence[str], a_col: str, b_col: str, tol: float = 0.003
) -> DataFrame:
    """Cross-source reconciliation: relative difference and pass flag at tolerance ``tol`` (C14, K4)."""
    j = a.join(b, _keys(on), "full_outer")
    rel = safe_ratio(F.abs(F.col(a_col) - F.col(b_col)), F.abs(F.col(b_col)))
    return j.withColumn("rel_diff", rel).withColumn(
        "passed", F.coalesce(F.col("rel_diff") <= F.lit(tol), F.col(a_col).eqNullSafe(F.col(b_col)))
    )


# ---------------------------------------------------------------------------
# C15 pairing, C16 event before/after
# ---------------------------------------------------------------------------


def pair_entities(entities: DataFrame, lanes: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Entity x programme pairs sharing a sector key."""
    return entities.join(lanes, _keys(on), "inner")


def before_after(
    events: DataFrame | None,
    series: DataFrame,
    key: str | Sequence[str],
    event_period: str,
    period: str,
    value: str,
    k: int,
) -> DataFrame:
    """Average of a per-period series in the ``k`` periods before an event vs the event period and
    the ``k - 1`` after (C16). ``series`` must already be aggregated to (key, period).

    With ``events=None`` the series already carries ``event_period`` (no join needed)."""
    keys = _keys(key)
    j = series if events is None else series.join(events.select(*keys, event_period), keys, "inner")
    off = F.col(period) - F.col(event_period)
    return j.groupBy(*keys, event_period).agg(
        F.avg(F.when((off >= -k) & (off < 0), F.col(value))).alias("avg_before"),
        F.avg(F.when((off >= 0) & (off < k), F.col(value))).alias("avg_after"),
    )
