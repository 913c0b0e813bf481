"""Flagship two-series comparison and its family: C1, C2, D3, D27, B8, F1, D28, F3/G1, G3, G4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import pct
from ..operators import aggs, joins, sets, windows
from ..session import materialize
from . import bind
from .registry import Tables, register, sql_canon

A = bind.PLACE_ALIASES

# ---------------------------------------------------------------------------
# Shared oracle CTEs (DuckDB)
# ---------------------------------------------------------------------------
SQL_GEO = "geo AS (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"
SQL_INFLOW = f"""inflow AS (
  SELECT {sql_canon('g.n_name', A)} AS place, sum(l.l_extendedprice) AS inflow_amt
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey
  WHERE g.r_name <> 'AFRICA' GROUP BY 1)"""
SQL_ORD = f"""ord AS (
  SELECT {sql_canon("' ' || lower(g.n_name) || '. '", A)} AS place, sum(o.o_totalprice) AS filed_amt,
         sum(CASE WHEN o.o_orderstatus = 'F' AND g.r_name <> 'EUROPE' THEN o.o_totalprice END) AS impl_amt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey
  WHERE o.o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1),
impl AS (SELECT place, impl_amt FROM ord WHERE impl_amt IS NOT NULL)"""
SQL_BASE = f"WITH {SQL_GEO},\n{SQL_INFLOW},\n{SQL_ORD}"


def comparison(t: Tables):
    """The two-series comparison with provenance, shares, intensity and conversion (entry 1).

    lineitem and orders are each scanned once: both series are reduced to places, fully joined,
    the filed measure is looked up, and the place-level results (bounded by the place dimension)
    are materialised, so the totals and the rows do not re-scan the fact tables.
    """
    orders = materialize(bind.order_sums_by_place(t))  # a row per place
    impl = orders.where(F.col("impl_amt").isNotNull()).select("place", "impl_amt")
    j = joins.full_join_provenance(bind.inflow_by_place(t), impl, "place", "inflow", "impl")
    j = materialize(joins.left_lookup(j, orders.select("place", "filed_amt"), "place"))
    tot = j.agg(F.sum("inflow_amt").alias("tot_inflow"), F.sum("impl_amt").alias("tot_impl"))
    j = j.crossJoin(F.broadcast(tot))
    j = j.withColumn("inflow_share", pct("inflow_amt", "tot_inflow")).withColumn("impl_share", pct("impl_amt", "tot_impl"))
    return (
        j.withColumn("intensity_ratio", aggs.intensity("inflow_share", "impl_share"))
        .withColumn("conversion_pct", pct("impl_amt", "filed_amt"))
        .drop("tot_inflow", "tot_impl")
    )


def series_pair(t: Tables):
    """(inflow by place, implemented by place), each materialised once."""
    inflow = materialize(bind.inflow_by_place(t))
    impl = materialize(bind.order_sums_by_place(t).where(F.col("impl_amt").isNotNull()).select("place", "impl_amt"))
    return inflow, impl


@register(
    "full_join_provenance",
    SQL_BASE
    + """,
j AS (SELECT coalesce(i.place, m.place) AS place, i.inflow_amt, m.impl_amt,
        CASE WHEN i.place IS NOT NULL AND m.place IS NOT NULL THEN 'both'
             WHEN i.place IS NOT NULL THEN 'inflow_only' ELSE 'impl_only' END AS present_in
      FROM inflow i FULL OUTER JOIN impl m ON i.place = m.place),
tot AS (SELECT (SELECT sum(inflow_amt) FROM inflow) AS ti, (SELECT sum(impl_amt) FROM impl) AS tm),
s AS (SELECT j.*, j.inflow_amt / nullif(tot.ti, 0) * 100 AS inflow_share, j.impl_amt / nullif(tot.tm, 0) * 100 AS impl_share
      FROM j CROSS JOIN tot)
SELECT s.place, s.present_in,
       CAST(s.inflow_amt AS DECIMAL(38,2)) AS inflow_amt, CAST(s.inflow_share AS DECIMAL(38,4)) AS inflow_share_pct,
       CAST(s.impl_amt AS DECIMAL(38,2)) AS impl_amt, CAST(s.impl_share AS DECIMAL(38,4)) AS impl_share_pct,
       CAST(s.inflow_share / nullif(s.impl_share, 0) AS DECIMAL(38,4)) AS intensity_ratio,
       CAST(o.filed_amt AS DECIMAL(38,2)) AS filed_amt,
       CAST(s.impl_amt / nullif(o.filed_amt, 0) * 100 AS DECIMAL(38,4)) AS conversion_pct
FROM s LEFT JOIN ord o ON s.place = o.place""",
    ids=("C1", "C2", "B1", "B2", "B8", "D1", "D3", "D27", "F1"),
)
def full_join_provenance(spark, d):
    c = comparison(Tables(spark, d))
    out = c.select(
        "place",
        "present_in",
        F.col("inflow_amt").cast("decimal(38,2)").alias("inflow_amt"),
        F.col("inflow_share").cast("decimal(38,4)").alias("inflow_share_pct"),
        F.col("impl_amt").cast("decimal(38,2)").alias("impl_amt"),
        F.col("impl_share").cast("decimal(38,4)").alias("impl_share_pct"),
        F.col("intensity_ratio").cast("decimal(38,4)").alias("intensity_ratio"),
        F.col("filed_amt").cast("decimal(38,2)").alias("filed_amt"),
        F.col("conversion_pct").cast("decimal(38,4)").alias("conversion_pct"),
    )
    return windows.order_by(out, "intensity_ratio", "place")


@register(
    "share_pct",
    f"WITH {SQL_GEO},\n{SQL_INFLOW.replace("WHERE g.r_name <> 'AFRICA' ", '')}"
    + """
SELECT place, CAST(inflow_amt AS DECIMAL(38,2)) AS inflow_amt,
       CAST(inflow_amt / (SELECT sum(inflow_amt) FROM inflow) * 100 AS DECIMAL(38,4)) AS share_pct
FROM inflow""",
    ids=("D3",),
)
def share_pct(spark, d):
    x = aggs.share_of_total(materialize(bind.inflow_by_place(Tables(spark, d), whole=True)), "inflow_amt")
    return x.select(
        "place", F.col("inflow_amt").cast("decimal(38,2)").alias("inflow_amt"), F.col("share_pct").cast("decimal(38,4)").alias("share_pct")
    )


@register(
    "sum_by_label",
    f"""WITH {SQL_GEO}
SELECT {sql_canon('g.n_name', A)} AS place, CAST(sum(coalesce(s.s_acctbal, 0)) AS DECIMAL(38,2)) AS stock,
       CAST(count(*) AS BIGINT) AS n_rows
FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1""",
    ids=("D1", "B1"),
)
def sum_by_label(spark, d):
    t = Tables(spark, d)
    from ..functions.labels import canon_label

    s = t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal")
    x = s.join(bind.geo(t), "n_nationkey").withColumn("place", canon_label(F.col("n_name"), A))
    out = aggs.sum_by(x, "place", "s_acctbal", "stock", count="n_rows")
    return out.select("place", F.col("stock").cast("decimal(38,2)").alias("stock"), "n_rows")


@register(
    "coverage_counts",
    SQL_BASE
    + """,
j AS (SELECT coalesce(i.place, m.place) AS place, i.inflow_amt, m.impl_amt FROM inflow i FULL OUTER JOIN impl m ON i.place = m.place)
SELECT CAST(count(DISTINCT place) AS BIGINT) AS n_keys,
       CAST(count(DISTINCT CASE WHEN inflow_amt IS NOT NULL THEN place END) AS BIGINT) AS n_with_a,
       CAST(count(DISTINCT CASE WHEN impl_amt IS NOT NULL THEN place END) AS BIGINT) AS n_with_b,
       CAST(count(DISTINCT CASE WHEN inflow_amt IS NOT NULL AND impl_amt IS NOT NULL THEN place END) AS BIGINT) AS n_with_both
FROM j""",
    ids=("D28",),
)
def coverage_counts(spark, d):
    c = comparison(Tables(spark, d))
    return aggs.coverage_counts(c, "place", "inflow_amt", "impl_amt")


@register(
    "key_union",
    SQL_BASE + "\nSELECT place FROM inflow UNION SELECT place FROM impl",
    ids=("G1", "F3"),
)
def key_union(spark, d):
    inflow, impl = series_pair(Tables(spark, d))
    return sets.key_union(inflow, impl, ["place"]).orderBy("place")


@register(
    "key_intersect",
    SQL_BASE + "\nSELECT place FROM inflow INTERSECT SELECT place FROM impl",
    ids=("G3", "C3"),
)
def key_intersect(spark, d):
    inflow, impl = series_pair(Tables(spark, d))
    return sets.key_intersect(inflow, impl, ["place"])


@register(
    "key_except",
    SQL_BASE
    + """
SELECT 'inflow_only' AS side, place FROM (SELECT place FROM inflow EXCEPT SELECT place FROM impl)
UNION ALL
SELECT 'impl_only' AS side, place FROM (SELECT place FROM impl EXCEPT SELECT place FROM inflow)""",
    ids=("G4",),
)
def key_except(spark, d):
    inflow, impl = series_pair(Tables(spark, d))
    a = sets.key_except(inflow, impl, ["place"]).select(F.lit("inflow_only").alias("side"), "place")
    b = sets.key_except(impl, inflow, ["place"]).select(F.lit("impl_only").alias("side"), "place")
    return a.unionByName(b)


@register(
    "ec_iem_common",
    SQL_BASE
    + """
SELECT i.place, CAST(i.inflow_amt AS DECIMAL(38,2)) AS inflow_amt, CAST(m.impl_amt AS DECIMAL(38,2)) AS impl_amt
FROM inflow i JOIN impl m ON i.place = m.place""",
    ids=("C3",),
)
def ec_iem_common(spark, d):
    inflow, impl = series_pair(Tables(spark, d))
    j = joins.common_keys(inflow, impl, "place")
    return j.select(
        "place", F.col("inflow_amt").cast("decimal(38,2)").alias("inflow_amt"), F.col("impl_amt").cast("decimal(38,2)").alias("impl_amt")
    )


