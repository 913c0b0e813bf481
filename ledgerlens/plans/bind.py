"""Binding of the test tables to the canonical roles (FIXTURES.md part 3).

Every builder aggregates the large fact table to its join key *before* joining a dimension
(Spark does not push aggregates below joins by itself): lineitem is reduced by supplier, orders
by customer, so the shuffle carries partial sums, not rows. The nation/region dimensions are
fixed-size (25 and 5 rows) and are broadcast by the size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import canon_label
from ..operators.filters import drop_labels
from .registry import Tables

# Fixed values of the test binding.
# Two places reported as one merged place (both spellings map to the merged label).
PLACE_ALIASES = {
    "nation_23": "Nation_23 and Nation_24",
    "nation_24": "Nation_23 and Nation_24",
}
# Stop labels dropped before summing.
STOP_LABELS = ["total", "grand total", "not indicated"]
# Zone left out of the inflow series (so right-only places exist).
INFLOW_EXCLUDED_ZONE = "AFRICA"
# Zone whose implemented figures are not published (so left-only places exist).
IMPL_EXCLUDED_ZONE = "EUROPE"
# Order dates in the comparison window: the partial last year (to August 2001) is left out.
WINDOW_END = "2001-01-01"


def geo(t: Tables) -> DataFrame:
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return n.join(r, "n_regionkey").drop("n_regionkey")


def inflow_by_nation(t: Tables) -> DataFrame:
    """(nationkey, inflow_amt): lineitem summed per supplier, then per supplier nation."""
    li = t("lineitem").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("amt"))
    sup = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    return li.join(sup, "l_suppkey").groupBy("n_nationkey").agg(F.sum("amt").alias("inflow_amt"))


def inflow_by_place(t: Tables, whole: bool = False) -> DataFrame:
    """(place, inflow_amt) with aliases merged (B1, B2, D1); the excluded zone is left out unless ``whole``."""
    g = geo(t) if whole else geo(t).where(F.col("r_name") != INFLOW_EXCLUDED_ZONE)
    x = inflow_by_nation(t).join(g, "n_nationkey")
    x = x.withColumn("place", canon_label(F.col("n_name"), PLACE_ALIASES))
    x = drop_labels(x, "place", STOP_LABELS)
    return x.groupBy("place").agg(F.sum("inflow_amt").alias("inflow_amt"))


def order_sums_by_nation(t: Tables, window_end: str | None = WINDOW_END) -> DataFrame:
    """(nationkey, filed_amt, impl_amt) from orders in the window, summed per customer first."""
    o = t("orders")
    if window_end:
        o = o.where(F.col("o_orderdate") < F.lit(window_end).cast("timestamp_ntz"))
    per_cust = o.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("filed_amt"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("impl_amt"),
    )
    cust = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return (
        per_cust.join(cust, "o_custkey")
        .groupBy("n_nationkey")
        .agg(F.sum("filed_amt").alias("filed_amt"), F.sum("impl_amt").alias("impl_amt"))
    )


def order_sums_by_place(t: Tables) -> DataFrame:
    """(place, filed_amt, impl_amt): implemented is unpublished (null) in the excluded zone.
    The place label is spelled differently from the inflow side ('  nation_3. ') on purpose."""
    x = order_sums_by_nation(t).join(geo(t), "n_nationkey")
    x = x.withColumn("impl_amt", F.when(F.col("r_name") != IMPL_EXCLUDED_ZONE, F.col("impl_amt")))
    label = F.concat(F.lit(" "), F.lower("n_name"), F.lit(". "))
    x = x.withColumn("place", canon_label(label, PLACE_ALIASES))
    x = drop_labels(x, "place", STOP_LABELS)
    return x.groupBy("place").agg(F.sum("filed_amt").alias("filed_amt"), F.sum("impl_amt").alias("impl_amt"))


def orders_geo(t: Tables, cols=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")):
    """Orders with customer nation and zone (for status pipelines at row level)."""
    o = t("orders").select(*cols)
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return o.join(c, "o_custkey").join(geo(t), "n_nationkey")


def rev_by_nation_year(t: Tables) -> DataFrame:
    """(n_name, yr, revenue, n_orders): order revenue per customer nation and order year,
    reduced per (customer, year) before the customer join."""
    o = t("orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_totalprice")
    per = o.groupBy("o_custkey", "yr").agg(F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders"))
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    x = per.join(c, "o_custkey").groupBy("n_nationkey", "yr").agg(
        F.sum("revenue").alias("revenue"), F.sum("n_orders").alias("n_orders")
    )
    return x.join(geo(t), "n_nationkey").select("n_name", "yr", "revenue", "n_orders")


def out_rev_by_nation(t: Tables) -> DataFrame:
    """(n_name, out_rev, n_lines): lineitem revenue by supplier nation (pre-reduced per supplier)."""
    li = t("lineitem").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("amt"), F.count(F.lit(1)).alias("n"))
    sup = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    x = li.join(sup, "l_suppkey").groupBy("n_nationkey").agg(F.sum("amt").alias("out_rev"), F.sum("n").alias("n_lines"))
    return x.join(geo(t), "n_nationkey").select("n_name", "out_rev", "n_lines")


def in_rev_by_nation(t: Tables) -> DataFrame:
    """(n_name, in_rev): lineitem revenue by the ordering customer's nation.

    lineitem is reduced per order, joined to orders, reduced per customer, then joined to customer.
    """
    li = t("lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("amt"))
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    per_c = li.join(o, "l_orderkey").groupBy("o_custkey").agg(F.sum("amt").alias("amt"))
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    x = per_c.join(c, "o_custkey").groupBy("n_nationkey").agg(F.sum("amt").alias("in_rev"))
    return x.join(geo(t), "n_nationkey").select("n_name", "in_rev")


def after_status(status: str = "o_orderstatus", priority: str = "o_orderpriority"):
    """Status in the later snapshot: urgent/high pending orders are granted, low-priority open
    orders fall to pending; everything else is unchanged."""
    s, p = F.col(status), F.col(priority)
    return (
        F.when((s == "P") & p.isin("1-URGENT", "2-HIGH"), F.lit("F"))
        .when((s == "O") & (p == "5-LOW"), F.lit("P"))
        .otherwise(s)
    )


def order_partials(t: Tables, *extra) -> DataFrame:
    """Orders reduced per (customer, *extra) to (n, v) = (count, sum of o_totalprice) before the
    customer join, then tagged with nation and zone. Callers re-aggregate with sums of n and v.

    With ``extra = (status,)`` a customer contributes at most three rows instead of one per
    order, so the orders x customer join moves partial sums, not orders."""
    o = t("orders")
    per = o.groupBy("o_custkey", *extra).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("v"))
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return per.join(c, "o_custkey").join(geo(t), "n_nationkey")
