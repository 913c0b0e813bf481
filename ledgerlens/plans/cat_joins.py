"""Joins (C4-C16) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import safe_ratio, supply_verdict
from ..operators import joins
from ..session import materialize
from . import bind, cat_windows
from .registry import Tables, register
from .sqlbits import GEO, ORD_GEO, dec

# Fixed values of the test binding: the place whose stock is reported as zero, and verdict cut points.
ZERO_STOCK_PLACE = "NATION_7"
VERDICT = {"backlog_hi": 25e6, "ready_stock": 15000.0, "rich_stock": 20000.0}


def stock_by_nation(t: Tables):
    s = t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal").join(bind.geo(t), "n_nationkey")
    s = s.withColumn("s_acctbal", F.when(F.col("n_name") == ZERO_STOCK_PLACE, F.lit(0.0)).otherwise(F.col("s_acctbal")))
    return s.groupBy("n_name").agg(F.sum("s_acctbal").alias("stock"))


def pending_by_nation(t: Tables):
    og = bind.order_partials(t, "o_orderstatus")
    return og.groupBy("n_name").agg(
        (F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "O", F.col("v"))), F.lit(0.0))
         - F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("v"))), F.lit(0.0))).alias("demand")
    )


SQL_STOCK = f"""stock AS (SELECT g.n_name, sum(CASE WHEN g.n_name = '{ZERO_STOCK_PLACE}' THEN 0.0 ELSE s.s_acctbal END) AS stock
          FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1)"""
SQL_PENDING = """pend AS (SELECT n_name, coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 0) - coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0) AS demand
         FROM og GROUP BY 1)"""


@register(
    "demand_supply_match",
    f"""WITH {ORD_GEO}, {SQL_STOCK}, {SQL_PENDING}
SELECT p.n_name, {dec('p.demand')} AS demand, {dec('s.stock')} AS stock,
       {dec('CASE WHEN p.demand > 0 THEN p.demand / nullif(s.stock, 0) END', 6)} AS demand_per_stock,
       CASE WHEN p.demand > {VERDICT['backlog_hi']} THEN (CASE WHEN s.stock >= {VERDICT['ready_stock']} THEN 'READY' ELSE 'CONSTRAINED' END)
            WHEN s.stock > {VERDICT['rich_stock']} THEN (CASE WHEN p.demand < 0 THEN 'UNDER-UTILISED' ELSE 'LAND-RICH' END)
            ELSE 'balanced/low' END AS verdict
FROM pend p LEFT JOIN stock s ON p.n_name = s.n_name""",
    ids=("C4", "H12"),
)
def q_demand_supply_match(spark, d):
    t = Tables(spark, d)
    m = joins.match_supply(pending_by_nation(t), stock_by_nation(t), "n_name", "demand", "stock")
    dem, st = F.col("demand"), F.col("stock")
    verdict = supply_verdict(dem, st, VERDICT["backlog_hi"], VERDICT["ready_stock"], VERDICT["rich_stock"])
    return m.select(
        "n_name", dem.cast("decimal(38,2)").alias("demand"), st.cast("decimal(38,2)").alias("stock"),
        F.col("demand_per_stock").cast("decimal(38,6)").alias("demand_per_stock"), verdict.alias("verdict"),
    )


@register(
    "correction_overlay",
    f"""WITH {GEO}, {SQL_STOCK},
corr AS (SELECT g.n_name, sum(c.c_acctbal) AS stock FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey WHERE g.r_name = 'ASIA' GROUP BY 1)
SELECT s.n_name, {dec('coalesce(c.stock, s.stock)')} AS stock, {dec('CASE WHEN c.n_name IS NOT NULL THEN s.stock END')} AS pre_correction_stock,
       c.n_name IS NOT NULL AS corrected
FROM stock s LEFT JOIN corr c ON s.n_name = c.n_name""",
    ids=("C5",),
)
def q_correction_overlay(spark, d):
    t = Tables(spark, d)
    corr = (
        t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("c_acctbal").alias("stock"))
        .join(bind.geo(t).where(F.col("r_name") == "ASIA"), "n_nationkey").select("n_name", "stock")
    )
    out = joins.apply_correction(stock_by_nation(t), corr, "n_name", ["stock"])
    return out.select(
        "n_name", F.col("stock").cast("decimal(38,2)"), F.col("_pre_correction.stock").cast("decimal(38,2)").alias("pre_correction_stock"),
        F.col("_pre_correction").isNotNull().alias("corrected"),
    )


@register(
    "nation_panel",
    f"""WITH {ORD_GEO}, {SQL_STOCK.replace("stock AS", "stock0 AS")},
supn AS (SELECT g.n_name, sum(l.l_extendedprice) AS out_rev FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1),
cn AS (SELECT g.n_name, count(*) AS n_cust FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1),
onn AS (SELECT n_name, count(*) AS n_orders, sum(o_totalprice) AS order_value FROM og GROUP BY 1)
SELECT g.n_name, {dec('supn.out_rev')} AS out_rev, {dec('st.stock')} AS stock, CAST(cn.n_cust AS BIGINT) AS n_cust,
       CAST(onn.n_orders AS BIGINT) AS n_orders, {dec('onn.order_value')} AS order_value
FROM geo g LEFT JOIN supn ON supn.n_name = g.n_name LEFT JOIN stock0 st ON st.n_name = g.n_name
LEFT JOIN cn ON cn.n_name = g.n_name LEFT JOIN onn ON onn.n_name = g.n_name""",
    ids=("C6",),
)
def q_nation_panel(spark, d):
    t = Tables(spark, d)
    base = t("nation").select("n_name")
    cn = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_cust"))
    cn = cn.join(bind.geo(t), "n_nationkey").select("n_name", "n_cust")
    per_c = t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("v"))
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    onn = per_c.join(c, "o_custkey").groupBy("n_nationkey").agg(F.sum("n").alias("n_orders"), F.sum("v").alias("order_value"))
    onn = onn.join(bind.geo(t), "n_nationkey").select("n_name", "n_orders", "order_value")
    out = joins.build_panel(base, bind.out_rev_by_nation(t).select("n_name", "out_rev"), stock_by_nation(t), cn, onn, on="n_name")
    return out.select(
        "n_name", F.col("out_rev").cast("decimal(38,2)"), F.col("stock").cast("decimal(38,2)"), "n_cust",
        F.col("n_orders").cast("long"), F.col("order_value").cast("decimal(38,2)"),
    )


# Fixed values of the test binding: size-code ranges per sector, written as text; S5's overlap and
# touch, S6's is reversed, S7's cannot be read.
CODE_TAXONOMY = [("S1", "1-10"), ("S2", "11, 13-20"), ("S3", "12"), ("S4", "21-50"), ("S5", "1-10, 5-8, 8-14"), ("S6", "38-31"), ("S7", "n/a")]


@register(
    "code_range_join",
    """WITH r AS (SELECT * FROM (VALUES ('S1', 1, 10), ('S2', 11, 11), ('S2', 13, 20), ('S3', 12, 12), ('S4', 21, 50), ('S5', 1, 14), ('S6', 31, 38)) AS v(sector, lo, hi))
SELECT r.sector, CAST(count(*) AS BIGINT) AS n, CAST(sum(p.p_size) AS BIGINT) AS size_sum FROM part p JOIN r ON p.p_size BETWEEN r.lo AND r.hi GROUP BY 1""",
    ids=("C7",),
)
def q_code_range_join(spark, d):
    p = Tables(spark, d)("part")
    tax = spark.createDataFrame(CODE_TAXONOMY, "sector string, codes string")
    m = joins.map_code_ranges(p, "p_size", tax, "codes")
    return m.groupBy("sector").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").cast("long").alias("size_sum"))


# Fixed values of the test binding: demand intensity assumptions (units of value per unit of stock).
SCENARIOS = [("low", 1.2), ("mid", 5.0), ("high", 16.0)]


@register(
    "scenario_cross",
    f"""WITH {ORD_GEO}, {SQL_PENDING},
sc AS (SELECT * FROM (VALUES ('low', 1.2), ('mid', 5.0), ('high', 16.0)) AS v(scenario, intensity)),
sup AS (SELECT sum(s_acctbal) AS supply FROM supplier)
SELECT p.n_name, sc.scenario, {dec('greatest(CAST(CAST(p.demand AS DECIMAL(38,2)) AS DOUBLE), 0) / 1000.0 / sc.intensity', 10)} AS demand_units,
       {dec('greatest(CAST(CAST(p.demand AS DECIMAL(38,2)) AS DOUBLE), 0) / 1000.0 / sc.intensity / (SELECT supply FROM sup)', 6)} AS multiple,
       CASE WHEN greatest(CAST(CAST(p.demand AS DECIMAL(38,2)) AS DOUBLE), 0) / 1000.0 / sc.intensity / (SELECT supply FROM sup) > 1.0 THEN 'DEFICIT'
            WHEN greatest(CAST(CAST(p.demand AS DECIMAL(38,2)) AS DOUBLE), 0) / 1000.0 / sc.intensity / (SELECT supply FROM sup) < 0.5 THEN 'SURPLUS' ELSE 'BALANCE' END AS verdict
FROM pend p CROSS JOIN sc""",
    ids=("C8", "H12"),
)
def q_scenario_cross(spark, d):
    t = Tables(spark, d)
    dem = pending_by_nation(t)
    sc = spark.createDataFrame(SCENARIOS, "scenario string, intensity double")
    sup = t("supplier").agg(F.sum("s_acctbal").alias("supply"))
    x = joins.cross_scenarios(dem, sc).crossJoin(F.broadcast(sup))
    # demand in cents first: the sums of money are exact to 2 places, the rest is plain division
    cents = F.col("demand").cast("decimal(38,2)").cast("double")
    units = safe_ratio(F.greatest(cents, F.lit(0.0)) / 1000.0, F.col("intensity"))
    mult = safe_ratio(units, F.col("supply"))
    verdict = F.when(mult > 1.0, F.lit("DEFICIT")).when(mult < 0.5, F.lit("SURPLUS")).otherwise(F.lit("BALANCE"))
    return x.select(
        "n_name", "scenario", units.cast("decimal(38,10)").alias("demand_units"), mult.cast("decimal(38,6)").alias("multiple"),
        verdict.alias("verdict"),
    )


@register(
    "snapshot_diff",
    """WITH prev AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-01'),
cur AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F'
                                WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'P' ELSE o_orderstatus END AS o_orderstatus
        FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED')),
j AS (SELECT coalesce(p.o_orderkey, c.o_orderkey) AS o_orderkey, p.o_orderstatus AS old_o_orderstatus, c.o_orderstatus AS new_o_orderstatus,
             CASE WHEN p.o_orderkey IS NULL THEN 'added' WHEN c.o_orderkey IS NULL THEN 'removed'
                  WHEN p.o_orderstatus IS DISTINCT FROM c.o_orderstatus THEN 'changed' END AS change
      FROM prev p FULL OUTER JOIN cur c ON p.o_orderkey = c.o_orderkey)
SELECT * FROM j WHERE change IS NOT NULL""",
    ids=("C9",),
)
def q_snapshot_diff(spark, d):
    o = Tables(spark, d)("orders")
    prev = o.where(F.col("o_orderdate") < F.lit("2000-06-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderstatus")
    cur = o.where(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED"))).select(
        "o_orderkey", bind.after_status().alias("o_orderstatus")
    )
    return joins.snapshot_diff(prev, cur, "o_orderkey", ["o_orderstatus"]).select(
        "o_orderkey", "old_o_orderstatus", "new_o_orderstatus", "change"
    )


@register(
    "resolved_refs",
    "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
    ids=("C10", "K3"),
)
def q_resolved_refs(spark, d):
    t = Tables(spark, d)
    res, _ = joins.resolve_citations(t("orders").select("o_orderkey"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return res


@register(
    "unresolved_refs",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    ids=("C10", "C11"),
)
def q_unresolved_refs(spark, d):
    t = Tables(spark, d)
    _, unres = joins.resolve_citations(
        t("orders").select("o_orderkey", "o_orderstatus"), t("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey"
    )
    return unres


@register(
    "interval_open",
    """WITH items AS (SELECT o.o_orderkey, o.o_orderdate AS start_t, m.end_t FROM orders o
                LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS end_t FROM lineitem GROUP BY 1) m ON o.o_orderkey = m.l_orderkey),
months AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS month FROM orders)
SELECT m.month, CAST(count(*) AS BIGINT) AS n_open, CAST(sum(datediff('day', m.month, i.end_t)) AS BIGINT) AS days_to_close_sum,
       CAST(count(*) FILTER (WHERE i.end_t IS NULL) AS BIGINT) AS n_open_ended
FROM items i JOIN months m ON i.start_t <= m.month AND (i.end_t IS NULL OR i.end_t >= m.month) GROUP BY 1""",
    ids=("C12",),
)
def q_interval_open(spark, d):
    t = Tables(spark, d)
    ends = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("end_t"))
    items = t("orders").select("o_orderkey", F.col("o_orderdate").alias("start_t")).join(ends, "o_orderkey", "left")
    months = materialize(t("orders").select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).distinct())
    x = joins.open_counts(items, months, "start_t", "end_t", "month", grid="month").where("n_open > 0")
    return x.select("month", "n_open", F.when(F.col("n_open") > F.col("n_open_ended"), F.col("days_to_close_sum")).alias("days_to_close_sum"), "n_open_ended")


@register(
    "open_items",
    """WITH items AS (SELECT o.o_orderkey, o.o_orderdate AS start_t, m.end_t FROM orders o
                LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS end_t FROM lineitem GROUP BY 1) m ON o.o_orderkey = m.l_orderkey),
dates AS (SELECT o_orderpriority AS why, max(o_orderdate) AS at FROM orders GROUP BY o_orderpriority, year(o_orderdate))
SELECT d.why, d.at, i.o_orderkey, CAST(datediff('day', d.at, i.end_t) AS INTEGER) AS days_to_close
FROM items i JOIN dates d ON i.start_t <= d.at AND (i.end_t IS NULL OR i.end_t >= d.at)""",
    ids=("C12",),
)
def q_open_items(spark, d):
    """Items open at arbitrary dates (the last order of each priority in each year), as rows."""
    t = Tables(spark, d)
    ends = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("end_t"))
    items = materialize(t("orders").select("o_orderkey", F.col("o_orderdate").alias("start_t")).join(ends, "o_orderkey", "left"))
    dates = materialize(t("orders").groupBy(F.col("o_orderpriority").alias("why"), F.year("o_orderdate").alias("yr")).agg(F.max("o_orderdate").alias("at")).drop("yr"))
    return joins.open_windows(items, dates, "start_t", "end_t", "at").select("why", "at", "o_orderkey", "days_to_close")


@register(
    "asof_vintage",
    f"""WITH {cat_windows.SQL_CUM},
v AS (SELECT n_name, make_timestamp(yr, 12, 31, 0, 0, 0) AS vt, cum FROM cum),
f AS (SELECT o_orderkey, n_name, o_orderdate FROM og)
SELECT f.o_orderkey, {dec('v.cum')} AS cum, v.vt AS asof_vt
FROM f ASOF LEFT JOIN v ON f.n_name = v.n_name AND f.o_orderdate >= v.vt""",
    ids=("C13",),
)
def q_asof_vintage(spark, d):
    t = Tables(spark, d)
    cum = cat_windows.cum_series(t)
    vint = materialize(cum.select("n_name", F.make_timestamp_ntz(F.col("yr"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("vt"), "cum"))
    facts = bind.orders_geo(t, cols=("o_orderkey", "o_custkey", "o_orderdate")).select("o_orderkey", "n_name", "o_orderdate")
    out = joins.asof_latest(facts, vint, "n_name", "o_orderdate", "vt", ["cum"], bucket="year")
    return out.select("o_orderkey", F.col("cum").cast("decimal(38,2)"), F.col("asof_vt").cast("timestamp_ntz").alias("asof_vt"))


@register(
    "reconcile_totals",
    f"""WITH b AS (SELECT l_orderkey, sum(l_extendedprice) AS line_total FROM lineitem GROUP BY 1),
j AS (SELECT coalesce(o.o_orderkey, b.l_orderkey) AS o_orderkey, o.o_totalprice, b.line_total,
             abs(o.o_totalprice - b.line_total) / nullif(abs(b.line_total), 0) AS rel_diff
      FROM orders o FULL OUTER JOIN b ON o.o_orderkey = b.l_orderkey)
SELECT o_orderkey, {dec('rel_diff', 6)} AS rel_diff, coalesce(rel_diff <= 0.003, o_totalprice IS NOT DISTINCT FROM line_total) AS passed FROM j""",
    ids=("C14", "K4"),
)
def q_reconcile_totals(spark, d):
    t = Tables(spark, d)
    b = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("line_total"))
    a = t("orders").select("o_orderkey", "o_totalprice")
    r = joins.reconcile(a, b, "o_orderkey", "o_totalprice", "line_total", tol=0.003)
    return r.select("o_orderkey", F.col("rel_diff").cast("decimal(38,6)"), "passed")


# Fixed values of the test binding: programme lanes per sector (a sector may have two lanes).
LANES = [("ECONOMY", "lane_econ"), ("PROMO", "lane_promo"), ("STANDARD", "lane_std"), ("STANDARD", "lane_std_b"), ("LARGE", "lane_large")]


@register(
    "pair_entities",
    """WITH lanes AS (SELECT * FROM (VALUES ('ECONOMY', 'lane_econ'), ('PROMO', 'lane_promo'), ('STANDARD', 'lane_std'), ('STANDARD', 'lane_std_b'), ('LARGE', 'lane_large')) AS v(p_type, lane))
SELECT p.p_partkey, l.lane FROM part p JOIN lanes l ON p.p_type = l.p_type""",
    ids=("C15",),
)
def q_pair_entities(spark, d):
    p = Tables(spark, d)("part").select("p_partkey", "p_type")
    lanes = joins.bounded(spark.createDataFrame(LANES, "p_type string, lane string"), 10_000)
    return joins.pair_entities(p, lanes, "p_type").select("p_partkey", "lane")


@register(
    "before_after_event",
    f"""WITH cy AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS revenue FROM orders GROUP BY 1, 2),
ev AS (SELECT o_custkey, CAST(first(year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey DESC) AS INTEGER) AS event_yr FROM orders GROUP BY 1)
SELECT ev.o_custkey, ev.event_yr, {dec('avg(CASE WHEN cy.yr - ev.event_yr >= -2 AND cy.yr - ev.event_yr < 0 THEN cy.revenue END)', 4)} AS avg_before,
       {dec('avg(CASE WHEN cy.yr - ev.event_yr >= 0 AND cy.yr - ev.event_yr < 2 THEN cy.revenue END)', 4)} AS avg_after
FROM cy JOIN ev ON cy.o_custkey = ev.o_custkey GROUP BY 1, 2""",
    ids=("C16",),
)
def q_before_after_event(spark, d):
    o = Tables(spark, d)("orders").withColumn("yr", F.year("o_orderdate"))
    # one scan: per (customer, year) revenue and that year's largest order. The event year is
    # picked by a window over each customer's year rows (at most one row per year per customer,
    # so a busy customer is still a handful of rows), and no second pass is needed.
    from pyspark.sql import Window

    cy = o.groupBy("o_custkey", "yr").agg(
        F.sum("o_totalprice").alias("revenue"), F.max(F.struct("o_totalprice", "o_orderkey")).alias("top")
    )
    cy = cy.withColumn("event_yr", F.max_by("yr", "top").over(Window.partitionBy("o_custkey"))).drop("top")
    out = joins.before_after(None, cy, "o_custkey", "event_yr", "yr", "revenue", 2)
    return out.select(
        "o_custkey", "event_yr", F.col("avg_before").cast("decimal(38,4)"), F.col("avg_after").cast("decimal(38,4)")
    )



