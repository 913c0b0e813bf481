"""Windows (E), top-k (F), set operations (G) and statistics (D13-D16) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets, stats, windows
from ..session import materialize
from . import bind, cat_compare
from .registry import Tables, register
from .sqlbits import GEO, NY, ORD_GEO, SUPN, dec

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus", "l_shipdate"]


# ---------------------------------------------------------------------------
# E1 / E2 / E3
# ---------------------------------------------------------------------------


@register(
    "upsert_latest",
    """WITH r AS (SELECT *, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey, l_linenumber) AS cited,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
             l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
       FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate, cited FROM r WHERE rn = 1""",
    ids=("E1", "A11", "I5"),
)
def q_upsert_latest(spark, d):
    li = Tables(spark, d)("lineitem").withColumn("cited", F.col("l_returnflag") == "R")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    base, delta = li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)
    out = windows.upsert(base, delta, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], carry_max=["cited"])
    return out.select(*LI_COLS, "cited")


def cum_series(t: Tables):
    """Running year-end totals of order revenue per nation (cumulative vintages)."""
    from pyspark.sql import Window

    ny = bind.rev_by_nation_year(t)
    w = Window.partitionBy("n_name").orderBy("yr")
    return ny.withColumn("cum", F.sum("revenue").over(w))


SQL_CUM = NY + ",\ncum AS (SELECT n_name, yr, revenue, sum(revenue) OVER (PARTITION BY n_name ORDER BY yr) AS cum FROM ny)"


@register(
    "supersede_latest",
    f"""WITH {SQL_CUM}
SELECT n_name, yr, {dec('cum')} AS cum FROM cum c WHERE yr = (SELECT max(yr) FROM cum c2 WHERE c2.n_name = c.n_name)""",
    ids=("E2",),
)
def q_supersede_latest(spark, d):
    c = cum_series(Tables(spark, d)).select("n_name", "yr", "cum")
    return windows.supersede(c, "n_name", "yr").select("n_name", "yr", F.col("cum").cast("decimal(38,2)"))


@register(
    "cum_to_flow",
    f"""WITH {SQL_CUM}
SELECT n_name, yr, {dec('cum')} AS cum, {dec('cum - lag(cum) OVER (PARTITION BY n_name ORDER BY yr)')} AS flow,
       lag(cum) OVER (PARTITION BY n_name ORDER BY yr) IS NOT NULL AS derivable, {dec('revenue')} AS revenue
FROM cum""",
    ids=("E3",),
)
def q_cum_to_flow(spark, d):
    c = cum_series(Tables(spark, d))
    out = windows.difference_vintages(c, "n_name", "yr", "cum")
    return out.select(
        "n_name", "yr", F.col("cum").cast("decimal(38,2)"), F.col("flow").cast("decimal(38,2)"), "derivable",
        F.col("revenue").cast("decimal(38,2)"),
    )


# ---------------------------------------------------------------------------
# E4 / E5 / E6 / E7 / E8 / E9 / E10 / E11 / E12
# ---------------------------------------------------------------------------


def _growth_sql(n: int) -> str:
    return f"""WITH {NY}
SELECT a.n_name, a.yr, {dec('a.revenue')} AS revenue, {dec('b.revenue')} AS revenue_base_{n},
       {dec(f'(a.revenue - b.revenue) / nullif(abs(b.revenue), 0) * 100', 4)} AS growth_{n}_pct
FROM ny a LEFT JOIN ny b ON a.n_name = b.n_name AND a.yr = b.yr + {n}"""


def _growth_q(n: int):
    def q(spark, d):
        ny = materialize(bind.rev_by_nation_year(Tables(spark, d)).select("n_name", "yr", "revenue"))
        out = windows.growth(ny, "n_name", "yr", "revenue", n)
        return out.select(
            "n_name", "yr", F.col("revenue").cast("decimal(38,2)"), F.col(f"revenue_base_{n}").cast("decimal(38,2)"),
            F.col(f"growth_{n}_pct").cast("decimal(38,4)"),
        )

    return q


register("yoy_growth", _growth_sql(1), ids=("E4",))(_growth_q(1))
register("growth_5y", _growth_sql(5), ids=("E4",))(_growth_q(5))


@register(
    "rank_by_value",
    f"""WITH {SUPN}
SELECT n_name, {dec('out_rev')} AS out_rev, CAST(rank() OVER (ORDER BY out_rev DESC) AS INTEGER) AS rank,
       CAST(dense_rank() OVER (ORDER BY out_rev DESC) AS INTEGER) AS dense_rank,
       CAST(row_number() OVER (ORDER BY out_rev DESC, n_name) AS INTEGER) AS rn FROM supn""",
    ids=("E5",),
)
def q_rank_by_value(spark, d):
    x = materialize(bind.out_rev_by_nation(Tables(spark, d)).select("n_name", "out_rev"))
    x = windows.rank_by(x, "out_rev", method="rank")
    x = windows.rank_by(x, "out_rev", method="dense_rank")
    x = windows.rank_by(x, "out_rev", tiebreak=["n_name"], method="row_number")
    return x.select("n_name", F.col("out_rev").cast("decimal(38,2)"), "rank", "dense_rank", "rn")


@register(
    "top_n_per_group",
    f"""WITH cr AS (SELECT o_custkey, sum(o_totalprice) AS revenue FROM orders GROUP BY 1),
r AS (SELECT c.c_nationkey, cr.o_custkey, cr.revenue,
             row_number() OVER (PARTITION BY c.c_nationkey ORDER BY cr.revenue DESC, cr.o_custkey) AS rk
      FROM cr JOIN customer c ON cr.o_custkey = c.c_custkey)
SELECT c_nationkey, o_custkey, {dec('revenue')} AS revenue, CAST(rk AS INTEGER) AS rk FROM r WHERE rk <= 3""",
    ids=("E6",),
)
def q_top_n_per_group(spark, d):
    t = Tables(spark, d)
    cr = t("orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("revenue"))
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    out = windows.top_n(cr.join(c, "o_custkey"), "c_nationkey", "revenue", 3, tiebreak=["o_custkey"])
    return out.select("c_nationkey", "o_custkey", F.col("revenue").cast("decimal(38,2)"), "rk")


@register(
    "cumulative_share",
    f"""WITH {NY},
nr AS (SELECT n_name, sum(revenue) AS revenue FROM ny GROUP BY 1)
SELECT n_name, {dec('revenue')} AS revenue, CAST(row_number() OVER (ORDER BY revenue DESC, n_name) AS INTEGER) AS pos,
       {dec('sum(revenue) OVER (ORDER BY revenue DESC, n_name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (SELECT sum(revenue) FROM nr) * 100', 4)} AS cum_share_pct
FROM nr""",
    ids=("E7",),
)
def q_cumulative_share(spark, d):
    nr = materialize(bind.rev_by_nation_year(Tables(spark, d)).groupBy("n_name").agg(F.sum("revenue").alias("revenue")))
    out = windows.cum_share(nr, "revenue", tiebreak=["n_name"])
    return out.select("n_name", F.col("revenue").cast("decimal(38,2)"), "pos", F.col("cum_share_pct").cast("decimal(38,4)"))


@register(
    "revision_ledger",
    f"""WITH {NY},
v AS (SELECT n_name, yr, CAST(floor(revenue / n_orders / 10000) AS BIGINT) AS value FROM ny),
l AS (SELECT *, lag(value) OVER (PARTITION BY n_name ORDER BY yr) AS old_value, lag(yr) OVER (PARTITION BY n_name ORDER BY yr) AS old_version FROM v)
SELECT n_name, yr, value, old_value, old_version FROM l WHERE old_version IS NOT NULL AND value IS DISTINCT FROM old_value""",
    ids=("E8",),
)
def q_revision_ledger(spark, d):
    ny = bind.rev_by_nation_year(Tables(spark, d))
    v = ny.select("n_name", "yr", F.floor(F.col("revenue") / F.col("n_orders") / 10000).cast("long").alias("value"))
    return windows.revisions(v, "n_name", "yr", "value").select("n_name", "yr", "value", "old_value", "old_version")


@register(
    "max_normalised",
    f"""WITH {SUPN}
SELECT n_name, {dec("CASE WHEN out_rev > 0 THEN greatest(out_rev / (SELECT max(out_rev) FROM supn) * 100, 2.0) ELSE out_rev / (SELECT max(out_rev) FROM supn) * 100 END", 4)} AS bar_pct
FROM supn""",
    ids=("E9",),
)
def q_max_normalised(spark, d):
    x = materialize(bind.out_rev_by_nation(Tables(spark, d)).select("n_name", "out_rev"))
    return windows.bar_pct(x, "out_rev", 2.0).select("n_name", F.col("bar_pct").cast("decimal(38,4)"))


@register(
    "crossover_year",
    f"""WITH {ORD_GEO},
s AS (SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS a,
             sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS b FROM og GROUP BY 1, 2)
SELECT n_name, min(CASE WHEN b > a THEN yr END) AS crossover_period FROM s GROUP BY 1""",
    ids=("E10",),
)
def q_crossover_year(spark, d):
    og = bind.order_partials(Tables(spark, d), F.year("o_orderdate").alias("yr"), "o_orderstatus")
    s = og.groupBy("n_name", "yr").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("v"))).alias("a"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("v"))).alias("b"),
    )
    return windows.crossover(s, "n_name", "yr", "a", "b")


@register(
    "latest_report",
    f"""WITH {GEO},
x AS (SELECT g.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS period, CAST(year(l.l_shipdate) AS INTEGER) AS report, sum(l.l_extendedprice) AS value
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1, 2, 3)
SELECT n_name, period, {dec('arg_max(value, report)')} AS value, max(report) AS report FROM x GROUP BY 1, 2""",
    ids=("E11",),
)
def q_latest_report(spark, d):
    t = Tables(spark, d)
    li = t("lineitem").groupBy("l_orderkey", F.year("l_shipdate").alias("report")).agg(F.sum("l_extendedprice").alias("value"))
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("period"))
    per_c = li.join(o, "l_orderkey").groupBy("o_custkey", "period", "report").agg(F.sum("value").alias("value"))
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    x = per_c.join(c, "o_custkey").groupBy("n_nationkey", "period", "report").agg(F.sum("value").alias("value"))
    x = x.join(bind.geo(t), "n_nationkey")
    out = windows.latest_report(x, ["n_name", "period"], "report", "value")
    return out.select("n_name", "period", F.col("value").cast("decimal(38,2)"), "report")


@register(
    "spike_flags",
    f"""WITH {ORD_GEO},
cy AS (SELECT n_name, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS revenue, count(*) AS n_orders FROM og GROUP BY 1, 2, 3),
ny AS (SELECT n_name, yr, sum(revenue) AS revenue, sum(n_orders) AS n_orders, count(*) AS n_customers FROM cy GROUP BY 1, 2)
SELECT n_name, {dec('max(revenue) / sum(revenue) * 100', 4)} AS max_share_pct, CAST(count(*) AS BIGINT) AS n_periods,
       CAST(count(*) FILTER (WHERE n_orders = n_customers) AS BIGINT) AS n_repeated_cells,
       max(revenue) / sum(revenue) * 100 >= 16.5 AS spike
FROM ny GROUP BY 1""",
    ids=("E12",),
)
def q_spike_flags(spark, d):
    t = Tables(spark, d)
    cy = t("orders").groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders")
    )
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    ny = cy.join(c, "o_custkey").groupBy("n_nationkey", "yr").agg(
        F.sum("revenue").alias("revenue"), F.sum("n_orders").alias("n_orders"), F.count(F.lit(1)).alias("n_customers")
    ).join(bind.geo(t), "n_nationkey")
    out = windows.flag_spikes(ny, "n_name", "revenue", F.col("n_orders") == F.col("n_customers"), spike_share=16.5)
    return out.select("n_name", F.col("max_share_pct").cast("decimal(38,4)"), "n_periods", "n_repeated_cells", "spike")


# ---------------------------------------------------------------------------
# E13 / E14 / E15
# ---------------------------------------------------------------------------


@register(
    "trajectory_steps",
    """WITH o AS (SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS o_custkey, o_orderkey, CASE WHEN o_orderkey % 89 <> 0 THEN o_orderdate END AS o_orderdate FROM orders)
SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey) AS BIGINT) AS step FROM o""",
    ids=("E13",),
)
def q_trajectory_steps(spark, d):
    o = Tables(spark, d)("orders").select(  # some orders without a customer, some without a date
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderkey",
        F.when(F.col("o_orderkey") % 89 != 0, F.col("o_orderdate")).alias("o_orderdate"),
    )
    out = windows.trajectory(o, "o_custkey", "o_orderdate", tiebreak=["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", F.col("step").cast("long"))


@register(
    "trajectory_factor",
    f"""SELECT o_custkey, {dec('first(o_totalprice ORDER BY o_orderdate, o_orderkey)')} AS first_value,
       {dec('last(o_totalprice ORDER BY o_orderdate, o_orderkey)')} AS last_value,
       {dec('first(o_totalprice ORDER BY o_orderdate, o_orderkey) / last(o_totalprice ORDER BY o_orderdate, o_orderkey)', 6)} AS factor
FROM orders GROUP BY 1""",
    ids=("E14",),
)
def q_trajectory_factor(spark, d):
    o = Tables(spark, d)("orders")
    out = windows.trajectory_factor(o, "o_custkey", "o_orderdate", "o_totalprice", tiebreak=["o_orderkey"])
    return out.select(
        "o_custkey", F.col("first_value").cast("decimal(38,2)"), F.col("last_value").cast("decimal(38,2)"),
        F.col("factor").cast("decimal(38,6)"),
    )


@register(
    "quadrant_class",
    cat_compare.SQL_BASE
    + """,
j AS (SELECT coalesce(i.place, m.place) AS place, i.inflow_amt / (SELECT sum(inflow_amt) FROM inflow) * 100 AS a,
             m.impl_amt / (SELECT sum(impl_amt) FROM impl) * 100 AS b
      FROM inflow i FULL OUTER JOIN impl m ON i.place = m.place)
SELECT place, (CASE WHEN a >= 4.0 THEN 'high' ELSE 'low' END) || '_' || (CASE WHEN b >= 4.0 THEN 'high' ELSE 'low' END) AS quadrant FROM j""",
    ids=("E15",),
)
def q_quadrant_class(spark, d):
    c = cat_compare.comparison(Tables(spark, d))
    return c.select("place", windows.quadrant(F.col("inflow_share"), F.col("impl_share"), 4.0, 4.0).alias("quadrant"))


# ---------------------------------------------------------------------------
# F2 / G2 / G5
# ---------------------------------------------------------------------------


@register(
    "top_entities",
    "SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 12",
    ids=("F2",),
)
def q_top_entities(spark, d):
    return windows.top_entities(Tables(spark, d)("events"), "user_id", 12)


@register(
    "align_union",
    """SELECT o_orderkey AS scheme, o_orderdate AS date, o_totalprice AS outlay, o_orderpriority = '1-URGENT' AS pli
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderdate, o_totalprice, NULL FROM orders WHERE o_orderstatus <> 'F'""",
    ids=("G2",),
)
def q_align_union(spark, d):
    o = Tables(spark, d)("orders")
    long_form = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("scheme"), F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("outlay"),
        (F.col("o_orderpriority") == "1-URGENT").alias("pli"),
    )
    short_form = o.where(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("s"), F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("cr")
    )
    return sets.align_union([long_form, short_form], [{}, {"s": "scheme", "d": "date", "cr": "outlay"}])


@register(
    "column_union",
    """SELECT 'k' AS key, min(event_id) AS first_row, 0 AS first_pos FROM events WHERE json_extract(props, '$.k') IS NOT NULL
UNION ALL
SELECT event_type, min(event_id), 1 FROM events GROUP BY 1""",
    ids=("G5",),
)
def q_column_union(spark, d):
    e = Tables(spark, d)("events")
    m = F.map_concat(F.from_json("props", "map<string,double>"), F.create_map(F.col("event_type"), F.col("value")))
    return sets.column_union(e.select("event_id", m.alias("m")), "m", "event_id")


# ---------------------------------------------------------------------------
# D13 / D14 / D15 / D16 / F4 on a per-nation panel
# ---------------------------------------------------------------------------

SQL_PANEL = f"""WITH {SUPN},
inn AS (SELECT g.n_name, sum(l.l_extendedprice) AS in_rev FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1),
nc AS (SELECT g.n_name, count(*) AS n_cust FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1),
p AS (SELECT s.n_name, s.out_rev AS y, i.in_rev AS x, CAST(nc.n_cust AS DOUBLE) AS z FROM supn s JOIN inn i ON s.n_name = i.n_name JOIN nc ON nc.n_name = s.n_name)"""


def panel(t: Tables):
    c = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).cast("double").alias("z"))
    c = c.join(bind.geo(t), "n_nationkey").select("n_name", "z")
    # one row per nation, read by several branches (fit, residuals, both extremes): materialised
    return materialize(
        bind.out_rev_by_nation(t).select("n_name", F.col("out_rev").alias("y"))
        .join(bind.in_rev_by_nation(t).select("n_name", F.col("in_rev").alias("x")), "n_name")
        .join(c, "n_name")
    )


@register(
    "pearson",
    SQL_PANEL + f"\nSELECT {dec('corr(y, x)', 6)} AS pearson_r, CAST(count(*) AS BIGINT) AS n FROM p",
    ids=("D13",),
)
def q_pearson(spark, d):
    out = stats.pearson(panel(Tables(spark, d)), "y", "x")
    return out.select(F.col("pearson_r").cast("decimal(38,6)"), "n")


@register(
    "corr_matrix",
    " UNION ALL ".join(f"SELECT '{x}' AS x, {dec(f'corr(l_extendedprice, {x})', 6)} AS pearson_r, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_extendedprice IS NOT NULL AND {x} IS NOT NULL"
                       for x in ("l_quantity", "l_discount", "l_tax")),
    ids=("D13",),
)
def q_corr_matrix(spark, d):
    out = stats.corr_matrix(Tables(spark, d)("lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return out.select("x", F.col("pearson_r").cast("decimal(38,6)").alias("pearson_r"), "n")


@register(
    "spearman",
    SQL_PANEL
    + f""",
r AS (SELECT rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry,
             rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx FROM p)
SELECT {dec('corr(ry, rx)', 6)} AS spearman_rho, CAST(count(*) AS BIGINT) AS n FROM r""",
    ids=("D14",),
)
def q_spearman(spark, d):
    out = stats.spearman(panel(Tables(spark, d)), "y", "x")
    return out.select(F.col("spearman_rho").cast("decimal(38,6)"), "n")


@register(
    "partial_corr",
    SQL_PANEL
    + f""",
c AS (SELECT corr(y, x) AS rxy, corr(y, z) AS ryz, corr(x, z) AS rxz, count(*) AS n FROM p)
SELECT {dec('(rxy - ryz * rxz) / sqrt((1 - ryz * ryz) * (1 - rxz * rxz))', 6)} AS partial_r, CAST(n AS BIGINT) AS n FROM c""",
    ids=("D15",),
)
def q_partial_corr(spark, d):
    out = stats.partial_corr(panel(Tables(spark, d)), "y", "x", "z")
    return out.select(F.col("partial_r").cast("decimal(38,6)"), "n")


@register(
    "loglog_residuals",
    SQL_PANEL
    + f""",
lp AS (SELECT n_name, log10(y) AS ly, log10(x) AS lx FROM p WHERE y > 0 AND x > 0),
fit AS (SELECT regr_slope(ly, lx) AS slope, regr_intercept(ly, lx) AS intercept FROM lp),
res AS (SELECT n_name, ly - (intercept + slope * lx) AS residual, slope FROM lp, fit),
o AS (SELECT 'over' AS side, n_name, residual, slope FROM res ORDER BY residual DESC, n_name LIMIT 3),
u AS (SELECT 'under' AS side, n_name, residual, slope FROM res ORDER BY residual ASC, n_name LIMIT 3)
SELECT side, n_name, {dec('residual', 6)} AS residual, {dec('slope', 6)} AS slope FROM o UNION ALL SELECT side, n_name, {dec('residual', 6)}, {dec('slope', 6)} FROM u""",
    ids=("D16", "F4"),
)
def q_loglog_residuals(spark, d):
    fit = stats.loglog_fit(panel(Tables(spark, d)), "n_name", "y", "x")
    ext = stats.extremes(fit, "residual", "n_name", 3)  # a top-k report; all residuals are in loglog_fit
    return ext.select("side", "n_name", F.col("residual").cast("decimal(38,6)"), F.col("slope").cast("decimal(38,6)"))


@register(
    "loglog_fit",
    SQL_PANEL
    + f""",
lp AS (SELECT n_name, log10(y) AS ly, log10(x) AS lx FROM p WHERE y > 0 AND x > 0),
fit AS (SELECT regr_slope(ly, lx) AS slope, regr_intercept(ly, lx) AS intercept FROM lp)
SELECT n_name, {dec('intercept + slope * lx', 6)} AS fitted, {dec('ly - (intercept + slope * lx)', 6)} AS residual, {dec('slope', 6)} AS slope FROM lp, fit""",
    ids=("D16",),
)
def q_loglog_fit(spark, d):
    fit = stats.loglog_fit(panel(Tables(spark, d)), "n_name", "y", "x")
    return fit.select("n_name", *(F.col(c).cast("decimal(38,6)").alias(c) for c in ("fitted", "residual", "slope")))
