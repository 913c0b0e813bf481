"""Predicates (B) and aggregations (D) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import canon_label
from ..functions.scalars import pct, safe_ratio
from ..operators import aggs, filters, windows
from ..session import materialize
from . import bind
from .registry import Tables, register, sql_canon
from .sqlbits import GEO, NY, ORD_GEO, SUPN, dec

# ---------------------------------------------------------------------------
# B1 / B2 / B3 / B4 / B5 / B6 / B7 / B9
# ---------------------------------------------------------------------------


@register(
    "canon_label",
    f"""WITH {GEO}
SELECT {sql_canon("' ' || lower(c.c_mktsegment) || ' &  ' || g.n_name || '.'")} AS label, CAST(count(*) AS BIGINT) AS n
FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1""",
    ids=("B1",),
)
def q_canon_label(spark, d):
    t = Tables(spark, d)
    c = t("customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").join(bind.geo(t), "n_nationkey")
    raw = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" &  "), F.col("n_name"), F.lit("."))
    return c.groupBy(canon_label(raw).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "drop_stop_labels",
    """SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer
WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> ''
  AND lower(trim(c_mktsegment)) NOT IN ('household', 'total', 'not indicated')
GROUP BY 1""",
    ids=("B2",),
)
def q_drop_stop_labels(spark, d):
    c = Tables(spark, d)("customer")
    kept = filters.drop_labels(c, "c_mktsegment", ["household", "total", "not indicated"])
    return kept.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@register(
    "window_matched_sum",
    f"""SELECT o_orderstatus, {dec('sum(o_totalprice)')} AS amount, CAST(count(*) AS BIGINT) AS n
FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998) GROUP BY 1""",
    ids=("B3",),
)
def q_window_matched_sum(spark, d):
    o = Tables(spark, d)("orders")
    # the year list is also given as a date range so the bound reaches the Parquet scan
    o = o.where((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    o = filters.in_window(o.withColumn("yr", F.year("o_orderdate")), "yr", [1996, 1997, 1998])
    return o.groupBy("o_orderstatus").agg(F.sum("o_totalprice").cast("decimal(38,2)").alias("amount"), F.count(F.lit(1)).alias("n"))


QUARANTINE = [(1, "yr", "=", "1995", "predates the comparison window"), (2, "yr", "=", "2001", "partial year (to August)")]


@register(
    "quarantine_reason",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr,
       CASE year(o_orderdate) WHEN 1995 THEN 'predates the comparison window' WHEN 2001 THEN 'partial year (to August)' END AS reason,
       CAST(count(*) AS BIGINT) AS n, {dec('sum(o_totalprice)')} AS amount
FROM orders GROUP BY 1, 2""",
    ids=("B4",),
)
def q_quarantine_reason(spark, d):
    """Orders of a year and their sums, split by the rules table; both outputs are written."""
    from ..sources.bulletins import scratch_path

    o = Tables(spark, d)("orders").select(F.year("o_orderdate").alias("yr"), "o_totalprice")
    good, bad = filters.write_quarantine(o, spark.createDataFrame(QUARANTINE, filters.RULES_SCHEMA), scratch_path(spark, "quarantine"))
    g = good.groupBy("yr").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amount")).withColumn(
        "reason", F.lit(None).cast("string")
    )
    b = bad.groupBy("yr", "quarantine_reason").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amount"))
    b = b.withColumnRenamed("quarantine_reason", "reason")
    return g.unionByName(b).select("yr", "reason", "n", F.col("amount").cast("decimal(38,2)").alias("amount"))


@register(
    "register_like",
    "SELECT p_partkey, p_name, p_size FROM part WHERE p_name LIKE '%blue%' AND p_size >= 10 AND p_size < 21",
    ids=("B5",),
)
def q_register_like(spark, d):
    p = Tables(spark, d)("part")
    p = filters.register_query(p, like="%blue%", like_col="p_name", date_col="p_size", date_from=10, date_to=21)
    return p.select("p_partkey", "p_name", "p_size")


@register(
    "title_sweep",
    """SELECT doc_id, lang FROM documents
WHERE regexp_matches(text, '(?i)(licen[cs]e|copyright)') AND NOT regexp_matches(text, '(?i)apache')""",
    ids=("B6",),
)
def q_title_sweep(spark, d):
    docs = Tables(spark, d)("documents").select("doc_id", "lang", "text")
    return filters.title_sweep(docs, "text", "(?i)(licen[cs]e|copyright)", "(?i)apache").select("doc_id", "lang")


@register(
    "slicer",
    f"""SELECT 'all' AS slice, o_orderpriority, {dec('sum(o_totalprice)')} AS amount FROM orders GROUP BY 2
UNION ALL
SELECT 'O' AS slice, o_orderpriority, {dec('sum(o_totalprice)')} AS amount FROM orders WHERE o_orderstatus = 'O' GROUP BY 2""",
    ids=("B7",),
)
def q_slicer(spark, d):
    o = Tables(spark, d)("orders")
    # one scan: sums per (status, priority) first, the slices are taken of those few rows
    per = materialize(o.groupBy("o_orderstatus", "o_orderpriority").agg(F.sum("o_totalprice").alias("v")))

    def one(name):
        part = filters.slicer(per, "o_orderstatus", name).groupBy("o_orderpriority").agg(F.sum("v").cast("decimal(38,2)").alias("amount"))
        return part.select(F.lit(name).alias("slice"), "o_orderpriority", "amount")

    return one("all").unionByName(one("O"))


@register(
    "industrial_subset",
    """SELECT p_type, CAST(count(*) AS BIGINT) AS n FROM part
WHERE p_type IN ('ECONOMY', 'STANDARD', 'LARGE') AND p_brand NOT IN ('Brand#1', 'Brand#2') GROUP BY 1""",
    ids=("B9",),
)
def q_industrial_subset(spark, d):
    p = Tables(spark, d)("part")
    p = filters.domain_filter(p, "p_type", keep=["ECONOMY", "STANDARD", "LARGE"], drop=None)
    p = filters.domain_filter(p, "p_brand", drop=["Brand#1", "Brand#2"])
    return p.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# D2 / D4 / D5 / D6 / D7 / D8 / D9 / D10 / D11
# ---------------------------------------------------------------------------


@register(
    "prefer_source",
    f"""WITH {GEO},
prim AS (SELECT g.n_name, sum(s.s_acctbal) AS v FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey
         WHERE g.r_name <> 'ASIA' GROUP BY 1),
fb AS (SELECT g.n_name, sum(c.c_acctbal) AS v FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1)
SELECT n_name, {dec('v')} AS v, 'primary' AS basis FROM prim
UNION ALL
SELECT n_name, {dec('v')} AS v, 'fallback' AS basis FROM fb WHERE n_name NOT IN (SELECT n_name FROM prim)""",
    ids=("D2",),
)
def q_prefer_source(spark, d):
    t = Tables(spark, d)
    g = bind.geo(t)
    prim = materialize(
        t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal").join(g.where(F.col("r_name") != "ASIA"), "n_nationkey")
        .groupBy("n_name").agg(F.sum("s_acctbal").alias("v"))
    )
    fb = (
        t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("c_acctbal").alias("v"))
        .join(g, "n_nationkey").select("n_name", "v")
    )
    out = aggs.prefer(prim, fb, "n_name", "primary", "fallback")
    return out.select("n_name", F.col("v").cast("decimal(38,2)").alias("v"), "basis")


@register(
    "prefer_table",
    f"""SELECT 'urgent orders' AS wanted, o_orderpriority AS label, {dec('sum(o_totalprice)')} AS v, 'primary' AS basis FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 2
UNION ALL SELECT 'withdrawn orders', p_type, {dec('sum(p_retailprice)')}, 'fallback' FROM part WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'W') GROUP BY 2""",
    ids=("D2",),
)
def q_prefer_table(spark, d):
    """The whole-table fallback twice: one primary table has rows, the other has none."""
    t = Tables(spark, d)
    sums = lambda df, by, v: df.groupBy(F.col(by).alias("label")).agg(F.sum(v).cast("decimal(38,2)").alias("v"))
    parts = sums(t("part"), "p_type", "p_retailprice")
    urgent = aggs.prefer_table(sums(t("orders").where(F.col("o_orderpriority") == "1-URGENT"), "o_orderpriority", "o_totalprice"), parts, "primary", "fallback")
    gone = aggs.prefer_table(sums(t("orders").where(F.col("o_orderstatus") == "W"), "o_orderpriority", "o_totalprice"), parts, "primary", "fallback")
    return urgent.select(F.lit("urgent orders").alias("wanted"), "*").unionByName(gone.select(F.lit("withdrawn orders").alias("wanted"), "*"))


@register(
    "register_stats",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_date, max(ts) AS last_date,
       CAST(sum(CAST(value > 10 AS INTEGER)) AS BIGINT) AS n_flagged
FROM events GROUP BY 1""",
    ids=("D4",),
)
def q_register_stats(spark, d):
    e = Tables(spark, d)("events").withColumn("flag", F.col("value") > 10)
    return aggs.register_stats(e, "event_type", "ts", "flag")


@register(
    "entity_activity",
    """WITH cat AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup')
SELECT e.user_id, CAST(count(*) AS BIGINT) AS n, min(e.ts) AS first_date, max(e.ts) AS last_date,
       bool_or(c.user_id IS NOT NULL) AS in_catalog
FROM events e LEFT JOIN cat c ON e.user_id = c.user_id GROUP BY 1""",
    ids=("D5",),
)
def q_entity_activity(spark, d):
    e = Tables(spark, d)("events")
    cat = e.where(F.col("event_type") == "signup").select("user_id")
    return aggs.entity_activity(e, "user_id", "ts", cat, "user_id")


@register(
    "status_cube",
    f"""WITH {ORD_GEO}
SELECT r_name, o_orderpriority, o_orderstatus, CAST(count(*) AS BIGINT) AS n,
       CAST(GROUPING(r_name, o_orderpriority, o_orderstatus) AS BIGINT) AS gid, {dec('sum(o_totalprice)')} AS amount
FROM og GROUP BY ROLLUP (r_name, o_orderpriority, o_orderstatus)""",
    ids=("D6", "A10"),
)
def q_status_cube(spark, d):
    dims = ["r_name", "o_orderpriority", "o_orderstatus"]
    og = bind.order_partials(Tables(spark, d), "o_orderpriority", "o_orderstatus").withColumnRenamed("n", "w")
    per = og.groupBy(*dims).agg(F.sum("w").alias("w"), F.sum("v").alias("o_totalprice"))
    out = aggs.status_cube(per, dims, "o_totalprice", weight="w")
    return out.select(
        "r_name", "o_orderpriority", "o_orderstatus", "n", F.col("gid").cast("long").alias("gid"),
        F.col("sum_o_totalprice").cast("decimal(38,2)").alias("amount"),
    )


@register(
    "status_funnel",
    f"""SELECT o_orderpriority, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS n_granted,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS n_in_process,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS n_dead, CAST(count(*) AS BIGINT) AS n_total,
       {dec("count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / (count(*) - count(*) FILTER (WHERE o_orderstatus = 'P'))", 4)} AS granted_rate_pct
FROM orders GROUP BY 1""",
    ids=("D7",),
)
def q_status_funnel(spark, d):
    o = Tables(spark, d)("orders")
    out = aggs.status_funnel(o, "o_orderpriority", "o_orderstatus", {"granted": ["F"], "in_process": ["O"], "dead": ["P"]}, dead="dead")
    return out.withColumn("granted_rate_pct", F.col("granted_rate_pct").cast("decimal(38,4)"))


@register(
    "category_tally",
    f"""WITH {GEO}
SELECT g.n_name, CAST(count(s.s_suppkey) AS BIGINT) AS n FROM geo g LEFT JOIN supplier s ON s.s_nationkey = g.n_nationkey GROUP BY 1
UNION ALL SELECT r_name, 0 FROM region""",
    ids=("D8",),
)
def q_category_tally(spark, d):
    t = Tables(spark, d)
    s = t("supplier").select(F.col("s_nationkey").alias("n_nationkey")).join(bind.geo(t), "n_nationkey").select("n_name")
    # the listed domain also has the zones, which no supplier names: they count 0
    return aggs.tally(s, "n_name", t("nation").select("n_name").unionByName(t("region").select(F.col("r_name").alias("n_name"))))


@register(
    "transition_matrix",
    """SELECT o_orderstatus AS old_status,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F'
            WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'P' ELSE o_orderstatus END AS new_status,
       CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1, 2""",
    ids=("D9",),
)
def q_transition_matrix(spark, d):
    o = Tables(spark, d)("orders").select(F.col("o_orderstatus").alias("old_status"), bind.after_status().alias("new_status"))
    return aggs.transition_matrix(o, "old_status", "new_status")


@register(
    "scoreboard",
    """SELECT p_brand, CAST(count(DISTINCT p_type) AS BIGINT) AS n, array_to_string(list_sort(list_distinct(list(p_type))), ', ') AS members
FROM part GROUP BY 1""",
    ids=("D10",),
)
def q_scoreboard(spark, d):
    return aggs.scoreboard(Tables(spark, d)("part"), "p_brand", "p_type")


@register(
    "years_used",
    "SELECT string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS yr_used FROM orders",
    ids=("D11",),
)
def q_years_used(spark, d):
    o = Tables(spark, d)("orders").select(F.year("o_orderdate").alias("yr"))
    return aggs.used_values(o, "yr")


# ---------------------------------------------------------------------------
# D12 / D17 / D18 / D19 / D20 / D21 / D22 / D23 / D24 / D25 / D26
# ---------------------------------------------------------------------------


@register(
    "series_profile",
    f"""WITH {NY},
n2 AS (SELECT nullif(n_name, 'FRANCE') AS n_name, yr, revenue FROM ny), yrs AS (SELECT DISTINCT yr FROM ny), ents AS (SELECT DISTINCT n_name FROM n2),
frame AS (SELECT e.n_name, y.yr, coalesce(n2.revenue, 0) AS v FROM ents e CROSS JOIN yrs y LEFT JOIN n2 ON n2.n_name IS NOT DISTINCT FROM e.n_name AND n2.yr = y.yr)
SELECT n_name, {dec('sum(v)')} AS total, {dec('max(v) / nullif(sum(v), 0) * 100', 4)} AS peak_share_pct,
       {dec('CASE WHEN avg(v) <> 0 THEN stddev_pop(v) / avg(v) END', 4)} AS cv, CAST(count(v) AS BIGINT) AS n_periods
FROM frame GROUP BY 1""",
    ids=("D12",),
)
def q_series_profile(spark, d):
    ny = materialize(bind.rev_by_nation_year(Tables(spark, d)))
    periods = ny.select("yr").distinct()
    ny = ny.withColumn("n_name", F.nullif("n_name", F.lit("FRANCE")))  # an entity without a name
    out = aggs.series_profile(ny, "n_name", "yr", "revenue", periods, missing="zero")
    return out.select(
        "n_name", F.col("total").cast("decimal(38,2)").alias("total"), F.col("peak_share_pct").cast("decimal(38,4)").alias("peak_share_pct"),
        F.col("cv").cast("decimal(38,4)").alias("cv"), "n_periods",
    )


@register(
    "ledger_total",
    f"""WITH {GEO},
layers AS (SELECT g.r_name AS layer, sum(s.s_acctbal) AS v, g.r_name <> 'ASIA' AS siteable
           FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY g.r_name)
SELECT {dec('sum(v)')} AS total, {dec('sum(CASE WHEN siteable THEN v END)')} AS ready_total FROM layers""",
    ids=("D17", "B11"),
)
def q_ledger_total(spark, d):
    t = Tables(spark, d)
    s = t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal").join(bind.geo(t), "n_nationkey")
    layers = s.groupBy(F.col("r_name").alias("layer")).agg(F.sum("s_acctbal").alias("v")).withColumn("siteable", F.col("layer") != "ASIA")
    out = aggs.ledger_total(layers, "v", "siteable")
    return out.select(F.col("total").cast("decimal(38,2)").alias("total"), F.col("ready_total").cast("decimal(38,2)").alias("ready_total"))


@register(
    "positive_part_sum",
    f"""WITH {ORD_GEO},
b AS (SELECT n_name, count(*) FILTER (WHERE o_orderstatus = 'O') - count(*) FILTER (WHERE o_orderstatus = 'F') AS backlog_n,
             coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 0) - coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0) AS backlog_v
      FROM og GROUP BY 1)
SELECT CAST(sum(greatest(backlog_n, 0)) AS BIGINT) AS backlog_n_positive, CAST(sum(backlog_n) AS BIGINT) AS backlog_n_net,
       {dec('sum(greatest(backlog_v, 0))')} AS backlog_v_positive, {dec('sum(backlog_v)')} AS backlog_v_net FROM b""",
    ids=("D18",),
)
def q_positive_part_sum(spark, d):
    og = bind.order_partials(Tables(spark, d), "o_orderstatus")
    st = F.col("o_orderstatus")
    b = og.groupBy("n_name").agg(
        (F.coalesce(F.sum(F.when(st == "O", F.col("n"))), F.lit(0)) - F.coalesce(F.sum(F.when(st == "F", F.col("n"))), F.lit(0))).alias("backlog_n"),
        (F.coalesce(F.sum(F.when(st == "O", F.col("v"))), F.lit(0.0))
         - F.coalesce(F.sum(F.when(st == "F", F.col("v"))), F.lit(0.0))).alias("backlog_v"),
    )
    out = aggs.sum_positive(b, ["backlog_n", "backlog_v"], net=True)
    return out.select(
        F.col("backlog_n_positive").cast("long"), F.col("backlog_n_net").cast("long"),
        F.col("backlog_v_positive").cast("decimal(38,2)"), F.col("backlog_v_net").cast("decimal(38,2)"),
    )


@register(
    "bucket_ratio_mean",
    f"""WITH pp AS (SELECT l_partkey, sum(l_extendedprice) AS rev, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
SELECT p.p_type, {dec('avg(pp.rev / nullif(pp.qty, 0))', 4)} AS mean_ratio, {dec('sum(pp.rev) / nullif(sum(pp.qty), 0)', 4)} AS pooled_ratio,
       CAST(count(pp.rev / nullif(pp.qty, 0)) AS BIGINT) AS n_rows
FROM pp JOIN part p ON pp.l_partkey = p.p_partkey GROUP BY 1""",
    ids=("D19",),
)
def q_bucket_ratio_mean(spark, d):
    t = Tables(spark, d)
    pp = t("lineitem").groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("rev"), F.sum("l_quantity").alias("qty"))
    p = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    out = aggs.bucket_mean_ratio(pp.join(p, "l_partkey"), "p_type", "rev", "qty")
    return out.select("p_type", F.col("mean_ratio").cast("decimal(38,4)"), F.col("pooled_ratio").cast("decimal(38,4)"), "n_rows")


SQL_TYPE_NATION = f"""WITH {GEO},
tn AS (SELECT p.p_type, g.n_name, sum(l.l_extendedprice) AS v
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY v DESC, n_name) AS rk FROM tn)"""


def type_nation(t: Tables):
    """Revenue per (part type, supplier nation); lineitem reduced per (part, supplier) first."""
    li = t("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    p = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    s = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    x = li.join(p, "l_partkey").join(s, "l_suppkey").groupBy("p_type", "n_nationkey").agg(F.sum("v").alias("v"))
    return x.join(bind.geo(t), "n_nationkey").select("p_type", "n_name", "v")


@register(
    "partner_concentration",
    SQL_TYPE_NATION
    + f"""
SELECT n_name, {dec('sum(CASE WHEN rk <= 8 THEN v END)')} AS exposure, CAST(count(*) FILTER (WHERE rk <= 8) AS BIGINT) AS n_top_k,
       CAST(count(*) FILTER (WHERE rk <= 2) AS BIGINT) AS n_top_2
FROM rk GROUP BY 1""",
    ids=("D20",),
)
def q_partner_concentration(spark, d):
    tn = type_nation(Tables(spark, d))
    ranked = windows.rank_by(tn, "v", partition_by="p_type", tiebreak=["n_name"], method="row_number").withColumnRenamed("rn", "rk")
    out = aggs.partner_concentration(ranked, "n_name", "v", "rk", 8)
    return out.withColumn("exposure", F.col("exposure").cast("decimal(38,2)"))


@register(
    "exposure_sum",
    f"""SELECT {dec('sum(l.l_extendedprice)')} AS exposure FROM lineitem l
WHERE l.l_partkey IN (SELECT p_partkey FROM part WHERE p_size IN (7, 14, 21, 28, 35))""",
    ids=("D21",),
)
def q_exposure_sum(spark, d):
    t = Tables(spark, d)
    codes = t("part").where(F.col("p_size").isin(7, 14, 21, 28, 35)).select(F.col("p_partkey").alias("l_partkey"))
    li = t("lineitem").groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("v"))
    out = aggs.exposure(li, "l_partkey", codes, "v")
    return out.select(F.col("exposure").cast("decimal(38,2)"))


@register(
    "launch_mix",
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderpriority, CAST(count(*) AS BIGINT) AS n, {dec('sum(o_totalprice)')} AS outlay,
       {dec("sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / nullif(sum(o_totalprice), 0) * 100", 4)} AS flagged_share_pct
FROM orders GROUP BY 1, 2""",
    ids=("D22",),
)
def q_launch_mix(spark, d):
    o = Tables(spark, d)("orders").withColumn("yr", F.year("o_orderdate")).withColumn("flag", F.col("o_orderstatus") == "F")
    out = aggs.launch_mix(o, "yr", "o_orderpriority", "o_totalprice", "flag")
    return out.select("yr", "o_orderpriority", "n", F.col("outlay").cast("decimal(38,2)"), F.col("flagged_share_pct").cast("decimal(38,4)"))


@register(
    "quarter_digest",
    """WITH q AS (SELECT o_orderkey, o_totalprice,
                  printf('FY%d-%02d', year(o_orderdate - INTERVAL 3 MONTH), (year(o_orderdate - INTERVAL 3 MONTH) + 1) % 100) AS fy,
                  CAST(quarter(o_orderdate - INTERVAL 3 MONTH) AS INTEGER) AS fq FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY fy, fq ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM q)
SELECT fy, fq, CAST((rk - 1) // 100 + 1 AS BIGINT) AS line, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(o_orderkey AS VARCHAR), '; ' ORDER BY rk) AS digest
FROM r GROUP BY 1, 2, 3""",
    ids=("D23", "H8"),
)
def q_quarter_digest(spark, d):
    from ..functions.scalars import fiscal_label, fiscal_quarter

    o = Tables(spark, d)("orders").select(
        "o_orderkey", (-F.col("o_totalprice")).alias("down"), fiscal_label("o_orderdate").alias("fy"), fiscal_quarter("o_orderdate").alias("fq")
    )
    return aggs.quarter_digest(o, ["fy", "fq"], "o_orderkey", ["down", "o_orderkey"], F.lit(0)).select("fy", "fq", "line", "n", "digest")


@register(
    "grand_total_check",
    f"""WITH {ORD_GEO},
body AS (SELECT n_name, sum(o_totalprice) AS v FROM og GROUP BY 1),
printed AS (SELECT sum(o_totalprice) AS v FROM og)
SELECT t AS table_no, {dec('(SELECT sum(v) FROM body)')} AS resummed, {dec('(SELECT v FROM printed) * f')} AS printed,
       abs((SELECT sum(v) FROM body) - (SELECT v FROM printed) * f) <= 0.005 * abs((SELECT v FROM printed) * f) AS passed FROM (VALUES (1, 1.0), (2, 1.01)) AS x(t, f)""",
    ids=("D24",),
)
def q_grand_total_check(spark, d):
    og = bind.order_partials(Tables(spark, d))
    table = materialize(
        og.rollup("n_name").agg(F.sum("v").alias("v")).withColumn("n_name", F.coalesce("n_name", F.lit("Grand Total")))
    )
    # a second table whose printed total is one percent too high must fail
    wrong = table.withColumn("v", F.when(F.col("n_name") == "Grand Total", F.col("v") * 1.01).otherwise(F.col("v")))
    checks = [aggs.check_grand_total(x, "n_name", "v", "Grand Total").withColumn("table_no", F.lit(i)) for i, x in ((1, table), (2, wrong))]
    return checks[0].unionByName(checks[1]).select("table_no", F.col("resummed").cast("decimal(38,2)"), F.col("printed").cast("decimal(38,2)"), "passed")


@register(
    "backlog_by_place",
    f"""WITH {ORD_GEO}
SELECT n_name, CAST(count(*) AS BIGINT) AS filed_n, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS impl_n,
       {dec('sum(o_totalprice)')} AS filed_value, {dec("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F')")} AS impl_value,
       CAST(count(*) - count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS pending_n,
       {dec("coalesce(sum(o_totalprice), 0) - coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0)")} AS pending_value,
       {dec("count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(*)", 4)} AS conversion_pct
FROM og GROUP BY 1""",
    ids=("D25",),
)
def q_backlog_by_place(spark, d):
    og = bind.order_partials(Tables(spark, d), "o_orderstatus")
    out = aggs.backlog(og, "n_name", F.lit(True), F.col("o_orderstatus") == "F", "v", count_col="n")
    return out.select(
        "n_name", "filed_n", "impl_n", F.col("filed_value").cast("decimal(38,2)"), F.col("impl_value").cast("decimal(38,2)"),
        "pending_n", F.col("pending_value").cast("decimal(38,2)"), F.col("conversion_pct").cast("decimal(38,4)"),
    )


@register(
    "completeness",
    """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT lang, 'quality' AS field, CAST(count(*) FILTER (WHERE quality IS NULL) AS BIGINT) AS n_null,
       CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_zero, CAST(count(*) FILTER (WHERE quality IS NOT NULL AND quality <> 0) AS BIGINT) AS n_present
FROM j GROUP BY 1
UNION ALL
SELECT lang, 'toxic', CAST(count(*) FILTER (WHERE toxic IS NULL) AS BIGINT), CAST(count(*) FILTER (WHERE toxic = 0) AS BIGINT),
       CAST(count(*) FILTER (WHERE toxic IS NOT NULL AND toxic <> 0) AS BIGINT) FROM j GROUP BY 1
UNION ALL
SELECT lang, 'n_chars', CAST(count(*) FILTER (WHERE n_chars IS NULL) AS BIGINT), CAST(count(*) FILTER (WHERE n_chars = 0) AS BIGINT),
       CAST(count(*) FILTER (WHERE n_chars IS NOT NULL AND n_chars <> 0) AS BIGINT) FROM j GROUP BY 1""",
    ids=("D26", "K8"),
)
def q_completeness(spark, d):
    t = Tables(spark, d)
    j = t("documents").select("doc_id", "lang", "n_chars").join(t("labels"), "doc_id", "left")
    return aggs.completeness(j, "lang", ["quality", "toxic", "n_chars"])


# ---------------------------------------------------------------------------
# D29 / D30 / D31 / D32 / D33 / D34 / D35 / D36
# ---------------------------------------------------------------------------


@register(
    "tier_funnel",
    f"""WITH {GEO},
t AS (SELECT g.r_name AS tier, g.r_regionkey AS ord, sum(s.s_acctbal) AS tier_value FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1, 2),
dem AS (SELECT sum(o_totalprice) / 1000.0 AS demand FROM orders WHERE o_orderstatus = 'O')
SELECT tier, CAST(ord AS INTEGER) AS ord, {dec('tier_value')} AS tier_value,
       {dec('sum(tier_value) OVER (ORDER BY ord, tier ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS running_value,
       {dec('(SELECT demand FROM dem) / nullif(sum(tier_value) OVER (ORDER BY ord, tier ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)', 4)} AS demand_multiple
FROM t""",
    ids=("D29",),
)
def q_tier_funnel(spark, d):
    t = Tables(spark, d)
    g = t("nation").select("n_nationkey", F.col("n_regionkey").alias("ord")).join(
        t("region").select(F.col("r_regionkey").alias("ord"), F.col("r_name").alias("tier")), "ord"
    )
    s = t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal").join(g, "n_nationkey")
    dem = t("orders").where(F.col("o_orderstatus") == "O").agg((F.sum("o_totalprice") / 1000.0).alias("demand"))
    f = aggs.tier_funnel(s, "tier", "ord", "s_acctbal")
    f = f.crossJoin(F.broadcast(dem)).withColumn("demand_multiple", safe_ratio(F.col("demand"), F.col("running_value")))
    return f.select(
        "tier", "ord", F.col("tier_value").cast("decimal(38,2)"), F.col("running_value").cast("decimal(38,2)"),
        F.col("demand_multiple").cast("decimal(38,4)"),
    )


@register(
    "partner_balance",
    f"""WITH {SUPN},
inn AS (SELECT g.n_name, sum(l.l_extendedprice) AS in_rev FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1),
b AS (SELECT coalesce(s.n_name, i.n_name) AS n_name, coalesce(s.out_rev, 0) - coalesce(i.in_rev, 0) AS balance
      FROM supn s FULL OUTER JOIN inn i ON s.n_name = i.n_name)
SELECT n_name, {dec('balance')} AS balance,
       CAST(row_number() OVER (ORDER BY balance DESC, n_name) AS INTEGER) AS rank_surplus,
       CAST(row_number() OVER (ORDER BY balance ASC, n_name) AS INTEGER) AS rank_deficit
FROM b""",
    ids=("D30",),
)
def q_partner_balance(spark, d):
    t = Tables(spark, d)
    out = bind.out_rev_by_nation(t).select("n_name", "out_rev")
    inn = bind.in_rev_by_nation(t)
    # the per-nation table feeds the balance and both rankings: materialised once
    j = materialize(out.join(inn, "n_name", "full_outer"))
    b = aggs.balance(j.select("n_name", "out_rev"), j.select("n_name", "in_rev"), "n_name", "out_rev", "in_rev")
    return b.select(
        "n_name", F.col("balance").cast("decimal(38,2)"), F.col("rank_surplus").cast("int"), F.col("rank_deficit").cast("int")
    )


@register(
    "growth_multiple",
    f"""WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS v FROM orders GROUP BY 1),
b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1),
ga AS (SELECT (max(v) FILTER (WHERE yr = 2000) - max(v) FILTER (WHERE yr = 1996)) / max(v) FILTER (WHERE yr = 1996) * 100 AS g FROM a),
gb AS (SELECT (max(v) FILTER (WHERE yr = 2000) - max(v) FILTER (WHERE yr = 1996)) / max(v) FILTER (WHERE yr = 1996) * 100 AS g FROM b)
SELECT {dec('ga.g', 4)} AS growth_a_pct, {dec('gb.g', 4)} AS growth_b_pct, {dec('ga.g / nullif(gb.g, 0)', 4)} AS growth_multiple FROM ga, gb""",
    ids=("D31",),
)
def q_growth_multiple(spark, d):
    t = Tables(spark, d)
    a = t("orders").groupBy(F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("v"))
    b = t("lineitem").groupBy(F.year("l_shipdate").alias("yr")).agg(F.sum("l_extendedprice").alias("v"))

    def g(x, name):
        first = F.max(F.when(F.col("yr") == 1996, F.col("v")))
        last = F.max(F.when(F.col("yr") == 2000, F.col("v")))
        return x.agg((safe_ratio(last - first, first) * 100).alias(name))

    j = g(a, "growth_a_pct").crossJoin(g(b, "growth_b_pct"))
    j = j.withColumn("growth_multiple", aggs.growth_multiple(F.col("growth_a_pct"), F.col("growth_b_pct")))
    return j.select(*[F.col(c).cast("decimal(38,4)").alias(c) for c in ("growth_a_pct", "growth_b_pct", "growth_multiple")])


@register(
    "attrition_rate",
    f"""SELECT o_orderpriority, CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS n_withdrawn, CAST(count(*) AS BIGINT) AS n_all,
       {dec("count(*) FILTER (WHERE o_orderstatus = 'P') * 100.0 / count(*)", 4)} AS attrition_pct FROM orders GROUP BY 1""",
    ids=("D32",),
)
def q_attrition_rate(spark, d):
    out = aggs.attrition(Tables(spark, d)("orders"), "o_orderpriority", "o_orderstatus", "P")
    return out.withColumn("attrition_pct", F.col("attrition_pct").cast("decimal(38,4)"))


@register(
    "delivery_pct",
    f"""SELECT o_orderpriority, {dec("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F')")} AS delivered, {dec('sum(o_totalprice)')} AS committed,
       {dec("sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') / sum(o_totalprice) * 100", 4)} AS delivered_pct,
       CAST(GROUPING(o_orderpriority) AS BIGINT) AS gid
FROM orders GROUP BY ROLLUP (o_orderpriority)""",
    ids=("D33",),
)
def q_delivery_pct(spark, d):
    out = aggs.delivery_pct(Tables(spark, d)("orders"), "o_orderpriority", F.col("o_orderstatus") == "F", "o_totalprice")
    return out.select(
        "o_orderpriority", F.col("delivered").cast("decimal(38,2)"), F.col("committed").cast("decimal(38,2)"),
        F.col("delivered_pct").cast("decimal(38,4)"), F.col("gid").cast("long"),
    )


@register(
    "whole_from_share",
    f"""WITH {ORD_GEO},
s AS (SELECT n_name, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS part,
             sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') / sum(o_totalprice) * 100 AS share_pct, sum(o_totalprice) AS total
      FROM og GROUP BY 1)
SELECT n_name, {dec('part / (share_pct / 100.0)')} AS whole, {dec('total')} AS total FROM s""",
    ids=("D34",),
)
def q_whole_from_share(spark, d):
    og = bind.order_partials(Tables(spark, d), "o_orderstatus")
    s = og.groupBy("n_name").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("v"))).alias("part"), F.sum("v").alias("total")
    ).withColumn("share_pct", pct("part", "total"))
    return s.select(
        "n_name", aggs.whole_from_share(F.col("part"), F.col("share_pct")).cast("decimal(38,2)").alias("whole"),
        F.col("total").cast("decimal(38,2)"),
    )


@register(
    "cohort_two_dates",
    """WITH a AS (SELECT CAST(year(o.o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(a.yr, b.yr) AS yr, CAST(a.n AS BIGINT) AS n_by_order_date, CAST(b.n AS BIGINT) AS n_by_ship_date
FROM a FULL OUTER JOIN b ON a.yr = b.yr""",
    ids=("D35",),
)
def q_cohort_two_dates(spark, d):
    t = Tables(spark, d)
    li = t("lineitem")
    per_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = per_order.join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return aggs.cohort_counts(o, "o_orderdate", li, "l_shipdate", ("n_by_order_date", "n_by_ship_date"), weight_a="n")


@register(
    "share_in_group",
    f"""WITH {GEO},
nv AS (SELECT nullif(g.r_name, 'ASIA') AS r_name, g.n_name, sum(s.s_acctbal) AS v FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1, 2)
SELECT r_name, n_name, {dec('v')} AS v, {dec('v / nullif(sum(v) OVER (PARTITION BY r_name), 0) * 100', 4)} AS share_in_group_pct FROM nv""",
    ids=("D36",),
)
def q_share_in_group(spark, d):
    t = Tables(spark, d)
    nv = materialize(
        t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal").join(bind.geo(t), "n_nationkey")
        .groupBy(F.nullif("r_name", F.lit("ASIA")).alias("r_name"), "n_name").agg(F.sum("s_acctbal").alias("v"))  # a group without a name
    )
    out = aggs.share_in_group(nv, "r_name", "v")
    return out.select("r_name", "n_name", F.col("v").cast("decimal(38,2)"), F.col("share_in_group_pct").cast("decimal(38,4)"))
