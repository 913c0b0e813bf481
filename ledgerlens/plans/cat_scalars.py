"""Scalar functions (H) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels, scalars
from ..operators import aggs, filters
from ..session import materialize
from . import bind
from .registry import Tables, register
from .sqlbits import GEO, dec


def sql_humanize(x: str) -> str:
    """DuckDB text of functions.labels.humanize with the default acronym table."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.DEFAULT_ACRONYMS.items())
    return (
        f"array_to_string(list_transform(string_split(replace({x}, '-', '_'), '_'), lambda w: CASE lower(w) {whens} "
        f"ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ')"
    )


@register(
    "humanize_label",
    "SELECT " + sql_humanize("lang || '_' || source || '_usd_mn'") + " AS label, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1",
    ids=("H1",),
)
def q_humanize_label(spark, d):
    docs = Tables(spark, d)("documents")
    lab = labels.humanize(F.concat_ws("_", "lang", "source", F.lit("usd_mn")))
    return docs.groupBy(lab.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "stem_title",
    f"""SELECT {sql_humanize("regexp_replace(replace(event_type || '_fdi-snapshot_' || strftime(ts, '%Y-%m-%d'), '-', '_'), '_[0-9]{4}_[0-9]{2}_[0-9]{2}$', '')")} AS title,
       CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""",
    ids=("H2",),
)
def q_stem_title(spark, d):
    e = Tables(spark, d)("events")
    stem = F.concat(F.col("event_type"), F.lit("_fdi-snapshot_"), F.date_format("ts", "yyyy-MM-dd"))
    return e.groupBy(labels.title_from_stem(stem).alias("title")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "to_cell",
    """SELECT doc_id, CASE WHEN length(coalesce(text, '')) > 80 THEN regexp_replace(substr(text, 1, 79), '\\s+$', '') || '…'
                       ELSE coalesce(text, '') END AS cell FROM documents""",
    ids=("H3",),
)
def q_to_cell(spark, d):
    docs = Tables(spark, d)("documents")
    return docs.select("doc_id", scalars.to_cell("text", 80).alias("cell"))


def _cut_sql(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN regexp_replace(substr({x}, 1, {n - 1}), '\\s+$', '') || '…' ELSE {x} END"


@register(
    "nested_cells",
    f"""WITH c AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_cut_sql('x', 80)}), '; ') AS lines,
    'Doc Id: ' || doc_id || '; Source: ' || coalesce(source, '') || '; HS Text: ' || {_cut_sql("replace(coalesce(text, ''), chr(10), ' ')", 60)} AS fields FROM documents)
SELECT doc_id, {_cut_sql("coalesce(lines, '')", 280)} AS lines_cell, {_cut_sql("fields", 280)} AS fields_cell FROM c""",
    ids=("H3",),
)
def q_nested_cells(spark, d):
    """Arrays and objects flattened to one cell: a document's lines, and its fields under humanized keys."""
    docs = Tables(spark, d)("documents")
    fields = F.create_map(F.lit("doc_id"), F.col("doc_id").cast("string"), F.lit("source"), F.col("source"), F.lit("hs_text"), F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    return docs.select("doc_id", scalars.array_to_cell(F.split("text", "\n", -1)).alias("lines_cell"), scalars.map_to_cell(fields).alias("fields_cell"))


@register(
    "clean_html",
    """SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
         regexp_extract(html, '<title>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''),
         '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g')) AS title FROM pages""",
    ids=("H4",),
)
def q_clean_html(spark, d):
    p = Tables(spark, d)("pages")
    raw = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    return p.select("page_id", scalars.clean_html(raw).alias("title"))


@register(
    "canon_label_table",
    """WITH a AS (SELECT lower(r_name) AS spelling, 'Zone ' || r_regionkey AS label FROM region)
SELECT coalesce(a.label, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2))) AS place, CAST(count(*) AS BIGINT) AS n
FROM (SELECT n_name, n_nationkey FROM nation UNION ALL SELECT r.r_name, c.c_nationkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey) x
LEFT JOIN a ON lower(x.n_name) = a.spelling GROUP BY 1""",
    ids=("B1",),
)
def q_canon_label_table(spark, d):
    """Labels by an alias table that is data: nation and zone names, the zones' aliases made from ``region``."""
    t = Tables(spark, d)
    aliases = t("region").select(F.concat(F.lit("  "), F.upper("r_name"), F.lit(" .")).alias("spelling"), F.concat(F.lit("Zone "), F.col("r_regionkey")).alias("label"))
    per = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    zones = per.join(t("nation").select("n_nationkey", "n_regionkey"), "n_nationkey").join(t("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    rows = t("nation").select(F.col("n_name").alias("name"), F.lit(1).cast("long").alias("n")).unionByName(zones.select(F.col("r_name").alias("name"), "n"))
    return labels.canon_label_by_table(rows, "name", aliases, "place").groupBy("place").agg(F.sum("n").alias("n"))


@register(
    "harvest_ids",
    """SELECT id, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '([0-9]{4,})', 1)) AS id FROM documents) GROUP BY 1""",
    ids=("H5", "A4"),
)
def q_harvest_ids(spark, d):
    from ..sources.register import harvest_citations

    docs = Tables(spark, d)("documents").select("doc_id", "text")
    cites = harvest_citations(docs, "text", r"([0-9]{4,})", id_col="id", doc_col="doc_id")
    return cites.groupBy("id").agg(F.count_distinct("doc_id").alias("n_docs"))


@register(
    "parse_amount",
    f"""SELECT o_orderkey,
       {dec("CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice * 100000 ELSE o_totalprice END")} AS value,
       CASE o_orderstatus WHEN 'F' THEN 'INR_cr' WHEN 'O' THEN 'USD_mn' ELSE 'pct' END AS unit FROM orders""",
    ids=("H6",),
)
def q_parse_amount(spark, d):
    o = Tables(spark, d)("orders")
    p2 = F.format_string("%.2f", F.col("o_totalprice"))
    text = (
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), F.concat(F.lit("₹"), p2, F.lit(" lakh cr")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("Rs "), F.format_number("o_totalprice", 2), F.lit("cr")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("$"), p2, F.lit("mn")))
        .otherwise(F.concat(F.lit("+"), p2, F.lit("%")))
    )
    parsed = scalars.parse_amount(text)
    return o.select("o_orderkey", parsed["value"].cast("decimal(38,2)").alias("value"), parsed["unit"].alias("unit"))


@register(
    "parse_amount_spellings",
    f"""WITH x AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2)) AS p, o_orderkey % 8 AS k FROM orders)
SELECT o_orderkey, {dec("CASE k WHEN 0 THEN p * 100000 WHEN 1 THEN -p * 1000 WHEN 2 THEN -p * 1000000 WHEN 3 THEN p * 0.01 WHEN 4 THEN p WHEN 7 THEN p END", 4)} AS value,
       CASE WHEN k IN (0, 3, 7) THEN 'INR_cr' WHEN k IN (1, 2, 4) THEN 'USD_mn' END AS unit FROM x""",
    ids=("H6",),
)
def q_parse_amount_spellings(spark, d):
    """Capitals, both minus signs before and after the currency, no currency, unknown suffixes, other words."""
    o = Tables(spark, d)("orders")
    forms = ["₹%s Lakh Crore", "−$%sbn", " $-%s Trillion ", "INR %s LAKH", "usd %s million", "%s zorkmid", "about Rs %s crore", "%s\u00a0Crore."]
    form = F.element_at(F.array(*(F.lit(x) for x in forms)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    parsed = scalars.parse_amount(F.replace(form, F.lit("%s"), F.format_string("%.2f", F.col("o_totalprice"))))
    return o.select("o_orderkey", parsed["value"].cast("decimal(38,4)").alias("value"), parsed["unit"].alias("unit"))


# Fixed values of the test binding: the unit each zone reports its land stock in.
ZONE_UNITS = {"AFRICA": "ha", "AMERICA": "sq_km", "ASIA": "acre", "EUROPE": "sq_m", "MIDDLE EAST": "ha"}


@register(
    "unit_convert",
    f"""WITH {GEO}
SELECT g.r_name, {dec("sum(s.s_acctbal * CASE g.r_name WHEN 'AFRICA' THEN 2.47105 WHEN 'AMERICA' THEN 247.105 WHEN 'ASIA' THEN 1.0 WHEN 'EUROPE' THEN 0.000247105 WHEN 'MIDDLE EAST' THEN 2.47105 END)", 4)} AS acres
FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1""",
    ids=("H7",),
)
def q_unit_convert(spark, d):
    t = Tables(spark, d)
    s = t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_acctbal").join(bind.geo(t), "n_nationkey")
    s = s.withColumn("unit", F.try_element_at(labels.literal_map(ZONE_UNITS), F.col("r_name")))
    return s.groupBy("r_name").agg(F.sum(scalars.to_unit("s_acctbal", "unit", "acre")).cast("decimal(38,4)").alias("acres"))


@register(
    "fiscal_rollup",
    f"""SELECT printf('FY%d-%02d', year(o_orderdate - INTERVAL 3 MONTH), (year(o_orderdate - INTERVAL 3 MONTH) + 1) % 100) AS fy,
       CAST(quarter(o_orderdate - INTERVAL 3 MONTH) AS INTEGER) AS fq, CAST(count(*) AS BIGINT) AS n, {dec('sum(o_totalprice)')} AS amount
FROM orders GROUP BY 1, 2""",
    ids=("H8",),
)
def q_fiscal_rollup(spark, d):
    o = Tables(spark, d)("orders")
    return o.groupBy(scalars.fiscal_label("o_orderdate").alias("fy"), scalars.fiscal_quarter("o_orderdate").alias("fq")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("decimal(38,2)").alias("amount")
    )


@register(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed
FROM orders""",
    ids=("H9",),
)
def q_parse_dates(spark, d):
    o = Tables(spark, d)("orders")
    dt = F.col("o_orderdate")
    text = (
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"),
               F.concat(F.dayofmonth(dt).cast("string"), F.lit(" XYZ "), F.year(dt).cast("string")))
        .when(F.col("o_orderstatus") == "P", F.upper(F.date_format(dt, "d MMM yyyy")))
        .when(F.col("o_orderstatus") == "O", F.date_format(dt, "dd/MM/yyyy"))
        .otherwise(F.date_format(dt, "yyyy-MM-dd"))
    )
    return o.select("o_orderkey", scalars.parse_date(text).alias("parsed"))


@register(
    "log_clip",
    f"SELECT o_orderkey, {dec('least(greatest(log10(o_totalprice), 3.5), 5.5)', 6)} AS v FROM orders",
    ids=("H11",),
)
def q_log_clip(spark, d):
    o = Tables(spark, d)("orders")
    return o.select("o_orderkey", scalars.log_clip("o_totalprice", 3.5, 5.5).cast("decimal(38,6)").alias("v"))


@register(
    "band_conversion",
    """WITH c AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(*) AS conv FROM orders GROUP BY 1)
SELECT CASE WHEN conv >= 80 THEN 'high' WHEN conv >= 40 THEN 'mid' ELSE 'low' END AS band, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY 1""",
    ids=("H12",),
)
def q_band_conversion(spark, d):
    o = Tables(spark, d)("orders")
    c = o.groupBy("o_custkey").agg((F.count_if(F.col("o_orderstatus") == "F") * 100.0 / F.count(F.lit(1))).alias("conv"))
    b = scalars.band(F.col("conv"), [(80, "high"), (40, "mid")], "low")
    return c.groupBy(b.alias("band")).agg(F.count(F.lit(1)).alias("n"))


# Fixed values of the test binding: verdict rules in priority order and human overrides.
VERDICT_RULES = [(1, "p_retailprice", ">=", "1900", "A"), (2, "p_size", ">=", "40", "B"), (3, "p_type", "=", "PROMO", "C")]
VERDICT_OVERRIDES = [("Brand#25", "X"), ("Brand#7", "B-")]


@register(
    "rule_verdict",
    """WITH ov AS (SELECT * FROM (VALUES ('Brand#25', 'X'), ('Brand#7', 'B-')) AS v(p_brand, override)),
rules AS (SELECT * FROM (VALUES (1, 'p_retailprice', 1900, NULL, 'A'), (2, 'p_size', 40, NULL, 'B'), (3, 'p_type', NULL, 'PROMO', 'C')) AS r(priority, field, least, text, label)),
hits AS (SELECT p.p_partkey, min_by(r.label, r.priority) AS label FROM part p JOIN rules r
    ON (r.field = 'p_retailprice' AND p.p_retailprice >= r.least) OR (r.field = 'p_size' AND p.p_size >= r.least) OR (r.field = 'p_type' AND p.p_type = r.text) GROUP BY 1)
SELECT coalesce(ov.override, h.label, 'D') AS verdict, CAST(count(*) AS BIGINT) AS n
FROM part p LEFT JOIN ov ON p.p_brand = ov.p_brand LEFT JOIN hits h ON h.p_partkey = p.p_partkey GROUP BY 1""",
    ids=("H13",),
)
def q_rule_verdict(spark, d):
    p = Tables(spark, d)("part")
    ov = F.broadcast(spark.createDataFrame(VERDICT_OVERRIDES, "p_brand string, override string"))
    j = p.join(ov, "p_brand", "left")
    v = filters.rule_label(j, spark.createDataFrame(VERDICT_RULES, filters.RULES_SCHEMA), default="D", override="override")
    return j.groupBy(v.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "status_class",
    """SELECT CASE WHEN regexp_matches(lower(o_orderpriority), 'urgent|high') THEN 'priority'
            WHEN regexp_matches(lower(o_orderpriority), 'low') THEN 'deferred' ELSE 'normal' END AS cls,
       CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1""",
    ids=("H14",),
)
def q_status_class(spark, d):
    o = Tables(spark, d)("orders")
    cls = scalars.status_class("o_orderpriority", [("urgent|high", "priority"), ("low", "deferred")], "normal")
    return o.groupBy(cls.alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "cite_url",
    "SELECT event_id, printf('https://register.example/%s/%d', event_type, event_id) AS url FROM events",
    ids=("H15",),
)
def q_cite_url(spark, d):
    e = Tables(spark, d)("events")
    return e.select("event_id", scalars.cite_url("https://register.example/%s/%d", "event_type", "event_id").alias("url"))


@register(
    "melt_years",
    f"""WITH {GEO}
SELECT g.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS yr, {dec('sum(o.o_totalprice)')} AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1, 2""",
    ids=("H16",),
)
def q_melt_years(spark, d):
    ny = bind.rev_by_nation_year(Tables(spark, d))
    # wide: one column per year (the year list is the small distinct set pivot computes)
    wide = ny.groupBy("n_name").pivot("yr").agg(F.sum("revenue"))
    years = [c for c in wide.columns if c != "n_name"]
    as_map = wide.select("n_name", F.create_map(*[x for y in years for x in (F.lit(int(y)), F.col(f"`{y}`"))]).alias("m"))
    long_form = scalars.melt_map(as_map, "m", "yr", "value").where(F.col("value").isNotNull())
    return long_form.select("n_name", F.col("yr").cast("int"), F.col("value").cast("decimal(38,2)"))


@register(
    "melt_map",
    """SELECT key, CAST(count(*) AS BIGINT) AS n, """ + dec("sum(CAST(json_extract(props, '$.' || key) AS DOUBLE))") + """ AS total
FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY 1""",
    ids=("H16",),
)
def q_melt_map(spark, d):
    e = Tables(spark, d)("events").select(F.from_json("props", "map<string,double>").alias("m"))
    long_form = scalars.melt_map(e, "m", "key", "value")
    return long_form.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(38,2)").alias("total"))


@register(
    "spread_to_base",
    f"""WITH {GEO},
r AS (SELECT g.n_name, avg(l.l_discount) AS rate FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY 1)
SELECT n_name, {dec('rate', 6)} AS rate, {dec("rate - (SELECT rate FROM r WHERE n_name = 'NATION_1')", 6)} AS spread FROM r""",
    ids=("H17",),
)
def q_spread_to_base(spark, d):
    t = Tables(spark, d)
    li = t("lineitem").groupBy("l_suppkey").agg(F.sum("l_discount").alias("s"), F.count("l_discount").alias("c"))
    sup = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    r = li.join(sup, "l_suppkey").groupBy("n_nationkey").agg(scalars.safe_ratio(F.sum("s"), F.sum("c")).alias("rate"))
    r = materialize(r.join(bind.geo(t), "n_nationkey").select("n_name", "rate"))
    out = aggs.spread(r, "n_name", "rate", "NATION_1")
    return out.select("n_name", F.col("rate").cast("decimal(38,6)"), F.col("spread").cast("decimal(38,6)"))


@register(
    "slug",
    """SELECT regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, CAST(count(*) AS BIGINT) AS n
FROM part GROUP BY 1""",
    ids=("H18",),
)
def q_slug(spark, d):
    p = Tables(spark, d)("part")
    return p.groupBy(labels.slug("p_name").alias("slug")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "json_shape",
    """WITH t AS (
  SELECT unnest([props, '[' || props || ']', '[' || CAST(value AS VARCHAR) || ', 1]', CAST(value AS VARCHAR), '[]',
                 '[' || CAST(value AS VARCHAR) || ', "' || event_type || '", null]', '[1, ' || props || ']', 'null', '{' || event_type]) AS j
  FROM events)
SELECT CASE WHEN j IS NULL OR NOT json_valid(j) OR json_type(j) = 'NULL' THEN 'null'
            WHEN json_type(j) = 'OBJECT' THEN 'object'
            WHEN json_type(j) = 'ARRAY' THEN CASE
                 WHEN json_array_length(j) = 0 THEN 'list'
                 WHEN list_bool_and(list_transform(json_extract(j, '$[*]'), lambda x: json_type(x) = 'OBJECT')) THEN 'object_list'
                 WHEN NOT list_bool_or(list_transform(json_extract(j, '$[*]'), lambda x: json_type(x) IN ('OBJECT', 'ARRAY'))) THEN 'scalar_list'
                 ELSE 'list' END
            ELSE 'scalar' END AS shape,
       CAST(count(*) AS BIGINT) AS n
FROM t GROUP BY 1""",
    ids=("H19",),
)
def q_json_shape(spark, d):
    e = Tables(spark, d)("events")
    v = F.col("value").cast("string")
    texts = e.select(
        F.explode(
            F.array(
                F.col("props"),
                F.concat(F.lit("["), F.col("props"), F.lit("]")),
                F.concat(F.lit("["), v, F.lit(", 1]")),
                v,
                F.lit("[]"),
                F.concat(F.lit("["), v, F.lit(', "'), F.col("event_type"), F.lit('", null]')),
                F.concat(F.lit("[1, "), F.col("props"), F.lit("]")),
                F.lit("null"),
                F.concat(F.lit("{"), F.col("event_type")),
            )
        ).alias("j")
    )
    return texts.groupBy(scalars.json_shape("j").alias("shape")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "coalesce_keys",
    "SELECT event_id, coalesce(json_extract_string(props, '$.loop'), json_extract_string(props, '$.k')) AS v FROM events",
    ids=("H20",),
)
def q_coalesce_keys(spark, d):
    e = Tables(spark, d)("events")
    return e.select("event_id", scalars.coalesce_keys("props", ["$.loop", "$.k"]).alias("v"))


@register(
    "rounded_halves",
    "SELECT o_orderkey, round_even(o_orderkey / 8.0::DOUBLE, 2) AS r2, round_even(o_orderkey / 8.0::DOUBLE, 0) AS r0, round_even(-o_orderkey / 8.0::DOUBLE, 1) AS neg FROM orders",
    ids=("H10",),
)
def q_rounded_halves(spark, d):
    """Half-even rounding; eighths are exact binary fractions, so their halves are real ties."""
    x = F.col("o_orderkey") / F.lit(8.0)
    return Tables(spark, d)("orders").select("o_orderkey", scalars.rnd(x, 2).alias("r2"), scalars.rnd(x, 0).alias("r0"), scalars.rnd(-x, 1).alias("neg"))
