"""Sources, register and quality gates (A, J2, K) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..session import materialize
from ..sources import bulletins, pages, register as reg, snapshots
from .registry import Tables, register
from .sqlbits import dec

# ---------------------------------------------------------------------------
# A1 / A2 / A3
# ---------------------------------------------------------------------------


@register(
    "scan_json_props",
    "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1",
    ids=("A1",),
)
def q_scan_json_props(spark, d):
    e = Tables(spark, d)("events")
    parsed = e.select(F.from_json("props", "k int").alias("p"))
    return parsed.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "bulletin_files",
    f"""SELECT event_type AS kind, CAST(count(*) AS BIGINT) AS n, {dec('sum(value)')} AS total, CAST(DATE '2026-12-01' + CAST(length(event_type) AS INTEGER) AS DATE) AS snapshot_date FROM events GROUP BY 1""",
    ids=("A1",),
)
def q_bulletin_files(spark, d):
    """A multi-line JSON file per kind and date is written and read back with an explicit schema; the date comes from its folder's stamp."""
    e = Tables(spark, d)("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(38,2)").alias("total"))
    text = F.concat(F.lit('{\n  "purpose": "totals",\n  "rows": '), F.to_json(F.struct(F.col("event_type").alias("kind"), "n", "total")), F.lit("\n}"))
    path = bulletins.scratch_path(spark, "bulletins")
    stamp = F.date_add(F.lit("2026-12-01").cast("date"), F.length("event_type")).cast("string")
    e.select(F.concat(F.col("event_type"), F.lit("_"), stamp).alias("bulletin"), text.alias("value")).write.partitionBy("bulletin").text(path)
    back = bulletins.read_bulletins(spark, path, "purpose string, rows struct<kind:string,n:long,total:decimal(38,2)>")
    return back.select("rows.kind", "rows.n", "rows.total", "snapshot_date")


@register(
    "listed_files",
    """WITH m AS (SELECT DISTINCT o_orderstatus AS s FROM orders)
SELECT s AS entry, s AS file, 'ok' AS status FROM m UNION ALL SELECT s, s || '-old', 'missing' FROM m UNION ALL SELECT 'none', NULL, 'no_data'""",
    ids=("A3", "C11"),
)
def q_listed_files(spark, d):
    """A manifest against the real listing of a written folder (file contents are not read)."""
    path = bulletins.scratch_path(spark, "listed")
    o = materialize(Tables(spark, d)("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))  # the listing needs a file a status, not the orders
    o.write.partitionBy("o_orderstatus").parquet(path)
    listing = bulletins.list_files(spark, f"{path}/*/*.parquet").select(F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("file"))
    s = o.select("o_orderstatus").distinct()
    manifest = s.select(F.col("o_orderstatus").alias("entry"), F.array("o_orderstatus", F.concat("o_orderstatus", F.lit("-old"))).alias("data"))
    manifest = manifest.unionByName(s.limit(1).select(F.lit("none").alias("entry"), F.array().cast("array<string>").alias("data")))
    return bulletins.manifest_status(manifest, "entry", "data", listing, "file").select("entry", "file", "status")


@register(
    "gated_publish",
    """SELECT 'documents' AS step, true AS published, CAST(count(*) AS BIGINT) AS n FROM documents
UNION ALL SELECT 'events', false, CAST(0 AS BIGINT)""",
    ids=("K4",),
)
def q_gated_publish(spark, d):
    """A publish step runs only if its checks pass: complete documents are written, events whose user
    should be unique are blocked."""
    t = Tables(spark, d)
    checks = {"documents": quality.check_required(t("documents"), ["doc_id", "text"]), "events": quality.check_unique(t("events"), ["user_id"]).select((F.col("n_dup_keys") == 0).alias("passed"))}
    steps = None
    for name, check in checks.items():
        path = bulletins.scratch_path(spark, f"publish-{name}")
        try:
            quality.gate(check)
            t(name).write.parquet(path)
            done = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("step"), F.lit(True).alias("published"), "n")
        except quality.GateFailed:
            done = t(name).limit(1).groupBy().agg(F.lit(0).cast("long").alias("n")).select(F.lit(name).alias("step"), F.lit(False).alias("published"), "n")
        steps = done if steps is None else steps.unionByName(done)
    return steps


@register(
    "snapshot_year_partitions",
    f"""SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, {dec('sum(o_totalprice)')} AS amount
FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1""",
    ids=("A2",),
)
def q_snapshot_year_partitions(spark, d):
    o = Tables(spark, d)("orders").withColumn("yr", F.year("o_orderdate"))
    base = bulletins.scratch_path(spark, "orders-snapshots")
    bulletins.write_snapshot(o, base, "2026-12-01", partition_cols=("yr",))
    snap = bulletins.read_snapshots(spark, base)
    # snapshot_date and yr are partition columns: both filters prune folders, no file is opened twice
    one = snap.where((F.col("snapshot_date") == F.lit("2026-12-01").cast("date")) & (F.col("yr") == 1997))
    return one.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("decimal(38,2)").alias("amount"))


@register(
    "manifest_status",
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS f FROM orders),
lf AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT CASE WHEN m.f IS NULL THEN 'no_data' WHEN lf.l_orderkey IS NOT NULL THEN 'ok' ELSE 'missing' END AS status, CAST(count(*) AS BIGINT) AS n
FROM m LEFT JOIN lf ON m.f = lf.l_orderkey GROUP BY 1""",
    ids=("A3", "C11"),
)
def q_manifest_status(spark, d):
    t = Tables(spark, d)
    o = t("orders")
    files = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.array().cast("array<string>")).otherwise(
        F.array(F.col("o_orderkey").cast("string"))
    )
    manifest = o.select("o_orderkey", files.alias("data"))
    listing = t("lineitem").select(F.col("l_orderkey").cast("string").alias("file"))
    st = bulletins.manifest_status(manifest, "o_orderkey", "data", listing, "file")
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# A5 / A6 / A7 listing and detail pages
# ---------------------------------------------------------------------------

LINK_RE = r'<a href="([^"]*)">([^<]*)</a>'


def _sql_entities(x: str) -> str:
    chain = x
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
        chain = f"replace({chain}, '{ent}', '{ch}')"
    return chain


def sql_clean(x: str) -> str:
    return f"trim(regexp_replace({_sql_entities(x)}, '\\s+', ' ', 'g'))"


def sql_unescape(x: str) -> str:
    return f"trim({_sql_entities(x)})"


@register(
    "page_links",
    f"""WITH x AS (SELECT page_id, regexp_extract_all(html, '{LINK_RE}', 1) AS tg, regexp_extract_all(html, '{LINK_RE}', 2) AS tx FROM pages)
SELECT page_id, CAST(unnest(generate_series(1, len(tg))) AS INTEGER) AS ordinal, unnest(tg) AS target, {sql_unescape('unnest(tx)')} AS text FROM x""",
    ids=("A5",),
)
def q_page_links(spark, d):
    p = Tables(spark, d)("pages").select("page_id", "html")
    links = pages.extract_listing(p, "html", LINK_RE, keep_preamble=True)
    return links.select("page_id", "ordinal", "target", "text")


URL_RE = r"^https?://([^/?#]+)/([a-z]{2})/([0-9]+)"


@register(
    "page_links_dated",
    f"""SELECT page_id, nullif(regexp_extract(url, '{URL_RE}', 1), '') AS host, nullif(regexp_extract(url, '{URL_RE}', 2), '') AS lang,
       TRY_CAST(nullif(regexp_extract(url, '{URL_RE}', 3), '') AS BIGINT) AS item_id,
       TRY_CAST(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER) AS page_no FROM pages""",
    ids=("A6",),
)
def q_page_links_dated(spark, d):
    p = Tables(spark, d)("pages")

    def part(pat, i):
        return F.nullif(F.regexp_extract("url", pat, i), F.lit(""))

    return p.select(
        "page_id", part(URL_RE, 1).alias("host"), part(URL_RE, 2).alias("lang"), part(URL_RE, 3).try_cast("long").alias("item_id"),
        part(r"[?&]page=([0-9]+)", 1).try_cast("int").alias("page_no"),
    )


# the layout of the dated listing that the query below writes
DATED_ITEM_RE = r'<article data-no="([0-9]+)">\s*<h4>([^<]*)</h4>\s*<time>([^<]*)</time>'


@register(
    "dated_listing",
    """SELECT o_orderkey AS page_id, CAST(1 AS INTEGER) AS ordinal, o_orderkey AS item_id, o_orderpriority || ' – ' || o_orderstatus || '’s' AS title,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date
FROM orders""",
    ids=("A6", "H9"),
)
def q_dated_listing(spark, d):
    o = Tables(spark, d)("orders")
    day = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("not yet")).otherwise(
        F.upper(F.date_format("o_orderdate", "d MMM yyyy"))
    )
    # one saved snippet per order
    html = F.format_string('<article data-no="%d"> <h4>%s &ndash; %s&#8217;s </h4><time>%s</time></article>', "o_orderkey", "o_orderpriority", "o_orderstatus", day)
    return pages.extract_dated_listing(o.select(F.col("o_orderkey").alias("page_id"), html.alias("html")), "html", DATED_ITEM_RE)


GROUP_LINK_RE = r"<a href='([^']*)'>([^<]*)</a>"


@register(
    "page_groups",
    """SELECT o_custkey AS page_id, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate)) AS INTEGER) AS section_no,
       'Year ' || year(o_orderdate) || ' – customer’s' AS header, CAST(row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS INTEGER) AS ordinal,
       '/o/' || o_orderkey AS target, o_orderpriority || ' é &amp; ' || o_orderstatus AS text FROM orders""",
    ids=("A5", "H4"),
)
def q_page_groups(spark, d):
    """A saved page per customer, a header per year, a link per order; headers and texts hold entities and no-break spaces."""
    o = Tables(spark, d)("orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_orderkey", "o_orderpriority", "o_orderstatus")
    link = F.format_string("<a href='/o/%d'>%s &eacute; &amp;amp; %s</a>", "o_orderkey", "o_orderpriority", "o_orderstatus")
    per_year = o.groupBy("o_custkey", "yr").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", link.alias("a")))).alias("links"))
    section = F.concat(F.format_string("<h3> Year&nbsp; %d &ndash;\u00a0customer&#8217;s</h3><p>", "yr"), F.array_join(F.col("links.a"), "<br>"))
    per_page = per_year.select("o_custkey", "yr", section.alias("s")).groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("yr", "s"))).alias("all"))
    saved = per_page.select(F.col("o_custkey").alias("page_id"), F.concat(F.lit("<html><a href='/top'>top</a>"), F.array_join(F.col("all.s"), "</p>")).alias("html"))
    return pages.extract_listing(saved, "html", GROUP_LINK_RE).select("page_id", "section_no", "header", "ordinal", "target", "text")


TITLE_RES = [r"<title>([^<]{5,})</title>", r"<h1[^>]*>([^<]{5,})</h1>"]


@register(
    "page_title_fallback",
    f"""SELECT page_id, coalesce({sql_clean("nullif(regexp_extract(html, '" + TITLE_RES[0] + "', 1), '')")},
                             {sql_clean("nullif(regexp_extract(html, '" + TITLE_RES[1] + "', 1), '')")}, url) AS title,
       CASE WHEN nullif(regexp_extract(html, '{TITLE_RES[0]}', 1), '') IS NOT NULL THEN 'title'
            WHEN nullif(regexp_extract(html, '{TITLE_RES[1]}', 1), '') IS NOT NULL THEN 'h1' ELSE 'url' END AS source
FROM pages""",
    ids=("A7",),
)
def q_page_title_fallback(spark, d):
    p = Tables(spark, d)("pages")
    f = pages.extract_fields(p, "html", {"t_title": [TITLE_RES[0]], "t_h1": [TITLE_RES[1]]})
    src = F.when(F.col("t_title").isNotNull(), F.lit("title")).when(F.col("t_h1").isNotNull(), F.lit("h1")).otherwise(F.lit("url"))
    return f.select("page_id", F.coalesce("t_title", "t_h1", "url").alias("title"), src.alias("source"))


# ---------------------------------------------------------------------------
# A8 / A9 / A11 / J2 register
# ---------------------------------------------------------------------------


@register(
    "register_point_range",
    """SELECT event_id, ts, user_id FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'""",
    ids=("A8", "B5"),
)
def q_register_point_range(spark, d):
    from ..operators.filters import register_query

    path = bulletins.scratch_path(spark, "register")
    e = Tables(spark, d)("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("ts").alias("date"), "user_id")
    reg.write_register(e, path)
    stored = reg.read_register(spark, path).where((F.col("kind") == "click") & (F.col("year") == 2024))  # partition columns: other folders are not read
    lo, hi = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")
    return register_query(stored, date_col="date", date_from=lo, date_to=hi).select(F.col("id").alias("event_id"), F.col("date").alias("ts"), "user_id")


@register(
    "register_entity_range",
    """SELECT event_id, ts, event_type, user_id FROM events WHERE user_id = (SELECT min(user_id) FROM events) AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-03-01'""",
    ids=("A8", "B5"),
)
def q_register_entity_range(spark, d):
    """One entity's rows in a date range, from the stored bucketed register."""
    import uuid

    e = Tables(spark, d)("events").select("event_id", "ts", "event_type", "user_id")
    table = f"register_{uuid.uuid4().hex}"
    reg.save_register(e, table, bulletins.scratch_path(spark, "register"), "user_id", "ts", buckets=8)
    who = e.agg(F.min("user_id")).first()[0]
    return reg.entity_range(spark, table, "user_id", who, "ts", "2024-01-05", "2024-03-01").drop("year")


@register(
    "harvest_files",
    """SELECT DISTINCT lang, unnest(regexp_extract_all(text, '([0-9]{4,})', 1)) AS id FROM documents""",
    ids=("A4", "H5"),
)
def q_harvest_files(spark, d):
    """Ids in whole corpus files: the texts are written as files by language, which are read whole."""
    path = bulletins.scratch_path(spark, "corpus")
    Tables(spark, d)("documents").where("text IS NOT NULL").select("lang", "text").write.option("maxRecordsPerFile", 1000).partitionBy("lang").text(path)
    files = reg.read_corpus(spark, path)
    return reg.harvest_citations(files.withColumn("lang", F.regexp_extract("path", "/lang=([^/]+)/", 1)), "text", r"([0-9]{4,})", id_col="id", doc_col="lang").select("lang", "id")


@register(
    "last_indexed",
    "SELECT event_type, max(ts) AS last_indexed FROM events GROUP BY 1",
    ids=("A9",),
)
def q_last_indexed(spark, d):
    return reg.watermark(Tables(spark, d)("events"), "event_type", "ts")


@register(
    "merge_backfills",
    "SELECT event_id, event_type, ts, user_id, value FROM events",
    ids=("A11", "E1"),
)
def q_merge_backfills(spark, d):
    e = Tables(spark, d)("events").select("event_id", "event_type", "ts", "user_id", "value")
    day = F.dayofmonth("ts")
    first, second = e.where(day <= 16), e.where(day >= 14)  # the two backfills overlap on three days
    return reg.merge_registers([first, second], ["event_id"], ["ts"]).select("event_id", "event_type", "ts", "user_id", "value")


ADHOC = "SELECT event_type AS kind, count(*) AS n, max(ts) AS last_ts FROM {register} WHERE value > :least GROUP BY event_type"


@register(
    "adhoc_sql",
    "SELECT event_type AS kind, CAST(count(*) AS BIGINT) AS n, max(ts) AS last_ts FROM events WHERE value > 50 GROUP BY event_type",
    ids=("J2", "J3"),
)
def q_adhoc_sql(spark, d):
    return reg.adhoc_sql(spark, ADHOC, {"least": 50}, register=Tables(spark, d)("events"))


# ---------------------------------------------------------------------------
# K1 / K2 / K3 / K5 / K6 / K7
# ---------------------------------------------------------------------------


@register(
    "dq_required",
    """SELECT 'required' AS "check", k AS key, CAST(0 AS BIGINT) AS expected, CAST(n AS BIGINT) AS found, n = 0 AS passed FROM (
  SELECT 'doc_id' AS k, count(*) FILTER (WHERE doc_id IS NULL) AS n FROM documents UNION ALL
  SELECT 'text', count(*) FILTER (WHERE text IS NULL) FROM documents UNION ALL
  SELECT 'lang', count(*) FILTER (WHERE lang IS NULL) FROM documents UNION ALL
  SELECT 'source', count(*) FILTER (WHERE source IS NULL) FROM documents)""",
    ids=("K1",),
)
def q_dq_required(spark, d):
    return quality.check_required(Tables(spark, d)("documents"), ["doc_id", "text", "lang", "source"])


@register(
    "dq_monotone",
    """WITH c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT day, n AS cum FROM c)
SELECT 'monotone' AS "check", CAST(day AS VARCHAR) AS key, CAST(lag(cum) OVER (ORDER BY day) AS BIGINT) AS expected, CAST(cum AS BIGINT) AS found,
       coalesce(cum >= lag(cum) OVER (ORDER BY day), true) AS passed FROM s""",
    ids=("K2",),
)
def q_dq_monotone(spark, d):
    e = Tables(spark, d)("events")
    # a snapshot per day that holds that day's events only: some shrink and must fail
    snaps = e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("cum"))
    return quality.check_monotone(snaps, "day", "cum")


@register(
    "dq_known_ids",
    """SELECT 'known_ids' AS "check", 'doc_id' AS key, CAST(0 AS BIGINT) AS expected, CAST(count(*) AS BIGINT) AS found, count(*) = 0 AS passed
FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))""",
    ids=("K3",),
)
def q_dq_known_ids(spark, d):
    t = Tables(spark, d)
    return quality.check_known_ids(t("labels"), t("documents"), "doc_id")


@register(
    "dq_measure_separation",
    f"""WITH f AS (SELECT 'inflow' AS measure, l_extendedprice AS value FROM lineitem UNION ALL SELECT 'filed', o_totalprice FROM orders)
SELECT measure, {dec('sum(value)')} AS total FROM f GROUP BY 1""",
    ids=("K5",),
)
def q_dq_measure_separation(spark, d):
    t = Tables(spark, d)
    facts = t("lineitem").select(F.lit("inflow").alias("measure"), F.col("l_extendedprice").alias("value")).unionByName(
        t("orders").select(F.lit("filed").alias("measure"), F.col("o_totalprice").alias("value"))
    )
    out = quality.sum_by_measure(facts, ["measure"], "value")
    return out.select("measure", F.col("total").cast("decimal(38,2)"))


@register(
    "freshness",
    """WITH l AS (SELECT event_type, max(ts) AS last_ts, max(CAST(ts AS DATE)) AS newest_day FROM events GROUP BY 1)
SELECT l.event_type, l.last_ts, l.newest_day, CAST(count(e.event_id) AS BIGINT) AS n_newest
FROM l LEFT JOIN events e ON e.event_type = l.event_type AND CAST(e.ts AS DATE) = l.newest_day GROUP BY 1, 2, 3""",
    ids=("K6",),
)
def q_freshness(spark, d):
    return quality.freshness(Tables(spark, d)("events"), "event_type", "ts").select("event_type", "last_ts", "newest_day", "n_newest")


@register(
    "dq_duplicates",
    """SELECT CAST(count(*) AS BIGINT) AS n_dup_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_dup_rows
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
    ids=("K7",),
)
def q_dq_duplicates(spark, d):
    return quality.check_unique(Tables(spark, d)("lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "status_crosstab",
    """SELECT g.r_name, o.o_orderpriority, o.o_orderstatus, CAST(count(*) AS BIGINT) AS n
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g ON c.c_nationkey = g.n_nationkey
GROUP BY 1, 2, 3""",
    ids=("A10", "D6"),
)
def q_status_crosstab(spark, d):
    from ..sources.sinks import write_crosstab
    from . import bind

    # per (customer, priority, status) counts first, then the zone cross-tab, exported as CSV
    og = bind.order_partials(Tables(spark, d), "o_orderpriority", "o_orderstatus")
    xt = og.groupBy("r_name", "o_orderpriority", "o_orderstatus").agg(F.sum("n").alias("n_orders"))
    path = bulletins.scratch_path(spark, "crosstab")
    write_crosstab(xt.withColumnRenamed("n_orders", "w"), ["r_name", "o_orderpriority", "o_orderstatus"], path, value="w")
    back = spark.read.schema("r_name string, o_orderpriority string, o_orderstatus string, n long, sum_w long").option(
        "header", True
    ).csv(path)
    return back.select("r_name", "o_orderpriority", "o_orderstatus", F.col("sum_w").alias("n"))


@register(
    "dq_null_zero",
    """WITH j AS (SELECT l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'quality' AS field, CAST(count(*) FILTER (WHERE quality IS NULL) AS BIGINT) AS n_null,
       CAST(count(*) FILTER (WHERE quality = 0) AS BIGINT) AS n_zero, CAST(count(*) FILTER (WHERE quality <> 0) AS BIGINT) AS n_present FROM j
UNION ALL
SELECT 'toxic', CAST(count(*) FILTER (WHERE toxic IS NULL) AS BIGINT), CAST(count(*) FILTER (WHERE toxic = 0) AS BIGINT),
       CAST(count(*) FILTER (WHERE toxic <> 0) AS BIGINT) FROM j""",
    ids=("K8",),
)
def q_dq_null_zero(spark, d):
    from ..operators import aggs

    t = Tables(spark, d)
    j = t("documents").select("doc_id").join(t("labels"), "doc_id", "left")
    return aggs.completeness(j, None, ["quality", "toxic"])


# ---------------------------------------------------------------------------
# A2 / C9 / K2 / K3 / K6 over stored snapshots
# ---------------------------------------------------------------------------

# three stored dates: granted in the second, refiled and partly withdrawn in the third
SQL_STORED = """s1 AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
s2 AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F' ELSE o_orderstatus END AS o_orderstatus
       FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-01'),
s3 AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F'
                               WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'P' ELSE o_orderstatus END AS o_orderstatus
       FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'))"""


def _sql_diff(old: str, new: str, date: str) -> str:
    return f"""SELECT DATE '{date}' AS snapshot_date, coalesce(p.o_orderkey, c.o_orderkey) AS o_orderkey,
       CASE WHEN p.o_orderkey IS NULL THEN 'added' WHEN c.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
       p.o_orderstatus AS old_o_orderstatus, c.o_orderstatus AS new_o_orderstatus
FROM {old} p FULL OUTER JOIN {new} c ON p.o_orderkey = c.o_orderkey WHERE p.o_orderstatus IS DISTINCT FROM c.o_orderstatus"""


SQL_NONE = "(SELECT * FROM s1 WHERE false)"


def _stored_orders(spark, d) -> str:
    """A store of the orders at three dates."""
    from . import bind

    o = Tables(spark, d)("orders")
    path = bulletins.scratch_path(spark, "orders-store")
    before = lambda day: F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz")
    granted = F.when((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("F")).otherwise(F.col("o_orderstatus"))
    withdrawn = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
    bulletins.write_snapshot(o.where(before("1998-01-01")).select("o_orderkey", "o_orderstatus"), path, "2026-03-31")
    bulletins.write_snapshot(o.where(before("2000-06-01")).select("o_orderkey", granted.alias("o_orderstatus")), path, "2026-06-30")
    bulletins.write_snapshot(o.where(~withdrawn).select("o_orderkey", bind.after_status().alias("o_orderstatus")), path, "2026-09-30")
    return path


@register(
    "stored_snapshot_diff",
    f"WITH {SQL_STORED} SELECT o_orderkey, change, old_o_orderstatus, new_o_orderstatus FROM ({_sql_diff('s1', 's3', '2026-09-30')})",
    ids=("A2", "C9"),
)
def q_stored_snapshot_diff(spark, d):
    """What changed between two dates on which nothing was stored: the snapshots that hold there are compared."""
    out = snapshots.diff_between(spark, _stored_orders(spark, d), "2026-05-15", "2026-12-01", "o_orderkey", ["o_orderstatus"])
    return out.select("o_orderkey", "change", "old_o_orderstatus", "new_o_orderstatus")


@register(
    "snapshot_change_feed",
    f"""WITH {SQL_STORED} {_sql_diff(SQL_NONE, 's1', '2026-03-31')}
UNION ALL {_sql_diff('s1', 's2', '2026-06-30')} UNION ALL {_sql_diff('s2', 's3', '2026-09-30')}""",
    ids=("C9",),
)
def q_snapshot_change_feed(spark, d):
    return snapshots.change_feed(spark, _stored_orders(spark, d), "o_orderkey", ["o_orderstatus"])


@register(
    "dq_stored_snapshots",
    f"""WITH {SQL_STORED}, c AS (SELECT '2026-03-31' AS day, count(*) AS n FROM s1 UNION ALL SELECT '2026-06-30', count(*) FROM s2 UNION ALL SELECT '2026-09-30', count(*) FROM s3)
SELECT 'monotone' AS "check", day AS key, CAST(lag(n) OVER (ORDER BY day) AS BIGINT) AS expected, CAST(n AS BIGINT) AS found, coalesce(n >= lag(n) OVER (ORDER BY day), true) AS passed FROM c
UNION ALL SELECT 'known_ids', 'o_orderkey', 0, CAST(count(*) AS BIGINT), count(*) = 0 FROM s1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s3)""",
    ids=("K2", "K3"),
)
def q_dq_stored_snapshots(spark, d):
    """The gates of a refresh on what is stored: counts never shrink, ids of the first date resolve in the last."""
    path = _stored_orders(spark, d)
    ids = snapshots.check_stored_ids(spark, path, "2026-03-31", "2026-09-30", "o_orderkey")
    return snapshots.check_stored_monotone(spark, path).unionByName(ids)


@register(
    "gate_refresh",
    f"""WITH {SQL_STORED}, x AS ({_sql_diff('s2', 's3', '2026-09-30')}),
p AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0)
SELECT 'orders' AS gate, DATE '2026-09-30' AS last_snapshot, DATE '2026-06-30' AS previous_snapshot, (SELECT count(*) FROM s3) AS n_rows,
       count(*) FILTER (change = 'added') AS n_added, count(*) FILTER (change = 'changed') AS n_changed, count(*) FILTER (change = 'removed') AS n_removed FROM x
UNION ALL SELECT 'customers', DATE '2026-07-31', DATE '2026-04-30', count(*), count(*) FILTER (c_custkey NOT IN (SELECT c_custkey FROM p)), 0, 0 FROM customer
UNION ALL SELECT 'parts', DATE '2026-07-31', NULL, count(*), count(*), 0, 0 FROM part""",
    ids=("K6",),
)
def q_gate_refresh(spark, d):
    """Per gate the last stored date and the size of its delta; a gate with one snapshot has only additions."""
    t = Tables(spark, d)
    customers, parts = bulletins.scratch_path(spark, "customers-store"), bulletins.scratch_path(spark, "parts-store")
    c = t("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    bulletins.write_snapshot(c.where("c_acctbal >= 0"), customers, "2026-04-30")
    bulletins.write_snapshot(c, customers, "2026-07-31")
    bulletins.write_snapshot(t("part").select("p_partkey", "p_type"), parts, "2026-07-31")
    return snapshots.refresh_status(spark, {
        "orders": (_stored_orders(spark, d), "o_orderkey", ["o_orderstatus"]), "customers": (customers, "c_custkey", ["c_mktsegment"]), "parts": (parts, "p_partkey", ["p_type"])})
