"""Streaming (I1-I4) and the JSON walk (J1) bound to the test tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tree import json_tables, json_tree
from ..sources.bulletins import scratch_path
from ..streaming import register_stream as rs
from .registry import Tables, register

EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
# Landing layout of the replay: days per arriving file. A re-delivered file is at most one file
# late, so the dedup watermark delay is one file span plus a day.
DAYS_PER_FILE = 5
DEDUP_DELAY = f"{DAYS_PER_FILE + 1} days"


def _land_in_files(df: DataFrame, ts_col: str, path: str, days_per_file: int = 3, redeliver: bool = False) -> str:
    """Write a table as an ordered series of files, ``days_per_file`` days each (the arrival
    order of a landing folder). With ``redeliver`` every file also carries the rows of the
    previous file again (at-least-once delivery). Returns ``path``.

    One distributed write produces all files (a row re-delivered later is duplicated with
    ``explode`` into the next slot). Each slot's file is then moved into ``path`` with an
    increasing modification time, which is the order a file stream source reads them in; only
    file metadata passes through the driver."""
    spark = df.sparkSession
    day0 = df.agg(F.min(F.to_date(ts_col)).alias("d0")).first()["d0"]
    if day0 is None:
        return path
    slot = F.floor(F.datediff(F.to_date(ts_col), F.lit(day0)) / days_per_file).cast("int")
    slots = F.array(slot, slot + 1) if redeliver else F.array(slot)
    staged = f"{path.rstrip('/')}.staging"
    tagged = df.withColumn("__slot", F.explode(slots))
    tagged.repartition("__slot").write.mode("overwrite").partitionBy("__slot").parquet(staged)

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_root = jvm.org.apache.hadoop.fs.Path(staged)
    fs = src_root.getFileSystem(conf)
    dst_root = jvm.org.apache.hadoop.fs.Path(path)
    fs.mkdirs(dst_root)
    parts = sorted(
        (int(st.getPath().getName().split("=", 1)[1]), st.getPath())
        for st in fs.listStatus(src_root)
        if st.isDirectory() and st.getPath().getName().startswith("__slot=")
    )
    t0 = int(time.time() * 1000) - 1000 * (len(parts) + 1)
    for i, (k, part) in enumerate(parts):
        for f in fs.listStatus(part):
            name = f.getPath().getName()
            if name.endswith(".parquet"):
                dst = jvm.org.apache.hadoop.fs.Path(dst_root, f"slot-{k:06d}-{name}")
                fs.rename(f.getPath(), dst)
                fs.setTimes(dst, t0 + 1000 * i, -1)
    return path


def _landing(spark, d, redeliver: bool):
    ev = Tables(spark, d)("events").select(*EV_COLS)
    path = scratch_path(spark, "landing")
    _land_in_files(ev, "ts", path, days_per_file=DAYS_PER_FILE, redeliver=redeliver)
    return path, ev.schema


@register(
    "stream_register_replay",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    ids=("I1", "I2", "E1"),
)
def q_stream_register_replay(spark, d):
    landing, schema = _landing(spark, d, redeliver=True)
    return rs.stream_register(spark, landing, schema, ["event_id"], ["ts"]).select(*EV_COLS)


@register(
    "stream_dedup",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    ids=("I2",),
)
def q_stream_dedup(spark, d):
    landing, schema = _landing(spark, d, redeliver=True)
    return rs.dedup_stream(spark, landing, schema, ["event_id"], "ts", delay=DEDUP_DELAY).select(*EV_COLS)


@register(
    "daily_counts",
    "SELECT date_trunc('day', ts) AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2",
    ids=("I3",),
)
def q_daily_counts(spark, d):
    landing, schema = _landing(spark, d, redeliver=False)
    return rs.daily_counts_stream(spark, landing, schema, "ts", "event_type")


@register(
    "daily_counts_batch",
    "SELECT date_trunc('day', ts) AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2",
    ids=("I3",),
)
def q_daily_counts_batch(spark, d):
    e = Tables(spark, d)("events")
    return e.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@register(
    "speed_batch_merge",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE day(ts) > 20) AS BIGINT) AS n_from_speed
FROM events GROUP BY 1""",
    ids=("I4", "E2"),
)
def q_speed_batch_merge(spark, d):
    ev = Tables(spark, d)("events").select(*EV_COLS)
    batch = ev.where(F.dayofmonth("ts") <= 20)
    landing, schema = _landing(spark, d, redeliver=False)
    speed = rs.speed_layer_stream(spark, landing, schema, where=F.dayofmonth("ts") >= 15)
    m = rs.speed_merge(batch, speed, ["event_id"])
    return m.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("layer") == "speed").alias("n_from_speed"))


_AFTER = """CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F' WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'P' ELSE o_orderstatus END"""


@register(
    "patch_verification",
    f"""SELECT o_orderkey, {_AFTER} AS status, b.o_orderstatus AS batch_status,
       CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN {_AFTER} IS NOT DISTINCT FROM b.o_orderstatus THEN 'confirmed' ELSE 'corrected' END AS verdict
FROM orders LEFT JOIN (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority <> '3-MEDIUM') b USING (o_orderkey)""".replace("o_orderstatus = 'P'", "orders.o_orderstatus = 'P'").replace("o_orderstatus = 'O'", "orders.o_orderstatus = 'O'").replace("ELSE o_orderstatus", "ELSE orders.o_orderstatus"),
    ids=("I4",),
)
def q_patch_verification(spark, d):
    from . import bind

    o = Tables(spark, d)("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    patches = o.select("o_orderkey", bind.after_status().alias("status"))
    batch = o.where(F.col("o_orderpriority") != "3-MEDIUM").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return rs.verify_patches(patches, batch, ["o_orderkey"], ["status"])


@register(
    "late_revision",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F'
                           WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'P' END AS o_orderstatus,
       o_orderstatus AS old_value, CAST(0 AS BIGINT) AS old_version
FROM orders WHERE (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')""",
    ids=("I5", "E8", "E1"),
)
def q_late_revision(spark, d):
    from . import bind

    o = Tables(spark, d)("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    landing = scratch_path(spark, "orders-landing")
    # first delivery: all orders as published; second delivery: the corrected rows only, which lands first
    first = o.withColumn("version", F.lit(0).cast("long"))
    corrected = o.withColumn("new", bind.after_status()).where(F.col("new") != F.col("o_orderstatus"))
    second = corrected.select("o_orderkey", F.col("new").alias("o_orderstatus"), "o_orderpriority", F.lit(1).cast("long").alias("version"))
    second.write.mode("append").parquet(landing)
    first.write.mode("append").parquet(landing)
    _, ledger = rs.revision_stream(spark, landing, first.schema, ["o_orderkey"], "o_orderstatus")
    return ledger.select("o_orderkey", "o_orderstatus", "old_value", "old_version")


# a document per event: text that looks like JSON, nested values, a list, metadata, a list of objects
_NODES = [  # (pos_path, path, depth, key, kind, text) of the document, as DuckDB expressions
    ("[0]", "$.event_type", 1, "event_type", "scalar", "'Event Type: [' || event_type || '] {x'"),
    ("[1]", "$.value_usd", 1, "value_usd", "scalar", "'Value USD: ' || CAST(value AS VARCHAR)"),
    ("[2]", "$.props", 1, "props", "object", "'Props'"),
    ("[2, 0]", "$.props.k", 2, "k", "scalar", "'K: ' || json_extract_string(props, '$.k')"),
    ("[3]", "$.ids", 1, "ids", "array", "'Ids'"),
    ("[3, 0]", "$.ids[0]", 2, None, "scalar", "CAST(user_id AS VARCHAR)"),
    ("[3, 1]", "$.ids[1]", 2, None, "scalar", "CAST(event_id AS VARCHAR)"),
    ("[4]", "$.rows", 1, "rows", "array", "'Rows'"),
    ("[4, 0]", "$.rows[0]", 2, None, "object", "'{\"user\":' || user_id || ',\"type\":\"' || event_type || '\"}'"),
    ("[4, 0, 0]", "$.rows[0].user", 3, "user", "scalar", "'User: ' || user_id"),
    ("[4, 0, 1]", "$.rows[0].type", 3, "type", "scalar", "'Type: ' || event_type"),
    ("[4, 1]", "$.rows[1]", 2, None, "object", "'{\"note\":[[' || event_id || ']]}'"),
    ("[4, 1, 0]", "$.rows[1].note", 3, "note", "array", "'Note'"),
    ("[4, 1, 0, 0]", "$.rows[1].note[0]", 4, None, "array", "'[' || event_id || ']'"),
    ("[4, 1, 0, 0, 0]", "$.rows[1].note[0][0]", 5, None, "scalar", "CAST(event_id AS VARCHAR)"),
]
_BUDGET = 150


def _nodes_sql() -> str:
    q = lambda x: "NULL" if x is None else f"'{x}'"
    rows = ",\n".join(f"{{'o': {i}, 'pos_path': {p}, 'path': '{path}', 'depth': {d}, 'key': {q(k)}, 'kind': '{kind}', 'text': {t}}}" for i, (p, path, d, k, kind, t) in enumerate(_NODES))
    return f"""WITH n AS (SELECT event_id AS id, unnest([{rows}]) AS r FROM events),
b AS (SELECT id, r.*, coalesce(sum(length(r.text)) OVER (PARTITION BY id ORDER BY r.o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(length(r.text)) OVER (PARTITION BY id) AS whole FROM n)
SELECT id, CAST(pos_path AS INTEGER[]) AS pos_path, path, CAST(depth AS INTEGER) AS depth, key, kind, text FROM b WHERE before < {_BUDGET}
UNION ALL SELECT DISTINCT id, [2147483647], '$', 1, NULL, 'marker', '… (truncated)' FROM b WHERE whole >= {_BUDGET}"""


def _event_docs(spark, d):
    e = Tables(spark, d)("events")
    rows = F.concat(F.lit('[{"user":'), F.col("user_id"), F.lit(',"type":"'), F.col("event_type"), F.lit('"},{"note":[['), F.col("event_id"), F.lit("]]}]"))
    doc = F.concat(
        F.lit('{"event_type":"['), F.col("event_type"), F.lit('] {x","value_usd":'), F.col("value").cast("string"), F.lit(',"purpose":{"x":[1]},"props":'), F.col("props"), F.lit(',"ids":['),
        F.col("user_id"), F.lit(","), F.col("event_id"), F.lit('],"rows":'), rows, F.lit("}"),
    )
    return e.select("event_id", doc.alias("doc"))


@register("json_tree", _nodes_sql(), ids=("J1", "H3", "B10"))
def q_json_tree(spark, d):
    return json_tree(_event_docs(spark, d), "event_id", "doc", max_chars=_BUDGET)


@register(
    "json_tables",
    """WITH f AS (SELECT event_id AS id, r AS row_no, c.col_no, c.column FROM events, range(2) AS r(r), (VALUES (0, 'User'), (1, 'Type'), (2, 'Note')) AS c(col_no, "column"))
SELECT f.id, '$.rows' AS path, CAST(row_no AS INTEGER) AS row_no, col_no, f.column, CASE WHEN row_no = 0 AND col_no = 0 THEN CAST(e.user_id AS VARCHAR) WHEN row_no = 0 AND col_no = 1 THEN e.event_type
       WHEN row_no = 1 AND col_no = 2 THEN '[[' || e.event_id || ']]' ELSE '' END AS cell FROM f JOIN events e ON e.event_id = f.id""",
    ids=("H16", "J1"),
)
def q_json_tables(spark, d):
    return json_tables(_event_docs(spark, d), "event_id", "doc")
