
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import aggs, filters, joins, quality, windows
from ledgerlens.operators.tree import json_tables, json_tree
from ledgerlens.sources import bulletins, pages


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_join_rowcount_is_key_union(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    a = o.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("a"))
    b = o.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("b"))
    j = joins.full_join_provenance(a, b, "o_custkey")
    keys = a.select("o_custkey").union(b.select("o_custkey")).distinct()
    assert j.count() == keys.count()
    assert {r[0] for r in j.select("present_in").distinct().collect()} <= {"both", "left_only", "right_only"}


def test_shares_sum_to_100(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    s = aggs.share_of_total(o, "v").agg(F.sum("share_pct")).first()[0]
    assert abs(s - 100.0) < 1e-6


def test_upsert_idempotent(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    key, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    once = windows.upsert(li, li.limit(0), key, order)
    twice = windows.upsert(once, li, key, order)
    assert rows(once) == rows(twice)
    assert once.count() == li.select(*key).distinct().count()


def test_diff_of_snapshot_with_itself_is_empty(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert joins.snapshot_diff(o, o, "o_orderkey", ["o_orderstatus", "o_totalprice"]).count() == 0


def test_cumulative_roundtrip(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    y = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("v"))
    cum = y.withColumn("cum", F.sum("v").over(Window.partitionBy("o_custkey").orderBy("yr")))
    flow = windows.difference_vintages(cum, "o_custkey", "yr", "cum")
    bad = flow.where(F.col("derivable") & (F.abs(F.col("flow") - F.col("v")) > 1e-6)).count()
    assert bad == 0
    assert flow.where(~F.col("derivable")).count() == y.select("o_custkey").distinct().count()


def test_quarantine_halves_union_is_input(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("yr", F.year("o_orderdate"))
    rules = spark.createDataFrame([(1, "yr", "=", "1995", "early"), (2, "yr", ">=", "2001", "partial")], filters.RULES_SCHEMA)
    good, bad = filters.quarantine(o, rules)
    assert good.count() + bad.count() == o.count()
    assert bad.where("quarantine_reason IS NULL").count() == 0
    kept, split = filters.write_quarantine(o, rules, str(tmp_path / "q"))
    assert kept.columns == o.columns and (kept.count(), split.count()) == (good.count(), bad.count())


def test_rules_by_priority_operator_and_override(spark):
    df = spark.createDataFrame([(1, "Alpha", 5.0, None), (2, "beta", None, None), (3, "gamma", 50.0, "X"), (4, None, 7.5, None), (5, "zeta", -1.0, None)], "id int, s string, v double, ovr string")
    rules = [(5, "s", "like", "%eta", "like"), (1, "v", ">=", "7.5", "big"), (2, "s", "null", None, "no name"), (3, "s", "regex", "(?i)^al", "regex"), (4, "nowhere", "=", "1", "never"), (None, "v", "<", "-100", "first")]
    got = {r.id: r[1] for r in df.select("id", filters.rule_label(df, spark.createDataFrame(rules, filters.RULES_SCHEMA), "none", "ovr")).collect()}
    assert got == {1: "regex", 2: "like", 3: "X", 4: "big", 5: "like"}
    none = spark.createDataFrame([], filters.RULES_SCHEMA)
    assert {r[0] for r in df.select(filters.rule_label(df, none, "d")).collect()} == {"d"}
    with pytest.raises(ValueError):
        filters.rule_label(df, spark.createDataFrame([(1, "s", "~", "x", "y")], filters.RULES_SCHEMA))


def test_bucketed_register_prunes_by_entity_and_date(spark, tmp_path):
    """A look-up by entity reads one bucket and one by date the years' folders; a join by entity does not shuffle it."""
    from ledgerlens.sources import register as reg

    df = spark.range(2000).select("id", (F.col("id") % 37).alias("who"), F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("at"))
    table = f"register_{tmp_path.name}".replace("-", "_")
    reg.save_register(df, table, str(tmp_path / "t"), "who", "at", buckets=4)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then names the buckets it reads
    got = reg.entity_range(spark, table, "who", 5, "at", "2021-03-01", "2022-02-01")
    want = df.where("who = 5 AND at >= timestamp_ntz'2021-03-01' AND at < timestamp_ntz'2022-02-01'")
    assert rows(got.select("id", "who", "at")) == rows(want)
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "SelectedBucketsCount: 1 out of 4" in plan and "PartitionFilters: [isnotnull(year" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(table).join(spark.range(37).withColumnRenamed("id", "who"), "who")
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_asof_matches_brute_force(spark):
    facts = spark.createDataFrame(
        [(1, "a", "2024-01-05"), (2, "a", "2024-03-01"), (3, "a", "2023-12-31"), (4, "b", "2024-02-10"), (5, "a", "2024-01-20")],
        "fid int, k string, t string",
    ).withColumn("t", F.to_timestamp("t"))
    vint = spark.createDataFrame(
        [("a", "2024-01-01", 10.0), ("a", "2024-01-20", 11.0), ("a", "2024-02-15", 12.0), ("b", "2024-03-01", 5.0)],
        "k string, vt string, v double",
    ).withColumn("vt", F.to_timestamp("vt"))
    got = {r.fid: r.v for r in joins.asof_latest(facts, vint, "k", "t", "vt", ["v"]).collect()}
    cand = facts.join(vint, "k").where("vt <= t")
    brute = {r.fid: r.v for r in cand.groupBy("fid").agg(F.max_by("v", "vt").alias("v")).collect()}
    for fid in (1, 2, 3, 4, 5):
        assert got[fid] == brute.get(fid), fid


def test_code_ranges_any_bucket_width_and_awkward_ranges(spark):
    """Overlapping, reversed, single, unreadable ranges; fractional, negative and null codes."""
    tax = [("A", "1-10, 5-8"), ("B", "38-31"), ("C", "12"), ("D", "x, 7"), ("E", ""), ("F", "10-20, 20-30")]
    spans = {"A": [(1, 10)], "B": [(31, 38)], "C": [(12, 12)], "D": [(7, 7)], "F": [(10, 30)]}
    codes = [(i, c) for i, c in enumerate([6.0, 35.0, 1.0, 10.0, 10.5, 12.0, 12.5, 38.0, 38.1, 20.0, None, -3.0])]
    df = spark.createDataFrame(codes, "id int, code double")
    want = sorted((i, k) for i, c in codes for k, rs in spans.items() if c is not None and any(lo <= c <= hi for lo, hi in rs))
    for width in (1, 7, 1024):
        got = joins.map_code_ranges(df, "code", spark.createDataFrame(tax, "sector string, codes string"), "codes", width=width)
        assert sorted((r.id, r.sector) for r in got.collect()) == want


def test_bounded_counts_rows_not_estimates(spark):
    """A frame that the optimizer takes for a few bytes is not broadcast if its rows are many."""
    big = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(50_000))).alias("x"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert not hinted(joins.bounded(big, max_rows=10_000))
    assert not hinted(joins.bounded(big.withColumn("s", F.lit("y" * 100)), max_bytes=1_000_000))
    assert hinted(joins.bounded(big, max_rows=60_000))


def test_null_keys_and_dates_stay(spark):
    rows_in = [(1, None, "2024-01-01"), (2, None, None), (3, "a", None), (4, "a", "2023-05-05"), (5, "a", "2024-05-05"), (6, None, None)]
    df = spark.createDataFrame(rows_in, "id int, k string, d string").withColumn("d", F.to_timestamp("d"))
    for kw in ({}, {"hot_rows": 1, "sub_buckets": 4}):
        got = windows.seq_number(df, "k", ["d", "id"], F.date_trunc("year", "d"), **kw)
        assert {r.id: r.step for r in got.collect()} == {2: 1, 6: 2, 1: 3, 3: 1, 4: 2, 5: 3}
    v = spark.createDataFrame([(None, 1.0), (None, 3.0), ("g", 4.0)], "g string, v double")
    assert sorted((str(r.g), r.p) for r in aggs.share_in_group(v, "g", "v", "p").collect()) == [("None", 25.0), ("None", 75.0), ("g", 100.0)]
    s = spark.createDataFrame([(None, 2024, 7.0), ("e", 2023, 1.0)], "e string, y int, v double")
    prof = aggs.series_profile(s, "e", "y", "v", spark.createDataFrame([(2023,), (2024,)], "y int"))
    assert {(r.e, r.total, r.n_periods) for r in prof.collect()} == {(None, 7.0, 2), ("e", 1.0, 2)}


def test_seq_number_equals_row_number(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderdate")
    got = windows.trajectory(o, "o_custkey", "o_orderdate", tiebreak=["o_orderkey"], bucket="month")
    ref = o.withColumn("step", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    assert rows(got.select("o_orderkey", "step")) == rows(ref.select("o_orderkey", "step"))


def test_top_n_per_group_keeps_n(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    t = windows.top_n(o, "o_orderpriority", "o_totalprice", 3, tiebreak=["o_orderkey"])
    assert t.count() == 15


def test_json_tree_budget(spark):
    doc = json.dumps({"a": 1, "b": {"c": "x", "d": [1, 2]}, "e": "long text " * 5})
    df = spark.createDataFrame([(1, doc)], "id int, j string")
    full = json_tree(df, "id", "j", max_depth=4)
    assert {r.path for r in full.collect()} == {"$.a", "$.b", "$.b.c", "$.b.d", "$.b.d[0]", "$.b.d[1]", "$.e"}
    cut = json_tree(df, "id", "j", max_depth=4, max_chars=12).orderBy("pos_path").collect()
    # a node is emitted while the text before it is under budget: 0, 4, 5, 9, 10, 11 < 12
    assert [r.text for r in cut] == ["A: 1", "B", "C: x", "D", "1", "2", "… (truncated)"]


def test_gates(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    res = quality.check_required(d, ["doc_id", "text"])
    quality.gate(res)
    bad = spark.createDataFrame([("x", False)], "check string, passed boolean")
    try:
        quality.gate(bad)
        raise AssertionError("gate did not fail")
    except quality.GateFailed:
        pass
    try:
        quality.assert_measure(d, ["lang"])
        raise AssertionError("measure rule not enforced")
    except quality.GateFailed:
        pass


def test_bulletins_and_manifest(spark, tmp_path):
    for name, body in [
        ("alpha_2026-07-19.json", {"purpose": "p", "rows": [{"state": "X", "v": 1.5}]}),
        ("beta_2026-07-20.json", {"purpose": "q", "rows": [{"state": "Y", "v": None}, {"state": "Z", "v": 2.0}]}),
    ]:
        (tmp_path / name).write_text(json.dumps(body, indent=1))
    df = bulletins.read_bulletins(spark, str(tmp_path / "*.json"), "purpose string, rows array<struct<state:string,v:double>>")
    got = {(r.file_name, str(r.snapshot_date)) for r in df.collect()}
    assert got == {("alpha_2026-07-19.json", "2026-07-19"), ("beta_2026-07-20.json", "2026-07-20")}
    man = spark.createDataFrame([("A", ["alpha_2026-07-19.json"]), ("B", ["gamma.json"]), ("C", [])], "title string, data array<string>")
    listing = df.select(F.col("file_name").alias("file"))
    st = {r.title: r.status for r in bulletins.manifest_status(man, "title", "data", listing, "file").collect()}
    assert st == {"A": "ok", "B": "missing", "C": "no_data"}


def test_listing_header_carried(spark):
    html = "<p>x</p><h3>Ministry A</h3><li><a href='/d?PRID=101'>One</a></li><h3>B &amp; C</h3><a href='/d?PRID=102'>Two</a>"
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    out = pages.extract_listing(df, "html", r"<a[^>]*href='/d\?PRID=(\d+)'[^>]*>([^<]*)</a>")
    assert [(r.header, r.target, r.text) for r in out.orderBy("section_no").collect()] == [
        ("Ministry A", "101", "One"), ("B & C", "102", "Two"),
    ]


def test_global_rank_matches_window_rank(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    keyed = li.withColumn("rid", F.monotonically_increasing_id())
    for ties, ref in [
        ("min", F.rank().over(Window.orderBy("l_quantity"))),
        ("dense", F.dense_rank().over(Window.orderBy("l_quantity"))),
        ("mean", F.rank().over(Window.orderBy("l_quantity")) + (F.count(F.lit(1)).over(Window.partitionBy("l_quantity")) - 1) / 2.0),
    ]:
        got = windows.global_rank(keyed, "l_quantity", "r", ties=ties).select("rid", "r")
        want = keyed.withColumn("r", ref.cast("double")).select("rid", "r")
        assert rows(got.withColumn("r", F.col("r").cast("double"))) == rows(want)
    desc = windows.global_rank(keyed, "l_quantity", "r", descending=True)
    top = desc.where("r = 1").agg(F.min("l_quantity")).first()[0]
    assert top == keyed.agg(F.max("l_quantity")).first()[0]


def test_register_partition_pruning(spark, tmp_path):
    from ledgerlens.sources import register as reg

    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    r = e.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("ts").alias("date"),
        F.col("user_id").cast("string").alias("entity"),
    )
    path = str(tmp_path / "register")
    reg.write_register(r, path)
    back = reg.read_register(spark, path).where((F.col("kind") == "click") & (F.col("year") == 2024))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "kind" in plan.split("PartitionFilters")[1][:200]
    assert back.count() == e.where("event_type = 'click'").count()
    last = {x.kind: x.last_indexed for x in reg.watermark(reg.read_register(spark, path), "kind", "date").collect()}
    assert len(last) == 5


def test_crosstab_csv_sink(spark, tmp_path):
    from ledgerlens.sources.sinks import write_crosstab

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = str(tmp_path / "xtab")
    out = write_crosstab(o, ["o_orderpriority", "o_orderstatus"], path, value="o_totalprice")
    back = spark.read.option("header", True).csv(path)
    assert back.count() == out.count() == o.select("o_orderpriority", "o_orderstatus").distinct().count()
    assert set(back.columns) == {"o_orderpriority", "o_orderstatus", "n", "sum_o_totalprice"}


def test_cells(spark):
    from ledgerlens.functions.scalars import array_to_cell, map_to_cell, to_cell

    df = spark.createDataFrame(
        [(["a" * 100, "b"], {"usd_mn": "x" * 70}, "word " * 80)], "l array<string>, m map<string,string>, t string"
    )
    r = df.select(
        array_to_cell("l").alias("l"), map_to_cell("m").alias("m"), to_cell("t", 20).alias("t")
    ).first()
    assert r.l == "a" * 79 + "…; b"
    assert r.m == "USD Mn: " + "x" * 59 + "…"
    assert r.t == "word word word word…"


def test_json_tree_skips_reserved_metadata(spark):
    doc = json.dumps({"purpose": "p", "rows": [{"method": "kept below top level"}], "method": {"x": 1}, "retrieved": "2026"})
    df = spark.createDataFrame([(1, doc)], "id int, j string")
    paths = {r.path for r in json_tree(df, "id", "j").collect()}
    assert paths == {"$.rows", "$.rows[0]", "$.rows[0].method"}


def test_snapshots_are_immutable(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus")
    base = str(tmp_path / "snaps")
    bulletins.write_snapshot(o, base, "2026-01-01")
    bulletins.write_snapshot(o.limit(10), base, "2026-02-01")
    try:
        bulletins.write_snapshot(o, base, "2026-01-01")
        raise AssertionError("rewrote a snapshot")
    except FileExistsError:
        pass
    snaps = bulletins.read_snapshots(spark, base)
    counts = {str(r[0]): r[1] for r in snaps.groupBy("snapshot_date").count().collect()}
    assert counts == {"2026-01-01": o.count(), "2026-02-01": 10}


def test_json_tree_keeps_strings_depth_and_order(spark):
    doc = {"z": "[Draft] steel note", "a": "{x} y", "n": None, "s": "null", "deep": {"a": {"b": {"c": {"d": [[1, '"[{']]}}}}, "e": [], "o": {}, "f": 1.5, "t": True, "long": "w " * 200}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, "[]"), (3, "not json"), (4, None), (5, '"{"')], "id int, j string")
    got = {(r.id, r.path): (r.kind, r.text) for r in json_tree(df, "id", "j").collect()}
    assert {i for i, _ in got} == {1}
    assert got[1, "$.z"] == ("scalar", "Z: [Draft] steel note") and got[1, "$.a"] == ("scalar", "A: {x} y")
    assert got[1, "$.n"] == ("null", "N: null") and got[1, "$.s"] == ("scalar", "S: null")
    assert got[1, "$.deep.a.b.c.d[0][0]"] == ("scalar", "1") and got[1, "$.deep.a.b.c.d[0][1]"] == ("scalar", '"[{')
    assert got[1, "$.e"] == ("array", "E") and got[1, "$.o"] == ("object", "O")
    assert len(got[1, "$.long"][1]) <= 220 and got[1, "$.long"][1].endswith("…")
    order = [r.path for r in json_tree(df, "id", "j").where("depth = 1").orderBy("pos_path").collect()]
    assert order == ["$." + k for k in doc]


def test_json_tables_have_the_union_of_keys(spark):
    doc = {"rows": [{"b": 1, "a_x": "[q]"}, {"c": None, "b": {"k": 1}}], "scalars": [1, 2], "mixed": [{"a": 1}, 2], "in": {"t": [{"z": 1}]}, "none": []}
    df = spark.createDataFrame([(7, json.dumps(doc))], "id int, j string")
    got = sorted((r.path, r.row_no, r.col_no, r.column, r.cell) for r in json_tables(df, "id", "j").collect())
    assert got == [("$.in.t", 0, 0, "Z", "1"), ("$.rows", 0, 0, "B", "1"), ("$.rows", 0, 1, "A X", "[q]"), ("$.rows", 0, 2, "C", ""),
                   ("$.rows", 1, 0, "B", '{"k":1}'), ("$.rows", 1, 1, "A X", ""), ("$.rows", 1, 2, "C", "")]


def test_cum_share_matches_running_window(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    per = o.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), -4).alias("v"))  # many ties
    got = windows.cum_share(per, "v", ["o_custkey"]).select("o_custkey", "pos", F.round("cum_share_pct", 9))
    w = Window.orderBy(F.col("v").desc(), "o_custkey")
    tot = per.agg(F.sum("v")).first()[0]
    ref = per.select(
        "o_custkey", F.row_number().over(w).alias("pos"),
        F.round(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)) / tot * 100, 9),
    )
    assert rows(got) == rows(ref)


def test_rank_paths_agree(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_discount")
    keyed = li.withColumn("rid", F.monotonically_increasing_id())
    for ties in ("min", "dense", "mean"):
        a = windows.global_rank(keyed, "l_discount", "r", ties=ties, descending=True).select("rid", F.col("r").cast("double"))
        w = Window.orderBy(F.col("l_discount").desc())
        r = {"min": F.rank().over(w), "dense": F.dense_rank().over(w), "mean": F.rank().over(w) + (F.count("*").over(Window.partitionBy("l_discount")) - 1) / 2}[ties]
        assert rows(a) == rows(keyed.select("rid", r.cast("double").alias("r")))
        va = windows.value_ranks(keyed, "l_discount", "r", ties=ties).select("l_discount", F.col("r").cast("double"))
        up = windows.global_rank(keyed, "l_discount", "r", ties=ties).select("l_discount", F.col("r").cast("double")).distinct()
        assert rows(va) == rows(up)


def test_revision_stream_empty_and_out_of_order(spark, tmp_path):
    from pyspark.sql.types import StructType

    from ledgerlens.streaming import register_stream as rs

    schema = StructType.fromDDL("k long, v string, version long")
    current, ledger = rs.revision_stream(spark, str(tmp_path / "nothing"), schema, ["k"], "v")
    assert current.count() == 0 and ledger.count() == 0
    landing = str(tmp_path / "landing")
    for batch in ([(1, "b", 1)], [(1, "a", 0), (2, "x", 0)], [(1, "c", 2), (2, "x", 1)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(landing)
    current, ledger = rs.revision_stream(spark, landing, schema, ["k"], "v")
    assert sorted((r.k, r.v) for r in current.collect()) == [(1, "c"), (2, "x")]
    assert sorted((r.k, r.old_value, r.v) for r in ledger.collect()) == [(1, "a", "b"), (1, "b", "c")]


def test_register_epochs_replay_retry_and_compaction(spark, tmp_path):
    from pyspark.sql.types import StructType

    from ledgerlens.streaming import register_stream as rs

    schema = StructType.fromDDL("k long, v string, t long, url string")
    df = lambda rows_in: spark.createDataFrame(rows_in, schema)
    path, rule = str(tmp_path / "register"), dict(key=["k"], order=["t"], keep_first=["url"])
    assert rs.current_register(spark, path, schema, **rule).count() == 0
    rs.write_epoch(df([(k, "a", 1, f"u{k}") for k in range(20)]), path, 0)
    rs.write_epoch(df([(3, "lost", 9, "x")]), path, 1)
    rs.write_epoch(df([(3, "b", 2, "new"), (4, "old", 0, "older"), (50, "c", 1, "u50")]), path, 1)  # the epoch is tried again

    def check(got, n=21):
        got = {r.k: (r.v, r.url) for r in got.collect()}
        assert len(got) == n and got[3] == ("b", "u3") and got[4] == ("a", "older") and got[50] == ("c", "u50")

    check(rs.current_register(spark, path, schema, **rule))
    check(rs.compact_register(spark, path, str(tmp_path / "compact"), schema, **rule))
    rs.write_epoch(df([(60, "d", 1, "u60")]), str(tmp_path / "compact"), 2)
    check(rs.current_register(spark, str(tmp_path / "compact"), schema, **rule), 22)


def test_register_stream_over_several_runs(spark, tmp_path):
    from pyspark.sql.types import StructType

    from ledgerlens.streaming import register_stream as rs

    schema = StructType.fromDDL("k long, v string, t long")
    landing, work = str(tmp_path / "landing"), str(tmp_path / "work")
    run = lambda: sorted(tuple(r) for r in rs.stream_register(spark, landing, schema, ["k"], ["t"], work_dir=work).collect())
    assert run() == []
    for batch, want in ([(1, "new", 5), (2, "x", 1)], [(1, "new", 5), (2, "x", 1)]), ([(1, "old", 2), (2, "y", 2), (1, "new", 5)], [(1, "new", 5), (2, "y", 2)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(landing)
        assert run() == want


def test_revision_ledger_is_kept_up_by_touched_keys(spark, tmp_path):
    """Late, repeated and out-of-order versions over several runs give what a replay of the whole log gives."""
    from pyspark.sql.types import StructType

    from ledgerlens.streaming import register_stream as rs

    schema = StructType.fromDDL("k long, v string, version long")
    landing, work = str(tmp_path / "landing"), str(tmp_path / "work")
    log = []
    for batch in ([(1, "a", 0), (2, "x", 0), (3, None, 0)], [(1, "c", 4), (3, "z", 2)], [(1, "b", 2), (1, "c", 4), (2, "x", 1)], [(3, None, 1), (1, "a", 3)]):
        log += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        current, ledger = rs.revision_stream(spark, landing, schema, ["k"], "v", work_dir=work)
        whole = windows.revisions(spark.createDataFrame(log, schema).distinct(), ["k"], "version", "v").select(*ledger.columns)
        assert rows(ledger) == rows(whole)
        assert {r.k: r.v for r in current.collect()} == {k: v for k, v, _ in sorted(log, key=lambda r: r[2])}


def test_patches_are_confirmed_corrected_or_missing(spark):
    from ledgerlens.streaming import register_stream as rs

    patches = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (5, None)], "k int, v string")
    batch = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "k int, v string")
    got = {r.k: r.verdict for r in rs.verify_patches(patches, batch, ["k"], ["v"]).collect()}
    assert got == {1: "confirmed", 2: "corrected", 3: "confirmed", 4: "missing", 5: "corrected"}


def test_open_counts_equal_open_windows(spark):
    items = spark.createDataFrame(
        [(1, "2024-01-15", "2024-03-01"), (2, "2024-02-01", None), (3, "2024-01-01", "2024-01-31"), (4, None, "2024-05-01"), (5, "2024-04-01", "2024-02-01"), (6, "2023-01-01", "2030-01-01")],
        "i int, s string, e string").select("i", F.to_timestamp("s").cast("timestamp_ntz").alias("s"), F.to_timestamp("e").cast("timestamp_ntz").alias("e"))
    months = spark.createDataFrame([("2024-01-01",), ("2024-02-01",), ("2024-03-01",), ("2024-06-01",)], "m string").select(F.to_timestamp("m").cast("timestamp_ntz").alias("m"))
    rows_of = joins.open_windows(items, months, "s", "e", "m", grid="month")
    want = rows_of.groupBy("m").agg(F.count("*").alias("n"), F.count_if(F.col("e").isNull()).alias("z"), F.sum(F.coalesce("days_to_close", F.lit(0))).alias("d"))
    got = joins.open_counts(items, months, "s", "e", "m", grid="month").select("m", F.col("n_open").alias("n"), F.col("n_open_ended").alias("z"), F.col("days_to_close_sum").alias("d"))
    assert rows(got) == rows(want)


def test_purge_scratch(spark):
    path = bulletins.scratch_path(spark, "purge-me")
    spark.range(3).write.parquet(path)
    bulletins.purge_scratch(spark, 1.0)
    assert spark.read.parquet(path).count() == 3
    assert bulletins.purge_scratch(spark, -1.0) >= 1


def test_checkpoint_folder_is_stable(spark):
    from ledgerlens.session import ensure_checkpoint_dir, materialize

    first = ensure_checkpoint_dir(spark)
    materialize(spark.range(3))
    assert ensure_checkpoint_dir(spark) == first
    inner = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    assert inner.count("ledgerlens-ckpt-") <= 1
