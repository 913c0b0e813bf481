
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import aggs, joins, sets


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_match_supply_null_ratio_rules(spark):
    demand = spark.createDataFrame([("a", 100.0), ("b", 0.0), ("c", -5.0), ("d", 50.0), ("e", 10.0)], "k string, demand double")
    stock = spark.createDataFrame([("a", 25.0), ("b", 10.0), ("c", 10.0), ("d", 0.0)], "k string, stock double")
    got = {r.k: r.demand_per_stock for r in joins.match_supply(demand, stock, "k", "demand", "stock").collect()}
    assert got == {"a": 4.0, "b": None, "c": None, "d": None, "e": None}


def test_snapshot_diff_is_null_safe(spark):
    prev = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id int, s string")
    cur = spark.createDataFrame([(1, None), (2, None), (4, "z")], "id int, s string")
    got = {r.id: r.change for r in joins.snapshot_diff(prev, cur, "id", ["s"]).collect()}
    assert got == {2: "changed", 3: "removed", 4: "added"}


def test_prefer_table_falls_back_only_when_empty(spark):
    p = spark.createDataFrame([("a", 1.0)], "k string, v double")
    f = spark.createDataFrame([("a", 9.0), ("b", 9.0)], "k string, v double")
    assert rows(aggs.prefer_table(p, f, "cum", "fy")) == [("a", 1.0, "cum")]
    assert rows(aggs.prefer_table(p.limit(0), f, "cum", "fy")) == [("a", 9.0, "fy"), ("b", 9.0, "fy")]
    per_key = aggs.prefer(p, f, "k", "cum", "fy")
    assert rows(per_key) == [("a", 1.0, "cum"), ("b", 9.0, "fy")]


def test_interval_join_paths_agree(spark):
    items = spark.createDataFrame(
        [(1, "2024-01-15", "2024-04-02"), (2, "2024-02-01", None), (3, "2024-03-10", "2024-03-01"), (4, "2023-12-31", "2024-01-01")],
        "id int, s string, e string",
    ).select("id", F.to_timestamp("s").cast("timestamp_ntz").alias("s"), F.to_timestamp("e").cast("timestamp_ntz").alias("e"))
    cal = spark.createDataFrame([(f"2024-0{m}-01",) for m in range(1, 6)], "m string").select(
        F.to_timestamp("m").cast("timestamp_ntz").alias("m")
    )
    a = joins.open_windows(items, cal, "s", "e", "m").select("id", "m", "days_to_close")
    b = joins.open_windows(items, cal, "s", "e", "m", grid="month").select("id", "m", "days_to_close")
    assert rows(a) == rows(b)
    assert {(r.id, r.m.month) for r in a.collect()} == {(1, 2), (1, 3), (1, 4), (2, 2), (2, 3), (2, 4), (2, 5), (4, 1)}


def test_reconcile_tolerance_and_gate(spark):
    from ledgerlens.operators import quality

    a = spark.createDataFrame([("x", 334.3), ("y", 100.0), ("z", None)], "k string, a double")
    b = spark.createDataFrame([("x", 333.2), ("y", 110.0), ("z", None)], "k string, b double")
    got = {r.k: r.passed for r in joins.reconcile(a, b, "k", "a", "b", tol=0.0035).collect()}
    assert got == {"x": True, "y": False, "z": True}
    try:
        quality.gate(joins.reconcile(a, b, "k", "a", "b", tol=0.0035))
        raise AssertionError("gate should fail")
    except quality.GateFailed:
        pass


def test_align_union_and_column_union(spark):
    long_form = spark.createDataFrame([("s1", dt.date(2017, 1, 1), 10.0, True)], "scheme string, date date, outlay double, pli boolean")
    short = spark.createDataFrame([("s2", dt.date(2019, 1, 1), 20.0)], "s string, d date, cr double")
    u = sets.align_union([long_form, short], [{}, {"s": "scheme", "d": "date", "cr": "outlay"}])
    assert rows(u.select("scheme", "outlay", "pli")) == [("s1", 10.0, True), ("s2", 20.0, None)]
    recs = spark.createDataFrame([(1, '{"b": 1, "a": 2}'), (2, '{"c": 3, "a": 4}')], "rid int, j string").select(
        "rid", F.from_json("j", "map<string,int>").alias("m")
    )
    order = [r.key for r in sets.column_union(recs, "m", "rid").orderBy("first_row", "first_pos").collect()]
    assert order == ["b", "a", "c"]


def test_tally_shows_zero_categories(spark):
    s = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").join(
        spark.read.parquet(f"{SF_SMALL}/nation.parquet"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    t = aggs.tally(s.select("n_name"), "n_name", spark.read.parquet(f"{SF_SMALL}/nation.parquet"))
    assert t.count() == 25 and t.where("n = 0").count() == 15  # suppliers cover 10 nations at sf0.001


def test_register_upsert_column_rules(spark):
    from ledgerlens.operators import windows

    base = spark.createDataFrame(
        [(1, "release", dt.date(2024, 1, 5), "Title A", "u1", False, 1), (2, "release", None, None, "u2", True, 1)],
        "id int, kind string, date date, title string, url string, cited boolean, fetched int",
    )
    delta = spark.createDataFrame(
        [(1, "release", dt.date(2024, 1, 6), "Title A2", "u1-new", False, 2), (2, "release", None, "Filled", "u2-new", False, 2)],
        "id int, kind string, date date, title string, url string, cited boolean, fetched int",
    )
    out = windows.upsert(
        base, delta, ["kind", "id"], ["fetched"], carry_max=["cited"], keep_first=["url"], latest_non_null=["date"]
    )
    got = {r.id: (r.date, r.title, r.url, r.cited) for r in out.collect()}
    assert got == {1: (dt.date(2024, 1, 6), "Title A2", "u1", False), 2: (None, "Filled", "u2", True)}
    again = windows.upsert(out, delta, ["kind", "id"], ["fetched"], carry_max=["cited"], keep_first=["url"], latest_non_null=["date"])
    assert rows(again.select("id", "date", "title", "url", "cited")) == rows(out.select("id", "date", "title", "url", "cited"))


def test_planned_helpers(spark):
    from ledgerlens.operators import quality, stats, windows
    from ledgerlens.sources import bulletins

    panel = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 3.0), (3.0, 6.2, None), (4.0, 7.9, 1.0)], "y double, a double, b double")
    cm = {r.x: (round(r.pearson_r, 3), r.n) for r in stats.corr_matrix(panel, "y", ["a", "b"]).collect()}
    assert cm["b"] == (-0.982, 3) and cm["a"][1] == 4 and cm["a"][0] > 0.99  # numpy: -0.9820, 0.9988

    out = spark.createDataFrame([("x", 10.0), ("y", 1.0)], "k string, o double")
    inn = spark.createDataFrame([("x", 4.0), ("z", 3.0)], "k string, i double")
    bal = {r.k: (r.balance, int(r.rank_surplus), int(r.rank_deficit)) for r in aggs.balance(out, inn, "k", "o", "i").collect()}
    assert bal == {"x": (6.0, 1, 3), "y": (1.0, 2, 2), "z": (-3.0, 3, 1)}

    ordered = [r.k for r in windows.order_by(spark.createDataFrame([("a", 1.0), ("b", None), ("c", 5.0)], "k string, v double"), "v", "k").collect()]
    assert ordered == ["c", "a", "b"]

    man = spark.createDataFrame([("A", ["f1"]), ("B", ["f2", "f3"])], "t string, data array<string>")
    listing = spark.createDataFrame([("f1",), ("f3",)], "file string")
    assert {(r.t, r.file) for r in bulletins.missing(man, "t", "data", listing, "file").collect()} == {("B", "f2")}

    zn = {r.field: (r.n_null, r.n_zero, r.n_present) for r in quality.check_zero_null(
        spark.createDataFrame([(None,), (0.0,), (2.0,)], "v double"), ["v"]).collect()}
    assert zn == {"v": (1, 1, 1)}
