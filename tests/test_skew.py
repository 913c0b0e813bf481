"""Operators on input where one key holds a third of the rows: results equal the plain baselines."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import joins, windows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def skewed_lineitem(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    # the first three lines of every order go to one hot key (over a third of all rows)
    hot = F.when(F.col("l_linenumber") <= 3, F.lit(-1)).otherwise(F.col("l_suppkey"))
    return li.withColumn("k", hot).withColumn("rid", F.monotonically_increasing_id()).cache()


def test_hot_key_share(spark):
    li = skewed_lineitem(spark)
    assert li.where("k = -1").count() * 3 > li.count()


def test_seq_number_on_hot_key(spark):
    li = skewed_lineitem(spark)
    got = windows.seq_number(li, "k", ["l_shipdate", "rid"], F.date_trunc("month", "l_shipdate")).select("rid", "step")
    ref = li.select("rid", F.row_number().over(Window.partitionBy("k").orderBy("l_shipdate", "rid")).alias("step"))
    assert rows(got) == rows(ref)


def test_global_rank_with_hot_value(spark):
    li = skewed_lineitem(spark)
    got = windows.global_rank(li, "k", "r", ties="mean").select("rid", "r")
    ref = li.select("rid", (F.rank().over(Window.orderBy("k")) + (F.count(F.lit(1)).over(Window.partitionBy("k")) - 1) / 2.0).alias("r"))
    assert rows(got) == rows(ref)


def test_latest_and_top_n_on_hot_key(spark):
    li = skewed_lineitem(spark)
    latest = windows.latest_per_key(li.select("k", "l_shipdate", "rid", "l_quantity"), "k", ["l_shipdate", "rid"])
    ref = li.groupBy("k").agg(F.max(F.struct("l_shipdate", "rid")).alias("m")).select("k", "m.l_shipdate", "m.rid")
    assert rows(latest.select("k", "l_shipdate", "rid")) == rows(ref)
    top = windows.top_n(li, "k", "l_extendedprice", 5, tiebreak=["rid"]).where("k = -1").select("rid")
    ref_top = li.where("k = -1").orderBy(F.col("l_extendedprice").desc(), "rid").limit(5).select("rid")
    assert rows(top) == rows(ref_top)


def test_asof_on_hot_key(spark):
    li = skewed_lineitem(spark)
    facts = li.select("rid", "k", "l_shipdate")
    vint = li.where("l_linenumber = 1").select("k", F.col("l_shipdate").alias("vt"), F.col("l_quantity").alias("v"))
    vint = vint.groupBy("k", "vt").agg(F.max("v").alias("v"))
    got = joins.asof_latest(facts, vint, "k", "l_shipdate", "vt", ["v"], bucket="month").select("rid", "v")
    cand = facts.join(vint, "k").where("vt <= l_shipdate").groupBy("rid").agg(F.max_by("v", "vt").alias("v"))
    ref = facts.select("rid").join(cand, "rid", "left")
    assert rows(got) == rows(ref)


def test_seq_number_splits_a_hot_group_inside_one_bucket(spark):
    li = skewed_lineitem(spark)
    # one bucket for everything and a low threshold: the hot key is split by quantiles
    got = windows.seq_number(li, "k", ["l_shipdate", "rid"], F.lit(0), hot_rows=100, sub_buckets=8).select("rid", "step")
    ref = li.select("rid", F.row_number().over(Window.partitionBy("k").orderBy("l_shipdate", "rid")).alias("step"))
    assert rows(got) == rows(ref)


def test_asof_splits_a_hot_group_inside_one_bucket(spark):
    li = skewed_lineitem(spark)
    facts = li.select("rid", "k", "l_shipdate")
    vint = li.where("l_linenumber = 1").select("k", F.col("l_shipdate").alias("vt"), F.col("l_quantity").alias("v"))
    vint = vint.groupBy("k", "vt").agg(F.max("v").alias("v"))
    got = joins.asof_latest(facts, vint, "k", "l_shipdate", "vt", ["v"], bucket="year", hot_rows=50, sub_buckets=8).select("rid", "v")
    cand = facts.join(vint, "k").where("vt <= l_shipdate").groupBy("rid").agg(F.max_by("v", "vt").alias("v"))
    ref = facts.select("rid").join(cand, "rid", "left")
    assert rows(got) == rows(ref)


def test_one_value_in_all_rows_is_spread_and_exact(spark):
    """Ranks and running shares of a table whose rows all tie: many partitions hold it, results as by plain windows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select("id", F.lit(2.0).alias("v"))
        placed = windows.in_order(df, [F.col("v").desc()])
        sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 2000
        got = windows.cum_share(df, "v", ["id"]).select("id", "pos", F.round("cum_share_pct", 9)).collect()
        assert sorted(tuple(r) for r in got) == [(i, i + 1, round((i + 1) / 40, 9)) for i in range(4000)]
        mixed = df.unionByName(spark.range(4000, 4100).select("id", (F.col("id") * 1.0).alias("v"))).unionByName(spark.range(5000, 5003).select("id", F.lit(None).cast("double").alias("v")))
        ranks = {r.id: (r.r, r.b) for r in windows.global_rank(mixed, "v", "r", back="b").collect()}
        assert all(ranks[i] == (1, 101) for i in range(4000)) and ranks[4000] == (4001, 100) and ranks[4099] == (4100, 1) and ranks[5000] == (None, None)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_newest_per_key_with_hot_and_cold_keys(spark):
    """A hot key is reduced before the shuffle, all others behind it; both as a plain window gives."""
    rows = [(1 if i % 2 else i, i % 97, i, None if i % 5 else f"n{i}", i % 3 == 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, x int, note string, flag boolean")
    kwargs = dict(carry_max=["flag"], latest_non_null=["note"])
    got = {r.k: tuple(r) for r in windows.latest_per_key(df, "k", ["t"], **kwargs).collect()}
    reduced = {r.k: tuple(r) for r in windows._latest_reduced(df, ["k"], ["t"], ["flag"], [], ["note"], None).collect()}
    shuffled = {r.k: tuple(r) for r in windows._latest_shuffled(df, ["k"], ["t"], ["flag"], [], ["note"], None).collect()}
    assert got == reduced == shuffled and len(got) == 1501
    plan = windows._latest_shuffled(df, ["k"], ["t"], [], [], [], None)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") > plan.index("Sort") and plan.count("Sort [") == 1  # plans are printed from the top: the sort is above the shuffle


def test_open_windows_at_any_dates(spark):
    import random

    from ledgerlens.operators import joins

    rnd = random.Random(3)
    items = [(i, rnd.randrange(0, 3000), None if i % 9 == 0 else rnd.randrange(0, 3200)) for i in range(300)] + [(900, None, 50), (901, -5000, 9000)]
    dates = [(j, rnd.randrange(-100, 3100)) for j in range(60)] + [(99, 17), (98, 17)]
    at = lambda c: F.date_add(F.lit("2015-01-01").cast("date"), F.col(c))
    i = spark.createDataFrame(items, "i int, a int, b int").select("i", at("a").alias("s"), at("b").alias("e"))
    d = spark.createDataFrame(dates, "j int, c int").select("j", at("c").alias("d"))
    got = sorted((r.i, r.j, r.days_to_close) for r in joins.open_windows(i, d, "s", "e", "d").collect())
    want = sorted((x, j, None if b is None else b - c) for x, a, b in items for j, c in dates if a is not None and a <= c and (b is None or b >= c))
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 1000
