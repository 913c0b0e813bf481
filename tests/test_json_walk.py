"""The JSON walk's tasks: documents are dealt out evenly whatever the scan's splits, and a document's depth is found once."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.tree import json_tables, json_tree
from ledgerlens.session import spread

N = 4000


@pytest.fixture
def one_row_group(spark, tmp_path):
    """Documents in a file of one row group that the scan cuts into many splits: one of them has all rows."""
    path = str(tmp_path / "docs")
    doc = F.concat(F.lit('{"t":[{"a":'), F.col("id"), F.lit('},{"b":"[x"}],"u":[1,[2]]}'))
    spark.range(0, N, 1, 1).select("id", doc.alias("j")).write.parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def largest(df):
    return df.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("id").alias("n")).agg(F.max("n")).first()[0]


def test_one_row_group_in_many_splits(spark, one_row_group):
    cores = spark.sparkContext.defaultParallelism
    assert one_row_group.rdd.getNumPartitions() >= cores and largest(one_row_group) == N
    assert largest(spread(one_row_group)) <= N / cores


def test_even_and_empty_scans_stay(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 10 * cores, 1, cores)).rdd.getNumPartitions() == cores
    assert spread(spark.range(0, 50 * cores, 1, 5 * cores)).rdd.getNumPartitions() == 5 * cores
    assert spread(spark.range(0)).count() == 0


def test_json_tree_is_dealt_and_finds_the_depth_once(spark, one_row_group):
    out = json_tree(one_row_group, "id", "j")
    assert largest(out) <= N / spark.sparkContext.defaultParallelism
    assert out.count() == 9 * N
    assert out._jdf.queryExecution().optimizedPlan().toString().count("(?:\\\\.") == 1


def test_json_tree_deep_and_looking_like_containers(spark):
    deep = "[" * 40 + "]" * 40
    docs = [(1, deep), (2, '{"a":"\\u007bx","b":"[1]","c":[{"d":"{"}]}'), (3, '{"a":[1'), (4, None), (5, '{"s":"\\"[[","t":{"purpose":[{}]},"purpose":[1]}')]
    got = {(r.id, r.path): (r.kind, r.depth) for r in json_tree(spark.createDataFrame(docs, "id int, j string"), "id", "j").collect()}
    want = {(1, "$" + "[0]" * k): ("array", k) for k in range(1, 40)}
    want |= {(2, "$.a"): ("scalar", 1), (2, "$.b"): ("scalar", 1), (2, "$.c"): ("array", 1), (2, "$.c[0]"): ("object", 2), (2, "$.c[0].d"): ("scalar", 3)}
    want |= {(5, "$.s"): ("scalar", 1), (5, "$.t"): ("object", 1), (5, "$.t.purpose"): ("array", 2), (5, "$.t.purpose[0]"): ("object", 3)}
    assert got == want


def test_json_tables_are_dealt_and_find_the_depth_once(spark, one_row_group):
    out = json_tables(one_row_group, "id", "j")
    assert largest(out) <= N / spark.sparkContext.defaultParallelism
    assert out.count() == 4 * N
    assert out._jdf.queryExecution().optimizedPlan().toString().count("(?:\\\\.") == 1


def test_json_tables_of_lists_that_begin_with_an_object(spark):
    docs = [(1, ' [ {"a" : 1 } ,\n {"b":[{"c":"[{"}]} ]'), (2, '{"s":"[{\\"a\\":1}]","m":[{"a":1},2],"n":[2,{"a":1}],"e":[[],[{}]],"t":[{"a":2}]}'), (None, '[{"a":null}]')]
    got = {(r.id, r.path, r.row_no, r.column, r.cell) for r in json_tables(spark.createDataFrame(docs, "id int, j string"), "id", "j").collect()}
    assert got == {(1, "$", 0, "A", "1"), (1, "$", 0, "B", ""), (1, "$", 1, "A", ""), (1, "$", 1, "B", '[{"c":"[{"}]'), (1, "$[1].b", 0, "C", "[{"), (2, "$.t", 0, "A", "2"), (None, "$", 0, "A", "")}
