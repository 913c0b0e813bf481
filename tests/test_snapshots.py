"""Stored snapshots: state at a date, change feed, gates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import joins
from ledgerlens.sources import bulletins, snapshots

SCHEMA = "k int, part string, v string, extra int"
DATES = ["2026-01-31", "2026-02-28", "2026-05-31", "2026-08-31"]


def store(spark, by_date, schema=SCHEMA):
    path = bulletins.scratch_path(spark, "test-store")
    for d, rows in by_date.items():
        bulletins.write_snapshot(spark.createDataFrame(rows, schema), path, d)
    return path


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_state_at_a_date_reads_one_folder(spark):
    path = store(spark, {d: [(i, "a", d, 0)] for i, d in enumerate(DATES)})
    at = lambda d: [r["v"] for r in snapshots.snapshot_at(spark, path, d).collect()]
    assert at("2026-03-15") == ["2026-02-28"] and at("2026-05-31") == ["2026-05-31"] and at("2030-01-01") == ["2026-08-31"]
    assert at("2026-01-30") == [] and snapshots.date_at(spark, path, "2026-01-30") is None
    plan = snapshots.snapshot_at(spark, path, "2026-03-15").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<k:int>" in plan
    cat = snapshots.catalogue(spark, path).orderBy("snapshot_date").collect()
    assert [str(r["snapshot_date"]) for r in cat] == DATES and all(r["files"] >= 1 and r["bytes"] > 0 for r in cat)


def test_feed_equals_pairwise_diffs(spark):
    rng = random.Random(3)
    by_date = {d: [(k, p, rng.choice(["x", "y", None]), k) for k in range(40) for p in ("a", None) if rng.random() < 0.6] for d in DATES}
    path = store(spark, by_date)
    got = rows(snapshots.change_feed(spark, path, ["k", "part"], ["v", "extra"]), "snapshot_date", "k", "part", "change", "old_v", "new_v", "old_extra", "new_extra")
    want = []
    for old, new in zip([None, *DATES], DATES):
        a, b = ({(k, p): (v, e) for k, p, v, e in by_date.get(d, [])} for d in (old, new))
        day = dt.date.fromisoformat(new)
        for key in a.keys() | b.keys():
            if a.get(key) != b.get(key):
                change = "added" if key not in a else "removed" if key not in b else "changed"
                (ov, oe), (nv, ne) = a.get(key, (None, None)), b.get(key, (None, None))
                want.append((day, *key, change, ov, nv, oe, ne))
    assert got == sorted(want, key=str)


def test_feed_on_null_keys_repeats_and_a_hot_key(spark):
    hot = [(7, "a", f"v{i % 3}", 0) for i in range(600)]
    path = store(spark, {DATES[0]: [(None, None, "n", 0), (None, None, "n", 0), (1, "a", "x", 0), (1, "a", "y", 0)], DATES[1]: hot + [(1, "a", "y", 0)], DATES[2]: [(7, "a", "v2", 0)]})
    got = rows(snapshots.change_feed(spark, path, "k", ["v"]), "snapshot_date", "k", "change", "old_v", "new_v")
    d = [dt.date.fromisoformat(x) for x in DATES]
    want = [(d[0], None, "added", None, "n")] * 2 + [(d[1], None, "removed", "n", None)] * 2
    want += [(d[0], 1, "added", None, "y"), (d[2], 1, "removed", "y", None), (d[1], 7, "added", None, "v2")]
    assert got == sorted(want, key=str)


def test_feed_with_an_empty_snapshot(spark):
    path = store(spark, {DATES[0]: [(1, "a", "x", 0)], DATES[1]: [], DATES[2]: [(1, "a", "x", 0)]})
    got = rows(snapshots.change_feed(spark, path, "k", ["v"]), "snapshot_date", "k", "change")
    d = [dt.date.fromisoformat(x) for x in DATES]
    assert got == [(d[0], 1, "added"), (d[1], 1, "removed"), (d[2], 1, "added")]
    assert snapshots.check_stored_monotone(spark, path).where("NOT passed").count() == 1  # the empty date has files, and no rows


def test_feed_is_one_shuffle(spark):
    path = store(spark, {d: [(k, "a", d, 0) for k in range(200)] for d in DATES[:2]})
    plan = snapshots.change_feed(spark, path, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "extra" not in plan


def test_refresh_status(spark):
    path = store(spark, {DATES[0]: [(1, "a", "x", 0), (2, "a", "x", 0)], DATES[1]: [(1, "a", "y", 0), (3, "a", "x", 0)], DATES[2]: [(1, "a", "z", 0), (3, "a", "x", 0), (4, "a", "x", 0)]})
    one = store(spark, {DATES[3]: [(1, "a", "x", 0)]})
    got = {r["gate"]: tuple(r)[1:] for r in snapshots.refresh_status(spark, {"g": (path, "k", ["v"]), "h": (one, "k", ["v"])}).collect()}
    d = [dt.date.fromisoformat(x) for x in DATES]
    assert got == {"g": (d[2], d[1], 3, 1, 1, 0), "h": (d[3], None, 1, 1, 0, 0)}
    known = snapshots.check_stored_ids(spark, path, DATES[0], DATES[2], "k").first()
    assert known["found"] == 1 and not known["passed"]


def test_a_stored_date_is_not_written_again(spark):
    path = store(spark, {DATES[0]: [(1, "a", "x", 0)]})
    with pytest.raises(FileExistsError):
        bulletins.write_snapshot(spark.createDataFrame([(2, "a", "x", 0)], SCHEMA), path, DATES[0])
    assert joins.snapshot_diff(snapshots.snapshot_at(spark, path, DATES[0]), snapshots.snapshot_at(spark, path, DATES[0]), "k", ["v"]).where(F.lit(True)).count() == 0
