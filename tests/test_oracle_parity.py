"""Every registered query against its DuckDB oracle at sf0.01 (row count, names, values)."""

import pytest

from conftest import SF_CHECK, SF_SMALL
from oracle import compare


def _names(with_sql: bool):
    from ledgerlens.plans.catalog import load

    return sorted(n for n, e in load().items() if bool(e.sql) == with_sql)


@pytest.mark.parametrize("name", _names(True))
def test_matches_oracle(spark, registry, duck_check, name):
    e = registry[name]
    compare(e.build(spark, SF_CHECK), duck_check, e.sql)


@pytest.mark.parametrize("name", _names(False) or ["<none>"])
def test_rows_only(spark, registry, name):  # queries without an oracle (none at present)
    if name == "<none>":
        pytest.skip("every query has an oracle")
    df = registry[name].build(spark, SF_SMALL)
    assert df.count() > 0
    assert df.schema == registry[name].build(spark, SF_SMALL).schema


@pytest.mark.parametrize("name", ["daily_counts_batch", "interval_open", "register_point_range", "asof_vintage", "fiscal_rollup", "stem_title"])
def test_session_time_zone_does_not_matter(spark, registry, duck_check, name):
    """Wall-clock (timestamp_ntz) inputs give the same answer in any session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        e = registry[name]
        compare(e.build(spark, SF_CHECK), duck_check, e.sql)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
