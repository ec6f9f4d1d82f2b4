"""Every catalogue query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from compare import compare
from conftest import SF_SMALL
from tideline.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name not in ORACLES:
        assert df.count() > 0
        return
    ok, msg = compare(df, duck_small, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["start", "end", "item", "item_count"]
    assert df.count() > 0


def test_every_query_has_oracle_or_reason():
    missing = set(QUERIES) - set(ORACLES)
    assert missing == {"dedup_watermark"}


def test_results_do_not_depend_on_the_session_time_zone(spark, duck_small):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES["event_time"](spark, SF_SMALL)
        ok, msg = compare(df, duck_small, ORACLES["event_time"])
        assert ok, msg
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
