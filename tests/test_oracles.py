"""Every registered query against its SQL, over whole tables."""

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(MEDIUM)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, QUERIES[name], ORACLES[name], MEDIUM) is None


@pytest.mark.parametrize("name", ["fct_daily", "data_prep", "gap_fill", "stage_rqa_ubicazioni"])
def test_results_do_not_depend_on_the_session_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert difference(spark, duck, QUERIES[name], ORACLES[name], MEDIUM) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", ["dim_lookup", "fct_annual", "diff_duplicate_keys", "apply_patch"])
def test_results_do_not_depend_on_the_join_strategy(spark, duck, name):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        assert difference(spark, duck, QUERIES[name], ORACLES[name], MEDIUM) is None
    finally:
        for key in changed:
            spark.conf.unset(key)


def test_entry(spark):
    import __spark_entry__ as entry_module

    result = entry_module.entry(spark)
    assert result.count() > 0
    assert difference(
        spark, connect(SMALL), QUERIES["fct_daily"], ORACLES["fct_daily"], SMALL
    ) is None
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_module.queries()) >= set(QUERIES)
    assert entry_module.oracle_sql().items() >= ORACLES.items()


def test_a_swap_in_the_product_turns_a_check_red(spark, monkeypatch):
    from obsengine.operators import staging

    name = "rqa_t_reti"
    query, sql = QUERIES[f"stage_{name}"], ORACLES[f"stage_{name}"]
    assert difference(spark, connect(SMALL), query, sql, SMALL) is None
    swapped = [("DESCR_T_RETE", "string", "t_rete"), ("T_RETE", "string", "descr_t_rete")]
    monkeypatch.setitem(staging.STAGING_COLUMNS, name, swapped)
    assert difference(spark, connect(SMALL), query, sql, SMALL) is not None
