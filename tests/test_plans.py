"""What the physical plans must and must not hold."""

import re
from datetime import datetime

import pytest

from checks.queries import QUERIES
from obsengine.operators.prep import data_prep
from obsengine.operators.tablediff.compare import diff_rows
from obsengine.operators.staging import stage
from obsengine.sources import events as ev
from obsengine.sources.snapshots import snapshot
from tests.conftest import SMALL

# The days of the events of the test tables.
JANUARY = datetime(2024, 1, 1), datetime(2024, 1, 31)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    n
    for n in QUERIES
    if not n.startswith(("layers", "ingest", "format", "diff_keyless", "diff_context"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_products(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word
    assert "SinglePartition" not in text or name in (
        "hourly_spine",  # one row: the first and last day
        "diff_summary",  # one row per count
        "drop_trailing_blank_rows",  # one row: the last filled position
    )


def exchanges(text):
    return re.findall(r"Exchange (\w+)\((.*?)\), (\w+)", text)


def test_daily_figures_shuffle_the_hours_once(spark):
    prep = ev.observations(ev.of_pollutants(ev.table(spark, SMALL, "events"), "NO2"))
    prep.createOrReplaceTempView("hours")
    from obsengine.operators.hourly import daily_figures, level_hours

    text = plan(daily_figures(prep, "NO2", [200], 400, unique_hours=True))
    # The first belongs to the hourly cells, the second places the hours by day.
    assert len(exchanges(text)) == 2
    annual = plan(level_hours(prep, "NO2", "anno"))
    assert len(exchanges(annual)) == 2


def test_unknown_hours_are_added_up_before_any_shuffle(spark):
    from obsengine.operators.hourly import daily_figures
    from obsengine.operators.rolling import moving_mean

    rows = ev.event_measurements(ev.of_pollutants(ev.table(spark, SMALL, "events"), "O3"))
    for df in (
        daily_figures(rows, "O3", [180], 240),
        moving_mean(rows, *JANUARY),
    ):
        # Read from the scan upwards, a partial sum comes before the first exchange.
        lines = [line for line in reversed(plan(df).split("\n")) if line.strip()]
        first = next(i for i, line in enumerate(lines) if "Exchange" in line)
        assert any("partial_sum" in line for line in lines[:first])
    # Once to add up, once to place by day; windows and groups follow there.
    assert len(exchanges(plan(daily_figures(rows, "O3", [180], 240)))) == 2


def test_annual_figures_shuffle_the_hours_once(spark):
    from obsengine.operators.hourly import annual_figures

    prep = ev.observations(ev.of_pollutants(ev.table(spark, SMALL, "events"), "O3"))
    text = plan(
        annual_figures(prep, "O3", [180], 240, {"p": 0.5}, stddev_digits=0, unique_hours=True)
    )
    assert len(exchanges(text)) == 2


def test_moving_mean_is_one_shuffle_and_two_windows(spark):
    text = plan(QUERIES["moving_8h"](spark, SMALL))
    assert len(exchanges(text)) == 2
    assert len(re.findall(r"\bWindow \[", text)) == 2


def test_three_levels_of_daily_means_are_one_aggregation(spark):
    text = plan(QUERIES["daily_mean_levels"](spark, SMALL))
    assert "Join" not in text
    assert text.count("FileScan") == 1


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["o3_daily"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*event_type", text) or "EqualTo(event_type" in text
    assert "props" not in text


def test_small_sides_are_broadcast_by_size_only(spark):
    events = ev.table(spark, SMALL, "events")
    sides = [
        stage("rqa_dati_aria_cor", ev.raw_measurements(events)),
        stage("rqa_configurazioni", ev.raw_configurations(events)),
        stage("rqa_parametri", ev.raw_parameters(events)),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(data_prep(*sides))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_declared_keys_join_once(spark):
    before, after = (snapshot(spark, SMALL, f"orders_{n}") for n in ("before", "after"))
    text = plan(diff_rows(before, after, ["o_orderkey"], keys_unique=True))
    assert text.count("FullOuter") == 1 and text.count("FileScan") == 2


@pytest.mark.parametrize("name", ["diff_keyed", "diff_duplicate_keys", "diff_summary", "diff3", "merge3"])
def test_every_side_is_read_once(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    sides = 3 if name in ("diff3", "merge3") else 2
    assert len(re.findall(r"FileScan parquet[^\n]*/orders\.parquet", text)) == sides


def test_equal_tables_are_not_joined(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from obsengine.operators.tablediff.compare import unequal_summary

    before = snapshot(spark, SMALL, "orders_before")

    def no_join(*_, **__):
        raise AssertionError("joined")

    monkeypatch.setattr(DataFrame, "join", no_join)
    assert unequal_summary(before, before.repartition(3), ["o_orderkey"]) is None


def test_gap_fill_is_dealt_to_many_tasks(spark):
    from obsengine.operators.spine import gap_fill

    series = spark.range(100_000).selectExpr(
        "cast(id as string) as cod_ubic", "1 as cod_conf", "'O3' as sigla_param",
        "timestamp_ntz'2024-01-01 00:00:00' as data_da", "timestamp_ntz'2024-01-01 01:00:00' as data_a",
        "1.0 as val_param", "0 as cod_valid", "'V' as cod_validaz", "'V' as cod_validaz_reg",
    )
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = plan(gap_fill(series, *JANUARY))
    assert re.search(rf"hashpartitioning\(.*, {parts}\), REPARTITION_BY_NUM", text)


def test_lookup_never_exchanges_on_codes_of_few_values(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large statistics
    try:
        text = plan(QUERIES["dim_lookup"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for code in ("cod_mis", "cod_freq", "station_cl_eu"):
        assert not [x for x in exchanges(text) if re.match(rf"(coalesce\()?{code}", x[1])]


def test_lookup_moves_parameters_before_the_wider_locations(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large statistics
    try:
        text = plan(QUERIES["dim_lookup"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\((?:coalesce\()?(\w+)", text)
    # The outermost exchange comes first: nothing is moved once the locations are joined.
    assert keys.index("cod_ubic") < keys.index("cod_param")
    assert "cod_ente" not in keys
