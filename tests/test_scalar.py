import math
from datetime import date, datetime

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from obsengine.functions.scalar import (
    available_year_days,
    blank_to_null,
    clamp_code,
    hour_number,
    hour_start,
    pct_validity,
    validity_flag,
)
from obsengine.operators.spine import SPINE_END, SPINE_START, date_spine
from obsengine.operators.staging import STAGING_COLUMNS, stage


def test_blank_to_null(spark):
    df = spark.createDataFrame([("",), ("44.1",), (None,)], "x string")
    cast = df.select(blank_to_null(F.col("x")).cast("double").alias("x"))
    assert [r.x for r in cast.collect()] == [None, 44.1, None]
    junk = spark.createDataFrame([("x",)], "x string")
    with pytest.raises(NumberFormatException):
        junk.select(blank_to_null(F.col("x")).cast("double")).collect()


def test_clamp_code(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 1, 7, None)], "x int")
    assert [r[0] for r in df.select(clamp_code(F.col("x"))).collect()] == [-1, 0, 1, 1, None]


def test_validity(spark):
    df = spark.createDataFrame([(18, 24), (17, 24), (None, 24), (5, 0)], "seen bigint, due int")
    got = df.select(
        pct_validity(F.col("seen"), F.col("due")), validity_flag(F.col("seen"), F.col("due"))
    ).collect()
    assert [tuple(r) for r in got] == [
        (75.0, "Si"),
        (70.833333, "No"),
        (None, "No"),
        (0.0, "No"),
    ]


def test_validity_compares_the_unrounded_share(spark):
    df = spark.createDataFrame([(7499999999, 10000000000)], "seen bigint, due bigint")
    got = df.select(
        pct_validity(F.col("seen"), F.col("due")), validity_flag(F.col("seen"), F.col("due"))
    ).first()
    assert tuple(got) == (75.0, "No")


def test_available_year_days(spark):
    cases = [
        (date(2024, 5, 1), date(2023, 1, 1), date(2025, 1, 1), 366),
        (date(2024, 5, 1), date(2024, 3, 1), date(2024, 3, 10), 10),
        (date(2023, 5, 1), date(2022, 3, 1), date(2023, 1, 1), 1),
    ]
    df = spark.createDataFrame(cases, "day date, lo date, hi date, want int")
    got = df.select(
        available_year_days(F.col("day"), F.col("lo"), F.col("hi")).alias("got"), "want"
    )
    assert all(r.got == r.want for r in got.collect())


@pytest.mark.parametrize("zone", ["UTC", "Europe/Rome"])
def test_hour_numbers_ignore_the_session_zone(spark, zone):
    # 02:30 on 2024-03-31 does not exist in Rome; zone-less hours do not care.
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = [datetime(2024, 3, 31, h) for h in (1, 2, 3)] + [datetime(1969, 12, 31, 23)]
        df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
        got = df.select(hour_number(F.col("t")).alias("n")).select(
            "n", hour_start(F.col("n")).alias("t")
        )
        found = got.collect()
        assert [r.t for r in found] == moments
        assert [r.n for r in found][1] - found[0].n == 1
        assert found[3].n == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_spine(spark):
    spine = date_spine(spark, "hour", SPINE_START, SPINE_END)
    got = spine.agg(F.count("*"), F.min("data_da"), F.max("data_da"), F.max("data_a")).first()
    assert tuple(got) == (2592, SPINE_START, datetime(2021, 3, 3, 23), SPINE_END)
    with pytest.raises(ValueError):
        date_spine(spark, "day")


def test_stage_location(spark):
    raw = spark.createDataFrame(
        [("u", "d", "v", "p", "c", "", "9.5", "", "e", "z", "dropped")],
        "COD_UBIC string, DESCR_UBIC string, VIA_UBIC string, COD_PROV string, COD_COM string,"
        "CMIRL_LAT string, CMIRL_LON string, DATA_DISATTIV string, COD_EU string,"
        "COD_TZONA string, OTHER string",
    )
    staged = stage("rqa_ubicazioni", raw)
    assert tuple(staged.first()) == ("u", "d", "v", "p", "c", None, 9.5, None, "e", "z")
    assert dict(staged.dtypes)["data_disattiv"] == "timestamp_ntz"
    assert len(STAGING_COLUMNS) == 15


def test_round_half_away_from_zero(spark):
    got = spark.sql("select round(2.5D), round(-2.5D)").first()
    assert (got[0], got[1]) == (3.0, -3.0) and math.copysign(1, got[1]) < 0
