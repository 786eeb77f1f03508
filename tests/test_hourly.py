import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsengine.functions.windows import consecutive_sum
from obsengine.operators.daily_mean import daily_mean, daily_mean_levels
from obsengine.operators.hourly import annual_figures, daily_figures, exceeds
from obsengine.operators.levels import LEVELS, explode_levels
from obsengine.operators.percentiles import exact_percentiles
from obsengine.operators.quality import NotUnique, assert_unique, has_unique_hours
from obsengine.operators.rolling import moving_mean
from obsengine.operators.spine import gap_fill
from obsengine.plans.no2 import no2_annual, no2_daily, nox_annual
from obsengine.plans.o3 import o3_annual, o3_daily
from obsengine.schema import ANNUAL_SCHEMA, DAILY_SCHEMA, LEVEL
from tests.conftest import rows
from tests.frames import DAY, measurement, prep_frame

BOTH = pytest.mark.parametrize("unique", [True, False])


def shape(schema):
    return [(f.name, f.dataType) for f in schema]


def test_round_before_comparing(spark):
    df = spark.createDataFrame([(180.4,), (180.5,), (181.0,), (None,)], "v double")
    assert [r[0] for r in df.select(exceeds(F.col("v"), 180)).collect()] == [0, 1, 1, 0]


def test_levels_overlap(spark):
    prep = prep_frame(
        spark,
        [
            measurement(0, 1),
            measurement(1, 1, checked=None),
            measurement(2, 1, valid=1),
            measurement(3, 1, valid=1, certified=None),
            measurement(4, 1, valid=None, checked=None, certified=None),
        ],
    )
    got = explode_levels(prep).groupBy(F.hour("data_da").alias("h")).agg(
        F.sort_array(F.collect_set(LEVEL)).alias("l")
    )
    assert {r.h: r.l for r in got.collect()} == {0: ["VR", "VS", "VX"], 1: ["VR", "VS"], 2: ["VR"]}


def hits(spark, measurements, unique, threshold=240):
    daily = daily_figures(prep_frame(spark, measurements), "O3", [180], threshold, unique)
    return {
        r.data_day.isoformat() if r.data_day else None: r.count_superi_3h
        for r in daily.filter(F.col(LEVEL) == "VS").collect()
    }


@BOTH
def test_four_hours_are_two_hits(spark, unique):
    assert hits(spark, [measurement(h, 300) for h in range(4)], unique) == {"2024-03-10": 2}


@BOTH
def test_filtered_hour_does_not_break_a_run(spark, unique):
    data = [measurement(h, 300, valid=int(h == 3)) for h in (1, 2, 3, 4)]
    assert hits(spark, data, unique) == {"2024-03-10": 1}


@BOTH
def test_run_ends_at_midnight(spark, unique):
    data = [measurement(h, 300) for h in (22, 23, 24)]
    assert hits(spark, data, unique) == {"2024-03-10": 0, "2024-03-11": 0}


@BOTH
def test_unflagged_hour_breaks_a_run(spark, unique):
    data = [measurement(h, v) for h, v in enumerate([300, 300, 100, 300, 300, 300])]
    assert hits(spark, data, unique) == {"2024-03-10": 1}


def test_rows_without_time_are_one_group(spark):
    data = [measurement(None, v) for v in (300, 100, 300, 300, 300)]
    assert hits(spark, data, unique=False) == {None: 2}


def brute_daily(data, threshold):
    """Rows in time order, lower values first, three in a row over the threshold."""
    days = {}
    for m in data:
        if m[6] == 0:
            days.setdefault((m[0], m[3].date()), []).append((m[3], -1 if m[5] is None else m[5]))
    out = {}
    for key, values in days.items():
        flags = [v > threshold for _, v in sorted(values)]
        known = [v for _, v in values if v >= 0]
        out[key] = (
            len(known),
            sum(flags),
            sum(all(flags[i - 2 : i + 1]) for i in range(2, len(flags))),
        )
    return out


def test_merged_hours_equal_brute_force(spark):
    rng = random.Random(7)
    data = []
    for station in range(60):
        # One station in ten is a heap of copies of few hours.
        n, span = (400, 3) if station % 10 == 0 else (rng.randint(1, 40), 30)
        for _ in range(n):
            value = rng.choice([None, 100, 239, 241, 300])
            data.append(
                measurement(
                    rng.randrange(span), value, valid=int(rng.random() < 0.2), ubic=f"U{station}"
                )
            )
    daily = daily_figures(prep_frame(spark, data), "O3", [240], 240)
    got = {
        (r.cod_ubic, r.data_day): (r.count_val_param, r.count_over_240, r.count_superi_3h)
        for r in daily.filter(F.col(LEVEL) == "VS").collect()
    }
    assert got == brute_daily(data, 240)


def test_two_forms_of_the_run_agree(spark):
    rng = random.Random(3)
    data = [
        measurement(h, rng.choice([100, 300]), ubic=f"U{u}")
        for u in range(20)
        for h in range(72)
        if rng.random() < 0.8
    ]
    flagged = prep_frame(spark, data).withColumn("f", exceeds(F.col("val_param"), 240))
    day = F.col("data_da").cast("date")
    total = consecutive_sum(F.col("f"), ["cod_ubic", day], ["data_da"])
    frame = flagged.select("cod_ubic", day.alias("d"), total.alias("s")).groupBy("cod_ubic", "d")
    want = {(r.cod_ubic, r.d): r.n for r in frame.agg(F.count_if(F.col("s") == 3).alias("n")).collect()}
    daily = daily_figures(prep_frame(spark, data), "O3", [], 240, unique_hours=True)
    got = {
        (r.cod_ubic, r.data_day): r.count_superi_3h
        for r in daily.filter(F.col(LEVEL) == "VR").collect()
    }
    assert got == want


def random_prep(spark, seed, stations=25, days=5, duplicates=False):
    rng = random.Random(seed)
    data = []
    for station in range(stations):
        for hour in range(days * 24):
            if rng.random() < 0.25:
                continue
            for _ in range(rng.choice([1, 1, 3]) if duplicates else 1):
                data.append(
                    measurement(
                        hour,
                        rng.choice([None, *range(0, 400, 7)]),
                        valid=rng.choice([0, 0, 0, 1]),
                        checked=rng.choice(["V", "V", None]),
                        certified=rng.choice(["V", "V", "N"]),
                        ubic=f"U{station}",
                        sigla=rng.choice(["O3"]),
                        minutes=rng.choice([60] * 9 + [30]),
                    )
                )
    return prep_frame(spark, data)


@BOTH
@pytest.mark.parametrize("chunk", [5, 24, 672])
def test_moving_mean_equals_window_over_the_full_grid(spark, unique, chunk):
    prep = random_prep(spark, 11)
    start, end = DAY, DAY + timedelta(days=4, hours=5)
    got = moving_mean(prep, start, end, unique_hours=unique, chunk_hours=chunk)
    filled = gap_fill(prep, start, end)
    filled.createOrReplaceTempView("filled")
    parts, keep = [], []
    for level, cond in zip(
        LEVELS,
        ("cod_valid = 0", "cod_valid = 0 and cod_validaz = 'V'", "cod_validaz_reg = 'V'"),
    ):
        case = f"case when {cond} then val_param end"
        enough = f"count({case}) over w >= 6"
        parts += [
            f"case when {enough} then round(avg({case}) over w, 2) end as mv_avg_{level.suffix}",
            f"case when {enough} then count({case}) over w end"
            f" as valori_validi_mv_avg_{level.suffix}",
        ]
        keep.append(f"mv_avg_{level.suffix} is not null")
    want = spark.sql(
        f"""select * from (select data_da, data_a, cod_ubic, cod_conf, sigla_param,
          {", ".join(parts)} from filled
          window w as (partition by cod_ubic, cod_conf, sigla_param order by data_da
                       rows between 7 preceding and current row))
        where {" or ".join(keep)}"""
    )
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    assert got.count() > 100


def test_moving_mean_gate_and_early_hours(spark):
    prep = prep_frame(spark, [measurement(h, 10 * h) for h in range(6)])
    got = moving_mean(prep, DAY, DAY + timedelta(days=1), unique_hours=True)
    found = [(r.data_da.hour, r.mv_avg_val, r.valori_validi_mv_avg_val) for r in got.collect()]
    # Five values are too few at 4:00; 6:00 and 7:00 still see six; 8:00 does not.
    assert sorted(found) == [(5, 25.0, 6), (6, 25.0, 6), (7, 25.0, 6)]


def test_moving_mean_off_the_full_hour(spark):
    start = DAY + timedelta(minutes=30)
    prep = prep_frame(spark, [measurement(h, 1, start=start) for h in range(8)])
    got = moving_mean(prep, start, start + timedelta(days=1))
    assert min(r.data_da for r in got.collect()) == start + timedelta(hours=5)
    assert moving_mean(prep, DAY, DAY + timedelta(days=1)).isEmpty()


def test_moving_mean_merges_copies(spark):
    once = [measurement(h, 10 * h) for h in range(8)]
    prep = prep_frame(spark, once * 50)
    got = moving_mean(prep, DAY, DAY + timedelta(days=1)).filter("hour(data_da) = 7").first()
    assert (got.mv_avg_val, got.valori_validi_mv_avg_val) == (35.0, 400)


@BOTH
def test_annual_figures(spark, unique):
    prep = random_prep(spark, 5, stations=6, days=20)
    figures = annual_figures(
        prep,
        "O3",
        [180],
        240,
        percentiles={"p98": 0.98, "p50": 0.5},
        stddev_digits=2,
        unique_hours=unique,
    )
    data = [r for r in prep.collect() if r.cod_validaz_reg == "V"]
    for r in figures.filter(F.col(LEVEL) == "VR").collect():
        mine = [d.val_param for d in data if d.cod_ubic == r.cod_ubic and d.val_param is not None]
        assert r.count_val_param == len(mine)
        assert r.count_over_180 == sum(v > 180 for v in mine)
        assert r.p98 == np.floor(np.quantile(mine, 0.98) + 0.5)
        assert r.p50 == np.floor(np.quantile(mine, 0.5) + 0.5)
        assert r.stddev_val_param == pytest.approx(statistics.stdev(mine), abs=0.0051)
        assert r.available_hours_in_year == r.available_days_in_year * 24


@BOTH
def test_single_value_has_no_deviation(spark, unique):
    prep = prep_frame(spark, [measurement(0, 5)])
    got = annual_figures(prep, "O3", stddev_digits=0, unique_hours=unique).first()
    assert (got.stddev_val_param, got.count_val_param) == (None, 1)


@pytest.mark.parametrize("piece", [40, 250_000])
def test_exact_percentiles_of_uneven_groups(spark, piece):
    rng = np.random.default_rng(1)
    groups = {
        "wide": rng.normal(0, 100, 5000),
        "few": np.repeat([1.0, 2.0, 7.0], [3000, 10, 1]),
        "one": np.array([4.0]),
        "outlier": np.append(rng.random(999), 1e9),
        None: np.arange(10.0),
    }
    data = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("empty", None), ("one", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    shares = {"a": 0.0, "b": 0.5, "c": 0.98, "d": 1.0}
    got = exact_percentiles(df, ["g"], "v", shares, piece_values=piece)
    weighted = df.groupBy("g", "v").count()
    again = exact_percentiles(weighted, ["g"], "v", shares, weight="count", piece_values=piece)
    found = {r.g: (r.a, r.b, r.c, r.d) for r in got.collect()}
    assert found == {r.g: (r.a, r.b, r.c, r.d) for r in again.collect()}
    assert set(found) == set(groups)
    for name, values in groups.items():
        assert found[name] == pytest.approx(tuple(np.quantile(values, [0, 0.5, 0.98, 1])))


def test_daily_mean_gate(spark):
    data = [measurement(h, 10) for h in range(17)] + [
        measurement(h, 10, ubic="B") for h in range(18)
    ]
    got = daily_mean(prep_frame(spark, data), LEVELS[0])
    assert [(r.cod_ubic, r.valori_validi_gg_val) for r in got.collect()] == [("B", 18)]


def test_daily_sampler_with_enough_values_has_two_rows(spark):
    data = [measurement(h, 10, freq="CG") for h in range(18)]
    prep = prep_frame(spark, data)
    assert daily_mean(prep, LEVELS[0]).count() == 2
    assert daily_mean_levels(prep).count() == 8


def test_daily_sampler_without_values(spark):
    prep = prep_frame(spark, [measurement(0, None, freq="CG")])
    got = daily_mean(prep, LEVELS[0]).first()
    assert (got.media_giornaliera_val, got.valori_validi_gg_val) == (None, 0)


def test_null_keys_do_not_join_across_levels(spark):
    prep = prep_frame(spark, [measurement(h, 10, ubic=None) for h in range(18)])
    got = daily_mean_levels(prep)
    assert got.count() == 3
    filled = [
        sum(r[f"media_giornaliera_{lv.suffix}"] is not None for lv in LEVELS)
        for r in got.collect()
    ]
    assert filled == [1, 1, 1]


def test_year_change_restarts_the_running_sums(spark):
    eve = datetime(2023, 12, 31)
    prep = prep_frame(spark, [measurement(h, 300, start=eve) for h in range(48)])
    moving = moving_mean(prep, eve, eve + timedelta(days=2), unique_hours=True)
    daily = o3_daily(prep, moving, unique_hours=True).filter(
        (F.col(LEVEL) == "VS") & F.col("nome_indicatore").endswith("informazione da inizio anno")
    )
    got = {r.data.year: (r.valore, r.dati_teorici, r.valori_rilevati) for r in daily.collect()}
    assert got == {2023: (24.0, 24, 24), 2024: (24.0, 24, 24)}


def test_output_contracts(spark):
    data = [
        measurement(h, 50 + h, sigla=s, conf=c)
        for c, s in enumerate(["O3", "NO2", "NOX"])
        for h in range(30)
    ]
    prep = prep_frame(spark, data)
    moving = moving_mean(prep, DAY, DAY + timedelta(days=2))
    for daily in (o3_daily(prep, moving), no2_daily(prep, daily_mean_levels(prep))):
        assert shape(daily.schema) == shape(DAILY_SCHEMA)
    for annual in (o3_annual(prep, moving), no2_annual(prep)):
        assert shape(annual.schema) == shape(ANNUAL_SCHEMA)
    # Seven, five, seven and ten indicators at three levels.
    assert o3_daily(prep, moving).count() == 2 * 7 * 3
    assert no2_daily(prep, daily_mean_levels(prep)).count() == 2 * 5 * 3
    assert o3_annual(prep, moving).count() == 7 * 3
    assert no2_annual(prep).count() == 10 * 3


def test_missing_daily_mean(spark):
    prep = prep_frame(spark, [measurement(0, 50, sigla="NO2")])
    got = no2_daily(prep, daily_mean_levels(prep)).filter(
        F.col("nome_indicatore").endswith("media giornaliera")
    )
    assert {(r.valore, r.valori_rilevati, r.percentuale_validita, r.validita_indicatore)
            for r in got.collect()} == {(None, None, None, "No")}


def test_daily_mean_is_rounded_twice(spark):
    # 10.4951 rounds to 10.50 and then to 11.
    values = [10.4951] * 18
    prep = prep_frame(spark, [measurement(h, v, sigla="NO2") for h, v in enumerate(values)])
    got = no2_daily(prep, daily_mean_levels(prep)).filter(
        F.col("nome_indicatore").endswith("media giornaliera") & (F.col(LEVEL) == "VS")
    )
    assert got.first().valore == 11.0


def test_nox_as_no2(spark):
    prep = prep_frame(spark, [measurement(h, 10, sigla="NOX") for h in range(5)])
    got = nox_annual(prep).filter(F.col(LEVEL) == "VR").first()
    assert (got.valore, got.dati_teorici, got.valori_rilevati) == (19.1, 24, 5)


def test_unique_checks(spark):
    prep = prep_frame(spark, [measurement(0, 1), measurement(1, 1)])
    assert_unique(prep)
    assert has_unique_hours(prep)
    twice = prep.unionByName(prep)
    with pytest.raises(NotUnique):
        assert_unique(twice)
    # Two lengths of one hour keep the key but not the hour.
    other = prep.unionByName(prep_frame(spark, [measurement(0, 1, minutes=30)]))
    assert_unique(other)
    assert not has_unique_hours(other)


def test_plans_take_other_limits_gates_and_levels(spark):
    from dataclasses import replace
    from datetime import datetime, timedelta

    from obsengine.operators.levels import LEVELS
    from obsengine.operators.rolling import moving_mean
    from obsengine.plans.no2 import NO2Rules, no2_annual
    from obsengine.plans.o3 import O3Rules, o3_daily
    from obsengine.sources import events as ev

    start = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [(i * 30 + 1, start + timedelta(hours=i), 1, kind, 10.0 + i)
         for i in range(14) for kind in ("view", "click")],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    )
    prep = ev.observations(events)  # values 40, 44, ... 92
    moving = moving_mean(prep, start, start + timedelta(days=1), unique_hours=True)

    def daily(rules):
        found = o3_daily(prep, moving, unique_hours=True, rules=rules).collect()
        return {
            r.nome_indicatore.split(": ")[1]: (r.valore, r.validita_indicatore)
            for r in found if r.cod_liv_validazione == "VS"
        }

    name = "numero di medie orarie superiori al livello di informazione"
    assert daily(O3Rules())[name] == (0.0, "No")
    # Event ids of one hour in ten mark it as not valid, whatever the limit.
    above = [4 * (10 + i) for i in range(14) if (i * 30 + 1) % 10]
    assert daily(O3Rules(information=60, min_share=50))[name] == (sum(v > 60 for v in above), "Si")
    one = O3Rules(levels=LEVELS[:1])
    assert {r.cod_liv_validazione for r in o3_daily(prep, moving, True, one).collect()} == {"VS"}
    same = replace(NO2Rules(), limit=60, upper=60, lower=50.5)
    counts = [r.valore for r in no2_annual(prep, True, same).collect() if r.cod_liv_validazione == "VS"]
    assert counts[:3] == [sum(v > 60 for v in above)] * 2 + [sum(v > 50 for v in above)]


def test_merged_annual_figures_keep_the_digits_of_large_values(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    values = [1e9 + (i % 7) for i in range(100)] + [None]
    rows = [
        ("S", 1, "O3", start + timedelta(hours=i % 50), v, 0, "V", "V") for i, v in enumerate(values)
    ]
    prep = spark.createDataFrame(
        rows,
        "cod_ubic string, cod_conf int, sigla_param string, data_da timestamp_ntz,"
        " val_param double, cod_valid int, cod_validaz string, cod_validaz_reg string",
    )
    figures = annual_figures(prep, "O3", [5], percentiles={"p": 0.5}, stddev_digits=6)
    known = np.array(values[:-1])
    for r in figures.collect():
        assert r.count_val_param == 100 and r.count_over_5 == 100
        assert r.stddev_val_param == pytest.approx(known.std(ddof=1), abs=1e-6)
        assert (r.max_val_param, r.mean_val_param) == (known.max(), round(known.mean()))
