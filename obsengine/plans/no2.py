"""Nitrogen dioxide and nitrogen oxides indicators."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.operators.hourly import annual_figures, daily_figures, with_year_to_date
from obsengine.operators.indicators import (
    MIN_SHARE,
    AnnualIndicator,
    DailyIndicator,
    unpivot_indicators,
)
from obsengine.operators.levels import LEVELS, Level, pick_level
from obsengine.schema import SERIES

# Limits in µg/m3, the NOX to NO2 factor, and the indicator texts.
HOURLY_LIMIT = 200
UPPER_ASSESSMENT = 140
LOWER_ASSESSMENT = 100
ALARM_LIMIT = 400
NOX_AS_NO2 = 1.912

DAILY_INDICATORS = (
    DailyIndicator(
        "Biossido di azoto (NO2): numero di medie orarie superiori al valore limite orario",
        "200 µg/m3", "", "",
        "count_over_limit", "24", "count_val_param",
    ),
    DailyIndicator(
        "Biossido di azoto (NO2): numero di medie orarie superiori al valore limite orario da inizio anno",
        "200 µg/m3", "", "",
        "ytd_over_limit", "available_days_ytd * 24", "ytd_count_val",
    ),
    DailyIndicator(
        "Biossido di azoto (NO2): valore massimo orario",
        "", "", "",
        "max_val_param", "24", "count_val_param",
    ),
    DailyIndicator(
        "Biossido di azoto (NO2): numero di superamenti della soglia di allarme",
        "soglia di allarme: 400 µg/m3", "per 3 ore consecutive", "4 ore consecutive = 2 superi",
        "count_superi_3h", "24", "count_val_param",
    ),
)

DAILY_MEAN = DailyIndicator(
    "Biossido di azoto (NO2): valore media giornaliera",
    "", "", "",
    "mean", "24", "n",
)

ANNUAL_INDICATORS = (
    AnnualIndicator(
        "Biossido di azoto (NO2): numero di medie orarie superiori al limite",
        "200 µg/m3", "max 18/anno", "",
        "count_over_limit", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): numero di medie orarie superiori alla soglia UAT",
        "140 µg/m3", "max 18/anno", "",
        "count_over_upper", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): numero di medie orarie superiori alla soglia LAT",
        "100 µg/m3", "max 18/anno", "",
        "count_over_lower", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): valore massima media oraria",
        "", "", "",
        "max_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): numero di superamenti della soglia di allarme",
        "400 µg/m3", "x3 ore consecutive", "",
        "count_superi_3h", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): valore media annuale",
        "", "", "livello critico: 40 µg/m3, UAT: 32 µg/m3, LAT: 26 µg/m3",
        "mean_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): 98° percentile",
        "", "", "",
        "p98_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): deviazione standard",
        "", "", "",
        "stddev_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Biossido di azoto (NO2): mediana",
        "", "", "",
        "median_val_param", "available_hours_in_year", "count_val_param",
    ),
)

NOX_INDICATORS = (
    AnnualIndicator(
        "Ossidi di azoto (NOx): valore media annuale",
        "", "", "livello critico: 30 µg/m3 NO2, UAT: 24 µg/m3 NO2, LAT: 19.5 µg/m3 NO2",
        "mean_val_param", "available_hours_in_year", "count_val_param",
    ),
)


@dataclass(frozen=True)
class NO2Rules:
    """Limits, gates, levels and texts of the NO2 and NOX indicators.

    ``daily_mean`` tables must have been built for the same ``levels``.
    """

    limit: float = HOURLY_LIMIT
    upper: float = UPPER_ASSESSMENT
    lower: float = LOWER_ASSESSMENT
    alarm: float = ALARM_LIMIT
    nox_factor: float = NOX_AS_NO2
    min_share: float = MIN_SHARE
    levels: Sequence[Level] = LEVELS
    daily: Sequence[DailyIndicator] = DAILY_INDICATORS
    daily_mean: DailyIndicator = DAILY_MEAN
    annual: Sequence[AnnualIndicator] = ANNUAL_INDICATORS
    nox: Sequence[AnnualIndicator] = NOX_INDICATORS


def _by_role(figures: DataFrame, **limits: float) -> DataFrame:
    """Exceedances under the names of their limits, whatever the values."""
    return figures.withColumns(
        {f"count_over_{role}": F.col(f"`count_over_{value}`") for role, value in limits.items()}
    )


def _mean_rows(daily_mean: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """All daily-mean rows of a series and day in one array.

    The array has at most two rows per level to the power of the levels, eight:
    the gated mean and the daily-sampler one of each level.
    """
    pairs = [
        F.struct(
            F.round(f"media_giornaliera_{lv.suffix}").alias("mean"),
            F.col(f"valori_validi_gg_{lv.suffix}").alias("n"),
        ).alias(lv.code)
        for lv in levels
    ]
    return (
        daily_mean.filter(F.col("sigla_param") == "NO2")
        .dropna(subset=[*SERIES, "data"])
        .groupBy(*SERIES, F.col("data").alias("data_day"))
        .agg(F.collect_list(F.struct(*pairs)).alias("mean_rows"))
    )


def no2_daily(
    prep: DataFrame, daily_mean: DataFrame, unique_hours: bool = False, rules: NO2Rules = NO2Rules()
) -> DataFrame:
    """Daily NO2 indicators; the daily mean repeats as often as its source rows do."""
    daily = daily_figures(prep, "NO2", [rules.limit], rules.alarm, unique_hours, rules.levels)
    daily = _by_role(daily, limit=rules.limit)
    empty = F.lit(None).cast("struct<mean:double,n:bigint>")
    means = _mean_rows(daily_mean, rules.levels)
    picked = pick_level({lv.code: F.col(f"mean_rows.{lv.code}") for lv in rules.levels})
    with_means = daily.join(means, SERIES + ["data_day"], "left").withColumn(
        "level_means", F.coalesce(picked, F.array(empty))
    )
    running = with_year_to_date(
        with_means,
        {"ytd_over_limit": F.col("count_over_limit"), "ytd_count_val": F.col("count_val_param")},
    )

    def mean_row(r):
        return rules.daily_mean.row_of(r["mean"], F.lit(24), r["n"], rules.min_share)

    return unpivot_indicators(
        running,
        F.col("data_day").alias("data"),
        rules.daily,
        F.transform("level_means", mean_row),
        rules.min_share,
    )


def no2_annual(
    prep: DataFrame, unique_hours: bool = False, rules: NO2Rules = NO2Rules()
) -> DataFrame:
    """Annual NO2 indicators and the NOX mean as NO2."""
    return _no2_only(prep, unique_hours, rules).unionByName(nox_annual(prep, unique_hours, rules))


def _no2_only(prep: DataFrame, unique_hours: bool, rules: NO2Rules) -> DataFrame:
    limits = {"limit": rules.limit, "upper": rules.upper, "lower": rules.lower}
    figures = annual_figures(
        prep,
        "NO2",
        list(dict.fromkeys(limits.values())),
        rules.alarm,
        percentiles={"p98_val_param": 0.98, "median_val_param": 0.5},
        stddev_digits=2,
        unique_hours=unique_hours,
        levels=rules.levels,
    )
    figures = _by_role(figures, **limits)
    return unpivot_indicators(figures, F.col("anno"), rules.annual, min_share=rules.min_share)


def nox_annual(
    prep: DataFrame, unique_hours: bool = False, rules: NO2Rules = NO2Rules()
) -> DataFrame:
    """Annual NOX mean as NO2, with its own bounds and counts."""
    figures = annual_figures(
        prep, "NOX", mean=(rules.nox_factor, 1), unique_hours=unique_hours, levels=rules.levels
    )
    return unpivot_indicators(figures, F.col("anno"), rules.nox, min_share=rules.min_share)
