"""Ozone indicators."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.functions.scalar import validity_flag
from obsengine.operators.hourly import annual_figures, daily_figures, with_year_to_date
from obsengine.operators.indicators import (
    MIN_SHARE,
    AnnualIndicator,
    DailyIndicator,
    unpivot_indicators,
)
from obsengine.operators.levels import LEVELS, Level, pick_level
from obsengine.schema import SERIES

# Limits in µg/m3 and the texts of the ozone indicators.
INFORMATION_LIMIT = 180
ALARM_LIMIT = 240
LONG_TERM_LIMIT = 120
MIN_MOVING_MEANS = 18

DAILY_INDICATORS = (
    DailyIndicator(
        "Ozono (O3): valore massima media oraria",
        "", "", "",
        "max_val_param", "24", "count_val_param",
    ),
    DailyIndicator(
        "Ozono (O3): numero di medie orarie superiori al livello di informazione",
        "soglia informazione: 180 µg/m3", "", "",
        "count_over_information", "24", "count_val_param",
    ),
    DailyIndicator(
        "Ozono (O3): numero di medie orarie superiori al livello di informazione da inizio anno",
        "soglia informazione: 180 µg/m3", "", "",
        "ytd_over_information", "available_days_ytd * 24", "ytd_count_val",
    ),
    DailyIndicator(
        "Ozono (O3): numero di medie orarie superiori al livello di allarme",
        "soglia di allarme: 240 µg/m3", "per 3 ore consecutive", "4 ore consecutive = 2 superi",
        "count_superi_3h", "24", "count_val_param",
    ),
    DailyIndicator(
        "Ozono (O3): numero di medie orarie superiori al livello di allarme da inizio anno",
        "soglia di allarme: 240 µg/m3", "per 3 ore consecutive", "4 ore consecutive = 2 superi",
        "ytd_superi_3h", "available_days_ytd * 24", "ytd_count_val",
    ),
    DailyIndicator(
        "Ozono (O3): valore massima media 8 oraria",
        "", "", "",
        "max_mv_avg", "24", "count_mv_avg",
    ),
    DailyIndicator(
        "Ozono (O3): numero di giorni con medie su 8 ore massime giornaliere superiori al valore obiettivo a lungo termine da inizio anno",
        "obiettivo: 120 µg/m3", "", "",
        "ytd_8h_over_long_term", "available_days_ytd", "ytd_valid_days",
    ),
)

ANNUAL_INDICATORS = (
    AnnualIndicator(
        "Ozono (O3): numero di giorni con medie su 8 ore massime giornaliere superiori al valore obiettivo a lungo termine",
        "120 µg/m3", "", "",
        "days_over_long_term", "available_days_in_year", "valid_days_8h",
    ),
    AnnualIndicator(
        "Ozono (O3): numero di medie orarie superiori alla soglia di informazione",
        "180 µg/m3", "", "",
        "count_over_information", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Ozono (O3): numero di medie orarie superiori alla soglia di allarme",
        "240 µg/m3", "x 3 ore consecutive", "",
        "count_superi_3h", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Ozono (O3): valore media annuale",
        "", "", "",
        "mean_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Ozono (O3): 98° percentile",
        "", "", "",
        "p98_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Ozono (O3): deviazione standard",
        "", "", "",
        "stddev_val_param", "available_hours_in_year", "count_val_param",
    ),
    AnnualIndicator(
        "Ozono (O3): mediana",
        "", "", "",
        "median_val_param", "available_hours_in_year", "count_val_param",
    ),
)


@dataclass(frozen=True)
class O3Rules:
    """Limits, gates, levels and texts of the ozone indicators.

    ``moving`` tables must have been built for the same ``levels``.
    """

    information: float = INFORMATION_LIMIT
    alarm: float = ALARM_LIMIT
    long_term: float = LONG_TERM_LIMIT
    min_moving_means: int = MIN_MOVING_MEANS
    min_share: float = MIN_SHARE
    levels: Sequence[Level] = LEVELS
    daily: Sequence[DailyIndicator] = DAILY_INDICATORS
    annual: Sequence[AnnualIndicator] = ANNUAL_INDICATORS

    def pick(self, prefix: str):
        return pick_level({lv.code: F.col(f"{prefix}_{lv.code}") for lv in self.levels})


def _moving_mean_days(moving: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Per series and day, number and rounded maximum of the moving means of each level."""
    return (
        moving.filter(F.col("sigla_param") == "O3")
        .groupBy(*SERIES, F.col("data_da").cast("date").alias("data_day"))
        .agg(
            *[F.count(f"mv_avg_{lv.suffix}").alias(f"means_{lv.code}") for lv in levels],
            *[F.round(F.max(f"mv_avg_{lv.suffix}")).alias(f"top_{lv.code}") for lv in levels],
        )
    )


def _by_role(figures: DataFrame, rules: O3Rules) -> DataFrame:
    """The exceedances under the name of their limit, whatever its value."""
    over = F.col(f"`count_over_{rules.information}`")
    return figures.withColumn("count_over_information", over)


def o3_daily(
    prep: DataFrame, moving: DataFrame, unique_hours: bool = False, rules: O3Rules = O3Rules()
) -> DataFrame:
    """Daily ozone indicators; days without an hourly value at a level have none there."""
    daily = daily_figures(
        prep, "O3", [rules.information], rules.alarm, unique_hours, rules.levels
    )
    share = validity_flag(F.col("count_mv_avg"), F.lit(24), rules.min_share)
    figures = (
        _by_role(daily, rules)
        .join(_moving_mean_days(moving, rules.levels), SERIES + ["data_day"], "left")
        .withColumn("count_mv_avg", F.coalesce(rules.pick("means"), F.lit(0).cast("bigint")))
        .withColumn("max_mv_avg", rules.pick("top"))
        .withColumn("validita_8h", share)
    )
    valid = F.col("validita_8h") == "Si"
    over = valid & (F.col("max_mv_avg") > rules.long_term)
    running = with_year_to_date(
        figures,
        {
            "ytd_over_information": F.col("count_over_information"),
            "ytd_superi_3h": F.col("count_superi_3h"),
            "ytd_count_val": F.col("count_val_param"),
            "ytd_8h_over_long_term": F.when(over, 1).otherwise(0),
            "ytd_valid_days": F.when(valid, 1).otherwise(0),
        },
    )
    day = F.col("data_day").alias("data")
    return unpivot_indicators(running, day, rules.daily, min_share=rules.min_share)


def _moving_mean_years(moving: DataFrame, rules: O3Rules) -> DataFrame:
    """Per series, level and year: days with enough moving means, and those over the limit."""
    days = _moving_mean_days(moving, rules.levels)
    enough = {lv.code: F.col(f"means_{lv.code}") >= rules.min_moving_means for lv in rules.levels}
    over = {code: test & (F.col(f"top_{code}") > rules.long_term) for code, test in enough.items()}
    return days.groupBy(*SERIES, F.year("data_day").alias("anno")).agg(
        *[F.count_if(test).alias(f"valid_{code}") for code, test in enough.items()],
        *[F.count_if(test).alias(f"over_{code}") for code, test in over.items()],
    )


def o3_annual(
    prep: DataFrame, moving: DataFrame, unique_hours: bool = False, rules: O3Rules = O3Rules()
) -> DataFrame:
    """Annual ozone indicators."""
    annual = annual_figures(
        prep,
        "O3",
        [rules.information],
        rules.alarm,
        percentiles={"p98_val_param": 0.98, "median_val_param": 0.5},
        stddev_digits=0,
        unique_hours=unique_hours,
        levels=rules.levels,
    )
    none = F.lit(0).cast("bigint")
    figures = (
        _by_role(annual, rules)
        .join(_moving_mean_years(moving, rules), SERIES + ["anno"], "left")
        .withColumn("valid_days_8h", F.coalesce(rules.pick("valid"), none))
        .withColumn("days_over_long_term", F.coalesce(rules.pick("over"), none))
    )
    return unpivot_indicators(figures, F.col("anno"), rules.annual, min_share=rules.min_share)
