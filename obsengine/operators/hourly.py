"""Hourly measurements per level, and their daily and annual figures.

``unique_hours=True`` states that a series has at most one row per time (see
``operators.quality.has_unique_hours``).  A series then has at most 24 hourly rows
a day and 8784 a year, so rows are shuffled once, to their series and period, and
all else happens there.  Without that statement equal times are merged by a
pre-aggregation, so that no series, day or heap of copies is ever gathered.
"""

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from obsengine.functions.scalar import elapsed_days, theoretical_hours
from obsengine.functions.windows import run_hits, year_to_date
from obsengine.operators.keys import join_same_groups
from obsengine.operators.levels import (
    LEVELS,
    Level,
    explode_mask,
    in_any_level,
    level_mask,
    sum_by_level,
)
from obsengine.operators.percentiles import attach_to_groups, percentiles_of, placed_by_value
from obsengine.schema import LEVEL, SERIES

_YEAR_KEYS = [*SERIES, "anno", LEVEL]


def exceeds(value: Column, threshold: float) -> Column:
    """1 when the rounded value is over the threshold, else 0 (also for NULL).

    Values round half away from zero, so this is a comparison with the half step
    over the threshold; rounding every value would cost far more.
    """
    step = math.floor(threshold) + 0.5
    over = value >= step if step > 0 else value > step
    return F.when(over, F.lit(1)).otherwise(F.lit(0))


def _rows_of(prep: DataFrame, pollutant: str) -> DataFrame:
    return (
        prep.filter(F.col("sigla_param") == pollutant)
        .withColumn("data_day", F.col("data_da").cast("date"))
        .withColumn("anno", F.year("data_da"))
    )


def level_hours(
    prep: DataFrame, pollutant: str, near: str, levels: Sequence[Level] = LEVELS
) -> DataFrame:
    """Measurements of a pollutant, one row per level, placed by series and ``near``.

    ``near`` is ``data_day`` or ``anno``.  The rows are placed before they are
    repeated per level, and windows and groups within that period need no further
    shuffle.
    """
    placed = (
        _rows_of(prep, pollutant)
        .filter(in_any_level(levels))
        .select(*SERIES, "data_da", "data_day", "anno", "val_param", level_mask(levels).alias("_mask"))
        .repartition(*SERIES, near)
    )
    return explode_mask(placed, "_mask", levels)


def _day_window(*more: str) -> WindowSpec:
    return Window.partitionBy(*SERIES, *more, "data_day", LEVEL).orderBy("data_da")


def daily_figures(
    prep: DataFrame,
    pollutant: str,
    thresholds: Sequence[int],
    run_threshold: int,
    unique_hours: bool = False,
    levels: Sequence[Level] = LEVELS,
) -> DataFrame:
    """Per series, level and day: count, maximum, exceedances, runs of three hours.

    A run counts the rows left in the level, so a missing hour does not break it,
    and ends at midnight.  Among rows of one time the lower values come first.
    """
    value = F.col("val_param")
    flag = exceeds(value, run_threshold).cast("bigint")
    sums = {"n": value.isNotNull().cast("bigint"), "ones": flag, "zeros": 1 - flag}
    sums |= {f"over_{t}": exceeds(value, t).cast("bigint") for t in thresholds}
    if unique_hours:
        hours = level_hours(prep, pollutant, "data_day", levels)
        cells = hours.withColumns({**sums, "top": value})
    else:
        cells = sum_by_level(
            _rows_of(prep, pollutant),
            [*SERIES, "data_da", "data_day", "anno"],
            sums,
            {"top": value},
            levels,
            place_by=[*SERIES, "data_day"],
        )
    hits = run_hits(F.col("zeros"), F.col("ones"), _day_window())
    return (
        cells.withColumn("hits", hits)
        .groupBy(*SERIES, "data_day", "anno", LEVEL)
        .agg(
            F.sum("n").alias("count_val_param"),
            F.round(F.max("top")).alias("max_val_param"),
            *[F.sum(f"over_{t}").alias(f"count_over_{t}") for t in thresholds],
            F.sum("hits").alias("count_superi_3h"),
        )
    )


def with_year_to_date(daily: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Add running sums since the first available day of the year, and its age in days.

    The partition holds one row per day, 366 at most.
    """
    w = year_to_date(["anno", *SERIES, LEVEL], "data_day")
    first_day = F.min("data_day").over(w)
    return daily.select(
        "*",
        elapsed_days(F.col("data_day"), first_day).alias("available_days_ytd"),
        *[F.sum(expr).over(w).alias(name) for name, expr in sums.items()],
    )


def _merged_annual(
    prep: DataFrame,
    pollutant: str,
    thresholds: Sequence[int],
    shares: Mapping[str, float],
    stddev_digits: int | None,
    mean: tuple[float, int],
    levels: Sequence[Level],
) -> DataFrame:
    """Annual figures of hours with any number of rows, from one count of equal values.

    Rows are added up per series, year, mask and value before they are shuffled, and the
    levels repeat only those sums, which are written and feed every figure.  Runs jobs.
    """
    rows = _rows_of(prep, pollutant).filter(in_any_level(levels))
    once = (
        rows.withColumn("_mask", level_mask(levels))
        .groupBy(*SERIES, "anno", "_mask", F.col("val_param").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("data_day").alias("a"), F.max("data_day").alias("b"))
    )
    values = (
        explode_mask(once, "_mask", levels)
        .groupBy(*_YEAR_KEYS, "v")
        .agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"))
    )
    values = placed_by_value(values, _YEAR_KEYS, "v")

    v, n = F.col("v"), F.col("n")
    factor, digits = mean
    average = F.sum(v * n) / F.sum(F.when(v.isNotNull(), n))
    scaled = average if factor == 1.0 else average * factor
    annual = values.groupBy(*_YEAR_KEYS).agg(
        F.coalesce(F.sum(F.when(v.isNotNull(), n)), F.lit(0)).alias("count_val_param"),
        F.min("a").alias("first_day"),
        F.max("b").alias("last_day"),
        F.round(F.max(v)).alias("max_val_param"),
        F.round(scaled, digits).alias("mean_val_param"),
        *[F.sum(exceeds(v, t) * n).alias(f"count_over_{t}") for t in thresholds],
    )
    if stddev_digits is not None:
        # Squares are taken around the mean, so large values keep their digits.
        means = values.groupBy(*_YEAR_KEYS).agg(average.alias("_mean"))
        near = attach_to_groups(values.filter(v.isNotNull()), means, _YEAR_KEYS)
        gap = v - F.col("_mean")
        known = F.sum(n)
        deviation = F.sqrt(F.sum(gap * gap * n) / F.when(known > 1, known - 1))
        spread = near.groupBy(*_YEAR_KEYS).agg(
            F.round(deviation, stddev_digits).alias("stddev_val_param")
        )
        annual = join_same_groups(annual, spread, _YEAR_KEYS)
    if shares:
        exact = percentiles_of(values, _YEAR_KEYS, "v", "n", shares)
        annual = join_same_groups(annual, exact, _YEAR_KEYS)
        annual = annual.withColumns({name: F.round(name) for name in shares})
    return annual


def annual_figures(
    prep: DataFrame,
    pollutant: str,
    thresholds: Sequence[int] = (),
    run_threshold: int | None = None,
    percentiles: Mapping[str, float] | None = None,
    stddev_digits: int | None = None,
    mean: tuple[float, int] = (1.0, 0),
    unique_hours: bool = False,
    levels: Sequence[Level] = LEVELS,
) -> DataFrame:
    """Per series, level and year: counts, exceedances, runs, mean, spread, percentiles.

    Percentiles are exact and interpolated.  ``mean`` is a factor and the digits
    to round the scaled mean to.
    """
    value = F.col("val_param")
    factor, digits = mean
    average = F.avg(value) if factor == 1.0 else F.avg(value) * factor
    aggregates = [
        F.count(value).alias("count_val_param"),
        F.min("data_day").alias("first_day"),
        F.max("data_day").alias("last_day"),
        F.round(F.max(value)).alias("max_val_param"),
        F.round(average, digits).alias("mean_val_param"),
        *[F.sum(exceeds(value, t)).alias(f"count_over_{t}") for t in thresholds],
    ]
    if stddev_digits is not None:
        deviation = F.round(F.stddev_samp(value), stddev_digits)
        aggregates.append(deviation.alias("stddev_val_param"))
    shares = percentiles or {}
    if unique_hours:
        hours = level_hours(prep, pollutant, "anno", levels)
        if run_threshold is not None:
            flag = exceeds(value, run_threshold).cast("bigint")
            hours = hours.withColumn("ones", flag).withColumn("zeros", 1 - F.col("ones"))
            hits = run_hits(F.col("zeros"), F.col("ones"), _day_window("anno"))
            hours = hours.withColumn("hits", hits)
            aggregates.append(F.sum("hits").alias("count_superi_3h"))
        exact = [F.round(F.percentile(value, p)).alias(n) for n, p in shares.items()]
        annual = hours.groupBy(*_YEAR_KEYS).agg(*aggregates, *exact)
    else:
        annual = _merged_annual(
            prep, pollutant, thresholds, shares, stddev_digits, mean, levels
        )
        if run_threshold is not None:
            daily = daily_figures(prep, pollutant, [], run_threshold, levels=levels)
            runs = daily.groupBy(*_YEAR_KEYS).agg(F.sum("count_superi_3h").alias("count_superi_3h"))
            annual = join_same_groups(annual, runs, _YEAR_KEYS)
    first, last = F.col("first_day"), F.col("last_day")
    return annual.withColumn("available_days_in_year", elapsed_days(last, first)).withColumn(
        "available_hours_in_year", theoretical_hours(first, last)
    )
