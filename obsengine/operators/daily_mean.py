"""Daily means with a coverage gate."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.operators.levels import LEVELS, Level, in_any_level, in_level, level_mask
from obsengine.schema import SERIES

# Least valid hours of a day, frequency code of daily samplers.
MIN_VALID_HOURS = 18
DAILY_FREQUENCY = "CG"


def _has_row(level: Level, min_valid: int) -> Column:
    return (F.col(f"count_{level.suffix}") >= min_valid) | (F.col(f"cg_rows_{level.suffix}") > 0)


def _candidates(level: Level, min_valid: int) -> Column:
    """The day's rows of one level: the gated mean, then the ungated daily-sampler one."""

    def row(prefix: str) -> Column:
        return F.struct(
            F.col(f"{prefix}mean_{level.suffix}").alias("mean"),
            F.col(f"{prefix}count_{level.suffix}").alias("n"),
        )

    gated, daily = row(""), row("cg_")
    enough = F.col(f"count_{level.suffix}") >= min_valid
    sampled = F.col(f"cg_rows_{level.suffix}") > 0
    return (
        F.when(enough & sampled, F.array(gated, daily))
        .when(enough, F.array(gated))
        .when(sampled, F.array(daily))
    )


def _per_day(prep: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Mean, count and daily-sampler share of every level in one row per series and day.

    Values are added up per set of levels first: three running figures per row to
    shuffle, whatever the number of levels.
    """
    value = F.col("val_param")
    parts = (
        prep.filter(in_any_level(levels))
        .groupBy(
            *SERIES,
            F.col("data_da").cast("date").alias("data"),
            level_mask(levels).alias("_mask"),
            F.coalesce(F.col("cod_freq") == DAILY_FREQUENCY, F.lit(False)).alias("_daily"),
        )
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"), F.count("*").alias("_rows"))
    )

    def figures(kept: Column, prefix: str, suffix: str) -> list[Column]:
        none = F.lit(0).cast("bigint")
        n = F.coalesce(F.sum(F.when(kept, F.col("_n"))), none)
        mean = F.sum(F.when(kept, F.col("_sum"))) / F.nullif(n, none)
        return [
            F.round(mean, 2).alias(f"{prefix}mean_{suffix}"),
            n.alias(f"{prefix}count_{suffix}"),
        ]

    aggregates = []
    for at, level in enumerate(levels):
        kept = in_level(F.col("_mask"), at)
        daily = kept & F.col("_daily")
        aggregates += figures(kept, "", level.suffix)
        aggregates += figures(daily, "cg_", level.suffix)
        aggregates.append(F.sum(F.when(daily, F.col("_rows"))).alias(f"cg_rows_{level.suffix}"))
    return parts.groupBy(*SERIES, "data").agg(*aggregates)


def daily_mean(prep: DataFrame, level: Level, min_valid: int = MIN_VALID_HOURS) -> DataFrame:
    """Daily mean and count of one level.

    A day counts with ``min_valid`` values.  Daily samplers also count without
    the gate, so one of them with enough values has two rows for that day.
    """
    return (
        _per_day(prep, [level])
        .filter(_has_row(level, min_valid))
        .select(*SERIES, "data", F.inline_outer(_candidates(level, min_valid)))
        .select(
            *SERIES,
            F.col("mean").alias(f"media_giornaliera_{level.suffix}"),
            F.col("n").alias(f"valori_validi_gg_{level.suffix}"),
            "data",
        )
    )


def daily_mean_levels(
    prep: DataFrame, levels: Sequence[Level] = LEVELS, min_valid: int = MIN_VALID_HOURS
) -> DataFrame:
    """Daily means of all levels side by side, as full joins of the levels would give.

    One aggregation computes every level, so no join is needed: the rows of a key
    (at most two per level) are combined within the aggregated row.  Full joins
    never match NULL keys, so there each level's rows stand alone.
    """
    suffixes = [level.suffix for level in levels]
    empty = F.lit(None).cast("struct<mean:double,n:bigint>")
    any_row = reduce(lambda a, b: a | b, [_has_row(level, min_valid) for level in levels])
    days = (
        _per_day(prep, levels)
        .filter(any_row)
        .select(
            "data", *SERIES, *[_candidates(lv, min_valid).alias(f"_{lv.suffix}") for lv in levels]
        )
    )

    def combined(done: dict, left: list) -> Column:
        if not left:
            return F.array(F.struct(*[v.alias(k) for k, v in done.items()]))
        rows = F.coalesce(F.col(f"_{left[0]}"), F.array(empty))
        return F.flatten(F.transform(rows, lambda r: combined({**done, left[0]: r}, left[1:])))

    def alone(suffix: str) -> Column:
        rows = F.coalesce(F.col(f"_{suffix}"), F.array().cast("array<struct<mean:double,n:bigint>>"))
        return F.transform(
            rows, lambda r: F.struct(*[(r if k == suffix else empty).alias(k) for k in suffixes])
        )

    null_key = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in [*SERIES, "data"]])
    rows = F.when(null_key, F.concat(*[alone(s) for s in suffixes])).otherwise(
        combined({}, suffixes)
    )
    measures = []
    for suffix in suffixes:
        measures.append(F.col(f"{suffix}.mean").alias(f"media_giornaliera_{suffix}"))
        measures.append(F.col(f"{suffix}.n").alias(f"valori_validi_gg_{suffix}"))
    return days.select("data", *SERIES, F.inline_outer(rows)).select("data", *SERIES, *measures)
