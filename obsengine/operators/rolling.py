"""Moving means over clock hours."""

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsengine.functions.scalar import hour_number, hour_start, one_hour, seconds_past_hour
from obsengine.operators.levels import LEVELS, Level, in_any_level, in_level, level_mask
from obsengine.operators.spine import SPINE_END, SPINE_START, ntz
from obsengine.schema import SERIES

# Pollutants with a moving mean, window length, least valid hours.
MOVING_MEAN_POLLUTANTS = ("CO", "O3")
WINDOW_HOURS = 8
MIN_VALID_HOURS = 6

# Hours per window partition.  A series is cut into pieces of this length; each
# piece also gets the last hours of the piece before, 7 in 672 by default.
CHUNK_HOURS = 672


def moving_mean(
    prep: DataFrame,
    start: datetime = SPINE_START,
    end: datetime = SPINE_END,
    pollutants: Sequence[str] = MOVING_MEAN_POLLUTANTS,
    window_hours: int = WINDOW_HOURS,
    min_valid: int = MIN_VALID_HOURS,
    levels: Sequence[Level] = LEVELS,
    unique_hours: bool = False,
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Per level, mean and count over the ``window_hours`` clock hours up to each hour.

    Both are NULL under ``min_valid`` valid hours; hours NULL at every level are
    left out.  The result equals a row window over the gap-filled series, but the
    full series x spine grid is never built: only the empty hours are added that
    follow a measured one closely enough for the window to hold enough values.
    ``unique_hours=True`` states that a series has at most one row per hour and
    saves the pre-aggregation that merges the rows of an hour, all of which count.
    """
    if not 1 <= min_valid <= window_hours:
        raise ValueError("min_valid must lie between 1 and window_hours")
    tail = window_hours - 1
    # One hour may hold enough rows for the whole window unless hours are unique.
    spare = window_hours - min_valid if unique_hours else tail
    hours = (end - start) // timedelta(hours=1)
    past = timedelta(minutes=start.minute, seconds=start.second, microseconds=start.microsecond)
    end_hour = (start - datetime(1970, 1, 1)) // timedelta(hours=1) + hours
    on_spine = (
        (F.col("data_da") >= ntz(start))
        & (F.col("data_da") < ntz(start + timedelta(hours=hours)))
        & (seconds_past_hour(F.col("data_da")) == past.total_seconds())
        & (F.col("data_a") == F.col("data_da") + one_hour())
    )
    sums = [f"s_{level.suffix}" for level in levels]
    counts = [f"n_{level.suffix}" for level in levels]
    value, mask = F.col("val_param"), F.col("_mask")
    in_levels = [in_level(mask, at) for at in range(len(levels))]
    per_level = {s: F.when(kept, value) for s, kept in zip(sums, in_levels)}
    per_level |= {
        n: F.when(kept, F.lit(1).cast("bigint")) for n, kept in zip(counts, in_levels)
    }
    # A row without a value or a level is like an empty hour.
    cells = (
        prep.filter(F.col("sigla_param").isin(*pollutants) & in_any_level(levels) & on_spine)
        .dropna(subset=[*SERIES, "val_param"])
        .select(
            *SERIES,
            hour_number(F.col("data_da")).alias("hour"),
            "val_param",
            level_mask(levels).alias("_mask"),
        )
    )
    if not unique_hours:
        cells = cells.groupBy(*SERIES, "hour").agg(
            *[F.sum(e).alias(n) for n, e in per_level.items()]
        )
        per_level = {n: F.col(n) for n in per_level}

    def chunk(col):
        return F.floor(col / chunk_hours)

    reach = F.sequence(chunk(F.col("hour")), chunk(F.col("hour") + tail))
    # Neither list is ever empty; the outer form saves a filter that would build it twice.
    pieces = cells.withColumn("chunk", F.explode_outer(reach))
    by_hour = Window.partitionBy(*SERIES, "chunk").orderBy("hour")
    next_hour = F.coalesce(F.lead("hour").over(by_hour), F.col("hour") + spare + 1)
    own = F.col("at") == F.col("hour")
    filled = (
        pieces.withColumn("until", F.least(next_hour - 1, F.col("hour") + spare))
        .withColumn("at", F.explode_outer(F.sequence("hour", "until")))
        .select(*SERIES, "chunk", "at", *[F.when(own, e).alias(n) for n, e in per_level.items()])
    )
    frame = Window.partitionBy(*SERIES, "chunk").orderBy("at").rangeBetween(-tail, 0)
    enough = {n: F.col(n) >= min_valid for n in counts}
    windowed = (
        filled.select(
            *SERIES, "chunk", "at", *[F.sum(n).over(frame).alias(n) for n in sums + counts]
        )
        .filter((chunk(F.col("at")) == F.col("chunk")) & (F.col("at") < end_hour))
        # A count over the gate implies a mean.
        .filter(reduce(lambda a, b: a | b, enough.values()))
    )
    gated = []
    for level, s, n in zip(levels, sums, counts):
        mean = F.round(F.col(s) / F.col(n), 2)
        gated.append(F.when(enough[n], mean).alias(f"mv_avg_{level.suffix}"))
        gated.append(F.when(enough[n], F.col(n)).alias(f"valori_validi_mv_avg_{level.suffix}"))
    return (
        windowed.withColumn("data_da", hour_start(F.col("at")) + F.lit(past))
        .withColumn("data_a", F.col("data_da") + one_hour())
        .select("data_da", "data_a", *SERIES, *gated)
    )
