"""Validation levels: three overlapping subsets of the measurements.

A row may belong to several levels.  Instead of one filtered copy of a plan per
level, a row carries its levels as a bit mask and is repeated once per level as
late as possible; the level code then is part of every later group or window key.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.schema import LEVEL


@dataclass(frozen=True)
class Level:
    code: str
    name: str
    suffix: str
    condition: Callable[[], Column]


def _valid() -> Column:
    return F.col("cod_valid") == 0


def _valid_and_checked() -> Column:
    return _valid() & (F.col("cod_validaz") == "V")


def _certified() -> Column:
    return F.col("cod_validaz_reg") == "V"


# Codes, names and column suffixes of the validation levels.
LEVELS = (
    Level("VS", "Dati validi", "val", _valid),
    Level("VX", "Dati validi e validati COR", "val_cor", _valid_and_checked),
    Level("VR", "Dati certificati", "cert", _certified),
)


def in_any_level(levels: Sequence[Level] = LEVELS) -> Column:
    """Filter for rows in at least one level, in a form scans understand (NULL fails)."""
    return reduce(lambda a, b: a | b, [level.condition() for level in levels])


def level_mask(levels: Sequence[Level] = LEVELS) -> Column:
    """The levels of a row as the bits of one number, narrower than codes to shuffle."""
    bits = [F.when(level.condition(), 1 << at).otherwise(0) for at, level in enumerate(levels)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def in_level(mask: Column, at: int) -> Column:
    """Whether the mask holds the level at this place."""
    return mask.bitwiseAND(1 << at) != 0


def explode_mask(df: DataFrame, mask: str, levels: Sequence[Level] = LEVELS) -> DataFrame:
    """Repeat each row once per level of its mask, which is replaced by the level code.

    The possible code lists are literals, so no list is built per row, and the
    partitioning of ``df`` stays.
    """
    lists = [
        F.array(*[F.lit(lv.code) for at, lv in enumerate(levels) if mask_value >> at & 1])
        for mask_value in range(1 << len(levels))
    ]
    lists[0] = lists[0].cast("array<string>")
    codes = F.element_at(F.array(*lists), F.col(mask) + 1)
    return df.withColumn(LEVEL, F.explode(codes)).drop(mask)


def explode_levels(df: DataFrame, levels: Sequence[Level] = LEVELS) -> DataFrame:
    """Repeat each row once per level whose condition it meets."""
    return explode_mask(df.withColumn("_mask", level_mask(levels)), "_mask", levels)


def sum_by_level(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    maxima: Mapping[str, Column] | None = None,
    levels: Sequence[Level] = LEVELS,
    place_by: Sequence[str] | None = None,
) -> DataFrame:
    """Sums and maxima per keys and level.

    Rows are first added up per mask, of which there are few, so that the levels
    only repeat the groups and never the rows.  The groups are placed by some of
    their keys (``place_by``, all by default), and stay there in the result.
    """
    maxima = maxima or {}
    once = (
        df.filter(in_any_level(levels))
        .withColumn("_mask", level_mask(levels))
        .groupBy(*keys, "_mask")
        .agg(
            *[F.sum(e).alias(n) for n, e in sums.items()],
            *[F.max(e).alias(n) for n, e in maxima.items()],
        )
    )
    placed = once.repartition(*(place_by or keys))
    return (
        explode_mask(placed, "_mask", levels)
        .groupBy(*keys, LEVEL)
        .agg(*[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima])
    )


def level_name(levels: Sequence[Level] = LEVELS) -> Column:
    """Display name for the level code column."""
    return pick_level({level.code: F.lit(level.name) for level in levels})


def pick_level(by_code: Mapping[str, Column]) -> Column:
    """Choose among expressions by the level code of the row."""
    chosen = None
    for code, expr in by_code.items():
        test = F.col(LEVEL) == code
        chosen = F.when(test, expr) if chosen is None else chosen.when(test, expr)
    return chosen
