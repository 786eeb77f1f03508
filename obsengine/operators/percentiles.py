"""Exact percentiles of groups of any size."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.operators.keys import join_same_groups, same_keys
from obsengine.operators.prep import broadcast_if_small
from obsengine.session import fresh_folder

# Distinct values of a group that one task puts in order.
PIECE_VALUES = 250_000


def placed_by_value(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows sorted by group and value over the whole table, written with their number ``_id``.

    The table is cut into ranges of equal size, so a group of many values is many tasks.  Numbers
    rise with the order and have gaps between ranges.  Runs a job.
    """
    order = [*keys, value]
    spark = values.sparkSession
    sorted_rows = (
        values.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    folder = fresh_folder(spark, "values")
    sorted_rows.write.parquet(folder)
    return spark.read.schema(sorted_rows.schema).parquet(folder)


def attach_to_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their group, whose size decides between broadcast and shuffle."""
    return join_same_groups(rows, broadcast_if_small(groups), keys)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    weight: str | None = None,
    piece_values: int = PIECE_VALUES,
) -> DataFrame:
    """Interpolated percentiles per group, one column per named share; NULLs are ignored.

    The built-in exact percentile gathers all distinct values of a group in one
    task.  Here equal values are counted once and the counts put in order over the whole table;
    see ``percentiles_of``.  ``weight`` names a column that says how many rows a row stands for.
    Runs jobs.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(*keys, F.col(value).alias("_v")).agg(n.alias("_n"))
    return percentiles_of(placed_by_value(counts, keys, "_v"), keys, "_v", "_n", shares, piece_values)


def percentiles_of(
    placed: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    shares: Mapping[str, float],
    piece_values: int = PIECE_VALUES,
) -> DataFrame:
    """Percentiles of distinct values and their counts, as ``placed_by_value`` left them.

    Every ``piece_values`` consecutive rows are a piece, told by the row's number alone, whatever
    the number of pieces.  Running counts of the pieces of a group say which of them hold a
    wanted rank, and only these are looked into.
    """
    placed = placed.filter(F.col(value).isNotNull()).select(
        *keys,
        F.col(value).alias("_v"),
        F.col(weight).alias("_n"),
        F.floor(F.col("_id") / piece_values).alias("_piece"),
    )
    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    up_to = by_piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A row per group and piece from here to the join.
    sizes = (
        placed.groupBy(*keys, "_piece")
        .agg(F.sum("_n").alias("_size"))
        .withColumn("_end", F.sum("_size").over(up_to))
        .withColumn("_last", F.sum("_size").over(whole) - 1)
    )
    at = {name: F.lit(float(share)) * F.col("_last") for name, share in shares.items()}
    low = {name: F.floor(position) for name, position in at.items()}
    high = {name: F.ceil(position) for name, position in at.items()}

    def holds(rank: Column, start: Column, end: Column) -> Column:
        return (rank >= start) & (rank < end)

    start, end = F.col("_end") - F.col("_size"), F.col("_end")
    wanted = reduce(
        lambda a, b: a | b, [holds(r, start, end) for r in [*low.values(), *high.values()]]
    )
    found = sizes.filter(wanted).withColumn("_start", start).drop("_size", "_end")
    inside = Window.partitionBy(*keys, "_piece").orderBy("_v")
    ranked = (
        placed.alias("_a")
        .join(found.alias("_b"), same_keys("_a", "_b", [*keys, "_piece"]))
        .select("_a.*", "_b._start", "_b._last")
        .withColumn("_to", F.col("_start") + F.sum("_n").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_n"))
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when(holds(rank, F.col("_from"), F.col("_to")), F.col("_v")))

    ends = ranked.groupBy(*keys, "_last").agg(
        *[value_at(low[n]).alias(f"_low_{n}") for n in shares],
        *[value_at(high[n]).alias(f"_high_{n}") for n in shares],
    )
    return ends.select(
        *keys,
        *[
            (
                F.col(f"_low_{n}")
                + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * (at[n] - low[n])
            ).alias(n)
            for n in shares
        ],
    )
