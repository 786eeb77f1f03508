"""Window expressions over measurement series."""

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def consecutive_sum(flag: Column, partition: list, order: list, steps: int = 3) -> Column:
    """Sum of a 0/1 flag over this row and the ``steps - 1`` rows before it.

    The frame counts rows, not clock hours: rows removed by an earlier filter do
    not break a run.  Put the day into ``partition`` so that runs end at midnight.
    """
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(-(steps - 1), 0)
    return F.sum(flag).over(w)


def run_hits(zeros: Column, ones: Column, w: WindowSpec) -> Column:
    """How many rows end a run of three flagged rows, for rows merged by time.

    Each window row stands for ``zeros`` unflagged and then ``ones`` flagged rows.
    Only the last two rows before matter, so two steps back are enough whatever
    the counts are.
    """
    none = F.lit(0)
    last_ones = F.coalesce(F.lag(ones, 1).over(w), none)
    last_zeros = F.coalesce(F.lag(zeros, 1).over(w), none)
    ones_before = F.coalesce(F.lag(ones, 2).over(w), none)
    carried = (
        F.when(last_ones >= 2, 2)
        .when((last_ones == 1) & ((last_zeros > 0) | (ones_before == 0)), 1)
        .when(last_ones == 1, 2)
        .otherwise(0)
    )
    run = ones + F.when(zeros == 0, carried).otherwise(0)
    return F.when(ones > 0, F.greatest(none, run - 2)).otherwise(none).cast("bigint")


def year_to_date(partition: list, day: str) -> WindowSpec:
    """Running frame from the first row of the partition to the current day."""
    return (
        Window.partitionBy(*partition)
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
