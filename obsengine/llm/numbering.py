"""Positions of rows in a total order, without a task that sees them all."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.components import settled
from obsengine.session import fresh_folder

_PARTITION_BITS = 33  # of monotonically_increasing_id: the rest counts within the partition


def numbered(df: DataFrame, group: str, order: Sequence[Column], name: str = "at") -> DataFrame:
    """``df`` with the position of each row, from 0, among the rows of its ``group``.

    The rows are range-partitioned by group and order, so neither a group nor a key of many rows
    is one task as long as the order tells its rows apart; they are sorted there and written,
    and only one count per partition and group is added up.  Rows level in ``order`` are
    numbered in an arbitrary but lasting order.  ``group`` is never null.
    """
    spark = df.sparkSession
    keys = [F.col(group), *order]
    placed = settled(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_row", F.monotonically_increasing_id()),
        fresh_folder(spark, "numbered"),
    ).withColumn("_piece", F.shiftrightunsigned("_row", _PARTITION_BITS))
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(group, "_piece")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    return (
        placed.join(starts, [group, "_piece"])
        .withColumn(name, F.col("_start") + F.col("_row") - F.col("_first"))
        .drop("_row", "_piece", "_start", "_first")
    )
