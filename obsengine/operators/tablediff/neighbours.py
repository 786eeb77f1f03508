"""Linking rows that equal their counterpart beside a linked row."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsengine.operators.tablediff.context import with_positions
from obsengine.session import fresh_folder

# Rows of a table that one task looks through for the nearest linked row.
BLOCK_ROWS = 100_000


def _settled(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _with_anchor(rows: DataFrame, start: bool, block_rows: int) -> DataFrame:
    """Unlinked rows with ``anchor``: position and mate of the last linked row before them.

    The table is looked through in blocks of positions; one row a block passes the last linked
    row on.  With ``start`` the place before the first row counts as linked on both sides.
    """
    linked = F.when(F.col("mate").isNotNull(), F.struct("at", "mate"))
    placed = rows.withColumn("_linked", linked).withColumn("_block", F.floor(F.col("at") / block_rows))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    passed = (
        placed.groupBy("_block")
        .agg(F.max("_linked").alias("_last"))
        .select("_block", F.last("_last", ignorenulls=True).over(before).alias("_passed"))
    )
    inside = Window.partitionBy("_block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    near = F.last("_linked", ignorenulls=True).over(inside)
    none = F.lit(-1).cast("long")
    outside = F.struct(none.alias("at"), none.alias("mate")) if start else F.lit(None).cast(
        "struct<at: bigint, mate: bigint>"
    )
    return (
        placed.withColumn("_near", near)
        .join(passed, "_block")
        .withColumn("anchor", F.coalesce("_near", "_passed", outside))
        .where("mate is null and anchor is not null")
    )


def _outwards(left: DataFrame, right: DataFrame, start: bool, block_rows: int) -> DataFrame:
    """Positions ``l`` and ``r`` of unlinked rows that follow a linked pair at the same distance
    and, like all rows between, have equal texts."""
    mine = _with_anchor(left, start, block_rows).select(
        F.col("at").alias("l"), "a", "b", F.col("anchor.mate").alias("base"),
        (F.col("at") - F.col("anchor.at")).alias("steps"),
    )
    theirs = _with_anchor(right, start, block_rows).select(
        F.col("at").alias("r"), "a", "b", F.col("anchor.at").alias("base"),
        (F.col("at") - F.col("anchor.at")).alias("steps"),
    )
    met = mine.join(theirs, ["base", "steps", "a", "b"], "left")
    # The first row without its like ends what its linked row can reach.
    ends = met.where("r is null").groupBy("base").agg(F.min("steps").alias("_end"))
    reached = met.join(ends, "base", "left").where("_end is null or steps < _end")
    return reached.select("l", "r")


def link_neighbours(
    left: DataFrame,
    right: DataFrame,
    links: DataFrame,
    order: Sequence[str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """More pairs (left_id, right_id): unlinked rows that lie as far from a linked pair as their like.

    ``left`` and ``right`` have a number ``_id``, the text's digest ``a``, ``b`` and the columns of
    ``order``; ``links`` pairs numbers.  From every linked pair downwards, then from every linked
    pair (and the ends of both tables) upwards, rows are linked with the row at the same distance
    on the other side until texts differ or a linked row comes.  Each row is found by distance, so
    a long stretch of equal rows is no single task.  Runs jobs.
    """
    folder = fresh_folder(left.sparkSession, "neighbours")
    sides, sizes = [], []
    for name, df in (("left", left), ("right", right)):
        placed = with_positions(df.select("_id", "a", "b", *[F.col(f"`{c}`") for c in order]), [*order, "_id"], "at")
        sides.append(_settled(placed.select("_id", "a", "b", "at"), f"{folder}/{name}"))
        sizes.append(sides[-1].count())
    at_left, at_right = (
        side.select(F.col("_id").alias(f"{name}_id"), F.col("at").alias(name[0]))
        for name, side in (("left", sides[0]), ("right", sides[1]))
    )
    pairs = _settled(
        links.join(at_left, "left_id").join(at_right, "right_id").select("l", "r"), f"{folder}/pairs"
    )
    found = []
    for name in ("down", "up"):
        rows = []
        for side, own, other in ((sides[0], "l", "r"), (sides[1], "r", "l")):
            mates = pairs.select(F.col(own).alias("at"), F.col(other).alias("mate"))
            rows.append(side.join(mates, "at", "left"))
        if name == "up":  # the same from the other end
            for i, size in ((0, sizes[0]), (1, sizes[1])):
                mate = sizes[1 - i] - 1 - F.col("mate")
                rows[i] = rows[i].withColumns({"at": size - 1 - F.col("at"), "mate": mate})
        new = _outwards(*rows, start=name == "up", block_rows=block_rows)
        if name == "up":
            new = new.select(sizes[0] - 1 - F.col("l"), sizes[1] - 1 - F.col("r")).toDF("l", "r")
        found.append(_settled(new, f"{folder}/{name}"))
        pairs = pairs.union(found[-1])
    return found[0].union(found[1]).join(at_left, "l").join(at_right, "r").select("left_id", "right_id")
