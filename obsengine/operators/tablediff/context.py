"""Operators that need the order of the rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.operators.tablediff.columns import ColumnChange
from obsengine.session import ensure_checkpoints, fresh_folder

_PARTITION_BITS = 33  # of monotonically_increasing_id: the rest counts within the partition

# Mean number of rows between those that a table may be cut at.
CUT_GAP = 1000


def with_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Number the rows from 0 in the given order, which must be total.

    The rows are range-partitioned and sorted in parallel, and checkpointed so
    that partition bounds and numbers stay the same in every later read.  Only
    one count per partition meets in a single task.  Runs a job.
    """
    ensure_checkpoints(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_ordinal", F.monotonically_increasing_id())
        .checkpoint()
    )
    piece = F.shiftrightunsigned("_ordinal", _PARTITION_BITS)
    placed = placed.withColumn("_piece", piece).withColumn(
        "_at", F.col("_ordinal") - F.shiftleft("_piece", _PARTITION_BITS)
    )
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so this window and broadcast are bounded.
    starts = (
        placed.groupBy("_piece")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_piece")
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_ordinal", "_piece", "_at", "_start")
    )


def with_piece(rows: DataFrame, order: Sequence[str], gap: int = CUT_GAP) -> DataFrame:
    """``_piece``: the number of the range of ``order`` that a row lies in.

    Ranges are cut at rows picked by a hash of ``order``, so every reading of the rows cuts them
    alike: of about one row in ``gap`` the one with the smallest hash in each of a fixed number of
    groups, twice the shuffle partitions.  Their order columns alone are written, as one row that
    reaches the tasks as a scalar, and a row finds its range by halving, one comparison a step.
    Runs a job.
    """
    spark = rows.sparkSession
    groups = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*[F.col(c).alias(f"c{at}") for at, c in enumerate(order)])
    drawn = F.xxhash64(F.lit("cut"), *order)
    drawn_cuts = (
        rows.select(place.alias("place"), drawn.alias("drawn"))
        .where(F.pmod("drawn", F.lit(gap)) == 0)
        .groupBy(F.pmod(F.xxhash64("drawn"), F.lit(groups)).alias("group"))
        .agg(F.min_by("place", "drawn").alias("place"))
        .agg(F.sort_array(F.collect_list("place")).alias("cuts"))
    )
    folder = fresh_folder(spark, "cuts")
    drawn_cuts.write.parquet(folder)
    cuts = spark.read.schema(drawn_cuts.schema).parquet(folder).scalar()
    placed = rows.withColumns({"_place": place, "_piece": F.lit(0)})
    for bit in reversed(range(groups.bit_length())):
        past = F.col("_piece") + (1 << bit)
        # Beyond the last cut there is NULL, which no row is past.
        placed = placed.withColumn(
            "_piece", F.when(F.get(cuts, past - 1) <= F.col("_place"), past).otherwise(F.col("_piece"))
        )
    return placed.drop("_place")


def near_or_edge(rows: DataFrame, order: Sequence[str], around: int, gap: int = CUT_GAP) -> DataFrame:
    """Rows within ``around`` of a changed one in their range, and both ends of every range.

    With ``_piece``, the range, and ``_at``, the number from 1 in it.  The rows are shuffled once,
    beside a reading of their order columns for the cuts.
    """
    if around < 0:
        raise ValueError("around must not be negative")
    ends = max(around, 1)
    by_place = Window.partitionBy("_piece").orderBy(*order)
    changed = F.col("action") != ""
    return (
        with_piece(rows, order, gap)
        .withColumns(
            {
                "_at": F.row_number().over(by_place),
                "_near": F.max(changed).over(by_place.rowsBetween(-around, around)),
                "_last": F.lead(F.lit(1), ends).over(by_place).isNull(),
            }
        )
        .where(F.col("_near") | (F.col("_at") <= ends) | F.col("_last"))
        .drop("_near", "_last")
    )


def with_context(
    rows: DataFrame, order: Sequence[str], around: int = 1, gap: int = CUT_GAP
) -> DataFrame:
    """Changed rows and up to ``around`` unchanged rows before and after each, with ``position``.

    ``rows`` is a difference with ``keep_equal``; ``order`` must be total, so end it with the key.
    The rows are cut into ranges of that order, and only those near a change or at the end of
    a range are written.  The ends tell how many rows a range holds and join neighbouring ranges.
    ``gap`` is the mean distance of the rows that ranges may be cut at.  Runs a job.
    """
    folder = fresh_folder(rows.sparkSession, "context")
    found = near_or_edge(rows, order, around, gap)
    found.write.parquet(folder)
    found = rows.sparkSession.read.schema(found.schema).parquet(folder)
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range, so this window is bounded; the last row of each range is there.
    starts = (
        found.groupBy("_piece")
        .agg(F.max("_at").alias("_rows"))
        .select("_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    placed = (
        found.join(F.broadcast(starts), "_piece")
        .withColumn("position", F.col("_start") + F.col("_at") - 1)
        .drop("_piece", "_at", "_start")
    )
    near = (
        placed.filter(F.col("action") != "")
        .select(
            F.explode(
                F.sequence(F.col("position") - around, F.col("position") + around)
            ).alias("position")
        )
        .distinct()
    )
    return placed.join(near, "position", "left_semi")


def drop_blank_rows(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Drop rows whose cells are all NULL or empty text.

    With ``order_by`` only those after the last filled row in that order are
    dropped; the ordering column itself does not count as a cell.  NULL comes first
    in that order, and blank rows level with the last filled row are kept.
    """
    filled = F.lit(False)
    for name in df.columns:
        if name != order_by:
            filled = filled | F.coalesce(F.col(f"`{name}`").cast("string") != "", F.lit(False))
    if order_by is None:
        return df.filter(filled)
    at = F.col(f"`{order_by}`")
    last = df.filter(filled).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("at")).first()
    if not last.n:
        return df.filter(filled)
    return df.filter(filled | at.isNull() | F.coalesce(at <= F.lit(last.at), F.lit(False)))


def prune_columns(
    diff: DataFrame, keys: Sequence[str], changes: Sequence[ColumnChange], around: int = 1
) -> DataFrame:
    """A difference without the cells of unchanged columns.

    Kept are the keys, columns with a changed cell, added, dropped and renamed ones, and up to
    ``around`` columns beside each of these in the order of ``changes``.  Runs a job that reads
    a row a column.
    """
    counted = diff.select(F.explode("changed").alias("name")).distinct().collect()
    touched = {r.name for r in counted}
    active = [c.name in touched or c.old != c.new for c in changes]
    near = {
        c.name
        for at, c in enumerate(changes)
        if any(active[max(0, at - around) : at + around + 1])
    }
    known = {f"{side}_{c.name}" for c in changes for side in ("old", "new")}
    shown = {f"{side}_{name}" for name in near for side in ("old", "new")}
    kept = [c for c in diff.columns if c in keys or c not in known or c in shown]
    return diff.select(*[F.col(f"`{c}`") for c in kept])
