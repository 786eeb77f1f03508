"""Connected components of an edge table, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.session import fresh_folder


def settled(df: DataFrame, folder: str) -> DataFrame:
    """A table written to ``folder`` and read back."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _write(edges: DataFrame, folder: str) -> tuple[DataFrame, tuple]:
    written = settled(edges, folder)
    state = written.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return written, tuple(state)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes that have a link.

    ``edges`` has columns ``a`` and ``b`` of one sortable type.  Every step aggregates a
    smallest neighbour per node before it joins, so the neighbours of one node never meet in
    one task, and is written to the shared folder, so a lost executor costs one step.  The
    number of steps grows with the logarithm of the longest chain.
    """
    folder = fresh_folder(edges.sparkSession, "components")
    linked = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current, state = _write(linked.distinct(), f"{folder}/0")
    step = 0
    while state[0]:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            current.select("b", "a")
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = settled(least.select("u", F.least("u", "m").alias("m")), f"{folder}/least-{step}")
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = settled(large, f"{folder}/large-{step}")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        pulled = large.join(down, "a").where(F.col("b") != F.col("m")).select("b", "m")
        small = down.toDF("a", "b").union(pulled.toDF("a", "b")).distinct()
        step += 1
        before = state
        current, state = _write(small, f"{folder}/{step}")
        if state == before:
            break
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(current.select("b", "b").distinct()).distinct()
