"""Linking rows of several tables by key."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.operators.keys import same_keys
from obsengine.session import fresh_folder

# The key of an aligned row.  Each side is one struct, so no column can meet this name.
KEY = "_key"


# Tells the rows of repeated keys apart; 0 for all others.
_ALONE = "_alone"


def align_rows(
    sides: Mapping[str, DataFrame], keys: Sequence[str], keys_unique: bool = False
) -> DataFrame:
    """One row per key: the struct ``_key`` and one struct per side, NULL where it has no such row.

    Rows link only when their key is unique on their own side; every row whose
    key repeats there stands alone.  Such a row joins under a number of its own
    beside the key, so it meets no other row, no key can make the join uneven,
    and every side is read once.  NULL keys meet like any other.

    Unless ``keys_unique`` is set, runs a job that counts the keys and writes those
    that repeat.
    """
    repeated = None if keys_unique else _repeated(sides, keys)
    packed = {}
    for at, (name, df) in enumerate(sides.items()):
        rows = df.select(F.struct(*_columns(keys)).alias(KEY), F.struct("*").alias(name))
        if repeated is not None:
            mine = repeated.filter(F.col(f"_{name}") > 1).select(F.col("_keys").alias("_twice"))
            met = [F.col(f"{KEY}.`{k}`").eqNullSafe(F.col(f"_twice._{i}")) for i, k in enumerate(keys)]
            number = F.monotonically_increasing_id() * len(sides) + (at + 1)
            alone = F.when(F.col("_twice").isNotNull(), number).otherwise(F.lit(0).cast("long"))
            rows = rows.join(mine, reduce(lambda a, b: a & b, met), "left").select(
                KEY, name, alone.alias(_ALONE)
            )
        packed[name] = rows
    inner = [f"{KEY}.{k}" for k in keys] + ([] if repeated is None else [_ALONE])
    return reduce(lambda a, b: _meet(a, b, inner), packed.values()).select(KEY, *sides)


def _repeated(sides: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame | None:
    """Keys that occur twice on one side, as ``_keys``, and their rows per side; None if there are none.

    One tagged union of the key columns, counted before its one exchange.  Runs a job.
    """
    marked = [
        df.select(
            F.struct(*[F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)]).alias("_keys"),
            *[F.lit(int(other == name)).alias(f"_{other}") for other in sides],
        )
        for name, df in sides.items()
    ]
    counts = (
        reduce(DataFrame.union, marked)
        .groupBy("_keys")
        .agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in sides])
    )
    twice = reduce(lambda a, b: a | b, [F.col(f"_{name}") > 1 for name in sides])
    spark = counts.sparkSession
    folder = fresh_folder(spark, "repeated-keys")
    counts.filter(twice).write.parquet(folder)
    found = spark.read.schema(counts.schema).parquet(folder)
    return None if found.isEmpty() else found


def _meet(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    joined = a.alias("_a").join(b.alias("_b"), same_keys("_a", "_b", keys), "full")
    common = [c for c in (KEY, _ALONE) if c in a.columns]
    sides = [
        F.col(f"{t}.`{c}`") for t, df in (("_a", a), ("_b", b)) for c in df.columns if c not in common
    ]
    return joined.select(*[F.coalesce(f"_a.{c}", f"_b.{c}").alias(c) for c in common], *sides)


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]
