"""Comparing tables by sums of row hashes, which do not depend on the order of the rows."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.session import fresh_folder

# Keys fall into so many buckets; a bucket is one row of the first exchange.
BUCKETS = 65_536

_SUMS = ("_first", "_second")


def _hashes(columns: Sequence[Column], seed: int) -> Column:
    """64 bits over cells and whether they are NULL, so a cell that moves changes them."""
    parts = [part for c in columns for part in (c.isNull(), c)]
    return F.xxhash64(F.lit(seed), *parts)


def _packed(
    df: DataFrame, key: Sequence[Column], columns: Sequence[str], buckets: int
) -> DataFrame:
    """The whole row, its key and its bucket, as columns no table's column can meet."""
    return df.select(
        F.struct("*").alias("_row"),
        F.struct(*[k.alias(f"_{i}") for i, k in enumerate(key)]).alias("_key"),
        F.pmod(_hashes(key, 3), F.lit(buckets)).alias("_bucket"),
        *[
            _hashes([F.col(f"`{c}`") for c in columns], seed).cast("decimal(38,0)").alias(name)
            for seed, name in ((1, "_first"), (2, "_second"))
        ],
    )


def _unequal(sides: Sequence[DataFrame], group: str, folder: str) -> DataFrame:
    """Groups whose row counts and sums of hashes are not the same on both sides; written."""
    signed = [
        df.select(group, F.lit(sign).alias("_rows"), *[(F.col(n) * sign).alias(n) for n in _SUMS])
        for df, sign in zip(sides, (1, -1))
    ]
    names = ("_rows", *_SUMS)
    apart = (
        reduce(DataFrame.union, signed)
        .groupBy(group)
        .agg(*[F.sum(n).alias(n) for n in names])
        .filter(reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names]))
        .select(group)
    )
    apart.write.parquet(folder)
    return apart.sparkSession.read.schema(apart.schema).parquet(folder)


def unequal_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    key: Column | None = None,
    buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame, int] | None:
    """Rows of keys that do not have the same rows, equally often, on both sides; None if all do.

    Also returns how many rows of either side are left out.  Hashes are added up per bucket of
    keys first: a row a bucket and task is all that is shuffled while tables are equal, and both
    are read once.  Then keys of the buckets that differ are added up, and their rows are found
    by a join with these keys.  ``key`` is a key text to be used instead of the key columns.
    Tables of other columns or types are unequal wherever they have rows.  Runs jobs.
    """
    if set(left.dtypes) != set(right.dtypes):
        return None if left.isEmpty() and right.isEmpty() else (left, right, 0)
    folder = fresh_folder(left.sparkSession, "digests")
    by = [F.col(f"`{k}`") for k in keys] if key is None else [key]
    sides = [_packed(df, by, right.columns, buckets) for df in (left, right)]
    found = _unequal(sides, "_bucket", f"{folder}/buckets")
    if found.isEmpty():
        return None
    near = [side.join(found, "_bucket", "left_semi") for side in sides]
    unequal = _unequal(near, "_key", f"{folder}/keys")
    met = reduce(
        lambda a, b: a & b,
        [F.col(f"_a._key._{i}").eqNullSafe(F.col(f"_b._key._{i}")) for i in range(len(by))],
    )
    rest = [
        side.alias("_a").join(unequal.alias("_b"), met, "left_semi").select("_row.*") for side in near
    ]
    return rest[0], rest[1], left.count() - rest[0].count()
