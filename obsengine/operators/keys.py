"""Joins on keys that may be NULL, where NULL meets NULL."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(a: str, b: str, keys: Sequence[str]) -> Column:
    """Join condition between two aliased tables."""
    return reduce(
        lambda x, y: x & y, [_of(a, k).eqNullSafe(_of(b, k)) for k in keys]
    )


def _of(alias: str, key: str) -> Column:
    """A key column, or a field of the key struct."""
    struct, dot, name = key.partition(".")
    return F.col(f"{alias}.{struct}.`{name}`") if dot and struct == "_key" else F.col(f"{alias}.`{key}`")


def join_same_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the keys, keeping one copy of them."""
    extra = [c for c in right.columns if c not in keys]
    return (
        left.alias("_a")
        .join(right.alias("_b"), same_keys("_a", "_b", keys), "left")
        .select("_a.*", *[F.col(f"_b.`{c}`") for c in extra])
    )
