"""Checks on whole tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.schema import MEASUREMENT_KEY


class NotUnique(ValueError):
    """A table breaks its key."""


def duplicate_keys(df: DataFrame, keys: Sequence[str] = MEASUREMENT_KEY) -> DataFrame:
    """Key combinations that occur more than once, with their number of rows.

    Reads the key columns only and counts before the shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str] = MEASUREMENT_KEY) -> None:
    """Raise ``NotUnique`` with one example if a key repeats.  Runs a job."""
    example = duplicate_keys(df, keys).take(1)
    if example:
        raise NotUnique(f"key ({', '.join(keys)}) repeats, e.g. {example[0].asDict()}")


def has_unique_hours(prep: DataFrame) -> bool:
    """Whether every series has at most one row per hour start.  Runs a job.

    Stricter than the measurement key, which also holds the end of the hour.
    """
    return not duplicate_keys(prep, MEASUREMENT_KEY[:-1]).take(1)
