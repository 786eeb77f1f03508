"""The two published tables."""

from pyspark.sql import DataFrame


def fct_daily(o3: DataFrame, no2: DataFrame) -> DataFrame:
    """All daily indicators."""
    return o3.unionByName(no2)


def fct_annual(o3: DataFrame, no2: DataFrame) -> DataFrame:
    """All annual indicators."""
    return o3.unionByName(no2)
