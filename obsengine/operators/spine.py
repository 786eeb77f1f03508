"""Hourly spine and gap filling."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.functions.scalar import one_hour
from obsengine.schema import SERIES

# The period of the reference data set, first hour and end (excluded).
SPINE_START = datetime(2020, 11, 16)
SPINE_END = datetime(2021, 3, 4)

# Hours of one series that one row of the grid stands for before its hours are made.
CHUNK_HOURS = 168


def ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def spine_hours(start: Column, end: Column) -> Column:
    """Array of the hour starts in the half-open period ``[start, end)``."""
    last = end - one_hour()
    return F.when(last >= start, F.sequence(start, last, one_hour()))


def date_spine(
    spark: SparkSession, datepart: str, start: datetime = SPINE_START, end: datetime = SPINE_END
) -> DataFrame:
    """Distributed half-open series of hours as (data_da, data_a)."""
    if datepart != "hour":
        raise ValueError(f"date_spine supports datepart='hour' only, not {datepart!r}")
    hours = max(0, (end - start) // timedelta(hours=1))
    return spark.range(hours).select(
        (ntz(start) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("data_da"),
        (ntz(start) + F.make_dt_interval(hours=(F.col("id") + 1).cast("int"))).alias("data_a"),
    )


def period(moments: DataFrame, column: str) -> tuple[datetime, datetime] | None:
    """Whole days from the first to the last moment, as start and end (excluded).  Runs a job."""
    day = F.col(column).cast("date")
    ends = moments.agg(
        F.min(day).cast("timestamp_ntz").alias("start"),
        F.date_add(F.max(day), 1).cast("timestamp_ntz").alias("end"),
    ).first()
    return None if ends.start is None else (ends.start, ends.end)


def _chunk_hours(start: datetime, end: datetime) -> Column:
    """Hour starts of the chunk that begins ``_chunk`` hours after ``start``."""
    begin = ntz(start) + F.make_dt_interval(hours=F.col("_chunk"))
    last = F.least(begin + F.make_dt_interval(hours=F.lit(CHUNK_HOURS)), ntz(end)) - one_hour()
    return F.sequence(begin, last, one_hour())


def gap_fill(prep: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Every hour of the spine for every series, with the measurement where there is one.

    A measurement matches on the series and on both ends of its hour, so one that
    does not last exactly a spine hour is left out.  The series are few and small, so they
    would be merged into one task; the grid is dealt by series and ``CHUNK_HOURS`` to a fixed
    number of tasks before its hours are made.
    """
    spark = prep.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hours = max(0, (end - start) // timedelta(hours=1))
    chunks = F.array(*(F.lit(at) for at in range(0, hours, CHUNK_HOURS))).cast("array<int>")
    grid = (
        prep.select(*SERIES)
        .distinct()
        .select(*SERIES, F.explode(chunks).alias("_chunk"))
        .repartition(parts, *SERIES, "_chunk")
        .select(*SERIES, F.explode(_chunk_hours(start, end)).alias("data_da"))
        .withColumn("data_a", F.col("data_da") + one_hour())
    )
    # Rows that cannot match stay out of the shuffle, however many there are.
    can_match = (F.col("data_da") >= ntz(start)) & (F.col("data_da") < ntz(end))
    measured = prep.filter(can_match & (F.col("data_a") == F.col("data_da") + one_hour())).select(
        *SERIES, "data_da", "data_a", "val_param", "cod_valid", "cod_validaz", "cod_validaz_reg"
    )
    return grid.join(measured, SERIES + ["data_da", "data_a"], "left").select(
        "data_da",
        "data_a",
        *SERIES,
        "val_param",
        "cod_valid",
        "cod_validaz",
        "cod_validaz_reg",
    )
