"""Monitoring tables derived from the event and order tables.

The library's own source tables hold hourly measurements and their dimensions.
These functions read the same shapes out of general tables, so that every
operator can run over whole tables of any size.  Seventy-five users share a
station, so the number of series grows with the data.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.functions.scalar import one_hour
from obsengine.operators.spine import period

USERS_PER_STATION = 75

# Event type, configuration, pollutant, sampling frequency.
CHANNELS = (
    ("view", 1, "O3", "OR"),
    ("click", 2, "NO2", "OR"),
    ("purchase", 3, "NOX", "OR"),
    ("signup", 4, "CO", "OR"),
    ("error", 5, "PM10", "CG"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _channel(position: int) -> Column:
    """One attribute of the event's channel; the last channel takes all other types."""
    *named, rest = CHANNELS
    chosen = F.when(F.col("event_type") == named[0][0], F.lit(named[0][position]))
    for channel in named[1:]:
        chosen = chosen.when(F.col("event_type") == channel[0], F.lit(channel[position]))
    return chosen.otherwise(F.lit(rest[position]))


def _station_number() -> Column:
    return F.expr(f"user_id div {USERS_PER_STATION}")


def _station() -> Column:
    return F.concat(F.lit("S"), F.col("station").cast("string"))


def _hour() -> Column:
    return F.col("ts").cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour("ts"))


def event_period(events: DataFrame) -> tuple[datetime, datetime]:
    """The days the events cover, as start and end (excluded).  Runs a job.

    Without events it is an empty period.
    """
    return period(events, "ts") or (datetime(1970, 1, 1), datetime(1970, 1, 1))


def hourly_cells(events: DataFrame) -> DataFrame:
    """One row per station, channel and hour; counted before the shuffle.

    Types that name no channel are mapped to the last one before grouping.
    """
    return events.groupBy(
        _station_number().alias("station"), _channel(0).alias("event_type"), _hour().alias("data_da")
    ).agg(F.max("value").alias("top_value"), F.max("event_id").alias("last_id"))


def of_pollutants(events: DataFrame, *pollutants: str) -> DataFrame:
    """Events of some pollutants only, as a filter the Parquet scan understands."""
    kind = F.col("event_type")
    chosen = kind.isin(*[channel[0] for channel in CHANNELS if channel[2] in pollutants])
    if CHANNELS[-1][2] in pollutants:  # which takes all types that name no channel
        chosen = chosen | kind.isNull() | ~kind.isin(*[channel[0] for channel in CHANNELS])
    return events.filter(chosen)


def event_measurements(events: DataFrame) -> DataFrame:
    """Each event as a measurement of its hour, so an hour may hold many rows."""
    cells = events.select(
        _station_number().alias("station"),
        "event_type",
        _hour().alias("data_da"),
        F.col("value").alias("top_value"),
        F.col("event_id").alias("last_id"),
    )
    return _measured(cells)


def observations(events: DataFrame) -> DataFrame:
    """Prepared measurements; a series has at most one row per hour by construction."""
    return _measured(hourly_cells(events))


def _measured(cells: DataFrame) -> DataFrame:
    last = F.col("last_id")
    return cells.select(
        _station().alias("cod_ubic"),
        _channel(1).alias("cod_conf"),
        F.concat(F.lit("P"), _channel(1).cast("string")).alias("cod_param"),
        "data_da",
        (F.col("data_da") + one_hour()).alias("data_a"),
        F.floor(F.col("top_value") * 4).cast("double").alias("val_param"),
        F.when(last % 10 == 0, F.lit(1)).otherwise(F.lit(0)).alias("cod_valid"),
        F.when(last % 3 != 0, F.lit("V")).alias("cod_validaz"),
        F.when(last % 4 != 0, F.lit("V")).alias("cod_validaz_reg"),
        F.year("data_da").alias("anno"),
        _channel(3).alias("cod_freq"),
        _channel(2).alias("sigla_param"),
    )


def raw_measurements(events: DataFrame) -> DataFrame:
    """The same measurements as a raw table: upper-case names, text columns, open codes."""
    last = F.col("last_id")
    return hourly_cells(events).select(
        _station().alias("COD_UBIC"),
        _channel(1).cast("string").alias("COD_CONF"),
        F.col("data_da").cast("string").alias("DATA_DA"),
        (F.col("data_da") + one_hour()).cast("string").alias("DATA_A"),
        F.floor(F.col("top_value") * 4).cast("string").alias("VAL_PARAM"),
        F.when(last % 10 == 0, F.lit("7")).otherwise(F.lit("0")).alias("COD_VALID"),
        F.when(last % 3 != 0, F.lit("V")).alias("COD_VALIDAZ"),
        F.when(last % 4 != 0, F.lit("V")).alias("COD_VALIDAZ_REG"),
    )


def raw_configurations(events: DataFrame) -> DataFrame:
    """One configuration per station and event type."""
    conf = _channel(1).cast("string")
    return (
        events.select(_station_number().alias("station"), _channel(0).alias("event_type"))
        .distinct()
        .select(
            conf.alias("COD_CONF"),
            _station().alias("COD_UBIC"),
            F.concat(F.lit("P"), conf).alias("COD_PARAM"),
            F.lit("E1").alias("COD_ENTE"),
            F.lit("M1").alias("COD_MIS"),
            _channel(3).alias("COD_FREQ"),
            F.lit(None).cast("string").alias("STATION_CL_EU"),
            F.lit("S").alias("FLG_PUB"),
        )
    )


def raw_parameters(events: DataFrame) -> DataFrame:
    """One parameter per event type."""
    conf = _channel(1).cast("string")
    return (
        events.select(_channel(0).alias("event_type"))
        .distinct()
        .select(
            F.concat(F.lit("P"), conf).alias("COD_PARAM"),
            F.col("event_type").alias("DESCR_PARAM"),
            _channel(2).alias("SIGLA_PARAM"),
            F.lit("X1").alias("COD_METODO"),
            F.lit("S").alias("FLAG_PUBBLICO"),
            F.concat(F.lit("EL"), conf).alias("COD_ELEMENTO"),
        )
    )
