"""Small measurement frames."""

from datetime import datetime, timedelta

from obsengine.schema import PREP_SCHEMA

DAY = datetime(2024, 3, 10)


def measurement(
    hour,
    value,
    valid=0,
    checked="V",
    certified="V",
    ubic="A",
    conf=1,
    sigla="O3",
    freq="OR",
    start=DAY,
    minutes=60,
):
    da = None if hour is None else start + timedelta(hours=hour)
    return (
        ubic,
        conf,
        f"P{conf}",
        da,
        None if da is None else da + timedelta(minutes=minutes),
        None if value is None else float(value),
        valid,
        checked,
        certified,
        None if da is None else da.year,
        freq,
        sigla,
    )


def prep_frame(spark, measurements):
    return spark.createDataFrame(measurements, PREP_SCHEMA)
