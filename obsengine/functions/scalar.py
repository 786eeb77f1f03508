"""Column helpers: cleaning, clock arithmetic, coverage."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    """Turn an empty string into NULL so that a later cast does not raise."""
    return F.nullif(col, F.lit(""))


def clamp_code(col: Column, top: int = 1) -> Column:
    """Cap a status code at ``top``; smaller values, negatives and NULL stay."""
    code = col.cast("int")
    return F.when(code > top, F.lit(top)).otherwise(code)


def hour_number(ts: Column) -> Column:
    """Whole hours since 1970-01-01 of a zone-less timestamp, as BIGINT."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def hour_start(number: Column) -> Column:
    """Inverse of :func:`hour_number` for whole hours."""
    day = F.date_from_unix_date(F.floor(number / 24).cast("int"))
    hour = F.pmod(number, F.lit(24)).cast("int")
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


def seconds_past_hour(ts: Column) -> Column:
    return F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def one_hour() -> Column:
    return F.expr("interval 1 hour")


def pct_validity(observed: Column, expected: Column) -> Column:
    """Observed share of the expected values in percent, to 6 digits; 0 if none expected."""
    ratio = observed.cast("double") * F.lit(100.0) / expected.cast("double")
    return F.round(F.when(expected == 0, F.lit(0.0)).otherwise(ratio), 6)


def validity_flag(observed: Column, expected: Column, threshold: float = 75.0) -> Column:
    """'Si' when the unrounded coverage reaches ``threshold`` percent, else 'No'."""
    ratio = observed.cast("double") * F.lit(100.0) / expected.cast("double")
    return (
        F.when(expected == 0, F.lit("No"))
        .when(ratio >= F.lit(float(threshold)), F.lit("Si"))
        .otherwise(F.lit("No"))
    )


def elapsed_days(day: Column, first_day: Column) -> Column:
    """Days from ``first_day`` to ``day``, both counted."""
    return F.datediff(day, first_day) + 1


def theoretical_hours(first_day: Column, last_day: Column) -> Column:
    """Hours in the period from ``first_day`` to ``last_day``, both counted."""
    return elapsed_days(last_day, first_day) * 24


def available_year_days(day: Column, first_available: Column, last_available: Column) -> Column:
    """Days of the calendar year of ``day`` that lie inside the available period."""
    year_first = F.trunc(day.cast("date"), "year")
    year_last = F.date_sub(F.add_months(year_first, 12), 1)
    last = F.least(year_last, last_available.cast("date"))
    first = F.greatest(year_first, first_available.cast("date"))
    return elapsed_days(last, first)
