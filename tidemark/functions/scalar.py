"""Column-to-column helpers; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, TimestampType

# Fixed value: square metres in one square foot, as the study defines it.
SQUARE_METERS_PER_SQUARE_FOOT = 0.092903


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds as a timestamp."""
    return F.timestamp_seconds(seconds)


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp, whether it holds epoch seconds or a time."""
    kind = df.schema[name].dataType
    if isinstance(kind, LongType):
        return epoch_to_ts(F.col(name))
    if isinstance(kind, TimestampType):
        return F.col(name)
    return F.col(name).cast("timestamp")


def utc_date(when: Column) -> Column:
    """The UTC date of a timestamp, whatever the session time zone."""
    day = F.floor(F.unix_micros(when) / F.lit(86_400_000_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), day)


def utc_hour(when: Column) -> Column:
    """The UTC hour of the day of a timestamp, whatever the session time zone."""
    return F.pmod(F.floor(F.unix_micros(when) / F.lit(3_600_000_000)), F.lit(24)).cast("int")


def with_date_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``year, month, day, hour`` of ``ts`` in UTC, whatever the session time zone."""
    when = as_timestamp(df, ts)
    day = utc_date(when)
    return df.withColumns(
        {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day), "hour": utc_hour(when)}
    )


def hour_label(when: Column) -> Column:
    """The UTC hour of a timestamp as ``yyyymmddThh``."""
    day = F.replace(utc_date(when).cast("string"), F.lit("-"), F.lit(""))
    return F.concat(day, F.lit("T"), F.lpad(utc_hour(when).cast("string"), 2, "0"))


def convert_units(value: Column, factor: float, digits: int = 2) -> Column:
    """``value * factor`` rounded half up."""
    return F.round(value * F.lit(factor), digits)


def null_when(value: Column, condition: Column) -> Column:
    """``value``, or null where ``condition`` is true; an unknown condition keeps the value."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(None)).otherwise(value)


def fill_from(value: Column, fallback: Column) -> Column:
    """``value``, or ``fallback`` where it is null."""
    return F.coalesce(value, fallback)
