from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import BUSINESS_DATE_FORMAT


def day_from(column, kind, pattern=None):
    """`column`, whose type is `kind`, as a DATE. Text that does not parse gives NULL."""
    if isinstance(kind, T.StringType):
        return F.try_to_date(column, pattern) if pattern else column.try_cast("date")
    return column.cast("date")


def day_literal(day):
    """A date as a constant; by its ISO text, which also holds for years of three digits."""
    return F.lit(day.isoformat()).cast("date")


def business_day(column, kind):
    return day_from(column, kind, BUSINESS_DATE_FORMAT)


def moment_from(column, kind):
    """`column` as a timestamp, so that comparing it with a date means that day's midnight."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(kind, T.StringType):
        return column.try_cast("timestamp_ntz")
    return column.cast("timestamp_ntz")


def zero_date_to_null(column):
    """Text dates that are all zeros (an export habit of some databases) as NULL."""
    return F.when(~F.startswith(column, F.lit("0000-00-00")), column)


def first_midnight_from(moment):
    """The first day whose midnight is not before `moment`."""
    day = moment.cast("date")
    return F.when(moment > day, F.date_add(day, 1)).otherwise(day)
