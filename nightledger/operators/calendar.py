from pyspark.sql import functions as F

from ..functions.calendar import fiscal_start, fiscal_week


def fiscal_calendar(span):
    """A date dimension: one row per day from `first` to `last` of a one-row frame."""
    day = F.explode(F.sequence("first", "last", F.expr("interval 1 day")))
    return span.select(day.alias("day")).select(
        "day",
        F.year("day").alias("calendar_year"),
        fiscal_start("day").alias("fiscal_start"),
        fiscal_week(F.col("day")).alias("fiscal_week"),
    )
