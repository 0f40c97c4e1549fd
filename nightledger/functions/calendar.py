from pyspark.sql import functions as F


def fiscal_start(day):
    """First Sunday on or after 1 April of the calendar year of `day`."""
    return F.next_day(F.make_date(F.year(day), F.lit(3), F.lit(31)), "SU")


def fiscal_week(day):
    """Week number counted from `fiscal_start`; days before it are week 0."""
    start = fiscal_start(day)
    week = F.floor(F.datediff(day, start) / 7) + 1
    return F.when(day < start, 0).otherwise(week).cast("int")
