"""Materialized room nights and revenue per business date, hotel and segment."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dates import as_day, given_day
from ..functions.parsing import business_day, day_literal
from ..operators.joins import with_hotels, with_segments
from ..schemas import MAT_REVENUE

REPORT_KEYS = ["as_of_date", "hotel_id", "hotel_code", "inventory", "source_nm", "segment_nm"]


def dated(facts):
    """Facts with `business_date` as a DATE; text that is none gives NULL."""
    return facts.withColumn("business_date", business_day(F.col("business_date"), facts.schema["business_date"].dataType))


def between(rows, start, end):
    """Rows with a `business_date` from `start` to `end`; None leaves a side open."""
    day = F.col("business_date")
    if start is not None:
        rows = rows.filter(day >= day_literal(start))
    if end is not None:
        rows = rows.filter(day <= day_literal(end))
    return rows


def fact_totals(facts):
    """Facts added up per date, hotel code and segment id, before any join."""
    return facts.groupBy("business_date", "hotel_code", "src_sgmnt_id").agg(
        F.sum("room_nights").alias("room_nights"), F.sum("room_revenue").alias("room_revenue")
    )


def dated_totals(facts, start=None, end=None):
    """Totals of the dates from `start` to `end`.

    DATEs are filtered first, which reaches the scan; so are text dates if both sides
    are given. Over an open range text dates are added up as they are, so that only totals have to be
    parsed; days written in more than one way come together after that.
    """
    text = isinstance(facts.schema["business_date"].dataType, T.StringType)
    if text and (start is None or end is None):
        return fact_totals(between(dated(fact_totals(facts)), start, end))
    return fact_totals(between(dated(facts), start, end))


def decorated(totals, hotels, segments):
    """Totals with hotel and segment columns, under their report names."""
    return with_segments(with_hotels(totals, hotels, "hotel_code"), segments).select(
        F.col("business_date").alias("as_of_date"),
        "hotel_id",
        "hotel_code",
        F.col("no_of_rooms").alias("inventory"),
        F.col("source").alias("source_nm"),
        F.col("segment").alias("segment_nm"),
        "room_nights",
        "room_revenue",
    )


def mat_range(facts, hotels, segments, start=None, end=None):
    """The report for every business date from `start` to `end`, in one plan."""
    totals = dated_totals(facts, as_day(start), as_day(end))
    return (
        decorated(totals, hotels, segments)
        .groupBy(*REPORT_KEYS)
        .agg(
            F.sum("room_nights").alias("Total_rooms"),
            F.sum("room_revenue").cast(MAT_REVENUE).alias("total_room_revenue"),
        )
    )


def mat(facts, hotels, segments, day):
    """The report for one business date, which must be given."""
    chosen = given_day(day)
    return mat_range(facts, hotels, segments, chosen, chosen)


def rooms_by_date_and_hotel(report):
    """A MAT report added up per date and hotel code."""
    return report.groupBy("as_of_date", "hotel_code").agg(
        F.sum("Total_rooms").alias("rob_sum"),
        F.sum("total_room_revenue").cast(MAT_REVENUE).alias("revenue_sum"),
    )
