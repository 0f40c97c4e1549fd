"""The coarser report variants; they differ from `rob` and `mat` in grain and measures."""

from pyspark.sql import functions as F

from ..dates import given_day
from ..fixed_values import HOTEL_RECODES
from ..functions.codes import recode
from ..operators.joins import with_segment_ids
from ..operators.nights import stay_nights
from ..schemas import MAT_REVENUE, ROB_REVENUE
from .mat import dated_totals, decorated
from .rob import BOOKING_KEYS, _decorated, booked_stays, revenue, rooms


def rob_room_nights(reservations, hotels, bridge, segments, as_of):
    """Rooms on books with raw status codes and room nights, ordered by stay date.

    `number_of_room_nights` adds the length of the whole stay for each of its nights.
    """
    day = given_day(as_of)
    stays = with_segment_ids(booked_stays(reservations, day), bridge)
    totals = (
        stay_nights(stays, not_before=F.lit(day))
        .groupBy("stay_date", *BOOKING_KEYS)
        .agg(
            F.sum(rooms() * F.datediff("departure", "arrival")).alias("number_of_room_nights"),
            F.sum(revenue()).alias("room_revenue"),
            F.sum(rooms()).alias("rob"),
        )
    )
    return (
        _decorated(totals, hotels, segments)
        .groupBy(
            "stay_date",
            "hotel_id",
            "hotel_code",
            F.col("no_of_rooms").alias("inventory"),
            F.col("source").alias("source_nm"),
            F.col("segment").alias("segment_nm"),
            "reservation_status",
        )
        .agg(
            F.sum("number_of_room_nights").alias("number_of_room_nights"),
            F.sum("room_revenue").cast(ROB_REVENUE).alias("room_revenue"),
            F.sum("rob").alias("rob"),
        )
        .select(F.lit(day).alias("as_of_date"), "*")
        .orderBy("stay_date")
    )


def mat_by_hotel(facts, hotels, segments, recodes=HOTEL_RECODES):
    """Room nights and revenue of all dates per date, hotel code shown and inventory."""
    return (
        decorated(dated_totals(facts), hotels, segments)
        .withColumn("hotel_code", recode(F.col("hotel_code"), recodes))
        .groupBy("as_of_date", "hotel_code", "inventory")
        .agg(
            F.sum("room_nights").alias("ROB"),
            F.sum("room_revenue").cast(MAT_REVENUE).alias("total_room_revenue"),
        )
        .orderBy("as_of_date")
    )
