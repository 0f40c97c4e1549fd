"""Left joins that decorate bookings and totals. None carries a broadcast hint:

Spark broadcasts a dimension when its size is known to be under the session's
threshold and otherwise joins by shuffle, which is cheap here because hotels and
segments are joined to totals, not to single bookings or facts.
"""

from pyspark.sql import functions as F


def with_segment_ids(stays, bridge):
    """Adds src_sgmnt_id per booking, and to `copies` how often the bridge links the two.

    Links are counted before the join, so a booking linked many times meets one
    row per segment id instead of one per link.
    """
    links = (
        bridge.groupBy("source_rsrv_id", "src_sgmnt_id")
        .agg(F.count(F.lit(1)).alias("links"))
    )
    return (
        stays.join(links, F.col("bkg_num") == F.col("source_rsrv_id"), "left")
        .withColumn("copies", F.col("copies") * F.coalesce("links", F.lit(1)))
        .drop("links", "source_rsrv_id")
    )


def with_hotels(totals, hotels, key):
    return totals.join(
        hotels.select("hotel_id", "hotel_code", "no_of_rooms", "owned_vs_managed"), key, "left"
    )


def with_segments(totals, segments):
    return totals.join(segments.select("src_sgmnt_id", "source", "segment"), "src_sgmnt_id", "left")
