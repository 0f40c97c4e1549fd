"""The logical tables, read off the generic order tables the checks run on.

Every row of every table is used. Keys of hotels with a negative account balance
and of part-shipped orders are negated, so that some bookings find no hotel or
no segment, as happens in real data.
"""

from pyspark.sql import functions as F

from ..schemas import MONEY, RATE


# Declared so that no job has to look into the files for their columns.
_FILES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark, sf_dir, name):
    """One of the generic tables, with the columns used here."""
    return spark.read.schema(_FILES[name]).parquet(f"{sf_dir}/{name}.parquet")


def reservations(spark, sf_dir, loaded_until=None):
    """Reservation versions from lineitem.

    `loaded_until` keeps versions whose ship date is not later. Load times are
    never before the ship date, so this loses no version loaded by that day, and
    unlike a filter on the derived load time it reaches the scan.
    """
    lines = table(spark, sf_dir, "lineitem")
    if loaded_until is not None:
        lines = lines.filter(F.col("l_shipdate") <= F.lit(loaded_until))
    shipped = F.col("l_shipdate").cast("date")
    arrival = F.date_add(shipped, (F.col("l_partkey") % 30).cast("int"))
    nights = F.col("l_quantity").cast("int") % 8
    return lines.select(
        F.col("l_orderkey").alias("bkg_num"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_shipdate") + F.expr("interval 9 hours"))
        .otherwise(F.col("l_shipdate"))
        .alias("load_datetime"),
        arrival.alias("arrival_dt"),
        F.date_add(arrival, nights).alias("departure_dt"),
        F.when(F.col("l_returnflag") == "A", 0)
        .when(F.col("l_returnflag") == "N", 5)
        .when(F.col("l_returnflag") == "R", 9)
        .alias("reservation_status"),
        (F.col("l_suppkey") % 40).cast("int").alias("room_typ"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice").cast(RATE)).alias("rm_rate"),
        (F.col("l_discount") * 1000).cast(RATE).alias("rm_rate_wo_split"),
        F.col("l_suppkey").alias("hotel_id"),
        F.col("l_partkey").cast("int").alias("price_typ_grp"),
        F.col("l_linenumber").alias("num_of_room_booked"),
    )


def hotels(spark, sf_dir):
    """Hotels from supplier."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") < 0, -key).otherwise(key).alias("hotel_id"),
        F.col("s_name").alias("hotel_code"),
        (50 + key % 200).cast("int").alias("no_of_rooms"),
        F.element_at(
            F.array(F.lit("Owned"), F.lit("Managed"), F.lit("Franchise")),
            (F.col("s_nationkey") % 3 + 1).cast("int"),
        ).alias("owned_vs_managed"),
    )


def bridge(spark, sf_dir):
    """Booking to segment links from orders."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", -key).otherwise(key).alias("source_rsrv_id"),
        (F.col("o_custkey") % 27).cast("int").alias("src_sgmnt_id"),
    )


def segments(spark, sf_dir):
    """Segments from nation and region."""
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("src_sgmnt_id"),
            F.col("r_name").alias("source"),
            F.col("n_name").alias("segment"),
        )
    )


def hotel_facts(spark, sf_dir, text_dates=True):
    """Daily hotel facts from lineitem, with dates as `dd-MM-yyyy` text or as DATE."""
    day = F.date_format("l_shipdate", "dd-MM-yyyy") if text_dates else F.col("l_shipdate").cast("date")
    return (
        table(spark, sf_dir, "lineitem")
        .join(
            table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
            F.col("l_suppkey") == F.col("s_suppkey"),
            "left",
        )
        .select(
            day.alias("business_date"),
            F.col("s_name").alias("hotel_code"),
            (F.col("l_orderkey") % 27).cast("int").alias("src_sgmnt_id"),
            F.col("l_quantity").cast("int").cast("long").alias("room_nights"),
            F.col("l_extendedprice").cast(MONEY).alias("room_revenue"),
        )
    )
