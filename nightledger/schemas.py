"""Declared schemas of the logical tables: only the columns the plans use."""

from pyspark.sql import types as T

RATE = T.DecimalType(10, 2)
MONEY = T.DecimalType(18, 2)
# Types of the summed measures in the reports.
ROB_REVENUE = T.DecimalType(31, 2)
MAT_REVENUE = T.DecimalType(28, 2)


def _struct(**columns):
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RESERVATIONS = _struct(
    bkg_num=T.LongType(),
    load_datetime=T.TimestampNTZType(),
    arrival_dt=T.DateType(),
    departure_dt=T.DateType(),
    reservation_status=T.IntegerType(),
    room_typ=T.IntegerType(),
    rm_rate=RATE,
    rm_rate_wo_split=RATE,
    hotel_id=T.LongType(),
    price_typ_grp=T.IntegerType(),
    num_of_room_booked=T.IntegerType(),
)

HOTELS = _struct(
    hotel_id=T.LongType(),
    hotel_code=T.StringType(),
    no_of_rooms=T.IntegerType(),
    owned_vs_managed=T.StringType(),
)

BRIDGE = _struct(source_rsrv_id=T.LongType(), src_sgmnt_id=T.IntegerType())

SEGMENTS = _struct(
    src_sgmnt_id=T.IntegerType(), source=T.StringType(), segment=T.StringType()
)

HOTEL_FACTS = _struct(
    business_date=T.DateType(),
    hotel_code=T.StringType(),
    src_sgmnt_id=T.IntegerType(),
    room_nights=T.LongType(),
    room_revenue=MONEY,
)

AUDIT = _struct(
    glue_run_id=T.StringType(),
    job_name=T.StringType(),
    insert_record_count=T.LongType(),
    s3_file_modified_datetime=T.StringType(),
    update_record_count=T.LongType(),
    last_table_update_datetime=T.StringType(),
    table_name=T.StringType(),
    last_record_id=T.LongType(),
    src_sys_id=T.IntegerType(),
)

DATES = _struct(
    day=T.DateType(),
    calendar_year=T.IntegerType(),
    fiscal_start=T.DateType(),
    fiscal_week=T.IntegerType(),
)

BY_TABLE = {
    "dates": DATES,
    "reservations": RESERVATIONS,
    "hotels": HOTELS,
    "bridge": BRIDGE,
    "segments": SEGMENTS,
    "hotel_facts": HOTEL_FACTS,
}
