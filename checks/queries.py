"""One query per operator or report, over the whole of the given tables."""

import tempfile
import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger import schemas
from nightledger.fixed_values import HOTEL_RECODES, STATUS_LABELS
from nightledger.functions.calendar import fiscal_week
from nightledger.functions.codes import recode
from nightledger.functions.parsing import business_day, moment_from, zero_date_to_null
from nightledger.functions.rates import effective_rate
from nightledger.operators import calendar
from nightledger.operators.joins import with_hotels, with_segment_ids, with_segments
from nightledger.operators.nights import stay_nights
from nightledger.operators.schema import align_schema, conform, null_markers_to_null
from nightledger.operators.versions import collapse_copies, latest_versions
from nightledger.plans import jobs, mat, rob, sql_reports
from nightledger.sinks.audit import audited_commit, audited_write, committed_audits
from nightledger.sinks.files import write_aligned, write_by_date, write_csv_by_date, write_parquet
from nightledger.sinks.tables import register_by_date, repair_by_date, write_bucketed, write_table
from nightledger.sinks.versions import DatedVersions
from nightledger.sources import stand_in
from nightledger.sources.files import read_files
from nightledger.sources.tables import read_source, read_table
from nightledger.workspace import scratch_path as shared_path

AS_OF = date(1998, 6, 1)
WEEK = (date(1998, 6, 1), date(1998, 6, 7))
LOG_END = date(2001, 12, 31)
# The coarse report's own recodes, plus two that occur in the test data.
RECODES = {
    **HOTEL_RECODES,
    "Supplier#000000001": "Supplier#000000002",
    "Supplier#000000003": "HOUSE",
}


def _rob_tables(spark, sf_dir, loaded_until=None):
    return (
        stand_in.reservations(spark, sf_dir, loaded_until),
        stand_in.hotels(spark, sf_dir),
        stand_in.bridge(spark, sf_dir),
        stand_in.segments(spark, sf_dir),
    )


def _mat_tables(spark, sf_dir, text_dates=True):
    return (
        stand_in.hotel_facts(spark, sf_dir, text_dates),
        stand_in.hotels(spark, sf_dir),
        stand_in.segments(spark, sf_dir),
    )


# --- reports ---------------------------------------------------------------


def rob_daily(spark, sf_dir):
    return rob.rob(*_rob_tables(spark, sf_dir, AS_OF), AS_OF)


def rob_bulk(spark, sf_dir):
    return rob.rob_range(*_rob_tables(spark, sf_dir, WEEK[1]), *WEEK)


def rob_bulk_default_start(spark, sf_dir):
    """Every date from the first load on, added up per date and hotel."""
    report = rob.rob_range(*_rob_tables(spark, sf_dir), None, LOG_END, by_quarter=True)
    return (
        report.groupBy("quarter", "as_of_date", "hotel_code")
        .agg(
            F.count(F.lit(1)).alias("report_rows"),
            F.sum("rob").alias("rob"),
            F.sum("room_revenue").cast(schemas.ROB_REVENUE).alias("room_revenue"),
        )
        .drop("quarter")
    )


def rob_sql_report(spark, sf_dir):
    return sql_reports.rob_room_nights(*_rob_tables(spark, sf_dir, AS_OF), AS_OF)


def rob_by_hotel_stay(spark, sf_dir):
    return rob.rooms_by_date_and_hotel(rob_daily(spark, sf_dir))


def ordered_report(spark, sf_dir):
    return rob_daily(spark, sf_dir).orderBy("stay_date", "hotel_id")


def mat_daily(spark, sf_dir):
    return mat.mat(*_mat_tables(spark, sf_dir), AS_OF.isoformat())


def mat_bulk(spark, sf_dir):
    return mat.mat_range(*_mat_tables(spark, sf_dir, text_dates=False), *WEEK)


def mat_bulk_text(spark, sf_dir):
    """The week, from facts whose dates are text."""
    return mat.mat_range(*_mat_tables(spark, sf_dir), *WEEK)


def mat_bulk_all_dates(spark, sf_dir):
    return mat.mat_range(*_mat_tables(spark, sf_dir, text_dates=False))


def mat_sql_report(spark, sf_dir):
    return sql_reports.mat_by_hotel(*_mat_tables(spark, sf_dir), RECODES)


def mat_by_date_hotel(spark, sf_dir):
    return mat.rooms_by_date_and_hotel(mat_bulk(spark, sf_dir))


# --- versions and nights -----------------------------------------------------


def latest_version(spark, sf_dir):
    return latest_versions(stand_in.reservations(spark, sf_dir, AS_OF), AS_OF)


def active_bookings(spark, sf_dir):
    return latest_version(spark, sf_dir).filter(
        (F.col("departure_dt") >= F.lit(AS_OF)) & (F.col("departure_dt") > F.col("arrival_dt"))
    )


def _as_stays(reservations):
    return reservations.withColumnsRenamed({"arrival_dt": "arrival", "departure_dt": "departure"})


def stay_nights_sequence(spark, sf_dir):
    stays = _as_stays(stand_in.reservations(spark, sf_dir))
    return stay_nights(stays).select("bkg_num", "hotel_id", "num_of_room_booked", "stay_date")


def stay_nights_numbers(spark, sf_dir):
    """Nights with their number in the stay."""
    stays = _as_stays(stand_in.reservations(spark, sf_dir))
    return stay_nights(stays).select(
        "bkg_num",
        F.datediff("departure", "arrival").alias("nights"),
        F.datediff("stay_date", "arrival").alias("n"),
        "stay_date",
    )


def status_room_price_filter(spark, sf_dir):
    codes = stand_in.reservations(spark, sf_dir).withColumns(
        {
            "room_typ": F.nullif("room_typ", F.lit(7)),
            "price_typ_grp": F.nullif("price_typ_grp", F.lit(42)),
        }
    )
    return codes.filter(rob.counts_as_booked()).select(
        "bkg_num", "reservation_status", "room_typ", "price_typ_grp"
    )


def effective_rates(spark, sf_dir):
    """Rates that arrive as text, with empty text where there is none."""
    text = F.coalesce(F.col("rm_rate").cast("string"), F.lit(""))
    return stand_in.reservations(spark, sf_dir).select(
        "bkg_num", "load_datetime", effective_rate(text, F.col("rm_rate_wo_split")).alias("room_rate")
    )


# --- joins and aggregates ------------------------------------------------------


def join_reservation_hotel(spark, sf_dir):
    joined = with_hotels(
        stand_in.reservations(spark, sf_dir), stand_in.hotels(spark, sf_dir), "hotel_id"
    )
    return joined.select("bkg_num", "hotel_id", "hotel_code", "no_of_rooms", "owned_vs_managed")


def join_booking_segment(spark, sf_dir):
    versions = collapse_copies(stand_in.reservations(spark, sf_dir).select("bkg_num", "load_datetime"))
    linked = with_segment_ids(versions, stand_in.bridge(spark, sf_dir))
    return with_segments(linked, stand_in.segments(spark, sf_dir)).select(
        "bkg_num", "load_datetime", "src_sgmnt_id", "source", "segment", "copies"
    )


def join_fact_hotel_segment(spark, sf_dir):
    facts, hotels, segments = _mat_tables(spark, sf_dir)
    return mat.decorated(mat.dated(facts), hotels, segments)


def revenue_expr_sum(spark, sf_dir):
    rate = effective_rate(F.col("rm_rate"), F.col("rm_rate_wo_split"))
    return (
        stand_in.reservations(spark, sf_dir)
        .groupBy("hotel_id")
        .agg(
            F.sum(F.col("num_of_room_booked") * rate).cast(schemas.ROB_REVENUE).alias("room_revenue"),
            F.sum("num_of_room_booked").alias("rob"),
        )
    )


def min_load_bound(spark, sf_dir):
    """First day of each log: the default start of the range jobs."""
    loads = stand_in.reservations(spark, sf_dir).agg(F.min("load_datetime").cast("date").alias("first_day"))
    facts = mat.dated(stand_in.hotel_facts(spark, sf_dir))
    return loads.select(F.lit("reservations").alias("log"), "first_day").union(
        facts.agg(F.min("business_date").alias("first_day")).select(F.lit("hotel_facts"), "first_day")
    )


def row_count(spark, sf_dir):
    return rob_daily(spark, sf_dir).agg(F.count(F.lit(1)).alias("report_rows"))


# --- columns -------------------------------------------------------------------


def decode_status(spark, sf_dir):
    status = F.col("reservation_status")
    return (
        stand_in.reservations(spark, sf_dir)
        .groupBy("reservation_status", recode(status, STATUS_LABELS).alias("status_label"))
        .agg(F.count(F.lit(1)).alias("versions"))
    )


def recode_hotel(spark, sf_dir):
    return (
        stand_in.hotel_facts(spark, sf_dir)
        .groupBy(recode(F.col("hotel_code"), RECODES).alias("hotel_code"))
        .agg(F.sum("room_nights").alias("room_nights"))
    )


def _landed(spark, sf_dir):
    """Upper-case text columns, one of them unknown to the target schema; some rates are empty or broken text."""
    rate = F.col("rm_rate").cast("string")
    broken = F.when(F.col("num_of_room_booked") == 1, "").when(F.col("num_of_room_booked") == 2, "n/a").otherwise(rate)
    return stand_in.reservations(spark, sf_dir).select(
        F.col("bkg_num").cast("string").alias("BKG_NUM"),
        F.col("arrival_dt").cast("string").alias("Arrival_Dt"),
        broken.alias("RM_RATE"),
        F.col("num_of_room_booked").cast("string").alias("num_of_room_booked"),
        F.concat(F.lit("h"), "hotel_id").alias("Hotel Label"),
    )


def aligned(spark, sf_dir):
    return align_schema(_landed(spark, sf_dir), schemas.RESERVATIONS)


def rejected(spark, sf_dir):
    """The cells that did not parse, by column and value."""
    return write_aligned(_landed(spark, sf_dir), schemas.RESERVATIONS, scratch_path(spark, "aligned"))[1]


def null_markers(spark, sf_dir):
    priority = F.col("o_orderpriority")
    marked = (
        F.when(priority.startswith("1"), "NaN")
        .when(priority.startswith("2"), "nan")
        .when(priority.startswith("3"), "@NULL@")
        .when(priority.startswith("4"), "NULL")
        .otherwise(priority)
    )
    orders = stand_in.table(spark, sf_dir, "orders")
    return null_markers_to_null(orders.select("o_orderkey", marked.alias("priority")))


def zero_dates(spark, sf_dir):
    lines = stand_in.table(spark, sf_dir, "lineitem")
    exported = F.when(F.col("l_linenumber") == 3, "0000-00-00 00:00:00").otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    )
    return lines.select(
        "l_orderkey", "l_linenumber", zero_date_to_null(exported).cast("date").alias("ship_day")
    )


def parse_dates(spark, sf_dir):
    facts = stand_in.hotel_facts(spark, sf_dir)
    loads = F.date_format(F.to_timestamp("business_date", "dd-MM-yyyy"), "yyyy-MM-dd HH:mm:ss")
    text = T.StringType()
    return facts.select(
        "business_date",
        business_day(F.col("business_date"), text).alias("business_day"),
        moment_from(loads, text).cast("date").alias("load_day"),
        "room_nights",
    )


def fiscal_weeks(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    orders = stand_in.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", day.alias("order_day"), fiscal_week(day).alias("fiscal_week"))


def fiscal_calendar(spark, sf_dir):
    """A date dimension over all days the reservations span."""
    span = stand_in.reservations(spark, sf_dir).agg(
        F.min("arrival_dt").alias("first"), F.max("departure_dt").alias("last")
    )
    return calendar.fiscal_calendar(span)


def rename_project(spark, sf_dir):
    versions = stand_in.reservations(spark, sf_dir).alias("r")
    hotels = stand_in.hotels(spark, sf_dir).alias("h")
    return (
        versions.join(hotels, F.col("r.hotel_id") == F.col("h.hotel_id"), "left")
        .select(
            F.lit(AS_OF).alias("as_of_date"),
            F.col("r.bkg_num"),
            F.col("r.hotel_id"),
            F.col("h.hotel_code"),
            "no_of_rooms",
        )
        .withColumnsRenamed({"no_of_rooms": "inventory", "bkg_num": "booking"})
        .select("*")
    )


# --- sources and sinks ------------------------------------------------------------


def scratch_path(spark, label):
    """In the shared folder; only a local session without one gets a folder of this machine."""
    local = spark.sparkContext.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None)
    return shared_path(spark, label, tempfile.mkdtemp(prefix="nightledger-") if local else None)


def parquet_roundtrip(spark, sf_dir):
    """The week written twice over: a rerun leaves one copy."""
    path = scratch_path(spark, "rob")
    report = rob_bulk(spark, sf_dir)
    write_by_date(report, path)
    write_by_date(report, path)
    return read_files(spark, path, "parquet").select(report.columns)


def plain_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "versions")
    write_parquet(stand_in.reservations(spark, sf_dir), path, files=8)
    return conform(read_files(spark, path, "parquet"), schemas.RESERVATIONS)


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "mat")
    report = mat_bulk(spark, sf_dir)
    write_csv_by_date(report, path)
    return conform(read_files(spark, path, "csv"), report.schema)


def _table_name():
    return f"nightledger_check_{uuid.uuid4().hex}"


def _empty_table(spark, schema):
    name = _table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{scratch_path(spark, name)}'")
    return name


def truncate_overwrite(spark, sf_dir):
    report = mat_bulk(spark, sf_dir)
    table = _empty_table(spark, report.schema)
    write_table(report, table)
    write_table(report, table, mode="overwrite")
    return spark.table(table)


def table_append(spark, sf_dir):
    """Two appends leave every row twice."""
    report = mat_daily(spark, sf_dir)
    table = _empty_table(spark, report.schema)
    write_table(report, table)
    write_table(report, table)
    return spark.table(table)


def rob_daily_job(spark, sf_dir):
    """Written and rewritten by the job, then read from the refreshed catalog table."""
    path, table = scratch_path(spark, "rob-daily"), _table_name()
    tables = _rob_tables(spark, sf_dir, AS_OF)
    for _ in range(2):
        jobs.rob_daily(*tables, path, as_of=AS_OF, table=table)
    return spark.table(table)


def rob_bulk_job(spark, sf_dir):
    path, table = scratch_path(spark, "rob-bulk"), _table_name()
    jobs.rob_bulk(*_rob_tables(spark, sf_dir, WEEK[1]), path, *WEEK, table=table)
    return spark.table(table)


def _deliveries(versions, *days):
    """The log as it arrives by these days; one booking in seven comes a delivery late."""
    loaded = F.col("load_datetime")
    due = sum((F.when(loaded > F.lit(day), 1).otherwise(0) for day in days[:-1]), F.lit(0))
    late = F.when(F.col("bkg_num") % 7 == 0, 1).otherwise(0)
    numbered = versions.withColumn("delivery", F.least(due + late, F.lit(len(days) - 1)))
    return [numbered.filter(F.col("delivery") == n).drop("delivery") for n in range(len(days))]


def rob_bucketed_job(spark, sf_dir):
    """The report over copies of log and bridge that are bucketed by booking."""
    reservations, hotels, bridge, segments = _rob_tables(spark, sf_dir, AS_OF)
    dealt = []
    for df, key in ((reservations, "bkg_num"), (bridge, "source_rsrv_id")):
        table = _table_name()
        write_bucketed(df, table, key, 8, scratch_path(spark, "bucketed"))
        dealt.append(spark.table(table))
    return rob.rob(dealt[0], hotels, dealt[1], segments, AS_OF)


def rob_daily_state_job(spark, sf_dir):
    """The report of a date from a state that three deliveries, each with late loads, have brought forward."""
    path, state, table = scratch_path(spark, "rob-state"), scratch_path(spark, "state"), _table_name()
    reservations, *others = _rob_tables(spark, sf_dir, AS_OF)
    days = [AS_OF - timedelta(days=60), AS_OF - timedelta(days=1), AS_OF]
    for day, arrivals in zip(days, _deliveries(reservations, *days)):
        jobs.rob_daily_from_state(arrivals, *others, path, state, as_of=day, table=table)
    return spark.table(table).filter(F.col("as_of_date") == F.lit(AS_OF))


def rob_extend_job(spark, sf_dir):
    """A week stored in three steps: late loads change dates that are stored already; the last step is run twice."""
    path, totals, table = scratch_path(spark, "rob-extended"), scratch_path(spark, "totals"), _table_name()
    reservations, *others = _rob_tables(spark, sf_dir, WEEK[1])
    days = [WEEK[0] + timedelta(days=2), WEEK[0] + timedelta(days=4), WEEK[1]]
    log = reservations.filter(F.lit(False))
    for n, (day, arrivals) in enumerate(zip(days, _deliveries(reservations, *days))):
        for _ in range(1 + n // 2):
            jobs.rob_extend(arrivals, log, *others, path, totals, f"delivery {n}", day, start=WEEK[0], table=table)
        log = log.unionByName(arrivals)
    return spark.table(table)


def mat_daily_job(spark, sf_dir):
    path, table = scratch_path(spark, "mat-daily"), _table_name()
    jobs.mat_daily(*_mat_tables(spark, sf_dir), path, day=AS_OF, table=table)
    return spark.table(table)


def mat_bulk_job(spark, sf_dir):
    """The default range: from the first fact to two days ago."""
    path, table = scratch_path(spark, "mat-bulk"), _table_name()
    tables = _mat_tables(spark, sf_dir, text_dates=False)
    jobs.mat_bulk(*tables, path, table=table, tasks=spark.sparkContext.defaultParallelism)
    return spark.table(table)


def mat_bulk_text_job(spark, sf_dir):
    """A stored range of text-dated facts; then a rerun without the last date drops what is stored of it."""
    path, table = scratch_path(spark, "mat-text"), _table_name()
    facts, hotels, segments = _mat_tables(spark, sf_dir)
    jobs.mat_bulk(facts, hotels, segments, path, *WEEK, table=table)
    fewer = facts.filter(F.col("business_date") != WEEK[1].strftime("%d-%m-%Y"))
    jobs.mat_bulk(fewer, hotels, segments, path, *WEEK, table=table)
    return spark.table(table)


def mat_landed_daily(spark, sf_dir):
    """Text-dated facts landed by date in two deliveries, the second of them twice; the report reads its date only."""
    path = scratch_path(spark, "landed")
    facts, hotels, segments = _mat_tables(spark, sf_dir)
    first = F.col("room_nights") % 2 == 0
    jobs.land_facts(facts.filter(first), path, "first")
    for _ in range(2):
        jobs.land_facts(facts.filter(~first | first.isNull()), path, "second")
    return mat.mat(jobs.landed_facts(spark, path, AS_OF, AS_OF), hotels, segments, AS_OF)


def load_audit_once(spark, sf_dir):
    """A load that is run again leaves one record, and its rows once."""
    path = scratch_path(spark, "load")
    for _ in range(2):
        audited_commit(
            stand_in.reservations(spark, sf_dir), path, F.col("bkg_num"), F.col("load_datetime"), "reservation_status",
            glue_run_id="run-1", job_name="reservations", s3_file_modified_datetime="2026-01-01 00:00:00",
            table_name="reservations", src_sys_id=1,
        )
    stored = DatedVersions(spark, path, "reservation_status").read().count()
    return committed_audits(spark, path, "reservation_status").withColumn("stored_rows", F.lit(stored).cast("bigint"))


def csv_inferred(spark, sf_dir):
    """Headed CSV with types inferred, markers in text included."""
    path = scratch_path(spark, "hotels")
    hotels = stand_in.hotels(spark, sf_dir)
    marked = F.when(F.col("owned_vs_managed") == "Owned", "@NULL@").otherwise(F.col("owned_vs_managed"))
    hotels.withColumn("owned_vs_managed", marked).write.option("header", True).csv(path)
    return read_files(spark, path, "csv", infer=True)


def rob_from_csv(spark, sf_dir):
    """The report from tables that are all text."""
    kinds = (schemas.RESERVATIONS, schemas.HOTELS, schemas.BRIDGE, schemas.SEGMENTS)
    tables = []
    for df, schema in zip(_rob_tables(spark, sf_dir, AS_OF), kinds):
        path = scratch_path(spark, "text")
        df.write.option("header", True).csv(path)
        tables.append(conform(read_files(spark, path, "csv"), schema))
    return rob.rob(*tables, AS_OF)


def catalog_refresh(spark, sf_dir):
    """A date added behind the catalog's back shows after the next refresh."""
    path, table = scratch_path(spark, "mat"), _table_name()
    tables = _mat_tables(spark, sf_dir)
    first = mat.mat(*tables, WEEK[0])
    write_by_date(first, path)
    register_by_date(spark, table, path, first.schema)
    write_by_date(mat.mat(*tables, WEEK[1]), path)
    repair_by_date(spark, table)
    return spark.table(table)


def named_tables(spark, sf_dir):
    """Logical tables resolved by name, with their declared columns."""
    found = {
        "reservations": stand_in.reservations(spark, sf_dir),
        "hotels": stand_in.hotels(spark, sf_dir),
        "bridge": stand_in.bridge(spark, sf_dir),
        "segments": stand_in.segments(spark, sf_dir),
        "hotel_facts": stand_in.hotel_facts(spark, sf_dir),
        "dates": fiscal_calendar(spark, sf_dir),
    }
    for name, df in found.items():
        df.createOrReplaceTempView(f"check_{name}")
    names = {name: f"check_{name}" for name in found}
    labels = {
        "reservations": "reservation_status", "hotels": "owned_vs_managed", "bridge": "src_sgmnt_id",
        "segments": "source", "hotel_facts": "src_sgmnt_id", "dates": "fiscal_week",
    }
    counts = None
    for name, label in labels.items():
        rows = read_table(spark, name, names).groupBy(F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
        rows = rows.select(F.lit(name).alias("table_name"), "label", "n")
        counts = rows if counts is None else counts.union(rows)
    return counts


def query_source(spark, sf_dir):
    stand_in.reservations(spark, sf_dir).createOrReplaceTempView("check_reservations")
    return read_source(
        spark,
        table="check_reservations",
        query="""
        SELECT hotel_id, count(*) AS versions, max(departure_dt) AS last_departure
        FROM check_reservations WHERE reservation_status IN (0, 5) GROUP BY hotel_id
        """,
    )


def load_audit(spark, sf_dir):
    path, audit_path = scratch_path(spark, "load"), scratch_path(spark, "audit")
    audited_write(
        stand_in.reservations(spark, sf_dir),
        path,
        audit_path,
        record_id=F.col("bkg_num"),
        modified_at=F.col("load_datetime"),
        by="reservation_status",
        glue_run_id="run-1",
        job_name="reservations",
        s3_file_modified_datetime="2026-01-01 00:00:00",
        table_name="reservations",
        src_sys_id=1,
    )
    return spark.read.parquet(audit_path)


QUERIES = {
    "rob_daily": rob_daily,
    "rob_bulk": rob_bulk,
    "rob_bulk_default_start": rob_bulk_default_start,
    "rob_sql_report": rob_sql_report,
    "rob_by_hotel_stay": rob_by_hotel_stay,
    "ordered_report": ordered_report,
    "mat_daily": mat_daily,
    "mat_bulk": mat_bulk,
    "mat_bulk_all_dates": mat_bulk_all_dates,
    "mat_bulk_text": mat_bulk_text,
    "mat_sql_report": mat_sql_report,
    "mat_by_date_hotel": mat_by_date_hotel,
    "latest_version": latest_version,
    "active_bookings": active_bookings,
    "stay_nights_sequence": stay_nights_sequence,
    "stay_nights_numbers": stay_nights_numbers,
    "status_room_price_filter": status_room_price_filter,
    "effective_rate": effective_rates,
    "join_reservation_hotel": join_reservation_hotel,
    "join_booking_segment": join_booking_segment,
    "join_fact_hotel_segment": join_fact_hotel_segment,
    "revenue_expr_sum": revenue_expr_sum,
    "min_load_bound": min_load_bound,
    "row_count": row_count,
    "decode_status": decode_status,
    "recode_hotel": recode_hotel,
    "align_schema": aligned,
    "rejected_cells": rejected,
    "null_markers": null_markers,
    "zero_dates": zero_dates,
    "parse_dates": parse_dates,
    "fiscal_week": fiscal_weeks,
    "fiscal_calendar": fiscal_calendar,
    "rename_project": rename_project,
    "parquet_roundtrip": parquet_roundtrip,
    "plain_parquet_roundtrip": plain_parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "truncate_overwrite": truncate_overwrite,
    "table_append": table_append,
    "rob_daily_job": rob_daily_job,
    "rob_bulk_job": rob_bulk_job,
    "rob_bucketed_job": rob_bucketed_job,
    "rob_daily_state_job": rob_daily_state_job,
    "rob_extend_job": rob_extend_job,
    "mat_daily_job": mat_daily_job,
    "mat_bulk_job": mat_bulk_job,
    "mat_bulk_text_job": mat_bulk_text_job,
    "mat_landed_daily": mat_landed_daily,
    "csv_inferred": csv_inferred,
    "rob_from_csv": rob_from_csv,
    "catalog_refresh": catalog_refresh,
    "named_tables": named_tables,
    "query_source": query_source,
    "load_audit": load_audit,
    "load_audit_once": load_audit_once,
}
