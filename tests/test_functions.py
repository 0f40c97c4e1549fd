from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger import schemas
from nightledger.dates import as_day, given_day
from nightledger.functions.calendar import fiscal_week
from nightledger.functions.codes import recode
from nightledger.functions.parsing import business_day, first_midnight_from, moment_from, zero_date_to_null
from nightledger.functions.rates import effective_rate
from nightledger.operators.nights import stay_nights
from nightledger.operators.schema import align_schema, conform, null_markers_to_null
from nightledger.operators.versions import collapse_copies, latest_versions
from nightledger.settings import session_settings


def values(spark, kind, items, expression):
    frame = spark.createDataFrame([(item,) for item in items], f"v {kind}")
    return [row[0] for row in frame.select(expression).collect()]


def week_by_counting(day):
    """Walks from 1 April to the first Sunday and counts whole weeks from there."""
    sunday = date(day.year, 4, 1)
    while sunday.weekday() != 6:
        sunday += timedelta(days=1)
    week = 0
    while sunday <= day:
        week, sunday = week + 1, sunday + timedelta(days=7)
    return week


def test_fiscal_week_on_every_day_of_many_years(spark):
    days = [date(2019, 1, 1) + timedelta(days=n) for n in range(365 * 12)]
    assert values(spark, "date", days, fiscal_week(F.col("v"))) == [week_by_counting(d) for d in days]


def test_fiscal_week_edges(spark):
    days = [date(2025, 3, 31), date(2025, 4, 5), date(2025, 4, 6), date(2025, 4, 13), date(2026, 1, 10), None]
    assert values(spark, "date", days, fiscal_week(F.col("v"))) == [0, 0, 1, 2, 0, None]


def test_effective_rate(spark):
    text = ["12.345", "", None, "abc"]
    rate = effective_rate(F.col("v"), F.lit("7"))
    assert values(spark, "string", text, rate) == [Decimal("12.35"), Decimal("7.00"), Decimal("7.00"), Decimal("7.00")]


def test_recode(spark):
    mapped = recode(F.col("v"), {"0": "Confirmed", "5": "Tentative"})
    assert values(spark, "int", [0, 5, 9, None], mapped) == ["Confirmed", "Tentative", "9", None]
    # A new code that is itself an old one is not mapped again.
    assert values(spark, "string", ["a", "b"], recode(F.col("v"), {"a": "b", "b": "c"})) == ["b", "c"]


def test_zero_dates(spark):
    text = ["0000-00-00", "0000-00-00 00:00:00", "2025-01-02", None]
    assert values(spark, "string", text, zero_date_to_null(F.col("v"))) == [None, None, "2025-01-02", None]


def test_business_day(spark):
    text = ["06-11-2025", "2025-11-06", "", None]
    parsed = business_day(F.col("v"), T.StringType())
    assert values(spark, "string", text, parsed) == [date(2025, 11, 6), None, None, None]
    assert values(spark, "date", [date(2025, 1, 1)], business_day(F.col("v"), T.DateType())) == [date(2025, 1, 1)]


def test_moments(spark):
    parsed = moment_from(F.col("v"), T.StringType())
    assert values(spark, "string", ["2025-11-11 10:00:00", "x"], parsed) == [datetime(2025, 11, 11, 10), None]
    assert values(spark, "date", [date(2025, 1, 1)], moment_from(F.col("v"), T.DateType())) == [datetime(2025, 1, 1)]
    moments = [datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 1), None]
    assert values(spark, "timestamp_ntz", moments, first_midnight_from(F.col("v"))) == [
        date(2025, 1, 1), date(2025, 1, 2), None]


def test_as_day():
    assert as_day(" 2025-01-02 ") == as_day(date(2025, 1, 2)) == as_day(datetime(2025, 1, 2, 3)) == date(2025, 1, 2)
    assert as_day(None) is as_day("  ") is None
    with pytest.raises(ValueError):
        as_day("02/01/2025")


def test_null_markers(spark):
    frame = spark.createDataFrame(
        [("NaN", "x", 1), ("nan", "@NULL@", 2), ("NULL", "null", 3)], "a string, b string, n int")
    assert [tuple(r) for r in null_markers_to_null(frame).collect()] == [(None, "x", 1), (None, None, 2), (None, "null", 3)]
    numbers = spark.range(2)
    assert null_markers_to_null(numbers).columns == ["id"]


def test_align_schema(spark):
    frame = spark.sql("SELECT '7' AS HOTEL_ID, 5L AS No_Of_Rooms, 'x' AS `Odd ``Name`")
    aligned = align_schema(frame, schemas.HOTELS)
    assert [(f.name, f.dataType.simpleString()) for f in aligned.schema] == [
        ("hotel_id", "bigint"), ("no_of_rooms", "int"), ("odd `name", "string")]
    assert tuple(aligned.first()) == (7, 5, "x")


def test_align_schema_rejects_names_that_differ_by_case(spark):
    frame = spark.createDataFrame([(1, 2)], "id int, ID int")
    with pytest.raises(ValueError, match="id"):
        align_schema(frame, schemas.HOTELS)


def test_conform(spark):
    text = spark.sql("SELECT 'Web' AS source, 'x' AS extra, '' AS src_sgmnt_id, NULL AS segment")
    assert [tuple(r) for r in conform(text, schemas.SEGMENTS).collect()] == [(None, "Web", None)]
    with pytest.raises(ValueError, match="segment"):
        conform(text.drop("segment"), schemas.SEGMENTS)


def test_copies_are_counted(spark):
    frame = spark.createDataFrame([(1, None)] * 5 + [(1, "a")] * 2 + [(None, None)], "k int, v string")
    assert sorted(r.copies for r in collapse_copies(frame).collect()) == [1, 2, 5]


def test_latest_versions_keeps_whole_rows(spark):
    frame = spark.sql(
        """SELECT * FROM VALUES (1, timestamp'2025-01-01', 'old'), (1, timestamp'2025-01-02', 'a'),
           (1, timestamp'2025-01-02', 'a'), (1, timestamp'2025-01-02', 'b'), (1, timestamp'2025-01-09', 'late'),
           (2, timestamp'2025-01-01', 'c') AS t(bkg_num, load_datetime, note)""")
    found = latest_versions(frame, date(2025, 1, 3))
    assert sorted(r.note for r in found.collect()) == ["a", "a", "b", "c"]
    assert found.columns == frame.columns


def test_ties_without_a_booking_are_spread_over_tasks(spark):
    """All rows of a load stamp tie, and have no booking number: they are one key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        log = spark.range(0, 100_000, 1, 8).select(
            F.lit(None).cast("bigint").alias("bkg_num"), F.lit(datetime(2025, 1, 1)).alias("load_datetime"),
            F.concat(F.lit("row "), "id").alias("note"),
        )
        found = latest_versions(log, date(2025, 1, 3)).withColumn("task", F.spark_partition_id())
        rows = found.groupBy("task").count().collect()
        assert sum(r["count"] for r in rows) == 100_000
        assert len(rows) > 1
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_long_stays_go_by_blocks(spark):
    stays = spark.createDataFrame([(1, date(2025, 1, 1), date(2028, 1, 1)), (2, date(2025, 1, 1), date(2025, 1, 1))],
                                  "id int, arrival date, departure date")
    nights = stay_nights(stays)
    assert [r.stay_date for r in nights.orderBy("stay_date").collect()] == [
        date(2025, 1, 1) + timedelta(days=n) for n in range(1095)]
    assert nights.columns == [*stays.columns, "stay_date"]
    assert stay_nights(stays, F.lit(date(2027, 12, 30))).count() == 2


def test_conform_looks_names_up_in_any_case(spark):
    upper = spark.sql("SELECT '3' AS SRC_SGMNT_ID, 'Web' AS Source, 'x' AS segment")
    assert [tuple(r) for r in conform(upper, schemas.SEGMENTS).collect()] == [(3, "Web", "x")]
    both = spark.createDataFrame([("a", "b")], "source string, SOURCE string")
    with pytest.raises(ValueError, match="case"):
        conform(both, schemas.SEGMENTS)


def test_align_schema_gives_null_for_text_that_does_not_parse(spark):
    frame = spark.sql("SELECT '' AS HOTEL_ID, 'x' AS no_of_rooms")
    assert tuple(align_schema(frame, schemas.HOTELS).first()) == (None, None)


def test_null_markers_in_columns_with_dots(spark):
    frame = spark.createDataFrame([("NaN", 1)], "`a.b` string, `c.d` int")
    assert tuple(null_markers_to_null(frame).first()) == (None, 1)


def test_reports_need_a_date():
    with pytest.raises(ValueError, match="date"):
        given_day("  ")
    assert given_day("2025-01-02") == date(2025, 1, 2)


def test_session_settings():
    tib = 1024**4
    assert session_settings(10 * tib, 4000)["spark.sql.shuffle.partitions"] == "10240"
    assert session_settings(100 * tib, 4000)["spark.sql.shuffle.partitions"] == "20000"
    assert session_settings(1, 8)["spark.sql.shuffle.partitions"] == "8"
