from datetime import date, timedelta
from decimal import Decimal

import pytest

from nightledger import schemas
from nightledger.operators.schema import conform
from nightledger.plans.mat import mat, mat_range, rooms_by_date_and_hotel
from nightledger.plans.sql_reports import mat_by_hotel

FACTS = [
    ("05-11-2025", "AAA1", 1, 10, "1000.50"),
    ("06-11-2025", "AAA1", 1, 20, "2000.25"),
    ("06-11-2025", "AAA1", 1, 5, None),
    ("06-11-2025", "AAA1", 2, None, "10.00"),
    ("06-11-2025", "BBB2", 9, 7, "70.00"),
    ("06-11-2025", "ZZZ9", None, 3, "30.00"),
    ("06-11-2025", "RFHDL1", 1, 4, "40.00"),
    ("06-11-2025", "LTHDL", 1, 6, "60.00"),
    ("07-11-2025", "AAA1", 1, 30, "3000.00"),
]
HOTELS = [(-1, "AAA1", 50, "Owned"), (2, "BBB2", 60, "Managed"), (3, "RFHDL1", 70, "Owned"), (4, "LTHDL", 70, "Owned")]
SEGMENTS = [(1, "Web", "Leisure"), (2, "Web", "Leisure")]
TEXT = "business_date string, hotel_code string, src_sgmnt_id string, room_nights string, room_revenue string"


@pytest.fixture
def raw(spark):
    rows = [tuple(None if v is None else str(v) for v in row) for row in FACTS]
    return spark.createDataFrame(rows, TEXT)


@pytest.fixture
def frames(spark, raw):
    text_dates = raw.select(
        "business_date",
        *[raw[f.name].cast(f.dataType) for f in schemas.HOTEL_FACTS if f.name != "business_date"],
    )
    return (
        text_dates,
        spark.createDataFrame(HOTELS, schemas.HOTELS),
        spark.createDataFrame(SEGMENTS, schemas.SEGMENTS),
    )


def rows(report):
    return sorted((tuple(r) for r in report.collect()), key=str)


def test_one_date(frames):
    day = date(2025, 11, 6)
    assert rows(mat(*frames, day)) == sorted(
        [
            # Two segment ids of the same name make one row.
            (day, -1, "AAA1", 50, "Web", "Leisure", 25, Decimal("2010.25")),
            (day, 2, "BBB2", 60, None, None, 7, Decimal("70.00")),
            (day, None, "ZZZ9", None, None, None, 3, Decimal("30.00")),
            (day, 3, "RFHDL1", 70, "Web", "Leisure", 4, Decimal("40.00")),
            (day, 4, "LTHDL", 70, "Web", "Leisure", 6, Decimal("60.00")),
        ],
        key=str,
    )


def test_text_and_date_columns_and_arguments_agree(raw, frames):
    facts, *dims = frames
    dated = conform(raw, schemas.HOTEL_FACTS)
    expected = rows(mat(facts, *dims, date(2025, 11, 6)))
    assert rows(mat(facts, *dims, " 2025-11-06 ")) == expected
    assert rows(mat(dated, *dims, "2025-11-06")) == expected


def test_range_is_the_union_of_its_dates(frames):
    days = [date(2025, 11, 5) + timedelta(days=n) for n in range(3)]
    each = [row for day in days for row in rows(mat(*frames, day))]
    assert rows(mat_range(*frames, days[0], days[-1])) == sorted(each, key=str)
    assert rows(mat_range(*frames)) == sorted(each, key=str)
    assert rows(mat_range(*frames, "2020-01-01", "2025-12-31")) == sorted(each, key=str)
    assert rows(mat_range(*frames, "2025-11-07", "2025-11-06")) == []
    # Bounds are inclusive, and text bounds do not compare as text.
    assert {r[0] for r in rows(mat_range(*frames, "2025-11-06", None))} == set(days[1:])


def test_ranges_of_any_length_read_text_alike(spark, frames):
    """Days written without leading zeros come together with the others, where the parser takes them."""
    _, *dims = frames
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")
    try:
        facts = spark.createDataFrame(
            [("1-6-1998", "AAA1", 1, 5, Decimal("1.00")), ("01-06-1998", "AAA1", 1, 10, Decimal("1.00")),
             ("02-06-0999", "AAA1", 1, 3, Decimal("1.00"))], frames[0].schema)
        short = rows(mat_range(facts, *dims, "1998-06-01", "1998-06-02"))
        long = rows(mat_range(facts, *dims, "1998-06-01", "1999-12-02"))
        assert short == long
        assert [row[6] for row in short] == [15]
        assert [row[6] for row in rows(mat(facts, *dims, "0999-06-02"))] == [3]
    finally:
        spark.conf.unset("spark.sql.legacy.timeParserPolicy")


def test_a_blank_date_is_refused(frames):
    with pytest.raises(ValueError):
        mat(*frames, " ")


def test_unreadable_dates_belong_to_no_date(spark, frames):
    facts, *dims = frames
    bad = spark.createDataFrame([("2025-11-06", "AAA1", 1, 99, Decimal("1.00"))], facts.schema)
    assert rows(mat(facts.union(bad), *dims, "2025-11-06")) == rows(mat(*frames, "2025-11-06"))


def test_repeated_hotels_multiply(spark, frames):
    facts, hotels, segments = frames
    twice = {(r.hotel_code, r.Total_rooms) for r in mat(facts, hotels.union(hotels), segments, "2025-11-05").collect()}
    assert twice == {("AAA1", 20)}


def test_added_up_by_hotel(frames):
    report = rooms_by_date_and_hotel(mat_range(*frames))
    found = {(r.as_of_date.day, r.hotel_code): (r.rob_sum, r.revenue_sum) for r in report.collect()}
    assert found[(6, "AAA1")] == (25, Decimal("2010.25"))
    assert len(found) == 7


def test_coarse_report_recodes_after_the_join(frames):
    report = mat_by_hotel(*frames)
    found = [tuple(r) for r in report.collect()]
    assert report.columns == ["as_of_date", "hotel_code", "inventory", "ROB", "total_room_revenue"]
    # Both codes have 70 rooms, so they merge; a code that is recoded keeps its own hotel's rooms.
    assert (date(2025, 11, 6), "LTHDL", 70, 10, Decimal("100.00")) in found
    assert [row[0] for row in found] == sorted(row[0] for row in found)
    assert not any(row[1] == "RFHDL1" for row in found)


def test_types(frames):
    assert [f.dataType.simpleString() for f in mat_range(*frames).schema] == [
        "date", "bigint", "string", "int", "string", "string", "bigint", "decimal(28,2)"
    ]
