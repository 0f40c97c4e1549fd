"""One small case per rule of the rooms-on-books report."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import version

from nightledger import schemas
from nightledger.operators.schema import conform
from nightledger.plans.rob import rob, rob_range, rooms_by_date_and_hotel
from nightledger.plans.sql_reports import rob_room_nights

DAY = date(2025, 3, 5)


def nights(report):
    return sorted((r.stay_date.isoformat(), r.rob, str(r.room_revenue)) for r in report.collect())


def test_counts_each_future_night(tables):
    rows = rob(*tables([version(rooms=2)]), DAY).collect()
    assert [(r.stay_date, r.rob, r.room_revenue) for r in sorted(rows)] == [
        (date(2025, 3, 10), 2, Decimal("200.00")),
        (date(2025, 3, 11), 2, Decimal("200.00")),
    ]
    assert {(r.as_of_date, r.hotel_id, r.hotel_code, r.inventory, r.source_nm, r.segment_nm,
             r.reservation_status, r.owned_vs_managed) for r in rows} == {
        (DAY, 7, "H7", 40, "Web", "Leisure", "Confirmed", "Owned")}


def test_cancelled_latest_version_hides_the_older_one(tables):
    log = [version(load="2025-03-01"), version(load="2025-03-02", status=9)]
    assert rob(*tables(log), DAY).count() == 0


def test_tied_versions_all_count(tables):
    log = [version(rooms=1), version(rooms=2)]
    assert [r.rob for r in rob(*tables(log), DAY).collect()] == [3, 3]


def test_copies_of_a_version_all_count(tables):
    assert [r.rob for r in rob(*tables([version()] * 5), DAY).collect()] == [5, 5]


def test_versions_loaded_later_that_day_are_not_seen(tables):
    log = [version(load="2025-03-01", rooms=1), version(load="2025-03-05 10:00:00", rooms=4)]
    frames = tables(log)
    assert {r.rob for r in rob(*frames, DAY).collect()} == {1}
    assert {r.rob for r in rob(*frames, date(2025, 3, 6)).collect()} == {4}
    midnight = tables([version(load="2025-03-05", rooms=4)])
    assert {r.rob for r in rob(*midnight, DAY).collect()} == {4}


@pytest.mark.parametrize(
    "codes",
    [{"room_typ": None}, {"room_typ": 32}, {"price_group": None}, {"price_group": 681}, {"status": None}, {"status": 9}],
)
def test_versions_that_do_not_count(tables, codes):
    assert rob(*tables([version(**codes)]), DAY).count() == 0


@pytest.mark.parametrize("status, label", [(0, "Confirmed"), (5, "Tentative")])
def test_integer_status_is_decoded(tables, status, label):
    assert {r.reservation_status for r in rob(*tables([version(status=status)]), DAY).collect()} == {label}


def test_day_use_stay_has_no_nights(spark, tables):
    _, *others = tables([version()])
    day_use = spark.sql(
        """SELECT 1L AS bkg_num, timestamp'2025-03-01 00:00:00' AS load_datetime,
                  timestamp'2025-03-10 10:00:00' AS arrival_dt, timestamp'2025-03-10 18:00:00' AS departure_dt,
                  0 AS reservation_status, 1 AS room_typ, 10.00BD AS rm_rate, 10.00BD AS rm_rate_wo_split,
                  7L AS hotel_id, 5 AS price_typ_grp, 1 AS num_of_room_booked"""
    )
    assert rob(day_use, *others, DAY).count() == 0


def test_text_columns_give_the_same_report(spark, tables):
    typed = tables([version(rate=None, rooms=2), version(bkg_num=2, status=5)])
    text = typed[0].select(*[typed[0][name].cast("string") for name in typed[0].columns])
    assert nights(rob(conform(text, schemas.RESERVATIONS), *typed[1:], DAY)) == nights(rob(*typed, DAY))


def test_duplicate_bridge_rows_multiply(tables):
    assert {r.rob for r in rob(*tables([version()], bridge=[(1, 3), (1, 3)]), DAY).collect()} == {2}


def test_unknown_hotel_and_segment_keep_their_rows(tables):
    rows = rob(*tables([version(hotel_id=99)], bridge=[(1, 88)]), DAY).collect()
    assert {(r.hotel_id, r.hotel_code, r.inventory, r.source_nm) for r in rows} == {(99, None, None, None)}
    assert rob(*tables([version()], bridge=[]), DAY).count() == 2


def test_segments_of_one_name_are_added_up(tables):
    rows = rob(*tables([version()], bridge=[(1, 3), (1, 4)], segments=[(3, "Web", "X"), (4, "Web", "X")]), DAY)
    assert [r.rob for r in rows.collect()] == [2, 2]


def test_repeated_dimension_rows_multiply(tables):
    hotels = [(7, "H7", 40, "Owned"), (7, "H7", 40, "Owned"), (7, "H7b", 40, "Owned")]
    found = {(r.hotel_code, r.rob) for r in rob(*tables([version()], hotels=hotels), DAY).collect()}
    assert found == {("H7", 2), ("H7b", 1)}


def test_departure_day_has_no_nights_left(tables):
    frames = tables([version()])
    assert rob(*frames, date(2025, 3, 12)).count() == 0
    assert [r.stay_date for r in rob(*frames, date(2025, 3, 11)).collect()] == [date(2025, 3, 11)]


def test_inventory_is_a_key_not_a_sum(tables):
    log = [version(), version(bkg_num=2)]
    rows = rob(*tables(log, bridge=[(1, 3), (2, 3)]), DAY).collect()
    assert {(r.inventory, r.rob) for r in rows} == {(40, 2)}


def test_missing_rates_and_rooms(tables):
    fallback = rob(*tables([version(rate=None)]), DAY).collect()
    assert {r.room_revenue for r in fallback} == {Decimal("80.00")}
    no_rate = rob(*tables([version(rate=None, other_rate=None)]), DAY).collect()
    assert {(r.rob, r.room_revenue) for r in no_rate} == {(1, None)}
    no_rooms = rob(*tables([version(rooms=None)]), DAY).collect()
    assert {(r.rob, r.room_revenue) for r in no_rooms} == {(None, None)}


def test_as_of_as_text_date_or_datetime(tables):
    frames = tables([version()])
    expected = nights(rob(*frames, DAY))
    assert nights(rob(*frames, "2025-03-05")) == expected
    assert nights(rob(*frames, datetime(2025, 3, 5, 13))) == expected


def test_all_nights_of_a_long_stay_count(tables):
    frames = tables([version(arrival="2025-03-10", departure="2026-04-14")])
    assert rob(*frames, DAY).count() == 400
    report = rob_room_nights(*frames, DAY).collect()
    assert len(report) == 400
    assert {r.number_of_room_nights for r in report} == {400}
    assert rob_room_nights(*frames, date(2025, 3, 20)).count() == 390


def test_a_blank_date_is_refused(tables):
    frames = tables([version()])
    for blank in (None, "  "):
        with pytest.raises(ValueError):
            rob(*frames, blank)
        with pytest.raises(ValueError):
            rob_room_nights(*frames, blank)


def test_room_nights_report_is_ordered_with_raw_status(tables):
    rows = rob_room_nights(*tables([version(departure="2025-03-20", status=5)]), DAY).collect()
    assert [r.stay_date for r in rows] == sorted(r.stay_date for r in rows)
    assert {r.reservation_status for r in rows} == {5}
    assert "owned_vs_managed" not in rows[0].asDict()


def test_added_up_by_hotel(tables):
    report = rob(*tables([version(), version(bkg_num=2, status=5)]), DAY)
    assert {r.rob_sum for r in rooms_by_date_and_hotel(report).collect()} == {2}


def test_range_of_one_date_is_that_date(tables):
    frames = tables([version(), version(load="2025-03-04", rooms=3)])
    assert nights(rob_range(*frames, DAY, DAY)) == nights(rob(*frames, DAY))


def test_columns_and_types(tables):
    report = rob(*tables([version()]), DAY)
    assert [(f.name, f.dataType.simpleString()) for f in report.schema] == [
        ("as_of_date", "date"), ("stay_date", "date"), ("hotel_id", "bigint"), ("hotel_code", "string"),
        ("inventory", "int"), ("source_nm", "string"), ("segment_nm", "string"), ("reservation_status", "string"),
        ("room_revenue", "decimal(31,2)"), ("rob", "bigint"), ("owned_vs_managed", "string"),
    ]
    ranged = rob_range(*tables([version()]), DAY, DAY)
    assert [(f.name, f.dataType) for f in ranged.schema] == [(f.name, f.dataType) for f in report.schema]
