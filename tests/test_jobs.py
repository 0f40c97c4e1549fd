from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import version
from pyspark.sql import functions as F

from nightledger import schemas
from nightledger.plans import jobs
from nightledger.plans.rob import rob, rob_range
from nightledger.sinks.versions import DatedVersions


def days(spark, path):
    return sorted(r.as_of_date for r in jobs.stored(spark, path).select("as_of_date").distinct().collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "out")


@pytest.fixture
def facts(spark):
    today = date.today()
    rows = [((today - timedelta(days=n)).strftime("%d-%m-%Y"), "H7", 3, 10, Decimal("1.00")) for n in (40, 3, 2, 1, 0)]
    return spark.createDataFrame(
        rows, "business_date string, hotel_code string, src_sgmnt_id int, room_nights bigint, room_revenue decimal(18,2)")


def test_rob_daily_is_for_today(spark, tables, path):
    today = date.today()
    frames = tables([version(arrival=today.isoformat(), departure=(today + timedelta(days=2)).isoformat())])
    jobs.rob_daily(*frames, path, as_of="  ")
    assert days(spark, path) == [today]
    jobs.rob_daily(*frames, path)
    assert jobs.stored(spark, path).count() == 2


def test_rob_bulk_runs_from_the_first_load_to_yesterday(spark, tables, path):
    today = date.today()
    start = today - timedelta(days=4)
    frames = tables([version(load=start.isoformat(), arrival=today.isoformat(), departure=(today + timedelta(days=1)).isoformat())])
    jobs.rob_bulk(*frames, path, start="", end=" ")
    assert days(spark, path) == [start + timedelta(days=n) for n in range(4)]


def test_rob_bulk_with_one_bound_given(spark, tables, path):
    frames = tables([version()])
    jobs.rob_bulk(*frames, path, start=None, end="2025-03-03")
    assert days(spark, path) == [date(2025, 3, 1), date(2025, 3, 2), date(2025, 3, 3)]
    jobs.rob_bulk(*frames, path, start=date(2025, 3, 9), end=" ")
    assert days(spark, path) == [date(2025, 3, d) for d in (1, 2, 3, 9, 10, 11)]


def test_bulk_then_daily_gives_the_daily_report(spark, tables, path):
    frames = tables([version(), version(bkg_num=2, load="2025-03-02")])
    jobs.rob_bulk(*frames, path, "2025-03-01", "2025-03-04", table="job_check")
    jobs.rob_daily(*frames, path, "2025-03-02", table="job_check")
    day = date(2025, 3, 2)
    expected = rob(*frames, day)
    stored = spark.table("job_check").filter(f"as_of_date = date'{day}'").select(expected.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect()))
    spark.sql("DROP VIEW job_check")


def test_dates_left_without_rows_are_emptied(spark, tables, path):
    booked, cancelled = version(), version(load="2025-03-02", status=9)
    jobs.rob_bulk(*tables([booked]), path, "2025-03-01", "2025-03-04")
    assert len(days(spark, path)) == 4
    jobs.rob_bulk(*tables([booked, cancelled]), path, None, "2025-03-03")
    assert days(spark, path) == [date(2025, 3, 1), date(2025, 3, 4)]
    jobs.rob_daily(*tables([cancelled]), path, "2025-03-04", table="emptied_check")
    assert days(spark, path) == [date(2025, 3, 1)]
    assert spark.table("emptied_check").count() == 2
    spark.sql("DROP VIEW emptied_check")


def test_a_first_run_without_rows(spark, tables, path):
    jobs.rob_daily(*tables([version(status=9)]), path, "2025-03-04", table="first_check")
    assert spark.table("first_check").count() == 0
    spark.sql("DROP VIEW first_check")


def test_append_repeats_a_date(spark, tables, path):
    for _ in range(2):
        jobs.rob_daily(*tables([version()]), path, "2025-03-04", mode="append")
    assert jobs.stored(spark, path).count() == 4


def test_mat_daily_is_for_yesterday(spark, tables, facts, path):
    _, hotels, _, segments = tables([version()])
    jobs.mat_daily(facts, hotels, segments, path)
    assert days(spark, path) == [date.today() - timedelta(days=1)]
    jobs.mat_daily(facts, hotels, segments, path, day=(date.today() - timedelta(days=3)).isoformat())
    assert len(days(spark, path)) == 2


def test_mat_bulk_runs_from_the_first_fact_to_two_days_ago(spark, tables, facts, path):
    _, hotels, _, segments = tables([version()])
    jobs.mat_bulk(facts, hotels, segments, path, start=" ", end=None, tasks=2)
    assert days(spark, path) == [date.today() - timedelta(days=n) for n in (40, 3, 2)]
    assert jobs.stored(spark, path).drop("as_of_date").columns == [
        "hotel_id", "hotel_code", "inventory", "source_nm", "segment_nm", "Total_rooms", "total_room_revenue"]
    assert schemas.MAT_REVENUE == jobs.stored(spark, path).schema["total_room_revenue"].dataType


def by_day(df):
    return {day: sorted(str(r) for r in df.filter(F.col("as_of_date") == F.lit(day)).collect()) for day in {r.as_of_date for r in df.collect()}}


def test_a_state_is_brought_forward_and_days_can_be_run_again(spark, tables, path, tmp_path):
    """Arrivals count once however often a day is run; going back to a day forgets what came after it."""
    state = str(tmp_path / "state")
    first = [version(), version(bkg_num=2, status=9), version(bkg_num=3, load="2025-03-04")]
    second = [version(load="2025-03-02", status=9), version(bkg_num=4, load="2025-02-20"), version(bkg_num=2, load="2025-02-28")]
    third = [version(bkg_num=5, load="2025-03-03")]
    days = [date(2025, 3, 1), date(2025, 3, 2), date(2025, 3, 4)]
    log, others = [], tables([version()])[1:]
    for day, part in zip(days, (first, second, third)):
        arrivals = tables(part)[0]
        log += part
        for _ in range(2):
            jobs.rob_daily_from_state(arrivals, *others, path, state, as_of=day, table="state_check")
        expected = by_day(rob(tables(log)[0], *others, day))
        assert by_day(spark.table("state_check").select(rob(tables(log)[0], *others, day).columns)).get(day, []) == expected.get(day, [])
    store = DatedVersions(spark, state, "state_day")
    assert store.dates() == days[1:]
    # The second day once more, without what came on the third.
    jobs.rob_daily_from_state(tables(third)[0], *others, path, state, as_of=days[2], table="state_check")
    assert store.read(days[2], days[2]).count() == 5
    spark.sql("DROP VIEW state_check")


def test_a_range_is_extended_by_deliveries(spark, tables, path, tmp_path):
    totals = str(tmp_path / "totals")
    parts = [
        [version(departure="2025-03-20"), version(bkg_num=2, departure="2025-03-20")],
        [version(bkg_num=2, load="2025-03-04", status=9)],
        [version(bkg_num=2, load="2025-03-02", rooms=3, departure="2025-03-20"), version(bkg_num=3, load="2025-03-06", departure="2025-03-21")],
        [],
    ]
    start, ends = date(2025, 3, 1), [date(2025, 3, 3), date(2025, 3, 5), date(2025, 3, 7), date(2025, 3, 8)]
    log, others = [], tables([version()])[1:]
    for n, (end, part) in enumerate(zip(ends, parts)):
        before, arrivals = tables(log)[0], tables(part)[0]
        log += part
        for _ in range(2):
            jobs.rob_extend(arrivals, before, *others, path, totals, f"delivery {n}", end, start=start, table="extend_check")
        whole = rob_range(tables(log)[0], *others, start, end)
        assert by_day(spark.table("extend_check").select(whole.columns)) == by_day(whole)
    spark.sql("DROP VIEW extend_check")
