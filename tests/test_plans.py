"""What the plans look like: pushed filters, pruned columns, sums before shuffles, no cross joins."""

import re
from datetime import date

import pytest

from checks.queries import QUERIES
from nightledger.operators import versions
from nightledger.plans.mat import mat_range
from nightledger.plans.rob import rob, rob_range
from nightledger.sinks.tables import write_bucketed
from nightledger.sources import stand_in

SF_DIR = "/root/testdata/sf0.001"
DAY = date(1998, 6, 1)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def rob_tables(spark):
    return (
        stand_in.reservations(spark, SF_DIR, DAY),
        stand_in.hotels(spark, SF_DIR),
        stand_in.bridge(spark, SF_DIR),
        stand_in.segments(spark, SF_DIR),
    )


def shuffle_keys(plan):
    return re.findall(r"Arguments: hashpartitioning\((.*), \d+\), ", plan)


def keys_of(plan):
    return [re.sub(r"#\d+L?", "", key) for key in shuffle_keys(plan)]


def test_rob_shuffles(spark, no_broadcast, capsys):
    plan = plan_of(rob(*rob_tables(spark), DAY), capsys)
    keys = keys_of(plan)
    # The log is read once and moves once, by booking; what is older than another row of its task stays behind.
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("WindowGroupLimit") >= 2 and keys.count("bkg_num") == 1
    # Copies are counted and bridge links join where the bookings are; links are counted before.
    assert not any("arrival" in key or "load_datetime" in key for key in keys)
    assert keys.count("source_rsrv_id, src_sgmnt_id") == 1
    # Totals of nights are formed before hotels and segments come in.
    nights = keys.index("stay_date, hotel_id, reservation_status, src_sgmnt_id")
    assert keys.index("bkg_num") < nights < keys.index("hotel_id") < keys.index("src_sgmnt_id")


def test_a_range_moves_the_log_once(spark, no_broadcast, capsys):
    plan = plan_of(rob_range(*rob_tables(spark), date(1998, 5, 1), DAY), capsys)
    keys = keys_of(plan)
    assert plan.count("lineitem.parquet") == 1
    # By booking; all later moves are of bridge links, changes and dimensions.
    assert keys.count("bkg_num") == 1
    assert not any("valid_from" in key or "arrival" in key or "load_datetime" in key for key in keys)


def test_bucketed_log_and_bridge_do_not_move(spark, no_broadcast, tmp_path, capsys):
    log, hotels, bridge, segments = rob_tables(spark)
    for df, table, key in ((log, "bucketed_log", "bkg_num"), (bridge, "bucketed_bridge", "source_rsrv_id")):
        write_bucketed(df, table, key, 4, str(tmp_path / table))
    dealt = spark.table("bucketed_log"), hotels, spark.table("bucketed_bridge"), segments
    for report in (rob(*dealt, DAY), rob_range(*dealt, date(1998, 5, 1), DAY)):
        keys = keys_of(plan_of(report, capsys))
        # What moves first are totals of nights, or changes of them.
        assert keys and keys[0].startswith("stay_date")
        assert not any("bkg_num" in key or "source_rsrv_id" in key for key in keys)
    for table in ("bucketed_log", "bucketed_bridge"):
        spark.sql(f"DROP TABLE {table}")


def test_hot_bookings_have_no_window(spark, no_broadcast, monkeypatch, capsys):
    """Where keys are hot, only narrow columns are grouped by them; rows go by a join that can be split."""
    monkeypatch.setattr(versions, "HOT_ROWS", 0)
    monkeypatch.setattr(versions, "SAMPLE", 1.0)
    slim = rob_tables(spark)[0].select("bkg_num", "load_datetime", "hotel_id")
    hot = versions.hot_keys(slim, "bkg_num")
    assert 0 < len(hot) <= 1 / versions.HOT_SHARE
    every = [row.name for row in slim.select(versions._named("bkg_num").alias("name")).distinct().collect()]
    plan = plan_of(versions.latest(slim, "bkg_num", hot=every), capsys)
    assert "SortMergeJoin" in plan and "partial_max(load_datetime" in plan


def test_changes_of_a_range_move_once_for_both_sums(spark, no_broadcast, capsys):
    """A quarter of a hotel is in one task, so that sums by date and hotel are whole before they move."""
    keys = keys_of(plan_of(rob_range(*rob_tables(spark), None, DAY), capsys))
    assert keys.count("hotel_id, quarter") == 1 and not any("hotel_code" in key for key in keys)


def test_stays_of_all_dates_move_before_they_are_expanded(spark, no_broadcast, capsys):
    """Neither nights nor changes of them move, and what is added up by date and hotel code is there already."""
    keys = keys_of(plan_of(QUERIES["rob_bulk_default_start"](spark, SF_DIR), capsys))
    assert keys.count("bkg_num") == 1 and keys.count("hotel_code, quarter") == 1
    assert not any("stay_date" in key or "as_of_date" in key for key in keys)


def test_scans_are_pruned_and_filtered(spark, capsys):
    plan = plan_of(rob(*rob_tables(spark), DAY), capsys)
    assert "LessThanOrEqual(l_shipdate,1998-06-01T00:00)" in plan
    assert "l_tax" not in plan and "o_orderdate" not in plan
    facts = stand_in.hotel_facts(spark, SF_DIR, text_dates=False)
    hotels, _, segments = rob_tables(spark)[1:]
    week = plan_of(mat_range(facts, hotels, segments, DAY, date(1998, 6, 7)), capsys)
    assert "GreaterThanOrEqual(l_shipdate" in week and "LessThan(l_shipdate" in week


def test_text_dates_of_a_range_are_filtered_and_added_up_once(spark, capsys):
    hotels, _, segments = rob_tables(spark)[1:]
    facts = stand_in.hotel_facts(spark, SF_DIR)
    sums = lambda plan: keys_of(plan).count("business_date, hotel_code, src_sgmnt_id")
    assert sums(plan_of(mat_range(facts, hotels, segments, DAY, DAY), capsys)) == 1
    # Of an open range only totals are parsed.
    assert sums(plan_of(mat_range(facts, hotels, segments, None, DAY), capsys)) == 2


WRITING = {
    name for name in QUERIES if name.endswith(("_roundtrip", "_job")) or name in (
        "truncate_overwrite", "rejected_cells", "table_append", "catalog_refresh", "load_audit", "load_audit_once", "mat_landed_daily", "csv_inferred", "rob_from_csv")
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_joins_and_no_python_in_plans(spark, no_broadcast, capsys, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR), capsys)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        if node == "SinglePartition" and name in ("row_count", "min_load_bound", "fiscal_calendar", "named_tables"):
            continue  # one figure over the whole table
        assert node not in plan
