"""Commits of stored dates: all of the old or all of the new, whatever fails or comes in between."""

import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from nightledger.plans import jobs
from nightledger.sinks import versions
from nightledger.sinks.audit import audited_commit, committed_audits
from nightledger.sinks.versions import DatedVersions


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def rows(spark, *days, label="a", n=3):
    """n rows on each of these days of January 2025; None is no date."""
    found = [(None if day is None else date(2025, 1, day), i, label) for day in days for i in range(n)]
    return spark.createDataFrame(found, "as_of_date date, id int, label string")


def shown(df):
    return sorted({(r.as_of_date and r.as_of_date.day, r.label) for r in df.collect()}, key=str)


DAY = [date(2025, 1, day) for day in range(0 + 1, 11)]


def test_a_range_is_replaced_and_nothing_else(spark, path):
    store = DatedVersions(spark, path)
    store.replace(rows(spark, 1, 2, 3, 4), DAY[0], DAY[3])
    store.replace(rows(spark, 2, label="b"), DAY[1], DAY[2])
    assert shown(store.read()) == [(1, "a"), (2, "b"), (4, "a")]
    assert shown(store.read(DAY[1], DAY[2])) == [(2, "b")]
    assert store.read(DAY[8], DAY[9]).count() == 0
    # The commit before can still be read.
    assert shown(store.read(number=1)) == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]


def test_a_failing_write_changes_nothing(spark, path):
    store = DatedVersions(spark, path)
    store.replace(rows(spark, 1, 2), DAY[0], DAY[1])
    broken = rows(spark, 1, 2, label="b").withColumn("id", F.when(F.col("as_of_date") == DAY[1], F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        store.replace(broken, DAY[0], DAY[1])
    assert shown(store.read()) == [(1, "a"), (2, "a")] and store.numbers() == [1]


def test_a_reader_in_the_middle_sees_the_old_or_the_new(spark, path, monkeypatch):
    """At each step of a rerun readers that begin there, and one that began before, see one report."""
    store, seen = DatedVersions(spark, path), []
    store.replace(rows(spark, 1, 2, 3), DAY[0], DAY[2])
    early = store.read()
    old, new = [(1, "a"), (2, "a"), (3, "a")], [(1, "b"), (3, "b")]

    def watching(step):
        def run(self, *args, **more):
            seen.append(shown(DatedVersions(spark, path).read()))
            out = step(self, *args, **more)
            seen.append(shown(DatedVersions(spark, path).read()))
            return out
        return run

    for name in ("_written", "_put", "clean"):
        monkeypatch.setattr(DatedVersions, name, watching(getattr(DatedVersions, name)))
    store.replace(rows(spark, 1, 3, label="b"), DAY[0], DAY[2])
    assert seen == [old, old, old, new, new, new]
    assert shown(early) == old


def test_two_writers(spark, path, monkeypatch):
    """The one that comes second builds on the other's commit."""
    store, put, others = DatedVersions(spark, path), DatedVersions._put, [1]

    def late(self, found):
        if others:
            others.pop()
            DatedVersions(spark, path).replace(rows(spark, 5, label="other"), DAY[4], DAY[4])
        return put(self, found)

    store.replace(rows(spark, 1), DAY[0], DAY[0])
    monkeypatch.setattr(DatedVersions, "_put", late)
    store.replace(rows(spark, 2), DAY[1], DAY[1])
    assert shown(store.read()) == [(1, "a"), (2, "a"), (5, "other")] and store.numbers()[-1] == 3


def test_what_was_replaced_goes_later(spark, path, tmp_path):
    store = DatedVersions(spark, path)
    folders = lambda: len(list((tmp_path / "store" / "data").iterdir()))
    for n in range(5):
        store.replace(rows(spark, 1, label=f"v{n}"), DAY[0], DAY[0])
        assert folders() == min(n + 1, 2) and len(store.numbers()) == min(n + 1, 2)
    # What a failed write has left goes after a week.
    (tmp_path / "store" / "data" / "version=lost").mkdir()
    store.clean(now=time.time() + 1)
    assert folders() == 3
    store.clean(now=time.time() + versions.ORPHAN_SECONDS + 60)
    assert folders() == 2 and shown(store.read()) == [(1, "v4")]


def test_rows_without_a_date(spark, path):
    store = DatedVersions(spark, path)
    store.replace(rows(spark, 1, None), None, None)
    store.replace(rows(spark, 1, label="b"), None, DAY[4])
    assert shown(store.read()) == [(1, "b"), (None, "a")]
    assert shown(store.read(None, DAY[4])) == [(1, "b")]
    store.replace(rows(spark, 2), None, None)
    assert shown(store.read()) == [(2, "a")]
    store.replace(rows(spark), DAY[0], DAY[9])
    assert store.read().count() == 0


def test_appended_loads_replace_themselves(spark, path):
    store = DatedVersions(spark, path)
    load = lambda key: lambda: (key, {"key": key})
    store.append(rows(spark, 1, 2), load=load("x"))
    store.append(rows(spark, 2, 3, label="b"), load=load("y"))
    store.append(rows(spark, 2, label="c"), load=load("x"))
    assert shown(store.read()) == [(2, "b"), (2, "c"), (3, "b")]
    assert store.read().count() == 9 and store.loads() == {"x": {"key": "x"}, "y": {"key": "y"}}


def test_the_catalog_changes_hands_in_one_statement(spark, path, monkeypatch):
    monkeypatch.setattr(versions, "PARTITIONS_AT_ONCE", 2)
    store = DatedVersions(spark, path)
    store.replace(rows(spark, 1, 2, 3, 4, None), None, None)
    store.publish("published_check")
    reader = spark.table("published_check")
    store.replace(rows(spark, 2, label="b"), DAY[1], DAY[3])
    assert shown(spark.table("published_check")) == [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (None, "a")]
    store.publish("published_check")
    assert shown(spark.table("published_check")) == [(1, "a"), (2, "b"), (None, "a")]
    assert shown(reader) == [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (None, "a")]
    assert spark.table("published_check").columns == ["as_of_date", "id", "label"]
    spark.sql("DROP VIEW published_check")


def test_a_crash_after_the_write_leaves_one_record(spark, path, monkeypatch):
    fields = dict(job_name="j", table_name="t", glue_run_id="r", src_sys_id=1, s3_file_modified_datetime=None)
    load = lambda: audited_commit(rows(spark, 1, 2), path, F.col("id"), F.col("as_of_date"), **fields)
    put = DatedVersions._put
    # Once before the commit, once after it: the run is repeated each time.
    monkeypatch.setattr(DatedVersions, "_put", lambda self, found: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load()
    monkeypatch.setattr(DatedVersions, "_put", put)
    monkeypatch.setattr(DatedVersions, "clean", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load()
    monkeypatch.undo()
    load()
    assert [(r.insert_record_count, r.last_record_id) for r in committed_audits(spark, path).collect()] == [(6, 2)]
    assert DatedVersions(spark, path).read().count() == 6


FACTS = "business_date string, hotel_code string, src_sgmnt_id int, room_nights bigint, room_revenue decimal(18,2)"


def test_landed_facts_are_read_by_date(spark, path):
    """One date out of many: the folders of that date alone, by path and by the filter of a plan."""
    facts = spark.createDataFrame([(f"{d:02d}-01-2025", "H7", 3, d, None) for d in range(1, 29)] + [("no date", "H7", 3, 1, None)], FACTS)
    jobs.land_facts(facts, path, "first")
    one = jobs.landed_facts(spark, path, "2025-01-09", "2025-01-09")
    assert [r.room_nights for r in one.collect()] == [9]
    assert len(one.inputFiles()) == 1
    whole = jobs.landed_facts(spark, path)
    assert whole.count() == 29 and whole.filter("business_date is null").count() == 1
    plan = whole.filter(F.col("business_date") == F.lit(date(2025, 1, 9)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_date" in plan
