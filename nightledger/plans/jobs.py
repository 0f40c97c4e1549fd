"""The jobs: compute a report for a date or a range and store it by date.

Each takes the tables as DataFrames. Dates may be dates or ISO text; None and
blank text mean the default. With `table` the catalog gets that name, or keeps it, as
a view of what the path holds. A rerun replaces the job's dates there in one
step, so that readers see the old report or the new one; with `mode` "append" it adds to it.
`tasks` is that of `write_by_date`. `stored` reads what jobs have stored.
"""

from datetime import date

from pyspark.sql import functions as F

from ..dates import as_day, days_ago
from ..functions.parsing import business_day
from ..sinks.versions import DatedVersions, land_by_date
from .mat import mat_range
from .rob import rob, rob_range
from .rob_state import advanced, extended_totals, first_changed, night_totals, state_of, state_report, totals_report


def _store(report, start, end, path, table, mode, tasks):
    store = DatedVersions(report.sparkSession, path)
    if mode == "replace":
        store.replace(report, start, end, tasks)
    elif mode == "append":
        store.append(report, tasks)
    else:
        raise ValueError(f"unknown mode {mode!r}: expected 'replace' or 'append'")
    if table:
        store.publish(table)


def stored(spark, path, start=None, end=None):
    """What jobs have stored at `path` for these dates."""
    return DatedVersions(spark, path).read(as_day(start), as_day(end))


def land_facts(facts, path, delivery, tasks=None):
    """Adds a delivery of facts to a copy by business date, in which MAT reports of a date read that date only.

    Text dates are parsed here, once. A delivery that is landed again replaces itself.
    """
    day = business_day(F.col("business_date"), facts.schema["business_date"].dataType)
    land_by_date(facts, path, "business_date", day, delivery, tasks)


def landed_facts(spark, path, start=None, end=None):
    """The landed facts of these dates, for the MAT reports."""
    return DatedVersions(spark, path, "business_date").read(as_day(start), as_day(end))


def rob_daily(reservations, hotels, bridge, segments, path, as_of=None, table=None, mode="replace", tasks=None):
    """Rooms on books as of a date; today by default."""
    day = as_day(as_of) or date.today()
    report = rob(reservations, hotels, bridge, segments, day)
    _store(report, day, day, path, table, mode, tasks)


def rob_bulk(
    reservations, hotels, bridge, segments, path, start=None, end=None, table=None, mode="replace", tasks=None
):
    """Rooms on books for a range; from the first load to yesterday by default."""
    first, last = as_day(start), as_day(end) or days_ago(1)
    report = rob_range(reservations, hotels, bridge, segments, first, last)
    _store(report, first, last, path, table, mode, tasks)


def rob_daily_from_state(arrivals, hotels, bridge, segments, path, state_path, as_of=None, table=None, tasks=None):
    """Rooms on books as of a date, today by default, from the stored state of an earlier date and what has arrived since.

    Arrivals may be loaded late, or be versions of days to come. The state as of this date and of the one before
    stay at `state_path`: a rerun starts from the earlier one, so arrivals count once.
    """
    day = as_day(as_of) or date.today()
    store = DatedVersions(arrivals.sparkSession, state_path, "state_day")
    before = [past for past in store.dates() if past < day]
    state = store.read(before[-1], before[-1]).drop("state_day") if before else None
    store.replace(advanced(state, arrivals, day).withColumn("state_day", F.lit(day)), day, None)
    if len(before) > 1:
        store.forget(None, before[-2])
    report = state_report(store.read(day, day), hotels, bridge, segments, day)
    _store(report, day, day, path, table, "replace", tasks)


def rob_extend(
    arrivals, log, hotels, bridge, segments, path, totals_path, delivery, end, start=None, table=None, tasks=None
):
    """Extends the stored report of a range to `end` by a delivery of versions; `log` holds those that came before.

    Only bookings with arrivals are looked at, and only dates that they change are written: new ones, and
    stored ones from the earliest late load on. The first run needs `start`. A delivery that is
    run again after a crash counts once.
    """
    end = as_day(end)
    store = DatedVersions(arrivals.sparkSession, totals_path)
    known = store.loads().get("range")
    if known is None:
        first = as_day(start)
        whole = log.select(arrivals.columns).unionByName(arrivals)
        totals = night_totals(whole, bridge, first, end)
        known = {"start": first.isoformat()}
    elif known["delivery"] == delivery:
        first, totals = as_day(known["first"]), None
    else:
        last = as_day(known["end"])
        end = max(end, last)
        first = max(as_day(known["start"]), first_changed(arrivals, last))
        totals = extended_totals(store.read(min(first, last), last), state_of(log), arrivals, bridge, first, last, end)
    if totals is not None:
        record = {"start": known["start"], "first": first.isoformat(), "end": end.isoformat(), "delivery": delivery}
        store.replace(totals, first, end, load=lambda: ("range", record))
    report = totals_report(store.read(first, end), hotels, segments)
    _store(report, first, end, path, table, "replace", tasks)


def mat_daily(facts, hotels, segments, path, day=None, table=None, mode="replace", tasks=None):
    """The materialized report of one business date; yesterday by default."""
    chosen = as_day(day) or days_ago(1)
    report = mat_range(facts, hotels, segments, chosen, chosen)
    _store(report, chosen, chosen, path, table, mode, tasks)


def mat_bulk(facts, hotels, segments, path, start=None, end=None, table=None, mode="replace", tasks=None):
    """The materialized report of a range; from the first fact to two days ago by default."""
    first, last = as_day(start), as_day(end) or days_ago(2)
    report = mat_range(facts, hotels, segments, first, last)
    _store(report, first, last, path, table, mode, tasks)
