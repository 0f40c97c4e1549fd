"""Rooms on books over a growing log, without reading it again each day.

Two things can be stored. The state holds of each booking the newest version as of a day, and versions that
are loaded later: with a day's arrivals it gives the next day's state and report. Night totals hold the
running totals of each as-of date before hotels and segments join: they are extended by what arrivals change, on
earlier dates too where loads come late.
"""

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from ..functions.parsing import first_midnight_from, moment_from
from ..operators.versions import daily_latest, hot_keys, latest, with_valid_from
from .rob import BOOKING_KEYS, MEASURES, REPORT_KEYS, _decorated, night_changes, reported, running_totals, slim, stays_report

STATE = ["bkg_num", "load_datetime", "stay"]
NIGHT_KEYS = ["stay_date", *BOOKING_KEYS]


def _counted(rows):
    """Equal rows together, their copies added up."""
    return rows.groupBy(*[name for name in rows.columns if name != "copies"]).agg(F.sum("copies").alias("copies"))


def _rows_of(versions):
    """Key, load time and the stay if it can count, of each version that has a load time."""
    kind = versions.schema["load_datetime"].dataType
    timed = versions.withColumn("load_datetime", moment_from(F.col("load_datetime"), kind))
    return slim(timed).filter(F.col("load_datetime").isNotNull()).select(*STATE)


def state_of(versions):
    """Versions in the form of the state: key, load time, the stay if it can count, and copies."""
    return _rows_of(versions).groupBy(*STATE).agg(F.count(F.lit(1)).alias("copies"))


def advanced(state, arrivals, day):
    """The state as of `day`, from an earlier one (None: none) and the versions that have come since.

    It does not matter when arrivals were loaded. Of versions loaded by `day` only the newest of each booking
    count from now on; those loaded later wait, each load time for itself. Rows move once, to their booking, and
    equal ones are added up where they then are.
    """
    rows = _rows_of(arrivals).withColumn("copies", F.lit(1).cast("long"))
    keys = arrivals.select("bkg_num")
    if state is not None:
        rows = state.select(*rows.columns).unionByName(rows)
        keys = state.select("bkg_num").unionByName(keys)
    load = F.col("load_datetime")
    parted = rows.withColumn("waits_for", F.when(load > F.lit(day), load))
    return _counted(latest(parted, "bkg_num", hot_keys(keys, "bkg_num"), ["waits_for"])).select(*STATE, "copies")


def state_report(state, hotels, bridge, segments, day):
    """Rooms on books as of the day of the state."""
    on_books = state.filter((F.col("load_datetime") <= F.lit(day)) & (F.col("stay.departure") > F.lit(day)))
    return stays_report(on_books.select("bkg_num", "stay.*", "copies"), hotels, bridge, segments, day)


def _changes(rows, bridge, start, end):
    """Night changes of state rows in the range."""
    seen = with_valid_from(rows.filter(F.col("load_datetime") <= F.lit(end)), start)
    kept = daily_latest(seen, end).filter(F.col("stay.departure") > F.col("valid_from"))
    stays = _counted(kept.select("bkg_num", "stay.*", "valid_from", "valid_to", "copies"))
    return night_changes(stays, bridge, end)


def _added(rows):
    """Totals of equal nights and dates added up; nights without stays go."""
    sums = [F.sum(F.coalesce(name, F.lit(0))).alias(name) for name in MEASURES]
    return rows.groupBy("as_of_date", *NIGHT_KEYS).agg(*sums).filter(F.col("stays") > 0)


def night_totals(reservations, bridge, start, end):
    """Totals per as-of date from `start` to `end`, night and booking keys."""
    return _added(running_totals(_changes(state_of(reservations), bridge, start, end), NIGHT_KEYS, end))


def first_changed(arrivals, last):
    """The first as-of date that arrivals change, if dates up to `last` are stored: the next one, or that of the earliest late load."""
    kind = arrivals.schema["load_datetime"].dataType
    first = F.min(first_midnight_from(moment_from(F.col("load_datetime"), kind)))
    seen, following = arrivals.agg(first.alias("day")).first()["day"], last + timedelta(days=1)
    return following if seen is None else min(seen, following)


def extended_totals(totals, history, arrivals, bridge, first, last, end):
    """The totals of the as-of dates from `first` to `end`, where those up to `last` are stored without the arrivals.

    `first` is `first_changed`, but not before the first stored date. `history` holds, in the form of the state, the versions
    that came before: of late loads all there are, else a state as of `last` will do. Only bookings with
    arrivals, or with versions loaded since, are looked at: their changes with arrivals less those without. The bridge must
    link their earlier versions as it did.
    """
    fresh = state_of(arrivals)
    since = history.filter((F.col("load_datetime") > F.lit(last)) & (F.col("load_datetime") <= F.lit(end)))
    touched = fresh.select("bkg_num").unionByName(since.select("bkg_num")).distinct().withColumnRenamed("bkg_num", "touched")
    before = history.join(touched, F.col("bkg_num").eqNullSafe(F.col("touched")), "left_semi")
    after = _changes(before.unionByName(fresh.select(*before.columns)), bridge, first, end)
    gone = _changes(before.filter(F.col("load_datetime") <= F.lit(last)), bridge, first, end)
    less = gone.select(*NIGHT_KEYS, "day", *[(-F.col(name)).alias(name) for name in MEASURES])
    sums = [F.sum(name).alias(name) for name in MEASURES]
    changes = after.select(less.columns).unionByName(less).groupBy(*NIGHT_KEYS, "day").agg(*sums)
    columns = ["as_of_date", *NIGHT_KEYS, *MEASURES]
    parts = [running_totals(changes, NIGHT_KEYS, end), totals.filter(F.col("as_of_date").between(F.lit(first), F.lit(last)))]
    new_days = F.sequence(F.date_add(F.lit(last), 1), F.lit(end), F.expr("interval 1 day"))
    carried = totals.filter(F.col("as_of_date") == F.lit(last)).withColumn("as_of_date", F.explode(new_days))
    parts.append(carried.filter(F.col("stay_date") >= F.col("as_of_date")))
    return _added(reduce(lambda a, b: a.unionByName(b), [part.select(columns) for part in parts]))


def totals_report(totals, hotels, segments):
    """The report of night totals, all as-of dates there are."""
    whole = (
        _decorated(totals, hotels, segments)
        .groupBy(*REPORT_KEYS, "as_of_date")
        .agg(*[F.sum(name).alias(name) for name in MEASURES])
    )
    return reported(whole)
