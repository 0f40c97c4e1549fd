"""Rooms on books: rooms and revenue per future stay night, as seen on a date."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..dates import as_day, given_day
from ..fixed_values import (
    BOOKED_STATUSES,
    EXCLUDED_PRICE_GROUPS,
    EXCLUDED_ROOM_TYPES,
    STATUS_LABELS,
)
from ..functions.codes import recode
from ..functions.parsing import day_from
from ..functions.rates import effective_rate
from ..operators.joins import with_hotels, with_segment_ids, with_segments
from ..operators.nights import stay_nights
from ..operators.versions import (
    collapse_copies,
    daily_latest,
    latest,
    loaded_by,
    with_valid_from,
)
from ..schemas import ROB_REVENUE

BOOKING_KEYS = ["hotel_id", "reservation_status", "src_sgmnt_id"]
MEASURES = ["rob", "room_revenue", "stays", "with_rooms", "with_revenue"]
REPORT_KEYS = [
    "stay_date", "hotel_id", "hotel_code", "no_of_rooms", "source", "segment",
    "reservation_status", "owned_vs_managed",
]


def rooms():
    """Rooms of a stay, times the rows that say so; NULL when the rooms are."""
    return F.col("num_of_room_booked") * F.col("copies")


def revenue():
    """Price of one night of a stay; NULL when its rooms or rate are."""
    return rooms() * F.col("room_rate")


def counts_as_booked():
    """Status, room type and price group of a version that counts; NULL codes do not."""
    return (
        F.col("reservation_status").isin(BOOKED_STATUSES)
        & ~F.col("room_typ").isin(EXCLUDED_ROOM_TYPES)
        & ~F.col("price_typ_grp").isin(EXCLUDED_PRICE_GROUPS)
    )


def slim(versions, first_day=None):
    """Key and load time of each version, plus the stay if it can count, after `first_day` if given.

    Versions that cannot count still have to be there to supersede older ones,
    but only their key and load time go into the shuffle.
    """
    kinds = {field.name: field.dataType for field in versions.schema}
    arrival = day_from(F.col("arrival_dt"), kinds["arrival_dt"])
    departure = day_from(F.col("departure_dt"), kinds["departure_dt"])
    stay = F.struct(
        arrival.alias("arrival"),
        departure.alias("departure"),
        F.col("hotel_id"),
        F.col("reservation_status"),
        F.col("num_of_room_booked"),
        effective_rate(F.col("rm_rate"), F.col("rm_rate_wo_split")).alias("room_rate"),
    )
    counts = counts_as_booked() & (departure > arrival)
    if first_day is not None:
        counts &= departure > first_day
    kept = [name for name in ("bkg_num", "load_datetime", "valid_from") if name in kinds]
    return versions.select(*kept, F.when(counts, stay).alias("stay"))


def _stays(versions, *more):
    """The stays of the versions that have one; equal ones together, with how many there are in `copies`."""
    stays = versions.filter(F.col("stay").isNotNull()).select("bkg_num", "stay.*", *more)
    return collapse_copies(stays)


def booked_stays(reservations, day):
    """Stays booked as of `day` that still have nights to come, with `copies` each."""
    return _stays(latest(slim(loaded_by(reservations, day), F.lit(day)), "bkg_num"))


def booked_stays_in_range(reservations, start, end):
    """Stays booked on some day of the range, with the days each was the latest version."""
    seen = with_valid_from(loaded_by(reservations, end), start)
    kept = daily_latest(slim(seen, F.col("valid_from")), end)
    return _stays(kept, "valid_from", "valid_to")


def _decorated(totals, hotels, segments):
    return with_segments(with_hotels(totals, hotels, "hotel_id"), segments)


def _report(totals, *more):
    return totals.select(
        *more,
        "as_of_date",
        "stay_date",
        "hotel_id",
        "hotel_code",
        F.col("no_of_rooms").alias("inventory"),
        F.col("source").alias("source_nm"),
        F.col("segment").alias("segment_nm"),
        recode(F.col("reservation_status"), STATUS_LABELS).alias("reservation_status"),
        F.col("room_revenue").cast(ROB_REVENUE).alias("room_revenue"),
        "rob",
        "owned_vs_managed",
    )


def rob(reservations, hotels, bridge, segments, as_of):
    """Rooms on books as of one date.

    Bookings are totalled per night, hotel id, status and segment id first;
    hotels and segments are joined to those totals, and totals that share all
    report columns are added up after that.
    """
    day = given_day(as_of)
    return stays_report(booked_stays(reservations, day), hotels, bridge, segments, day)


def stays_report(stays, hotels, bridge, segments, day):
    """The report of the stays that are on books as of `day`."""
    totals = (
        stay_nights(with_segment_ids(stays, bridge), not_before=F.lit(day))
        .groupBy("stay_date", *BOOKING_KEYS)
        .agg(F.sum(rooms()).alias("rob"), F.sum(revenue()).alias("room_revenue"))
    )
    return _report(
        _decorated(totals, hotels, segments)
        .groupBy(*REPORT_KEYS)
        .agg(F.sum("rob").alias("rob"), F.sum("room_revenue").alias("room_revenue"))
        .withColumn("as_of_date", F.lit(day))
    )


def rob_range(reservations, hotels, bridge, segments, start, end, by_quarter=False):
    """Rooms on books as of every date from `start` to `end`, in one plan.

    `start` None begins at the first load. A stay night adds to all dates from
    the first that sees it to the last; instead of repeating it for each of them
    it is counted once as a change on the first and once, negative, on the day
    after the last. Running sums of the changes over the dates give the report. Changes move once
    for both sums, a quarter of a hotel's nights to one task: so a task has all of what a later sum by date
    and hotel adds up, and passes on one row for it.

    `by_quarter` is for ranges much longer than stays are on books, where a night has hardly more stays than one and
    sums are no smaller than what they add up: see `quarter_totals`. The rows are the same, with the first day of
    their date's `quarter` before them; what is added up by quarter, date and hotel code does not move again.
    """
    first, end = as_day(start), given_day(end)
    stays = booked_stays_in_range(reservations, first, end)
    if by_quarter:
        return reported(quarter_totals(stays, hotels, bridge, segments, end), "quarter")
    changes = night_changes(stays, bridge, end)
    keys = [*REPORT_KEYS, "quarter"]
    per_night = (
        _decorated(changes, hotels, segments)
        .withColumn("quarter", F.trunc("stay_date", "quarter"))
        .repartition("hotel_id", "quarter")
        .groupBy(*keys, "day")
        .agg(*[F.sum(name).alias(name) for name in MEASURES])
    )
    return reported(running_totals(per_night, keys, end).filter(F.col("stays") > 0))


def quarter_totals(stays, hotels, bridge, segments, end):
    """Totals by REPORT_KEYS for every as_of_date, a `quarter` of those dates and a hotel code in one task.

    Stays move there, cut at the ends of quarters, and become nights and changes where they are then. A quarter begins with
    the stays that are on books, and a night ends with its date, so that only stays that are replaced before take from it.
    """
    keys = [*REPORT_KEYS, "quarter"]
    placed = _decorated(with_segment_ids(stays, bridge), hotels, segments).drop("bkg_num", "src_sgmnt_id")
    dealt = stay_quarters(placed).repartition("hotel_code", "quarter")
    last_day = F.least("stay_date", F.date_sub(F.add_months("quarter", 3), 1), F.lit(end))
    begins = F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("sign"))
    ends = F.struct(F.date_add("valid_to", 1).alias("day"), F.lit(-1).alias("sign"))
    per_night = (
        stay_nights(dealt, not_before=F.col("valid_from"))
        .withColumn("change", F.explode(F.when(F.col("valid_to") < last_day, F.array(begins, ends)).otherwise(F.array(begins))))
        .groupBy(*keys, F.col("change.day").alias("day"))
        .agg(*_sums_of_changes(F.col("change.sign")))
    )
    return running_totals(per_night, keys, last_day).filter(F.col("stays") > 0)


def stay_quarters(stays):
    """Stays cut at the ends of quarters: one row per `quarter` with days that see the stay, `valid_from` to `valid_to`."""
    last = F.least("valid_to", F.date_sub("departure", 1))
    quarters = F.sequence(F.trunc("valid_from", "quarter"), F.trunc(last, "quarter"), F.expr("interval 3 months"))
    return (
        stays.filter(F.col("valid_from") <= last)
        .withColumn("quarter", F.explode(quarters))
        .withColumn("valid_from", F.greatest("valid_from", "quarter"))
        .withColumn("valid_to", F.least("valid_to", F.date_sub(F.add_months("quarter", 3), 1)))
    )


def _sums_of_changes(sign):
    return [
        F.sum(sign * rooms()).alias("rob"),
        F.sum(sign * revenue()).alias("room_revenue"),
        # How many stays are on books, and how many of them have rooms and a rate:
        # sums over none are absent or NULL, not zero.
        F.sum(sign).alias("stays"),
        F.sum(F.when(rooms().isNotNull(), sign)).alias("with_rooms"),
        F.sum(F.when(revenue().isNotNull(), sign)).alias("with_revenue"),
    ]


def night_changes(stays, bridge, end):
    """Per night, booking keys and day: what that day adds to, and takes from, the totals of the night.

    `stays` hold the days that see them, `valid_from` to `valid_to`. A night counts until it is past.
    """
    last_day = F.least("valid_to", "stay_date")
    change = F.explode(
        F.array(
            F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("sign")),
            F.struct(F.date_add(last_day, 1).alias("day"), F.lit(-1).alias("sign")),
        )
    )
    sign = F.col("change.sign")
    return (
        stay_nights(with_segment_ids(stays, bridge), not_before=F.col("valid_from"))
        .withColumn("change", change)
        .withColumn("day", F.col("change.day"))
        .filter(F.col("day") <= F.lit(end))
        .groupBy("stay_date", "day", *BOOKING_KEYS)
        .agg(*_sums_of_changes(sign))
    )


def running_totals(changes, keys, end):
    """The changes added up, for every `as_of_date` from the first change of `keys` to `end`, a date or a column of `keys`."""
    by_day = Window.partitionBy(*keys).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = changes.select(
        *keys,
        "day",
        *[F.sum(name).over(so_far).alias(name) for name in MEASURES],
        F.lead("day").over(by_day).alias("next_day"),
    )
    until = F.coalesce(F.date_sub("next_day", 1), F.lit(end))
    days = F.explode(F.sequence("day", until, F.expr("interval 1 day")))
    return running.withColumn("as_of_date", days).drop("day", "next_day")


def reported(totals, *more):
    """The report of totals by REPORT_KEYS and as_of_date, with `more` columns of them before it."""
    return _report(
        totals.withColumn("rob", F.when(F.col("with_rooms") > 0, F.col("rob")))
        .withColumn("room_revenue", F.when(F.col("with_revenue") > 0, F.col("room_revenue"))),
        *more,
    )


def rooms_by_date_and_hotel(report):
    """A ROB report added up per as-of date, stay date and hotel."""
    return report.groupBy("as_of_date", "stay_date", "hotel_id").agg(
        F.sum("rob").alias("rob_sum"),
        F.sum("room_revenue").cast(ROB_REVENUE).alias("room_revenue_sum"),
    )
