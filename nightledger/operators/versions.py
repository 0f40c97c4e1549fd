"""Latest versions out of an append log that holds several versions per key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.parsing import first_midnight_from, moment_from

#: A key is hot from this many rows on, if they are also this share of the log.
HOT_ROWS = 50_000
HOT_SHARE = 0.001
#: Keys are counted over this share of the log, drawn alike each time.
SAMPLE = 0.01
SAMPLE_SEED = 17


def loaded_by(log, day):
    """Versions visible at midnight of `day`: one loaded later that day is not."""
    kind = log.schema["load_datetime"].dataType
    return log.withColumn("load_datetime", moment_from(F.col("load_datetime"), kind)).filter(
        F.col("load_datetime") <= F.lit(day)
    )


def collapse_copies(df):
    """One row per distinct row, with how often it occurred in `copies`.

    Counts before the shuffle, so a row repeated across much of the log leaves
    each task once.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def hot_keys(log, key):
    """Names (see `_named`) of the keys that are a large part of the log, at most 1 / HOT_SHARE of them.

    Found by counting a sample of one column, and only used to choose between two ways to the same rows.
    """
    names = log.sample(SAMPLE, SAMPLE_SEED).select(_named(key).alias("name"))
    # The subtotal without a name is that of the whole sample; no name has more.
    counts = names.rollup("name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("name"))
    total, *most = counts.limit(int(1 / HOT_SHARE) + 1).collect() or [None]
    return [row["name"] for row in most if row["n"] >= max(HOT_ROWS * SAMPLE, total["n"] * HOT_SHARE)]


def _named(key):
    """A key as text that is never NULL, since NULL is a key as well."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))


def _parted(log, key, hot):
    """The rows of ordinary keys, and those of hot ones or None; hot keys are looked up if not given."""
    hot = hot_keys(log, key) if hot is None else hot
    if not hot:
        return log, None
    return log.filter(~_named(key).isin(hot)), log.filter(_named(key).isin(hot))


def latest(log, key, hot=None, within=()):
    """Per key, and columns `within` it, the rows with the newest load_datetime, copies and ties included; a NULL key is one.

    A ranking does it in one pass: tasks leave out what is older than another row they hold, and rows move once.
    That would put all ties of a key into one task. For hot keys the newest load is found
    with partial maxima over two narrow columns and joined to the rows, which Spark can split.
    """
    plain, uneven = _parted(log, key, hot)
    keys = [key, *within]
    by_load = Window.partitionBy(*keys).orderBy(F.desc("load_datetime"))
    found = _first_ranked(plain, by_load)
    if uneven is None:
        return found
    newest = uneven.groupBy(*keys).agg(F.max("load_datetime").alias("newest_load"))
    return found.unionByName(_joined(uneven, newest, keys).drop("newest_load"))


def _first_ranked(log, window):
    """Rows that are first in the window, ties included; those without a load time do not count."""
    ranked = log.filter(F.col("load_datetime").isNotNull()).withColumn("newness", F.rank().over(window))
    return ranked.filter(F.col("newness") == 1).drop("newness")


def _joined(log, newest, keys):
    """Rows of `log` with the columns of `newest`, where key and load time agree; rows without a load time do not count."""
    named = newest.withColumnsRenamed({key: f"newest_{key}" for key in keys})
    same = F.col("load_datetime") == F.col("newest_load")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"newest_{key}"))
    return log.join(named, same).drop(*[f"newest_{key}" for key in keys])


def latest_versions(log, day):
    """Every booking's latest version as of `day`, whole rows, copies included."""
    return latest(loaded_by(log, day), "bkg_num")


def with_valid_from(log, start=None):
    """Adds the first day, not before `start`, that sees each version."""
    first = first_midnight_from(F.col("load_datetime"))
    return log.withColumn("valid_from", F.greatest(F.lit(start), first) if start else first)


def daily_latest(log, end, hot=None):
    """Versions that are the latest on at least one day, with the days they are.

    Needs `valid_from`. Of the versions that become visible on the same day only
    the newest matter, which leaves a booking at most one load per day in range;
    it then stays valid until the day before the booking's next one. Rows move once, to
    their booking, or not at all if the log is bucketed by it. For hot bookings the days are found
    over booking, day and load time alone and joined to the rows.
    """
    keys = ["bkg_num", "valid_from"]
    plain, uneven = _parted(log, "bkg_num", hot)
    same_day = Window.partitionBy("bkg_num").orderBy("valid_from").rangeBetween(Window.currentRow, Window.currentRow)
    # Going backwards in time, the days before the current one in the frame are the later ones.
    later = Window.partitionBy("bkg_num").orderBy(F.desc(F.unix_date("valid_from"))).rangeBetween(Window.unboundedPreceding, -1)
    newest = plain.withColumn("newest_load", F.max("load_datetime").over(same_day))
    newest = newest.filter(F.col("load_datetime") == F.col("newest_load")).drop("newest_load")
    found = newest.withColumn("valid_to", _until(F.min("valid_from").over(later), end))
    if uneven is None:
        return found
    newest = uneven.groupBy(*keys).agg(F.max("load_datetime").alias("newest_load"))
    following = F.lead("valid_from").over(Window.partitionBy("bkg_num").orderBy("valid_from"))
    days = newest.withColumn("valid_to", _until(following, end))
    return found.unionByName(_joined(uneven, days, keys).drop("newest_load"))


def _until(following, end):
    """The last day before the next one, or the end."""
    return F.coalesce(F.date_sub(following, 1), F.lit(end))
