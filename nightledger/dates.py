"""Date arguments at the edge of the library."""

from datetime import date, datetime, timedelta


def as_day(value):
    """A date from a date, a datetime or ISO text; None and blank text give None."""
    if isinstance(value, datetime):
        return value.date()
    if value is None or isinstance(value, date):
        return value
    text = value.strip()
    return date.fromisoformat(text) if text else None


def given_day(value):
    """As `as_day`, but there has to be a date."""
    day = as_day(value)
    if day is None:
        raise ValueError("a report needs a date; defaults are those of the jobs")
    return day


def days_ago(n):
    return date.today() - timedelta(days=n)
