"""Calendar keys and whole-day durations as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

# Weekday names in calendar order, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


MICROS_PER_DAY = SECONDS_PER_DAY * 1_000_000


def day_number(ts) -> Column:
    """Calendar day of the (wall-clock) timestamp as days since 1970-01-01.
    For TIMESTAMP_NTZ this does not depend on the session time zone."""
    return F.unix_date(F.to_date(_col(ts))).cast("bigint")


def micros_of_day(ts) -> Column:
    c = _col(ts)
    secs = F.hour(c) * 3600 + F.minute(c) * 60
    return (secs.cast("bigint") * 1_000_000
            + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint"))


def second_of_day(ts) -> Column:
    """Wall-clock time of day in microseconds (name kept for readability:
    only its order matters to callers)."""
    return micros_of_day(ts)


def whole_days(later, earlier) -> Column:
    """Duration ``later - earlier`` floored to whole days (a negative 1.5 days
    gives -2), matching ``Timedelta.days`` on naive timestamps.  ``datediff``
    would count midnights instead and ``timestampdiff`` truncates toward
    zero.  Computed from calendar day numbers and time of day, so the result
    is the same in every session time zone."""
    micros = ((day_number(later) - day_number(earlier)) * MICROS_PER_DAY
              + micros_of_day(later) - micros_of_day(earlier))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("bigint")


def plus_days(ts, n: int) -> Column:
    return _col(ts) + F.make_interval(days=F.lit(n))


def year_month(ts) -> Column:
    """``YYYY-MM`` month key (pandas Period('M') as text)."""
    return F.date_format(_col(ts), "yyyy-MM")


def month_short_name(ts) -> Column:
    return F.date_format(_col(ts), "MMM")


def weekday_name(ts) -> Column:
    return F.date_format(_col(ts), "EEEE")


def weekday_number(ts) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_col(ts)) + 1


def iso_week(ts) -> Column:
    return F.weekofyear(_col(ts))


def date_text(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def time_features(ts="order_date") -> dict[str, Column]:
    """year, month, month_name, year_month, week, weekday, quarter."""
    return {
        "year": F.year(_col(ts)).cast("int"),
        "month": F.month(_col(ts)).cast("int"),
        "month_name": month_short_name(ts),
        "year_month": year_month(ts),
        "week": iso_week(ts).cast("int"),
        "weekday": weekday_name(ts),
        "quarter": F.quarter(_col(ts)).cast("int"),
    }
