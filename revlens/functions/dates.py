"""Date parts used by the review sheets; all are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Review dates arrive as '12 11, 2015' and '02 2, 2018'; 'd' accepts both day widths.
REVIEW_TIME_FORMAT = "MM d, yyyy"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_review_time(c, fmt: str = REVIEW_TIME_FORMAT) -> Column:
    """Text date -> date; rows that do not parse become null instead of failing the job."""
    return F.try_to_date(_c(c), fmt)


def epoch_date(c) -> Column:
    """Epoch seconds (unixReviewTime) -> UTC calendar date (independent of the session time zone)."""
    return F.date_from_unix_date(F.floor(_c(c) / F.lit(86400)).cast("int"))


def date_epoch_seconds(c) -> Column:
    """Date -> epoch seconds of its UTC midnight (independent of the session time zone)."""
    return F.unix_date(_c(c)).cast("bigint") * F.lit(86400)


def week_part(c) -> Column:
    """Week number with Sunday start where week 1 holds January 1st.

    ISO ``weekofyear`` counts differently; this is the calendar-sheet week.
    """
    d = _c(c)
    return F.ceil((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - F.lit(1)) / F.lit(7)).cast("int")


def weekday_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def month_name(c) -> Column:
    return F.date_format(_c(c), "MMMM")


def month_start(c) -> Column:
    """Month period as the first day of the month (a date, not a timestamp)."""
    return F.trunc(_c(c), "month")
