"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MAX_DATE, MIN_DATE, WEEKEND_DAYS

# ISO calendar date with 4-digit year and 1- or 2-digit month and day.
ISO_DATE_PATTERN = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"


def parse_iso_date(c: Column) -> Column:
    """String -> DATE; anything not an ISO date in range becomes null.

    The format is fixed, never inferred from a "first row" (which has no
    meaning on a distributed scan). ``try_cast`` keeps ANSI mode on.
    """
    # Behind the shape check the text is exactly yyyy-[m]m-[d]d, which the
    # plain string-to-date cast parses with Spark's hand-written parser (no
    # pattern formatter per row); an impossible day such as 02-30 is null.
    d = c.try_cast("date")
    ok = c.rlike(ISO_DATE_PATTERN) & d.between(F.lit(MIN_DATE).cast("date"), F.lit(MAX_DATE).cast("date"))
    return F.when(ok, d)


# --- Fixed values: English day names in dayofweek() order (1 = Sunday) ---------
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_name(d: Column) -> Column:
    """Full English day name, e.g. ``Saturday`` (an index into DAY_NAMES,
    no date formatter per row)."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.dayofweek(d))


def day_type(weekday: Column) -> Column:
    """``Weekend`` for Saturday/Sunday, else ``Weekday`` (a missing day too)."""
    return F.when(weekday.isin(*WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))
