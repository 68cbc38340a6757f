"""MM-dd-yy dates (years 2000 to 2099), month buckets and day series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_blanks

DATE_PATTERN = "MM-dd-yy"


def parse_date(c: Column) -> Column:
    """Date of the text; anything that is not a real calendar day becomes NULL."""
    return F.try_to_date(F.trim(c), DATE_PATTERN)


def parse_date_clamped(c: Column) -> Column:
    """As parse_date, but control characters are trimmed too, and days 29 to 31
    missing from a month mean its last day."""
    text = trim_blanks(c)
    first = F.concat(
        F.lit("20"), F.substring(text, 7, 2), F.lit("-"), F.substring(text, 1, 2), F.lit("-01")
    ).try_cast("date")
    # Clean text stops at the first step; the others run for the rest only.
    return F.coalesce(
        parse_date(c),
        F.try_to_date(text, DATE_PATTERN),
        F.when(text.rlike("^[0-9]{2}-(29|30|31)-[0-9]{2}$"), F.last_day(first)),
    )


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def following_days(day: Column, length: Column) -> Column:
    """Array of the `length` days after `day`, `day` itself excluded."""
    return F.sequence(F.date_add(day, 1), F.date_add(day, length))
