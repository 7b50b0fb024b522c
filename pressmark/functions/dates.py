"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressmark import constants as K


def date_text(text: Column) -> Column:
    """First ``Month D, YYYY`` in a text, trimmed; null when there is none."""
    return F.nullif(F.trim(F.regexp_extract(text, f"({K.DATE_PATTERN})", 1)), F.lit(""))


def parse_month_day_year(text: Column) -> Column:
    """``December 12, 2014`` to a date; null when the month is unknown or the day does not exist."""
    spaced = F.regexp_replace(text, r"\s+", " ")
    return F.try_to_timestamp(spaced, F.lit("MMMM d, yyyy")).cast("date")


def upload_folder(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/")


def rfc2822(day: Column, zone: str = "UTC") -> Column:
    """Midnight of the day in ``zone``, as a mail header date in universal time."""
    at = F.to_utc_timestamp(day.cast("timestamp_ntz").cast("string").cast("timestamp"), zone)
    return F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss '-0000'")


def midnight_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd 00:00:00")


def month_of(argument: str) -> tuple[int, int]:
    """Month and year of an ``mm/yyyy`` argument; a ``ValueError`` when it is not one."""
    import re

    found = re.fullmatch(K.MONTH_PATTERN, argument)
    if not found or not 1 <= int(found[1]) <= 12:
        raise ValueError(f"not a month of the form mm/yyyy: {argument!r}")
    return int(found[1]), int(found[2])
