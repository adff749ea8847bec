"""Scalar building blocks, returned as ``Column`` so that they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marketplace and currency codes and the country each stands for.
COUNTRY_BY_CODE = {
    "Amazon.co.mx": "Mexico",
    "Amazon.ca": "Canada",
    "Amazon.co.uk": "United Kingdom",
    "Amazon.com": "United States",
    "USD": "United States",
    "CAD": "Canada",
    "INR": "India",
    "UK": "United Kingdom",
    "US": "United States",
}

_TIME_UNITS = {
    "MILLISECOND", "SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR",
}


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def datetime_add(col: Column | str, amount: Column | int, unit: str) -> Column:
    """Add ``amount`` units to a date-time; a zone-less timestamp stays zone-less."""
    unit = unit.upper()
    if unit not in _TIME_UNITS:
        raise ValueError(f"unknown time unit {unit!r}")
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(unit, amount, _column(col))


def epoch_ms_to_timestamp(col: Column | str) -> Column:
    """Epoch milliseconds as a zone-less UTC timestamp, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return datetime_add(epoch, _column(col).cast("bigint"), "MILLISECOND")


def epoch_ms_to_date(col: Column | str) -> Column:
    """UTC calendar date of an epoch-millisecond number."""
    return epoch_ms_to_timestamp(col).cast("date")


def as_date(col: Column | str, lenient: bool = False) -> Column:
    """Calendar date of a column; ``lenient`` gives NULL for unreadable text."""
    col = _column(col)
    return col.try_cast("date") if lenient else col.cast("date")


def country_name(col: Column | str) -> Column:
    """Country of a marketplace or currency code; unknown codes pass unchanged."""
    col = _column(col)
    pairs = [F.lit(part) for pair in COUNTRY_BY_CODE.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def json_field(variant: Column | str, path: str, kind: str = "string") -> Column:
    """One typed field of a variant value; NULL when absent or not of that type."""
    return F.try_variant_get(_column(variant), f"$.{path}", kind)
