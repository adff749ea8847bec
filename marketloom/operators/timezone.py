"""Time-zone standardisation by a whole-hour offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import datetime_add


def shift_timezone(df: DataFrame, columns: list[str], hours: Column | int) -> DataFrame:
    """Move local date-times by an offset in hours; names and order stay."""
    return df.withColumns({name: datetime_add(name, hours, "HOUR") for name in columns})


def is_datetime(type_name: str) -> bool:
    return type_name.startswith("timestamp")
