"""Column functions: all are compositions of built-in Spark SQL functions."""

from marketloom.functions.columns import (
    as_date,
    country_name,
    datetime_add,
    epoch_ms_to_date,
    epoch_ms_to_timestamp,
    json_field,
)

__all__ = [
    "as_date",
    "country_name",
    "datetime_add",
    "epoch_ms_to_date",
    "epoch_ms_to_timestamp",
    "json_field",
]
