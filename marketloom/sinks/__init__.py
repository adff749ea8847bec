"""Writing unified tables."""

from marketloom.sinks.publish import recover
from marketloom.sinks.tables import (
    Sink,
    exists,
    layout,
    merge_into_table,
    read_table,
    scratch_folder,
    upsert,
    write_table,
)

__all__ = [
    "Sink",
    "exists",
    "layout",
    "merge_into_table",
    "read_table",
    "recover",
    "scratch_folder",
    "upsert",
    "write_table",
]
