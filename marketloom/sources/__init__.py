"""Finding the raw tables of a feed and tagging their rows."""

from marketloom.sources.conform import DROP, FAIL, NULL, conform, rejected
from marketloom.sources.registry import Registry, SourceTable, discover
from marketloom.sources.scan import Scan, scans
from marketloom.sources.tagging import (
    BRAND,
    HOURS,
    SOURCE,
    STORE,
    brand_and_store,
    name_part,
    name_part_column,
    normalize_meta,
    tag_source,
)

__all__ = [
    "BRAND",
    "DROP",
    "FAIL",
    "HOURS",
    "NULL",
    "Registry",
    "SOURCE",
    "STORE",
    "Scan",
    "SourceTable",
    "brand_and_store",
    "conform",
    "discover",
    "name_part",
    "name_part_column",
    "normalize_meta",
    "rejected",
    "scans",
    "tag_source",
]
