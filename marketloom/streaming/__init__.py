"""Handling of re-delivered and late data by repeated batch runs."""

from marketloom.streaming.incremental import (
    high_water_mark,
    lookback_filter,
    merge_upsert,
    stored_mark,
)

__all__ = ["high_water_mark", "lookback_filter", "merge_upsert", "stored_mark"]
