"""Run settings shared by all pipelines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

# 30 days in milliseconds (fixed value): how far behind the newest loaded batch an
# incremental run re-reads the raw tables.
LOOKBACK_MS = 2_592_000_000


@dataclass(frozen=True)
class Lineage:
    """Names of the ingestion metadata columns, raw and unified.

    A raw table may carry each name with or without its leading underscore;
    the unified table always uses the names given here.
    """

    user_id: str = "_batch_user_id"
    runtime: str = "_batch_runtime"
    batch_id: str = "_batch_id"

    @property
    def names(self) -> tuple[str, str, str]:
        return (self.user_id, self.runtime, self.batch_id)


@dataclass(frozen=True)
class Settings:
    """What a caller can vary without touching a feed specification."""

    lineage: Lineage = field(default_factory=Lineage)
    # Brand and store come from the parts of the raw table name, or from a default.
    brand_from_name: bool = True
    brand_position: int = 0
    default_brand: str = ""
    store_from_name: bool = True
    store_position: int = 1
    default_store: str = ""
    # Raw table name -> hours added to its date-times.
    tz_offsets: Mapping[str, int] = field(default_factory=dict)
    # Load stamp; ``None`` means the time of the query.
    run_ts: dt.datetime | None = None
    run_id: str = "manual"
    # Nested arrays: keep rows whose array is empty (outer) or drop them (inner).
    outer_unnest: bool = True
    # Adds brand and store to the business key of the dedup and of the merge.
    lineage_in_key: bool = False
    lookback_ms: int = LOOKBACK_MS
    # Text that is no date becomes NULL where a feed casts to a date, instead of failing.
    lenient_dates: bool = False
    # A raw value that cannot be read as its declared type: "fail" stops the load, "null"
    # loads NULL in its place, "drop" leaves its row out.
    unreadable: str = "fail"
    # Only rates from this currency are attached; ``None`` attaches those from any.
    base_currency: str | None = None
    # A business key with at least this many rows is spread over several tasks.
    hot_key_rows: int = 1_000_000
    # Exchange rates up to this many rows are broadcast, larger ones are joined salted.
    broadcast_rate_rows: int = 2_000_000
    # Raw rows whose arrays unnest to more rows than this are cut and spread over tasks, at the
    # price of a shuffle of the nested rows; ``None`` unnests each row in the task that has it.
    split_product_rows: int | None = None
