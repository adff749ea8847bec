"""Declarative description of one feed and helpers to write it down briefly."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from marketloom.sinks import Sink

# Stands for the calendar date of the batch runtime.
BATCH_DATE = "batch_date()"


@dataclass(frozen=True)
class Output:
    """One output column: where it comes from and an optional cast."""

    name: str
    source: str
    cast: str | None = None


@dataclass(frozen=True)
class FxRule:
    """Which output columns find the exchange rate and where its columns go."""

    date: str
    currency: str
    leading: bool = False
    null_code_when_off: bool = False


@dataclass(frozen=True)
class FeedSpec:
    """Everything that distinguishes one pipeline from another."""

    name: str
    feed: str
    like: str
    raw_schema: T.StructType
    outputs: tuple[Output, ...]
    keys: tuple[str, ...]
    sink: Sink
    not_like: tuple[str, ...] = ()
    unnest: tuple[str, ...] = ()
    ties: str = "all"
    scope: str = "source"
    tie_break: tuple[str, ...] = ()
    fx: FxRule | None = None
    # Columns written between the batch id and the load stamp.
    after_batch_id: tuple[Output, ...] = ()


def same(names: str) -> tuple[Output, ...]:
    """Raw columns that keep their names."""
    return tuple(Output(name, name) for name in names.split())


def part_of(parent: str, names: str, prefix: str = "") -> tuple[Output, ...]:
    """Fields of an unnested struct, optionally with a name prefix."""
    return tuple(Output(prefix + name, f"{parent}.{name}") for name in names.split())


def renamed(**sources: str) -> tuple[Output, ...]:
    """Output name to source expression."""
    return tuple(Output(name, source) for name, source in sources.items())


def dated(names: str) -> tuple[Output, ...]:
    """Raw date-times cut to their calendar date."""
    return tuple(Output(name, name, "date") for name in names.split())


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def record(columns: str, **arrays: T.StructType) -> T.StructType:
    """A row type: ``name type`` pairs separated by commas, then arrays of row types."""
    fields = []
    for column in filter(None, (text.strip() for text in columns.split(","))):
        name, kind = column.split()
        fields.append(T.StructField(name, TYPES[kind]))
    fields += [T.StructField(name, T.ArrayType(row)) for name, row in arrays.items()]
    return T.StructType(fields)


def strings(names: str) -> str:
    """Column text for names that are all strings."""
    return ", ".join(f"{name} string" for name in names.split())
