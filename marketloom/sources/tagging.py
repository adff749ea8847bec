"""Brand, store and ingestion metadata of one raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.settings import Lineage, Settings
from marketloom.sources.conform import conform
from marketloom.sources.registry import SourceTable
from marketloom.sources.scan import FOLDER, folder_key
from marketloom.streaming.incremental import lookback_filter

# Internal tag columns, never part of an output.
BRAND = "__brand"
STORE = "__store"
SOURCE = "__source"
HOURS = "__hours"


def name_part(table_name: str, position: int) -> str:
    """The part of a table name between underscores at a position, case kept."""
    parts = table_name.split("_")
    if not 0 <= position < len(parts):
        raise ValueError(f"table name {table_name!r} has no part {position}")
    return parts[position]


def name_part_column(col: Column | str, position: int) -> Column:
    """Relational form of :func:`name_part`; NULL when the name has too few parts."""
    col = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(F.split(col, "_"), F.lit(position + 1))


def brand_and_store(table_name: str, settings: Settings) -> tuple[str, str]:
    brand = settings.default_brand
    if settings.brand_from_name:
        brand = name_part(table_name, settings.brand_position)
    store = settings.default_store
    if settings.store_from_name:
        store = name_part(table_name, settings.store_position)
    return brand, store


def normalize_meta(df: DataFrame, lineage: Lineage, mixed: bool = False) -> DataFrame:
    """Give the ingestion columns their unified names, with or without underscore.

    ``mixed`` rows come from several tables, which may use either name.
    """
    present = {name.lower(): name for name in df.columns}
    renames = {}
    for name in lineage.names:
        bare = name.removeprefix("_").lower()
        if name.lower() in present:
            if mixed and bare in present and bare != name.lower():
                df = df.withColumn(name, F.coalesce(name, present[bare]))
            continue
        if bare not in present:
            raise ValueError(f"neither {name!r} nor {bare!r} is a column of the raw table")
        renames[present[bare]] = name
    return df.withColumnsRenamed(renames)


def _tags(table: SourceTable, settings: Settings) -> tuple[str, str, str, int]:
    brand, store = brand_and_store(table.name, settings)
    offsets = settings.tz_offsets  # by full name first: schemas may share table names
    return brand, store, table.full_name, offsets.get(table.full_name, offsets.get(table.name, 0))


def tag_source(
    df: DataFrame,
    table: SourceTable,
    raw_columns: T.StructType,
    settings: Settings,
    mark: int | None = None,
    among: Sequence[SourceTable] = (),
    exact: bool = False,
) -> DataFrame:
    """Narrow a raw table to what its feed needs and tag the rows with their origin.

    A declared column that the table lacks is NULL, one of another type is converted;
    columns are found by name, whatever their case. The look-back filter sits here, directly
    above the scan, where it reaches the Parquet reader. The tags of a table are literals;
    rows of several tables (``among``) find theirs by the folder of their file, in a table
    with one row for each of them.
    """
    lineage = settings.lineage
    df = normalize_meta(df, lineage, mixed=bool(among))
    if mark is not None:
        df = lookback_filter(df, lineage.runtime, mark)
    df = conform(df, raw_columns, settings.unreadable, settings.lenient_dates, exact, table.full_name)
    present = {name.lower() for name in df.columns}
    columns = [
        F.col(f"`{field.name}`") if field.name.lower() in present
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in raw_columns
    ]
    names = [BRAND, STORE, SOURCE, *([HOURS] if settings.tz_offsets else [])]
    if not among:
        tags = dict(zip(names, map(F.lit, _tags(table, settings))))
        return df.select(*columns, *lineage.names).withColumns(tags)
    rows = [(folder_key(df.sparkSession, t.folder), *_tags(t, settings)) for t in among]
    kind = f"__folder string, {BRAND} string, {STORE} string, {SOURCE} string, {HOURS} int"
    tags = df.sparkSession.createDataFrame(rows, kind).select("__folder", *names)
    tagged = df.select(*columns, *lineage.names, FOLDER).join(
        F.broadcast(tags), F.col(FOLDER) == F.col("__folder"))
    return tagged.drop(FOLDER, "__folder")
