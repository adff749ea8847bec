"""Registry of raw tables and discovery by name pattern.

The session catalog folds table names to lower case, which would lose the case
of brand and store, so a registry keeps the names as the caller gives them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def discover(
    tables: DataFrame,
    like: str,
    not_like: Iterable[str] = (),
    schema: str | None = None,
    name_col: str = "table_name",
    schema_col: str = "table_schema",
    catalog: str | None = None,
    catalog_col: str = "table_catalog",
) -> DataFrame:
    """Rows of a table listing whose lower-cased name matches ``like``."""
    name = F.lower(F.col(name_col))
    keep = name.like(like)
    for pattern in not_like:
        keep = keep & ~name.like(pattern)
    if schema is not None:
        keep = keep & (F.col(schema_col) == schema)
    if catalog is not None:
        keep = keep & (F.col(catalog_col) == catalog)
    return tables.where(keep)


def like_matches(name: str, pattern: str) -> bool:
    """SQL LIKE for one lower-cased name (``%`` any text, ``_`` any character)."""
    wild = {"%": ".*", "_": "."}
    regex = "".join(wild.get(ch, re.escape(ch)) for ch in pattern)
    return re.fullmatch(regex, name.lower(), re.DOTALL) is not None


@dataclass(frozen=True)
class SourceTable:
    """One raw table: its original name, where it lives and how to read it.

    A reader that takes a schema can leave out nested fields nobody asks for; the
    Parquet scan then skips their column chunks.
    """

    name: str
    load: Callable[[SparkSession], DataFrame]
    schema: str = ""
    catalog: str = ""
    load_narrow: Callable[[SparkSession, T.StructType], DataFrame] | None = None
    #: Folder of a Parquet table; such tables are read together, by one scan.
    folder: str | None = None
    #: Raw column by which the frame's rows are dealt over its tasks, where one is known.
    dealt_by: str | None = None

    @property
    def full_name(self) -> str:
        return ".".join(part for part in (self.catalog, self.schema, self.name) if part)


class Registry:
    """The raw tables a run may read. Holds names and readers, no data."""

    def __init__(self, tables: Iterable[SourceTable] = ()):
        self.tables = sorted(tables, key=lambda table: table.full_name)

    @classmethod
    def from_frames(
        cls, frames: Mapping[str, DataFrame], schema: str = "", catalog: str = "", dealt_by: str | None = None
    ) -> Registry:
        return cls(
            SourceTable(name, lambda _spark, df=df: df, schema, catalog, dealt_by=dealt_by)
            for name, df in frames.items()
        )

    @classmethod
    def from_paths(
        cls, paths: Mapping[str, str], schema: str = "", fmt: str = "parquet", catalog: str = ""
    ) -> Registry:
        return cls(
            SourceTable(
                name,
                lambda spark, p=path: spark.read.format(fmt).load(p),
                schema,
                catalog,
                load_narrow=lambda spark, kind, p=path: spark.read.format(fmt)
                .schema(kind)
                .load(p),
                folder=path if fmt == "parquet" else None,
            )
            for name, path in paths.items()
        )

    @classmethod
    def from_folder(
        cls, spark: SparkSession, root: str, schema: str = "", catalog: str = ""
    ) -> Registry:
        """Every direct sub-folder of ``root`` is a Parquet table named like the folder."""
        base = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)
        folders = {
            status.getPath().getName(): status.getPath().toString()
            for status in files
            if status.isDirectory() and status.getPath().getName()[0] not in "._"
        }
        return cls.from_paths(folders, schema, catalog=catalog)

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        schema: str,
        names: Iterable[str] | None = None,
        catalog: str = "",
    ) -> Registry:
        """Tables of a schema, in the given or the current catalog; ``names`` restores the
        original case."""
        case = {name.lower(): name for name in names or ()}
        where = f"`{catalog}`.`{schema}`" if catalog else f"`{schema}`"
        listed = [t for t in spark.catalog.listTables(where) if not t.isTemporary]
        return cls(
            SourceTable(
                case.get(t.name.lower(), t.name),
                lambda session, n=f"{where}.`{t.name}`": session.table(n),
                schema,
                catalog,
            )
            for t in listed
        )

    def match(
        self,
        like: str,
        not_like: Iterable[str] = (),
        schema: str | None = None,
        catalog: str | None = None,
    ) -> list[SourceTable]:
        """Tables of one feed, in name order (the driver-side twin of ``discover``)."""
        return [
            table
            for table in self.tables
            if like_matches(table.name, like)
            and not any(like_matches(table.name, pattern) for pattern in not_like)
            and (schema is None or table.schema == schema)
            and (catalog is None or table.catalog == catalog)
        ]
