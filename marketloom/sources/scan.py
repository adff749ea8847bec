"""One scan for many raw tables.

Parquet tables whose columns agree are read together: one relation over all their folders,
with one schema, in which each row tells its folder. So the size of a plan and the work of
the driver do not grow with the number of stores, only with the number of different
layouts. Tables that agree but for missing columns or nested fields share a scan as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.sources.registry import SourceTable

FOLDER = "__file_folder"
LISTED_AT_ONCE = 16


@dataclass(frozen=True)
class Scan:
    """Raw tables that are read together, and the schema they have in common."""

    tables: tuple[SourceTable, ...]
    schema: T.StructType
    rows: DataFrame

    @property
    def narrows(self) -> bool:
        """Whether nested fields can be left out when reading."""
        return len(self.tables) > 1 or self.tables[0].load_narrow is not None

    def load(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """The rows, with their folder where there are several tables."""
        if len(self.tables) == 1:
            return self.rows if schema is None else self.tables[0].load_narrow(spark, schema)
        df = spark.read.schema(schema or self.schema).parquet(*[t.folder for t in self.tables])
        path = F.col("_metadata.file_path")
        name = F.length(F.substring_index(path, "/", -1))
        return df.select("*", _plain(F.left(path, F.length(path) - name - 1)).alias(FOLDER))


def _plain(path):
    """Local files are written with one or three slashes; keep one."""
    return F.regexp_replace(path, "^file:/+", "/")


def folder_key(spark: SparkSession, folder: str) -> str:
    """A folder as the rows of its files name it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    uri = full.toUri().toString()
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def _alone(spark: SparkSession, tables: Sequence[SourceTable]) -> list[Scan]:
    with ThreadPoolExecutor(max_workers=LISTED_AT_ONCE) as pool:
        frames = list(pool.map(lambda table: table.load(spark), tables))
    return [Scan((table,), df.schema, df) for table, df in zip(tables, frames)]


def _merged(spark: SparkSession, tables: Sequence[SourceTable]) -> Scan | None:
    """One scan over the tables, if their schemas can be merged."""
    folders = [table.folder for table in tables]
    try:
        rows = spark.read.option("mergeSchema", "true").parquet(*folders)
        return Scan(tuple(tables), rows.schema, rows)
    except (PySparkException, Py4JJavaError):  # types that cannot be merged, or folders with partitions
        return None


def scans(spark: SparkSession, tables: Sequence[SourceTable]) -> list[Scan]:
    """The tables of a feed in as few scans as their schemas allow."""
    stored = [table for table in tables if table.folder is not None]
    if len(stored) < 2:
        return _alone(spark, tables)
    others = _alone(spark, [table for table in tables if table.folder is None])
    whole = _merged(spark, stored)
    if whole is not None:
        return [whole, *others]
    layouts: dict[str, list[Scan]] = {}
    for scan in _alone(spark, stored):
        kinds = sorted((field.name.lower(), field.dataType.simpleString()) for field in scan.schema)
        layouts.setdefault(repr(kinds), []).append(scan)
    found = []
    for alike in layouts.values():
        one = _merged(spark, [s.tables[0] for s in alike]) if len(alike) > 1 else None
        found += alike if one is None else [one]
    return [*found, *others]
