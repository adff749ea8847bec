"""Partitioned and clustered Parquet tables.

A table is partitioned by its declared field when that is a date, so a filter on the field
picks folders. A field with a time of day, or text, stays in the files, and the folders
are its days, ``<field>_day``; :func:`read_table` filters by them and leaves them out. So
a round trip gives the same columns in the same order.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.sinks.publish import (
    NEW,
    UPDATES,
    Files,
    Step,
    beside,
    publish_parts,
    publish_table,
    recover,
)
from marketloom.streaming.incremental import matched, merge_upsert, reject_repeated_keys

# Mark in the metadata of the first stored column: the folder column and its place among
# the table's columns, -1 when it is none of them.
FOLDER, PLACE = "folder_column", "folder_place"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL value

# A day whose files have this many bytes on average is not dealt again when a few of its rows
# are replaced. Spark takes opening a file to be as dear as reading 4 MB.
SETTLED_BYTES = 4 << 20
# Bytes of files that a task of a merge reads: it sorts their rows, which take 25 times as much.
TASK_BYTES = 16 << 20
# Bitmaps of 4 KB and 32,768 rows that are broadcast at most: 64 MB for 500 million rows.
MOST_BLOCKS = 16_384
FILE, ROW, BLOCK, BITS = "__file", "__row", "__block", "__bits"


@dataclass(frozen=True)
class Sink:
    """Layout of a unified table: cluster columns and an optional day partition.

    ``by_day`` partitions by the days of a field that is not a date itself.
    """

    cluster_by: tuple[str, ...]
    partition_by: str | None = None
    by_day: bool = False

    @property
    def folder_column(self) -> str | None:
        return f"{self.partition_by}_day" if self.by_day else self.partition_by


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below the shared folder of the cluster, or below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/marketloom-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """True for a table with data files, whether or not its writer left a marker.

    A table appears by one move of a complete folder, so files mean a whole table. A
    table without rows has none and is loaded anew.
    """
    return Files(spark, path).has_data(path)


Days = tuple[dt.date | None, dt.date | None]


def read_table(spark: SparkSession, path: str, days: Days | None = None) -> DataFrame:
    """The table, or its rows of the days from the first to the last (None: open end).

    Only the folders of those days are read, whatever type the partition field has.
    """
    stored = spark.read.parquet(path)
    if days is not None:
        folder = F.col(stored.schema[0].metadata[FOLDER])
        stored = stored if days[0] is None else stored.where(folder >= F.lit(days[0]))
        stored = stored if days[1] is None else stored.where(folder <= F.lit(days[1]))
    return _arranged(stored)


def _arranged(stored: DataFrame) -> DataFrame:
    """The columns of a stored table as they were written."""
    first = stored.schema[0]
    if FOLDER not in first.metadata:
        return stored
    folder, place = first.metadata[FOLDER], first.metadata[PLACE]
    stored = stored.withMetadata(first.name, {})
    names = [name for name in stored.columns if name != folder]
    if place >= 0:
        if stored.schema[folder].dataType != T.DateType():  # no day but NULL
            stored = stored.withColumn(folder, F.col(f"`{folder}`").cast("date"))
        names.insert(place, folder)
    return stored.select(*[F.col(f"`{name}`") for name in names])


def _part(sink: Sink) -> Column:
    return F.to_date(F.col(sink.partition_by))


def _marked(df: DataFrame, sink: Sink) -> DataFrame:
    """The rows with their folder column, and the mark that :func:`read_table` needs."""
    if sink.partition_by is None:
        return df
    place = [name.lower() for name in df.columns].index(sink.partition_by.lower())
    field = df.schema[place]
    if sink.by_day:
        folder, place = sink.folder_column, -1
        df = df.withColumn(folder, _part(sink))
    else:
        folder = field.name
        if not isinstance(field.dataType, T.DateType):
            raise ValueError(f"{folder!r} is no date; partition by its days (by_day=True)")
    first = next(name for name in df.columns if name != folder)
    return df.withMetadata(first, {FOLDER: folder, PLACE: place})


def layout(df: DataFrame, sink: Sink, settled: DataFrame | None = None) -> DataFrame:
    """Arrange rows for the sink: partition value, then ranges of the cluster columns.

    The rows of a partitioned table are dealt by day. Adaptive execution joins small days
    and cuts large ones by their size, so no writer gets an unbounded share, and the stage
    before runs once. Rows are sorted in each file, whose pages then tell their ranges of
    the cluster columns. ``settled`` rows come from files of such a table: they are sorted by
    the task that reads them, and not dealt again.

    A table without days is dealt by ranges of the cluster columns, for which Spark samples
    the stage before; the number of the producing task cuts one popular key further.
    """
    order = [*([sink.folder_column] if sink.partition_by else []), *sink.cluster_by]
    placed = _marked(df, sink)
    if sink.partition_by:
        placed = placed.hint("rebalance", F.col(f"`{sink.folder_column}`"))
        if settled is not None:
            placed = placed.unionByName(_marked(settled, sink))
        return placed.sortWithinPartitions(*order)
    placed = placed.withColumn("__piece", F.spark_partition_id())
    ranged = placed.repartitionByRange(*order, "__piece")
    return ranged.sortWithinPartitions(*order).drop("__piece")


def write_table(df: DataFrame, path: str, sink: Sink, step: Step | None = None) -> None:
    """Write the whole table, replacing what is there.

    The new table is written next to the old one and moved in when it is complete. A run
    that fails leaves the old table as it was; one that is stopped while tables are moved
    is finished by the next (:mod:`marketloom.sinks.publish`).
    """
    recover(df.sparkSession, path)
    _replace(df, path, sink, step)


def _replace(df: DataFrame, path: str, sink: Sink, step: Step | None) -> None:
    staged = beside(path, NEW)
    _stage(df, staged, sink)
    publish_table(df.sparkSession, staged, path, step)


def _stage(df: DataFrame, staged: str, sink: Sink, settled: DataFrame | None = None) -> None:
    """Write rows in the sink's layout; what a failed job leaves is removed."""
    folders = [sink.folder_column] if sink.partition_by else []
    try:
        (
            layout(df, sink, settled)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*folders)
            .parquet(staged)
        )
    except Exception:
        Files(df.sparkSession, staged).delete(staged)
        raise


def key_range(updates: DataFrame, keys: list[str], null_safe: bool) -> Column:
    """A condition that the keys of the updates meet, for the scan of a table.

    It compares each key column with its least and greatest value among the updates, and
    Parquet passes over row groups and pages beyond them. Where keys do not match NULL,
    such rows are left out, too.
    """
    kinds = {field.name: field.dataType for field in updates.schema}
    plain = [key for key in keys if isinstance(kinds[key], (T.StringType, T.NumericType, T.DateType, T.TimestampNTZType))]
    if not plain:
        return F.lit(True)
    ends = [f(F.col(f"`{key}`")).alias(f"{n}{i}") for i, key in enumerate(plain) for n, f in (("a", F.min), ("b", F.max))]
    found, tests = updates.agg(*ends).first(), []
    for i, key in enumerate(plain):
        column, low, high = F.col(f"`{key}`"), found[f"a{i}"], found[f"b{i}"]
        kind = kinds[key]
        # Without any value no row matches, but for NULL keys.
        inside = F.lit(False) if low is None else (column >= F.lit(low).cast(kind)) & (column <= F.lit(high).cast(kind))
        tests.append(inside | column.isNull() if null_safe else inside)
    return reduce(Column.__and__, tests)


def _with_places(target: DataFrame) -> DataFrame:
    """The rows of a stored table with their file and their number in it, from 1."""
    place = target.metadataColumn("_metadata")
    return target.select("*", place["file_path"].alias(FILE), (place["row_index"] + 1).alias(ROW))


def _replaced(
    target: DataFrame, updates: DataFrame, keys: list[str], sink: Sink, null_safe: bool,
    hot_rows: int | None, days: list,
) -> DataFrame:
    """The stored rows that hold an update key, as bitmaps: one row for 32,768 rows of a file.

    Keys and places are compared, so the rows themselves are not moved. ``days`` are those of
    the updates.
    """
    near = target.where(key_range(updates, keys, null_safe))
    if sink.partition_by in keys:
        near = near.where(_in_parts(sink.folder_column, days))
    names = dict.fromkeys([*keys, "__day", FILE, ROW])
    slim = _with_places(near).withColumn("__day", F.col(f"`{sink.folder_column}`").cast("date"))
    found = matched(slim.select(*[F.col(name) for name in names]), updates, keys, null_safe, hot_rows)
    block, bit = F.bitmap_bucket_number(ROW), F.bitmap_bit_position(ROW)
    return found.groupBy("__day", FILE, block.alias(BLOCK)).agg(F.bitmap_construct_agg(bit).alias(BITS))


def _without_replaced(target: DataFrame, replaced: DataFrame, small: bool) -> DataFrame:
    """The stored rows that are not marked in the bitmaps; small ones are broadcast."""
    rows = _with_places(target)
    bits = replaced.select(F.col(FILE).alias("__of"), F.col(BLOCK), F.col(BITS))
    bits = F.broadcast(bits) if small else bits
    same = (rows[FILE] == bits["__of"]) & (F.bitmap_bucket_number(rows[ROW]) == bits[BLOCK])
    bit = F.bitmap_bit_position(ROW)
    byte = F.hex(F.substring(F.col(BITS), (bit / 8).cast("int") + 1, F.lit(1)))
    marked = F.getbit(F.conv(byte, 16, 10).cast("int"), (bit % 8).cast("int"))
    kept = rows.join(bits, same, "left").where(F.coalesce(marked, F.lit(0)) == 0)
    return kept.select(*[F.col(f"`{name}`") for name in target.columns])


def _in_parts(column: str, values: list) -> Column:
    """One membership test, however many days are touched."""
    present = [value for value in values if value is not None]
    inside = F.col(column).isin(present) if present else F.lit(False)
    return inside | F.col(column).isNull() if None in values else inside


def upsert(
    updates: DataFrame,
    path: str,
    keys: list[str],
    sink: Sink,
    null_safe: bool = False,
    strict: bool = False,
    hot_rows: int | None = 1_000_000,
    step: Step | None = None,
) -> None:
    """Merge updates into the table at ``path``, rewriting only the days they touch.

    A table without a partition field is written anew beside the old one and moved in.

    The updates are written out first, so that every later step reads the same rows. The
    touched days are then merged in one job, beside the table, and moved in; a day that
    lost all its rows is removed. Rows that stay in a day of files that are not small are
    filtered and sorted by the tasks that read them; only updates and small days are dealt. A run that is stopped before the days are complete leaves
    the table as it was, one that is stopped later is finished by the next.
    """
    spark = updates.sparkSession
    recover(spark, path)
    staged, places = beside(path, UPDATES), beside(path, UPDATES)
    try:
        updates.write.mode("overwrite").parquet(staged)
        _merge_staged(_session(spark), staged, places, path, keys, sink, null_safe, strict, hot_rows, step)
    finally:
        Files(spark, path).delete(staged)
        Files(spark, path).delete(places)


def _session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings whose tasks read no more than they can sort."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    return session


def _merge_staged(
    spark: SparkSession, updated: str, places: str, path: str, keys: list[str], sink: Sink,
    null_safe: bool, strict: bool, hot_rows: int | None, step: Step | None,
) -> None:
    updates = spark.read.parquet(updated)
    if sink.partition_by is None:
        merged = merge_upsert(read_table(spark, path), updates, keys, null_safe, strict, hot_rows)
        _replace(merged, path, sink, step)
        return
    target = spark.read.parquet(path)
    column = sink.folder_column
    days = [row[0] for row in updates.select(_part(sink)).distinct().collect()]  # some thousands
    _replaced(target, updates, keys, sink, null_safe, hot_rows, days).write.parquet(places)
    replaced = spark.read.parquet(places)
    blocks = {row[0]: row[1] for row in replaced.groupBy("__day").count().collect()}
    folders = {v: f"{column}={NULL_FOLDER if v is None else v}" for v in {*days, *blocks}}
    files = Files(spark, path)
    settled = [v for v, name in folders.items() if files.mean_size(f"{path.rstrip('/')}/{name}") >= SETTLED_BYTES]

    def kept(parts: list) -> DataFrame:
        small = sum(blocks.values()) <= MOST_BLOCKS
        return _arranged(_without_replaced(target.where(_in_parts(column, parts)), replaced, small))

    updates = reject_repeated_keys(updates, keys) if strict else updates
    dealt = kept([v for v in folders if v not in settled]).unionByName(updates)
    staged = beside(path, NEW)
    _stage(dealt, staged, sink, kept(settled) if settled else None)
    publish_parts(spark, staged, path, folders.values(), step)


def merge_into_table(updates: DataFrame, table: str, keys: list[str], null_safe: bool = False) -> None:
    """MERGE into a catalog table whose format supports row-level changes."""
    # The row-level MERGE names its target by table name.
    name = table.rpartition(".")[2]
    condition = reduce(
        Column.__and__,
        [
            (F.col(f"{name}.{key}").eqNullSafe(F.col(f"source.{key}")))
            if null_safe
            else (F.col(f"{name}.{key}") == F.col(f"source.{key}"))
            for key in keys
        ],
    )
    (
        updates.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
