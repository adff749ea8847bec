"""High-water mark, look-back filter and keyed upsert.

Late and repeated deliveries are handled by re-reading a fixed window before the
newest loaded batch, ranking it again and replacing the keys it contains.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.skew import PIECES, SALT, hot_keys, key_condition, with_hot_salt
from marketloom.settings import LOOKBACK_MS


def high_water_mark(target: DataFrame, runtime_col: str, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
    """One row: newest loaded batch minus the look-back, 0 for an empty target."""
    newest = F.max(runtime_col) - F.lit(lookback_ms)
    return target.agg(F.coalesce(newest, F.lit(0)).cast("bigint").alias("mark"))


def stored_mark(
    spark: SparkSession, path: str, runtime_col: str, lookback_ms: int = LOOKBACK_MS
) -> int:
    """The mark of a Parquet table, from the statistics in the footers of its files.

    A session of its own reads with the reader that answers minima and maxima from footers,
    so that no row group is read and the settings of the caller's session stay.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    newest = newest_batch(session, path, runtime_col)
    try:
        last = newest.first()[0]
    except (PySparkException, Py4JJavaError):  # files without statistics
        last = spark.read.parquet(path).agg(F.max(runtime_col)).first()[0]
    return 0 if last is None else last - lookback_ms


def newest_batch(session: SparkSession, path: str, runtime_col: str) -> DataFrame:
    return session.read.parquet(path).agg(F.max(runtime_col))


def lookback_filter(df: DataFrame, runtime_col: str, mark: int) -> DataFrame:
    """Rows of the batches from the mark on, the mark included."""
    return df.where(F.col(runtime_col) >= F.lit(mark))


def keep_unmatched(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    hot_rows: int | None = 1_000_000,
) -> DataFrame:
    """Target rows whose key is not among the updates.

    The update keys are reduced to distinct ones before they move. A NULL in the key
    never matches unless ``null_safe``, so such rows skip the join. Keys that hold very
    many target rows are split, and only their update keys are copied.
    """
    if null_safe:
        return _by_match(target, updates, keys, null_safe, hot_rows, "left_anti")
    complete = _complete(keys)
    kept = _by_match(target.where(complete), updates, keys, null_safe, hot_rows, "left_anti")
    return kept.unionByName(target.where(~complete))


def matched(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    hot_rows: int | None = 1_000_000,
) -> DataFrame:
    """Target rows whose key is among the updates: those that :func:`keep_unmatched` leaves out."""
    target = target if null_safe else target.where(_complete(keys))
    return _by_match(target, updates, keys, null_safe, hot_rows, "left_semi")


def _complete(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])


def _by_match(
    target: DataFrame, updates: DataFrame, keys: list[str], null_safe: bool, hot_rows: int | None, how: str
) -> DataFrame:
    names = {key: f"__upd_{i}" for i, key in enumerate(keys)}
    wanted = updates.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    wanted = wanted if null_safe else wanted.na.drop("any")
    columns = target.columns
    on_salt = F.lit(True)
    if hot_rows is not None:
        hot = hot_keys(target, keys, hot_rows)
        target = with_hot_salt(target, keys, hot)
        hot_names = {n: f"__hot_{i}" for i, n in enumerate(names.values())}
        pieces = F.coalesce(F.col(PIECES), F.lit(1))
        wanted = wanted.join(
            F.broadcast(hot), key_condition(wanted, hot, hot_names, True), "left"
        ).select(
            *names.values(), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("__upd_salt")
        )
        on_salt = target[SALT] == wanted["__upd_salt"]
    return target.join(
        wanted, key_condition(target, wanted, names, null_safe) & on_salt, how
    ).select(*columns)


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    strict: bool = False,
    hot_rows: int | None = 1_000_000,
) -> DataFrame:
    """The target after its rows with an update key are replaced by the updates.

    All update rows of a key are inserted, also when there are several; ``strict``
    fails instead, when the result is computed, as a MERGE statement would.
    """
    if strict:
        updates = reject_repeated_keys(updates, keys)
    kept = keep_unmatched(target, updates, keys, null_safe, hot_rows)
    return kept.unionByName(updates)


def reject_repeated_keys(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Updates that fail at run time if some complete key occurs twice."""
    names = {key: f"__dup_{i}" for i, key in enumerate(keys)}
    counted = (
        updates.na.drop("any", subset=keys)
        .groupBy(*[F.col(k).alias(n) for k, n in names.items()])
        .agg(F.count(F.lit(1)).alias("__copies"))
        .agg(F.max("__copies").alias("__most"))
    )
    check = F.when(
        F.coalesce(F.col("__most"), F.lit(0)) > 1,
        F.raise_error(F.lit("several update rows for one key")),
    )
    # One row, joined so that the check belongs to the same plan as the result.
    guard = counted.select(F.coalesce(check.cast("string"), F.lit("ok")).alias("__guard"))
    joined = updates.withColumn("__one", F.lit("ok")).join(
        F.broadcast(guard), F.col("__one") == F.col("__guard"), "inner"
    )
    return joined.drop("__one", "__guard")
