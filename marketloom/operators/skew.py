"""Spreading of business keys that hold very many rows.

Hot keys are found by counting a hash of the key, combined before the shuffle: 16 bytes
per key and task move. Only where some hash is crowded are its rows counted by the key
itself, so the result is exact; adaptive execution drops that second count when there
is nothing to count. With a threshold of ``hot_rows`` there are at most ``rows / hot_rows`` hot keys
(100,000 for 100 billion rows and the default), and never more than ``MOST_HOT``, those
with the most rows, however low the threshold: that bounds what is broadcast. A key beyond
that number stays in one task, like any other, and the result is the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.nested import quoted

SALT = "__salt"
PIECES = "__pieces"
MOST_HOT = 100_000


def key_condition(left: DataFrame, right: DataFrame, names: dict[str, str], null_safe: bool) -> Column:
    """Equality of key columns; ``names`` maps left names to right names."""
    pairs = [
        left[f"`{a}`"].eqNullSafe(right[f"`{b}`"])
        if null_safe
        else left[f"`{a}`"] == right[f"`{b}`"]
        for a, b in names.items()
    ]
    return reduce(Column.__and__, pairs)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int, extra: dict[str, Column] | None = None) -> DataFrame:
    """Keys with at least ``hot_rows`` rows, and into how many pieces to split each."""
    hashed = F.xxhash64(*[quoted(key) for key in keys])
    counts = df.groupBy(hashed.alias("__crowd")).agg(F.count(F.lit(1)).alias("__rows"))
    # All columns decide the order, so that every use of the hot keys finds the same ones.
    crowded = counts.where(F.col("__rows") >= hot_rows).orderBy(F.desc("__rows"), "__crowd")
    crowded = crowded.limit(MOST_HOT).select("__crowd")
    candidates = df.withColumn("__hash", hashed).join(
        F.broadcast(crowded), F.col("__hash") == F.col("__crowd"), "left_semi"
    )
    aggregates = [col.alias(name) for name, col in (extra or {}).items()]
    counted = candidates.groupBy(*[quoted(key) for key in keys]).agg(F.count(F.lit(1)).alias("__rows"), *aggregates)
    pieces = F.ceil(F.col("__rows") / F.lit(hot_rows)) + 1
    return counted.where(F.col("__rows") >= hot_rows).select(
        *[quoted(key).alias(f"__hot_{i}") for i, key in enumerate(keys)],
        pieces.cast("int").alias(PIECES),
        *(extra or {}),
    )


def with_hot_salt(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Add ``__salt``: 0 for an ordinary key, one of its pieces for a hot key.

    The piece is the number of the task that reads the row. A retried task reads the
    same split and so repeats its choice, and exact copies spread like other rows.
    """
    names = {key: f"__hot_{i}" for i, key in enumerate(keys)}
    joined = df.join(F.broadcast(hot), key_condition(df, hot, names, True), "left")
    salt = F.coalesce(F.pmod(F.spark_partition_id(), F.col(PIECES)), F.lit(0))
    return joined.withColumn(SALT, salt).drop(*names.values(), PIECES)
