"""Keeping the latest delivery of each business key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.nested import quoted
from marketloom.operators.skew import SALT, hot_keys, with_hot_salt

RANK = "__rank"
NEWEST = "__newest"
PLACE = "__place"


def latest(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    ties: str = "all",
    tie_break: Iterable[Column | str] = (),
    scope: str = "global",
    source_col: str | None = None,
    hot_rows: int | None = 1_000_000,
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Rows of the newest batch of every key; NULL keys form one group.

    ``ties="all"`` keeps every row of the newest batch, ``ties="one"`` exactly one row,
    chosen by ``tie_break``. ``scope="source"`` ranks inside each source table, which
    is the same as ranking each source before the union but needs one shuffle, not one
    per source.

    Spark evaluates a rank of 1 before the shuffle as well, so stale deliveries that
    share a task with a newer one are never sent. With ``ties="one"`` that leaves at
    most one row per key and task, so no key can overload a task. With ``ties="all"``
    the newest batch of one key may itself be huge: hot keys are found first, their
    stale rows are dropped in place and the rest is spread over several tasks.
    ``key_rows`` may give the same keys and batches from a narrower scan for that.
    """
    if ties not in ("all", "one"):
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    if scope == "source":
        if source_col is None:
            raise ValueError("scope='source' needs source_col")
        keys = [source_col, *keys]
    elif scope != "global":
        raise ValueError(f"scope must be 'source' or 'global', not {scope!r}")

    newest_first = F.col(order_col).desc_nulls_last()
    columns = df.columns
    if ties == "one":
        breaks = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie_break]
        if not breaks:
            raise ValueError("ties='one' needs a tie_break for a repeatable result")
        window = Window.partitionBy(*map(quoted, keys)).orderBy(newest_first, *breaks)
        ranked = df.withColumn(RANK, F.row_number().over(window))
        return ranked.where(F.col(RANK) == 1).select(*[quoted(name) for name in columns])

    partition = list(keys)
    if hot_rows is not None:
        hot = hot_keys(df if key_rows is None else key_rows, keys, hot_rows, {NEWEST: F.max(order_col)})
        df = with_hot_salt(df, keys, hot)
        stale = F.col(order_col) < F.col(NEWEST)
        unknown = F.col(NEWEST).isNotNull() & F.col(order_col).isNull()
        df = df.where(~F.coalesce(stale | unknown, F.lit(False)))
        partition.append(SALT)
    window = Window.partitionBy(*map(quoted, partition)).orderBy(newest_first)
    ranked = df.withColumn(RANK, F.dense_rank().over(window))
    return ranked.where(F.col(RANK) == 1).select(*[quoted(name) for name in columns])


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(field.dataType) for field in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def without_copies(df: DataFrame) -> DataFrame:
    """The rows without their exact copies.

    Rows that are dealt over tasks by one of their columns are compared where they are,
    others after a shuffle. With maps or variants, which cannot be compared, all rows are kept.
    """
    if not _comparable(df.schema):
        return df
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    scalars = [f.name for f in df.schema if f.name not in nested]
    # Sorting by a hash first brings copies together; only rows that share it are compared. A
    # hash alone does not tell an empty array from NULL, nor where one array ends.
    alike = [F.xxhash64(*map(quoted, df.columns)), *map(quoted, scalars)]
    window = Window.partitionBy(*alike).orderBy(*(map(quoted, nested) if nested else [F.lit(0)]))
    ranked = df.withColumns({RANK: F.rank().over(window), PLACE: F.row_number().over(window)})
    return ranked.where(F.col(RANK) == F.col(PLACE)).drop(RANK, PLACE)
