"""Helpers that the corpus operators share: scratch tables and running numbers."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it again; this cuts the lineage.

    The shuffle files of the write are not needed any more when it has ended, so Spark is
    told to remove them then, and not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def uniform_hash(seed: int, *columns: Column | str) -> Column:
    """64 hashed bits of the columns; another seed gives independent bits."""
    return F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in columns])


def blocks_for(rows: int, rows_per_block: int) -> int:
    """How many blocks hold ``rows`` rows at about ``rows_per_block`` each."""
    return max(1, math.ceil(rows / rows_per_block))


def numbered(
    df: DataFrame, groups: list[str], order: list[Column], block: Column, name: str,
    amount: Column | None = None,
) -> DataFrame:
    """Number the rows of each group from 0, or add up ``amount`` over the rows before.

    ``block`` cuts a group into pieces that are small enough for one task; the order is
    block first, ``order`` inside. Counts of the pieces are summed over a small table
    (groups times blocks), so that no group meets in one task however large it is.
    """
    amount = F.lit(1) if amount is None else amount
    rows = df.withColumns({"__block": block, "__amount": amount.cast("long")})
    sums = rows.groupBy(*groups, "__block").agg(F.sum("__amount").alias("__sum"))
    before = Window.partitionBy(*groups).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
        F.col("__block").alias("__b"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(*groups, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__inside", F.coalesce(F.sum("__amount").over(inside), F.lit(0)))
    match = rows["__block"].eqNullSafe(starts["__b"])
    for i, g in enumerate(groups):
        match = match & rows[g].eqNullSafe(starts[f"__g{i}"])
    return rows.join(starts, match).select(
        *[rows[c] for c in df.columns], (F.col("__start") + F.col("__inside")).alias(name)
    )
