"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of each source block go to each shard is drawn first, from the law that a
uniform permutation of all rows would give (multivariate hypergeometric, row after row of
the matrix). Then rows are permuted inside their block, the block's order is cut by the
matrix, the rows are exchanged, and permuted again inside their shard. Only counts pass
through the driver: at most ``MAX_BLOCKS`` times the number of shards.

Blocks and orders come from hashes of the row itself, so reruns and retried tasks repeat
them. Nulls hash like other values, repeated rows are rows of their own (whole copies may
swap places), an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import blocks_for, numbered, uniform_hash

ROWS_PER_BLOCK = 20_000
MIN_BLOCKS, MAX_BLOCKS = 16, 4096
_EXACT = 999_999_999  # largest population of numpy's sampler


def _draw(rng: np.random.Generator, left: np.ndarray, rows: int) -> np.ndarray:
    """Counts of ``rows`` draws without replacement from ``left`` places per shard.

    Above the sampler's limit of 10^9 rows, each shard's count is a rounded normal draw
    of the same mean and variance; the totals stay exact.
    """
    if left.sum() <= _EXACT:
        return rng.multivariate_hypergeometric(left, rows, method="marginals")
    out, total = np.zeros_like(left), int(left.sum())
    for i, places in enumerate(left.tolist()):
        rest = total - places
        if i == len(left) - 1:
            out[i] = rows
            break
        p = places / total
        spread = math.sqrt(max(0.0, rows * p * (1 - p) * (total - rows) / max(1, total - 1)))
        drawn = round(rng.normal(rows * p, spread))
        out[i] = min(max(drawn, 0, rows - rest), places, rows)
        rows, total = rows - int(out[i]), rest
    return out


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each block to each shard; shard totals differ by one at most."""
    total = sum(counts)
    left = np.array([total // shards + (i < total % shards) for i in range(shards)], dtype=np.int64)
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(counts), shards), dtype=np.int64)
    for block, rows in enumerate(counts):
        matrix[block] = _draw(rng, left, rows)
        left = left - matrix[block]
    return matrix


def shuffle_into_shards(
    df: DataFrame, shards: int, keys: list[str], seed: int = 1, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``keys`` are the columns that tell rows apart; rows equal in all of them may swap.
    """
    spark = df.sparkSession
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, blocks_for(df.count(), rows_per_block)))
    block = F.pmod(uniform_hash(seed, *keys), F.lit(blocks)).cast("int")
    placed = df.withColumn("__from", block)
    counts = {row["__from"]: row["count"] for row in placed.groupBy("__from").count().collect()}
    matrix = communication_matrix([counts.get(b, 0) for b in range(blocks)], shards, seed)
    cuts = ", ".join(
        f"({b}, array({', '.join(f'{int(c)}L' for c in row)}))" for b, row in enumerate(matrix.cumsum(axis=1))
    )
    cuts = spark.sql(f"SELECT * FROM VALUES {cuts} AS t(__block, __cuts)")

    local = Window.partitionBy("__from").orderBy(uniform_hash(seed + 1, *keys), *keys)
    ranked = placed.withColumn("__rank", F.row_number().over(local) - 1)
    sent = ranked.join(cuts, ranked["__from"] == cuts["__block"]).withColumn(
        "shard", F.size(F.filter("__cuts", lambda c: c <= F.col("__rank"))).cast("int")
    )
    pieces = blocks_for(blocks * rows_per_block, rows_per_block * shards)
    again = F.pmod(uniform_hash(seed + 2, *keys), F.lit(pieces)).cast("int")
    order = [uniform_hash(seed + 3, *keys), *[F.col(k) for k in keys]]
    return numbered(sent.select(*df.columns, "shard"), ["shard"], order, again, "slot")


def op6_hypergeometric_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 under the ``rows`` law."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = shuffle_into_shards(docs, 40, ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
