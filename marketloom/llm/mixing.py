"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash into one stream of words, which is cut
into blocks of equally many words. Slot ``k`` of the mix takes the point ``frac(k * phi)``
(golden ratio), which falls into one source's part of the cumulative targets; the slot's
rank among its source's slots names the block, going round when the stream ends. Any
stretch of the mix therefore has nearly the target shares.

The driver holds one row per source. Slots are ``SLOTS`` in number, whatever the corpus,
and so bound the blocks. Null texts have no words and null sources are a source of their
own, after the others. Repeated rows are rows of their own. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm.common import WORD, blocks_for, numbered, store, uniform_hash

SLOTS = 1 << 17
ROWS_PER_BLOCK = 5_000
WEIGHTS = (3, 1, 2)
GOLDEN = 2_654_435_769  # 2^32 / phi: the points in whole numbers


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Share of the total by weight; what exceeds ``most`` times a source goes to the rest."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        for i in over or open_:
            out[i] = most * sizes[i] if over else left * weights[i] / weight
        if not over:
            break
        left -= sum(out[i] for i in over)
        open_ -= over
    return out


def _sources(docs: DataFrame) -> list[tuple]:
    """(number, source, size, target) by code point, null last."""
    found = docs.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(((r["source"], r["size"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [size for _, size in found]
    wanted = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
    return [(i, name, size, target) for i, ((name, size), target) in enumerate(zip(found, wanted))]


def schedule(spark: SparkSession, sources: list[tuple], words_per_slot: int, slots: int) -> DataFrame:
    """Slots of the mix: ``slot``, ``source_no``, ``block``, ``round`` and where to stop.

    A source whose points are a few short of its target gets its last slots at the end, in
    turn with others; points beyond its target stay unused. No two slots share a number. The
    last slot stops at the target word.
    """
    share = np.cumsum([target for *_, target in sources])
    bounds = np.floor(share / share[-1] * 2**32)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            at = (k * np.uint64(GOLDEN)) & np.uint64(2**32 - 1)
            no = np.minimum(np.searchsorted(bounds, at.astype(np.float64), side="right"), len(bounds) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(no.astype(np.int32))], names=["slot", "source_no"]
            )

    plan = []
    for no, _, size, target in sources:
        take = min(round(target), 2 * size)
        blocks = -(-size // words_per_slot)
        rounds, rest = divmod(take, size) if size else (0, 0)
        plan.append((no, size, take, blocks, rounds * blocks + -(-rest // words_per_slot)))
    needed = spark.createDataFrame(plan, "no int, words long, take long, blocks long, needed long")
    drawn = spark.range(slots).mapInArrow(points, "slot long, source_no int")
    rank = Window.partitionBy("source_no").orderBy("slot")  # at most SLOTS rows
    ranked = drawn.withColumn("rank", F.row_number().over(rank) - 1)
    have = ranked.groupBy("source_no").count()
    short = needed.join(have, F.col("no") == F.col("source_no"), "left").select(
        F.col("no").alias("source_no"),
        F.posexplode(F.expr("if(needed > coalesce(count, 0), sequence(coalesce(count, 0), needed - 1), array())")).alias("nth", "rank"),
    )
    short = short.select((F.lit(slots) + F.col("nth") * len(sources) + F.col("source_no")).alias("slot"), "source_no", "rank")
    every = ranked.select("slot", "source_no", F.col("rank").cast("long")).unionByName(short)
    used = every.join(needed, (F.col("source_no") == F.col("no")) & (F.col("rank") < F.col("needed")))
    turn = F.floor(F.col("rank") / F.col("blocks"))
    return used.select(
        "slot", "source_no", (F.col("rank") % F.col("blocks")).alias("block"), turn.cast("int").alias("round"),
        (F.col("take") - turn * F.col("words")).alias("stop"),
    )


def mix(docs: DataFrame, source: str = "source", text: str = "text", slots: int = SLOTS, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The documents as streams, and the mix.

    Streams: the columns of ``docs`` but the text, ``size``, ``source_size``, ``target``,
    ``source_no`` and ``before`` (words of the source ahead of it). Mix: ``slot``,
    ``source_no``, ``before``, ``round``, and the words ``first`` to ``last`` (exclusive)
    that the slot takes of that document.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in (text, source)]
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    sized = store(docs.select(*others, F.col(source).alias("source"), size.alias("size")), "sized")
    sources = _sources(sized)
    table = spark.createDataFrame(sources, "source_no int, name string, source_size long, target double")
    keys = [*others, "size"]
    block = F.pmod(uniform_hash(seed, *keys), F.lit(blocks_for(sized.count(), ROWS_PER_BLOCK))).cast("int")
    placed = sized.join(table, sized["source"].eqNullSafe(table["name"])).drop("name")
    order = [uniform_hash(seed + 1, *keys), *[F.col(k) for k in keys]]
    streams = store(numbered(placed, ["source_no"], order, block, "before", F.col("size")), "streams")
    total = sum(target for *_, target in sources)
    if not total:
        return streams, spark.createDataFrame([], "slot long, source_no int, before long, round int, first long, last long")
    words_per_slot = max(1, -(-round(total) // slots))
    plan = schedule(spark, sources, words_per_slot, -(-round(total) // words_per_slot))
    w = F.lit(words_per_slot)
    cut = streams.where("size > 0").select(
        "source_no", "before", "size",
        F.explode(F.sequence(F.floor(F.col("before") / w), F.floor((F.col("before") + F.col("size") - 1) / w))).alias("block"),
    )
    begin = F.greatest(F.col("before"), F.col("block") * w)
    end = F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * w, F.col("stop"))
    taken = cut.join(plan, ["source_no", "block"]).select(
        "slot", "source_no", "before", "round",
        (begin - F.col("before")).alias("first"), (end - F.col("before")).alias("last"),
    )
    return streams, taken.where("last > first")


def op1_golden_ratio_mix(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, the first slot that takes of it (null: none) and
    the number of slots that do; read by slots, the mix has the target shares in every stretch."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    streams, taken = mix(docs)
    words = taken.where("first < last").groupBy("source_no", "before").agg(
        F.sum(F.col("last") - F.col("first")).alias("taken"),
        F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots"))
    # Of rows with the same number of words before them, one at most has words itself.
    words = words.withColumn("some", F.lit(True))
    joined = streams.withColumn("some", F.col("size") > 0).join(words, ["source_no", "before", "some"], "left")
    return joined.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source",
        "first_slot", F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
    )


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: a document once for each round in which the mix takes its first word.

    Documents without words are left out, as the mix takes nothing of them.
    """
    rows = ["__row", "__row_too"]  # 128 bits: rows that differ do not share both
    tagged = docs.withColumns({name: uniform_hash(11 + i, *docs.columns) for i, name in enumerate(rows)})
    streams, taken = mix(tagged.select(*rows, "source", "text"))
    first = taken.where("first = 0").select("source_no", "before", "round")
    chosen = streams.where("size > 0").join(first, ["source_no", "before"])
    times = chosen.groupBy(*rows).agg(F.count(F.lit(1)).cast("int").alias("__times"))
    # Rows that are equal in all columns stand for each other: one of them is repeated.
    copies = tagged.dropDuplicates(rows).join(times, rows)
    return copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
