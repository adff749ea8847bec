"""Hard negatives, by selection in disjoint slots of the score.

Anchors are a stated set of rows, searched against all rows. The rows are dealt into groups
of bounded size; each group meets the anchors a block at a time, as one product of two
integer matrices, and keeps little of it:

* first, for each anchor, the best rows of its label, of which the best of all groups are
  its positives;
* then, for each anchor, the best rows of other labels in each slot. A positive admits the
  scores up to its upper limit, so the distinct upper limits of an anchor's positives cut
  the scores into disjoint slots, and one pass serves all positives of an anchor.

Both lists are cut again before and after the shuffle, where groups meet. The slots of an
anchor, from the highest down, then hold its candidates in order; the best below a
positive's upper limit are the first of the suffix that begins with its slot, and those
under its lower limit are at the suffix's end.

Rows with a null label, a null vector, or a null or non-finite component take no part.
Vectors of unequal length are compared as if the shorter went on with zeros. Ties go to the
smaller id, rows without an id come last; such a row can be a positive or a negative, never
an anchor. Rows that repeat an id are rows of their own, but never each other's positives;
repeated anchors give repeated results. Scores are exact, and end at the bounds of a long.
Empty tables give no rows; other columns are left out. There are no texts; a vector, however
long, is held by a task as part of its group, which has about ``GROUP_CELLS`` components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import blocks_for, store, uniform_hash

POSITIVES = 5
NEGATIVES = 10
LOWER, UPPER = 30, 90  # percent of the positive's score
GROUP_CELLS = 1 << 23  # components of a group of rows
LEAST_CELLS, GROUPS = 1 << 16, 16  # smaller groups, where that keeps so many tasks busy
PRODUCT_CELLS = 1 << 22  # scores that a task holds at once
MOST = 2**63 - 1
ROWS, ANCHORS = 0, 1
LIMITS = "array<struct<least:long,most:long>>"


def scaled(vector: Column) -> Column:
    """Each component x as floor(256 x), within a long; null where the vector is null or has
    a component that is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(doubles, lambda x: F.floor(x * 256)))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), lengths.max(initial=0)), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two matrices."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = width * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0))
    if most < 2**53:  # doubles hold all sums
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -MOST, MOST).astype(np.int64)


class _Group:
    """The rows of a group: ids in the order of ties, labels, vectors."""

    def __init__(self, table: pa.Table):
        ids = table["id"].combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        order = np.lexsort((ids, null))
        self.ids, self.null = ids[order], null[order]
        self.labels = table["label"].to_numpy()[order]
        self.matrix = _matrix(table["vector"].combine_chunks())[order]


def best(scores: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` of some rows in the order of ties: highest scores first."""
    if len(rows) > n:
        least = np.partition(scores[rows], len(rows) - n)[len(rows) - n]
        rows = rows[scores[rows] >= least]
    return rows[np.argsort(-scores[rows], kind="stable")][:n]


def _met(n: int, negatives: bool):
    """Rows of a group, then blocks of anchors, to the best rows of each anchor (and slot)."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = group = None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            kinds = batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(keys) | np.diff(kinds)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)]):
                piece = batch.slice(a, b - a)
                if keys[a] != key:
                    key, held, group = keys[a], [], None
                if kinds[a] == ROWS:
                    held.append(piece)
                    continue
                if not held and group is None:
                    continue
                if group is None:
                    group, held = _Group(pa.Table.from_batches(held)), []
                size = max(1, PRODUCT_CELLS // len(group.ids))
                for c in range(0, piece.num_rows, size):
                    yield _block(group, piece.slice(c, size), n, negatives)

    return meet


def _block(group: _Group, block: pa.RecordBatch, n: int, negatives: bool) -> pa.RecordBatch:
    scores = products(_matrix(block.column(5)), group.matrix)
    number, slot, found = [], [], [np.zeros((2, 0), int)]
    anchors = zip(*(block.column(c).to_pylist() for c in (2, 3, 4, 6)))
    for i, (anchor, own, label, limits) in enumerate(anchors):
        row = scores[i]
        if negatives:
            # Slot j holds the scores up to its upper limit and above the next one.
            uppers = np.array(sorted({x["most"] for x in limits}, reverse=True))
            least = min(x["least"] for x in limits)
            others = np.flatnonzero((group.labels != label) & (row >= least) & (row <= uppers[0]))
            at = np.searchsorted(-uppers, -row[others], side="right") - 1
            picks = [best(row, others[at == j], n) for j in range(len(uppers))]
        else:
            picks = [best(row, np.flatnonzero((group.labels == label) & (group.null | (group.ids != own))), n)]
        for j, rows in enumerate(picks):
            number += [anchor] * len(rows)
            slot += [j] * len(rows)
            found.append(np.stack([np.full(len(rows), i), rows]))
    at = np.concatenate(found, axis=1)
    return pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int64()), pa.array(slot, pa.int32()), pa.array(scores[at[0], at[1]], pa.int64()),
         pa.array(group.ids[at[1]], pa.int64(), mask=group.null[at[1]])],
        names=["anchor", "slot", "score", "found"],
    )


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first rows of each anchor and slot; Spark cuts the lists before the shuffle, too."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("found").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def _searched(rows: DataFrame, anchors: DataFrame, groups: int, n: int, negatives: bool) -> DataFrame:
    """Every group of rows meets every anchor; anchors are copied once for each group."""
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    limits = F.col("limits") if negatives else F.lit(None).cast(LIMITS)
    own = rows.select(
        "group", F.lit(ROWS).alias("kind"), F.lit(None).cast("long").alias("anchor"), "id", "label", "vector",
        F.lit(None).cast(LIMITS).alias("limits"))
    sent = anchors.select(copies.alias("group"), F.lit(ANCHORS).alias("kind"), "anchor", "id", "label", "vector", limits.alias("limits"))
    dealt = own.union(sent).repartition(groups, "group").sortWithinPartitions("group", "kind")
    return _first(dealt.mapInArrow(_met(n, negatives), "anchor long, slot int, score long, found long"), n)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lower: int = LOWER,
    upper: int = UPPER,
    group_cells: int = GROUP_CELLS,
) -> DataFrame:
    """Negatives of every anchor and positive among rows of (id, label, vector), whose vectors
    hold whole numbers: anchor_id, positive_id, rank, negative_id and the two scores.

    ``is_anchor`` tells the anchors by id and label. A negative has another label and scores
    from ``lower`` to ``upper`` percent of its positive; the first ``negatives`` are kept.
    """
    rows = rows.where("label is not null and vector is not null").select("id", "label", "vector")
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    cells = rows.agg(F.sum(F.size("vector"))).first()[0] or 0
    groups = max(blocks_for(cells, group_cells), min(GROUPS, blocks_for(cells, LEAST_CELLS)))
    rows = rows.withColumn("group", F.pmod(uniform_hash(11, "row"), F.lit(groups)))
    anchors = rows.where(F.col("id").isNotNull() & is_anchor).withColumnRenamed("row", "anchor")

    first = _searched(rows, anchors, groups, positives, negatives=False)
    share = F.col("score").cast("decimal(38,0)")
    pairs = first.where("score >= 0").select(
        "anchor", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(share * lower / 100).cast("long").alias("least"), F.floor(share * upper / 100).cast("long").alias("most"))
    pairs = store(pairs.where("least <= most"), "positives")

    limits = pairs.groupBy("anchor").agg(F.collect_set(F.struct("least", "most")).alias("limits"))
    slots = _searched(rows, anchors.join(limits, "anchor"), groups, negatives, negatives=True)
    # From the highest slot down; a slot has at most as many rows as are wanted.
    ordered = F.sort_array(F.collect_list(F.struct("slot", "place", "score", "found")))
    candidates = slots.groupBy("anchor").agg(ordered.alias("candidates"))
    suffix = F.filter("candidates", lambda x: x["score"] <= F.col("most"))
    taken = F.filter(F.slice(suffix, 1, negatives), lambda x: x["score"] >= F.col("least"))
    both = pairs.join(candidates, "anchor").join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    out = both.select("anchor_id", "positive_id", "positive_score", F.posexplode(taken).alias("at", "negative"))
    return out.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("negative.found").alias("negative_id"),
        "positive_score", F.col("negative.score").alias("negative_score"))


def op11_slot_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; labels of every seventh are moved on by one."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.col("vec_id") % 7 == 0
    label = F.when(moved, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = table.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), scaled(F.col("embedding")).alias("vector"))
    return hard_negatives(rows, F.col("id") % 100 == 0)
