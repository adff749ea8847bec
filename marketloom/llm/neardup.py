"""MinHash near-duplicates, verified with odd sketches.

1. Each text becomes the set of its five-word shingles (64-bit hashes). Texts with equal
   sets form a class, represented by its smallest document id; only classes go on.
2. ``BANDS * ROWS`` MinHash values per class make band keys; all values are also folded
   into an odd sketch: a bitmap of ``BITS`` parities, one bit toggled per value. The
   population count of the XOR of two sketches estimates high similarities closely.
3. Classes that share a band key meet in a bucket. A bucket larger than ``BLOCK`` is cut
   into blocks, and each pair of blocks is a group of its own, so no task gets an
   unbounded group. In a group, sketches are compared and links form a maximum
   spanning forest: fewer links than members, not all pairs.
4. These candidates are confirmed on the full sets, and components are built. A second
   pass takes every member that still has a sketch match in another component, brings
   the texts of those members into the groups, compares full sets there, and returns one
   link for each two components it joins. No link between components is lost, and what
   is sent grows with the members of a group, not with its pairs.

With the defaults, a pair of similarity 0.85 shares no band with a chance of 3e-7, and
its sketches differ in more than ``most_bits`` bits with a chance of about 1e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import store
from marketloom.llm.graph import components
from marketloom.llm.textnum import mix, pieces, shingle_sets, signed

WIDTH = 5
BANDS, ROWS = 26, 5
BITS = 512
BLOCK = 1500
SIGNATURE = "n_shingles long, set_a long, set_b long, bands array<long>, sketch binary"


def most_bits(similarity: float, deviations: float = 5.0) -> int:
    """Bits in which two sketches may differ: the expectation at a similarity that lies
    ``deviations`` standard errors of the MinHash estimate below the wanted one."""
    samples = BANDS * ROWS
    low = similarity - deviations * math.sqrt(similarity * (1 - similarity) / samples)
    return math.ceil(BITS / 2 * (1 - math.exp(-4 * samples * (1 - low) / BITS)))


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, set digest, band keys and odd sketch of every row; nulls for empty sets."""
    rng = np.random.default_rng(3)
    factors = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    samples = BANDS * ROWS
    salt = mix(np.arange(1, samples + 1, dtype=np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                sets = shingle_sets(data, offsets, WIDTH)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                some = np.flatnonzero(sizes)
                a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                bands = pa.nulls(len(sets), pa.list_(pa.int64()))
                sketch = pa.nulls(len(sets), pa.binary())
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                    a[some] = np.add.reduceat(mix(flat + np.uint64(1)), starts)
                    b[some] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    least = np.empty((len(some), samples), np.uint64)
                    for j, factor in enumerate(factors):
                        least[:, j] = np.minimum.reduceat(flat * factor, starts)
                    least = mix(least ^ salt)
                    keys = np.zeros((len(some), BANDS), np.uint64)
                    for j in range(ROWS):
                        keys = mix(keys + least[:, j::ROWS])
                    keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
                    odd = np.zeros((len(some), BITS), np.uint8)
                    np.add.at(odd, (np.arange(len(some))[:, None], (least >> np.uint64(17)) % np.uint64(BITS)), 1)
                    packed = np.packbits(odd & 1, axis=1)
                    where = np.full(len(sets), -1)
                    where[some] = np.arange(len(some))
                    take = pa.array(np.where(where < 0, None, where), pa.int64())
                    at = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
                    bands = pa.ListArray.from_arrays(pa.array(at), signed(keys.reshape(-1))).take(take)
                    sketch = pa.array([r.tobytes() for r in packed], pa.binary()).take(take)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(rows.schema.names.index(id_col)).cast(pa.int64()), pa.array(sizes), signed(a), signed(b), bands, sketch],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
                )

    return docs.select(id_col, text).mapInArrow(sign, "doc_id long, " + SIGNATURE)


def _forest(sketch: np.ndarray, size: np.ndarray, limit: int, ratio: float) -> list[tuple[int, int]]:
    """Maximum spanning forest of the sketch matches in a group (Prim's algorithm)."""
    n = len(sketch)
    if n == 2:
        differ = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
        return [(0, 1)] if differ <= limit and min(size) >= ratio * max(size) else []
    out, best, parent = [], np.full(n, BITS + 1), np.zeros(n, np.int64)
    todo = np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        todo[at] = False
        differ = np.bitwise_count(sketch ^ sketch[at]).sum(axis=1)
        fits = (np.minimum(size, size[at]) >= ratio * np.maximum(size, size[at])) & (differ <= limit)
        better = fits & todo & (differ < best)
        best[better], parent[better] = differ[better], at
        rest = np.flatnonzero(todo)
        at = int(rest[np.argmin(best[rest])])
        if best[at] <= limit:
            out.append((int(parent[at]), at))
    return out


def _fits(sketch: np.ndarray, size: np.ndarray, i: int, rest: np.ndarray, limit: int, ratio: float) -> np.ndarray:
    """Those of ``rest`` whose sketch and size match member ``i``."""
    differ = np.bitwise_count(sketch[rest] ^ sketch[i]).sum(axis=1)
    return rest[(differ <= limit) & (np.minimum(size[rest], size[i]) >= ratio * np.maximum(size[rest], size[i]))]


def _crossing(sketch: np.ndarray, size: np.ndarray, comp: np.ndarray, limit: int, ratio: float) -> np.ndarray:
    """Members of a group with a sketch match in another component."""
    taken = np.zeros(len(sketch), bool)
    for i in range(len(sketch) - 1):
        found = _fits(sketch, size, i, np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1, limit, ratio)
        if len(found):
            taken[i] = taken[found] = True
    return np.flatnonzero(taken)


def _joins(sets: list[np.ndarray], sketch: np.ndarray, size: np.ndarray, comp: np.ndarray, limit: int, ratio: float) -> list[tuple[int, int]]:
    """Links on full sets that join components of a group; further ones between joined
    components are left out."""
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    percent, mark, comp, out = round(100 * ratio), np.zeros(len(ids), bool), comp.copy(), []
    for i in range(len(sets) - 1):
        rest = _fits(sketch, size, i, np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1, limit, ratio)
        if not len(rest):
            continue
        mine = ids[starts[i] : starts[i + 1]]
        mark[mine] = True
        for j in rest:
            if comp[j] != comp[i]:
                both = int(mark[ids[starts[j] : starts[j + 1]]].sum())
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    out.append((i, int(j)))
                    comp[comp == comp[j]] = comp[i]
        mark[mine] = False
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches, cut so that groups (key, i, j) are whole, and where groups begin."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        ids = [held[c].to_numpy() for c in ("key", "i", "j")]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
        if len(change):
            yield held.slice(0, int(change[-1])), np.concatenate([[0], change[:-1]])
            held = held.slice(int(change[-1]))
    if held is not None and held.num_rows:
        yield held, np.array([0])


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(-1, BITS // 64)
    return table["rep"].to_numpy(), table["comp"].to_numpy(), table["n_shingles"].to_numpy(), sketch


def _links(rep: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [(max(rep[x], rep[y]), min(rep[x], rep[y])) for x, y in found if rep[x] != rep[y]]
    return pa.RecordBatch.from_arrays([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], names=["u", "v"])


def grouped(classes: DataFrame) -> DataFrame:
    """Members of buckets that hold at least two components, by pairs of blocks."""
    slim = classes.select(F.explode("bands").alias("key"), "rep", "comp")
    crowded = slim.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("a"), F.max("comp").alias("b"))
    crowded = crowded.where("a < b").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # Only members of crowded buckets carry their sketch through the shuffle.
    members = slim.join(crowded, "key").join(classes.select("rep", "n_shingles", "sketch"), "rep")
    own = F.pmod(F.xxhash64(F.lit(5), "rep"), F.col("blocks")).cast("int")
    members = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt(members.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "rep", "comp", "n_shingles", "sketch",
    ))


def dealt(members: DataFrame) -> DataFrame:
    return members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")


def candidates(classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) of classes to confirm: forests of the sketch matches in each group."""
    limit = most_bits(similarity)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _groups(batches):
            rep, _, size, sketch = _columns(table)
            found = []
            for a, b in zip(begins, np.append(begins[1:], table.num_rows)):
                if b - a > 1:
                    found += [(a + x, a + y) for x, y in _forest(sketch[a:b], size[a:b], limit, similarity)]
            yield _links(rep, found)

    return grouped(classes.withColumn("comp", F.col("rep"))).mapInArrow(compare, "u long, v long").distinct()


def crossing_links(classes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Confirmed links (u, v) between classes whose components (``comp``) differ."""
    limit = most_bits(similarity)
    members = grouped(classes)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _groups(batches):
            _, comp, size, sketch = _columns(table)
            rows = []
            for a, b in zip(begins, np.append(begins[1:], table.num_rows)):
                if b - a > 1:
                    rows.append(a + _crossing(sketch[a:b], size[a:b], comp[a:b], limit, similarity))
            taken = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            yield from table.take(pa.array(taken, pa.int64())).combine_chunks().to_batches()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _groups(batches):
            rep, comp, size, sketch = _columns(table)
            found = []
            for a, b in zip(begins, np.append(begins[1:], table.num_rows)):
                rows = table.slice(int(a), int(b - a)).select(["text"]).combine_chunks().to_batches()
                sets = [x for batch in rows for _, d, o in pieces(batch) for x in shingle_sets(d, o, WIDTH)]
                found += [(a + x, a + y) for x, y in _joins(sets, sketch[a:b], size[a:b], comp[a:b], limit, similarity)]
            yield _links(rep, found)

    kept = store(members.mapInArrow(pick, members.schema), "crossing")
    texts = texts_of(docs, kept.select("rep").distinct())
    return dealt(kept.join(texts, "rep")).mapInArrow(join, "u long, v long")


def texts_of(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """Texts (rep, text) of the wanted documents; both sides may be large."""
    return docs.join(reps.hint("merge"), docs["doc_id"] == reps["rep"]).select("rep", "text")


def confirm(pairs: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity (in hundredths, exactly).

    ``docs`` has ``rep`` and ``text`` of the classes; only those in pairs are shuffled.
    """
    percent = round(100 * similarity)
    left = docs.select(F.col("rep").alias("u"), F.col("text").alias("text_u"))
    right = docs.select(F.col("rep").alias("v"), F.col("text").alias("text_v"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text_u"):
                ours = shingle_sets(data, offsets, WIDTH)
                theirs = [s for _, d, o in pieces(rows, "text_v") for s in shingle_sets(d, o, WIDTH)]
                keep = []
                for a, b in zip(ours, theirs):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield rows.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v").mapInArrow(check, "u long, v long")


def near_duplicates(docs: DataFrame, similarity: float = 0.85, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Empty texts are linked with nothing. Rows that share an id count as one document when
    components are built. A row without an id has no component and is kept. Empty tables
    give an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = store(signatures(docs), "signatures")
    digest = ["n_shingles", "set_a", "set_b"]
    named = rows.where("n_shingles > 0 and doc_id is not null")
    reps = store(named.groupBy(*digest).agg(F.min("doc_id").alias("rep")), "classes")
    same = (F.col("doc_id") == F.col("rep")) & (rows["n_shingles"] == reps["n_shingles"])
    same = same & (rows["set_a"] == reps["set_a"]) & (rows["set_b"] == reps["set_b"])
    classes = store(
        named.join(reps, same).select("rep", rows["n_shingles"], "bands", "sketch").dropDuplicates(["rep", "n_shingles", "sketch"]),
        "bands",
    )

    tried = store(candidates(classes, similarity), "tried")
    ends = tried.select(F.col("u").alias("rep")).union(tried.select("v")).distinct()
    links = store(confirm(tried, store(texts_of(docs, ends), "texts"), similarity), "confirmed")
    first = components(links)
    labelled = classes.join(first, classes["rep"] == first["node"], "left").withColumn("comp", F.coalesce("component", "rep"))
    more = store(crossing_links(labelled.drop("node", "component"), docs, similarity), "across")
    if more.limit(1).count():
        first = components(links.union(more))
    # A class goes by its smallest id; ids that occur with several texts join classes.
    members = rows.join(reps, digest, "left").select(rows["doc_id"], rows["n_shingles"], "rep")
    shared = named.groupBy("doc_id").agg(F.min(F.struct(*digest)).alias("x"), F.max(F.struct(*digest)).alias("y")).where("x <> y")
    if shared.limit(1).count():
        twice = members.join(shared.select("doc_id"), "doc_id", "left_semi").where("rep is not null")
        first = components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(twice.select("doc_id", "rep")))
    out = members.join(first, F.coalesce("rep", "doc_id") == first["node"], "left")
    component = F.coalesce("component", "rep", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def op3_odd_sketches(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the smallest document of every component at a similarity of 0.8, and
    rows without an id.

    Of rows that share an id, the one with the least hash of its columns stays.
    """
    dropped = near_duplicates(docs, similarity=0.8).where("not kept").select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = left.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    if not repeated.limit(1).count():
        return left
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    first = left.join(repeated, "doc_id", "left_semi").withColumn("__nth", F.row_number().over(order)).where("__nth = 1")
    return left.join(repeated, "doc_id", "left_anti").unionByName(first.select(*docs.columns))
