"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs (lines, long lines cut every ``PARAGRAPH`` characters) are hashed to
64-bit digests. Each distinct digest is added to three cells of a sketch: a count, the XOR
of digests and the XOR of their checksums. Sketches of two versions are subtracted cell
by cell; shared paragraphs cancel, and peeling cells that hold one digest recovers the
differing ones. Where peeling gets stuck, both sketches are made again with four times
the cells. From the numbers recovered follows the likeness (shared paragraphs over all).

All of it is built-in column functions: a sketch is a sorted array of its cells that are
not empty, and adding, subtracting and peeling are one sort and one fold. Null texts
count as empty, empty texts have no paragraphs, and two texts without paragraphs are
alike (1.0). Repeated rows get equal fingerprints. Empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import store, uniform_hash
from marketloom.llm.quality import bind

PARAGRAPH = 240
CELLS = 32
HASHES = 3
ROUNDS = 24
RANGES = 256
ROWS_PER_BLOCK = 1000
STATE = "array<struct<cell:int,n:int,key:bigint,check:bigint>>"


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text."""
    lines = F.split(text, "\n", -1)
    cut = lambda x: F.regexp_extract_all(x, F.lit(rf"(?s).{{1,{PARAGRAPH}}}"), F.lit(0))
    return F.array_distinct(F.transform(F.flatten(F.transform(lines, cut)), lambda x: F.xxhash64(x)))


def check(key: Column) -> Column:
    return F.xxhash64(F.lit(77), key)


def entries(keys: Column, sign: Column | int, cells: int) -> Column:
    """What digests add to the cells; the three parts of the sketch keep them apart."""
    third = cells // HASHES
    one = lambda k, h: F.struct(
        (F.pmod(F.xxhash64(F.lit(h), k), F.lit(third)) + h * third).cast("int").alias("cell"),
        F.lit(sign).cast("int").alias("n"), k.alias("key"), check(k).alias("check"),
    )
    return F.flatten(F.transform(keys, lambda k: F.array(*[one(k, h) for h in range(HASHES)])))


def merged(parts: Column) -> Column:
    """Add up entries of the same cell and leave out cells that become empty."""
    full = lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0)

    def step(done: Column, x: Column) -> Column:
        last = done["last"]
        joined = F.struct(
            x["cell"].alias("cell"), (last["n"] + x["n"]).alias("n"),
            last["key"].bitwiseXOR(x["key"]).alias("key"), last["check"].bitwiseXOR(x["check"]).alias("check"))
        kept = F.when(full(last), F.concat(done["cells"], F.array(last))).otherwise(done["cells"])
        return F.when(
            last["cell"] == x["cell"], F.struct(done["cells"].alias("cells"), joined.alias("last"))
        ).otherwise(F.struct(kept.alias("cells"), x.alias("last")))

    nothing = F.struct(F.lit(-1).alias("cell"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))
    start = F.struct(F.array().cast(STATE).alias("cells"), nothing.alias("last"))
    end = lambda s: F.when(full(s["last"]), F.concat(s["cells"], F.array(s["last"]))).otherwise(s["cells"])
    return F.aggregate(F.sort_array(parts), start, step, end)


def sketch(keys: Column, cells: int) -> Column:
    return merged(entries(keys, 1, cells))


def negated(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.struct(c["cell"].alias("cell"), (-c["n"]).alias("n"), c["key"].alias("key"), c["check"].alias("check")))


def peeled(difference: Column, cells: int) -> Column:
    """Peel a difference: the cells left (none if it worked) and the digests found on
    either side. Each round takes out every digest that is alone in some cell."""
    def step(state: Column, _: Column) -> Column:
        def after(alone: Column) -> Column:
            left = F.array_distinct(F.transform(F.filter(alone, lambda c: c["n"] == 1), lambda c: c["key"]))
            right = F.array_distinct(F.transform(F.filter(alone, lambda c: c["n"] == -1), lambda c: c["key"]))
            rest = lambda a, b: merged(F.concat(state["cells"], entries(a, -1, cells), entries(b, 1, cells)))
            return bind(left, lambda a: bind(right, lambda b: F.struct(
                rest(a, b).alias("cells"), F.concat(state["left"], a).alias("left"),
                F.concat(state["right"], b).alias("right"), F.lit(False).alias("stuck"))))
        alone = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == check(c["key"])))
        stop = F.struct(state["cells"].alias("cells"), state["left"].alias("left"), state["right"].alias("right"), F.lit(True).alias("stuck"))
        return F.when(state["stuck"] | (F.size(state["cells"]) == 0), stop).otherwise(
            bind(alone, lambda a: F.when(F.size(a) == 0, stop).otherwise(after(a))))

    longs = F.array().cast("array<bigint>")
    start = F.struct(difference.alias("cells"), longs.alias("left"), longs.alias("right"), F.lit(False).alias("stuck"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def written(cells: Column) -> Column:
    """A sketch as text: cell, count and the two XORs in hexadecimal."""
    part = lambda c: F.concat(
        F.lpad(F.hex(c["cell"]), 2, "0"), F.lpad(F.hex(c["n"]), 2, "0"), F.lpad(F.hex(c["key"]), 16, "0"),
        F.right(F.lpad(F.hex(c["check"]), 16, "0"), F.lit(4)))
    return F.concat(F.lit(f"iblt{CELLS}:"), F.array_join(F.transform(cells, part), ""))


def differences(pairs: DataFrame, a: str, b: str, cells: int = CELLS) -> DataFrame:
    """Add ``only_a`` and ``only_b``, the digests that peeling recovers from sketches.

    Rows whose peeling gets stuck go on to larger sketches; once a sketch has eight cells
    for each digest, what is still stuck (hash accidents) is compared directly.
    """
    names = pairs.columns
    done, todo = [], store(pairs, "pairs")
    while True:
        difference = F.concat(sketch(F.col(a), cells), negated(sketch(F.col(b), cells)))
        tried = store(todo.select(*names, peeled(merged(difference), cells).alias("__p")), "peeled")
        ended = F.size("__p.cells") == 0
        done.append(tried.where(ended).select(*names, F.col("__p.left").alias("only_a"), F.col("__p.right").alias("only_b")))
        todo = tried.where(~ended).select(*names)
        most = todo.agg(F.max(F.size(a) + F.size(b))).first()[0]
        if most is None:
            return reduce(DataFrame.union, done)
        if cells > 8 * most:
            rest = todo.select(*names, F.array_except(a, b).alias("only_a"), F.array_except(b, a).alias("only_b"))
            return reduce(DataFrame.union, [*done, rest])
        cells *= 4


def likeness(a: str, b: str, only_a: str, only_b: str) -> Column:
    """Shared paragraphs over all paragraphs of both."""
    every = F.size(a) + F.size(only_b)
    return F.when(every == 0, F.lit(1.0)).otherwise((F.size(a) - F.size(only_a)) / every)


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``next_text``: the text that follows in descending order of ids, going round.

    Ids are cut into ranges at quantiles, and ranges into equal steps, so that a window
    runs over a bounded piece; the last row of a piece follows on the first row of the
    next piece. Rows that share an id are ordered by a hash of the text, then the text.
    Rows without an id come last, cut into pieces by that hash. Pieces find the next one
    inside their range, and only the ranges, some hundreds, are ordered by one task.
    """
    n, known, low, high, cuts = docs.agg(
        F.count(F.lit(1)), F.count(id_col), F.min(id_col), F.max(id_col),
        F.percentile_approx(id_col, [i / RANGES for i in range(1, RANGES)], 20_000)).first()
    cuts = sorted({*(cuts or []), low, high} - {None}) or [0]
    steps = max(1, -(-n // (RANGES * ROWS_PER_BLOCK)))
    edges = F.array(*[F.lit(c).cast("long") for c in cuts])
    at = F.size(F.filter(edges, lambda e: e <= F.col(id_col))) - 1
    # Doubles keep the order of ids, and have room for differences of any two.
    below = F.get(edges, F.col("__at")).cast("double")
    above = F.coalesce(F.get(edges, F.col("__at") + 1).cast("double"), F.lit(float(cuts[-1]) + 1))
    share = (F.col(id_col).cast("double") - below) / F.greatest(above - below, F.lit(1.0))
    inner = F.least(F.greatest(F.floor(share * steps), F.lit(0)), F.lit(steps - 1))
    place = uniform_hash(10, text)
    without = max(1, -(-(n - known) // ROWS_PER_BLOCK))
    last = -1 - F.least(F.floor((place.cast("double") / 2.0**64 + 0.5) * without), F.lit(without - 1))
    piece = F.when(F.col(id_col).isNull(), last).otherwise(F.col("__at") * steps + inner).cast("long")
    rows = docs.withColumn("__at", at).withColumn("__piece", piece).drop("__at")
    order = Window.partitionBy("__piece").orderBy(F.col(id_col).desc_nulls_last(), uniform_hash(10, text), text)
    rows = rows.withColumns({
        "__next": F.lead(F.struct(text)).over(order), "__nth": F.row_number().over(order)})
    firsts = rows.where("__nth = 1").select(F.col("__piece").alias("__p"), F.struct(text).alias("__first"))
    pieces_ = firsts.select("__p", F.greatest(F.floor(F.col("__p") / steps), F.lit(-1)).alias("__range"))
    pieces_ = pieces_.withColumn("__follows", F.lead("__p").over(Window.partitionBy("__range").orderBy(F.desc("__p"))))
    tops = pieces_.groupBy("__range").agg(F.max("__p").alias("__top"))
    down = Window.orderBy(F.desc("__range"))
    every = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select(
        F.col("__range").alias("__r"), F.coalesce(F.lead("__top").over(down), F.max("__top").over(every)).alias("__down"))
    ring = pieces_.join(tops, pieces_["__range"] == tops["__r"]).select(
        F.col("__p").alias("__of"), F.coalesce("__follows", "__down").alias("__to"))
    heads = firsts.join(ring, firsts["__p"] == ring["__to"]).select("__of", "__first")
    joined = rows.join(heads, rows["__piece"] == heads["__of"], "left")
    return joined.select(*docs.columns, F.coalesce("__next", "__first")[text].alias("next_text"))


def op10_iblt_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    body = F.coalesce(F.col("text"), F.lit("")).alias("text")
    near = with_next(docs.select("doc_id", body)).withColumn("n", F.length("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n") - half), F.left("next_text", half))
    rows = near.withColumn("edited", edited)
    rows = store(rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), digests(F.col("next_text")).alias("after"),
    ), "digests")
    compared = differences(differences(rows, "own", "changed").withColumnsRenamed({"only_a": "ea", "only_b": "eb"}), "own", "after")
    return compared.select(
        "doc_id", "n_chars", "edited_sha256",
        written(sketch(F.col("own"), CELLS)).alias("fingerprint"),
        written(sketch(F.col("changed"), CELLS)).alias("edited_fingerprint"),
        likeness("own", "changed", "ea", "eb").alias("near_edited"),
        likeness("own", "after", "only_a", "only_b").alias("near_next"),
        F.size("ea").cast("long").alias("n_removed"), F.size("eb").cast("long").alias("n_added"),
    )
