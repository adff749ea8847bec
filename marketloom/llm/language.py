"""Language identification with interpolated Kneser-Ney character models.

One model per language, of ``ORDER`` characters, learned from a bounded sample: the whole
texts of at most ``DOCS_PER_LANGUAGE`` labelled documents of a language, chosen by a hash
of the text. Counts are made in tasks; models hold, for each
order, sorted hashes of the seen n-grams with their probabilities, and sorted hashes of
contexts with their back-off weights. A fifth of the sample calibrates the rejection: a
text is rejected when its cross-entropy exceeds what nearly all sample texts of the
predicted language stay below.

Texts are scored whole. Letters count in lower case; everything between letters counts
as one blank. Null texts and texts without letters are ``und`` with score 0. Rows without
a language teach nothing; repeated rows are rows of their own; without any labelled
row, every text is ``und``. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import uniform_hash
from marketloom.llm.textnum import mix, pieces

ORDER = 4
DOCS_PER_LANGUAGE = 600
CACHE_BITS = 19
UNDETERMINED = "und"
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each 16-bit code: the lower-case letter, or a blank."""
    if not _TABLE:
        table = np.full(1 << 16, 32, np.uint16)
        for c in range(1 << 16):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _TABLE.append(table)
    return _TABLE[0]


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all rows with single blanks between and around words, and their rows.

    Letters beyond 16 bits keep their low 16 bits, which is enough to tell scripts apart.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(starts)])[offsets]
    low = _letters()[points & 0xFFFF]
    for c in np.unique(points[points > 0xFFFF]):
        low[points == c] = int(c) & 0xFFFF if chr(int(c)).isalpha() else 32
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    n = len(offsets) - 1
    # A blank before each row, and one at its end, where words then meet a boundary.
    low = np.insert(low, np.concatenate([at[:-1], at[1:]]), 32)
    row = np.insert(row, np.concatenate([at[:-1], at[1:]]), np.concatenate([np.arange(n), np.arange(n)]))
    order = np.argsort(row, kind="stable")
    low, row = low[order], row[order]
    keep = np.ones(len(low), bool)
    keep[1:] = ~((low[1:] == 32) & (low[:-1] == 32) & (row[1:] == row[:-1]))
    return low[keep], row[keep]


def grams(low: np.ndarray, row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams (16 bits a letter) inside rows, and their rows."""
    n = len(low) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.zeros(n, np.uint64)
    for i in range(order):
        key = (key << np.uint64(16)) | low[i : i + n].astype(np.uint64)
    same = row[:n] == row[order - 1 :]
    return key[same], row[:n][same]


class Sorted:
    """Values by hash: sorted hashes and binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        h = mix(keys)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return self.hashes[at] == h, self.values[at]


class KneserNey:
    """Interpolated Kneser-Ney over characters: counts of the highest order, numbers of
    distinct predecessors below it, one discount per order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER):
        self.order = order
        levels = {order: (keys, counts.astype(np.float64))}
        for k in range(order - 1, 0, -1):
            lower = levels[k + 1][0] & np.uint64((1 << 16 * k) - 1)
            levels[k] = tuple(np.unique(lower, return_counts=True))
        single, n = levels[1]
        n = n.astype(np.float64)
        self.floor = 0.5 / (n.sum() + 0.5 * (len(n) + 1)) if len(n) else 1.0
        self.found = {1: Sorted(single, (n + 0.5) / (n.sum() + 0.5 * (len(n) + 1)))} if len(n) else {1: Sorted(single, n)}
        self.back: dict[int, Sorted] = {}
        for k in range(2, order + 1):
            key, c = levels[k]
            sort = np.argsort(key)
            key, c = key[sort], c[sort].astype(np.float64)
            once, twice = (c == 1).sum(), (c == 2).sum()
            discount = once / (once + 2 * twice) if once else 0.5
            context = key >> np.uint64(16)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(key) else np.zeros(0, np.int64)
            total = np.add.reduceat(c, first) if len(key) else c
            kinds = np.diff(np.concatenate([first, [len(key)]]))
            weight = discount * kinds / total if len(key) else total
            of = np.repeat(np.arange(len(first)), kinds)
            below = self.probability(key & np.uint64((1 << 16 * (k - 1)) - 1), k - 1)
            p = np.maximum(c - discount, 0) / total[of] + weight[of] * below if len(key) else c
            self.found[k], self.back[k] = Sorted(key, p), Sorted(context[first], weight)

    def probability(self, keys: np.ndarray, order: int | None = None) -> np.ndarray:
        """Probability of the last character of each packed n-gram after the others."""
        order = order or self.order
        hit, value = self.found[1].get(keys & np.uint64(0xFFFF))
        p = np.where(hit, value, self.floor)
        for k in range(2, order + 1):
            part = keys & np.uint64(2 ** (16 * k) - 1)
            hit, value = self.found[k].get(part)
            seen, weight = self.back[k].get(part >> np.uint64(16))
            p = np.where(hit, value, np.where(seen, weight * p, p))
        return p


class Identifier:
    """All languages' models, with a table of the n-grams met lately."""

    def __init__(self, languages: list[str], models: list[KneserNey], limits: np.ndarray):
        self.languages, self.models, self.limits = languages, models, limits
        self.slots: np.ndarray | None = None

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """-log2 probability, a row per n-gram and a column per language."""
        if self.slots is None:
            self.slots = np.zeros(1 << CACHE_BITS, np.uint64)
            self.costs = np.zeros((1 << CACHE_BITS, len(self.models)), np.float32)
        slot = (mix(keys) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        miss = self.slots[slot] != keys
        out = self.costs[slot]
        if miss.any():
            new, inverse = np.unique(keys[miss], return_inverse=True)
            costs = np.stack([-np.log2(m.probability(new)) for m in self.models], axis=1).astype(np.float32)
            out[miss] = costs[inverse]
            where = (mix(new) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            self.slots[where], self.costs[where] = new, costs
        return out

    def entropies(self, low: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Length-normalised cross-entropy per row and language, and numbers of n-grams."""
        keys, at = grams(low, row, min(ORDER, 4))
        n = np.bincount(at, minlength=rows)
        sums = np.zeros((rows, len(self.models)))
        if len(keys) and self.models:
            cost = self.bits(keys)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            sums[at[first]] = np.add.reduceat(cost, first, axis=0, dtype=np.float64)
        return sums / np.maximum(n, 1)[:, None], n


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in pieces(batch, "text"):
            keys, at = grams(*letters(data, offsets), ORDER)
            lang = rows.column(rows.schema.names.index("lang")).to_pylist()
            for name in sorted(set(lang)):
                mine = np.array([x == name for x in lang])
                k, c = np.unique(keys[mine[at]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(c)], names=["lang", "gram", "c"])


def own_entropies(sample: DataFrame, known: Identifier) -> DataFrame:
    """(lang, h): cross-entropy of texts, of twenty n-grams at least, in their own language."""
    shared = sample.sparkSession.sparkContext.broadcast(known)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, data, offsets in pieces(batch, "text"):
                lang = rows.column(rows.schema.names.index("lang")).to_pylist()
                h, n = model.entropies(*letters(data, offsets), rows.num_rows)
                out = [(x, h[i, model.languages.index(x)]) for i, x in enumerate(lang) if n[i] >= 20 and x in model.languages]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in out], pa.string()), pa.array([v for _, v in out], pa.float64())], names=["lang", "h"])

    return sample.select("lang", "text").mapInArrow(measure, "lang string, h double")


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Identifier:
    """Learn from rows (lang, text) with a language; only the bounded sample is gathered."""
    rows = labelled.where("lang is not null and text is not null").withColumn("key", uniform_hash(8, "text"))
    rank = Window.partitionBy("lang").orderBy("key")
    # Texts are ranked, not rows: copies take one place.
    ids = rows.select("lang", "key").distinct()
    ids = ids.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= docs_per_language)
    # At most docs_per_language rows for each language.
    sample = rows.join(F.broadcast(ids), ["lang", "key"]).dropDuplicates(["lang", "key"]).select("lang", "nth", "text")
    counts = sample.where("nth % 5 <> 0").select("lang", "text").mapInArrow(_sample_counts, "lang string, gram long, c long")
    table = counts.groupBy("lang", "gram").agg(F.sum("c").alias("c")).toArrow()
    names = table["lang"].to_numpy()
    gram, c = table["gram"].to_numpy().view(np.uint64), table["c"].to_numpy()
    languages = sorted(set(names))
    models = [KneserNey(gram[names == x], c[names == x]) for x in languages]
    known = Identifier(languages, models, np.full(len(languages), np.inf))
    for row in own_entropies(sample.where("nth % 5 = 0"), known).groupBy("lang").agg(
        F.avg("h").alias("mean"), F.stddev_pop("h").alias("spread")).collect():
        known.limits[languages.index(row["lang"])] = row["mean"] + 4 * row["spread"] + 0.1
    return known


def identify(docs: DataFrame, known: Identifier, id_cols: list[str], text: str = "text") -> DataFrame:
    """Per row: ``lang_pred``, ``score`` and whether the prediction is ``rejected``.

    The score is the share of the best language when likelihoods of at most fifty
    characters are compared.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kept = [f for f in docs.schema.fields if f.name in id_cols]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                low, row = letters(data, offsets)
                count = np.bincount(row[low != 32], minlength=rows.num_rows)
                score, names, bad = np.zeros(rows.num_rows), [UNDETERMINED] * rows.num_rows, np.zeros(rows.num_rows, bool)
                if model.languages:
                    h, n = model.entropies(low, row, rows.num_rows)
                    best = np.argmin(h, axis=1)
                    least = h[np.arange(len(h)), best]
                    share = 1 / np.exp2(np.maximum(-(h - least[:, None]) * np.clip(n, 1, 50)[:, None], -1000)).sum(axis=1)
                    score = np.where(count > 0, share, 0.0)
                    names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, count)]
                    bad = (count > 0) & (least > model.limits[best])
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(rows.schema.names.index(f.name)) for f in kept], pa.array(names, pa.string()), pa.array(score), pa.array(bad)],
                    names=[*[f.name for f in kept], "lang_pred", "score", "rejected"],
                )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string, score double, rejected boolean"])
    return docs.select(*[f.name for f in kept], text).mapInArrow(predict, schema)


def op8_kneser_ney_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = docs.withColumn("held_out", out)
    known = fit(docs.where("not held_out").select("lang", "text"))
    return identify(docs, known, ["doc_id", "held_out"])
