"""Bigram language model in a log-frequency Bloom filter.

Counts of all training n-grams (one and two tokens) are made exactly, combined in each
task before the shuffle. A count ``c`` is quantised to level ``1 + floor(log2 c)``, so that
n-grams seen once have the first level, and an n-gram is put into the filter once for each
level up to its own; reading probes level after level until one is missing. Words and
bigrams have a filter each, made of segments, one for each bucket of n-grams, so that tasks
build them apart. They have ``BITS_PER_ITEM`` bits for every level of every n-gram, however
many there are.

The words' filter is broadcast up to ``MAX_BITS`` bits. The bigrams' filter is broadcast in
passes of at most ``MAX_BITS`` bits each: a pass adds the log probabilities of the tokens
whose bigram falls into its segments, and nothing is shuffled but a number for each text.
Beyond ``MAX_PASSES`` passes, or with too many words, the segments stay in a table, and the
n-grams of the texts travel to them, each once for a block of texts. Both ways probe the
same bits and give the same scores.

A token's probability is the bigram count smoothed with the unigram probability:
``(c(h w) + K p(w)) / (c(h) + K)``, ``p(w) = (c(w) + 1) / (N + V + 1)``.

The plain unigram score is exact: counts of the ``FREQUENT`` commonest words are
broadcast, the other words of a document are joined with the table of all counts; each
of them has less than N / FREQUENT occurrences, so no key is hot.

Null and empty texts have the end token only. A row without an id is learned from.
Repeated rows are counted and scored as rows of their own. Empty tables give no rows. Ties
among the commonest words are broken by hash and change no result. A text is read whole by
one task, whose arrays take about thirty times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import store
from marketloom.llm.textnum import BASE_2, mix, pieces, signed, word_hashes

FREQUENT = 1 << 16
LEAST_PREFIX = 8  # n-grams are dealt by so many leading bits of their hash at least
TOKENS_PER_BUCKET = 1 << 23
SEGMENT_BITS = 1 << 24
LEAST_SEGMENT = 1 << 12  # smaller ones would be overfull by chance
MAX_BITS = 1 << 27
MAX_PASSES = 16  # each reads the texts once more
BITS_PER_ITEM = 10
PROBES = 4
SMOOTHING = 1000.0
FLUSH = 2_000_000
OWN = 2  # rows with which a block keeps its own tokens
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def bigrams(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with the end added to every row, their predecessors, and their rows."""
    count = np.bincount(row, minlength=rows)
    ends = np.cumsum(count + 1) - 1
    token = np.empty(len(h) + rows, np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[is_end], token[~is_end] = END, h
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[np.concatenate([[0], ends[:-1] + 1])] = START
    return token, before, np.repeat(np.arange(rows), count + 1)


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(BASE_2) + token)


def prefix_for(amount: int, each: int) -> int:
    """Leading bits that deal ``amount`` out to buckets of about ``each``."""
    return max(LEAST_PREFIX, (-(-amount // each) - 1).bit_length())


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def distinct_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.concatenate([first, [len(keys)]])).astype(np.uint64)


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, c): exact counts of words, by 64-bit hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for batch in batches:
            for _, data, offsets in pieces(batch, text):
                k, c = distinct_counts(word_hashes(data, offsets)[0])
                keys, counts = np.concatenate([keys, k]), np.concatenate([counts, c])
                if len(keys) > FLUSH:
                    keys, counts = summed(keys, counts)
                    if len(keys) > FLUSH // 2:
                        yield pa.RecordBatch.from_arrays([signed(keys), signed(counts)], names=["token", "c"])
                        keys, counts = keys[:0], counts[:0]
        keys, counts = summed(keys, counts)
        yield pa.RecordBatch.from_arrays([signed(keys), signed(counts)], names=["token", "c"])

    partial = docs.select(text).mapInArrow(count, "token long, c long")
    return partial.groupBy("token").agg(F.sum("c").alias("c"))


def bigram_counts(docs: DataFrame, text: str = "text", prefix: int = LEAST_PREFIX) -> DataFrame:
    """(gram, c): exact counts of bigrams, by 64-bit hash.

    Tasks send one array of sorted hashes and one of counts for each bucket.
    """
    schema = "bucket int, grams binary, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(keys: np.ndarray) -> pa.RecordBatch:
            keys, counts = distinct_counts(keys)
            counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)
            cuts = np.searchsorted(keys >> np.uint64(64 - prefix), np.arange((1 << prefix) + 1, dtype=np.uint64))
            parts = [(b, keys[i:j].tobytes(), counts[i:j].tobytes()) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
            no, grams, many = zip(*parts) if parts else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(no, pa.int32()), pa.array(grams, pa.binary()), pa.array(many, pa.binary())],
                names=["bucket", "grams", "counts"],
            )

        held, size = [], 0
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                token, before, _ = bigrams(*word_hashes(data, offsets), rows.num_rows)
                held.append(pair_hash(before, token))
                size += len(token)
                if size > 2 * FLUSH:
                    yield sent(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield sent(np.concatenate(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(keys: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
            k, c = summed(np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(counts), np.uint32).astype(np.uint64))
            return pa.RecordBatch.from_arrays([signed(k), signed(c)], names=["gram", "c"])

        now, keys, counts = None, [], []
        for batch in batches:
            for bucket, k, c in zip(*[x.to_pylist() for x in batch.columns]):
                if bucket != now and keys:
                    yield merged(keys, counts)
                    keys, counts = [], []
                now = bucket
                keys.append(k)
                counts.append(c)
        if keys:
            yield merged(keys, counts)

    sent = docs.select(text).mapInArrow(count, schema)
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "gram long, c long")


def probes(grams: np.ndarray, level: int, segment_bits: int) -> Iterator[np.ndarray]:
    """Places of a level's bits inside the segment (of less than 2^32 bits) of each gram."""
    h = mix(grams + np.uint64(level * BASE_2 % 2**64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    for _ in range(PROBES):
        yield (h & np.uint64(0xFFFFFFFF)) * np.uint64(segment_bits) >> np.uint64(32)
        h = h + step


class Shape(NamedTuple):
    """Bits of a filter's segment, leading bits that name the bucket, mean count of each level."""

    segment: int
    prefix: int
    means: np.ndarray

    @property
    def bits(self) -> int:
        return self.segment << self.prefix


class CountFilter:
    """Reads quantised counts: levels are probed upwards until one is missing.

    ``bits`` are those of consecutive segments, from that of bucket ``first`` on.
    """

    def __init__(self, bits: np.ndarray, shape: Shape, first: int = 0):
        self.bits, self.shape, self.first = bits, shape, first

    def buckets(self, grams: np.ndarray) -> np.ndarray:
        return grams >> np.uint64(64 - self.shape.prefix)

    def holds(self, grams: np.ndarray) -> np.ndarray:
        """Which n-grams belong to the segments at hand."""
        last = self.first + len(self.bits) * 8 // self.shape.segment
        bucket = self.buckets(grams)
        return (bucket >= np.uint64(self.first)) & (bucket < np.uint64(last))

    def set_bits(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level that each gram is found at; 0 if not found."""
        segment = self.shape.segment
        level = np.zeros(len(grams), np.uint8)
        alive = np.arange(len(grams))
        starts = (self.buckets(grams) - np.uint64(self.first)) * np.uint64(segment)
        for q in range(1, len(self.shape.means)):
            # Most n-grams end at the first probe; only the others make the rest.
            first = next(probes(grams[alive], q, segment))
            alive = alive[self.set_bits(starts[alive] + first)]
            found = np.ones(len(alive), bool)
            for at in probes(grams[alive], q, segment):
                found &= self.set_bits(starts[alive] + at)
            alive = alive[found]
            level[alive] = q
            if not len(alive):
                break
        return level

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Mean training count of each gram's level."""
        return self.shape.means[self.levels(grams)]


def shapes(words: DataFrame, pairs: DataFrame) -> tuple[Shape, Shape]:
    """The filters of words and of bigrams; a level's mean is that of both."""
    level = (F.floor(F.log2("c")) + 1).cast("int").alias("level")
    both = words.select(F.lit(0).alias("kind"), level, "c").union(pairs.select(F.lit(1), level, "c"))
    found = both.groupBy("kind", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()
    top = max((r["level"] for r in found), default=0)
    n, c, needed = np.zeros(top + 1), np.zeros(top + 1), [0, 0]
    for r in found:
        n[r["level"]] += r["n"]
        c[r["level"]] += r["c"]
        needed[r["kind"]] += BITS_PER_ITEM * r["n"] * r["level"]
    means = np.where(n > 0, c / np.maximum(n, 1), 2.0 ** (np.arange(top + 1) - 1))
    means[0] = 0
    out = []
    for bits in needed:
        prefix = prefix_for(bits, SEGMENT_BITS)
        out.append(Shape(max(LEAST_SEGMENT, -(-bits // (1 << prefix) // 64) * 64), prefix, means))
    return out[0], out[1]


def segments(grams: DataFrame, shape: Shape) -> DataFrame:
    """The filter's segments (bucket, bits), built in tasks."""
    segment, prefix = shape.segment, shape.prefix

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(bucket: int, mine: np.ndarray) -> pa.RecordBatch:
            bits = np.packbits(mine, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([bits])], names=["bucket", "bits"])

        now, mine = None, np.zeros(0, bool)
        for batch in batches:
            gram, q, bucket = (c.to_numpy() for c in batch.columns)
            gram = gram.view(np.uint64)
            for b in np.unique(bucket):
                if b != now:
                    if now is not None:
                        yield packed(now, mine)
                    now, mine = int(b), np.zeros(segment, bool)
                for one in range(1, int(q[bucket == b].max()) + 1):
                    for at in probes(gram[(bucket == b) & (q >= one)], one, segment):
                        mine[at.astype(np.int64)] = True
        if now is not None:
            yield packed(now, mine)

    level = (F.floor(F.log2("c")) + 1).cast("int").alias("level")
    dealt = grams.select("gram", level, F.shiftrightunsigned("gram", 64 - prefix).cast("int").alias("bucket"))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(build, "bucket int, bits binary")


def gathered(parts: DataFrame, shape: Shape, first: int = 0, last: int | None = None) -> CountFilter:
    """Segments ``first`` to ``last`` (exclusive) of a filter; only for a checked number of bits."""
    last = 1 << shape.prefix if last is None else last
    each = shape.segment // 8
    table = np.zeros((last - first) * each, np.uint8)
    for row in parts.where(F.col("bucket").between(first, last - 1)).toLocalIterator():
        at = (row["bucket"] - first) * each
        table[at : at + each] = np.frombuffer(row["bits"], np.uint8)
    return CountFilter(table, shape, first)


def log_probabilities(single: np.ndarray, pair: np.ndarray, ends: np.ndarray, texts: int, norm: float, smoothing: float) -> np.ndarray:
    """log10 of each token's probability, from the filter's counts of tokens and bigrams.

    ``ends`` are the places of the end tokens, whose count is known; a text's first token
    follows the start, which is as frequent.
    """
    single[ends] = texts
    after = np.empty_like(single)
    after[1:] = single[:-1]
    after[np.concatenate([[0], ends[:-1] + 1])] = texts
    pair = np.minimum(pair, after)
    return np.log10((pair + smoothing * (single + 1) / norm) / (after + smoothing))


def partial_scores(
    h: np.ndarray, row: np.ndarray, rows: int, words: CountFilter, pairs: CountFilter, texts: int, norm: float, smoothing: float,
) -> np.ndarray:
    """Each row's sum of log10 probabilities of the tokens whose bigram ``pairs`` holds."""
    token, before, place = bigrams(h, row, rows)
    grams = pair_hash(before, token)
    many = np.bincount(place, minlength=rows)
    mine = pairs.holds(grams)
    need = mine.copy()
    need[:-1] |= mine[1:]
    single, pair = np.zeros(len(token)), np.zeros(len(token))
    # Words recur, and common ones have many levels to probe.
    distinct, where = np.unique(token[need], return_inverse=True)
    single[need], pair[mine] = words.counts(distinct)[where], pairs.counts(grams[mine])
    p = log_probabilities(single, pair, np.cumsum(many) - 1, texts, norm, smoothing)
    return np.bincount(place, np.where(mine, p, 0.0), rows)


def scores_in_pass(
    docs: DataFrame, words: CountFilter, pairs: CountFilter, texts: int, norm: float, smoothing: float, text: str = "text",
) -> DataFrame:
    """(__row, score): what the bigrams of one pass add to each row's score."""
    known = docs.sparkSession.sparkContext.broadcast((words, pairs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                p = partial_scores(*word_hashes(data, offsets), rows.num_rows, *known.value, texts, norm, smoothing)
                yield pa.RecordBatch.from_arrays([rows.column(rows.schema.names.index("__row")), pa.array(p)], names=["__row", "score"])

    out = store(docs.select("__row", text).mapInArrow(score, "__row long, score double"), "pass")
    known.destroy()
    return out


def scores_of_passes(parts: list[DataFrame]) -> DataFrame:
    """(__row, score): the passes' scores, met in one shuffle and added in the passes' order.

    Whole copies share their key and their score.
    """
    marked = [part.withColumn("nth", F.lit(nth)) for nth, part in enumerate(parts)]
    by_pass = [F.max(F.when(F.col("nth") == nth, F.col("score"))).alias(f"score_{nth}") for nth in range(len(parts))]
    sums = reduce(DataFrame.union, marked).groupBy("__row").agg(*by_pass)
    return sums.select("__row", reduce(Column.__add__, [F.col(f"score_{nth}") for nth in range(len(parts))]).alias("score"))


def scores_by_segment(
    docs: DataFrame, words: DataFrame, word_shape: Shape, pairs: DataFrame, pair_shape: Shape,
    texts: int, norm: float, smoothing: float, text: str = "text",
) -> DataFrame:
    """(__row, score) of texts, with filters that are too large to broadcast.

    A block of texts (a piece of a batch) asks for each of its n-grams once, with one row
    for each bucket, and gets levels back, a byte each. So a segment is asked for an n-gram
    at most once by each block, however common the n-gram is. What a task holds is one
    segment, and then one block's tokens. The blocks' rows are stored, as two jobs read them.
    """
    shape = (word_shape, pair_shape)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                token, before, place = bigrams(*word_hashes(data, offsets), rows.num_rows)
                sent, index = [], []
                for kind, grams in enumerate((token, pair_hash(before, token))):
                    distinct, where = np.unique(grams, return_inverse=True)
                    index.append(where.astype(np.int32))
                    bucket = (distinct >> np.uint64(64 - shape[kind].prefix)).astype(np.int32)
                    cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
                    sent += [(kind, int(bucket[a]), int(a), distinct[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
                keys = rows.column(rows.schema.names.index("__row")).to_numpy()
                many = np.bincount(place, minlength=rows.num_rows)
                own = (np.concatenate(index), many.astype(np.int64), keys)
                sent += [(OWN, None, i, x.tobytes()) for i, x in enumerate(own)]
                kinds, buckets, at, bits = zip(*sent)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task << 32 | blocks] * len(sent), pa.int64()), pa.array(kinds, pa.int32()),
                        pa.array(buckets, pa.int32()), pa.array(at, pa.int32()), pa.array(bits, pa.binary()),
                    ],
                    names=["block", "kind", "bucket", "at", "bits"],
                )
                blocks += 1

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, table = None, None
        for batch in batches:
            out = []
            for block, kind, bucket, at, bits in zip(*[c.to_pylist() for c in batch.columns]):
                if block is None:
                    now, table = (kind, bucket), CountFilter(np.frombuffer(bits, np.uint8), shape[kind], bucket)
                    continue
                grams = np.frombuffer(bits, np.uint64)
                # Only buckets in which n-grams were learned have a segment.
                found = table.levels(grams) if now == (kind, bucket) else np.zeros(len(grams), np.uint8)
                out.append((block, kind, at, found.tobytes()))
            block, kind, at, bits = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(bits, pa.binary())],
                names=["block", "kind", "at", "bits"],
            )

    def score(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "ascending"), ("at", "ascending")])
        kind, bits = table["kind"].to_numpy(), table["bits"].to_pylist()
        single, pair = (np.frombuffer(b"".join(b for k, b in zip(kind, bits) if k == one), np.uint8) for one in (0, 1))
        index, many, keys = (b for k, b in zip(kind, bits) if k == OWN)
        index, many = np.frombuffer(index, np.int32), np.frombuffer(many, np.int64)
        n = len(index) // 2
        p = log_probabilities(
            word_shape.means[single[index[:n]]], pair_shape.means[pair[index[n:]]], np.cumsum(many) - 1, texts, norm, smoothing)
        return pa.table({"__row": np.frombuffer(keys, np.int64), "score": np.bincount(np.repeat(np.arange(len(many)), many), p, len(many))})

    asked = store(docs.select("__row", text).mapInArrow(ask, "block long, kind int, bucket int, at int, bits binary"), "asked")
    sent = asked.where(F.col("kind") != OWN)
    for one, parts in enumerate((words, pairs)):
        sent = sent.union(parts.select(F.lit(None).cast("long"), F.lit(one), "bucket", F.lit(None).cast("int"), "bits"))
    # A segment comes before what is asked of it.
    sent = sent.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", F.col("block").isNotNull())
    answers = sent.mapInArrow(answer, "block long, kind int, at int, bits binary")
    own = asked.where(F.col("kind") == OWN).select("block", "kind", "at", "bits")
    scores = answers.union(own).groupBy("block").applyInArrow(score, "__row long, score double")
    return scores.groupBy("__row").agg(F.max("score").alias("score"))


def score_documents(
    docs: DataFrame, held_out: str = "held_out", id_col: str = "doc_id", text: str = "text",
    smoothing: float = SMOOTHING, max_bits: int = MAX_BITS, max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Learn from the rows that are not held out and score all rows.

    At most ``max_bits`` bits of each of the two filters are broadcast at once, and the texts
    are read at most ``max_passes`` times for it; beyond, n-grams travel to the filters.
    """
    spark = docs.sparkSession
    docs = docs.select(id_col, text, held_out, F.xxhash64(id_col, text).alias("__row"))
    training = docs.where(~F.col(held_out))
    counts = store(token_counts(training, text), "words")
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    texts = training.count()
    total, vocabulary = words + texts, distinct + (texts > 0)
    pairs = store(bigram_counts(training, text, prefix_for(words, TOKENS_PER_BUCKET)), "pairs")
    singles = counts.select(F.col("token").alias("gram"), "c")
    word_shape, pair_shape = shapes(singles, pairs)
    word_parts, pair_parts = store(segments(singles, word_shape), "segments"), store(segments(pairs, pair_shape), "segments")
    a_pass = max(1, max_bits // pair_shape.segment)
    firsts = range(0, 1 << pair_shape.prefix, a_pass)
    fits = word_shape.bits <= max_bits and len(firsts) <= max_passes
    top = counts.orderBy(F.desc("c"), "token").limit(FREQUENT).toPandas()
    order = np.argsort(top["token"].to_numpy().view(np.uint64))
    known = spark.sparkContext.broadcast((
        top["token"].to_numpy().view(np.uint64)[order], top["c"].to_numpy()[order].astype(np.float64)))
    norm = float(total + vocabulary + 1)
    if fits:
        # No filter is in memory any more when the passes have ended.
        words_filter = gathered(word_parts, word_shape)
        scores = scores_of_passes([
            scores_in_pass(
                docs, words_filter, gathered(pair_parts, pair_shape, first, min(first + a_pass, firsts.stop)),
                texts, norm, smoothing, text)
            for first in firsts
        ])
    else:
        scores = scores_by_segment(docs, word_parts, word_shape, pair_parts, pair_shape, texts, norm, smoothing, text)

    def common(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are among the commonest, and their counts."""
        keys, c = known.value
        if not len(keys):
            return np.zeros(len(h), bool), np.zeros(len(h))
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[at] == h
        return hit, np.where(hit, c[at], 0.0)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                h, row = word_hashes(data, offsets)
                hit, _ = common(h)
                h, row = h[~hit], row[~hit]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, np.int64)
                many = np.diff(np.concatenate([new, [len(h)]]))
                key = rows.column(rows.schema.names.index("__row")).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(key[row[new]]), signed(h[new]), pa.array(many)], names=["__row", "token", "tf"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                n = rows.num_rows
                h, row = word_hashes(data, offsets)
                hit, c = common(h)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(rows.schema.names.index(x)) for x in (id_col, held_out, "__row")],
                        pa.array(np.bincount(row, minlength=n) + 1),
                        pa.array(np.bincount(row[hit], minlength=n) + int(texts > 0)),
                        pa.array(np.bincount(row[hit], np.log10(c[hit] + 1), n) + np.log10(texts + 1)),
                    ],
                    names=[id_col, held_out, "__row", "n_tokens", "n_common", "log_common"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    heads = docs.mapInArrow(score, f"`{id_col}` {kind}, `{held_out}` boolean, __row long, n_tokens long, n_common long, log_common double").join(scores, "__row")
    looked_up = docs.select("__row", text).mapInArrow(rare, "__row long, token long, tf long").join(counts, "token")
    rest = looked_up.groupBy("__row").agg(
        F.sum("tf").alias("n_rare"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("log_rare"))
    # Rows that are whole copies share their key: each takes its part of the sum.
    rest = rest.join(docs.groupBy("__row").agg(F.count(F.lit(1)).alias("__copies")), "__row")
    part = lambda c, zero: F.coalesce(F.col(c) / F.col("__copies"), F.lit(zero))
    return heads.join(rest, "__row", "left").select(
        id_col, held_out, "n_tokens",
        (F.col("n_common") + part("n_rare", 0).cast("long")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_common") + part("log_rare", 0.0) - F.col("n_tokens") * F.log10(F.lit(norm))).alias("base_score"),
        "score",
    )


def op7_count_filter_scores(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; those with a checksum remainder of 2 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return score_documents(docs.withColumn("held_out", out))
