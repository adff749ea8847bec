"""Repeated byte strings, by a depth-limited radix sort of suffixes.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts in a document
with a smaller id. Suffixes matter only down to that depth, and only whether they share
a group with a smaller document, so the most significant digits are handled as follows.

* First digit: the window of each suffix is known by its anchor, the ``GRAM``-byte gram
  with the least hash in it (leftmost if tied). Neighbouring suffixes share their anchor,
  so one row stands for a run of about sixteen suffixes; equal windows have equal anchors.
* Second digit: the bytes that a run spans. Runs with the same gram and span are equal to
  full depth at once; all but those of the smallest document are repeated.
* Third digit: where runs share the gram but not the span, a few hashed bits of the bytes
  that all suffixes of the run's right (or left) half share. Grams that two documents
  share by chance differ here.
* Last digit: half runs that still share a group (the edges of a passage), and only these,
  are sorted suffix by suffix to full depth.

Groups of a digit are formed in each task first, and a task sends one row per group, so
that a passage in a third of all documents does not pile up in one place.

Null texts are empty. Rows that share an id are compared with smaller ids only; their
texts, however many, are told apart by a 64-bit hash. Rows without an id count as larger
than all others. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import store
from marketloom.llm.textnum import BASE, BASE_2, buffers, mix, pieces, powers, signed, span_hashes

LENGTH = 50
GRAM = 20
PIECE_BYTES = 1 << 20
CHUNK = 500_000  # runs that a task groups at once; each takes some 250 bytes while they are sorted
HALF = 15  # suffixes that start at most so many bytes before the anchor are the right half
SENT = 16  # runs of one gram that a task sends before it asks for full depth itself
HIT, REQUEST, GROUP, MANY = 0, 1, 2, 3
TWINS = 1  # kind of a hit that holds for all equal suffixes of its document
NO_ID = (1 << 63) - 1


def packed(start: np.ndarray, count: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Place of a run in one number: first suffix, bytes from there to the anchor, suffixes,
    and two bits for the kind."""
    return (start << 13) | (ahead << 8) | (count << 2)


def unpacked(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First suffix, suffixes and bytes to the anchor."""
    return places >> 13, (places >> 2) & 63, (places >> 8) & 31


def halves(places: np.ndarray, right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places cut to the wanted halves of their runs."""
    start, count, ahead = unpacked(places)
    beyond = np.clip(ahead - HALF, 0, count)  # suffixes of the left half
    skip = np.where(left, 0, beyond)
    count = np.where(right, count, beyond) - skip
    return packed(start + skip, count, np.maximum(ahead - skip, 0)) | REQUEST


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor: gram hash, span hash, row, first suffix,
    suffixes, bytes to the anchor. The low bits of the span hash are twelve bits for the
    right half and twelve for the left (0 where a half has no suffix)."""
    n, last = len(data), len(data) - LENGTH + 1
    if last <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    up, down = powers(n + 1, BASE)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    least = (h & np.uint64(2**64 - 2**30)) | np.arange(len(h), dtype=np.uint64)
    width, grams = 1, LENGTH - GRAM + 1
    while width < grams:
        step = min(width, grams - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    bad = np.zeros(n + 1, np.int32)
    inner = offsets[1:-1]
    np.add.at(bad, np.maximum(inner - LENGTH + 1, 0), 1)
    np.add.at(bad, inner, -1)
    at = np.flatnonzero(np.cumsum(bad[:last]) == 0)
    if not len(at):
        return runs(data[:0], offsets[:1])
    anchor = (least[at] & np.uint64(2**30 - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    first, count = at[new], np.diff(np.concatenate([new, [len(at)]]))
    row = np.searchsorted(offsets, first, side="right") - 1
    span = span_hashes(data, first, first + count - 1 + LENGTH, BASE_2) & np.uint64(2**64 - 2**24)
    anchor = anchor[new]
    ahead = anchor - first
    has_right, has_left = ahead - count < HALF, ahead > HALF
    for has, start, length, shift in (
        (has_right, anchor, LENGTH - HALF, 12), (has_left, anchor - HALF - 1, GRAM + HALF + 1, 0)):
        start = np.where(has, start, 0)
        half = span_hashes(data, start, np.where(has, start + length, 0), BASE) % np.uint64(4095) + np.uint64(1)
        span |= np.where(has, half, np.uint64(0)) << np.uint64(shift)
    return mix(h[anchor]), span, row, first - offsets[row], count, ahead


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before in any column."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def _spread(new: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value at the start of each row's group."""
    return values[np.flatnonzero(new)][np.cumsum(new) - 1]


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and second digit inside a task: (digit, span, doc, variant, place with its kind)."""
    held: list[tuple[np.ndarray, ...]] = []

    def grouped() -> pa.RecordBatch:
        gram, span, doc, variant, place = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, span, gram))
        gram, span, doc, variant, place = gram[order], span[order], doc[order], variant[order], place[order]
        hit = doc > _spread(_changes(gram, span), doc)
        new_gram = _changes(gram)
        group = np.cumsum(new_gram) - 1
        many = (np.bincount(group, ~hit) > SENT)[group] & ~hit
        kind = np.where(hit, HIT, np.where(many, REQUEST, GROUP))
        # Hits and requests are final here; they travel to anywhere.
        digit = np.where(kind == GROUP, gram, mix(place.view(np.uint64) ^ mix(doc.view(np.uint64))))
        marks = np.flatnonzero(many)
        marks = marks[_changes(gram[marks])] if len(marks) else marks
        return pa.RecordBatch.from_arrays(
            [
                signed(np.concatenate([digit, gram[marks]])),
                signed(np.concatenate([span, np.zeros(len(marks), np.uint64)])),
                pa.array(np.concatenate([doc, doc[marks]])),
                pa.array(np.concatenate([variant, np.zeros(len(marks), np.int64)])),
                pa.array(np.concatenate([place | kind, np.full(len(marks), MANY)])),
            ],
            names=["digit", "span", "doc", "variant", "place"],
        )

    size = 0
    for batch in batches:
        for rows, data, offsets in pieces(batch, "text", PIECE_BYTES):
            gram, span, row, start, count, ahead = runs(data, offsets)
            doc = rows.column(rows.schema.names.index("doc")).to_numpy()[row]
            variant = rows.column(rows.schema.names.index("variant")).to_numpy()[row]
            held.append((gram, span, doc, variant, packed(start, count, ahead)))
            size += len(gram)
            if size > CHUNK:
                yield grouped()
                held, size = [], 0
    if size:
        yield grouped()


def _complete(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that no group of equal keys is divided."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        change = np.flatnonzero(_changes(*[held[k].to_numpy() for k in keys]))
        if change[-1] > 0:
            yield held.slice(0, int(change[-1]))
            held = held.slice(int(change[-1]))
    if held is not None and held.num_rows:
        yield held


def _shared(group: np.ndarray, half: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows whose half (not 0) occurs in several spans of the group."""
    key = (group.astype(np.int64) << 12) | half.astype(np.int64)
    found, inverse = np.unique(key, return_inverse=True)
    return (np.bincount(inverse, first, len(found)) > 1)[inverse] & (half != 0)


def _places(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(x)) for x in zip(*found)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc", "variant", "place"])


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join what tasks sent of a gram: hits of larger documents, requests where spans differ."""
    for table in _complete((b for b in batches if b.num_rows), ["digit"]):
        digit, span, doc, variant, place = (table[c].to_numpy() for c in ("digit", "span", "doc", "variant", "place"))
        kind = place & 3
        final = kind < GROUP
        out = [(doc[final], variant[final], place[final])]
        mine = ~final
        digit, span, doc, variant, place, mark = (x[mine] for x in (digit, span, doc, variant, place, kind == MANY))
        if len(digit):
            new = _changes(digit, span, mark)
            group = np.cumsum(_changes(digit)) - 1
            all_of_it = (np.bincount(group, mark) > 0)[group]
            hit = ~mark & (doc > _spread(new, doc))
            rest = ~mark & ~hit
            several = [all_of_it | _shared(group, (span.view(np.uint64) >> np.uint64(shift)) % np.uint64(4096), new & ~mark) for shift in (12, 0)]
            ask = rest & (several[0] | several[1])
            asked = halves(place[ask], several[0][ask], several[1][ask])
            out += [(doc[hit], variant[hit], (place[hit] & ~3) | HIT), (doc[ask], variant[ask], asked)]
        yield _places(out)


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last digit inside a task: all suffixes of the requested runs, to full depth."""
    held: list[tuple[np.ndarray, ...]] = []

    def grouped() -> pa.RecordBatch:
        a, b, doc, variant, place = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((variant, doc, b, a))
        a, b, doc, variant, place = a[order], b[order], doc[order], variant[order], place[order]
        hit = doc > _spread(_changes(a, b), doc)
        # Of equal suffixes of one text the first is sent, and stands for its twins.
        first = _changes(a, b, doc, variant)
        twins = (np.bincount(np.cumsum(first) - 1) > 1)[np.cumsum(first) - 1] & ~hit
        keep = first | hit
        place = place | (twins.astype(np.int64) << 8)
        a, b, doc, variant, hit, place = (x[keep] for x in (a, b, doc, variant, hit, place))
        # Hits are final here; they travel to anywhere.
        a = np.where(hit, place.view(np.uint64) >> np.uint64(13) & np.uint64(1023), a)
        place = place | np.where(hit, HIT, GROUP)
        return pa.RecordBatch.from_arrays(
            [signed(a), pa.array(np.where(hit, 0, b).astype(np.int32)), pa.array(doc), pa.array(variant), pa.array(place)],
            names=["a", "b", "doc", "variant", "place"])

    size = 0
    for batch in batches:
        data, offsets = buffers(batch.column(batch.schema.names.index("text")))
        for i, (doc, variant, wanted) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4)), batch.column(1))):
            places = np.sort(wanted.values.to_numpy())
            start, count, _ = unpacked(places)
            at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
            text = data[offsets[i] : offsets[i + 1]]
            ends = at + LENGTH
            held.append((
                span_hashes(text, at, ends, BASE), span_hashes(text, at, ends, BASE_2) >> np.uint64(33),
                np.full(len(at), doc, np.int64), np.full(len(at), variant, np.int64),
                packed(at, np.ones(len(at), np.int64), np.zeros(len(at), np.int64))))
            size += len(at)
            if size > CHUNK:
                yield grouped()
                held, size = [], 0
    if size:
        yield grouped()


def _joined_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _complete((b for b in batches if b.num_rows), ["a", "b"]):
        a, b, doc, variant, place = (table[c].to_numpy() for c in ("a", "b", "doc", "variant", "place"))
        final = (place & 3) == HIT
        out = [(doc[final], variant[final], place[final])]
        a, b, doc, variant, place = (x[~final] for x in (a, b, doc, variant, place))
        if len(a):
            hit = doc > _spread(_changes(a, b), doc)
            twins = (place[hit] >> 8) & 1
            out.append((doc[hit], variant[hit], (place[hit] & ~0x103) | (twins * TWINS)))
        yield _places(out)


def _orders(docs: DataFrame) -> Column:
    """Ids as numbers that order the documents, with room for ``NO_ID`` above all of them."""
    doc = F.col("doc_id")
    last, missing = docs.agg(F.max("doc_id"), F.max(F.col("doc_id").isNull())).first()
    if last == NO_ID and missing:
        # Ids above one that is free move down by one.
        draws = Random(0)
        free = NO_ID
        while docs.where(doc == free).limit(1).count():
            free = draws.randrange(-NO_ID, NO_ID)
        doc = F.when(doc > free, doc - 1).otherwise(doc)
    return F.coalesce(doc, F.lit(NO_ID))


def _variants(docs: DataFrame) -> DataFrame:
    """Columns doc_id, ``text``, ``doc`` (its order) and ``variant``, which tells texts of a
    repeated id apart."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("doc", _orders(docs))
    digest = F.xxhash64("text")
    several = docs.groupBy("doc").agg(F.min(digest).alias("x"), F.max(digest).alias("y")).where("x <> y")
    several = several.select(F.col("doc").alias("__doc"), F.lit(True).alias("several"))
    if not several.limit(1).count():
        return docs.withColumn("variant", F.lit(0).cast("long"))
    told = docs.join(several, docs["doc"] == several["__doc"], "left")
    return told.select("doc_id", "text", "doc", F.when(F.col("several"), digest).otherwise(F.lit(0)).alias("variant"))


def _with_places(docs: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Each text with the list of its places."""
    lists = places.groupBy("doc", "variant").agg(F.collect_list("place").alias("places"))
    return docs.join(lists, ["doc", "variant"], how).select("doc_id", "places", "text", "doc", "variant")


def _cut(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(2))
        removed, spans, digest, kept = [], [], [], []
        for i, places in enumerate(batch.column(1)):
            text = data[offsets[i] : offsets[i + 1]]
            gone = np.zeros(len(text), bool)
            if places.is_valid:
                places = places.values.to_numpy()
                start, count, _ = unpacked(places)
                twins = start[(places & 3) == TWINS]
                if len(twins):
                    every = np.arange(len(text) - LENGTH + 1)
                    h = span_hashes(text, every, every + LENGTH, BASE)
                    more = every[np.isin(h, h[twins])]
                    start, count = np.append(start, more), np.append(count, np.ones(len(more), np.int64))
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + count - 1 + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
            rest = text[~gone].tobytes()
            removed.append(int(gone.sum()))
            spans.append(int((gone[1:] & ~gone[:-1]).sum() + (len(gone) > 0 and gone[0])))
            digest.append(hashlib.sha256(rest).hexdigest())
            if texts:
                kept.append(rest)
        columns = {
            "doc_id": batch.column(0), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns | ({"kept": pa.array(kept, pa.binary())} if texts else {}))


def without_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """Per row (doc_id, text): counts, the digest of the remaining bytes, and with ``texts``
    these themselves."""
    kept = ", kept binary" if texts else ""
    rows = _variants(docs)
    sent = rows.select("doc", "variant", "text").mapInArrow(_sorted_runs, "digit long, span long, doc long, variant long, place long")
    dealt = sent.repartition("digit").sortWithinPartitions("digit", "span", "doc")
    found = store(dealt.mapInArrow(_joined_runs, "doc long, variant long, place long"), "runs")
    kind = F.col("place").bitwiseAND(3)
    asked = _with_places(rows, found.where(kind == REQUEST), "inner")
    windows = asked.mapInArrow(_sorted_windows, "a long, b int, doc long, variant long, place long")
    windows = windows.repartition("a").sortWithinPartitions("a", "b", "doc")
    more = store(windows.mapInArrow(_joined_windows, "doc long, variant long, place long"), "windows")
    hits = found.where(kind == HIT).union(more)
    return _with_places(rows, hits, "left").mapInArrow(
        lambda batches: _cut(batches, texts), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string{kept}")


def op5_radix_sorted_suffixes(spark, sf_dir: str) -> DataFrame:
    """What remains of every document without strings that smaller documents have."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs, texts=False)
