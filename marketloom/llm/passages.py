"""Repeated passages, by Rabin-Karp hashes of every window of words.

A word goes when it lies in a window of ``LENGTH`` words that also starts in a document
with a smaller id.

* A task hashes every window of its texts, some millions at a time (a chunk). Windows that
  a chunk holds twice are settled there, so a passage in a third of all documents leaves
  each chunk once.
* The others are dealt by ranges of the hash, eight bytes of hash and three of place each,
  and every range is counted: a window is repeated where a smaller document has its hash.
* The places go back to their chunks, where neighbouring windows merge into maximal runs,
  and the runs to the texts, found by id and a hash of the text.

Null texts are empty. Words are compared as they are, windows by 64-bit hashes. Rows that
share an id are compared with smaller ids only, whatever their texts; exact copies under
one id have equal results. Rows without an id count as larger than all others and not as
larger than each other. Ties cannot arise. Empty tables give no rows; other columns are
left out. A very long text is hashed in pieces and may spread over several chunks; a task
then holds its bytes, its word ends and the hashes of one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import blocks_for, store
from marketloom.llm.textnum import BASE, mix, pieces, powers, span_hashes, words

LENGTH = 13
PIECE_BYTES = 1 << 20
CHUNK = 2_000_000  # windows; a chunk has less than twice as many, and a place fits three bytes
PART_BYTES = 16 << 20  # text whose windows are counted in one range of the hash
LOCAL, SENT = 0, 1
PACKED = (
    "part long, kind int, chunk long, hashes binary, places binary, starts binary, ids binary, nulls int,"
    " digests binary, firsts binary, twins binary"
)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, a piece of the text at a time."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        a = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, a + PIECE_BYTES, side="right")))
        b = int(ends[last - 1])
        if b - a > PIECE_BYTES:  # one word longer than a piece
            out[first] = int.from_bytes(hashlib.blake2b(data[a:b], digest_size=8).digest(), "little")
        else:
            out[first:last] = span_hashes(data[a:b], starts[first:last] - a, ends[first:last] - a)
        first = last
    return out


def window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash of every ``length`` consecutive words, from prefix sums."""
    n = len(codes)
    if n < length:
        return np.zeros(0, np.uint64)
    out = np.empty(n - length + 1, np.uint64)
    for a in range(0, len(out), PIECE_BYTES):
        piece = codes[a : a + PIECE_BYTES + length - 1]
        up, down = powers(len(piece) + 1, BASE)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * up[: len(piece)], out=sums[1:])
        out[a : a + PIECE_BYTES] = mix((sums[length:] - sums[:-length]) * down[: len(piece) - length + 1])
    return out


def _changes(x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def _three_bytes(places: np.ndarray) -> bytes:
    return np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _from_three_bytes(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
    return wide.view("<u4").reshape(-1).astype(np.int64)


class _Chunk:
    """Windows of some texts: (id or None, digest, first window, hashes) each."""

    def __init__(self) -> None:
        self.texts: list[tuple[int | None, int, int, np.ndarray]] = []
        self.seen: set[tuple[int | None, int, int]] = set()
        self.size = 0

    def add(self, doc: int | None, digest: int, first: int, hashes: np.ndarray) -> None:
        """Take a piece of a text, unless the chunk has it."""
        if (doc, digest, first) not in self.seen:
            self.seen.add((doc, digest, first))
            self.texts.append((doc, digest, first, hashes.copy()))
            self.size += len(hashes)

    def rows(self, chunk: int, parts: int) -> Iterator[dict]:
        """One row for each range of the hash that the chunk has, and one that stays."""
        texts = sorted(self.texts, key=lambda t: (t[0] is None, t[0] or 0))
        ids = np.array([t[0] or 0 for t in texts], np.int64)
        null = np.array([t[0] is None for t in texts])
        counts = np.array([len(t[3]) for t in texts])
        starts = np.cumsum(counts) - counts
        hashes = np.concatenate([t[3] for t in texts])
        rank = np.cumsum(_changes(ids) | _changes(null)).astype(np.int32)
        place = np.argsort(hashes, kind="stable")
        hashes, text = hashes[place], np.repeat(np.arange(len(texts), dtype=np.int32), counts)[place]
        rank = rank[text]
        new = _changes(hashes)
        heads = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        hit = rank > rank[heads][group]
        # Of equal windows of the smallest document one is sent for all.
        twin = ~hit & ~new
        bits = np.zeros(len(place), bool)
        bits[place[hit]] = True
        twins = np.stack([place[heads][group[twin]], place[twin]]).astype("<i4")
        yield {
            "part": chunk % parts, "kind": LOCAL, "chunk": chunk, "hashes": np.packbits(bits).tobytes(),
            "ids": ids.tobytes(), "nulls": int(null.sum()), "starts": np.append(starts, len(bits)).astype("<i8").tobytes(),
            "digests": np.array([t[1] for t in texts], np.int64).tobytes(),
            "firsts": np.array([t[2] for t in texts], np.int64).tobytes(), "twins": twins.tobytes(),
        }
        hashes, place, text = hashes[heads], place[heads], text[heads]
        edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
        cuts = [0, *np.searchsorted(hashes, edges).tolist(), len(hashes)]
        for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a == b:
                continue
            mine = np.flatnonzero(np.bincount(text[a:b], minlength=len(texts)))
            yield {
                "part": part, "kind": SENT, "chunk": chunk, "hashes": hashes[a:b].tobytes(),
                "places": _three_bytes(place[a:b]), "starts": starts[mine].astype("<i4").tobytes(),
                "ids": ids[mine].tobytes(), "nulls": int(null[mine].sum()),
            }


def _hashed(length: int, parts: int, size: int):
    """Texts of a task to the windows of its chunks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("part", pa.int64()), ("kind", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("places", pa.binary()),
            ("starts", pa.binary()), ("ids", pa.binary()), ("nulls", pa.int32()), ("digests", pa.binary()),
            ("firsts", pa.binary()), ("twins", pa.binary()),
        ])
        number = TaskContext.get().partitionId() << 24
        chunk = _Chunk()

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal chunk, number
            for row in chunk.rows(number, parts):
                yield pa.RecordBatch.from_pylist([row], schema=schema)
            chunk, number = _Chunk(), number + 1

        for batch in batches:
            for rows, data, offsets in pieces(batch, "text", PIECE_BYTES):
                starts, ends, row = words(data, offsets)
                hashes = window_hashes(word_hashes(data, starts, ends), length)
                first = np.searchsorted(row, np.arange(len(offsets)))
                docs, digests = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                for i, (a, b) in enumerate(zip(first, first[1:])):
                    own = hashes[a : max(a, b - length + 1)]
                    for at in range(0, len(own), size):
                        chunk.add(docs[i], digests[i], at, own[at : at + size])
                        if chunk.size >= size:
                            yield from full()
        if chunk.size:
            yield from full()

    return pack


def _runs_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Sorted rows, as lists of rows with one key."""
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


_FOUND = pa.schema([
    ("kind", pa.int32()), ("chunk", pa.int64()), ("places", pa.binary()), ("hits", pa.binary()), ("starts", pa.binary()),
    ("ids", pa.binary()), ("nulls", pa.int32()), ("digests", pa.binary()), ("firsts", pa.binary()), ("twins", pa.binary()),
])
FOUND = (
    "kind int, chunk long, places binary, hits binary, starts binary, ids binary, nulls int, digests binary,"
    " firsts binary, twins binary"
)


def repeated(hashes: np.ndarray, ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Which of the windows a smaller document has, too."""
    order = np.argsort(hashes, kind="stable")
    new = _changes(hashes[order])
    heads, group = np.flatnonzero(new), np.cumsum(new) - 1
    value = ids.view(np.uint64) ^ np.uint64(1 << 63)  # in the order of the ids
    value = np.where(null, np.uint64(2**64 - 1), value)[order]
    least = np.minimum.reduceat(value, heads)[group]
    known = np.logical_or.reduceat(~null[order], heads)[group]
    out = np.empty(len(hashes), bool)
    out[order] = np.where(null[order], known, value > least)
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of the hash to the places of repeated windows; other rows pass."""
    for rows in _runs_of(batches, "part"):
        out = [
            {"kind": LOCAL, "chunk": r["chunk"], "hits": r["hashes"]}
            | {k: r[k] for k in ("starts", "ids", "nulls", "digests", "firsts", "twins")}
            for r in rows if r["kind"] == LOCAL
        ]
        rows = [r for r in rows if r["kind"] == SENT]
        places, ids, null = [], [], []
        for r in rows:
            place, start = _from_three_bytes(r["places"]), np.frombuffer(r["starts"], "<i4")
            at = np.searchsorted(start, place, side="right") - 1
            places.append(place)
            ids.append(np.frombuffer(r["ids"], np.int64)[at])
            null.append(at >= len(start) - r["nulls"])
        if rows:
            hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
            hit = repeated(hashes, np.concatenate(ids), np.concatenate(null))
            ends = np.cumsum([len(p) for p in places])
            for r, place, a, b in zip(rows, places, [0, *ends], ends):
                if hit[a:b].any():
                    out.append({"kind": SENT, "chunk": r["chunk"], "places": _three_bytes(place[hit[a:b]])})
        for row in out:
            yield pa.RecordBatch.from_pylist([row], schema=_FOUND)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a chunk to maximal runs of windows: (doc, digest, runs) for each text."""
    for rows in _runs_of(batches, "chunk"):
        own = rows[0]
        starts = np.frombuffer(own["starts"], "<i8")
        hit = np.unpackbits(np.frombuffer(own["hits"], np.uint8), count=int(starts[-1])).astype(bool)
        for r in rows[1:]:
            hit[_from_three_bytes(r["places"])] = True
        first, other = np.frombuffer(own["twins"], "<i4").reshape(2, -1)
        hit[other] = hit[first]
        new = hit.copy()
        new[1:] &= ~hit[:-1]
        new[starts[:-1]] = hit[starts[:-1]]
        last = hit.copy()
        last[:-1] &= ~hit[1:]
        last[starts[1:] - 1] = hit[starts[1:] - 1]
        begin, end = np.flatnonzero(new), np.flatnonzero(last) + 1
        text = np.searchsorted(starts, begin, side="right") - 1
        shift = (np.frombuffer(own["firsts"], np.int64) - starts[:-1])[text]
        pairs = np.stack([begin + shift, end + shift], axis=1)
        ids, digests = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["digests"], np.int64)
        found = np.unique(text)
        cuts = np.searchsorted(text, [*found, len(starts)])
        yield pa.RecordBatch.from_pydict({
            "doc": pa.array([None if t >= len(ids) - own["nulls"] else int(ids[t]) for t in found], pa.int64()),
            "digest": pa.array(digests[found], pa.int64()),
            "runs": pa.array([pairs[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        })


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                rows = batch.slice(a, 512)
                total, removed, kept = [], [], []
                for text, lists in zip(rows.column(1), rows.column(2)):
                    # These blanks are just the ASCII blanks of bytes.split().
                    found = text.as_buffer().to_pybytes().split() if text.is_valid else []
                    total.append(len(found))
                    gone = 0
                    if lists.is_valid:
                        edge = np.zeros(len(found) + 1, np.int64)
                        for runs in lists.values:
                            pairs = np.frombuffer(runs.as_buffer(), np.int64).reshape(-1, 2)
                            np.add.at(edge, pairs[:, 0], 1)
                            np.add.at(edge, pairs[:, 1] + length - 1, -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        gone = len(found) - int(stay.sum())
                        found = compress(found, stay.tolist())
                    removed.append(gone)
                    kept.append(b" ".join(found))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return cut


def without_repeated_passages(
    docs: DataFrame, length: int = LENGTH, chunk: int = CHUNK, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Per row of (doc_id, text): numbers of words and of removed words, and the words that
    stay, joined by one space. ``chunk`` (windows) and ``part_bytes`` bound a task's memory."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = texts.withColumn("digest", F.xxhash64("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = blocks_for(size, part_bytes)
    sent = keyed.select("doc_id", "digest", "text").mapInArrow(_hashed(length, parts, chunk), PACKED)
    dealt = sent.repartition(parts, "part").sortWithinPartitions("part", "kind")
    found = store(dealt.mapInArrow(_counted, FOUND), "windows")
    chunks = found.repartition("chunk").sortWithinPartitions("chunk", "kind")
    runs = chunks.mapInArrow(_merged, "doc long, digest long, runs binary")
    # Copies of a text under one id have the same runs; only pieces of a text differ.
    runs = runs.groupBy("doc", F.col("digest").alias("__digest")).agg(F.collect_set("runs").alias("runs"))
    same = keyed["doc_id"].eqNullSafe(runs["doc"]) & (keyed["digest"] == runs["__digest"])
    joined = keyed.join(runs, same, "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_cut(length), "doc_id long, n_words long, n_removed long, kept string")


def op13_rabin_karp_windows(spark, sf_dir: str) -> DataFrame:
    """What remains of every document without passages that smaller documents have."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = without_repeated_passages(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
