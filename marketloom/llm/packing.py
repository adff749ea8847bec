"""Best-fit packing by minimum bin slack.

Documents are tokenised in parallel; of the pieces only their lengths matter for the plan.
Lengths are whole numbers up to the capacity, so a histogram of at most ``capacity``
numbers describes any corpus. The plan is made from it on the driver: for each kind of
bin, a bitset subset-sum program over the available lengths finds the fullest feasible
combination around the longest piece left; the combination is taken out as often as the
counts allow, which makes the plan's size independent of the number of documents. Pieces
are then numbered within their length and looked up in the plan.

Null and empty texts are one end token. Repeated rows are packed as rows of their own;
whole copies may swap places. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import blocks_for, numbered, store, uniform_hash

CAPACITY = 1024
END = 2
ROWS_PER_BLOCK = 5_000
PIECE = "piece int, start long, length long, ids_crc32 long"


def fullest(lengths: list[tuple[int, int]], capacity: int) -> dict[int, int]:
    """Lengths (longest first, with counts) whose sum comes closest to the capacity.

    The longest length is always part of it. Bit ``i`` of ``reach`` tells that a sum of
    ``i`` can be made; counts are split into powers of two, so that few steps cover them.
    """
    longest = lengths[0][0]
    room = capacity - longest
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length, count in lengths:
        count = min(count - (length == longest), room // length)
        part = 1
        while count > 0 and not reach >> room & 1:
            many = min(part, count)
            steps.append((reach, length, many))
            reach |= (reach << length * many) & mask
            count -= many
            part *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = {longest: 1}
    for before, length, many in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + many
            at -= length * many
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many bins are filled with each."""
    left, plan = dict(counts), []
    while left := {length: n for length, n in left.items() if n > 0}:
        chosen = fullest(sorted(left.items(), reverse=True), capacity)
        times = min(left[length] // many for length, many in chosen.items())
        plan.append((chosen, times))
        for length, many in chosen.items():
            left[length] -= many * times
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, behind the last rank, many per bin, first bin, offset)."""
    used: dict[int, int] = {}
    rows, bin_no = [], 0
    for chosen, times in plan:
        offset = 0
        for length, many in chosen.items():
            first = used.get(length, 0)
            rows.append((length, first, first + many * times, many, bin_no, offset))
            used[length] = first + many * times
            offset += length * many
        bin_no += times
    return rows


class Encoder:
    """Token ids of a public byte-level vocabulary.

    The fast encoder takes the same ranks and gives the same ids; texts that hold a
    special token's string go to the other library, which gives it its own id.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            ids = []
        elif any(s in text for s in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array([*ids, END], dtype="<u4")


def token_pieces(docs: DataFrame, vocabulary: str, ranks: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Cut every document's ids into pieces; only the first may be shorter than the rest.

    Returns the other columns of ``docs`` for each piece, with its number, place in the
    document, length and checksum.
    """
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [PIECE])
    names = [f.name for f in kept]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary, ranks)
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, value in enumerate(batch.column(batch.schema.names.index(text))):
                ids = encode(value.as_py())
                many = -(-len(ids) // capacity)
                first = len(ids) - capacity * (many - 1)
                for k in range(many):
                    a = 0 if k == 0 else first + capacity * (k - 1)
                    b = first + capacity * k
                    row.append(i)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            taken = [batch.column(batch.schema.names.index(n)).take(pa.array(row, pa.int64())) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*taken, pa.array(number, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                names=[*names, "piece", "start", "length", "ids_crc32"],
            )

    return docs.mapInArrow(cut, schema)


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY, seed: int = 4) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens."""
    spark = pieces.sparkSession
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = places(minimum_bin_slack(counts, capacity))
    table = spark.createDataFrame(plan, "of long, first long, behind long, many long, bin long, at long")
    blocks = blocks_for(sum(counts.values()), ROWS_PER_BLOCK)
    block = F.pmod(uniform_hash(seed, *keys), F.lit(blocks)).cast("int")
    ranked = numbered(pieces, ["length"], [F.col(k) for k in keys], block, "__rank")
    here = (F.col("length") == F.col("of")) & (F.col("__rank") >= F.col("first")) & (F.col("__rank") < F.col("behind"))
    nth = F.col("__rank") - F.col("first")
    # The table has a few rows for each length, whatever the number of documents.
    return ranked.join(F.broadcast(table), here).select(
        *pieces.columns,
        (F.col("bin") + F.floor(nth / F.col("many"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("many")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Tokenise, cut and pack; ``keys`` name documents in the result."""
    import public_tokenizers as P

    slim = docs.select(*keys, text)
    pieces = store(token_pieces(slim, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), text), "pieces")
    return pack(pieces, [*keys, "piece", "ids_crc32", "start"])


def op4_minimum_bin_slack(spark, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 1024 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: where the pieces of the mix's documents go."""
    return pack_documents(docs)
