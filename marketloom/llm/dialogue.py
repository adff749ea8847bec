"""Repair of conversations, by alignment to the alternating grammar ``(s?(ua)+)?``.

A turn is known to the alignment by the first character of its role and by its fault. The
turns of a conversation are aligned to the target strings of each feasible length: the
empty one, ``(ua)+`` and ``s(ua)+``. Targets with the same beginning are prefixes of each
other, so one Wagner-Fischer table holds the costs for all their lengths. The cost of a
plain repair, from left to right, is the incumbent: cells beyond the band that it leaves
are not filled (Ukkonen), and the first table's best cost narrows the second one's band. The
audits of all cheapest alignments are traced back and the ASCII-least is taken.

A conversation whose band would fill more than ``CELLS`` cells, some thousands of turns
with many faults, is aligned to the period of the grammar instead: the target matters only
by its last character, so four states replace the band, with the same result. Tests hold
both ways against each other and against all edits.

Turns are sorted by Spark and read as a stream, first without their texts (a character and
a fault each), then again to write the repaired turns, so that a task holds one batch of
turns and, of its current conversation, a few bytes a turn.

Null ids, roles and texts are one space where they are read; rows without an id form one
conversation. Turns without a number come first; rows with one number follow each other by
role, then by text, and exact copies are duplicates. A conversation without turns has
zeros, an empty audit and the hash of the empty string. Roles count by their first
character, whatever it is; an empty one has none. Texts may be long: only their last
character, blankness and equality (128 hashed bits) matter for the repair. Empty tables
give no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import store, uniform_hash

DELETE, INSERT, REROLE, OPEN_END = 3, 2, 2, 1  # costs; an undeleted truncated turn adds the last
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # first fault of a turn
DROPPED = (BLANK, DUPLICATE)  # faults whose turns have to go
CELLS = 4_000_000
FAR = 1 << 40
LEGAL = frozenset(("su", "ua", "au"))
NO_ROLE = "\0"
TRIMMED = "rtrim(' \\t\\n\\u000b\\f\\r', text)"


def plain_cost(roles: str, faults: bytes) -> int:
    """Cost of a repair that keeps or rerolls all turns that may stay, or of deleting all."""
    cost, placed, system = 0, 0, False
    for role, fault in zip(roles, faults):
        if fault in DROPPED:
            cost += DELETE
            continue
        cost += OPEN_END if fault == TRUNCATED else 0
        if role == "s" and not placed and not system:
            system = True
            continue
        cost += 0 if role == "ua"[placed % 2] else REROLE
        placed += 1
    if placed % 2:
        cost += INSERT
    elif system and not placed:
        cost += 2 * INSERT
    return min(cost, DELETE * len(roles))


class Table:
    """Costs of turning the first i turns into the first j characters of a target, for the
    columns that a repair of at most ``most`` can reach."""

    def __init__(self, roles: str, faults: bytes, first: str, most: int):
        self.roles, self.faults, self.most = roles, faults, most
        free = np.concatenate([[0], np.cumsum([f not in DROPPED for f in faults])]).astype(int)
        slack = most - DELETE * (len(roles) - int(free[-1]))
        self.low = np.maximum(free - slack // DELETE, 0).tolist()
        self.width = slack // DELETE + slack // INSERT + 1
        size = self.low[-1] + self.width
        self.text = (first + "ua" * size if first == "s" else "ua" * size)[:size]
        self.codes = np.array([-1, *map(ord, self.text)])  # the character that ends column j
        self.rows: list[np.ndarray] = []

    def cells(self) -> int:
        return len(self.low) * self.width

    def fill(self) -> Table:
        step = np.arange(self.width) * INSERT
        row = np.full(self.width, FAR)
        row[0] = 0
        self._insert(row, 0, step)
        for i, (role, fault) in enumerate(zip(self.roles, self.faults)):
            a, b = self.low[i], self.low[i + 1]
            above = np.concatenate([[FAR], row, [FAR]])
            row = above[1 + b - a : 1 + b - a + self.width] + DELETE
            if fault not in DROPPED:
                more = OPEN_END if fault == TRUNCATED else 0
                codes = self.codes[b : b + self.width]
                take = np.where(codes == ord(role), more, np.where((codes == ord("s")) | (codes < 0), FAR, REROLE + more))
                row = np.minimum(row, above[b - a : b - a + self.width] + take)
            self._insert(row, b, step)
        return self

    def _insert(self, row: np.ndarray, low: int, step: np.ndarray) -> None:
        """Extend a row by insertions, prune it and keep it; a system turn is not inserted."""
        at = 1 if low == 0 and self.text[:1] == "s" else 0
        row[at:] = np.minimum.accumulate(row[at:] - step[at:]) + step[at:]
        row[row > self.most] = FAR
        self.rows.append(row)

    def cost(self, i: int, j: int) -> int:
        at = j - self.low[i]
        return int(self.rows[i][at]) if 0 <= at < self.width else FAR

    def ends(self) -> dict[int, int]:
        """Cost by feasible length of the target."""
        found = {j: self.cost(len(self.roles), j) for j in range(self.low[-1], self.low[-1] + self.width)}
        odd = int(self.text[:1] == "s")
        return {j: c for j, c in found.items() if c < FAR and j % 2 == odd and j != 1}

    def steps(self, i: int, j: int) -> list[tuple[str, int, int]]:
        """Edits that leave a cell and are a cheapest way to the cell they lead to."""
        here, out = self.cost(i, j), []
        if i < len(self.roles):
            if self.cost(i + 1, j) == here + DELETE:
                out.append(("D", i + 1, j))
            if self.faults[i] not in DROPPED and j < len(self.text):
                letter, same = self.text[j], self.roles[i] == self.text[j]
                cost = (0 if same else REROLE) + (OPEN_END if self.faults[i] == TRUNCATED else 0)
                if (same or letter != "s") and self.cost(i + 1, j + 1) == here + cost:
                    out.append(("K" if same else "R", i + 1, j + 1))
        if j < len(self.text) and self.text[j] != "s" and self.cost(i, j + 1) == here + INSERT:
            out.append(("I", i, j + 1))
        return out

    def audit(self, length: int) -> str:
        """The ASCII-least audit of the cheapest alignments to the target of this length."""
        end = (len(self.roles), length)
        good, stack = {end}, [end]
        while stack:  # back from the end over cheapest edits
            i, j = stack.pop()
            for x, y in ((i - 1, j), (i, j - 1), (i - 1, j - 1)):
                if (x, y) not in good and x >= 0 and y >= 0 and self.cost(x, y) < FAR:
                    if any(step[1:] == (i, j) for step in self.steps(x, y)):
                        good.add((x, y))
                        stack.append((x, y))
        i, j, out = 0, 0, []
        while (i, j) != end:
            letter, i, j = min(step for step in self.steps(i, j) if step[1:] in good)
            out.append(letter)
        return "".join(out)


def banded_repair(roles: str, faults: bytes, cells: int = CELLS) -> tuple[int, str] | None:
    """Cost and audit by banded tables; None where they would take too many cells."""
    most, best = plain_cost(roles, faults), []
    for first in ("u", "s"):
        table = Table(roles, faults, first, most)
        if table.cells() > cells:
            return None
        ends = table.fill().ends()
        if ends:
            most = min(ends.values())
            best += [(most, table.audit(j)) for j, cost in ends.items() if cost == most]
    return min(best)


# States of a target: nothing yet, only s, u last, a last; where each character leads.
LEADS = ((("s", 1), ("u", 2)), (("u", 2),), (("a", 3),), (("u", 2),))
ENDS = (0, 3)


def periodic_repair(roles: str, faults: bytes) -> tuple[int, str]:
    """The same by states of the target: costs from each turn and state to the end, then all
    cheapest ways at once, character by character of the audit."""
    n = len(roles)

    def take(i: int, letter: str) -> int:
        if faults[i] in DROPPED:
            return FAR
        more = OPEN_END if faults[i] == TRUNCATED else 0
        return more if roles[i] == letter else FAR if letter == "s" else REROLE + more

    left = [[FAR] * 4 for _ in range(n)] + [[0 if state in ENDS else FAR for state in range(4)]]
    for i in range(n, -1, -1):
        here = left[i]
        for state in range(4) if i < n else ():
            ways = [left[i + 1][to] + take(i, letter) for letter, to in LEADS[state]]
            here[state] = min(left[i + 1][state] + DELETE, *ways)
        for _ in range(2):  # at most u and a are inserted without coming back
            for state in range(4):
                here[state] = min([here[state], *(here[to] + INSERT for letter, to in LEADS[state] if letter != "s")])
    ways, audit = {(0, 0)}, []
    while not any(i == n and state in ENDS and not left[n][state] for i, state in ways):
        found: dict[str, set[tuple[int, int]]] = {}
        for i, state in ways:
            here = left[i][state]
            if i < n and left[i + 1][state] + DELETE == here:
                found.setdefault("D", set()).add((i + 1, state))
            for letter, to in LEADS[state]:
                if letter != "s" and left[i][to] + INSERT == here:
                    found.setdefault("I", set()).add((i, to))
                if i < n and left[i + 1][to] + take(i, letter) == here < FAR:
                    found.setdefault("K" if roles[i] == letter else "R", set()).add((i + 1, to))
        audit.append(min(found))
        ways = found[audit[-1]]
    return left[0][0], "".join(audit)


@lru_cache(maxsize=1 << 15)
def _short_repair(roles: str, faults: bytes) -> tuple[int, str]:
    return banded_repair(roles, faults)


def repair(roles: str, faults: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, the ASCII-least audit where several are."""
    if len(roles) <= 64:
        return _short_repair(roles, faults)
    return banded_repair(roles, faults) or periodic_repair(roles, faults)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns (id, turn, role's character, fault, two hashes) to one row each conversation."""
    out: list[dict] = []
    turns: list[int] = []
    roles: list[str] = []
    faults, seen, current = bytearray(), set(), None

    def ended() -> dict:
        cost, audit = repair("".join(roles), bytes(faults))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        return {
            "conv_id": current, "gaps": min(gaps, 2**63 - 1), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED), "illegal": sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])),
            "cost": cost, "audit": audit,
        }

    for batch in batches:
        schema = pa.schema([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
        schema = schema.insert(0, pa.field("conv_id", batch.schema.field(0).type)).append(pa.field("audit", pa.string()))
        for conv, turn, role, fault, *digest in zip(*(column.to_pylist() for column in batch.columns)):
            if conv != current and roles:
                out.append(ended())
                turns, roles, faults, seen = [], [], bytearray(), set()
            current = conv
            if turn is not None:
                turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
            # Blank turns come back with another fault only if they are not blank.
            again = tuple(digest) in seen
            seen.add(tuple(digest))
            roles.append(role or NO_ROLE)
            faults.append(DUPLICATE if again and fault != BLANK else fault)
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if roles:
        out.append(ended())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An audit, then the sorted turns of its conversation: to the repaired turns."""
    current, audit, at, place, placed = None, "", 0, 0, 0
    out: list[tuple] = []

    def inserted() -> None:
        nonlocal at, place, placed
        while audit[at : at + 1] == "I":
            out.append((current, place, "I", ("user", "assistant")[placed % 2], ""))
            at, place, placed = at + 1, place + 1, placed + 1

    def written(schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv_id", "place", "edit", "role", "text"])

    schema = None
    for batch in batches:
        schema = batch.schema
        for conv, mine, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if mine is not None:  # the audit leads its conversation
                inserted()
                current, audit, at, place, placed = conv, mine, 0, 0, 0
                continue
            inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                role = ("user", "assistant")[placed % 2]
            out.append((conv, place, edit, role, text))
            place += 1
            placed += 0 if edit == "K" and role[:1] == "s" else 1
        yield written(schema)
    if schema is not None:
        inserted()
        yield written(schema)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns in order to one hash for each conversation."""
    current, digest, out, kind = None, None, [], None
    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, place, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if place == 0:
                if digest is not None:
                    out.append((current, digest.hexdigest()))
                current, digest = conv, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
    if digest is not None:
        out.append((current, digest.hexdigest()))
    if out:
        ids, digests = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests)], names=["conv_id", "repaired_sha256"])


def _readable(turns: DataFrame) -> DataFrame:
    filled = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    return turns.select("conv_id", "turn", *filled)


def _in_order(turns: DataFrame, *first) -> DataFrame:
    """Each conversation in one task, its turns in order."""
    dealt = turns.repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text): gaps in the numbers, turns by fault,
    illegal neighbours, cost and audit of the cheapest repair."""
    end = F.right(F.expr(TRIMMED), F.lit(1))
    fault = F.when(end == "", BLANK).when(end.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    ordered = _in_order(_readable(turns))
    coded = ordered.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("role"), fault.alias("fault"),
        uniform_hash(1, "role", "text").alias("a"), uniform_hash(2, "role", "text").alias("b"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return coded.mapInArrow(_audited, f"conv_id {kind}, {counts}")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns after the edits of their audits: conv_id, place, edit, role and text.

    A task gives the turns of a conversation one after the other, in order.
    """
    own = _readable(turns).select("conv_id", "turn", F.lit(None).cast("string").alias("audit"), "role", "text")
    none = F.lit(None)
    first = found.select(
        "conv_id", none.cast(turns.schema["turn"].dataType).alias("turn"), "audit", none.cast("string").alias("role"),
        none.cast("string").alias("text"))
    ordered = _in_order(first.union(own), F.col("audit").isNull())
    kind = turns.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(
        _rewritten, f"conv_id {kind}, place long, edit string, role string, text string")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults, by a checksum of their ids: some are dropped, emptied, unpunctuated,
    repeated or given to the user."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    turns = _readable(turns).withColumn("harm", F.crc32(name.cast("binary")) % 20).where("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("__copy")).drop("__copy")


def op12_banded_grammar_repair(spark, sf_dir: str) -> DataFrame:
    """Audits of all conversations after damage, and hashes of their repaired turns."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = damaged(table)
    found = store(audits(turns), "audits")
    kind = table.schema["conv_id"].dataType.simpleString()
    digests = repaired(turns, found).select("conv_id", "place", "role", "text").mapInArrow(
        _digested, f"conv_id {kind}, repaired_sha256 string")
    ids = table.select(F.col("conv_id").alias("id")).distinct()
    out = ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left").drop("conv_id")
    digests = digests.withColumnRenamed("conv_id", "own")
    out = out.join(digests, out["id"].eqNullSafe(digests["own"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
