"""Hard negatives, repaired conversations and repeated passages against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm.dialogue import (
    audits,
    banded_repair,
    op12_banded_grammar_repair,
    periodic_repair,
    repaired,
)
from marketloom.llm.negatives import hard_negatives, op11_slot_negatives, products
from marketloom.llm.passages import op13_rabin_karp_windows, without_repeated_passages

WORD = re.compile("[^\x20\x09-\x0d]+")
BIG = 2**63 - 1


# --- Hard negatives -------------------------------------------------------------------


def negatives(rows):
    """Rows of (id, label, whole numbers) to the contract's rows, as a multiset."""
    want = Counter()
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i, label, v in rows:
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows]
        same = sorted(((s, j) for s, j, m in scored if m == label and j != i), key=key)[:5]
        other = sorted(((s, j) for s, j, m in scored if m != label), key=key)
        for s, p in same:
            found = [(t, n) for t, n in other if 30 * s <= 100 * t <= 90 * s][:10]
            want.update((i, p, rank, n, s, t) for rank, (t, n) in enumerate(found, 1))
    return want


def usable(table):
    for r in table.collect():
        if r.label is None or r.embedding is None or any(x is None or not math.isfinite(x) for x in r.embedding):
            continue
        moved = r.vec_id is not None and r.vec_id % 7 == 0
        yield r.vec_id, (r.label + 1) % 10 if moved else r.label, [math.floor(256 * x) for x in r.embedding]


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def test_op11(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert rows_of(op11_slot_negatives(spark, sf_dir)) == negatives(list(usable(table)))


def test_op11_odd(spark, tmp_path):
    """Nulls, copies, ties, unequal lengths, numbers that are not finite, extra columns."""
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.5, 1.0, 0.0]) for _ in range(6)], rng.randrange(3)) for i in range(0, 1000, 5)]
    rows += rows[:40]
    rows += [
        (100, [1.0] * 6, 1), (100, [1.0] * 6, 2), (200, None, 1), (300, [1.0, None], 1), (400, [float("nan")] * 6, 0),
        (500, [float("inf")], 0), (None, [1.0] * 6, 1), (None, [1.0] * 6, 2), (-100, [1.0] * 9, 0), (600, [], 1), (700, [1.0] * 6, None),
        (-7, [0.75] * 6, 9), (BIG, [1.0, 1.0], 2), (-BIG - 1, [1.0, 1.0, 0.25], 1),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clash = {name: F.lit("x") for name in ("id", "group", "row", "anchor", "score", "limits", "found")}
    table.withColumns(clash).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert rows_of(op11_slot_negatives(spark, str(tmp_path))) == negatives(list(usable(table)))


def test_groups_change_nothing(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = spark.createDataFrame(list(usable(table)), "id long, label long, vector array<long>")
    small = hard_negatives(rows, F.col("id") % 100 == 0, group_cells=500)
    assert rows_of(small) == negatives(list(usable(table)))


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for size in (2**10, 2**28, 2**40, 2**62):
        a, b = rng.integers(-size, size, (3, 5)), rng.integers(-size, size, (4, 7))
        want = [[max(-BIG, min(BIG, sum(int(x) * int(y) for x, y in zip(u, v)))) for v in b] for u in a]
        assert products(a, b).tolist() == want


# --- Conversations --------------------------------------------------------------------


def all_edits(roles, faults):
    """Cost and audit by a search over all edits, cheapest first, then ASCII-least."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, text = heapq.heappop(heap)
        if (i, text) in seen:
            continue
        seen.add((i, text))
        if i == len(roles) and re.fullmatch("(s?(ua)+)?", text):
            return cost, audit
        for x in "ua" if len(text) < len(roles) + 3 else "":
            heapq.heappush(heap, (cost + 2, audit + "I", i, text + x))
        if i < len(roles):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, text))
            if faults[i] not in (1, 2):
                more = cost + (faults[i] == 3)
                heapq.heappush(heap, (more, audit + "K", i + 1, text + roles[i]))
                for x in "ua":
                    heapq.heappush(heap, (more + 2, audit + "R", i + 1, text + x))


def test_alignment_is_cheapest_and_least():
    rng = random.Random(3)
    for n in range(6):
        for _ in range(150):
            roles = "".join(rng.choice("suaut\0") for _ in range(n))
            faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
            assert banded_repair(roles, faults) == periodic_repair(roles, faults) == all_edits(roles, faults)


def test_long_alignments_agree():
    rng = random.Random(4)
    for n in (50, 300):
        for share in (0.05, 0.6):
            roles = "".join("ua"[i % 2] if rng.random() > share else rng.choice("suat") for i in range(n))
            faults = bytes(0 if rng.random() > share else rng.choice([1, 2, 3]) for _ in range(n))
            assert banded_repair(roles, faults) == periodic_repair(roles, faults)
    assert banded_repair("u" * 3000, bytes(3000), cells=1000) is None


def conversations(rows):
    """The contract's row for every conversation, by the alignment without bands."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        turns = by[conv]
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        turns += [(turn is not None, turn or 0, role, text)] * ((0, 1, 1, 2)[harm] if harm < 4 else 1)
    want = {}
    for conv, turns in by.items():
        turns.sort()
        numbers = [t[1] for t in turns if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults, seen = [], set()
        for _, _, role, text in turns:
            body = text.strip(" \t\n\v\f\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 0 if body[-1] in ".!?" else 3)
            seen.add((role, text))
        roles = "".join(t[2][:1] or "\0" for t in turns)
        cost, audit = periodic_repair(roles, bytes(faults))
        out, rest, placed = [], iter(turns), 0
        for edit in audit:
            _, _, role, text = (0, 0, "", "") if edit == "I" else next(rest)
            if edit != "D":
                role = role if edit == "K" else ("user", "assistant")[placed % 2]
                out.append(f"{role}:{text}")
                placed += not (edit == "K" and role[:1] == "s")
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        want[conv] = (conv, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, digest)
    return want


def test_op12(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = conversations(map(tuple, table.collect()))
    assert sorted(map(tuple, op12_banded_grammar_repair(spark, sf_dir).collect())) == sorted(want.values())


def test_op12_odd(spark, tmp_path):
    """Null columns, ties, copies, odd roles, a long text, a long conversation, extra columns."""
    rng = random.Random(6)
    rows = [(None, None, None, None), (None, 1, "user", "Yes."), (None, None, "system", "Be kind."), (1, 1, "user", "Hi."),
            (1, 1, "user", "Hi."), (1, 1, "assistant", "Hello!"), (1, None, "system", None), (2, 5, "", "x"), (2, 2, "tool", " \t\n\x0b"),
            (3, 7, "system", "Only this."), (4, 1, "user", "long " * 100_000), (4, 2, "assistant", "ok.\n\n"), (5, 0, "user", "Été"),
            (6, -BIG - 1, "user", "a."), (6, BIG, "assistant", "b.")]
    rows += [(7, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["A.", "B", "C!", " "]) + str(i % 40) * (i % 3)) for i in range(300)]
    rows += [(i, 0, "user", "gone?") for i in range(8, 60)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = {name: F.lit(1) for name in ("id", "audit", "harm", "fault", "place", "cost")}
    table.withColumns(clash).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in op12_banded_grammar_repair(spark, str(tmp_path)).collect()]
    want = {k: (*v[:1], min(v[1], BIG), *v[2:]) for k, v in conversations(rows).items()}
    assert sorted(got, key=str) == sorted(want.values(), key=str)
    assert len(got) == len({r[0] for r in rows})


def test_repaired_turns(spark):
    turns = spark.createDataFrame(
        [("x", 1, "assistant", "One."), ("x", 2, "user", "Two."), ("x", 3, "user", "Three"), ("y", 1, "system", "S.")],
        "conv_id string, turn int, role string, text string")
    found = audits(turns)
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()} == {"x": (5, "IKKR"), "y": (3, "D")}
    got = [tuple(r) for r in repaired(turns, found).orderBy("conv_id", "place").collect()]
    assert got == [("x", 0, "I", "user", ""), ("x", 1, "K", "assistant", "One."), ("x", 2, "K", "user", "Two."),
                   ("x", 3, "R", "assistant", "Three")]


# --- Repeated passages ----------------------------------------------------------------


def passages(docs, length=13):
    """Rows of (doc_id, text) to (doc_id, words, removed words, hash), as a multiset."""
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, w in split:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, math.inf), math.inf if d is None else d)
    out = Counter()
    for d, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            least = first[tuple(w[k : k + length])]
            if least < (math.inf if d is None else d):
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_op13(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_rabin_karp_windows(spark, sf_dir)) == passages(docs)


@pytest.mark.parametrize(("chunk", "part_bytes"), [(2_000_000, 16 << 20), (50, 100_000)])
def test_op13_odd(spark, chunk, part_bytes):
    """Nulls, repeated ids with equal and other texts, ids at the ends of the long range, a
    passage within one text, long words, and chunks that cut texts."""
    a, b = ([f"{c}{i}" for i in range(30)] for c in "ab")
    rows = [
        (5, " ".join(a)), (3, "\t".join(a[5:]) + "\x0b" + " ".join(b)), (3, " ".join(b + b)), (3, " ".join(b + b)), (None, " ".join(a)),
        (None, " ".join(a)), (None, "only here " * 20), (None, "only here " * 20), (-BIG - 1, " ".join(b[:13])), (BIG, " ".join(a[:14] + b)),
        (BIG, None), (0, ""), (1, " \n "), (2, "é" * 700_000), (4, " ".join(["w"] * 3000)), (6, " ".join(["w"] * 13)), (7, "x " * 12),
        (8, " ".join(a[:12])), (9, " ".join(a)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("doc", "digest", "runs", "part")})
    got = without_repeated_passages(docs, chunk=chunk, part_bytes=part_bytes)
    assert found(got.withColumn("kept_sha256", F.sha2("kept", 256))) == passages(rows)


def test_many_texts_share_an_id(spark):
    """No number of texts under one id, or without one, is too many."""
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.range(40_000).select(
        F.when(F.col("id") == 0, 1).cast("long").alias("doc_id"), F.concat(F.lit(text + " tail"), "id").alias("text"))
    got = without_repeated_passages(docs).groupBy("n_removed").count().collect()
    assert {(r.n_removed, r["count"]) for r in got} == {(0, 1), (20, 39_999)}


def test_op5_tells_any_number_of_texts_apart(spark):
    """More texts than fit sixteen bits under no id, and ids at the ends of the long range."""
    from marketloom.llm.substring import without_repeats

    shared = "this passage of sixty bytes is in every one of the texts here"
    rows = [(-BIG - 1, shared), (BIG, f"{shared} and more")] + [(None, f"{i} {shared}") for i in range(40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = without_repeats(docs).groupBy("doc_id", "n_removed").count().collect()
    assert {(r.doc_id, r.n_removed, r["count"]) for r in got} == {
        (-BIG - 1, 0, 1), (BIG, len(shared), 1), (None, len(shared), 40_000)}


def test_op5_orders_the_largest_id_before_none(spark):
    from marketloom.llm.substring import without_repeats

    text = "a passage that only the last document and one without an id have"
    docs = spark.createDataFrame([(BIG, text), (None, text), (-BIG - 1, "x"), (0, "y")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in without_repeats(docs).collect()} == {BIG: 0, None: len(text), -BIG - 1: 0, 0: 0}


def test_op9_ends_where_numbers_are_short(spark):
    """All numbers of five digits that begin with 1 are entities; theirs begin otherwise."""
    from marketloom.llm.pii import redrawn, surrogate

    numbers = [str(n) for n in range(10_000, 20_000)]
    found = spark.createDataFrame([(i, "phone", n) for i, n in enumerate(numbers)], "row long, kind string, entity string")
    draws = {r.entity: r.attempt for r in redrawn(found).collect()}
    new = [surrogate("phone", n, draws.get(n, 0)) for n in numbers]
    assert len(set(new)) == len(numbers) and not set(new) & set(numbers) and all(len(n) == 5 for n in new)


def test_op9_names_a_type_that_is_used_up(spark, monkeypatch):
    from marketloom.llm import pii

    monkeypatch.setattr(pii, "STALLED", 2)
    # Ten numbers of one digit have no other numbers to turn into.
    found = spark.createDataFrame([(i, "phone", str(i)) for i in range(1, 10)], "row long, kind string, entity string")
    with pytest.raises(ValueError, match="phone"):
        pii.redrawn(found)


def test_op10_next_text_for_any_ids(spark, monkeypatch):
    """Ids at both ends of the long range, repeated ones, many rows without one; going round."""
    from marketloom.llm import fingerprint

    monkeypatch.setattr(fingerprint, "ROWS_PER_BLOCK", 3)
    ids = [-BIG - 1, BIG, -9 * 10**18, 9 * 10**18, 0, 1, 2, 2, 5, 10**12] + [None] * 40
    rows = [(d, f"text {i}") for i, d in enumerate(ids)]
    for some in (rows, rows[:2], rows[:1], rows[10:]):
        docs = spark.createDataFrame(some, "doc_id long, text string")
        hashed = docs.select("doc_id", "text", fingerprint.uniform_hash(10, "text").alias("h")).collect()
        order = sorted(hashed, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h, r.text))
        want = {r.text: order[(i + 1) % len(order)].text for i, r in enumerate(order)}
        assert {r.text: r.next_text for r in fingerprint.with_next(docs).collect()} == want


def test_remaining_texts_of_substrings_are_sent_only_where_asked_for(spark):
    from hashlib import sha256

    from marketloom.llm import substring

    common = "".join(chr(97 + i * i % 23) for i in range(80))
    docs = spark.createDataFrame([(1, common + "one"), (2, "two" + common), (3, None)], "doc_id long, text string")
    whole = {r.doc_id: r for r in substring.without_repeats(docs).collect()}
    assert bytes(whole[2].kept) == b"two" and bytes(whole[3].kept) == b""
    slim = substring.without_repeats(docs, texts=False)
    assert "kept" not in slim.columns
    for row in slim.collect():
        assert row.kept_sha256 == sha256(bytes(whole[row.doc_id].kept)).hexdigest()
        assert (row.n_bytes, row.n_removed, row.n_spans) == whole[row.doc_id][1:4]
