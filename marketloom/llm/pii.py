"""Surrogates for personal data: keyed, type-consistent replacements.

Entities are found by patterns; each gets a replacement of its own type that follows its
script and format (digit for digit, letter for letter, title's gender for a name, valid
check digit for a valid one), drawn from a keyed hash of its canonical form. All spellings
of an entity therefore get the same surrogate everywhere (coreference). A distributed
check over all entities keeps surrogates distinct: where two entities meet in one
surrogate, or a surrogate is an entity of the corpus, all but the smallest draw again.

Null texts stay null, empty texts stay empty, and texts without entities are unchanged.
Repeated rows are replaced alike. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import store

KEY = "surrogates"
WIDER = 4  # draws before the first digits of a number change
STALLED = 24  # rounds without progress before the replacement fails

# Countries whose IBAN ends with a group of four; a short word behind it is not part of it.
WHOLE_GROUPS = "AD|AL|AT|AZ|BA|BE|BY|CY|CZ|DO|EE|ES|GT|HU|KZ|LB|LT|LU|MD|NI|PK|PL|RO|SA|SE|SK|SV|TN|VG|XK"

# Patterns by type. Longer types come first, so that an address inside a
# secret, or a number inside an address, belongs to the outer one.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,24}"),
    ("secret", r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Za-z])"),
    ("secret", r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,})(?![0-9A-Za-z])"),
    ("secret", r"(?i:(?<![a-z])(?:token|secret|password|passwd|api_key|apikey)\s*[=:]\s*[\"'])[^\"'\s]{6,}(?=[\"'])"),
    ("iban", rf"(?<![0-9A-Za-z])(?:{WHOLE_GROUPS})[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{3,7}}(?![0-9A-Za-z])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2}(?:(?: ?[0-9A-Z]{4}){1,5}(?: ?[0-9A-Z]{1,3})?| ?[0-9A-Z]{3})(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z.])[0-9]{4}(?:[ \-]?[0-9]{4}){2}[ \-]?[0-9]{1,7}(?![0-9A-Za-z])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("ssn", r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"),
    ("phone", r"(?<![0-9A-Za-z])(?=\+[0-9](?:[ .\-()]{0,3}[0-9]){6})\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{1,4}(?:[ .\-]?[0-9]{1,4}){0,3}(?:[ .\-]?[0-9]{2,4}|[.\-][0-9])(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[.\-][0-9]{4}(?![0-9A-Za-z])"),
    ("name", r"(?<!\w)(?:Mr|Mrs|Ms|Herr|Frau|Monsieur|Madame|Señora|Señor)\.? [^\W\d_][\w'\-]+(?: [A-ZÀ-ÞΑ-ΩА-Я][\w'\-]+)?"),
)

# Name parts by gender of the title.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor")
GIVEN = {
    "m": "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noel Oskar Paul".split(),
    "f": "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nora Olga Paula".split(),
}
FAMILY = "Abel Berg Conrad Dorn Engel Frank Gruber Hall Jansen Keller Lang Moser Novak Olsen Petri Roth".split()

# First and last code point of a script, and its letters.
LATIN = "abcdefghijklmnopqrstuvwxyz"
SCRIPTS = (
    ("\u0370", "\u03ff", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("\u0400", "\u04ff", "абвгдежзиклмнопрстуфхцчшщэюя"),
)

# Every match holds one of these; most texts hold none and need no closer look.
SIGNS = re.compile(r"[0-9@=:]|M(?:r|s|onsieur|adame)|Herr|Frau|Señor")

FOUND = "kind string, entity string"


def _compiled() -> re.Pattern:
    return re.compile("|".join(f"(?P<p{i}>{p})" for i, (_, p) in enumerate(PATTERNS)))


def _matches(pattern: re.Pattern, text: str | None) -> Iterator[re.Match]:
    return pattern.finditer(text) if text and SIGNS.search(text) else iter(())


def _kind(match: re.Match) -> tuple[str, str, int]:
    """Type and entity text of a match, and where the entity starts."""
    kind, value, start = PATTERNS[int(match.lastgroup[1:])][0], match.group(), match.start()
    if kind == "secret" and value[0].isalpha() and re.match(r"(?i)[a-z_]+\s*[=:]", value):
        cut = re.match(r"[^\"']*[\"']", value).end()
        return kind, value[cut:], start + cut
    return kind, value, start


def canonical(kind: str, value: str) -> str:
    """What the spellings of one entity have in common."""
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"[^0-9]", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "email":
        return value.lower()
    if kind == "name":
        return value.replace(".", "").casefold()
    return value


def _luhn(digits: str) -> int:
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10


def _stream(key: str, kind: str, text: str, attempt: int) -> Iterator[int]:
    """Endless keyed bytes."""
    part = 0
    while True:
        yield from hashlib.blake2b(f"{kind}\0{attempt}\0{part}\0{text}".encode(), key=key.encode()).digest()
        part += 1


def surrogate(kind: str, entity: str, attempt: int, key: str = KEY) -> str:
    """The replacement of a canonical entity, in canonical form."""
    draw = _stream(key, kind, entity, attempt)
    digit = lambda low=0: str(low + next(draw) % (10 - low))
    if kind == "name":
        title, *names = entity.split(" ")
        if any(_letters(c) != LATIN for c in "".join(names)):
            return " ".join([title, *[_alike(part, draw) for part in names]])
        given = GIVEN["m" if title.capitalize() in MALE_TITLES else "f"]
        parts = [given[next(draw) % 16]] if len(names) > 1 else []
        family = [FAMILY[next(draw) % 16] for _ in range(2 + attempt)]
        return " ".join([title, *parts, "-".join(family)]).casefold()
    if kind == "ip":
        return ".".join(str(1 + (256 * next(draw) + next(draw)) % 254) for _ in range(4))
    if kind == "email":
        local, _, domain = entity.partition("@")
        last = domain.rsplit(".", 1)[1]
        return f"{_alike(local, draw)}@{_alike(domain[: -len(last) - 1], draw)}.{last}"
    if kind == "phone":
        keep = max(1, len(entity) - 9)
        first = entity[:keep] if attempt < WIDER else digit(1) + "".join(digit() for _ in entity[1:keep])
        return first + "".join(digit() for _ in entity[keep:])
    if kind in ("card", "ssn"):
        body = (entity[0] if attempt < WIDER else digit(1)) + "".join(digit() for _ in entity[1:])
        if kind == "card" and _luhn(entity) == 0:
            body = next(body[:-1] + d for d in "0123456789" if _luhn(body[:-1] + d) == 0)
        return body
    if kind == "iban":
        body = _alike(entity[4:], draw)
        number = int("".join(str(int(c, 36)) for c in body + entity[:2] + "00"))
        return f"{entity[:2]}{98 - number % 97:02d}{body}"
    hexadecimal = re.fullmatch(r"[0-9a-fA-F]+", entity)
    if hexadecimal:
        out = "".join("0123456789abcdef"[next(draw) % 16] for _ in entity)
        return out.upper() if entity.isupper() else out
    return _alike(entity, draw)


def _letters(c: str) -> str:
    """The letters of a character's script; Latin ones for scripts without a table."""
    return next((letters for first, last, letters in SCRIPTS if first <= c <= last), LATIN)


def _alike(text: str, draw: Iterator[int]) -> str:
    """A digit for each digit and a letter of the same case and script for each letter."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(next(draw) % 10))
        elif c.isalpha():
            letters = _letters(c)
            new = letters[next(draw) % len(letters)]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def spelled(kind: str, value: str, replacement: str) -> str:
    """A canonical replacement in the format of the spelling it replaces."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(replacement)
        return "".join(next(digits) if c.isdigit() else c for c in value)
    if kind == "iban":
        chars = iter(replacement)
        return "".join(c if c == " " else next(chars) for c in value)
    if kind == "email":
        return replacement.upper() if value.isupper() else replacement
    if kind == "name":
        title = re.match(r"\w+\.?", value).group()
        rest = " ".join("-".join(p.capitalize() for p in w.split("-")) for w in replacement.split(" ")[1:])
        return f"{title} {rest.upper() if value.isupper() else rest}"
    return replacement


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, kind, entity): the distinct entities of each text, by the hash of the text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _compiled()
        for batch in batches:
            rows, kinds, values = [], [], []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen = {_kind(m)[:2] for m in _matches(pattern, value.as_py())}
                for kind, entity in sorted({(k, canonical(k, v)) for k, v in seen}):
                    rows.append(key)
                    kinds.append(kind)
                    values.append(entity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                names=["row", "kind", "entity"])

    return docs.select(F.xxhash64(text).alias("row"), text).mapInArrow(find, "row long, " + FOUND)


def redrawn(found: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, entity, attempt) of entities whose first surrogate is taken.

    All entities draw; of those that meet in one surrogate the smallest keeps it, and a
    surrogate that is itself an entity is given up. Later rounds look only at the
    entities that drew again, against every surrogate held so far. After ``WIDER`` draws
    the first digits of a number change as well. Where ``STALLED`` rounds settle nothing,
    the surrogates of some type are used up, and an error names it.
    """
    def draw(attempted: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                new = [surrogate(k, e, a, key) for k, e, a in zip(*[c.to_pylist() for c in batch.columns])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "entity", "attempt", "new"])
        return attempted.select("kind", "entity", "attempt").mapInArrow(run, FOUND + ", attempt int, new string")

    every = store(found.groupBy("kind", "entity").agg(F.lit(0).alias("attempt")), "entities")
    taken = every.select("kind", F.col("entity").alias("new"))
    drawn, result = store(draw(every), "surrogates"), None
    least, rounds = None, 0
    while True:
        first = drawn.groupBy("kind", "new").agg(F.min("entity").alias("holder"), F.count(F.lit(1)).alias("n"))
        clash = first.join(taken, ["kind", "new"], "left_semi").select("kind", "new", F.lit(None).cast("string").alias("holder"))
        clash = clash.union(first.join(taken, ["kind", "new"], "left_anti").where("n > 1").select("kind", "new", "holder"))
        again = drawn.join(clash, ["kind", "new"]).where("holder is null or entity <> holder")
        again = store(again.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "again")
        settled = drawn.join(again.select("kind", "entity"), ["kind", "entity"], "left_anti")
        later = settled.where("attempt > 0").select("kind", "entity", "attempt")
        result = later if result is None else result.union(later)
        left = {r["kind"]: r["count"] for r in again.groupBy("kind").count().collect()}
        if not left:
            return store(result, "redrawn")
        total = sum(left.values())
        rounds = 0 if least is None or total < least else rounds + 1
        least = total if least is None else min(least, total)
        if rounds >= STALLED:
            raise ValueError(f"too few surrogates that are no entities themselves: {left}")
        taken = store(taken.union(settled.select("kind", "new")), "taken")
        drawn = store(draw(again), "surrogates")


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """The given columns with the text replaced, and ``n_entities`` (occurrences)."""
    found = store(entities(docs, text), "found")
    late = redrawn(found, key)
    # Texts with an entity that drew again carry those draws along; they are few.
    notes = found.join(late, ["kind", "entity"]).groupBy("row").agg(
        F.collect_set(F.struct("kind", "entity", "attempt")).alias("__late"))
    columns = docs.columns
    keyed = docs.withColumn("__row", F.xxhash64(text))
    tagged = keyed.join(notes, keyed["__row"] == notes["row"], "left").select(*[keyed[c] for c in columns], "__late")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", `__n_entities` long"

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _compiled()
        at = columns.index(text)
        for batch in batches:
            texts, counts = [], []
            for value, late_draws in zip(batch.column(at), batch.column(len(columns))):
                value = value.as_py()
                draws = {(d["kind"], d["entity"]): d["attempt"] for d in late_draws.as_py() or []}
                out, end, n = [], 0, 0
                for match in _matches(pattern, value):
                    kind, entity, start = _kind(match)
                    plain = canonical(kind, entity)
                    new = surrogate(kind, plain, draws.get((kind, plain), 0), key)
                    out += [value[end:start], spelled(kind, entity, new)]
                    end, n = start + len(entity), n + 1
                texts.append(value if not n else "".join([*out, value[end:]]))
                counts.append(n)
            arrays = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64())], names=[*columns, "__n_entities"])

    return tagged.mapInArrow(rewrite, schema)


def op9_surrogates(spark, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(docs).select("doc_id", "text", F.col("__n_entities").alias("n_entities"))


def without_personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts with surrogates; ``n_chars`` follows the new text."""
    out = replace_entities(docs).drop("__n_entities")
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
