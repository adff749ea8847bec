"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

Measures are SQL expressions over the text; a rule bounds one measure. No user functions
and no shuffle: every row is judged from its own text. Null and empty texts have no words,
so the base rule rejects them; ties and repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import BLANKS

WINDOW = 8

# Frequent function words of the four languages.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au aux dans de des du elle en est et il la le les ou par pas pour que qui sur un une "
    "auf das dem den der des die ein eine einen für ist mit nicht sich und von zu "
    "al como con del el es esta los las no o para por que se una y"
).split()

# Measure, least and greatest allowed value (None: no bound).
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 2.0, 16.0),
    ("symbol_ratio", None, 0.25),
    ("shout_ratio", None, 0.25),
    ("stop_word_ratio", 0.05, None),
    ("duplicate_line_ratio", None, 0.5),
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _covered(positions: Column) -> Column:
    """Words that windows at these ascending positions cover."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        positions,
        start,
        lambda a, i: F.struct(
            (a["total"] + i + WINDOW - F.greatest(a["end"], i)).alias("total"), (i + WINDOW).alias("end")
        ),
        lambda a: a["total"],
    )


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur at least twice in the text.

    Windows are compared by 64-bit hashes of their words' hashes. Sorting brings equal
    windows together, so the work is n log n also for texts that repeat themselves.
    """
    def of_windows(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.cast("long").alias("i"))))
        def positions(sorted_pairs: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(sorted_pairs, j)["k"] == x["k"], F.lit(False))
            twice = F.filter(sorted_pairs, lambda x, j: same(x, j - 1) | same(x, j + 1))
            return _covered(F.sort_array(F.transform(twice, lambda x: x["i"])))
        unique = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(unique, F.lit(0).cast("long")).otherwise(bind(pairs, positions))

    def of_hashes(hashes: Column) -> Column:
        last = F.size(hashes) - WINDOW
        window = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])
        keys = F.transform(F.sequence(F.lit(0), last), window)
        return F.when(last < 1, F.lit(0).cast("long")).otherwise(bind(keys, of_windows))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measures(text: Column) -> dict[str, Column]:
    """Counts of a text, as columns over the array column ``__words``."""
    words = F.col("__words")
    blanks = " \t\n\x0b\f\r"
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, blanks, "")) > 0)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, blanks, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeated_words(words),
        "n_shouts": (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
    }


def ratios() -> dict[str, Column]:
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "mean_word_chars": over("word_chars", "n_words"),
        "symbol_ratio": over("n_symbols", "n_words"),
        "shout_ratio": over("n_shouts", "n_words"),
        "stop_word_ratio": over("n_stop_words", "n_words"),
        "duplicate_line_ratio": over("n_dup_lines", "n_lines"),
    }


def verdict(rules=RULES) -> Column:
    """One condition: all rules of the table hold."""
    bounds = []
    for name, least, most in rules:
        bounds += [ratios()[name] >= least] if least is not None else []
        bounds += [ratios()[name] <= most] if most is not None else []
    return reduce(Column.__and__, bounds, F.lit(True))


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The given columns and, in a struct ``quality``, all measures and the verdict."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(F.struct("*").alias("__row"), body.alias("__text")).withColumn(
        "__words", F.split("__text", f"[{BLANKS}]+")
    ).withColumn("__words", F.array_remove("__words", ""))
    counted = counted.select("__row", *[c.alias(n) for n, c in measures(F.col("__text")).items()])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    names = [c for c in counted.columns if c != "__row"]
    quality = F.struct(*names, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
    return counted.select("__row", quality.alias("quality")).select("__row.*", F.col("quality").alias("__quality"))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select(
        "doc_id",
        *[F.col(f"__quality.{c}") for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", "n_stop_words", "n_shouts",
        )],
    )


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules keep, with their own columns."""
    return judge(docs).where("__quality.kept").select(*docs.columns)


OP2_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), b AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)),
                     lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS lines
  FROM t
), g AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM b WHERE len(w) > 8)
), c AS (
  SELECT r, i, lag(i + 7) OVER (PARTITION BY r ORDER BY i) AS e
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT r, sum(i + 7 - greatest(coalesce(e, 0), i - 1)) AS n FROM c GROUP BY r
), m AS (
  SELECT b.r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words,
         length(text) - length(replace(text, '!', '')) AS n_shouts,
         len(list_filter(w, lambda x: lower(x) IN (STOPS))) AS n_stop_words
  FROM b LEFT JOIN rep USING (r)
), v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND RULES AS kept,
       n_stop_words::BIGINT AS n_stop_words, n_shouts::BIGINT AS n_shouts
FROM v
"""

_SQL_RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "n_words"),
    "shout_ratio": ("n_shouts", "n_words"), "stop_word_ratio": ("n_stop_words", "n_words"),
    "duplicate_line_ratio": ("n_dup_lines", "n_lines"),
}


def op2_sql() -> str:
    """The DuckDB statement of ``op2_quality_rules``, from the same table of thresholds."""
    bounds = []
    for name, least, most in RULES:
        a, b = _SQL_RATIOS[name]
        ratio = f"{a}::DOUBLE / greatest({b}, 1)"
        bounds += [f"{ratio} >= {least}"] if least is not None else []
        bounds += [f"{ratio} <= {most}"] if most is not None else []
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return OP2_SQL.replace("STOPS", stops).replace("RULES", " AND ".join(bounds))
