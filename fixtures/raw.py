"""Raw feed tables as integer arithmetic on a row number, in Spark SQL and DuckDB SQL.

Both texts come from one walk over the declared raw schema, so the two engines see the
same rows. Everything is a projection of one given table; nothing is grouped or sorted.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.plans import FeedSpec, catalog
from marketloom.plans.pipeline import raw_type
from marketloom.sources import Registry, SourceTable

BATCHES = (1704067200000, 1704931200000, 1707955200000)  # day 0, day 10, day 45
SOURCES = {"Acme_US_mkt_": "Acme", "Globex_CA_mkt_": "Globex"}
STORES = {"Acme": "US", "Globex": "CA"}
CURRENCIES = ("USD", "CAD", "INR", "MXN")

# Base table and row number of each feed; all others are item feeds.
LINE = ("lineitem", "l_orderkey * 10 + l_linenumber", "true")
BASES = {
    "m04_cancellation_on_request": LINE,
    "m05_delivery_defect_on_request": LINE,
    "m15_reconciliation": LINE,
    "m12_orders": ("orders", "o_orderkey", "true"),
    "m18_returns": ("lineitem", "l_orderkey", "true"),
    "m19_returns_order_lines": ("lineitem", "l_orderkey", "true"),
}
ITEM = ("part", "p_partkey", "true")

# Elements per array where it is not one, and the most there can be.
SIZES = {
    "orderLine": ("1 + n % 3", 3),
    "charge": ("1 + (n + {at}) % 2", 2),
    "tax": ("(n + {at}) % 3", 2),
    "shipments": ("1 + n % 2", 2),
    "nodes": ("2", 2),
    "shipNodes": ("2", 2),
    "returnOrderLines": ("1 + n % 2", 2),
    "chargeTotals": ("3", 3),
    "charges": ("1 + n % 2", 2),
}

# Fields with the same value in all elements, so that positions decide between them.
REPEATED = {"returnOrderLineNumber"}

SPECS = catalog()


# Sums that most columns share, computed once a row: 31, 7 and 13 times the number, plus ``d``.
SUMS = {f"n{k}": f"n * {k} + d" for k in (31, 7, 13)}


class Spark:
    """Spark SQL spelling of the few constructs that differ.

    Arrays are spelled element by element, up to the most they can have: Spark compiles that,
    while it interprets a lambda and all that is inside it.
    """

    def user(self):
        # Spark compiles a projection with a lambda column by column, others into one method.
        # The JVM interprets a method of seventy columns, which takes three times as long.
        return "array_join(transform(array(n % 3), x -> concat('user_', x)), '')"

    def missing(self, rest):
        # In every nested column, so that those are never compiled into one method either.
        return f"exists(array({rest}), x -> x = 0)"

    def places(self, indexes):
        return " + ".join(i if d == 0 else f"{3 ** d} * {i}" for d, i in enumerate(indexes)) or "0"

    def times(self, j, factor):
        return j * factor

    def total(self, factor, constant, d, at):
        first = f"n{factor}" if d == "d" else f"n * {factor}"
        return " + ".join([first, *(str(x) for x in (constant, at) if str(x) != "0")])

    def label(self, letter, j, *parts):
        return f"concat('{letter}{j}_', {', '.join(parts)})"

    def currency(self, at):
        place = "n" if at == "0" else f"(n + {at})"
        codes = ", ".join(f"'{code}'" for code in CURRENCIES)
        return f"get(array({codes}), cast({place} % 5 as int))"

    def date(self, days):
        return f"date_add(date'2024-01-01', cast({days} as int))"

    def hour(self, hours):
        return f"timestampadd(HOUR, cast({hours} as int), timestamp_ntz'2024-01-01 00:00:00')"

    def struct(self, fields):
        return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields) + ")"

    def array(self, size, most, index, element):
        places = range(1, most + 1)
        items = [f"case when {size} >= {i} then {re.sub(rf'\b{index}\b', str(i), element)} end" for i in places]
        return f"slice(array({', '.join(items)}), 1, cast(greatest({size}, 0) as int))"


class Duck:
    """The same constructs for DuckDB."""

    def user(self):
        return "concat('user_', n % 3)"

    def missing(self, rest):
        return f"{rest} = 0"

    def places(self, indexes):
        return "(" + " + ".join(["0", *(f"{3 ** d} * {i}" for d, i in enumerate(indexes))]) + ")"

    def times(self, j, factor):
        return f"{j} * {factor}"

    def total(self, factor, constant, d, at):
        return f"n * {factor} + {constant} + {d} + {at}"

    def label(self, letter, j, *parts):
        return f"concat('{letter}', {j}, '_', {', '.join(parts)})"

    def currency(self, at):
        cases = " ".join(f"when {i} then '{c}'" for i, c in enumerate(CURRENCIES))
        return f"case (n + {at}) % 5 {cases} end"

    def date(self, days):
        return f"(date '2024-01-01' + cast({days} as integer))"

    def hour(self, hours):
        return f"(timestamp '2024-01-01 00:00:00' + to_hours(cast({hours} as integer)))"

    def struct(self, fields):
        return "{" + ", ".join(f"'{name}': {value}" for name, value in fields) + "}"

    def array(self, size, most, index, element):
        return f"[{element} for {index} in range(1, 1 + cast({size} as bigint))]"


class _Walk:
    def __init__(self, dialect, spec: FeedSpec):
        self.dialect = dialect
        # Feeds that share a raw table agree on which of its fields are keys.
        self.keys = {
            output.source.rpartition(".")[2].lower()
            for other in SPECS.values()
            if other.feed == spec.feed
            for output in other.outputs
            if output.name.lower() in {key.lower() for key in other.keys}
        }
        self.null_key = spec.keys[0].lower()
        # Keys repeat inside an array where one row per key is kept.
        self.tail = "1 + {} % 2" if spec.ties == "one" else "{}"
        self.j = 0

    def value(self, name, kind, indexes=(), wanted=None):
        if isinstance(kind, T.ArrayType):
            return self.array(name, kind.elementType, indexes, wanted and wanted.elementType)
        if isinstance(kind, T.StructType):
            # Fields that are left out are numbered all the same.
            kinds = {f.name: f.dataType for f in wanted or kind}
            fields = [(f.name, self.value(f.name, f.dataType, indexes, kinds.get(f.name))) for f in kind]
            return self.dialect.struct([field for field in fields if field[0] in kinds])
        self.j += 1
        at = "0" if name in REPEATED else self.dialect.places(indexes)
        is_key = name.lower() in self.keys
        d = "0" if is_key else "d"
        if isinstance(kind, T.StringType):
            text = self.text(name, at, d, is_key, indexes)
        elif isinstance(kind, T.LongType):
            text = f"({self.dialect.total(7, self.j, d, at)}) % 500"
        elif isinstance(kind, T.DoubleType):
            five = self.dialect.times(self.j, 5)
            text = f"cast(({self.dialect.total(13, five, d, at)}) % 10000 as double) / 100"
        elif isinstance(kind, T.DateType):
            text = self.dialect.date(f"(n + {self.j} + {at}) % 28")
        elif isinstance(kind, T.TimestampNTZType):
            text = self.dialect.hour(f"(n + {self.j} + {at}) % 672")
        else:
            raise TypeError(f"no rule for {kind}")
        if not indexes and name.lower() == self.null_key:
            text = f"case when n % 101 = 0 then null else {text} end"
        return text

    def text(self, name, at, d, is_key, indexes):
        if is_key:
            tail = ["'_'", self.tail.format(indexes[-1])] if indexes else []
            return self.dialect.label("k", self.j, "n", *tail)
        if name.lower().endswith(("currency", "currencyunit")):
            return self.dialect.currency(at)
        total = self.dialect.total(31, self.dialect.times(self.j, 17), d, at)
        return self.dialect.label("c", self.j, f"({total}) % 1000")

    def array(self, name, element, indexes, wanted=None):
        self.j += 1
        shift = f"(n + {self.j}" + "".join(f" + {i}" for i in indexes) + ")"
        at = "(" + " + ".join(["0", *indexes]) + ")"
        text, most = SIZES.get(name, ("1", 1))
        size = text.format(at=at)
        empty, null = (17, 13) if not indexes else (19, 23)
        size = f"(case when {shift} % {empty} = 0 then 0 else {size} end)"
        index = f"i{len(indexes) + 1}"
        body = self.value(name, element, (*indexes, index), wanted)
        made = self.dialect.array(size, most, index, body)
        missing = f"{shift} % {null} = 0" if indexes else self.dialect.missing(f"{shift} % {null}")
        return f"case when {missing} then null else {made} end"


def raw_expressions(name: str, dialect, narrow: T.StructType | None = None) -> list[tuple[str, str]]:
    """Column name and expression of every raw column, ingestion columns included, or of the
    columns and nested fields in ``narrow``."""
    spec = SPECS[name]
    walk = _Walk(dialect, spec)
    meta = {"_batch_user_id": dialect.user(), "_batch_runtime": "rt", "_batch_id": "v + 100"}
    kinds = {field.name: field.dataType for field in narrow or raw_type(spec)}
    columns = []
    for field in raw_type(spec):
        text = meta.get(field.name) or walk.value(field.name, field.dataType, wanted=kinds.get(field.name))
        columns.append((field.name, text))
    return [column for column in columns if column[0] in kinds]


def _source_rule(brand: str) -> str:
    if brand == "Acme":
        return "(n % 2 = 0 or n % 10 = 5)"
    return "(n % 2 = 1 and (n % 10 <> 5 or v = 0))"


# Row numbers that one task turns into raw rows, ranks and flattens. Nested ones take some
# kilobytes each; a task spends 0.3 s on the expressions of a feed alone. The orders' twenty
# arrays take 1 ms a number.
NUMBERS_PER_TASK = 25_000
FEWER_PER_TASK = {"m12_orders": 10_000}

# Feeds whose base table repeats most row numbers: an order's for each of its lines.
REPEATING = {"m18_returns", "m19_returns_order_lines"}

DELIVERED = "(v = 0 or (v = 1 and n % 3 = 0) or (v = 2 and n % 7 = 0)) and (t = 0 or n % 11 = 0)"


def dealing_key(name: str) -> str | None:
    """The raw column that the numbers of a feed are dealt by: its second business key.

    It tells the numbers apart, as the first does, but is never NULL: rows without a first key
    would gather in one task. None for feeds whose second key is no raw column.
    """
    spec = SPECS[name]
    sources = {output.name.lower(): output.source for output in spec.outputs}
    columns = {field.name.lower(): field.name for field in spec.raw_schema}
    return columns.get(sources[spec.keys[1].lower()].lower()) if len(spec.keys) > 1 else None


def raw_frame(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    brand: str,
    batches: int = 3,
    files: int | None = None,
    arrays: Callable[[Column], Column] | None = None,
    narrow: T.StructType | None = None,
) -> DataFrame:
    """One raw table: the first ``batches`` deliveries of one source of one feed.

    ``files`` spreads the row numbers over that many tasks, to write as many files. Without
    it they are dealt by a business key, before they are widened, over tasks that grow in
    number with the table: a row group has a million numbers in a few bytes each, which one
    task would turn into gigabytes of raw rows. Spark then knows that all deliveries of a key
    meet in one task and ranks them there, so that raw rows are not sent at all. Feeds without
    such a key are dealt by number. The count is read from the footers.

    Equal numbers give equal rows: where many are equal, each is widened once and its rows
    are repeated. ``arrays`` turns nested columns into the form they are delivered in, and
    ``narrow`` names the columns and nested fields that are asked for.
    """
    table, number, rows = BASES.get(name, ITEM)
    stored = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    numbered = stored.where(rows).select(F.expr(f"cast({number} as bigint)").alias("n"))
    kinds = {field.name: field.dataType for field in narrow or raw_type(SPECS[name])}
    columns = {
        column: F.expr(text).cast(kinds[column]) for column, text in raw_expressions(name, Spark(), narrow)
    }
    dealt = [key for key in [dealing_key(name)] if key in kinds]
    if arrays is not None:
        columns |= {
            column: arrays(value) for column, value in columns.items() if isinstance(kinds[column], T.ArrayType)
        }
    each = FEWER_PER_TASK.get(name, NUMBERS_PER_TASK)
    tasks = -(-stored.count() // each) if files is None else 1
    repeated = tasks > 1 and bool(dealt) and name in REPEATING
    if files is not None:
        numbered = numbered.repartition(files)
    elif tasks > 1:
        numbered = numbered.withColumns({key: columns[key] for key in dealt})
        numbered = numbered.repartition(tasks, *(dealt or ["n"]))
        columns |= {key: F.col(key) for key in dealt}
    if repeated:
        numbered = numbered.groupBy("n", *dealt).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    deliveries = [
        F.struct(
            F.lit(v).alias("v"), F.lit(BATCHES[v]).cast("bigint").alias("rt"), F.lit(t).alias("t")
        )
        for v in range(batches)
        for t in (0, 1)
    ]
    spread = numbered.select("*", F.inline(F.array(*deliveries)))
    kept = spread.where(f"{DELIVERED} and {_source_rule(brand)}")
    rows = kept.withColumn("d", F.expr("v + 10 * t"))
    rows = rows.withColumns({total: F.expr(text) for total, text in SUMS.items()})
    wide = [column.alias(name) for name, column in columns.items()]
    if not repeated:
        return rows.select(*wide)
    rows = rows.select("copies", *wide).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return rows.drop("copies", "copy")


def source_name(name: str, brand: str) -> str:
    prefix = {brand: prefix for prefix, brand in SOURCES.items()}[brand]
    return prefix + SPECS[name].feed


def registry(spark: SparkSession, sf_dir: str, name: str, batches: int = 3) -> Registry:
    """Both sources of one feed; nested fields that nobody asks for are not made."""
    frames = {b: raw_frame(spark, sf_dir, name, b, batches) for b in STORES}
    return Registry(
        SourceTable(
            source_name(name, b),
            lambda _spark, df=df: df,
            load_narrow=lambda _spark, kind, b=b: raw_frame(spark, sf_dir, name, b, batches, narrow=kind),
            dealt_by=dealing_key(name),
        )
        for b, df in frames.items()
    )


def rates_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of 28 days against USD, and a second CAD rate (from EUR) on day 4."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    days = parts.select(F.expr("cast(p_partkey % 28 as int)").alias("day")).distinct()
    quotes = F.expr(
        "array(named_struct('f', 'USD', 't', 'CAD', 'x', 1.35D),"
        " named_struct('f', 'USD', 't', 'INR', 'x', 83.0D),"
        " named_struct('f', 'EUR', 't', 'CAD', 'x', 1.47D))"
    )
    rows = days.select("day", F.inline(quotes)).where("f = 'USD' or day = 4")
    return rows.select(
        F.expr("date_add(date'2024-01-01', day)").alias("date"),
        F.col("f").alias("from_currency_code"),
        F.col("t").alias("to_currency_code"),
        F.col("x").cast("decimal(38,9)").alias("value"),
    )


RATES_SQL = """
    select date '2024-01-01' + day as date, f as from_currency_code,
           t as to_currency_code, cast(x as decimal(38,9)) as value
    from (select distinct cast(p_partkey % 28 as integer) as day from part) days
    cross join (values ('USD', 'CAD', 1.35), ('USD', 'INR', 83.0), ('EUR', 'CAD', 1.47)) q(f, t, x)
    where f = 'USD' or day = 4"""


def raw_sql(name: str, brand: str, batches: int = 3) -> str:
    """DuckDB twin of :func:`raw_frame`, with the source tags in front."""
    table, number, rows = BASES.get(name, ITEM)
    deliveries = ", ".join(
        f"({v}, {BATCHES[v]}::bigint, {t})" for v in range(batches) for t in (0, 1)
    )
    columns = ", ".join(f'{text} as "{column}"' for column, text in raw_expressions(name, Duck()))
    return f"""
    select '{brand}' as s_brand, '{STORES[brand]}' as s_store,
           '{source_name(name, brand)}' as s_source, {columns}
    from (select n, v, rt, v + 10 * t as d
          from (select cast({number} as bigint) as n from {table} where {rows}) base
          cross join (values {deliveries}) delivery(v, rt, t)
          where {DELIVERED} and {_source_rule(brand)}) numbered"""
