"""Exchange rates: attaching them to rows and converting amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import as_date

RATE = "exchange_currency_rate"
CODE = "exchange_currency_code"
RATE_TYPE = "decimal(38,9)"
TEXT_RATE_TYPE = "decimal(38,18)"
BYTES_PER_RATE = 64
UNKNOWN_BYTES = 1 << 60  # Spark's estimates are beyond this where it knows nothing

# Pieces a rate table is copied into when it is too large to broadcast. Days times
# currencies is a small key space, so an unsalted shuffle would pile up on few tasks.
RATE_PIECES = 256


def _rate_type(rates: DataFrame) -> T.DataType | str:
    """Numbers keep their own type, and with it all their digits; text becomes a decimal
    with eighteen places."""
    given = rates.schema["value"].dataType
    return given if isinstance(given, T.NumericType) else TEXT_RATE_TYPE


def _bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of a table, without reading it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _few(table: DataFrame, most: int) -> bool:
    """Whether a table may be broadcast: by Spark's estimate of its size, or by a count up to
    the limit where there is none."""
    size = _bytes(table)
    if size < UNKNOWN_BYTES:
        return size <= most * BYTES_PER_RATE
    return most > 0 and table.limit(most + 1).count() <= most


def _rate_table(rates: DataFrame, base_currency: str | None) -> DataFrame:
    if base_currency is not None:
        rates = rates.where(F.col("from_currency_code") == base_currency)
    return rates.select(
        F.col("date").cast("date").alias("__rate_date"),
        F.col("from_currency_code").alias("__rate_from"),
        F.col("to_currency_code").alias("__rate_to"),
        F.col("value").cast(_rate_type(rates)).alias("__rate_value"),
    )


def one_rate_per_day(rates: DataFrame, base_currency: str | None = None) -> DataFrame:
    """Reduce rates to one per day and target currency, the lowest source code."""
    if base_currency is not None:
        rates = rates.where(F.col("from_currency_code") == base_currency)
    best = F.min_by(
        F.struct("from_currency_code", "value"), F.struct("from_currency_code", "value")
    )
    days = rates.withColumn("date", F.col("date").cast("date"))
    return (
        days.groupBy("date", "to_currency_code")
        .agg(best.alias("best"))
        .select("date", "to_currency_code", "best.from_currency_code", "best.value")
    )


def attach_exchange_rate(
    df: DataFrame,
    rates: DataFrame,
    date_col: Column | str,
    currency_col: Column | str,
    base_currency: str | None = None,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """Left join of the day's rate to each row's currency.

    Numeric rates keep their type. A row without a rate gets rate 1 and its own currency
    code; several source currencies for one day and target multiply the row, unless
    ``base_currency`` restricts them.

    Rates are broadcast up to a limit; beyond it the rows are salted and the rates copied
    once per salt. Spark's estimate of their size decides, so nothing is run to plan the
    join; only rates without an estimate (frames made from local rows) are counted, up to
    the limit.
    """
    local = F.col(currency_col) if isinstance(currency_col, str) else currency_col
    keyed = df.withColumns({"__fx_day": as_date(date_col), "__fx_local": local})
    table = _rate_table(rates, base_currency)
    match = (F.col("__fx_day") == F.col("__rate_date")) & (
        F.col("__fx_local") == F.col("__rate_to")
    )
    if _few(table, broadcast_rows):
        joined = keyed.join(F.broadcast(table), match, "left")
    else:
        pieces = F.sequence(F.lit(0), F.lit(RATE_PIECES - 1))
        copies = table.withColumn("__rate_piece", F.explode(pieces))
        keyed = keyed.withColumn(
            "__fx_piece", F.pmod(F.spark_partition_id(), F.lit(RATE_PIECES))
        )
        joined = keyed.join(
            copies, match & (F.col("__fx_piece") == F.col("__rate_piece")), "left"
        )
    return joined.select(
        *[F.col(name) for name in df.columns],
        F.coalesce("__rate_value", F.lit(1).cast(_rate_type(rates))).alias(RATE),
        F.coalesce("__rate_from", "__fx_local").alias(CODE),
    )


def without_exchange_rate(df: DataFrame, currency_col: Column | str | None) -> DataFrame:
    """The same two columns when conversion is off: rate 1 and the local code."""
    if currency_col is None:
        code = F.lit(None).cast("string")
    else:
        code = F.col(currency_col) if isinstance(currency_col, str) else currency_col
    return df.withColumns({RATE: F.lit(1).cast(RATE_TYPE), CODE: code})


def convert_amounts(df: DataFrame, columns: list[str], suffix: str = "_converted") -> DataFrame:
    """Local amounts divided by the attached rate, next to the originals; a rate of zero
    converts nothing and gives NULL."""
    rate = F.when(F.col(RATE) != 0, F.col(RATE).cast("double"))
    return df.withColumns(
        {name + suffix: F.col(name).cast("double") / rate for name in columns}
    )
