"""Raw values as their declared types, whatever type a store delivers them in.

A store may hold a number as text, a date as a timestamp, an array as JSON text or as a
variant, and may lack nested fields. Values are converted field by field; those that cannot
be read are NULL, and :func:`unreadable` tells where that happens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.nested import computed, quoted

NESTED = (T.ArrayType, T.StructType)
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def same_type(found: T.DataType, declared: T.DataType) -> bool:
    """Whether a value can be used as it is; nullability does not matter."""
    if isinstance(found, T.ArrayType) and isinstance(declared, T.ArrayType):
        return same_type(found.elementType, declared.elementType)
    if isinstance(found, T.StructType) and isinstance(declared, T.StructType):
        return [f.name.lower() for f in found] == [f.name.lower() for f in declared] and all(
            same_type(a.dataType, b.dataType) for a, b in zip(found, declared))
    return found == declared


def _always(found: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of one plain type can be read as the other."""
    if isinstance(declared, T.StringType):
        return True
    if type(found) in _NUMBERS and type(declared) in _NUMBERS:
        return _NUMBERS.index(type(found)) <= _NUMBERS.index(type(declared))
    return isinstance(found, _MOMENTS) and isinstance(declared, _MOMENTS)


def _plain(value: Column, found: T.DataType, declared: T.DataType) -> Column:
    if isinstance(found, NESTED):
        value, found = F.to_json(value), T.StringType()
    numbers = isinstance(found, T.NumericType) and isinstance(declared, T.NumericType)
    if not (numbers or _always(found, declared) or isinstance(found, T.StringType)):
        value = value.cast("string")
    return value.try_cast(declared)


def conformed(value: Column, found: T.DataType, declared: T.DataType) -> Column:
    """The value as its declared type; what cannot be read is NULL, deep inside as well."""
    if same_type(found, declared):
        return value
    if isinstance(found, T.VariantType):
        return F.try_variant_get(value, "$", declared.simpleString())
    if isinstance(declared, NESTED) and isinstance(found, T.StringType):
        return F.try_variant_get(F.try_parse_json(value), "$", declared.simpleString())
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return F.transform(value, lambda e: conformed(e, found.elementType, declared.elementType))
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        have = {f.name.lower(): f for f in found}
        fields = []
        for field in declared:
            own = have.get(field.name.lower())
            column = F.lit(None).cast(field.dataType) if own is None else conformed(
                value.getField(own.name), own.dataType, field.dataType)
            fields.append(column.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(declared, NESTED):
        return F.lit(None).cast(declared)
    return _plain(value, found, declared)


def _any(tests: list[Column]) -> Column | None:
    return reduce(Column.__or__, tests) if tests else None


def _in_variant(value: Column, declared: T.DataType) -> Column:
    """Whether some part of a variant is not of its declared type. Its NULLs are."""
    given = value.isNotNull() & ~F.is_variant_null(value)
    if isinstance(declared, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        inside = F.exists(items, lambda e: F.coalesce(_in_variant(e, declared.elementType), F.lit(False)))
        return given & (items.isNull() | F.coalesce(inside, F.lit(False)))
    if isinstance(declared, T.StructType):
        none = F.try_variant_get(value, "$", "map<string,variant>").isNull()
        tests = [_in_variant(F.try_variant_get(value, f"$['{f.name}']", "variant"), f.dataType) for f in declared]
        return given & (none | F.coalesce(_any(tests), F.lit(False)))
    return given & F.try_variant_get(value, "$", declared.simpleString()).isNull()


def unreadable(value: Column, found: T.DataType, declared: T.DataType) -> Column | None:
    """Whether the value, or some part of it, cannot be read; None where all values can."""
    if same_type(found, declared):
        return None
    if isinstance(found, T.VariantType):
        return F.coalesce(_in_variant(value, declared), F.lit(False))
    if isinstance(declared, NESTED) and isinstance(found, T.StringType):
        parsed = F.try_parse_json(value)
        return value.isNotNull() & (parsed.isNull() | F.coalesce(_in_variant(parsed, declared), F.lit(False)))
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        if unreadable(F.lit(None), found.elementType, declared.elementType) is None:
            return None
        return F.coalesce(F.exists(value, lambda e: unreadable(e, found.elementType, declared.elementType)), F.lit(False))
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        have = {f.name.lower(): f for f in found}
        tests = [
            unreadable(value.getField(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType)
            for f in declared if f.name.lower() in have
        ]
        return _any([test for test in tests if test is not None])
    if isinstance(declared, NESTED):
        return value.isNotNull()
    if not isinstance(found, NESTED) and _always(found, declared):
        return None
    return value.isNotNull() & conformed(value, found, declared).isNull()


def as_text(value: Column, found: T.DataType) -> Column:
    """A raw value for a person to read."""
    if isinstance(found, (*NESTED, T.VariantType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


# What happens to values that cannot be read as their declared type.
FAIL, NULL, DROP = "fail", "null", "drop"


def covers(found: T.DataType, declared: T.DataType) -> bool:
    """Whether the declared value can be read from the found one without conversion."""
    if isinstance(found, T.ArrayType) and isinstance(declared, T.ArrayType):
        return covers(found.elementType, declared.elementType)
    if isinstance(found, T.StructType) and isinstance(declared, T.StructType):
        have = {f.name.lower(): f.dataType for f in found}
        return all(f.name.lower() in have and covers(have[f.name.lower()], f.dataType) for f in declared)
    return found == declared


def differing(df: DataFrame, declared: T.StructType, exact: bool) -> dict[str, tuple[T.DataType, T.DataType]]:
    """Columns, by the raw table's name, whose types need conversion: found and declared.

    ``exact`` also asks for conversion where only further nested fields were found.
    """
    wanted = {field.name.lower(): field.dataType for field in declared}
    fits = same_type if exact else covers
    return {
        field.name: (field.dataType, wanted[field.name.lower()]) for field in df.schema
        if field.name.lower() in wanted and not fits(field.dataType, wanted[field.name.lower()])
    }


def _texts_parsed(df: DataFrame, kinds: dict[str, tuple[T.DataType, T.DataType]]) -> tuple[DataFrame, dict]:
    """JSON texts as variants, parsed once; and whether a text could not be parsed."""
    texts = [n for n, (found, declared) in kinds.items() if isinstance(found, T.StringType) and isinstance(declared, NESTED)]
    if not texts:
        return df, {}
    variants = {n: F.try_parse_json(quoted(n)) for n in texts}
    broken = {f"__broken_{i}": quoted(n).isNotNull() & variants[n].isNull() for i, n in enumerate(texts)}
    df = computed(df, broken | variants)
    return df, dict(zip(texts, broken))


def conform(
    df: DataFrame, declared: T.StructType, unread: str = FAIL, lenient_dates: bool = False, exact: bool = True,
    name: str = "",
) -> DataFrame:
    """The raw rows with their declared types.

    ``unread`` says what happens to a value that cannot be read: the query fails, the value
    is NULL, or its row is dropped. With ``lenient_dates``, dates given as text stay text,
    where all tables give them so, and are NULL otherwise.
    """
    if unread not in (FAIL, NULL, DROP):
        raise ValueError(f"unreadable values: {FAIL!r}, {NULL!r} or {DROP!r}, not {unread!r}")
    kinds = differing(df, declared, exact)
    if lenient_dates and not exact:
        kinds = {n: (f, d) for n, (f, d) in kinds.items() if not (isinstance(f, T.StringType) and isinstance(d, _MOMENTS))}
    if not kinds:
        return df
    if unread == FAIL:
        columns = {n: _strict(quoted(n), f, d, f"{name}.{n}", lenient_dates) for n, (f, d) in kinds.items()}
        return computed(df, columns)
    names = df.columns
    df, broken = _texts_parsed(df, kinds)
    kinds = {n: (T.VariantType() if n in broken else f, d) for n, (f, d) in kinds.items()}
    if unread == DROP:
        tests = [t for n, (f, d) in kinds.items() if not _excused(d, lenient_dates) and (t := unreadable(quoted(n), f, d)) is not None]
        tests += [F.col(flag) for flag in broken.values()]
        df = df.where(~_any(tests)) if tests else df
    columns = {n: conformed(quoted(n), f, d) for n, (f, d) in kinds.items()}
    return computed(df.select(*map(quoted, names)), columns)


def _excused(declared: T.DataType, lenient_dates: bool) -> bool:
    return lenient_dates and isinstance(declared, _MOMENTS)


def _strict(value: Column, found: T.DataType, declared: T.DataType, where: str, lenient_dates: bool) -> Column:
    if isinstance(declared, NESTED) and isinstance(found, T.StringType):
        return F.variant_get(F.parse_json(value), "$", declared.simpleString())
    if isinstance(found, T.VariantType):
        return F.variant_get(value, "$", declared.simpleString())
    out, bad = conformed(value, found, declared), unreadable(value, found, declared)
    if bad is None or _excused(declared, lenient_dates):
        return out
    text = F.concat(F.lit(f"{where}: no {declared.simpleString()}: "), as_text(value, found))
    return F.when(bad, F.raise_error(text).cast(declared)).otherwise(out)


def rejected(df: DataFrame, declared: T.StructType, keep: list[str], lenient_dates: bool = False) -> DataFrame:
    """One row for each value that cannot be read: the columns to keep, ``column``, ``value``."""
    kinds = differing(df, declared, exact=True)
    df = df.withColumns({f"__text_{i}": as_text(quoted(n), f) for i, (n, (f, _)) in enumerate(kinds.items())})
    df, broken = _texts_parsed(df, kinds)
    found = []
    for i, (n, (f, d)) in enumerate(kinds.items()):
        test = unreadable(quoted(n), T.VariantType() if n in broken else f, d)
        test = F.col(broken[n]) | test if n in broken else test
        if test is not None and not _excused(d, lenient_dates):
            found.append(F.when(test, F.struct(F.lit(n).alias("column"), F.col(f"__text_{i}").alias("value"))))
    nothing = F.lit(None).cast("struct<column:string,value:string>")
    return df.select(*map(quoted, keep), F.inline(F.filter(F.array(*found, nothing), lambda x: x.isNotNull())))
