"""Flattening of nested arrays, JSON text and variants.

All of it is row-local: no shuffle. The feeds use :func:`unnest_path`, whose result has
one flat column per struct field, called ``alias.field`` with a literal dot. Flat
columns keep the plan of twenty chained arrays free of struct extractions, which the
optimizer would otherwise move around between the generators.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


POSITION = "__position_"
# Cuts of a row are dealt together as long as they give no more rows than this.
ROWS_TOGETHER = 10_000


def quoted(name: str) -> Column:
    """Column of exactly this name, dots included."""
    return F.col(f"`{name}`")


def unnest(df: DataFrame, path: str, alias: str | None = None, outer: bool = True) -> DataFrame:
    """One row per element of the array at ``path``, as column ``alias``.

    ``outer`` keeps a row (with NULL) whose array is NULL or empty; otherwise the
    row goes. Two arrays unnested one after the other give their product per row.
    """
    explode = F.explode_outer if outer else F.explode
    return df.withColumn(alias or path.rpartition(".")[2], explode(F.col(path)))


def _element_type(types: dict[str, T.DataType], path: str) -> T.DataType:
    if path not in types:
        match = [name for name in types if name.lower() == path.lower()]
        path = match[0] if match else path
    return types[path].elementType


def _below(path: str, paths: list[str]) -> list[str]:
    """Those of ``paths`` that are read from the elements of ``path``."""
    alias = path.rpartition(".")[2]
    return [other for other in paths if "." in other and other.partition(".")[0] == alias]


def _gives_rows(array: Column, path: str, paths: list[str]) -> Column:
    """Whether an inner unnest of the array and of all arrays inside it leaves a row."""
    below = _below(path, paths)
    if not below:
        return F.coalesce(F.size(array), F.lit(0)) > 0
    return F.coalesce(F.exists(array, lambda e: _element_gives_rows(e, below, paths)), F.lit(False))


def _element_gives_rows(element: Column, below: list[str], paths: list[str]) -> Column:
    inside = [_gives_rows(element.getField(p.partition(".")[2]), p, paths) for p in below]
    return reduce(Column.__and__, inside)


def with_elements(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Rows that an inner unnest of ``paths`` would keep, with the arrays still in place."""
    paths = list(paths)
    inner = {path for outer in paths for path in _below(outer, paths)}
    tests = [_gives_rows(quoted(path), path, paths) for path in paths if path not in inner]
    return df.where(reduce(Column.__and__, tests)) if tests else df


def _step(
    df: DataFrame, types: dict[str, T.DataType], path: str, kind: str, keep: bool,
    positions: bool, below: list[str], paths: list[str],
) -> DataFrame:
    """Replace the array ``path`` by columns of its elements, or of its first element."""
    alias = path.rpartition(".")[2]
    element = _element_type(types, path)
    kept = [name for name in types if keep or name.lower() != path.lower()]
    array = quoted(path)
    if isinstance(element, T.StructType):
        names = [f"{alias}.{field.name}" for field in element]
        new_types = {name: field.dataType for name, field in zip(names, element)}
    else:
        names, new_types = [alias], {alias: element}
    if kind.startswith("first"):
        if kind == "first inner" and below:
            array = F.filter(array, lambda e: _element_gives_rows(e, below, paths))
        first = F.get(array, F.lit(0))
        if isinstance(element, T.StructType):
            new = [first.getField(field.name).alias(n) for n, field in zip(names, element)]
        else:
            new = [first.alias(alias)]
    elif isinstance(element, T.StructType):
        generate = F.inline_outer if kind == "outer" else F.inline
        if positions:
            fields = [field.name for field in element]
            array = F.transform(array, lambda e, i: F.struct(
                i.alias(POSITION), *[e.getField(name).alias(name) for name in fields]
            ))
            names, new_types = [POSITION + alias, *names], {POSITION + alias: T.IntegerType(), **new_types}
        new = [generate(array).alias(*names)]
    elif positions:
        generate = F.posexplode_outer if kind == "outer" else F.posexplode
        new_types = {POSITION + alias: T.IntegerType(), **new_types}
        new = [generate(array).alias(*new_types)]
    else:
        generate = F.explode_outer if kind == "outer" else F.explode
        new = [generate(array).alias(alias)]
    copies = {name: types[name] for name in kept}
    types.clear()
    types.update(copies)
    types.update(new_types)
    return df.select(*[quoted(name) for name in kept], *new)


def _walk(
    df: DataFrame, paths: Iterable[str], kind: str, keep: Iterable[str], positions: bool = False
) -> DataFrame:
    types = {field.name: field.dataType for field in df.schema}
    keep, paths = set(keep), list(paths)
    for path in paths:
        df = _step(df, types, path, kind, path in keep, positions, _below(path, paths), paths)
    return df


def unnest_path(
    df: DataFrame,
    paths: Iterable[str],
    outer: bool = True,
    keep: Iterable[str] = (),
    positions: bool = False,
) -> DataFrame:
    """Unnest arrays of structs in order; ``parent.child`` reads an unnested parent.

    The array column is replaced by the columns ``alias.field`` of its elements, where
    the alias is the last part of the path; arrays named in ``keep`` stay as well.
    ``positions`` adds ``__position_alias``, the place of the element in its array.
    """
    return _walk(df, paths, "outer" if outer else "inner", keep, positions)


def _rows_of(array: Column, path: str, paths: list[str]) -> Column:
    """Rows that an unnest of the array and of all arrays inside it gives, at least 1."""
    below = _below(path, paths)
    if not below:
        many = F.size(array).cast("double")
    else:
        inside = lambda e: reduce(Column.__mul__, [_rows_of(e.getField(p.partition(".")[2]), p, paths) for p in below])
        many = F.aggregate(array, F.lit(0.0), lambda total, e: total + inside(e))
    return F.greatest(F.coalesce(many, F.lit(1.0)), F.lit(1.0))


def split_products(
    df: DataFrame, paths: Iterable[str], most_rows: int, by: Iterable[str], keep: Iterable[str] = ()
) -> DataFrame:
    """Cut rows whose arrays would unnest to more than ``most_rows`` rows, and spread the cuts.

    Each cut has a slice of the row's longest array and the other arrays whole, so that
    unnesting all cuts, inner or outer, gives the same rows as unnesting the row itself.
    Rows below the limit and their empty arrays stay as they are. Cuts are dealt by the columns
    ``by`` and their number, in one shuffle of the nested rows; a row has at most as many cuts
    as its longest array has elements. Small cuts of a row stay side by side, up to
    ``ROWS_TOGETHER`` rows, so that what they have in common is compressed before it is sent.
    Arrays named in ``keep`` are part of the result and not cut.
    """
    paths, keep = list(paths), {name.lower() for name in keep}
    inner = {path for outer in paths for path in _below(outer, paths)}
    tops = [path for path in paths if path not in inner]
    cut = [path for path in tops if path.lower() not in keep]
    if not cut:
        return df
    product = reduce(Column.__mul__, [_rows_of(quoted(path), path, paths) for path in tops])
    lengths = [F.coalesce(F.size(quoted(path)), F.lit(0)) for path in cut]
    longest = F.greatest(*lengths) if len(lengths) > 1 else lengths[0]
    pieces = F.when(product > most_rows, F.least(F.ceil(product / most_rows), longest.cast("bigint"))).otherwise(1)
    places = reduce(
        lambda rest, i: F.when(lengths[i] == F.col("__longest"), i).otherwise(rest), reversed(range(len(cut))), F.lit(-1))
    rows = df.withColumns({"__longest": longest, "__cuts": F.greatest(pieces, F.lit(1)).cast("int")})
    rows = rows.withColumns({
        "__which": F.when(F.col("__cuts") > 1, places).otherwise(-1), "__each": product / F.col("__cuts")})
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("__cuts") - 1)).alias("__cut"))
    end = lambda n: F.floor(F.col("__longest").cast("bigint") * n / F.col("__cuts"))
    first = end(F.col("__cut")).cast("int")
    length = end(F.col("__cut") + 1).cast("int") - first
    slices = {path: F.when(F.col("__which") == i, F.slice(quoted(path), first + 1, length)).otherwise(quoted(path)) for i, path in enumerate(cut)}
    names = {path.lower(): column for path, column in slices.items()}
    # Slices are taken before the shuffle, so that no cut sends the whole of its longest array.
    together = F.floor(F.col("__cut") * F.col("__each") / ROWS_TOGETHER).alias("__together")
    rows = rows.select(*[names[c.lower()].alias(c) if c.lower() in names else quoted(c) for c in df.columns], together)
    # A number of partitions that is asked for is not lowered again for being few bytes.
    many = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(many, *[quoted(name) for name in by], "__together").drop("__together")


def first_of_path(
    df: DataFrame, paths: Iterable[str], outer: bool = True, keep: Iterable[str] = ()
) -> DataFrame:
    """Like :func:`unnest_path`, but keeps only the first row of each row's product.

    When one row of the product is wanted anyway, this picks the row of the first
    elements without ever building the product. Without ``outer``, elements that an
    inner unnest would drop are passed over; rows without any are the caller's to drop
    (:func:`with_elements`).
    """
    return _walk(df, paths, "first" if outer else "first inner", keep)


def prune_type(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """The schema narrowed to the given dotted paths (case ignored)."""
    wanted: dict[str, list[str]] = {}
    whole = set()
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head.lower(), [])
        if rest:
            wanted[head.lower()].append(rest)
        else:
            whole.add(head.lower())
    fields = []
    for field in schema:
        name, kind = field.name.lower(), field.dataType
        if name not in wanted:
            continue
        rest = wanted[name]
        if name not in whole and isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, T.StructType):
                kind = T.ArrayType(prune_type(kind.elementType, rest), kind.containsNull)
        fields.append(T.StructField(field.name, kind, field.nullable))
    return T.StructType(fields)


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Set columns whose values are costly, each computed once per row.

    They come out of a generator over one struct. Filters on them, such as those derived
    from an inner unnest, are not moved below a generator, so a text is not parsed again
    for each of them.
    """
    if not columns:
        return df
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    new = [name for name in columns if name not in df.columns]
    others = [quoted(name) for name in df.columns if name not in columns]
    return df.select(*others, F.inline_outer(F.array(values))).select(
        *[quoted(name) for name in [*df.columns, *new]]
    )


def read_json(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Parse JSON text columns into the given nested types (DDL), one parse per column."""
    return computed(df, {name: F.from_json(F.col(name), ddl) for name, ddl in types.items()})


def unnest_variant(df: DataFrame, column: str, alias: str, outer: bool = False) -> DataFrame:
    """Flatten JSON text whose shape is not known: array elements or object fields.

    Adds ``<alias>_pos``, ``<alias>_key`` (NULL for arrays) and the variant ``<alias>``.
    """
    parsed = df.withColumn("__variant", F.try_parse_json(F.col(column)))
    tables = df.sparkSession.tvf
    explode = tables.variant_explode_outer if outer else tables.variant_explode
    elements = explode(F.col("__variant").outer()).toDF(f"{alias}_pos", f"{alias}_key", alias)
    return parsed.lateralJoin(elements).drop("__variant")
