"""DuckDB statements for the pipelines, in their plain order: union, unnest everything,
join rates, rank, filter. Nothing of the rearranged Spark plan is repeated here."""

from __future__ import annotations

from pyspark.sql import types as T

from fixtures.raw import RATES_SQL, SPECS, STORES, raw_sql
from marketloom.plans.pipeline import key_paths, raw_paths, raw_type
from marketloom.plans.spec import BATCH_DATE, FeedSpec, Output

META = ("_batch_user_id", "_batch_runtime", "_batch_id")
AUDIT = "timestamp '2024-03-01 00:00:00' as _last_updated, 'manual' as _run_id"

# Nested columns that pass through are compared whole, as text that both engines write alike.
RENDERED = {
    "m12_orders": ("tax",),
    "m18_returns": ("returnOrderLines",),
    "m19_returns_order_lines": ("tax",),
}


def nested_type(name: str, column: str) -> T.DataType:
    """Declared type of a nested output column."""
    output = next(output for output in SPECS[name].outputs if output.name == column)
    kind: T.DataType = SPECS[name].raw_schema
    for field in raw_paths(SPECS[name], [output])[0].split("."):
        kind = (kind.elementType if isinstance(kind, T.ArrayType) else kind)[field].dataType
    return kind


def rendered(kind: T.DataType, value: str, duck: bool, depth: int = 0) -> str:
    """SQL text of a nested value, all fields of all elements included."""
    if isinstance(kind, T.StructType):
        dot = '."{}"' if duck else ".`{}`"
        fields = [rendered(f.dataType, value + dot.format(f.name), duck, depth) for f in kind]
        return "concat('{', " + ", ',', ".join(fields) + ", '}')"
    if isinstance(kind, T.ArrayType):
        each = f"e{depth}"
        body = rendered(kind.elementType, each, duck, depth + 1)
        if duck:
            joined = f"array_to_string([{body} for {each} in {value}], ';')"
        else:
            joined = f"array_join(transform({value}, {each} -> {body}), ';')"
        return f"case when {value} is null then '~' else concat('[', {joined}, ']') end"
    return f"coalesce(cast({value} as {'varchar' if duck else 'string'}), '~')"


def expression(output: Output, cast: str = "cast") -> str:
    if output.source == BATCH_DATE:
        return "cast(epoch_ms(_batch_runtime) as date)"
    text = ".".join(f'"{part}"' for part in output.source.split("."))
    return f"{cast}({text} as {output.cast})" if output.cast else text


def _unnested(spec: FeedSpec, raw: str, outer: bool, first: bool) -> tuple[str, list[str]]:
    """All arrays unnested, with the position of every element.

    ``first`` takes only the first element of arrays whose elements decide nothing but the
    last of the ties: where one row per key is kept, that row has first elements of them.
    """
    body, positions = raw, []
    for step, path in enumerate(spec.unnest):
        alias = path.rpartition(".")[2]
        ref = ".".join(f'"{part}"' for part in path.split("."))
        if first and spec.ties == "one" and path not in key_paths(spec):
            ref = f"{ref}[1:1]"
        exclude = f' exclude ("{alias}")' if "." not in path else ""
        array = f"case when coalesce(len({ref}), 0) = 0 then [null] else {ref} end" if outer else ref
        position = f"p{step}"
        positions.append(position)
        body = (
            f'select *{exclude}, unnest({array}) as "{alias}",'
            f" unnest(range(greatest(coalesce(len({ref}), 0), {1 if outer else 0}))) as {position}"
            f" from ({body})"
        )
    return body, positions


def pipeline_sql(
    name: str,
    rates: bool = False,
    batches: int = 3,
    since: int | None = None,
    outer: bool = True,
    lineage_in_key: bool = False,
    replace: str | None = None,
    rates_sql: str = RATES_SQL,
    only: str | None = None,
    first: bool = False,
) -> str:
    """Result of one pipeline over its derived raw tables.

    ``replace`` gives raw columns other values; casts are lenient then. ``only`` is a
    condition on raw rows. ``first``: see :func:`_unnested`.
    """
    spec = SPECS[name]
    raw = " union all ".join(raw_sql(name, brand, batches) for brand in STORES)
    cast = "cast"
    if replace is not None:
        raw, cast = f"select * replace ({replace}) from ({raw})", "try_cast"
    if only is not None:
        raw = f"select * from ({raw}) where {only}"
    body, positions = _unnested(spec, raw, outer, first)
    where = f"where _batch_runtime >= {since}" if since is not None else ""
    by_name = {output.name.lower(): output for output in spec.outputs}

    rate_columns, join = "", ""
    if spec.fx is not None:
        currency = expression(by_name[spec.fx.currency.lower()])
        if rates:
            day = expression(by_name[spec.fx.date.lower()])
            join = (
                "left join (select date as c_date, to_currency_code as c_to, from_currency_code as"
                f" c_from, value as c_value from ({rates_sql})) c"
                f" on cast({day} as date) = c_date and {currency} = c_to"
            )
            rate_columns = (
                "case when c_value is null then cast(1 as decimal(38,9)) else c_value end"
                " as exchange_currency_rate, case when c_from is null then"
                f" {currency} else c_from end as exchange_currency_code,"
            )
        else:
            code = "cast(null as varchar)" if spec.fx.null_code_when_off else currency
            rate_columns = (
                "cast(1 as decimal(38,9)) as exchange_currency_rate,"
                f" {code} as exchange_currency_code,"
            )

    keys = [expression(by_name[key.lower()]) for key in spec.keys]
    if lineage_in_key:
        keys = ["s_brand", "s_store", *keys]
    if spec.scope == "source":
        keys = ["s_source", *keys]
    order = ["_batch_runtime desc nulls last"]
    function = "dense_rank"
    if spec.ties == "one":
        function = "row_number"
        scalars = [f.name for f in raw_type(spec)
                   if not isinstance(f.dataType, T.ArrayType) and f.name not in ("_batch_runtime",)]
        breaks = [".".join(f'"{p}"' for p in path.split(".")) for path in spec.tie_break]
        breaks += [f'"{column}"' for column in scalars] + ["s_brand", "s_store", "s_source"]
        breaks += positions + (["c_from"] if join else [])
        order += [f"{text} asc nulls last" for text in breaks]

    outputs = []
    for output in spec.outputs:
        text = expression(output, cast)
        if output.name in RENDERED.get(name, ()):
            text = rendered(nested_type(name, output.name), text, duck=True)
        outputs.append(f'{text} as "{output.name}"')
    outputs += [f'{expression(output, cast)} as "{output.name}"' for output in spec.after_batch_id]
    return f"""
    select * exclude (row_num) from (
      select s_brand as brand, s_store as store, {rate_columns} {", ".join(outputs)},
             {", ".join(META)}, {AUDIT},
             {function}() over (partition by {", ".join(keys)} order by {", ".join(order)}) as row_num
      from (select * from ({body}) {where}) u {join}
    ) ranked where row_num = 1"""
