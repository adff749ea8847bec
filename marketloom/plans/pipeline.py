"""From raw tables to one unified table.

The logical order is: scan, look-back, project, unnest, exchange rates, dedup. The
plan keeps its result but moves the dedup down, to just above the arrays that the
business key needs: whether a row survives depends on its key and batch alone, and
neither the other arrays nor the rates change those. So what is shuffled are nested
rows, not the product of all their arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import as_date, datetime_add, epoch_ms_to_date
from marketloom.operators import (
    attach_exchange_rate,
    consolidate,
    first_of_path,
    latest,
    one_rate_per_day,
    prune_type,
    quoted,
    split_products,
    unnest_path,
    with_elements,
    without_copies,
    without_exchange_rate,
)
from marketloom.operators.exchange import CODE, RATE
from marketloom.operators.nested import POSITION
from marketloom.operators.timezone import is_datetime, shift_timezone
from marketloom.plans.spec import BATCH_DATE, FeedSpec, Output, record
from marketloom.settings import Lineage, Settings
from marketloom.sinks import exists, recover, upsert, write_table
from marketloom.sources import (
    BRAND,
    FAIL,
    HOURS,
    SOURCE,
    STORE,
    Registry,
    Scan,
    SourceTable,
    rejected,
    scans,
    tag_source,
)
from marketloom.streaming.incremental import stored_mark

LOAD_STAMP = "_last_updated"
RUN_ID = "_run_id"


def raw_type(spec: FeedSpec, lineage: Lineage = Lineage()) -> T.StructType:
    """Declared schema of a raw table, ingestion columns included."""
    user, runtime, batch = lineage.names
    meta = record(f"{user} string, {runtime} bigint, {batch} bigint")
    return T.StructType([*spec.raw_schema, *meta])


def business_key(spec: FeedSpec, settings: Settings) -> list[str]:
    """Key columns of the unified table."""
    return [*(("brand", "store") if settings.lineage_in_key else ()), *spec.keys]


def key_paths(spec: FeedSpec) -> tuple[str, ...]:
    """The arrays to unnest before the business key of a row is known."""
    source = {output.name.lower(): output.source for output in spec.outputs}
    by_alias = {path.rpartition(".")[2]: path for path in spec.unnest}
    needed: set[str] = set()
    for key in spec.keys:
        alias = source[key.lower()].partition(".")[0]
        while alias in by_alias and by_alias[alias] not in needed:
            needed.add(by_alias[alias])
            alias = by_alias[alias].partition(".")[0]
    return tuple(path for path in spec.unnest if path in needed)


def raw_paths(spec: FeedSpec, outputs: Iterable[Output]) -> list[str]:
    """Dotted paths inside the raw rows that the given outputs are read from."""
    roots: dict[str, str] = {}
    for path in spec.unnest:
        parent, _, field = path.rpartition(".")
        roots[field] = f"{roots[parent]}.{field}" if parent else field
    paths = []
    for output in outputs:
        if output.source == BATCH_DATE:
            continue
        alias, _, field = output.source.partition(".")
        paths.append(f"{roots[alias]}.{field}" if field else alias)
    return paths


class _Projection:
    """Output expressions of a feed over its (partly) unnested rows."""

    def __init__(self, settings: Settings):
        self.settings = settings

    def columns(self, df: DataFrame, outputs: Iterable[Output]) -> list[Column]:
        kinds: dict[str, str] = dict(df.dtypes) if self.settings.tz_offsets else {}
        columns = []
        for output in outputs:
            if output.source == BATCH_DATE:
                column = epoch_ms_to_date(quoted(self.settings.lineage.runtime))
            else:
                column = quoted(output.source)
                # Top-level date-times were shifted when the source was tagged.
                if "." in output.source and is_datetime(kinds.get(output.source, "")):
                    column = datetime_add(column, F.col(HOURS), "HOUR")
            if output.cast == "date":
                column = as_date(column, self.settings.lenient_dates)
            elif output.cast:
                column = column.cast(output.cast)
            columns.append(column.alias(output.name))
        return columns


def _completed(found: T.DataType, declared: T.DataType) -> T.DataType:
    """The type found in a raw table, with the declared nested fields that it lacks."""
    if isinstance(found, T.ArrayType) and isinstance(declared, T.ArrayType):
        return T.ArrayType(_completed(found.elementType, declared.elementType))
    if isinstance(found, T.StructType) and isinstance(declared, T.StructType):
        wanted = {field.name.lower(): field for field in declared}
        have = {field.name.lower() for field in found}
        fields = [
            T.StructField(f.name, _completed(f.dataType, wanted[f.name.lower()].dataType))
            if f.name.lower() in wanted else f
            for f in found
        ]
        return T.StructType(fields + [f for f in declared if f.name.lower() not in have])
    return found


def _lacks_fields(found: T.StructType, declared: T.StructType) -> bool:
    """Whether some array of the table misses declared fields of its elements."""
    types = {field.name.lower(): field.dataType for field in found}
    return any(
        isinstance(types.get(field.name.lower()), T.ArrayType)
        and len(_leaves(_completed(types[field.name.lower()], field.dataType)))
        > len(_leaves(types[field.name.lower()]))
        for field in declared
    )


def _leaves(kind: T.DataType) -> list[str]:
    if isinstance(kind, T.ArrayType):
        return _leaves(kind.elementType)
    if isinstance(kind, T.StructType):
        return [field.name for field in kind] + [x for field in kind for x in _leaves(field.dataType)]
    return []


def _narrowed(
    spark: SparkSession, scan: Scan, pruned: T.StructType, paths: list[str], settings: Settings
) -> DataFrame:
    """The rows of a scan without the nested fields that nobody asks for."""
    nested = any("." in path for path in paths)
    if not (scan.narrows and (nested or len(scan.tables) > 1 or _lacks_fields(scan.schema, pruned))):
        return scan.load(spark)
    kinds = {field.name.lower(): field.dataType for field in pruned}
    bare = [name.removeprefix("_") for name in settings.lineage.names]
    narrow = prune_type(scan.schema, [*paths, *settings.lineage.names, *bare])
    return scan.load(spark, T.StructType([
        T.StructField(f.name, _completed(f.dataType, kinds.get(f.name.lower(), f.dataType)))
        for f in narrow
    ]))


def _tagged_rows(
    spark: SparkSession,
    spec: FeedSpec,
    found: list[Scan],
    settings: Settings,
    mark: int | None,
    outputs: Iterable[Output],
) -> DataFrame:
    """All sources of a feed, narrowed to what the outputs need, tagged and united.

    Stores may lack declared columns or nested fields, which are NULL, and deliver columns
    in other types, which are converted.
    """
    paths = raw_paths(spec, outputs)
    heads = {path.partition(".")[0].lower() for path in paths}
    pruned = prune_type(raw_type(spec, settings.lineage), paths)
    declared = T.StructType([f for f in pruned if f.name.lower() in heads])
    loaded = [_narrowed(spark, scan, pruned, paths, settings) for scan in found]
    kinds = [{f.name.lower(): f.dataType.simpleString() for f in df.schema if f.name.lower() in heads} for df in loaded]
    frames = [
        tag_source(
            df, scan.tables[0], declared, settings, mark, scan.tables if len(scan.tables) > 1 else (),
            exact=any(kind != kinds[0] for kind in kinds))
        for scan, df in zip(found, loaded)
    ]
    rows = consolidate(frames)
    if settings.tz_offsets:
        local = [name for name, kind in rows.dtypes if is_datetime(kind)]
        rows = shift_timezone(rows, local, F.col(HOURS))
    return rows


def rejected_values(
    spark: SparkSession,
    spec: FeedSpec,
    registry: Registry,
    mark: int | None = None,
    settings: Settings = Settings(),
    schema: str | None = None,
    catalog: str | None = None,
) -> DataFrame:
    """Raw values that cannot be read as their declared type, one row each: the source
    table, the ingestion columns, the raw column and its value as text."""
    frames, names = [], [SOURCE, *settings.lineage.names]
    tags = replace(settings, unreadable="null", tz_offsets={}, brand_from_name=False, store_from_name=False)
    tables = registry.match(spec.like, spec.not_like, schema, catalog)
    for scan in scans(spark, tables) if tables else ():
        raw = scan.load(spark)
        # The raw columns keep their own types here.
        wanted = {field.name.lower() for field in spec.raw_schema}
        as_found = T.StructType([f for f in raw.schema if f.name.lower() in wanted])
        among = scan.tables if len(scan.tables) > 1 else ()
        tagged = tag_source(raw, scan.tables[0], as_found, tags, mark, among)
        frames.append(rejected(tagged, spec.raw_schema, names, settings.lenient_dates))
    empty = f"{SOURCE} string, {', '.join(f'{n} {t}' for n, t in zip(names[1:], ('string', 'bigint', 'bigint')))}"
    out = consolidate(frames) if frames else spark.createDataFrame([], f"{empty}, column string, value string")
    return out.withColumnRenamed(SOURCE, "source")


def _keyed_rows(
    rows: DataFrame,
    keys: list[Output],
    paths: Iterable[str],
    settings: Settings,
    late: Iterable[str],
    passed: Iterable[str] = (),
    positions: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Rows unnested as far as ``paths`` say, and the names of the business key columns.

    Inner unnesting drops rows, and whether it does has to be known before the dedup: so
    the arrays that are left for later are tested here, but not multiplied out. A key that
    is a raw column is used as it is, so that it is not shuffled twice.
    """
    rows = unnest_path(rows, paths, settings.outer_unnest, keep=passed, positions=positions)
    rows = rows if settings.outer_unnest else with_elements(rows, late)
    columns = _Projection(settings).columns(rows, keys)
    names, derived = [], {}
    for i, (key, column) in enumerate(zip(keys, columns)):
        plain = key.cast is None and key.source != BATCH_DATE and not settings.tz_offsets
        names.append(key.source if plain else f"__key_{i}")
        if not plain:
            derived[names[-1]] = column
    rows = rows.withColumns(derived) if derived else rows
    return rows, [BRAND, STORE, *names] if settings.lineage_in_key else names


def _all_columns_break(df: DataFrame, skip: set[str]) -> list[Column]:
    """Tie break over a whole row: its own scalar columns, positions of its elements, then
    their scalars and a hash of what is still nested, for raw rows that differ there only."""
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    fields = [field for field in df.schema if field.name not in skip]
    places = [field.name for field in fields if field.name.startswith(POSITION)]
    fields = [field for field in fields if field.name not in places]
    scalars = [f.name for f in fields if not isinstance(f.dataType, nested)]
    others = [f.name for f in fields if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    breaks = [quoted(name).asc_nulls_last() for name in scalars if "." not in name]
    breaks += [F.coalesce(quoted(name), F.lit(0)).asc() for name in places]
    breaks += [quoted(name).asc_nulls_last() for name in scalars if "." in name]
    return breaks + ([F.xxhash64(*[quoted(name) for name in others])] if others else [])


def unify(
    spark: SparkSession,
    spec: FeedSpec,
    registry: Registry,
    rates: DataFrame | None = None,
    mark: int | None = None,
    settings: Settings = Settings(),
    schema: str | None = None,
    catalog: str | None = None,
) -> DataFrame:
    """The unified rows of one feed: all of them, or those from ``mark`` on.

    ``schema`` and ``catalog`` restrict the raw tables to those of one schema or catalog.
    """
    found = registry.match(spec.like, spec.not_like, schema, catalog)
    if not found:
        return spark.createDataFrame([], output_schema(spark, spec, settings))
    tables = scans(spark, found)
    lineage = settings.lineage
    project = _Projection(settings)
    by_name = {output.name.lower(): output for output in spec.outputs}

    keys = [by_name[key.lower()] for key in spec.keys]
    early = key_paths(spec)
    late = [path for path in spec.unnest if path not in early]
    breaks = [Output(path, path) for path in spec.tie_break]
    contract = [*spec.outputs, *spec.after_batch_id, *breaks]
    rows = _tagged_rows(spark, spec, tables, settings, mark, contract)
    if spec.ties == "one" and early and all(table.dealt_by for table in found):
        # Of copies one row is kept anyway; here they are found without a shuffle, before they multiply.
        rows = without_copies(rows)
    passed = {output.source for output in spec.outputs}
    rows, names = _keyed_rows(
        rows, keys, early, settings, late, passed, positions=spec.ties == "one"
    )
    key_rows = None
    if spec.ties == "all" and early:
        # Inner unnesting also looks at the arrays that hold no others.
        parents = {path.partition(".")[0] for path in spec.unnest if "." in path}
        tested = [Output(p, p) for p in late if p.rpartition(".")[2] not in parents]
        tested = [] if settings.outer_unnest else tested
        slim = _tagged_rows(spark, spec, tables, settings, mark, [*keys, *tested])
        key_rows, _ = _keyed_rows(slim, keys, early, settings, late)
    tie_break = ()
    if spec.ties == "one":
        skip = {*names, lineage.runtime, HOURS}
        tie_break = [*[quoted(path).asc_nulls_last() for path in spec.tie_break],
                     *_all_columns_break(rows, skip)]
    rows = latest(
        rows,
        names,
        lineage.runtime,
        ties=spec.ties,
        tie_break=tie_break,
        scope=spec.scope,
        source_col=SOURCE,
        hot_rows=settings.hot_key_rows,
        key_rows=key_rows,
    )

    if spec.ties == "all" and settings.split_product_rows:
        rows = split_products(rows, late, settings.split_product_rows, [SOURCE, *names], passed)
    flatten = first_of_path if spec.ties == "one" else unnest_path
    flat = flatten(rows, late, settings.outer_unnest, keep=passed)
    return _finish(flat, spec, rates, settings, project)


def audit_columns(settings: Settings) -> list[Column]:
    """Load stamp and run id of a run."""
    stamp = F.current_timestamp() if settings.run_ts is None else F.lit(settings.run_ts)
    return [stamp.alias(LOAD_STAMP), F.lit(settings.run_id).alias(RUN_ID)]


def _finish(
    flat: DataFrame,
    spec: FeedSpec,
    rates: DataFrame | None,
    settings: Settings,
    project: _Projection,
) -> DataFrame:
    """Project the output contract and add rates and audit columns."""
    lineage = settings.lineage
    after = spec.after_batch_id
    business = [output.name for output in spec.outputs]
    out = flat.select(
        F.col(BRAND).alias("brand"),
        F.col(STORE).alias("store"),
        *project.columns(flat, spec.outputs),
        *lineage.names,
        *project.columns(flat, after),
    )
    rate_columns: list[str] = []
    if spec.fx is not None:
        rate_columns = [RATE, CODE]
        if rates is not None:
            if spec.ties == "one":
                rates = one_rate_per_day(rates, settings.base_currency)
            out = attach_exchange_rate(
                out, rates, spec.fx.date, spec.fx.currency, settings.base_currency,
                broadcast_rows=settings.broadcast_rate_rows,
            )
        else:
            currency = None if spec.fx.null_code_when_off else spec.fx.currency
            out = without_exchange_rate(out, currency)
    leading = rate_columns if spec.fx is not None and spec.fx.leading else []
    trailing = [] if leading else rate_columns
    return out.select(
        "brand",
        "store",
        *leading,
        *business,
        *trailing,
        *lineage.names,
        *[output.name for output in after],
        *audit_columns(settings),
    )


def output_schema(spark: SparkSession, spec: FeedSpec, settings: Settings = Settings()) -> T.StructType:
    """Schema of a feed's unified table, from its declared raw types."""
    raw = spark.createDataFrame([], raw_type(spec, settings.lineage))
    table = SourceTable("raw", lambda _spark: raw)
    bare = Settings(
        lineage=settings.lineage, brand_from_name=False, store_from_name=False,
        run_ts=settings.run_ts, run_id=settings.run_id,
    )
    rows = tag_source(table.load(spark), table, spec.raw_schema, bare)
    flat = unnest_path(rows, spec.unnest, keep={output.source for output in spec.outputs})
    return _finish(flat, spec, None, bare, _Projection(bare)).schema


def run(
    spark: SparkSession,
    spec: FeedSpec,
    registry: Registry,
    target: str,
    rates: DataFrame | None = None,
    settings: Settings = Settings(),
    full_refresh: bool = False,
    null_safe: bool = False,
    strict: bool = False,
    schema: str | None = None,
    catalog: str | None = None,
    rejects: str | None = None,
) -> None:
    """Load one feed into the table at ``target``, incrementally when it exists.

    What an interrupted load has left is finished or removed first. The values that cannot
    be read as their declared type are added to the table at ``rejects``, if that is given,
    with the stamp and id of the run.
    """
    recover(spark, target)
    if rejects is not None and settings.unreadable != FAIL:
        bad = rejected_values(spark, spec, registry, None, settings, schema, catalog)
        bad.select("*", *audit_columns(settings)).write.mode("append").parquet(rejects)
    if full_refresh or not exists(spark, target):
        rows = unify(spark, spec, registry, rates, None, settings, schema, catalog)
        write_table(rows, target, spec.sink)
        return
    mark = stored_mark(spark, target, settings.lineage.runtime, settings.lookback_ms)
    updates = unify(spark, spec, registry, rates, mark, settings, schema, catalog)
    upsert(
        updates, target, business_key(spec, settings), spec.sink,
        null_safe=null_safe, strict=strict, hot_rows=settings.hot_key_rows,
    )


def run_all(
    spark: SparkSession,
    specs: Iterable[FeedSpec],
    registry: Registry,
    targets: Mapping[str, str],
    rates: DataFrame | None = None,
    settings: Settings = Settings(),
    concurrent: int = 4,
    full_refresh: bool = False,
    null_safe: bool = False,
    strict: bool = False,
    schema: str | None = None,
    catalog: str | None = None,
) -> None:
    """Load several feeds; they are independent, so a few jobs are submitted at a time."""
    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        jobs = [
            pool.submit(
                run, spark, spec, registry, targets[spec.name], rates, settings,
                full_refresh, null_safe, strict, schema, catalog,
            )
            for spec in specs
        ]
        for job in jobs:
            job.result()
