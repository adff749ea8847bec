"""Every pipeline and operator as a Spark query and, next to it, its DuckDB statement."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.oracle import RENDERED, nested_type, pipeline_sql, rendered
from fixtures.raw import (
    BATCHES,
    RATES_SQL,
    SPECS,
    STORES,
    rates_frame,
    raw_frame,
    raw_sql,
    registry,
    source_name,
)
from marketloom import LOOKBACK_MS, Settings
from marketloom.functions import (
    as_date,
    country_name,
    datetime_add,
    epoch_ms_to_date,
    json_field,
)
from marketloom.functions.columns import COUNTRY_BY_CODE
from marketloom.operators import (
    attach_exchange_rate,
    consolidate,
    convert_amounts,
    latest,
    read_json,
    shift_timezone,
    unnest_path,
    unnest_variant,
    without_exchange_rate,
)
from marketloom.plans import run, unify
from marketloom.plans.pipeline import audit_columns, raw_type
from marketloom.sinks import Sink, read_table, recover, scratch_folder, upsert, write_table
from marketloom.sources import Registry, discover, name_part_column, normalize_meta
from marketloom.streaming import high_water_mark, lookback_filter, merge_upsert

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = dt.datetime(2024, 3, 1)
SETTINGS = Settings(run_ts=RUN_TS)
LAST_MARK = BATCHES[2] - LOOKBACK_MS
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a Spark query together with its DuckDB statement."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def render(name: str, df: DataFrame) -> DataFrame:
    """Nested columns that pass through, as text for the comparison."""
    texts = {
        column: F.expr(rendered(nested_type(name, column), f"`{column}`", duck=False))
        for column in RENDERED.get(name, ())
    }
    return df.withColumns(texts) if texts else df


# --- The 26 pipelines ---------------------------------------------------------------


def full(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = rates_frame(spark, sf_dir) if SPECS[name].fx else None
    return render(
        name, unify(spark, SPECS[name], registry(spark, sf_dir, name), rates, settings=SETTINGS)
    )


for _name, _spec in SPECS.items():
    query(pipeline_sql(_name, rates=_spec.fx is not None), _name)(partial(full, _name))


def merged_sql(target: str, updates: str, keys: list[str], null_safe: bool = False) -> str:
    """Upsert as a plain statement: unmatched target rows and all updates."""
    same = "is not distinct from" if null_safe else "="
    match = " and ".join(f't."{key}" {same} u."{key}"' for key in keys)
    return f"""
    with target as materialized ({target}), updates as materialized ({updates})
    select * from target t where not exists (select 1 from updates u where {match})
    union all by name select * from updates"""


def incremental(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load, then a scheduled run that re-reads the look-back window and merges."""
    spec = SPECS[name]
    target = scratch_folder(spark)
    raw = registry(spark, sf_dir, name)
    rates = rates_frame(spark, sf_dir) if spec.fx else None
    run(spark, spec, raw, target, rates, SETTINGS)
    run(spark, spec, raw, target, rates, SETTINGS)
    return render(name, read_table(spark, target))


for _name in SPECS:
    _fx = SPECS[_name].fx is not None
    query(
        merged_sql(
            pipeline_sql(_name, rates=_fx, first=True),
            pipeline_sql(_name, rates=_fx, since=LAST_MARK, first=True),
            list(SPECS[_name].keys),
        ),
        f"{_name}_incr",
    )(partial(incremental, _name))


def split(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of more than two elements in all are cut and spread before they are flattened."""
    rates = rates_frame(spark, sf_dir) if SPECS[name].fx else None
    settings = Settings(run_ts=RUN_TS, split_product_rows=2)
    return render(name, unify(spark, SPECS[name], registry(spark, sf_dir, name), rates, settings=settings))


for _name in ("m06_inventory", "m12_orders"):
    query(pipeline_sql(_name, rates=SPECS[_name].fx is not None), f"{_name}_split_products")(partial(split, _name))


def json_inner(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested arrays delivered as JSON text and flattened with inner semantics."""
    frames = {
        source_name(name, brand): raw_frame(spark, sf_dir, name, brand, arrays=F.to_json)
        for brand in STORES
    }
    settings = Settings(run_ts=RUN_TS, outer_unnest=False)
    return render(
        name, unify(spark, SPECS[name], Registry.from_frames(frames), settings=settings)
    )


for _name in (
    "m06_inventory", "m12_orders", "m18_returns", "m19_returns_order_lines",
    "m25_unpublished_items", "m26_wfs_inventory",
):
    query(pipeline_sql(_name, outer=False), f"{_name}_json_inner")(partial(json_inner, _name))


def variants(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested arrays delivered as variants."""
    frames = {
        source_name(name, brand): raw_frame(
            spark, sf_dir, name, brand, arrays=lambda array: F.parse_json(F.to_json(array)))
        for brand in STORES
    }
    return render(name, unify(spark, SPECS[name], Registry.from_frames(frames), settings=SETTINGS))


for _name in ("m06_inventory", "m12_orders", "m19_returns_order_lines"):
    query(pipeline_sql(_name), f"{_name}_variant")(partial(variants, _name))


BROKEN = "nodes is not null and md5(sku) < '3'"


def broken_json(spark: SparkSession, sf_dir: str, unreadable: str) -> DataFrame:
    """JSON texts of which some end too early."""
    name, text = "m06_inventory", F.to_json("nodes")
    cut = F.when(F.md5(F.col("sku").cast("binary")) < "3", F.substring(text, F.lit(1), F.length(text) - 3))
    frames = {
        source_name(name, b): raw_frame(spark, sf_dir, name, b).withColumn("nodes", F.coalesce(cut, text))
        for b in STORES
    }
    settings = Settings(run_ts=RUN_TS, unreadable=unreadable)
    return unify(spark, SPECS[name], Registry.from_frames(frames), settings=settings)


@query(pipeline_sql("m06_inventory", only=f"not coalesce({BROKEN}, false)"))
def prj_corrupt_json(spark, sf_dir):
    return broken_json(spark, sf_dir, "drop")


@query(pipeline_sql("m06_inventory", replace=f"case when {BROKEN} then null else nodes end as nodes"))
def prj_corrupt_json_null(spark, sf_dir):
    return broken_json(spark, sf_dir, "null")


# --- Sources --------------------------------------------------------------------------

FEEDS = sorted({spec.feed for spec in SPECS.values()})
LISTING_SQL = f"""
    select c_mktsegment as table_schema,
           concat('Brand', c_custkey, '_N', c_nationkey, '_mkt_',
                  ([{", ".join(f"'{feed}'" for feed in FEEDS)}])[1 + c_custkey % {len(FEEDS)}])
           as table_name
    from customer"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table listing with one raw table per customer."""
    feeds = F.array(*[F.lit(feed) for feed in FEEDS])
    feed = F.get(feeds, (F.col("c_custkey") % len(FEEDS)).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("table_schema"),
        F.concat(
            F.lit("Brand"), "c_custkey", F.lit("_N"), "c_nationkey", F.lit("_mkt_"), feed
        ).alias("table_name"),
    )


@query(f"select * from ({LISTING_SQL}) where lower(table_name) like '%mkt%inventory'")
def src_discover_like(spark, sf_dir):
    return discover(listing(spark, sf_dir), "%mkt%inventory")


@query(f"""select * from ({LISTING_SQL}) where lower(table_name) like '%mkt%inventory'
           and lower(table_name) not like '%mkt%wfsinventory'""")
def src_discover_not_like(spark, sf_dir):
    return discover(listing(spark, sf_dir), "%mkt%inventory", ["%mkt%wfsinventory"])


@query(f"""select * from ({LISTING_SQL}) where lower(table_name) like '%mkt%report%'
           and table_schema = 'BUILDING'""")
def src_schema_filter(spark, sf_dir):
    return discover(listing(spark, sf_dir), "%mkt%report%", schema="BUILDING")


SPARSE = "m06_inventory"


@query(pipeline_sql(SPARSE, replace="case when s_brand = 'Acme' then nodes end as nodes"))
def src_missing_column(spark, sf_dir):
    """One store delivers its table without a declared column."""
    frames = {source_name(SPARSE, b): raw_frame(spark, sf_dir, SPARSE, b) for b in STORES}
    frames[source_name(SPARSE, "Globex")] = frames[source_name(SPARSE, "Globex")].drop("nodes")
    return unify(spark, SPECS[SPARSE], Registry.from_frames(frames), settings=SETTINGS)


def landed(spark: SparkSession, frames: dict[str, DataFrame], **where) -> Registry:
    """Raw tables as Parquet folders."""
    root = scratch_folder(spark)
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}")
    return Registry.from_folder(spark, root, **where)


@query(pipeline_sql(SPARSE, replace="case when s_brand = 'Acme' then nodes end as nodes"))
def src_one_scan(spark, sf_dir):
    """Stores as Parquet folders are read by one scan, though one lacks a column."""
    frames = {source_name(SPARSE, b): raw_frame(spark, sf_dir, SPARSE, b) for b in STORES}
    frames[source_name(SPARSE, "Globex")] = frames[source_name(SPARSE, "Globex")].drop("nodes")
    return unify(spark, SPECS[SPARSE], landed(spark, frames), settings=SETTINGS)


@query(pipeline_sql("m02_cap", only="s_brand = 'Globex'"))
def src_catalog_filter(spark, sf_dir):
    """A load from the tables of one catalog."""
    tables = []
    for lake, brand in (("north", "Acme"), ("south", "Globex")):
        frames = {source_name("m02_cap", brand): raw_frame(spark, sf_dir, "m02_cap", brand)}
        tables += landed(spark, frames, schema="raw", catalog=lake).tables
    path = scratch_folder(spark)
    run(spark, SPECS["m02_cap"], Registry(tables), path, settings=SETTINGS, catalog="south")
    return read_table(spark, path)


TYPED = "m01_buy_box"
NO_PRICE = """s_brand = 'Globex' and md5("Sku") < '4'"""
LENIENT = Settings(run_ts=RUN_TS, unreadable="null")


def mixed_types(spark: SparkSession, sf_dir: str) -> Registry:
    """One store delivers prices as text, some of them no number, and days as times."""
    frames = {source_name(TYPED, b): raw_frame(spark, sf_dir, TYPED, b) for b in STORES}
    name = source_name(TYPED, "Globex")
    price = F.when(F.md5(F.col("Sku").cast("binary")) < "4", "n/a")
    frames[name] = frames[name].withColumns({
        "Seller_Item_Price": price.otherwise(F.col("Seller_Item_Price").cast("string")),
        "ReportDate": F.col("ReportDate").cast("timestamp_ntz"),
        "Offer2_Item_Price": F.col("Offer2_Item_Price").cast("decimal(20,4)"),
    })
    return landed(spark, frames)


@query(pipeline_sql(TYPED, replace=f"""case when {NO_PRICE} then null else "Seller_Item_Price" end
                                        as "Seller_Item_Price" """))
def src_differing_types(spark, sf_dir):
    return unify(spark, SPECS[TYPED], mixed_types(spark, sf_dir), settings=LENIENT)


@query(pipeline_sql(TYPED, only=f"""not coalesce({NO_PRICE}, false)"""))
def src_differing_types_dropped(spark, sf_dir):
    settings = Settings(run_ts=RUN_TS, unreadable="drop")
    return unify(spark, SPECS[TYPED], mixed_types(spark, sf_dir), settings=settings)


@query(f"""select s_source as source, 'Seller_Item_Price' as "column", count(*) as n
           from ({raw_sql(TYPED, 'Acme')} union all {raw_sql(TYPED, 'Globex')})
           where {NO_PRICE} group by all""")
def src_rejected_values(spark, sf_dir):
    """The load notes what it could not read, and goes on."""
    path, rejects = scratch_folder(spark), scratch_folder(spark)
    raw = mixed_types(spark, sf_dir)
    run(spark, SPECS[TYPED], raw, path, settings=LENIENT, rejects=rejects)
    noted = spark.read.parquet(rejects).where("value = 'n/a'")
    return noted.groupBy("source", "column").agg(F.count("*").alias("n"))


def _shared_sql() -> str:
    parts = [
        f"select '{name}' as pipeline, brand, store, count(*) as n"
        f" from ({pipeline_sql(name, rates=False)}) group by all"
        for name in ("m18_returns", "m19_returns_order_lines")
    ]
    return " union all ".join(parts)


@query(_shared_sql())
def src_shared_source(spark, sf_dir):
    raw = registry(spark, sf_dir, "m18_returns")
    parts = [
        unify(spark, SPECS[name], raw, settings=SETTINGS)
        .groupBy(F.lit(name).alias("pipeline"), "brand", "store")
        .agg(F.count("*").alias("n"))
        for name in ("m18_returns", "m19_returns_order_lines")
    ]
    return consolidate(parts)


@query(f"""select table_name, split_part(table_name, '_', 1) as brand,
           split_part(table_name, '_', 2) as store,
           (string_split(table_name, '_'))[9] as beyond from ({LISTING_SQL})""")
def prj_brand_store_from_name(spark, sf_dir):
    return listing(spark, sf_dir).select(
        "table_name",
        name_part_column("table_name", 0).alias("brand"),
        name_part_column("table_name", 1).alias("store"),
        name_part_column("table_name", 8).alias("beyond"),
    )


# --- Projections ----------------------------------------------------------------------


@query("select * replace ('House' as brand, 'Web' as store) from"
       f" ({pipeline_sql('m17_return_overrides_on_request')})")
def prj_default_brand_store(spark, sf_dir):
    name = "m17_return_overrides_on_request"
    settings = Settings(
        brand_from_name=False, default_brand="House", store_from_name=False,
        default_store="Web", run_ts=RUN_TS,
    )
    return unify(spark, SPECS[name], registry(spark, sf_dir, name), settings=settings)


@query(f"""select brand, "Item_Brand", "DepartmentId", "itemId", _batch_runtime
           from ({pipeline_sql('m24_top_trending')})""")
def prj_item_brand_rename(spark, sf_dir):
    name = "m24_top_trending"
    out = unify(spark, SPECS[name], registry(spark, sf_dir, name), settings=SETTINGS)
    return out.select("brand", "Item_Brand", "DepartmentId", "itemId", "_batch_runtime")


@query("""select * exclude (rn) from (select *, row_number() over (
            partition by p_brand order by p_size desc, p_partkey) as rn from part) where rn = 1""")
def prj_drop_helper(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return latest(parts, ["p_brand"], "p_size", ties="one", tie_break=["p_partkey"])


@query("""select 'Acme' as brand, 'US' as store,
          cast(1 as decimal(38,9)) as exchange_currency_rate,
          o_orderpriority as exchange_currency_code, o.* from orders o""")
def prj_star_passthrough(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    priced = without_exchange_rate(orders, "o_orderpriority")
    return priced.select(
        F.lit("Acme").alias("brand"), F.lit("US").alias("store"),
        "exchange_currency_rate", "exchange_currency_code", *orders.columns,
    )


@query("""select event_type, concat('user_', user_id) as _batch_user_id,
          epoch_us(ts) // 1000 as _batch_runtime, event_id as _batch_id from events""")
def prj_meta_normalize(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    raw = table(spark, sf_dir, "events").select(
        "event_type",
        F.concat(F.lit("user_"), "user_id").alias("batch_user_id"),
        millis.alias("batch_runtime"),
        F.col("event_id").alias("batch_id"),
    )
    return normalize_meta(raw, SETTINGS.lineage)


@query("""select l_orderkey, l_linenumber, timestamp '2024-03-01 00:00:00' as _last_updated,
          'manual' as _run_id from lineitem""")
def prj_audit_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", *audit_columns(SETTINGS))


def raw_union(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Both raw tables of a feed with their source name."""
    return consolidate(
        [
            raw_frame(spark, sf_dir, name, brand).withColumn(
                "s_source", F.lit(source_name(name, brand))
            )
            for brand in STORES
        ]
    )


def raw_union_sql(name: str) -> str:
    return " union all ".join(raw_sql(name, brand) for brand in STORES)


@query(f"""select sku, node."shipNode" as "shipNode", node."inputQty"[1].amount as first_amount
           from (select sku, unnest(case when coalesce(len(nodes), 0) = 0 then [null] else nodes
                 end) as node from ({raw_union_sql("m06_inventory")}))""")
def prj_struct_flatten(spark, sf_dir):
    rows = unnest_path(raw_union(spark, sf_dir, "m06_inventory").select("sku", "nodes"), ["nodes"])
    first = F.get("`nodes.inputQty`", F.lit(0)).getField("amount")
    return rows.select("sku", F.col("`nodes.shipNode`").alias("shipNode"), first.alias("first_amount"))


@query("""select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k,
          json_extract_string(props, '$.k') as k_text,
          try_cast(json_extract_string(props, '$.k') as double) as k_double,
          json_extract_string(props, '$.absent') as absent from events""")
def prj_json_path_cast(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    return events.select(
        "event_id",
        json_field("v", "k", "bigint").alias("k"),
        json_field("v", "k").alias("k_text"),
        json_field("v", "k", "double").alias("k_double"),
        json_field("v", "absent").alias("absent"),
    )


EPOCH = "1704067200000 + event_id * 3600000 - 1"


@query(f"select event_id, cast(epoch_ms({EPOCH}) as date) as report_date from events")
def prj_report_date_epoch(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_ms_to_date(F.expr(EPOCH)).alias("report_date")
    )


@query("select o_orderkey, cast(o_orderdate as date) as report_date from orders")
def prj_report_date_cast(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", as_date("o_orderdate").alias("report_date")
    )


@query(pipeline_sql("m14_promotions", rates=False))
def prj_fx_flag_off(spark, sf_dir):
    return flag_off("m14_promotions", spark, sf_dir)


def flag_off(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = registry(spark, sf_dir, name)
    return render(name, unify(spark, SPECS[name], raw, settings=SETTINGS))


for _name in ("m10_item", "m11_item_on_request", "m18_returns"):
    query(pipeline_sql(_name, rates=False), f"{_name}_flag_off")(partial(flag_off, _name))


DATED = "m13_promo_on_request"


TEXT_DATES = '''case when md5("SKU") < '8' then 'n/a' else
    cast("Promo_Effective_Date" as varchar) end as "Promo_Effective_Date" '''


@query(pipeline_sql(DATED, replace=TEXT_DATES))
def prj_lenient_dates(spark, sf_dir):
    """Dates delivered as text, some of them unreadable."""
    day = F.col("Promo_Effective_Date").cast("date").cast("string")
    text = F.when(F.md5(F.col("SKU").cast("binary")) < "8", "n/a").otherwise(day)
    frames = {
        source_name(DATED, brand): raw_frame(spark, sf_dir, DATED, brand).withColumn("Promo_Effective_Date", text)
        for brand in STORES
    }
    settings = Settings(run_ts=RUN_TS, lenient_dates=True)
    return unify(spark, SPECS[DATED], Registry.from_frames(frames), settings=settings)


@query(pipeline_sql("m19_returns_order_lines", rates=False))
def prj_fx_flag_off_null_code(spark, sf_dir):
    name = "m19_returns_order_lines"
    raw = registry(spark, sf_dir, name)
    return render(name, unify(spark, SPECS[name], raw, settings=SETTINGS))


# --- Filter and mark ------------------------------------------------------------------

M15 = "m15_reconciliation"


@query(f"""select "Transaction_Type", "Shipped_Qty", _batch_runtime from ({raw_union_sql(M15)})
           where _batch_runtime >= {BATCHES[1]}""")
def flt_lookback(spark, sf_dir):
    rows = lookback_filter(raw_union(spark, sf_dir, M15), "_batch_runtime", BATCHES[1])
    return rows.select("Transaction_Type", "Shipped_Qty", "_batch_runtime")


@query(f"""select coalesce(max(_batch_runtime) - {LOOKBACK_MS}, 0) as mark
           from ({raw_union_sql(M15)})""")
def agg_high_water_mark(spark, sf_dir):
    return high_water_mark(raw_union(spark, sf_dir, M15), "_batch_runtime")


# --- Exchange rates -------------------------------------------------------------------

M14 = "m14_promotions"
FX_COLUMNS = ["ReportDate", "Partner_ID", "Current_Price", "Current_Price_Currency"]
FX_SELECT = ", ".join(f'r."{column}"' for column in FX_COLUMNS)


def fx_sql(rates: str = RATES_SQL, where: str = "true") -> str:
    return f"""
    select {FX_SELECT},
           case when c.value is null then cast(1 as decimal(38,9)) else c.value end
             as exchange_currency_rate,
           case when c.from_currency_code is null then r."Current_Price_Currency"
             else c.from_currency_code end as exchange_currency_code
    from ({raw_union_sql(M14)}) r left join ({rates}) c
      on r."ReportDate" = c.date and r."Current_Price_Currency" = c.to_currency_code
    where {where}"""


def priced(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = raw_union(spark, sf_dir, M14).select(*FX_COLUMNS)
    rates = rates_frame(spark, sf_dir)
    return attach_exchange_rate(rows, rates, "ReportDate", "Current_Price_Currency", **options)


@query(fx_sql(f"select * from ({RATES_SQL}) where from_currency_code = 'USD'"))
def join_fx_left(spark, sf_dir):
    return priced(spark, sf_dir, base_currency="USD")


@query(fx_sql(where="c.value is null"))
def join_fx_default_when_missing(spark, sf_dir):
    out = priced(spark, sf_dir)
    code, own = F.col("exchange_currency_code"), F.col("Current_Price_Currency")
    return out.where(code.eqNullSafe(own))


@query(fx_sql())
def join_fx_fanout(spark, sf_dir):
    return priced(spark, sf_dir)


@query(fx_sql())
def join_fx_salted(spark, sf_dir):
    """The way taken when the rates are too many to broadcast."""
    return priced(spark, sf_dir, broadcast_rows=1)


SMALL_RATES_SQL = f"select * replace (cast(value as double) / 5283123.7 as value) from ({RATES_SQL})"


@query(fx_sql(SMALL_RATES_SQL).replace("cast(1 as decimal(38,9))", "cast(1 as double)"))
def join_fx_small_rate(spark, sf_dir):
    """Rates whose digits go beyond nine decimals."""
    rates = rates_frame(spark, sf_dir)
    rates = rates.withColumn("value", F.col("value").cast("double") / 5283123.7)
    rows = raw_union(spark, sf_dir, M14).select(*FX_COLUMNS)
    return attach_exchange_rate(rows, rates, "ReportDate", "Current_Price_Currency")


LONG_RATES_SQL = f"""select * replace (cast(value as decimal(38,18)) + 0.0000000001234 as value)
                      from ({RATES_SQL})"""


@query(fx_sql(LONG_RATES_SQL).replace("cast(1 as decimal(38,9))", "cast(1 as decimal(38,18))"))
def join_fx_text_rate(spark, sf_dir):
    """Rates given as text keep thirteen decimals."""
    rates = rates_frame(spark, sf_dir)
    tail = F.lit("0.0000000001234").cast("decimal(38,18)")
    text = (F.col("value").cast("decimal(30,18)") + tail).cast("decimal(38,13)").cast("string")
    rows = raw_union(spark, sf_dir, M14).select(*FX_COLUMNS)
    return attach_exchange_rate(rows, rates.withColumn("value", text), "ReportDate", "Current_Price_Currency")


@query(pipeline_sql("m10_item", rates=True))
def join_fx_timestamp_rates(spark, sf_dir):
    """Rates quoted twice a day still give one row per key."""
    hours = F.explode(F.array(F.lit(0), F.lit(9)))
    rates = rates_frame(spark, sf_dir).withColumn("hour", hours)
    moment = datetime_add(F.col("date").cast("timestamp_ntz"), F.col("hour"), "HOUR")
    rates = rates.withColumn("date", moment).drop("hour")
    return unify(spark, SPECS["m10_item"], registry(spark, sf_dir, "m10_item"), rates, settings=SETTINGS)


@query(f"""select *, "Current_Price" / cast(exchange_currency_rate as double)
           as "Current_Price_converted" from ({fx_sql()})""")
def fx_convert_amounts(spark, sf_dir):
    return convert_amounts(priced(spark, sf_dir), ["Current_Price"])


# --- Unnesting ------------------------------------------------------------------------


def unnest_sql(name: str, steps: list[tuple[str, str]], outer: bool = True) -> str:
    body = raw_union_sql(name)
    for path, alias in steps:
        array = f"case when coalesce(len({path}), 0) = 0 then [null] else {path} end"
        body = f"select *, unnest({array if outer else path}) as {alias} from ({body})"
    return body


@query(f"""select sku, e."availToSellQty" as "availToSellQty", e."shipNodeType" as "shipNodeType"
           from ({unnest_sql("m26_wfs_inventory", [('"shipNodes"', "e")])})""")
def unnest_outer(spark, sf_dir):
    return ship_nodes(spark, sf_dir, outer=True)


def ship_nodes(spark: SparkSession, sf_dir: str, outer: bool) -> DataFrame:
    rows = unnest_path(raw_union(spark, sf_dir, "m26_wfs_inventory"), ["shipNodes"], outer)
    fields = ("availToSellQty", "shipNodeType")
    return rows.select("sku", *[F.col(f"`shipNodes.{f}`").alias(f) for f in fields])


@query(f"""select sku, e."availToSellQty" as "availToSellQty", e."shipNodeType" as "shipNodeType"
           from ({unnest_sql("m26_wfs_inventory", [('"shipNodes"', "e")], False)})""")
def unnest_inner(spark, sf_dir):
    return ship_nodes(spark, sf_dir, outer=False)


CHAIN = [("nodes", "node"), ('node."inputQty"', "qty")]


@query(f"""select sku, node."shipNode" as "shipNode", qty.unit as unit, qty.amount as amount
           from ({unnest_sql("m06_inventory", CHAIN)})""")
def unnest_nested_chain(spark, sf_dir):
    rows = unnest_path(raw_union(spark, sf_dir, "m06_inventory"), ["nodes", "nodes.inputQty"])
    return rows.select(
        "sku",
        F.col("`nodes.shipNode`").alias("shipNode"),
        F.col("`inputQty.unit`").alias("unit"),
        F.col("`inputQty.amount`").alias("amount"),
    )


SIBLINGS = [('"orderLines"', "l"), ("shipments", "s"), ('"orderTotal"', "t")]


@query(f"""select "purchaseOrderId", len(l."orderLine") as n_lines, s."shipmentNo" as "shipmentNo",
           t.amount as amount from ({unnest_sql("m12_orders", SIBLINGS)})""")
def unnest_sibling_product(spark, sf_dir):
    rows = raw_union(spark, sf_dir, "m12_orders")
    rows = unnest_path(rows, ["orderLines", "shipments", "orderTotal"])
    lines = F.col("`orderLines.orderLine`")
    return rows.select(
        "purchaseOrderId",
        F.when(lines.isNotNull(), F.size(lines).cast("bigint")).alias("n_lines"),
        F.col("`shipments.shipmentNo`").alias("shipmentNo"),
        F.col("`orderTotal.amount`").alias("amount"),
    )


@query(f"""select sku, node."shipNode" as "shipNode", qty.unit as unit, qty.amount as amount
           from ({unnest_sql("m06_inventory", CHAIN, False)})""")
def unnest_json_inner(spark, sf_dir):
    rows = raw_union(spark, sf_dir, "m06_inventory").withColumn("nodes", F.to_json("nodes"))
    ddl = "array<struct<shipNode:string,inputQty:array<struct<unit:string,amount:double>>>>"
    rows = unnest_path(read_json(rows, {"nodes": ddl}), ["nodes", "nodes.inputQty"], outer=False)
    return rows.select(
        "sku",
        F.col("`nodes.shipNode`").alias("shipNode"),
        F.col("`inputQty.unit`").alias("unit"),
        F.col("`inputQty.amount`").alias("amount"),
    )


@query(f"""select sku, e."shipNodeType" as ship_type, e."onHandQty" as on_hand
           from ({unnest_sql("m26_wfs_inventory", [('"shipNodes"', "e")], False)})""")
def unnest_variant_array(spark, sf_dir):
    rows = raw_union(spark, sf_dir, "m26_wfs_inventory").select(
        "sku", F.to_json("shipNodes").alias("text")
    )
    flat = unnest_variant(rows, "text", "e")
    return flat.select(
        "sku",
        json_field("e", "shipNodeType").alias("ship_type"),
        json_field("e", "onHandQty", "bigint").alias("on_hand"),
    )


@query("""select event_id, key, json_extract_string(props, '$.' || key) as value
          from (select event_id, props, unnest(json_keys(props)) as key from events)""")
def unnest_variant_object(spark, sf_dir):
    flat = unnest_variant(table(spark, sf_dir, "events"), "props", "e")
    return flat.select(
        "event_id",
        F.col("e_key").alias("key"),
        F.try_variant_get("e", "$", "string").alias("value"),
    )


# --- Latest per key -------------------------------------------------------------------


@query("""select * exclude (rn) from (select *, dense_rank() over (
            partition by l_suppkey order by l_shipdate desc nulls last) as rn from lineitem)
          where rn = 1""")
def win_dense_rank_latest(spark, sf_dir):
    return latest(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_shipdate")


@query("""select * exclude (rn) from (select *, dense_rank() over (
            partition by event_type order by cast(ts as date) desc nulls last) as rn from
            (select *, cast(ts as date) as day from events)) where rn = 1""")
def win_dense_rank_hot_keys(spark, sf_dir):
    """Few keys with very many rows each: all of them are split over several tasks."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return latest(events, ["event_type"], "day", hot_rows=100)


@query("""select * exclude (rn) from (select *, row_number() over (
            partition by user_id order by ts desc nulls last, event_id) as rn from events)
          where rn = 1""")
def win_row_number_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return latest(events, ["user_id"], "ts", ties="one", tie_break=["event_id"])


def scope_sql(keys: str) -> str:
    return f"""
    select s_source, "SKU", "Item_ID", "Input_Quantity", _batch_runtime from (
      select *, dense_rank() over (partition by {keys} order by _batch_runtime desc nulls last)
        as rn from ({raw_union_sql("m07_inventory_on_request")})) where rn = 1"""


SCOPE_COLUMNS = ["s_source", "SKU", "Item_ID", "Input_Quantity", "_batch_runtime"]


@query(scope_sql('s_source, "SKU"'))
def win_scope_source(spark, sf_dir):
    rows = raw_union(spark, sf_dir, "m07_inventory_on_request")
    kept = latest(rows, ["SKU"], "_batch_runtime", scope="source", source_col="s_source")
    return kept.select(*SCOPE_COLUMNS)


@query(scope_sql('"SKU"'))
def win_scope_global(spark, sf_dir):
    rows = raw_union(spark, sf_dir, "m07_inventory_on_request")
    return latest(rows, ["SKU"], "_batch_runtime").select(*SCOPE_COLUMNS)


@query(f"""select s_source, "SKU", "PRICE", _batch_runtime
           from ({raw_union_sql("m02_cap")})""")
def set_union_all(spark, sf_dir):
    return raw_union(spark, sf_dir, "m02_cap").select("s_source", "SKU", "PRICE", "_batch_runtime")


# --- Scalar functions -----------------------------------------------------------------


@query("select event_id, cast(epoch_ms(event_id * 86399999) as date) as day from events")
def scl_epoch_ms_to_date(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_ms_to_date(F.col("event_id") * 86399999).alias("day")
    )


CODES = [*COUNTRY_BY_CODE, "DE"]
CODE_LIST = ", ".join(f"'{code}'" for code in CODES)
COUNTRY_CASES = " ".join(f"when '{k}' then '{v}'" for k, v in COUNTRY_BY_CODE.items())


@query(f"""select o_orderkey, case code {COUNTRY_CASES} else code end as store_name from
           (select o_orderkey, ([{CODE_LIST}])[1 + o_orderkey % {len(CODES)}] as code
            from orders)""")
def scl_country_name(spark, sf_dir):
    codes = F.array(*[F.lit(code) for code in CODES])
    code = F.get(codes, (F.col("o_orderkey") % len(CODES)).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", country_name(code).alias("store_name")
    )


@query("""select event_id, ts + interval 90 minute as later, ts - interval 2 day as earlier
          from events""")
def scl_datetime_add(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        datetime_add("ts", 90, "minute").alias("later"),
        datetime_add("ts", -2, "day").alias("earlier"),
    )


@query("select event_id, ts - interval 5 hour as ts from events")
def scl_timezone_shift(spark, sf_dir):
    return shift_timezone(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts"], -5)


TZ_FEED = "m07_inventory_on_request"


@query(f"""select * replace (case when brand = 'Acme' then "ReportDateTime" + interval 5 hour
           else "ReportDateTime" end as "ReportDateTime") from ({pipeline_sql(TZ_FEED)})""")
def scl_timezone_shift_per_source(spark, sf_dir):
    settings = Settings(run_ts=RUN_TS, tz_offsets={source_name(TZ_FEED, "Acme"): 5})
    return unify(spark, SPECS[TZ_FEED], registry(spark, sf_dir, TZ_FEED), settings=settings)


@query("""select o_orderkey, try_cast(case when o_orderkey % 3 = 0 then 'not a date' else
          cast(cast(o_orderdate as date) as varchar) end as date) as day from orders""")
def scl_try_cast_date(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 3 == 0, "not a date").otherwise(
        F.to_date("o_orderdate").cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", as_date(text, lenient=True).alias("day")
    )


# --- Sinks ----------------------------------------------------------------------------


def stored(spark: SparkSession, df: DataFrame, sink: Sink) -> DataFrame:
    path = scratch_folder(spark)
    write_table(df, path, sink)
    return read_table(spark, path)


def written(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    out = unify(spark, SPECS[name], registry(spark, sf_dir, name), settings=SETTINGS)
    return stored(spark, out, SPECS[name].sink)


for _query, _name in {
    "snk_full_refresh": "m03_cpa_on_request",
    "snk_partitioned_roundtrip": "m01_buy_box",
    "snk_day_partition_roundtrip": "m07_inventory_on_request",
    "snk_clustered_roundtrip": "m15_reconciliation",
}.items():
    query(pipeline_sql(_name), _query)(partial(written, _name))

# Target: the first load. Updates: the last batch only, as after the mark moved past it.
MERGE_FEED = "m02_cap"


def _versions(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    spec = SPECS[name]
    old = unify(spark, spec, registry(spark, sf_dir, name, 1), settings=SETTINGS)
    new = unify(spark, spec, registry(spark, sf_dir, name), mark=LAST_MARK, settings=SETTINGS)
    return old, new


def merge_sql(name: str, null_safe: bool = False) -> str:
    return merged_sql(
        pipeline_sql(name, batches=1),
        pipeline_sql(name, since=LAST_MARK),
        list(SPECS[name].keys),
        null_safe,
    )


@query(merge_sql(MERGE_FEED))
def snk_merge_upsert(spark, sf_dir):
    old, new = _versions(spark, sf_dir, MERGE_FEED)
    return merge_upsert(old, new, list(SPECS[MERGE_FEED].keys))


@query(merge_sql(MERGE_FEED, null_safe=True))
def snk_merge_null_key(spark, sf_dir):
    old, new = _versions(spark, sf_dir, MERGE_FEED)
    return merge_upsert(old, new, list(SPECS[MERGE_FEED].keys), null_safe=True)


@query(merge_sql(M15, null_safe=True))
def snk_merge_hot_keys(spark, sf_dir):
    """Merge whose target keys are all split over several tasks."""
    old, new = _versions(spark, sf_dir, M15)
    return merge_upsert(old, new, list(SPECS[M15].keys), null_safe=True, hot_rows=2)


MOVING = "m08_item_performance"


@query(merge_sql(MOVING))
def snk_upsert_partitions(spark, sf_dir):
    """Upsert into a stored table whose rows move from one day to another."""
    old, new = _versions(spark, sf_dir, MOVING)
    path = scratch_folder(spark)
    write_table(old, path, SPECS[MOVING].sink)
    upsert(new, path, list(SPECS[MOVING].keys), SPECS[MOVING].sink)
    return read_table(spark, path)


REFRESHED = "m01_buy_box"


@query(pipeline_sql(REFRESHED, batches=1))
def snk_full_refresh_dynamic_conf(spark, sf_dir):
    """A full refresh leaves nothing of the old table, whatever the session's overwrite mode."""
    path, sink, setting = scratch_folder(spark), SPECS[REFRESHED].sink, "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(setting, "dynamic")
    try:
        for batches in (3, 1):
            raw = registry(spark, sf_dir, REFRESHED, batches)
            write_table(unify(spark, SPECS[REFRESHED], raw, settings=SETTINGS), path, sink)
    finally:
        spark.conf.unset(setting)
    return read_table(spark, path)


RECOVERED = "m03_cpa_on_request"


class Stopped(Exception):
    """A writer that is stopped at some step."""


@query(merged_sql(
    pipeline_sql(RECOVERED, batches=1), pipeline_sql(RECOVERED, since=LAST_MARK), list(SPECS[RECOVERED].keys)
))
def snk_recovered_refresh(spark, sf_dir):
    """An upsert that is stopped while no table is in place; the next load finishes it."""

    def stop(step):
        if step == "move the table":
            raise Stopped(step)

    old, new = _versions(spark, sf_dir, RECOVERED)
    spec, path = SPECS[RECOVERED], scratch_folder(spark)
    write_table(old, path, spec.sink)
    try:
        upsert(new, path, list(spec.keys), spec.sink, step=stop)
    except Stopped:
        recover(spark, path)
    return read_table(spark, path)


ORDERED_SQL = "select o_orderkey, cast(o_orderdate as date) as o_day, o_totalprice from orders"


@query(merged_sql(
    ORDERED_SQL,
    "select o_orderkey, cast(o_day + 400 as date) as o_day, -o_totalprice as o_totalprice"
    f" from ({ORDERED_SQL}) where o_orderkey % 3 = 0",
    ["o_orderkey"],
))
def snk_upsert_many_days(spark, sf_dir):
    """Upsert that touches all days of several years; a third of the rows moves on."""
    old = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_day"), "o_totalprice"
    )
    new = old.where("o_orderkey % 3 = 0").select(
        "o_orderkey", F.date_add("o_day", 400).alias("o_day"), (-F.col("o_totalprice")).alias("o_totalprice")
    )
    path, sink = scratch_folder(spark), Sink(("o_orderkey",), "o_day")
    write_table(old, path, sink)
    upsert(new, path, ["o_orderkey"], sink)
    return read_table(spark, path)


KEYED = "m06_inventory"


@query(merged_sql(
    pipeline_sql(KEYED, lineage_in_key=True),
    pipeline_sql(KEYED, since=LAST_MARK, lineage_in_key=True),
    ["brand", "store", "sku"], null_safe=True,
))
def snk_merge_with_lineage_key(spark, sf_dir):
    """Brand and store belong to the key, so that stores do not replace each other's rows."""
    settings = Settings(run_ts=RUN_TS, lineage_in_key=True)
    raw = registry(spark, sf_dir, KEYED)
    path = scratch_folder(spark)
    for _ in range(2):
        run(spark, SPECS[KEYED], raw, path, settings=settings, null_safe=True)
    return read_table(spark, path)
