import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures.raw import SPECS, STORES, rates_frame, raw_frame, registry, source_name
from marketloom import Lineage, Settings
from marketloom.plans import catalog, output_schema, run, run_all, unify
from marketloom.plans.pipeline import key_paths
from marketloom.sinks import read_table
from marketloom.sources import Registry
from tests.conftest import rows

STAMP = Settings(run_ts=dt.datetime(2024, 3, 1))


def land(spark, sf_dir, folder, name):
    """Raw tables of a feed as Parquet."""
    for brand in STORES:
        raw_frame(spark, sf_dir, name, brand).write.parquet(f"{folder}/{source_name(name, brand)}")
    return Registry.from_folder(spark, str(folder))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_catalog_is_complete():
    assert [name[:3] for name in SPECS] == [f"m{i:02d}" for i in range(1, 27)]
    for spec in SPECS.values():
        names = {output.name.lower() for output in (*spec.outputs, *spec.after_batch_id)}
        assert {key.lower() for key in spec.keys} <= names
        assert {column.lower() for column in spec.sink.cluster_by} <= names
        if spec.sink.partition_by:
            assert spec.sink.partition_by.lower() in names


def test_marketplace_is_a_parameter():
    other = catalog("Bazaar")
    assert other["m12_orders"].like == "%bazaar%orders"
    assert "Bazaar_dot_com_PO__hash" in other["m15_reconciliation"].keys


def test_output_contract(spark):
    columns = output_schema(spark, SPECS["m12_orders"]).names
    assert len(columns) == 88
    assert columns[:5] == [
        "brand", "store", "exchange_currency_rate", "exchange_currency_code", "statusCodeFilter"
    ]
    assert columns[-5:] == [
        "_batch_user_id", "_batch_runtime", "_batch_id", "_last_updated", "_run_id"
    ]
    placed = output_schema(spark, SPECS["m04_cancellation_on_request"]).names
    assert placed[-3:] == ["ReportDate", "_last_updated", "_run_id"]


@pytest.mark.parametrize("name", ["m01_buy_box", "m12_orders", "m19_returns_order_lines"])
def test_no_source_gives_the_declared_schema(spark, name):
    empty = unify(spark, SPECS[name], Registry())
    assert empty.count() == 0
    assert empty.columns == output_schema(spark, SPECS[name]).names


def test_only_needed_nested_fields_and_batches_are_read(spark, sf_dir, tmp_path):
    raw = land(spark, sf_dir, tmp_path, "m12_orders")
    plan = executed(unify(spark, SPECS["m12_orders"], raw, mark=1705363200000))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert all("GreaterThanOrEqual(_batch_runtime,1705363200000)" in line for line in scans)
    # Both sources share a scan. Two more look for hot keys; they leave out all but the key
    # fields, and adaptive execution drops the second when the first finds nothing.
    slim = [line for line in scans if "orderTotal" not in line]
    assert len(scans) == 3 and len(slim) == 2 and all("commission" not in line for line in slim)


def test_parquet_sources_give_the_same_rows(spark, sf_dir, tmp_path):
    for name in ("m12_orders", "m19_returns_order_lines", "m06_inventory"):
        (tmp_path / name).mkdir()
        stored = land(spark, sf_dir, tmp_path / name, name)
        direct = unify(spark, SPECS[name], registry(spark, sf_dir, name), settings=STAMP)
        assert rows(unify(spark, SPECS[name], stored, settings=STAMP)) == rows(direct)


@pytest.mark.parametrize("name", ["m12_orders", "m06_inventory", "m02_cap"])
def test_splitting_hot_keys_changes_nothing(spark, sf_dir, name):
    raw = registry(spark, sf_dir, name)
    plain = dataclasses.replace(STAMP, hot_key_rows=None)
    split = dataclasses.replace(STAMP, hot_key_rows=2)
    assert rows(unify(spark, SPECS[name], raw, settings=split)) == rows(
        unify(spark, SPECS[name], raw, settings=plain)
    )


@pytest.mark.parametrize("outer", [True, False])
@pytest.mark.parametrize("name", ["m12_orders", "m06_inventory", "m19_returns_order_lines"])
def test_cutting_large_products_changes_nothing(spark, sf_dir, name, outer):
    raw = registry(spark, sf_dir, name)
    plain = dataclasses.replace(STAMP, outer_unnest=outer)
    cut = dataclasses.replace(plain, split_product_rows=2)
    assert rows(unify(spark, SPECS[name], raw, settings=cut)) == rows(unify(spark, SPECS[name], raw, settings=plain))


def test_one_shuffle_of_the_rows(spark, sf_dir):
    raw = registry(spark, sf_dir, "m18_returns")
    plan = executed(unify(spark, SPECS["m18_returns"], raw))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_local_times_are_shifted_before_dates_are_cut(spark, sf_dir):
    name = "m26_wfs_inventory"
    offsets = {source_name(name, brand): 23 for brand in STORES}
    shifted = dataclasses.replace(STAMP, tz_offsets=offsets)
    raw = registry(spark, sf_dir, name)
    before = unify(spark, SPECS[name], raw, settings=STAMP).agg(F.max("modifiedDate")).first()[0]
    after = unify(spark, SPECS[name], raw, settings=shifted).agg(F.max("modifiedDate")).first()[0]
    assert after == before + dt.timedelta(days=1)
    orders = unify(spark, SPECS["m12_orders"], registry(spark, sf_dir, "m12_orders"), settings=shifted)
    assert orders.columns == output_schema(spark, SPECS["m12_orders"]).names


def test_renamed_lineage(spark, sf_dir):
    name = "m03_cpa_on_request"
    lineage = Lineage("_in_user", "_in_runtime", "_in_batch")
    frames = {
        source_name(name, "Acme"): raw_frame(spark, sf_dir, name, "Acme").withColumnsRenamed(
            {"_batch_user_id": "in_user", "_batch_runtime": "in_runtime", "_batch_id": "in_batch"}
        )
    }
    settings = dataclasses.replace(STAMP, lineage=lineage)
    out = unify(spark, SPECS[name], Registry.from_frames(frames), settings=settings)
    assert out.columns[-5:-2] == list(lineage.names)
    plain = unify(spark, SPECS[name], registry(spark, sf_dir, name), settings=STAMP)
    assert out.count() == plain.where("brand = 'Acme'").count()


def test_incremental_equals_full_when_keys_are_complete_and_disjoint(spark, sf_dir, tmp_path):
    name = "m02_cap"
    whole = raw_frame(spark, sf_dir, name, "Acme").where("SKU is not null")
    first = Registry.from_frames({source_name(name, "Acme"): whole.where("_batch_id < 101")})
    both = Registry.from_frames({source_name(name, "Acme"): whole.where("_batch_id < 102")})
    path = str(tmp_path / "t")
    run(spark, SPECS[name], first, path, settings=STAMP)
    expected = rows(unify(spark, SPECS[name], both, settings=STAMP))
    for _ in range(2):
        run(spark, SPECS[name], both, path, settings=STAMP)
        assert rows(read_table(spark, path)) == expected


def test_run_all(spark, sf_dir, tmp_path):
    names = ["m03_cpa_on_request", "m14_promotions"]
    raw = Registry([t for n in names for t in registry(spark, sf_dir, n).tables])
    targets = {n: str(tmp_path / n) for n in names}
    rates = rates_frame(spark, sf_dir)
    run_all(spark, [SPECS[n] for n in names], raw, targets, rates, STAMP)
    for n in names:
        assert read_table(spark, targets[n]).count() > 0


def test_store_without_a_nested_field(spark, sf_dir, tmp_path):
    name = "m06_inventory"
    raw = {brand: raw_frame(spark, sf_dir, name, brand) for brand in STORES}
    short = F.transform("nodes", lambda node: node.dropFields("availToSellQty"))
    raw["Globex"] = raw["Globex"].withColumn("nodes", short)
    for brand, df in raw.items():
        df.write.parquet(f"{tmp_path}/{source_name(name, brand)}")
    out = unify(spark, SPECS[name], Registry.from_folder(spark, str(tmp_path)), settings=STAMP)
    amounts = {row.brand: row.n for row in out.groupBy("brand").agg(F.count("availToSellQty_amount").alias("n")).collect()}
    assert amounts["Globex"] == 0 < amounts["Acme"]


def test_inner_unnest_multiplies_after_the_dedup(spark, sf_dir):
    inner = dataclasses.replace(STAMP, outer_unnest=False)
    plan = executed(unify(spark, SPECS["m12_orders"], registry(spark, sf_dir, "m12_orders"), settings=inner))
    below = plan[plan.index("Window ["):]
    slim = below.index("BroadcastExchange") if "BroadcastExchange" in below else len(below)
    early = key_paths(SPECS["m12_orders"])
    assert below[:slim].count("Generate ") <= len(STORES) * (len(early) + 1)


def test_schema_restricts_a_load(spark, sf_dir, tmp_path):
    name = "m02_cap"
    tables = [
        t for schema, brand in (("a", "Acme"), ("b", "Globex"))
        for t in Registry.from_frames({source_name(name, brand): raw_frame(spark, sf_dir, name, brand)}, schema).tables
    ]
    run(spark, SPECS[name], Registry(tables), str(tmp_path / "t"), settings=STAMP, schema="b")
    assert [row.brand for row in read_table(spark, str(tmp_path / "t")).select("brand").distinct().collect()] == ["Globex"]


def test_declared_partition_prunes(spark, sf_dir, tmp_path):
    name = "m12_orders"
    run(spark, SPECS[name], registry(spark, sf_dir, name), str(tmp_path / "t"), settings=STAMP)
    table = read_table(spark, str(tmp_path / "t"))
    assert table.columns == output_schema(spark, SPECS[name]).names
    day = table.where(F.col("orderDate") == dt.date(2024, 1, 5))
    assert "PartitionFilters: [isnotnull(orderDate" in executed(day)
