import pytest

from marketloom import Lineage, Settings
from marketloom.plans import catalog
from marketloom.sources import (
    Registry,
    brand_and_store,
    discover,
    name_part,
    name_part_column,
    normalize_meta,
)

SPECS = catalog()
FEEDS = sorted({spec.feed for spec in SPECS.values()})


def registry():
    return Registry.from_frames({f"Acme_US_Mkt_{feed.title()}": None for feed in FEEDS})


def test_each_pattern_finds_only_its_own_feed():
    names = registry()
    for spec in SPECS.values():
        found = [table.name.lower() for table in names.match(spec.like, spec.not_like)]
        assert found == [f"acme_us_mkt_{spec.feed}"], spec.name


def test_one_raw_table_feeds_two_pipelines():
    assert SPECS["m18_returns"].like == SPECS["m19_returns_order_lines"].like


def test_exclusion_and_schema():
    tables = Registry.from_frames({"a_b_mkt_inventory": None}, "x").tables
    tables += Registry.from_frames({"a_b_mkt_wfsinventory": None}, "y").tables
    names = Registry(tables)
    assert len(names.match("%mkt%inventory")) == 2
    assert len(names.match("%mkt%inventory", ["%mkt%wfsinventory"])) == 1
    assert len(names.match("%mkt%inventory", schema="y")) == 1


def test_driver_and_relational_discovery_agree(spark):
    names = [f"Acme_US_Mkt_{feed}" for feed in FEEDS] + ["other", "a%b_c_mkt_orders"]
    listing = spark.createDataFrame([("s", name) for name in names], "table_schema string, table_name string")
    known = Registry.from_frames({name: None for name in names}, "s")
    for spec in SPECS.values():
        relational = {row.table_name for row in discover(listing, spec.like, spec.not_like).collect()}
        assert relational == {table.name for table in known.match(spec.like, spec.not_like)}


def test_brand_and_store_keep_case():
    assert brand_and_store("Acme_US_mkt_orders", Settings()) == ("Acme", "US")
    fixed = Settings(brand_from_name=False, default_brand="B", store_from_name=False)
    assert brand_and_store("whatever", fixed) == ("B", "")


def test_too_few_name_parts(spark):
    with pytest.raises(ValueError, match="Acme_mkt"):
        name_part("Acme_mkt", 5)
    df = spark.createDataFrame([("Acme_mkt",)], "n string")
    assert df.select(name_part_column("n", 5)).first()[0] is None


def test_metadata_with_and_without_underscore(spark):
    lineage = Lineage("_in_user", "_in_runtime", "_in_batch")
    for prefix in ("_", ""):
        df = spark.createDataFrame(
            [(1, "u", 2, 3)], f"x int, {prefix}in_user string, {prefix}in_runtime long, {prefix}in_batch long"
        )
        assert normalize_meta(df, lineage).columns == ["x", *lineage.names]
    with pytest.raises(ValueError, match="_in_user"):
        normalize_meta(spark.range(1), lineage)


def test_registries_from_storage(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "Acme_US_mkt_orders"))
    (tmp_path / "_ignored").mkdir()
    found = Registry.from_folder(spark, str(tmp_path))
    assert [table.name for table in found.tables] == ["Acme_US_mkt_orders"]
    assert found.tables[0].load(spark).count() == 3

    spark.sql("create database if not exists landing")
    spark.range(2).write.mode("overwrite").saveAsTable("landing.acme_us_mkt_orders")
    listed = Registry.from_catalog(spark, "landing", ["Acme_US_mkt_orders"])
    assert listed.tables[0].full_name == "landing.Acme_US_mkt_orders"
    assert listed.tables[0].load(spark).count() == 2
    spark.sql("drop database landing cascade")
