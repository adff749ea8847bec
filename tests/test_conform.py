"""Raw values in other types than declared, unreadable ones, and one scan for many stores."""

import dataclasses
import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures.raw import SPECS, STORES, rates_frame, raw_frame, registry, source_name
from marketloom import Settings
from marketloom.plans import rejected_values, run, unify
from marketloom.sinks import read_table
from marketloom.sources import Registry, conform, scans
from marketloom.sources.conform import conformed, covers, rejected, unreadable
from tests.conftest import rows

DDL = "array<struct<a:double,b:array<struct<c:bigint,d:timestamp_ntz>>>>"
TEXTS = [
    (1, '[{"a":1.5,"b":[{"c":3,"d":"2024-01-05T00:00:00.000"}]}]', False), (2, '[{"a":"n/a","b":[{"c":3}]}]', True),
    (3, '[{"a":1},{"a"', True), (4, "null", False), (5, None, False), (6, '{"a":1}', True), (7, '[{"a":"2.5","b":"x"}]', True),
    (8, '[{"a":1,"b":[{"c":"zz"}]},null]', True), (9, "[]", False), (10, "", True), (11, '[{"a":null,"x":1}]', False),
]
STAMP = Settings(run_ts=dt.datetime(2024, 3, 1))


def kind(ddl):
    return T.StructType.fromDDL(f"v {ddl}")[0].dataType


@pytest.mark.parametrize("as_variant", [False, True])
def test_nested_values(spark, as_variant):
    df = spark.createDataFrame([row[:2] for row in TEXTS], "i int, v string")
    found = T.StringType()
    if as_variant:  # a text that is no JSON cannot be a variant
        df, found = df.withColumn("v", F.try_parse_json("v")), T.VariantType()
    got = df.select("i", conformed(F.col("v"), found, kind(DDL)).alias("v"), unreadable(F.col("v"), found, kind(DDL)).alias("bad")).collect()
    broken = {3, 10} if as_variant else set()
    assert {r.i for r in got if r.bad} == {i for i, _, bad in TEXTS if bad} - broken
    values = {r.i: r.v for r in got}
    assert values[1] == [(1.5, [(3, dt.datetime(2024, 1, 5))])] and values[2] == [(None, [(3, None)])]
    assert values[8] == [(1.0, [(None, None)]), None] and values[3] is values[4] is values[6] is None
    assert values[11] == [(None, None)]


@pytest.mark.parametrize(("found", "declared", "values", "bad"), [
    ("string", "double", ["1.5", " 2 ", "n/a", "", None], [False, False, True, True, False]),
    ("string", "date", ["2024-01-05", "05.01.2024", None], [False, True, False]),
    ("double", "bigint", [1.0, 1e300, None], [False, True, False]),
    ("boolean", "double", [True, None], [True, False]),
    ("bigint", "date", [20240105, None], [True, False]),
    ("array<string>", "array<bigint>", [["1", None], ["x"], None], [False, True, False]),
    ("string", "array<bigint>", ["[1,2]", '[1,"x"]', "7"], [False, True, True]),
    ("bigint", "array<bigint>", [1, None], [True, False]),
])
def test_plain_values(spark, found, declared, values, bad):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {found}")
    test = unreadable(F.col("v"), kind(found), kind(declared))
    got = df.select("i", conformed(F.col("v"), kind(found), kind(declared)).alias("v"), test.alias("bad")).orderBy("i").collect()
    assert [r.bad for r in got] == bad
    assert all(r.v is None for r in got if r.bad and not declared.startswith("array<b") or values[r.i] is None)


@pytest.mark.parametrize(("found", "declared"), [
    ("int", "double"), ("date", "timestamp_ntz"), ("double", "string"), ("array<struct<a:int>>", "array<struct<a:bigint,b:string>>"),
    ("array<struct<b:string,a:bigint>>", "array<struct<a:bigint,b:string>>"),
])
def test_types_that_always_fit(found, declared):
    # No column is touched, so no session is needed to tell.
    assert unreadable(None, kind(found), kind(declared)) is None


def test_missing_and_further_nested_fields(spark):
    df = spark.createDataFrame([(1, [("x", 2)]), (2, None), (3, [None])], "i int, v array<struct<extra:string,A:int>>")
    declared = T.StructType([T.StructField("v", kind("array<struct<a:bigint,n:string>>"))])
    assert not covers(df.schema["v"].dataType, declared[0].dataType)
    got = conform(df, declared)
    assert got.schema["v"].dataType.simpleString() == "array<struct<a:bigint,n:string>>"
    assert [r.v for r in got.orderBy("i").collect()] == [[(2, None)], None, [None]]


def test_modes(spark):
    df = spark.createDataFrame([(1, "2.5", "[1]"), (2, "n/a", "[2]"), (3, "4", "[3"), (4, None, None)], "i int, v string, w string")
    declared = T.StructType.fromDDL("v double, w array<bigint>, other string")
    assert [tuple(r) for r in conform(df, declared, "null").orderBy("i").collect()] == [
        (1, 2.5, [1]), (2, None, [2]), (3, 4.0, None), (4, None, None)]
    assert [r.i for r in conform(df, declared, "drop").orderBy("i").collect()] == [1, 4]
    noted = rejected(df, declared, ["i"]).orderBy("i").collect()
    assert [tuple(r) for r in noted] == [(2, "v", "n/a"), (3, "w", "[3")]
    with pytest.raises(Exception, match="shop.v: no double: n/a"):
        conform(df.where("i = 2"), declared, name="shop").collect()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        conform(df.where("i = 3"), declared).collect()
    with pytest.raises(ValueError, match="unreadable"):
        conform(df, declared, "ignore")


def small_tables(spark, folder, n):
    """Tables of one feed in three layouts that can be merged."""
    base = raw_frame(spark, "/root/testdata/sf0.001", "m02_cap", "Acme").limit(3).coalesce(1)
    kinds = [base, base.drop("PRICE"), base.withColumnRenamed("_batch_id", "batch_id")]
    for i, df in enumerate(kinds):
        df.write.parquet(f"{folder}/Brand{i}_N{i % 7}_mkt_capreport")
    for i in range(3, n):
        shutil.copytree(f"{folder}/Brand{i % 3}_N{i % 3}_mkt_capreport", f"{folder}/Brand{i}_N{i % 7}_mkt_capreport")
    return Registry.from_folder(spark, str(folder))


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_many_stores_share_a_scan(spark, tmp_path):
    few, many = small_tables(spark, tmp_path / "few", 6), small_tables(spark, tmp_path / "many", 500)
    spec = SPECS["m02_cap"]
    assert len(scans(spark, many.match(spec.like))) == 1
    small, large = unify(spark, spec, few, settings=STAMP), unify(spark, spec, many, settings=STAMP)
    assert plan_size(large) < 1.1 * plan_size(small)
    got = large.groupBy("brand", "store").agg(F.count("*").alias("n"), F.count("PRICE").alias("priced")).collect()
    assert len(got) == 500 and all(r.store == f"N{int(r.brand[5:]) % 7}" for r in got)
    assert all(r.priced == (0 if int(r.brand[5:]) % 3 == 1 else r.n) for r in got)
    assert large.where("_batch_id is null").count() == 0


def test_same_rows_from_one_scan_and_from_frames(spark, sf_dir, tmp_path):
    for name in ("m07_inventory_on_request", "m18_returns"):
        for brand in STORES:
            raw_frame(spark, sf_dir, name, brand).write.parquet(f"{tmp_path}/{name}/{source_name(name, brand)}")
        offsets = {source_name(name, "Acme"): 5}
        settings = dataclasses.replace(STAMP, tz_offsets=offsets)
        stored = unify(spark, SPECS[name], Registry.from_folder(spark, f"{tmp_path}/{name}"), mark=1704931200000, settings=settings)
        direct = unify(spark, SPECS[name], registry(spark, sf_dir, name), mark=1704931200000, settings=settings)
        assert rows(stored) == rows(direct)


def test_folders_with_odd_names_and_partitions(spark, sf_dir, tmp_path):
    name = "m02_cap"
    for i, brand in enumerate(["A b", "Ü%41", "Plain"]):
        df = raw_frame(spark, sf_dir, name, "Acme").limit(5)
        writer = df.write.partitionBy("_batch_id") if i == 2 else df.write
        writer.parquet(f"{tmp_path}/{brand}_US_mkt_capreport")
    found = Registry.from_folder(spark, str(tmp_path))
    got = unify(spark, SPECS[name], found, settings=STAMP).groupBy("brand").agg(F.count("_batch_id").alias("n")).collect()
    assert {r.brand for r in got} == {"A b", "Ü%41", "Plain"} and all(r.n for r in got)


def test_rejected_values_of_a_load(spark, sf_dir, tmp_path):
    name = "m02_cap"
    raw = {source_name(name, b): raw_frame(spark, sf_dir, name, b) for b in STORES}
    first = source_name(name, "Acme")
    raw[first] = raw[first].withColumn("PRICE", F.when(F.col("SKU").like("%4"), "free").otherwise(F.col("PRICE").cast("string")))
    found, settings = Registry.from_frames(raw), dataclasses.replace(STAMP, unreadable="drop")
    free = raw[first].where("PRICE = 'free'").count()
    got = rejected_values(spark, SPECS[name], found).groupBy("source", "column", "value").count().collect()
    assert [tuple(r) for r in got] == [(first, "PRICE", "free", free)] and free
    run(spark, SPECS[name], found, str(tmp_path / "t"), settings=settings, rejects=str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == free
    assert read_table(spark, str(tmp_path / "t")).where("brand = 'Acme' and SKU like '%4'").count() == 0
    with pytest.raises(Exception, match="PRICE: no double: free"):
        unify(spark, SPECS[name], found, settings=STAMP).collect()


def test_planning_starts_no_job(spark, sf_dir):
    raw, rates = registry(spark, sf_dir, "m14_promotions"), rates_frame(spark, sf_dir)
    context = spark.sparkContext
    context.setJobGroup("planning", "")
    try:
        unify(spark, SPECS["m14_promotions"], raw, rates, settings=STAMP)
        context._jsc.sc().listenerBus().waitUntilEmpty()
        assert list(context.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        context._jsc.clearJobGroup()


def test_rates_without_an_estimate_are_counted(spark):
    from marketloom.operators import attach_exchange_rate

    df = spark.createDataFrame([(dt.date(2024, 1, 1), "CAD")], "day date, currency string")
    rates = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "USD", c, "1.0000000000005") for c in ("CAD", "INR", "MXN")],
        "date date, from_currency_code string, to_currency_code string, value string")
    few, many, none = (attach_exchange_rate(df, rates, "day", "currency", broadcast_rows=n) for n in (3, 2, 0))
    assert str(few.first().exchange_currency_rate) == "1.000000000000500000"
    assert few.first() == many.first() == none.first()
    plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in (few, many, none)]
    assert [("strategy=broadcast" in plan) for plan in plans] == [True, False, False]
