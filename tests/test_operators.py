import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions import as_date, country_name, datetime_add, epoch_ms_to_date
from marketloom.operators import (
    attach_exchange_rate,
    consolidate,
    convert_amounts,
    first_of_path,
    latest,
    one_rate_per_day,
    prune_type,
    split_products,
    unnest,
    unnest_path,
    unnest_variant,
    without_exchange_rate,
)
from marketloom.operators import skew
from marketloom.streaming import merge_upsert
from tests.conftest import rows

BATCHES = "k int, b long, x string"


@pytest.fixture(scope="module")
def batches(spark):
    return spark.createDataFrame(
        [(1, 10, "a"), (1, 10, "b"), (1, 5, "c"), (None, 3, "d"), (None, 4, "e"), (2, None, "f")],
        BATCHES,
    )


@pytest.mark.parametrize("hot_rows", [None, 1, 2, 1_000_000])
def test_latest_keeps_all_ties_however_keys_are_split(batches, hot_rows):
    kept = latest(batches, ["k"], "b", hot_rows=hot_rows)
    assert kept.columns == batches.columns
    assert sorted(row.x for row in kept.collect()) == ["a", "b", "e", "f"]


def test_latest_one_row_by_tie_break(batches):
    kept = latest(batches, ["k"], "b", ties="one", tie_break=[F.col("x").desc()])
    assert sorted(row.x for row in kept.collect()) == ["b", "e", "f"]
    with pytest.raises(ValueError):
        latest(batches, ["k"], "b", ties="one")


def test_latest_is_idempotent_and_one_is_within_all(batches):
    every = latest(batches, ["k"], "b")
    assert rows(latest(every, ["k"], "b")) == rows(every)
    one = latest(batches, ["k"], "b", ties="one", tie_break=["x"])
    assert set(rows(one)) <= set(rows(every))


def test_null_batch_is_the_oldest(spark):
    df = spark.createDataFrame([(1, None, "old"), (1, 0, "new")], BATCHES)
    for hot_rows in (None, 1):
        assert [row.x for row in latest(df, ["k"], "b", hot_rows=hot_rows).collect()] == ["new"]


def test_scope(spark):
    df = spark.createDataFrame([("s", 1, 5), ("t", 1, 9)], "src string, k int, b long")
    assert latest(df, ["k"], "b").count() == 1
    assert latest(df, ["k"], "b", scope="source", source_col="src").count() == 2


@pytest.mark.parametrize("share", [0.34, 0.9])
def test_hot_key_is_spread_over_tasks(spark, share):
    """One NULL key with a third of all rows, all of them exact copies."""
    n = 40_000
    df = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") >= n * share, F.col("id")).alias("k"), F.lit(7).alias("b")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = latest(df, ["k"], "b", hot_rows=500)
        assert kept.count() == n
        per_task = kept.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert per_task < n / 3


def test_unnest_outer_and_inner(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert unnest(df, "a").count() == 4
    assert unnest(df, "a", outer=False).count() == 2
    assert unnest_path(df, ["a"]).columns == ["id", "a"]


NESTED = "id int, a array<struct<x:int,b:array<struct<y:int>>>>, c array<struct<z:int>>"


def test_unnest_path_chain_product_and_kept_array(spark):
    df = spark.createDataFrame(
        [(1, [(1, [(1,), (2,)]), (2, None)], [(5,), (6,)]), (2, None, [(7,)])], NESTED
    )
    flat = unnest_path(df, ["a", "a.b", "c"], keep=["a.b"])
    assert flat.columns == ["id", "a.x", "a.b", "b.y", "c.z"]
    assert flat.count() == 3 * 2 + 1
    assert unnest_path(df, ["a", "a.b"], outer=False).count() == 2


def test_first_of_path_is_a_row_of_the_product(spark):
    df = spark.createDataFrame(
        [(1, [(1, [(1,), (2,)])], [(5,), (6,)]), (2, None, []), (3, [(4, [])], None)], NESTED
    )
    paths = ["a", "a.b", "c"]
    first = first_of_path(df, paths)
    assert first.columns == unnest_path(df, paths).columns
    assert rows(first) == rows(unnest_path(df, paths).where("coalesce(`b.y`, 1) = 1 and coalesce(`c.z`, 5) = 5"))


def test_prune_type(spark):
    schema = spark.createDataFrame([], NESTED).schema
    assert prune_type(schema, ["ID", "a.b.y"]).simpleString() == (
        "struct<id:int,a:array<struct<b:array<struct<y:int>>>>>"
    )
    assert prune_type(schema, ["a", "a.x"])["a"].dataType == schema["a"].dataType


def test_variant_array_object_and_bad_text(spark):
    df = spark.createDataFrame(
        [(1, '[{"p":1},{"p":2}]'), (2, '{"q":3}'), (3, "[]"), (4, None), (5, "{bad")], "id int, t string"
    )
    flat = unnest_variant(df, "t", "e")
    assert sorted((row.id, row.e_key) for row in flat.select("id", "e_key").collect()) == [
        (1, None), (1, None), (2, "q")
    ] or sorted((r.id, r.e_key or "") for r in flat.select("id", "e_key").collect()) == [
        (1, ""), (1, ""), (2, "q")
    ]
    assert unnest_variant(df, "t", "e", outer=True).select("id").distinct().count() == 5


@pytest.fixture(scope="module")
def rates(spark):
    day = dt.date(2024, 1, 5)
    return spark.createDataFrame(
        [(day, "USD", "CAD", "1.35"), (day, "EUR", "CAD", "1.47"), (day, "USD", "INR", "83")],
        "date date, from_currency_code string, to_currency_code string, value string",
    )


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(
        [(1, "2024-01-05 10:00:00", "CAD", 10.0), (2, "2024-01-05 10:00:00", "MXN", 1.0),
         (3, "2024-01-06 10:00:00", "INR", 83.0), (4, "2024-01-05 23:00:00", None, 5.0)],
        "id int, t string, cur string, amount double",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))


@pytest.mark.parametrize("limit", [1, 1000])
def test_rates_default_and_fan_out(prices, rates, limit):
    out = attach_exchange_rate(prices, rates, "t", "cur", broadcast_rows=limit)
    # Rates given as text have eighteen places.
    got = rows(out.select("id", "exchange_currency_rate", "exchange_currency_code"))
    assert got == [
        ("1", "1.350000000000000000", "USD"), ("1", "1.470000000000000000", "EUR"),
        ("2", "1.000000000000000000", "MXN"), ("3", "1.000000000000000000", "INR"),
        ("4", "1.000000000000000000", "None"),
    ]


def test_rates_one_per_day_base_and_conversion(prices, rates):
    single = attach_exchange_rate(prices, one_rate_per_day(rates), "t", "cur")
    assert single.count() == 4
    assert single.where("id = 1").first().exchange_currency_code == "EUR"
    usd = attach_exchange_rate(prices, rates, "t", "cur", base_currency="USD")
    converted = convert_amounts(usd, ["amount"]).where("id = 1").first()
    assert converted.amount_converted == pytest.approx(10 / 1.35)
    off = without_exchange_rate(prices, None)
    assert off.schema["exchange_currency_rate"].dataType.simpleString() == "decimal(38,9)"
    assert off.first().exchange_currency_code is None


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_consolidate_keeps_duplicates_and_goes_by_name(spark, n):
    frames = [spark.createDataFrame([(1, "x")], "a int, b string").select(*order)
              for order in (["a", "b"], ["b", "a"]) * n][:n]
    assert rows(consolidate(frames)) == [("1", "x")] * n


def test_epoch_date_ignores_session_zone(spark):
    df = spark.createDataFrame([(1704067200000,), (1704067199999,), (None,)], "ms long")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [row[0] for row in df.select(epoch_ms_to_date("ms")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.date(2024, 1, 1), dt.date(2023, 12, 31), None]


def test_scalars(spark):
    df = spark.createDataFrame([("CAD", "2024-13-01")], "c string, d string")
    row = df.select(
        country_name("c"), country_name(F.lit("zz")), as_date("d", lenient=True),
        datetime_add(F.lit("2024-01-31 23:30:00").cast("timestamp_ntz"), 1, "hour"),
    ).first()
    assert tuple(row) == ("Canada", "zz", None, dt.datetime(2024, 2, 1, 0, 30))
    with pytest.raises(ValueError):
        datetime_add("d", 1, "fortnight")


def test_rates_keep_their_digits_and_days(spark):
    rates = spark.sql(
        "select timestamp'2024-01-01 05:00:00' as date, 'USD' as from_currency_code,"
        " 'CAD' as to_currency_code, 0.0000157123456789D as value"
        " union all select timestamp'2024-01-01 09:00:00', 'USD', 'CAD', 0.5D"
    )
    sold = spark.sql("select date'2024-01-01' as t, 'CAD' as cur")
    got = attach_exchange_rate(sold, one_rate_per_day(rates), "t", "cur").collect()
    assert [row.exchange_currency_rate for row in got] == [0.0000157123456789]


SPLIT = "id int, name string, a array<struct<x:int,b:array<struct<y:int>>>>, c array<struct<z:int>>, d array<struct<w:int>>"


@pytest.mark.parametrize("outer", [True, False])
@pytest.mark.parametrize("most", [1, 4, 1000])
def test_split_products_keep_the_rows(spark, most, outer):
    df = spark.createDataFrame(
        [
            (1, "u", [(1, [(1,), (2,), (3,)]), (2, None), (3, [])], [(i,) for i in range(7)], [(5,)]),
            (1, "u", [(1, [(1,), (2,), (3,)]), (2, None), (3, [])], [(i,) for i in range(7)], [(5,)]),
            (2, None, None, [], [(1,), (2,)]),
            (3, "v", [], None, None),
            (4, "w", [(9, [(i,) for i in range(20)])], [(1,)], []),
            (None, None, [(1, [(1,)]), (2, [(4,), (5,)])], [(1,), (2,)], [(3,), (4,)]),
        ],
        SPLIT,
    )
    paths = ["a", "a.b", "c", "d"]
    cut = split_products(df, paths, most, ["id"])
    assert cut.columns == df.columns and cut.schema["a"].dataType == df.schema["a"].dataType
    assert rows(unnest_path(cut, paths, outer)) == rows(unnest_path(df, paths, outer))
    kept = split_products(df, paths, most, ["id"], keep=["A", "c"])
    assert rows(unnest_path(kept, paths, outer, keep=["a", "c"])) == rows(unnest_path(df, paths, outer, keep=["a", "c"]))
    assert split_products(df, ["c"], most, ["id"], keep=["c"]) is df
    assert split_products(df.limit(0), paths, most, ["id"]).count() == 0


def test_cuts_are_sent_with_their_slices_only(spark):
    rows = spark.range(3).select("id", F.sequence(F.lit(1), F.lit(50)).alias("a"), F.sequence(F.lit(1), F.lit(3)).alias("b"))
    cut = split_products(rows, ["a", "b"], 30, ["id"])
    above, below = cut._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")
    assert "slice(" not in above and "slice(" in below
    assert cut.agg(F.sum(F.size("a"))).first()[0] == 150 and cut.count() == 15


def test_small_cuts_of_a_row_stay_together(spark):
    """Many small cuts share a task, up to ten thousand rows; beyond that they are spread."""
    rows = spark.range(50).select("id", F.sequence(F.lit(1), F.lit(50)).alias("a"))
    tasks = split_products(rows, ["a"], 2, ["id"]).withColumn("task", F.spark_partition_id()).groupBy("id").agg(
        F.count("*").alias("cuts"), F.count_distinct("task").alias("tasks"))
    assert {(row.cuts, row.tasks) for row in tasks.collect()} == {(25, 1)}
    thousand = F.sequence(F.lit(1), F.lit(1000))
    cut = split_products(spark.range(1).select("id", thousand.alias("a"), thousand.alias("b")), ["a", "b"], 2, ["id"])
    assert cut.count() == 1000 and cut.select(F.spark_partition_id()).distinct().count() > 4


def test_one_product_is_spread_over_tasks(spark):
    numbers = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.struct(i.alias("x")))
    df = spark.range(1).select("id", *[numbers.alias(name) for name in "abc"])
    flat = unnest_path(split_products(df, ["a", "b", "c"], 10_000, ["id"]), ["a", "b", "c"])
    per_task = [row["count"] for row in flat.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 10**6 and len(per_task) > 4 and max(per_task) < 400_000
    assert flat.distinct().count() == 10**6


def test_few_hot_keys_are_broadcast_however_low_the_threshold(spark, monkeypatch):
    """Only the keys with the most rows are split, the same ones wherever they are used."""
    monkeypatch.setattr(skew, "MOST_HOT", 3)
    target = spark.range(0, 400, 1, 4).select((F.col("id") % 40).alias("k"), F.col("id").alias("x"))
    target = target.union(spark.range(1000, 1007).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("x")))
    hot = skew.hot_keys(target, ["k"], 2).collect()
    assert len(hot) == 3 and 7 in {row["__hot_0"] for row in hot}
    updates = spark.range(0, 40, 2).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("x"))
    for null_safe in (False, True):
        merged = merge_upsert(target, updates, ["k"], null_safe=null_safe, hot_rows=2)
        assert merged.where("x < 0").count() == 20
        assert merged.where("x >= 0 and k % 2 = 0").count() == 0
        assert merged.where("k % 2 = 1").count() == 207
    assert rows(latest(target, ["k"], "x", hot_rows=2)) == rows(latest(target, ["k"], "x", hot_rows=None))
