from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import raw
from fixtures.queries import QUERIES
from fixtures.raw import NUMBERS_PER_TASK, SPECS, raw_frame, registry
from marketloom import Settings
from marketloom.operators import latest, prune_type, without_copies
from marketloom.plans import pipeline, unify


def test_numbers_of_one_row_group_are_widened_by_several_tasks(spark, tmp_path):
    """Copies of a number stay together, so that a task drops all but its newest delivery."""
    many = 5 * NUMBERS_PER_TASK // 2
    lines = spark.range(0, many, 1, 1).select((F.col("id") - F.col("id") % 2).alias("l_orderkey"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    raw = raw_frame(spark, str(tmp_path), "m18_returns", "Acme")
    spread = raw.withColumn("task", F.spark_partition_id()).groupBy("customerOrderId").agg(
        F.count_distinct("task").alias("tasks"), F.count("*").alias("n"))
    assert raw.select(F.spark_partition_id()).distinct().count() == 3
    assert {row.tasks for row in spread.select("tasks").distinct().collect()} == {1}
    kept = lines.where("l_orderkey % 2 = 0 or l_orderkey % 10 = 5")
    deliveries = F.explode(F.array([F.struct(F.lit(v).alias("v"), F.lit(t).alias("t")) for v in range(3) for t in (0, 1)]))
    kept = kept.select(F.col("l_orderkey").alias("n"), deliveries.alias("d")).where(
        "(d.v = 0 or (d.v = 1 and n % 3 = 0) or (d.v = 2 and n % 7 = 0)) and (d.t = 0 or n % 11 = 0)")
    assert spread.agg(F.sum("n")).first()[0] == kept.count()


FEEDS = ["m04_cancellation_on_request", "m10_item", "m12_orders", "m15_reconciliation", "m18_returns", "m19_returns_order_lines"]


@pytest.fixture
def bases(spark, tmp_path):
    """Base tables with numbers that repeat, numbers whose first key is NULL, and no number."""
    numbers = spark.range(0, 600, 1, 1).select(
        F.when(F.col("id") % 50 != 49, F.when(F.col("id") < 150, F.col("id") % 40).otherwise(F.col("id"))).alias("k"))
    numbers.selectExpr("k as l_orderkey", "cast(1 + k % 3 as int) as l_linenumber").write.parquet(str(tmp_path / "lineitem.parquet"))
    numbers.selectExpr("k as o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    numbers.selectExpr("k as p_partkey").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def dealt(monkeypatch, numbers):
    monkeypatch.setattr(raw, "NUMBERS_PER_TASK", numbers)
    monkeypatch.setattr(raw, "FEWER_PER_TASK", {})


@pytest.mark.parametrize("name", FEEDS)
def test_dealt_numbers_give_the_same_raw_rows(spark, bases, monkeypatch, name):
    def texts():
        return Counter(row[0] for row in raw_frame(spark, bases, name, "Acme").select(F.to_json(F.struct("*"))).collect())

    whole = texts()
    dealt(monkeypatch, 100)
    assert raw_frame(spark, bases, name, "Acme").select(F.spark_partition_id()).distinct().count() > 1
    assert texts() == whole


@pytest.mark.parametrize("name", FEEDS)
def test_raw_rows_are_ranked_where_they_are_made(spark, bases, monkeypatch, name):
    """No raw row is sent: what moves are the numbers, before they are widened."""
    dealt(monkeypatch, 100)
    out = unify(spark, SPECS[name], registry(spark, bases, name), settings=Settings(hot_key_rows=None))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


@pytest.mark.parametrize("name", ["m18_returns", "m19_returns_order_lines", "m12_orders_json_inner", "m12_orders_variant", "src_shared_source"])
def test_dealt_numbers_give_the_same_results(spark, bases, monkeypatch, name):
    def texts():
        return Counter(row[0] for row in QUERIES[name](spark, bases).select(F.to_json(F.struct("*"))).collect())

    whole = texts()
    dealt(monkeypatch, 100)
    assert texts() == whole


@pytest.mark.parametrize("name", ["m06_inventory", "m12_orders", "m18_returns", "m25_unpublished_items"])
def test_arrays_are_compiled(name):
    """Lambdas are interpreted, so no array is made by one."""
    texts = [text for column, text in raw.raw_expressions(name, raw.Spark()) if not column.startswith("_batch")]
    assert any("slice(" in text for text in texts) and not any("transform(" in text for text in texts)


@pytest.mark.parametrize("name", ["m12_orders", "m19_returns_order_lines"])
def test_narrow_raw_rows_hold_the_same_values(spark, bases, monkeypatch, name):
    """Fields that nobody asks for are not made; the others keep their values."""
    dealt(monkeypatch, 100)
    spec, kind = SPECS[name], pipeline.raw_type(SPECS[name])
    keys = [output for output in spec.outputs if output.name in spec.keys]
    narrow = prune_type(kind, [*pipeline.raw_paths(spec, keys), "_batch_runtime"])
    few = raw_frame(spark, bases, name, "Acme", narrow=narrow)
    assert len(few.schema.json()) < len(kind.json()) / 2

    def texts(df):
        same = F.to_json(F.from_json(F.to_json(F.struct(*narrow.names)), narrow))
        return Counter(row[0] for row in df.select(same).collect())

    assert texts(few) == texts(raw_frame(spark, bases, name, "Acme"))


def test_keys_are_counted_on_narrow_raw_rows(spark, bases, monkeypatch):
    """What finds the hot keys of orders does not make their other arrays."""
    asked = []
    make = raw.raw_frame
    monkeypatch.setattr(raw, "raw_frame", lambda *a, narrow=None, **b: asked.append(narrow) or make(*a, narrow=narrow, **b))
    unify(spark, SPECS["m12_orders"], registry(spark, bases, "m12_orders"), settings=Settings())
    assert any(kind is not None and "orderLines" in kind.names and "shipments" not in kind.names for kind in asked)


def test_copies_are_dropped_where_they_are(spark):
    """One of each row is kept; rows that differ in a NULL or inside an array are no copies."""
    kinds = "k string, x double, lines array<struct<a:int,b:array<string>>>"
    rows = [
        ("a", 1.0, [(1, ["x"])]), ("a", 1.0, [(1, ["x"])]), ("a", 1.0, [(1, ["y"])]), ("a", None, [(1, ["x"])]),
        ("a", 1.0, None), ("a", 1.0, []),
        ("a", 1.0, [(1, None)]), ("a", 1.0, [(1, [])]), ("a", 1.0, [(1, ["x"]), (1, [])]), ("a", 1.0, [(1, []), (1, ["x"])]),
        (None, None, None), (None, None, None),
    ]
    dealt = spark.createDataFrame(rows, kinds).repartition(3, "k")
    kept = without_copies(dealt)
    assert Counter(map(str, kept.collect())) == Counter(set(map(str, dealt.collect())))
    assert kept.columns == dealt.columns
    assert "ENSURE_REQUIREMENTS" not in kept._jdf.queryExecution().executedPlan().toString()
    variants = dealt.withColumn("v", F.expr("parse_json('1')"))
    assert without_copies(variants).count() == len(rows)


def test_copies_of_returns_do_not_multiply(spark, tmp_path, monkeypatch):
    """An order's return is unnested once, however often its raw row is delivered."""
    monkeypatch.setattr(raw, "NUMBERS_PER_TASK", 100)
    lines = spark.range(0, 400, 1, 1).select((F.col("id") % 20).alias("l_orderkey"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    ranked = []
    monkeypatch.setattr(pipeline, "latest", lambda df, *a, **b: ranked.append(df.cache()) or latest(df, *a, **b))
    frames = registry(spark, str(tmp_path), "m19_returns_order_lines")
    assert sum(table.load(spark).count() for table in frames.tables) > 400
    unify(spark, SPECS["m19_returns_order_lines"], frames, settings=Settings()).collect()
    rows = ranked[0].groupBy(*[f"`{name}`" for name, kind in ranked[0].dtypes if not kind.startswith("array")]).count()
    assert rows.where("count > 1").count() == 0
