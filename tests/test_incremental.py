import datetime as dt
from functools import reduce

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketloom.sinks import Sink, exists, merge_into_table, read_table, tables, upsert, write_table
from marketloom.sinks.tables import key_range
from marketloom.streaming import high_water_mark, lookback_filter, merge_upsert, stored_mark
from marketloom.streaming.incremental import newest_batch
from tests.conftest import rows

MONTH = 2_592_000_000
TABLE = "k int, day date, x string"


def test_mark(spark):
    def mark(*values):
        df = spark.createDataFrame([(v,) for v in values], "b long")
        return high_water_mark(df, "b").first().mark

    assert mark() == 0
    assert mark(MONTH) == 0
    assert mark(1, MONTH + 5) == 5


def test_lookback_includes_the_mark(spark):
    df = spark.createDataFrame([(4,), (5,), (6,)], "b long")
    assert rows(lookback_filter(df, "b", 5)) == [("5",), ("6",)]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "old"), (2, "keep"), (None, "null")], "k int, x string")


@pytest.fixture(scope="module")
def updates(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, x string")


@pytest.mark.parametrize("hot_rows", [None, 1, 1_000_000])
def test_merge_replaces_keys_and_inserts_all(target, updates, hot_rows):
    merged = merge_upsert(target, updates, ["k"], hot_rows=hot_rows)
    assert sorted(row.x for row in merged.collect()) == ["a", "b", "keep", "n", "null"]
    safe = merge_upsert(target, updates, ["k"], null_safe=True, hot_rows=hot_rows)
    assert sorted(row.x for row in safe.collect()) == ["a", "b", "keep", "n"]


def test_strict_merge_rejects_repeated_keys(spark, target, updates):
    with pytest.raises(Exception, match="several update rows"):
        merge_upsert(target, updates, ["k"], strict=True).collect()
    single = updates.where("x <> 'b'")
    assert merge_upsert(target, single, ["k"], strict=True).count() == 4
    empty = updates.limit(0)
    assert merge_upsert(target, empty, ["k"], strict=True).count() == 3


def dated(spark, *items):
    return spark.createDataFrame(items, "k int, day string, x string").withColumn(
        "day", F.col("day").cast("date")
    )


DAILY = Sink(cluster_by=("k",), partition_by="day")


def test_upsert_moves_rows_between_days_and_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not exists(spark, path)
    write_table(
        dated(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, "2024-01-02", "c"),
              (4, None, "d"), (5, "2024-01-03", "e")),
        path, DAILY,
    )
    assert exists(spark, path)
    untouched = {p.name for p in (tmp_path / "t" / "day=2024-01-03").iterdir()}
    # Key 1 leaves its day empty, key 4 leaves the NULL day empty, key 6 is new.
    new = dated(spark, (1, "2024-01-02", "A"), (4, "2024-01-04", "D"), (6, None, "f"))
    for _ in range(2):
        upsert(new, path, ["k"], DAILY)
        assert rows(read_table(spark, path)) == rows(
            dated(spark, (1, "2024-01-02", "A"), (2, "2024-01-02", "b"), (3, "2024-01-02", "c"),
                  (4, "2024-01-04", "D"), (5, "2024-01-03", "e"), (6, None, "f"))
        )
    assert not (tmp_path / "t" / "day=2024-01-01").exists()
    assert {p.name for p in (tmp_path / "t" / "day=2024-01-03").iterdir()} == untouched


def test_upsert_when_the_day_is_part_of_the_key(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(dated(spark, (1, "2024-01-01", "a"), (1, "2024-01-02", "b")), path, DAILY)
    upsert(dated(spark, (1, "2024-01-02", "B")), path, ["k", "day"], DAILY)
    assert sorted(row.x for row in read_table(spark, path).collect()) == ["B", "a"]


def test_upsert_without_partition(spark, tmp_path, target, updates):
    path = str(tmp_path / "t")
    write_table(target, path, Sink(("k",)))
    upsert(updates, path, ["k"], Sink(("k",)), null_safe=True)
    assert sorted(row.x for row in read_table(spark, path).collect()) == ["a", "b", "keep", "n"]


def test_all_rows_of_the_only_day_leave(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(dated(spark, (1, "2024-01-01", "a")), path, DAILY)
    upsert(dated(spark, (1, "2024-01-09", "A")), path, ["k"], DAILY)
    assert [row.x for row in read_table(spark, path).collect()] == ["A"]


def test_clustering_orders_rows_inside_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(2000).select(F.pmod(F.col("id") * 7919, F.lit(2000)).alias("k"))
    write_table(df, path, Sink(("k",)))
    spans = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_merge_statement_needs_a_row_level_format(spark, updates):
    spark.sql("create database if not exists merged")
    updates.write.mode("overwrite").saveAsTable("merged.plain")
    with pytest.raises(PySparkException, match="UNSUPPORTED_FEATURE|MERGE"):
        merge_into_table(updates, "merged.plain", ["k"])
    spark.sql("drop database merged cascade")


def test_upsert_over_very_many_days(spark, tmp_path):
    days = spark.range(700).select(
        F.col("id").cast("int").alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.lit("old").alias("x"),
    )
    path = str(tmp_path / "many")
    write_table(days, path, DAILY)
    upsert(days.withColumn("x", F.lit("new")), path, ["k"], DAILY)
    assert read_table(spark, path).groupBy("x").count().collect() == [("new", 700)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["many"]


def test_table_without_marker_exists(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(dated(spark, (1, "2024-01-01", "a")), path, DAILY)
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert exists(spark, path)


def test_full_refresh_leaves_no_old_day(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(dated(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b")), path, DAILY)
        write_table(dated(spark, (3, "2024-01-03", "c")), path, DAILY)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_table(spark, path)) == [("3", "2024-01-03", "c")]


def test_failed_refresh_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(dated(spark, (1, "2024-01-01", "a")), path, DAILY)
    broken = dated(spark, (2, "2024-01-02", "b")).withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        write_table(broken, path, DAILY)
    assert rows(read_table(spark, path)) == [("1", "2024-01-01", "a")]


def test_days_of_a_table_are_folders(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    df = dated(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, None, "c"))
    path = str(tmp_path / "t")
    write_table(df, path, DAILY)
    table = read_table(spark, path)
    assert table.schema == df.schema
    assert pruned(table.where(F.col("day") == day)) and pruned(read_table(spark, path, (day, None)))
    assert [row.x for row in read_table(spark, path, (day, day)).collect()] == ["b"]

    times = df.withColumn("day", F.col("day").cast("timestamp_ntz") + F.expr("interval 5 hours"))
    path = str(tmp_path / "hours")
    sink = Sink(("k",), "day", by_day=True)
    write_table(times, path, sink)
    assert (tmp_path / "hours" / "day_day=2024-01-02").exists()
    assert read_table(spark, path).schema == times.schema
    assert pruned(read_table(spark, path, (None, day)))
    assert sorted(row.x for row in read_table(spark, path, (None, day)).collect()) == ["a", "b"]
    upsert(times.where("k = 1").withColumn("day", F.lit(None).cast("timestamp_ntz")), path, ["k"], sink)
    assert rows(read_table(spark, path).where("day is null").select("x")) == [("a",), ("c",)]
    with pytest.raises(ValueError, match="no date"):
        write_table(times, str(tmp_path / "refused"), DAILY)


def pruned(df):
    """Whether the scan picks folders."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "PartitionFilters: [isnotnull(day" in plan


def test_table_of_null_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = dated(spark, (1, None, "a"))
    write_table(df, path, DAILY)
    assert read_table(spark, path).schema == df.schema
    upsert(dated(spark, (1, "2024-01-01", "b")), path, ["k"], DAILY)
    assert rows(read_table(spark, path)) == [("1", "2024-01-01", "b")]


def test_empty_table_is_loaded_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(dated(spark, (1, None, "a")).limit(0), path, DAILY)
    assert not exists(spark, path)


def test_mark_is_read_from_footers(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 10 + MONTH).alias("b"), F.col("id").alias("k"))
    df.repartition(4).write.parquet(str(tmp_path / "t"))
    assert stored_mark(spark, str(tmp_path / "t"), "b") == 990
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = newest_batch(session, str(tmp_path / "t"), "b")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(b)]" in plan
    spark.createDataFrame([(None,)], "b long").write.parquet(str(tmp_path / "empty"))
    assert stored_mark(spark, str(tmp_path / "empty"), "b") == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def read_rows(df):
    """Rows that the scans of a query gave, after row groups and pages were passed over."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        leaves, total = execution.executedPlan().collectLeaves(), 0
        for i in range(leaves.size()):
            total += leaves.apply(i).metrics().apply("numOutputRows").value()
        return total
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("kind", ["int", "string"])
def test_rows_beyond_the_update_keys_are_not_read(spark, tmp_path, kind):
    key = F.col("id").cast("int") if kind == "int" else F.format_string("k%05d", "id")
    days = [spark.range(d * 1000, d * 1000 + 1000).select(
        key.alias("k"), F.lit(dt.date(2024, 1, 1 + d)).alias("day"), F.lit("x").alias("x")) for d in range(8)]
    table = reduce(lambda a, b: a.union(b), days)
    path = str(tmp_path / "t")
    write_table(table, path, DAILY)
    target, updates = spark.read.parquet(path), table.where("day = '2024-01-03'").limit(20)
    assert read_rows(target) == 8000
    assert read_rows(target.where(key_range(updates, ["k"], False)).select("k", "day")) <= 1000
    nothing = table.limit(0)
    assert read_rows(target.where(key_range(nothing, ["k"], False)).select("k")) == 0
    upsert(updates.withColumn("x", F.lit("new")), path, ["k"], DAILY)
    assert read_table(spark, path).where("x = 'new'").count() == 20 and read_table(spark, path).count() == 8000


def test_null_keys_are_found_in_range(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(dated(spark, (None, "2024-01-01", "a"), (7, "2024-01-02", "b")), path, DAILY)
    upsert(dated(spark, (None, "2024-01-05", "A")), path, ["k"], DAILY, null_safe=True)
    assert sorted(row.x for row in read_table(spark, path).collect()) == ["A", "b"]


def test_stage_before_a_partitioned_write_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows_ = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit(dt.date(2024, 1, 1)).alias("day"), F.lit("x").alias("x"))
    write_table(rows_.mapInPandas(counted, TABLE), str(tmp_path / "t"), DAILY)
    assert seen.value == 5000


def test_a_large_day_is_cut(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        large = spark.range(200_000, numPartitions=8).select(
            F.hash("id").alias("k"), F.lit(dt.date(2024, 1, 1)).alias("day"), F.md5(F.col("id").cast("string")).alias("x"))
        write_table(large, str(tmp_path / "t"), DAILY)
    finally:
        spark.conf.unset(size)
    files = list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    assert len(files) > 4
    for file in files[:2]:
        keys = [row.k for row in spark.read.parquet(str(file)).select("k").collect()]
        assert keys == sorted(keys)


def sent_rows(df):
    """Rows that the shuffles of a query sent, broadcasts aside."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        nodes, total = [plan], 0
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
        return total
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def test_rows_that_stay_in_large_days_are_not_sent(spark, tmp_path, monkeypatch):
    path, sent = str(tmp_path / "t"), []
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 5).cast("int"))
    table = spark.range(4000).select(F.col("id").cast("int").alias("k"), day.alias("day"), F.lit("x").alias("x"))
    write_table(table, path, DAILY)
    arranged = tables.layout

    def counted(*args):
        sent.append(sent_rows(arranged(*args)))
        return arranged(*args)

    monkeypatch.setattr(tables, "layout", counted)
    monkeypatch.setattr(tables, "SETTLED_BYTES", 1, raising=False)
    updates = table.where("k % 40 = 1").withColumn("x", F.lit("new")).withColumn("day", F.date_add("day", 1))
    upsert(updates, path, ["k"], DAILY)
    assert sent == [100]
    assert rows(read_table(spark, path)) == rows(table.where("k % 40 <> 1").union(updates))


@pytest.mark.parametrize("null_safe, hot_rows, blocks", [(False, 1_000_000, 16_384), (True, 2, 16_384), (False, None, 0)])
def test_merging_into_large_days_gives_the_same_rows(spark, tmp_path, monkeypatch, null_safe, hot_rows, blocks):
    """Files of several bitmaps and row groups, of which some pages are passed over; keys that
    repeat, NULL keys and days; days that lose all rows, get their first, or are small."""
    monkeypatch.setattr(tables, "SETTLED_BYTES", 4000)
    monkeypatch.setattr(tables, "TASK_BYTES", 200_000)
    monkeypatch.setattr(tables, "MOST_BLOCKS", blocks)
    day = F.expr("case when id % 50 = 0 then null when id < 90000 then date'2024-01-01' else date'2024-01-02' end")
    keys = [F.expr("cast(if(id % 97 = 0, null, id % 60000) as int)").alias("k"), F.expr("if(id % 89 = 0, null, id % 7)").alias("l")]
    table = spark.range(150_000).select(*keys, day.alias("day"), F.md5(F.col("id").cast("string")).alias("x"))
    alone = [spark.sql(f"select cast({k} as int) k, 1L l, date'2024-02-0{d}' day, 'alone' x") for k, d in ((70_000, 1), (70_001, 2), (20_007, 2))]
    table = reduce(lambda a, b: a.union(b), alone, table)
    updates = table.where("(k between 20000 and 45000 or k is null) and k <=> k div 3 * 3 or k = 70000")
    updates = updates.limit(20_000).withColumn("x", F.concat("x", F.lit("!"))).withColumn("day", F.date_add("day", 1)).localCheckpoint()
    path, sink = str(tmp_path / "t"), Sink(("k", "l"), "day")
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.setInt("parquet.block.size", 256 << 10)
    try:
        write_table(table, path, sink)
    finally:
        settings.unset("parquet.block.size")
    expected = merge_upsert(table, updates, ["k", "l"], null_safe, hot_rows=None)
    for _ in range(2):
        upsert(updates, path, ["k", "l"], sink, null_safe, hot_rows=hot_rows)
        stored = read_table(spark, path)
        assert stored.dtypes == table.dtypes
        assert stored.exceptAll(expected).count() == 0 and stored.count() == expected.count()
        expected = merge_upsert(expected, updates, ["k", "l"], null_safe, hot_rows=None)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
