"""Writers that are stopped at any step leave the old table or the new one."""

import datetime as dt

import pytest

from fixtures.raw import SPECS, registry
from marketloom import Settings
from marketloom.plans import run
from marketloom.sinks import Sink, exists, read_table, recover, upsert, write_table
from tests.conftest import rows
from tests.test_incremental import DAILY, dated

PLAIN = Sink(("k",))


class Stopped(Exception):
    pass


def stop_at(n):
    """A step function that raises at the n-th step, and the steps it has seen."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == n:
            raise Stopped(name)

    return step, seen


def old(spark):
    return dated(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, None, "c"))


def new(spark):
    return dated(spark, (1, "2024-01-03", "A"), (None, "2024-01-02", "n"))


def writers(spark, path, sink):
    return {
        "write": (lambda step: write_table(new(spark), path, sink, step), [("1", "2024-01-03", "A"), ("None", "2024-01-02", "n")]),
        "upsert": (
            lambda step: upsert(new(spark), path, ["k"], sink, step=step),
            [("1", "2024-01-03", "A"), ("2", "2024-01-02", "b"), ("3", "None", "c"), ("None", "2024-01-02", "n")],
        ),
    }


@pytest.mark.parametrize("sink", [PLAIN, DAILY], ids=["plain", "daily"])
@pytest.mark.parametrize("what", ["write", "upsert"])
def test_stopped_at_every_step(spark, tmp_path, sink, what):
    before, n = rows(old(spark)), 0
    while True:
        n += 1
        path = str(tmp_path / f"t{n}")
        write_table(old(spark), path, sink)
        write, after = writers(spark, path, sink)[what]
        step, seen = stop_at(n)
        try:
            write(step)
        except Stopped:
            recover(spark, path)
            # Nothing has happened before the log is there, and everything is done after it.
            assert rows(read_table(spark, path)) == (before if seen[-1] == "log" else after), seen
            assert recover(spark, path) is None
            # The writer of the next run finds a whole table.
            write(None)
        assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith(f"t{n}-")) == []
        if n > len(seen):
            break
    assert rows(read_table(spark, path)) == after and n > 4


def test_recovery_may_be_stopped_too(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(old(spark), path, DAILY)
    write, after = writers(spark, path, DAILY)["upsert"]
    for n in (3, 1, 2, 1):
        step, _ = stop_at(n)
        try:
            write(step) if n == 3 else recover(spark, path, step)
        except Stopped:
            pass
    assert recover(spark, path) in ("finished", "cleaned", None)
    assert rows(read_table(spark, path)) == after


def test_table_set_aside_without_log_comes_back(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(old(spark), path, PLAIN)
    (tmp_path / "t").rename(tmp_path / "t--old-1")
    old(spark).limit(1).write.parquet(f"{path}--new-1")
    assert not exists(spark, path)
    assert recover(spark, path) == "restored"
    assert rows(read_table(spark, path)) == rows(old(spark))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_tables_with_a_common_beginning_are_told_apart(spark, tmp_path):
    write_table(old(spark), str(tmp_path / "t"), PLAIN)
    write_table(old(spark), str(tmp_path / "t--old"), PLAIN)
    write_table(new(spark), str(tmp_path / "t"), PLAIN)
    assert exists(spark, str(tmp_path / "t--old"))


def test_failed_job_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    write_table(old(spark), path, DAILY)
    broken = new(spark).withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        upsert(broken, path, ["k"], DAILY)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    assert rows(read_table(spark, path)) == rows(old(spark))


def test_load_after_a_stopped_one(spark, sf_dir, tmp_path):
    """A run that finds no table, but a set aside one, goes on with it incrementally."""
    name, settings = "m03_cpa_on_request", Settings(run_ts=dt.datetime(2024, 3, 1))
    path = str(tmp_path / "t")
    run(spark, SPECS[name], registry(spark, sf_dir, name, 1), path, settings=settings)
    count = read_table(spark, path).count()
    (tmp_path / "t").rename(tmp_path / "t--old-1")
    empty = registry(spark, sf_dir, name, 1)
    for table in empty.tables:
        object.__setattr__(table, "load", lambda _spark, load=table.load: load(_spark).limit(0))
    run(spark, SPECS[name], empty, path, settings=settings)
    assert read_table(spark, path).count() == count
