"""Tables whose versions are lists of files."""

import random

import pytest
from pyspark.sql import functions as F

from roadstrata.sinks.silver import merge_partitions
from roadstrata.sinks.versions import Conflict, VersionedTable
from roadstrata.workspace import path_exists

SCHEMA = "k int, d string, v string"


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), "d", ["k"])


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_a_late_batch_opens_only_files_that_hold_its_keys(spark, table):
    """Eight files a day: one known key opens one of them, new keys none."""
    first = spark.range(800).selectExpr("cast(id as int) as k", "concat('d', id % 2) as d", "'x' as v")
    made = table.replace_partitions(first.repartition(8), layout="as_is")
    assert made.written == 16
    new = table.merge(batch(spark, (1000, "d0", "y"), (1001, "d9", "y")))
    assert (new.opened, new.kept) == (0, made.written)
    late = table.merge(batch(spark, (4, "d0", "a"), (1002, "d0", "y")))
    assert (late.opened, late.kept) == (1, made.written + new.written - 1)
    again = table.merge(batch(spark, (4, "d0", "a"), (1002, "d0", "y")))
    assert again.opened >= 1 and rows_of(table.read(late.version)) == rows_of(table.read())
    assert table.read().count() == table.read().select("k").distinct().count() == 803
    scanned = table.read().filter("d = 'd9'").inputFiles()
    assert all("/d=" in name for name in scanned)


def test_only_the_old_or_the_new_version_is_seen(spark, table, monkeypatch):
    table.merge(batch(spark, (1, "a", "x"), (2, "b", "x")))
    before, seen = table.read(), []
    swap = VersionedTable._swap_in

    def watched(self, attempt, version):
        seen.append(rows_of(table.read()))
        swap(self, attempt, version)

    monkeypatch.setattr(VersionedTable, "_swap_in", watched)
    table.merge(batch(spark, (3, "a", "y"), (2, "b", "a"), (4, "c", "y")), ["v"])
    assert seen == [rows_of(batch(spark, (1, "a", "x"), (2, "b", "x")))]
    assert rows_of(table.read()) == rows_of(batch(spark, (1, "a", "x"), (2, "b", "a"), (3, "a", "y"), (4, "c", "y")))
    # A reader from before still has its files, and older versions can be read.
    assert rows_of(before) == rows_of(table.read(0)) == seen[0]


def test_the_second_of_two_writers_is_refused(spark, table, monkeypatch):
    table.merge(batch(spark, (1, "a", "x")))
    swap, other = VersionedTable._swap_in, VersionedTable(spark, table.path, "d", ["k"])

    def beaten(self, attempt, version):
        monkeypatch.setattr(VersionedTable, "_swap_in", swap)
        other.merge(batch(spark, (2, "a", "other")))
        swap(self, attempt, version)

    monkeypatch.setattr(VersionedTable, "_swap_in", beaten)
    with pytest.raises(Conflict):
        table.merge(batch(spark, (3, "b", "mine")))
    assert table.versions() == [0, 1]
    assert rows_of(table.read()) == rows_of(batch(spark, (1, "a", "x"), (2, "a", "other")))
    assert table.vacuum() == 0 and table.versions() == [1]
    assert table.merge(batch(spark, (3, "b", "mine"))).version == 2 and table.read().count() == 3


def test_a_writer_that_is_lost_leaves_nothing_to_be_seen(spark, table, monkeypatch):
    table.merge(batch(spark, (1, "a", "x")))

    def lost(self, attempt, version):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_swap_in", lost)
        patched.setattr(VersionedTable, "_discard", lambda self, load: None)
        with pytest.raises(KeyboardInterrupt):
            table.merge(batch(spark, (2, "a", "y")))
    assert table.read().count() == 1
    assert table.merge(batch(spark, (2, "a", "y"))).version == 1
    assert table.read().count() == 2 and table.vacuum(versions=2) == 1


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_merge_of_whole_days(spark, tmp_path, table, seed):
    """Nulls, ties and repeated rows, odd names of days: the same rows as with merge_partitions."""
    pick = random.Random(seed)
    days = [None, "d 1:%", "ü/é", "plain", "a=b"]
    plain = str(tmp_path / "plain")
    for _ in range(4):
        rows = []
        for _ in range(pick.randrange(1, 60)):
            k = pick.choice([None, *range(30)])
            rows.append((k, days[(k or 0) % 5], pick.choice(["x", "y", None])))
        one = batch(spark, *rows)
        merge_partitions(one, plain, keys=["k"], partition="d")
        table.merge(one)
    assert rows_of(table.read()) == rows_of(spark.read.parquet(plain).select("k", "d", "v"))


def test_empty_batches_and_empty_tables(spark, table):
    assert table.versions() == []
    with pytest.raises(Exception):
        table.read().count()
    none = spark.createDataFrame([], SCHEMA)
    assert table.merge(none).written == 0 and table.read().count() == 0
    assert table.read().dtypes == none.dtypes
    table.merge(batch(spark, (1, "a", "x")))
    assert table.merge(none).kept == 1 and rows_of(table.read()) == rows_of(batch(spark, (1, "a", "x")))


def test_columns_that_come_later_and_clashing_names(spark, table):
    table.merge(batch(spark, (1, "a", "x"), (2, "a", "x")))
    more = spark.createDataFrame([(2, "a", "b", 7, "l"), (3, "a", "z", 8, "l")], f"{SCHEMA}, file int, part string")
    table.merge(more, ["v"])
    got = {r.k: (r.v, r.file, r.part) for r in table.read().collect()}
    assert got == {1: ("x", None, None), 2: ("b", 7, "l"), 3: ("z", 8, "l")}
    assert table.read(0).columns == ["k", "v", "d"] or table.read(0).columns == ["k", "d", "v"]
    with pytest.raises(ValueError, match="in the batch"):
        table.merge(batch(spark, (1, "a", "x")).withColumn("k", F.col("k").cast("bigint")))


def test_many_partitions_are_replaced_at_once_and_compacted(spark, table):
    for i in range(3):
        table.merge(batch(spark, (i, "a", "x"), (10 + i, None, "x"), (20 + i, "c", "x")))
    done = table.replace_partitions(batch(spark, (50, "a", "n"), (51, None, "n"), (52, "z", "n")))
    assert (done.opened, done.kept) == (6, 3)
    whole = rows_of(table.read())
    assert whole == rows_of(batch(spark, (50, "a", "n"), (51, None, "n"), (52, "z", "n"), *[(20 + i, "c", "x") for i in range(3)]))
    packed = table.compact(["c", None])
    assert (packed.opened, packed.written) == (4, 2) and rows_of(table.read()) == whole
    loads = {r.load for r in table.files(packed.version).collect()}
    assert table.vacuum() == 3 and rows_of(table.read()) == whole
    assert all(path_exists(spark, f"{table.path}/keys/load={load}") for load in loads)
    # Keys of what was written anew are known.
    assert table.merge(batch(spark, (20, "c", "x"))).opened == 1
