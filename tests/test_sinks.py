"""Serving sinks and session settings. No database is started: the JDBC options are checked."""

import pytest

from roadstrata.session import build_session, object_store_conf, object_store_from_env
from roadstrata.sinks.gold import JdbcTarget, publish, write_gold, write_jdbc
from roadstrata.sinks.metrics import RunMetrics, stored_rows
from roadstrata.workspace import (
    discard,
    path_exists,
    scratch_path,
    session_setting,
    shared_folder,
    shuffle_width,
)

TARGET = JdbcTarget("jdbc:postgresql://db/gold", "org.postgresql.Driver", "u", "secret")


class RecordingWriter:
    """Stands in for a DataFrameWriter and remembers what it was told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def save(self):
        self.told["saved"] = True


class Frame:
    def __init__(self):
        self.write = RecordingWriter()


def test_jdbc_options():
    frame = Frame()
    write_jdbc(frame, TARGET, "dim_owner", "overwrite")
    assert frame.write.told == {
        "format": "jdbc", "url": "jdbc:postgresql://db/gold", "driver": "org.postgresql.Driver",
        "dbtable": "dim_owner", "batchsize": "10000", "numPartitions": "4",
        "isolationLevel": "READ_COMMITTED", "user": "u", "password": "secret",
        "truncate": "true", "mode": "overwrite", "saved": True,
    }


def test_jdbc_append_without_transactions():
    frame = Frame()
    target = JdbcTarget("jdbc:x:y", "d", isolation="NONE", extra={"sessionInitStatement": "set x"})
    write_jdbc(frame, target, "t")
    told = frame.write.told
    assert told["isolationLevel"] == "NONE" and told["mode"] == "append"
    assert "truncate" not in told and "user" not in told and told["sessionInitStatement"] == "set x"
    with pytest.raises(ValueError):
        write_jdbc(frame, target, "t", "ignore")


def test_secrets_stay_out_of_repr():
    assert "secret" not in repr(TARGET)


@pytest.fixture
def served(monkeypatch):
    calls = []
    monkeypatch.setattr(
        "roadstrata.sinks.gold.write_jdbc",
        lambda df, target, table, mode: calls.append((table, mode, df.columns, df.count())),
    )
    return calls


def test_publish_serves_from_files(spark, tmp_path, served):
    df = spark.range(10).selectExpr("id", "id % 2 as day")
    stored = publish(df, str(tmp_path), "t", partition_by=["day"], jdbc=TARGET)
    assert stored.count() == 10 and stored.columns == ["id", "day"]
    assert "FileScan" in stored._jdf.queryExecution().executedPlan().toString()
    publish(df, str(tmp_path), "t", mode="append", jdbc=TARGET)
    assert served == [("t", "overwrite", ["id"], 10), ("t", "append", ["id", "day"], 10)]


def test_publish_evaluates_once(spark, tmp_path, served):
    evaluated = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    df = spark.range(10).mapInArrow(counting, "id bigint")
    publish(df, str(tmp_path), "once", jdbc=TARGET).count()
    assert evaluated.value == 10


def test_gold_modes(spark, tmp_path):
    df = spark.range(6).selectExpr("id", "id % 3 as day")
    root = str(tmp_path)
    write_gold(df, root, "t", partition_by=["day"])
    one_day = df.filter("day = 1").withColumn("id", df.id * 10)
    path = write_gold(one_day, root, "t", partition_by=["day"], keep_other_partitions=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5, 10, 40]
    write_gold(one_day, root, "t", partition_by=["day"])
    assert stored_rows(spark, path) == 2


def test_metrics_table(spark, tmp_path):
    metrics = RunMetrics("r1")
    with metrics.stage("write") as stage:
        stage.rows = 3
    metrics.record("noted", None)
    metrics.write(spark, str(tmp_path / "m"))
    stored = {r.stage: r for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert stored["write"].rows == 3 and stored["write"].seconds >= 0
    assert stored["noted"].rows is None and metrics.rows() == {"write": 3, "noted": None}


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_only_own_intermediate_tables_are_discarded(spark, tmp_path):
    own, other = scratch_path(spark, "x"), tmp_path / "kept"
    spark.range(1).write.parquet(own)
    spark.range(1).write.parquet(str(other))
    discard(spark, own)
    assert not path_exists(spark, own)
    with pytest.raises(ValueError):
        discard(spark, str(other))
    assert path_exists(spark, str(other))


def test_shuffle_width_follows_the_input(spark, tmp_path):
    spark.range(100_000).repartition(1).write.parquet(str(tmp_path / "t"))
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_width(spark, str(tmp_path / "t")) == floor
    assert shuffle_width(spark, str(tmp_path / "t"), bytes_per_task=1000) > 100
    assert shuffle_width(spark, more_bytes=10**9, bytes_per_task=1000) == 10**6


def test_session_setting_is_put_back(spark):
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError):
        with session_setting(spark, name, "7kb"):
            assert spark.conf.get(name) == "7kb"
            raise RuntimeError
    assert spark.conf.get(name) == before


def test_object_store_settings():
    conf = object_store_conf("http://store:9000", "key", "secret", extra={"connection.maximum": "100"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.maximum"] == "100"
    assert object_store_from_env({}) == {}
    from_env = object_store_from_env(
        {"AWS_ENDPOINT_URL": "https://s3", "AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b"}
    )
    assert from_env["spark.hadoop.fs.s3a.access.key"] == "a"
    assert from_env["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_build_session_keeps_caller_settings(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    same = build_session(conf={"spark.sql.shuffle.partitions": "8"})
    assert same.sparkContext is spark.sparkContext or same.sparkContext.applicationId == spark.sparkContext.applicationId
    assert same.conf.get("spark.sql.session.timeZone") == zone == "UTC"
