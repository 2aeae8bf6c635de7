from pathlib import Path

import pytest
from conftest import plan, values

from stratalift.sinks import (
    append_audit,
    catalog_name,
    dated_snapshot,
    register_catalog,
    write_catalog,
    write_jdbc,
    write_layer,
)
from stratalift.sources import read_dated, read_layer
from stratalift.staging import stage_rows, staging_path


def test_write_layer_caps_records_per_file_and_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.range(0, 1500, numPartitions=1), path, max_records=400)
    assert len(list(Path(path).glob("*.parquet"))) == 4
    write_layer(spark.createDataFrame([("a",)], "v string"), path)
    assert values(read_layer(spark, path)) == [("a",)]


def test_write_layer_raises(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)nosuchformat"):
        write_layer(spark.range(1), str(tmp_path / "t"), "nosuchformat")


def test_snapshots_by_day(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, n in (("2025-03-01", 5), ("2025-03-02", 2), ("2025-03-01", 3)):
        dated_snapshot(spark.range(n), path, day)
    assert read_dated(spark, path, "2025-03-01").count() == 3
    latest = read_dated(spark, path)
    assert latest.columns == ["id"] and latest.count() == 2
    assert latest.inputFiles() and all("run_date=2025-03-02" in f for f in latest.inputFiles())
    assert read_dated(spark, path, "2025-04-01").count() == 0
    # a day that is now empty is empty
    dated_snapshot(spark.range(0), path, "2025-03-02")
    assert read_dated(spark, path).count() == 0
    with pytest.raises(ValueError):
        dated_snapshot(spark.range(1), path, "yesterday")
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError, match="no run_date folder"):
        read_dated(spark, str(empty))


def test_a_day_keeps_its_own_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    dated_snapshot(spark.createDataFrame([(1, 2)], "id int, x int"), path, "2025-03-01")
    dated_snapshot(spark.createDataFrame([("a", 2, 3)], "id string, x int, y int"), path, "2025-03-02")
    assert values(read_dated(spark, path, "2025-03-01")) == [(1, 2)]
    assert values(read_dated(spark, path, "2025-03-02")) == [("a", 2, 3)]


def test_catalog(spark, tmp_path):
    name = catalog_name("default", "Fam-ily", "Demo Table", "SL")
    assert name == "default.Fam_ily_Demo_Table_SL"
    write_catalog(spark.range(3), name)
    write_catalog(spark.createDataFrame([("x",)], "v string"), name)
    assert values(spark.table(name)) == [("x",)]
    path = str(tmp_path / "t")
    dated_snapshot(spark.range(4), path, "2025-03-01")
    with pytest.raises(ValueError, match="rows of its own"):
        register_catalog(spark, name, path)
    assert spark.table(name).count() == 1
    spark.sql(f"drop table {name}")
    for _ in range(2):
        register_catalog(spark, name, path)
        assert spark.table(name).count() == 4
    spark.sql(f"drop table {name}")


def test_audit_rows_append(spark):
    for n in (1, 2):
        append_audit(spark.createDataFrame([(n, ["a"])], "n int, l array<string>"), "audit_rows")
    assert spark.table("audit_rows").count() == 2
    spark.sql("drop table audit_rows")


class Flaky:
    """A database that fails some times; each attempt gets the whole frame."""

    def __init__(self, failures):
        self.failures = failures
        self.calls = []

    def __call__(self, df, options):
        self.calls.append((df.count(), df.rdd.getNumPartitions(), options))
        if len(self.calls) <= self.failures:
            raise ConnectionError(f"failure {len(self.calls)}")


def write(spark, save, **more):
    df = spark.range(10)
    write_jdbc(df, "jdbc:x:y", "fact.t", "some.Driver", partitions=3, delay=0, save=save, **more)


def test_jdbc_write_tries_again(spark):
    database = Flaky(2)
    write(spark, database, properties={"user": "u"})
    assert len(database.calls) == 3
    rows, partitions, options = database.calls[-1]
    assert rows == 10 and partitions <= 3
    assert options == {
        "url": "jdbc:x:y",
        "dbtable": "fact.t",
        "driver": "some.Driver",
        "batchsize": "10000",
        "user": "u",
    }


def test_jdbc_write_raises_the_last_error(spark):
    database = Flaky(99)
    with pytest.raises(ConnectionError, match="failure 4"):
        write(spark, database, attempts=4)
    assert len(database.calls) == 4


def test_jdbc_write_waits_between_attempts_only(spark, monkeypatch):
    waits = []
    monkeypatch.setattr("stratalift.sinks.jdbc.time.sleep", waits.append)
    with pytest.raises(ConnectionError):
        write_jdbc(spark.range(1), "u", "t", "d", attempts=3, delay=5, save=Flaky(99))
    # Spark sleeps now and then too
    assert [w for w in waits if w == 5] == [5, 5]


def test_jdbc_writer_reports_a_missing_driver(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        write_jdbc(spark.range(1), "jdbc:none:x", "t", "no.such.Driver", attempts=1)


def test_staging_goes_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging_path(spark).startswith(root)
    assert staging_path(spark) != staging_path(spark)
    staged = stage_rows(spark.range(5))
    assert "FileScan parquet" in plan(staged) and staged.count() == 5


class Settings:
    """A session as far as the staging folder is concerned."""

    def __init__(self, **settings):
        self.settings = {name.replace("_", "."): value for name, value in settings.items()}
        self.conf = self

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_only_local_sessions_stage_on_the_machine():
    assert staging_path(Settings(spark_master="local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_path(Settings(spark_master="yarn"))
    shared = Settings(spark_master="yarn", spark_checkpoint_dir="hdfs:/shared/")
    assert staging_path(shared).startswith("hdfs:/shared/stratalift/")
