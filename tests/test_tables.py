"""JDBC tables against a recorded reader and writer: no database runs in tests."""

import pytest

from tideline import JdbcTable, ParquetTable


class Recorder:
    """Stands in for a DataFrameWriter or DataFrameReader."""

    def __init__(self, calls, loaded=None):
        self.calls, self.loaded = calls, loaded

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def mode(self, name):
        self.calls.append(("mode", name))
        return self

    def options(self, **options):
        self.calls.append(("options", options))
        return self

    def save(self):
        self.calls.append(("save",))

    def load(self):
        return self.loaded


@pytest.fixture
def table(monkeypatch):
    monkeypatch.setenv("POSTGRES_PASSWORD", "secret")
    return JdbcTable.postgres("db", 5432, "weather", "daily", "user", "POSTGRES_PASSWORD", connections=4)


def test_postgres_options(table):
    assert table.options() == {
        "url": "jdbc:postgresql://db:5432/weather",
        "dbtable": "daily",
        "user": "user",
        "password": "secret",
        "driver": "org.postgresql.Driver",
    }
    assert "secret" not in repr(table)


def test_overwrite_truncates_and_bounds_connections(spark, table, monkeypatch):
    calls = []
    df = spark.range(3)
    monkeypatch.setattr(type(df), "write", property(lambda self: Recorder(calls)))
    monkeypatch.setattr(JdbcTable, "read", lambda self, spark: spark.range(3))
    table.overwrite(df)
    assert ("format", "jdbc") in calls and ("mode", "overwrite") in calls
    options = next(c[1] for c in calls if c[0] == "options")
    assert options["truncate"] == "true" and options["numPartitions"] == "4"
    assert options["batchsize"] == "10000"


def test_repeated_rows_are_noticed(spark, table, monkeypatch):
    df = spark.range(3)
    monkeypatch.setattr(type(df), "write", property(lambda self: Recorder([])))
    monkeypatch.setattr(JdbcTable, "read", lambda self, spark: spark.range(4))
    with pytest.raises(RuntimeError, match="holds 4 rows after writing 3"):
        table.overwrite(df)


def test_a_repeated_task_makes_the_overwrite_start_over(spark, table, monkeypatch):
    calls, found = [], iter([4, 3])
    df = spark.range(3)
    monkeypatch.setattr(type(df), "write", property(lambda self: Recorder(calls)))
    monkeypatch.setattr(JdbcTable, "read", lambda self, spark: spark.range(next(found)))
    table.overwrite(df)
    assert calls.count(("save",)) == 2


def test_append_and_read(spark, table, monkeypatch):
    calls = []
    df = spark.range(3)
    monkeypatch.setattr(type(df), "write", property(lambda self: Recorder(calls)))
    table.append(df)
    assert ("mode", "append") in calls
    monkeypatch.setattr(type(spark), "read", property(lambda self: Recorder(calls, loaded="rows")))
    assert table.read(spark) == "rows"


def test_parquet_table(spark, tmp_path):
    table = ParquetTable(str(tmp_path / "t"))
    table.append(spark.range(2))
    table.append(spark.range(3))
    assert table.read(spark).count() == 5
    table.overwrite(spark.range(1))
    assert table.read(spark).count() == 1
