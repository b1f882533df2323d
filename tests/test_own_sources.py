from datetime import date
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stratalake import read_source, register_source
from tests.conftest import rows

PUSHES = "spark.sql.python.filterPushdown.enabled"
SOURCE = {"type": "arrow", "path": "t"}


@pytest.fixture
def pushing(spark):
    spark.conf.set(PUSHES, "true")
    yield
    spark.conf.unset(PUSHES)


def put(layers, name, table, rows_a_batch=1000):
    folder = f"{layers['landing']}/t"
    pa.fs.LocalFileSystem().create_dir(folder)
    with pa.OSFile(f"{folder}/{name}", "wb") as file, pa.ipc.new_file(file, table.schema) as writer:
        writer.write_table(table, max_chunksize=rows_a_batch)


def sample():
    return pa.table(
        {
            "n": pa.array([1, 2, None, 4], pa.int32()),
            "s": ["a", "ab", None, ""],
            "d": pa.array([date(2024, 1, 1), None, date(2024, 1, 3), date(2024, 1, 4)]),
            "x": pa.array([Decimal("1.50"), Decimal("2.00"), None, Decimal("-3.25")], pa.decimal128(9, 2)),
            "f": [1.0, float("nan"), None, -1.0],
        }
    )


@pytest.mark.parametrize(
    "condition",
    [
        "n > 1", "n = 4", "n <> 4", "n <=> 4", "n <=> null", "n in (1, 4)", "n not in (1, 4)", "n is null", "n is not null", "not n >= 2",
        "s = 'a'", "s like 'a%'", "s not like 'a%'", "s like '%b'", "s < 'ab'", "s = ''",
        "d >= date'2024-01-03'", "d <> date'2024-01-03'", "x = 2", "x < 0.5", "f > 0", "f = double('NaN')", "n + 1 = 5", "n = 1 or s = ''",
    ],
)
def test_pushed_conditions_give_what_spark_gives(spark, layers, pushing, condition):
    put(layers, "a.arrow", sample())
    found = read_source(spark, SOURCE, layers)
    here = spark.createDataFrame(rows(found), found.schema)
    assert sorted(map(repr, rows(found.where(condition)))) == sorted(map(repr, rows(here.where(condition))))


def test_conditions_reach_the_scan_where_the_session_allows(spark, layers, pushing, capsys):
    put(layers, "a.arrow", sample())
    read_source(spark, SOURCE, layers).where("n > 1 and f > 0").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(n,1)" in plan.split("PushedFilters")[1]
    assert "f#" in plan.split("Condition")[1] and "n#" not in plan.split("Condition")[1].split("\n")[0]


def test_without_pushed_conditions(spark, layers):
    put(layers, "a.arrow", sample())
    assert rows(read_source(spark, SOURCE, layers).where("n > 1").select("n")) == [(2,), (4,)]


def test_each_batch_is_read_once_by_several_tasks(spark, layers):
    put(layers, "a.arrow", pa.table({"n": range(10_000)}), 100)
    put(layers, "b.arrow", pa.table({"n": range(10_000, 10_007)}), 1)
    put(layers, "c.arrow", pa.table({"n": pa.array([], pa.int64())}))
    put(layers, "d.txt", pa.table({"n": [-1]}))
    found = read_source(spark, {**SOURCE, "options": {"split_bytes": "5000"}}, layers)
    assert sorted(n for (n,) in rows(found)) == list(range(10_007))
    assert found.select(F.spark_partition_id()).distinct().count() > 10


def test_files_that_differ(spark, layers):
    words = pa.array(["x", "y", "x"]).dictionary_encode()
    put(layers, "a.arrow", pa.table({"n": [1, 2, 3], "w": words}))
    put(layers, "b.arrow", pa.table({"extra": [True], "n": pa.array([4], pa.int8())}))
    assert sorted(rows(read_source(spark, SOURCE, layers))) == [(1, "x"), (2, "y"), (3, "x"), (4, None)]


def test_one_file_and_none(spark, layers):
    put(layers, "a.arrow", sample())
    assert read_source(spark, {"type": "arrow", "path": "t/a.arrow"}, layers).count() == 4
    with pytest.raises(Exception, match="no Arrow files at"):
        read_source(spark, {"type": "arrow", "path": "nothing"}, layers).count()


def test_a_source_of_a_users_own(spark, layers):
    class Squares(DataSource):
        @classmethod
        def name(cls):
            return "squares"

        def schema(self):
            return "n long, square long"

        def reader(self, schema):
            class Read(DataSourceReader):
                def partitions(self):
                    return [InputPartition(i) for i in range(3)]

                def read(self, partition):
                    yield (partition.value, partition.value**2)

            return Read()

    register_source("squares", Squares)
    found = read_source(spark, {"type": "squares"}, layers)
    assert sorted(rows(found)) == [(0, 0), (1, 1), (2, 4)]
    assert found.rdd.getNumPartitions() == 3
