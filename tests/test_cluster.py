from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalake import save_trusted, upsert
from stratalake.operators.cluster import clustered, range_starts, with_curve
from stratalake.sinks import upsert as upsert_module
from stratalake.sinks.upsert import _within
from tests.conftest import rows


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "trusted" / "t")


@pytest.fixture(autouse=True)
def files_of_any_size(spark, monkeypatch):
    """Files here are tiny: they are neither joined by adaptive execution nor compacted."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(upsert_module, "SMALL_FILE_BYTES", 0)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def ranges(path, name):
    """The least and the largest value of each file, by its statistics."""
    found = []
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            for i in range(meta.num_columns):
                stats = meta.row_group(group).column(i)
                if stats.path_in_schema == name:
                    found.append((stats.statistics.min, stats.statistics.max))
    return sorted(found)


def names(path):
    return {p.name for p in Path(path).rglob("*.parquet")}


def read_rows(df):
    """How many rows the scan of a frame without a shuffle gives out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def table(spark, n, version=1):
    return spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.lit(version).alias("o"), F.col("id").cast("string").alias("v"))


def test_files_hold_ranges_of_a_key(spark, path):
    upsert(table(spark, 4000), path, ["k"], ["o"], cluster=True)
    found = ranges(path, "k")
    assert len(found) == 4
    assert all(a[1] < b[0] for a, b in zip(found, found[1:], strict=False))


def test_a_batch_of_a_range_reads_and_rewrites_few_files(spark, path):
    upsert(table(spark, 4000), path, ["k"], ["o"], cluster=True)
    before = names(path)
    batch = table(spark, 4000, 2).filter("k BETWEEN 10 AND 200")
    target = spark.read.parquet(path)
    rule = upsert_module.Rule(["k"], ["o"], [], True)
    inside = target.where(_within(target, rule, upsert_module._measure(batch, rule))).select("k")
    assert read_rows(inside) < 1500 and read_rows(target.select("k")) == 4000
    upsert(batch, path, ["k"], ["o"], cluster=True)
    assert len(names(path) & before) == 3
    expected = [(k, 2 if 10 <= k <= 200 else 1) for k in range(4000)]
    assert rows(spark.read.parquet(path), "k", "o") == sorted(expected, key=repr)
    found = ranges(path, "k")
    assert all(a[1] < b[0] for a, b in zip(found, found[1:], strict=False))


def test_ranges_of_either_of_two_keys_are_in_few_files(spark, path):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        grid = spark.range(64 * 64).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"), F.lit(1).alias("o"))
        upsert(grid, path, ["a", "b"], ["o"], cluster=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(names(path)) == 16
    for name in ("a", "b"):
        met = [r for r in ranges(path, name) if r[0] <= 7]
        assert 3 <= len(met) <= 8


def test_a_hot_value_is_in_several_tasks(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"))
    sizes = clustered(hot, ["a", "b"]).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1500


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("string", ["", "a", "é", "zz", "10", "9"]),
        ("date", [date(2024, 1, d) for d in range(1, 7)]),
        ("timestamp", [datetime(2024, 1, d) for d in range(1, 7)]),
        ("timestamp_ntz", [datetime(2024, 1, d, 5, 6, 7, 8) for d in range(1, 7)]),
        ("decimal(20,3)", [Decimal(d) / 8 for d in range(-3, 3)]),
        ("double", [-1.5, 0.0, 1e-300, 1e300, float("inf"), 3.0]),
        ("boolean", [True, False]),
        ("binary", [b"", b"a", b"\xff", b"b"]),
    ],
)
@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_keys_of_any_type(spark, path, kind, values, partitions):
    def given(values, version):
        return spark.createDataFrame([(v, i, version, i % 2) for v in values for i in range(3)], f"k {kind}, n int, o int, p int")

    upsert(given(values[:-1], 1), path, ["k", "n"], ["o"], partitions, cluster=True)
    upsert(given(values[1:], 2), path, ["n", "k"], ["o"], partitions, cluster=True)
    expected = given(values[:1], 1).union(given(values[1:], 2))
    assert rows(spark.read.parquet(path), "k", "n", "o", "p") == rows(expected)


def test_keys_beyond_the_curve(spark, path):
    """Structs are keys, but have no ranges; a key that is a partition needs none."""
    made = spark.range(20).select(F.struct("id").alias("s"), (F.col("id") % 3).alias("p"), "id", F.lit(1).alias("o"))
    upsert(made, path, ["s", "p", "id"], ["o"], ["p"], cluster=True)
    upsert(made.filter("id > 5").withColumn("o", F.lit(2)), path, ["s", "p", "id"], ["o"], ["p"], cluster=True)
    assert rows(spark.read.parquet(path), "id", "o") == sorted(((i, 1 + (i > 5)) for i in range(20)), key=repr)
    assert clustered(made, ["p"], ["p"]).count() == 20
    assert clustered(made, []).count() == 20


def test_cells_follow_the_order_of_keys(spark):
    one = spark.range(1000).select("id", F.lit(5).alias("same"))
    assert [len(s) for s in range_starts(one, ["id", "same"], 8)] == [7, 1]
    placed = with_curve(one, ["id", "same"]).orderBy("id").select("__curve").collect()
    assert [r[0] for r in placed] == sorted(r[0] for r in placed) and len({r[0] for r in placed}) == 64
    assert [len(s) for s in range_starts(one.limit(0), ["id"], 8)] == [0]
    assert rows(clustered(one.limit(0), ["id", "same"])) == []


def test_a_job_asks_for_it(spark, path, database):
    for publish in ("auto", "switch"):
        trusted = {"ingest_type": "Upsert", "key_column": "k", "order_column": "o", "database": database, "cluster": True, "publish": publish}
        where = f"{path}-{publish}"
        save_trusted(table(spark, 1000), where, trusted, f"t_{publish}")
        save_trusted(table(spark, 1000, 2).filter("k < 30"), where, trusted, f"t_{publish}")
        found = spark.table(f"{database}.t_{publish}")
        assert found.count() == 1000 and found.filter("o = 2").count() == 30
