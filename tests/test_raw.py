import pytest
from pyspark.sql import functions as F

from stratalake import read_batch, run_raw, save_raw
from tests.conftest import rows


def job(path="t", **destination):
    return {
        "job_name": "t",
        "source": {"type": "parquet", "path": path},
        "destination": {"path": "d/t", "table_name": "t", **destination},
    }


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def test_stamps_and_upper_cases(spark, tmp_path):
    path = str(tmp_path / "raw")
    save_raw(numbers(spark, 1).withColumn("Mixed Case", F.lit("y")), path, "20240101")
    got = spark.read.parquet(path)
    assert got.columns == ["X", "MIXED CASE", "DT_IMPORT"]
    assert rows(got) == [(1, "y", 20240101)]


def test_replaces_a_batch_column_of_the_source(spark, tmp_path):
    save_raw(numbers(spark, 1).withColumn("dt_import", F.lit("old")), str(tmp_path / "raw"), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "raw"))) == [(1, 20240101)]


def test_names_that_differ_by_case_only(spark, tmp_path):
    df = numbers(spark, 1).toDF("a").select("a", F.lit(2).alias("A"))
    with pytest.raises(ValueError, match="appear more than once"):
        save_raw(df, str(tmp_path / "raw"), "20240101")


def test_rerun_replaces_its_date_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    save_raw(numbers(spark, 1, 2), path, "20240101")
    save_raw(numbers(spark, 3), path, "20240102")
    save_raw(numbers(spark, 4), path, "20240101")
    assert rows(spark.read.parquet(path)) == [(3, 20240102), (4, 20240101)]


def test_empty_rerun_keeps_the_date(spark, tmp_path):
    path = str(tmp_path / "raw")
    save_raw(numbers(spark, 1), path, "20240101")
    save_raw(numbers(spark), path, "20240101")
    assert rows(spark.read.parquet(path)) == [(1, 20240101)]


def test_session_settings_stay(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    save_raw(numbers(spark, 1), str(tmp_path / "raw"), "20240101")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_a_raw_write_has_no_shuffle(spark, tmp_path, monkeypatch):
    numbers(spark, *range(100)).repartition(4).write.parquet(str(tmp_path / "s"))
    save_raw(spark.read.parquet(str(tmp_path / "s")), str(tmp_path / "raw"), "20240101")
    files = list((tmp_path / "raw" / "DT_IMPORT=20240101").glob("*.parquet"))
    assert 1 <= len(files) <= 4


def test_table(spark, tmp_path, database):
    path = str(tmp_path / "raw")
    for date in ("20240101", "20240102"):
        save_raw(numbers(spark, 1), path, date, database, "t")
    table = spark.table(f"{database}.t")
    assert table.dtypes == [("X", "int"), ("DT_IMPORT", "string")]
    assert rows(table) == [(1, "20240101"), (1, "20240102")]
    save_raw(numbers(spark, 5), path, "20240102", database, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, "20240101"), (5, "20240102")]


def test_table_takes_the_newest_schema(spark, tmp_path, database):
    path = str(tmp_path / "raw")
    save_raw(numbers(spark, 1), path, "20240101", database, "t")
    save_raw(numbers(spark, 2).withColumn("new", F.lit("n")), path, "20240102", database, "t")
    table = spark.table(f"{database}.t")
    assert table.columns == ["X", "NEW", "DT_IMPORT"]
    assert rows(table) == [(1, None, "20240101"), (2, "n", "20240102")]


def test_table_follows_its_path(spark, tmp_path, database):
    save_raw(numbers(spark, 1), str(tmp_path / "a"), "20240101", database, "t")
    save_raw(numbers(spark, 2), str(tmp_path / "b"), "20240101", database, "t")
    assert rows(spark.table(f"{database}.t")) == [(2, "20240101")]


def test_empty_first_run_of_a_table(spark, tmp_path, database):
    path = str(tmp_path / "raw")
    save_raw(numbers(spark), path, "20240101", database, "t")
    assert rows(spark.table(f"{database}.t")) == []
    save_raw(numbers(spark, 1), path, "20240102", database, "t")
    save_raw(numbers(spark), path, "20240103", database, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, "20240102")]


def test_unknown_database_fails_before_the_write(spark, tmp_path):
    with pytest.raises(ValueError, match="no such database"):
        save_raw(numbers(spark, 1), str(tmp_path / "raw"), "20240101", "nowhere", "t")
    assert not (tmp_path / "raw").exists()


def test_a_managed_table_is_left_alone(spark, tmp_path, database):
    numbers(spark, 7).write.saveAsTable(f"{database}.t")
    with pytest.raises(ValueError, match="not an external table but MANAGED"):
        save_raw(numbers(spark, 1), str(tmp_path / "raw"), "20240101", database, "t")
    assert not (tmp_path / "raw").exists()
    assert rows(spark.table(f"{database}.t")) == [(7,)]


def test_a_database_needs_a_table_name(spark, tmp_path, database):
    with pytest.raises(ValueError, match="no table name"):
        save_raw(numbers(spark, 1), str(tmp_path / "raw"), "20240101", database)


def test_read_batch(spark, tmp_path):
    path = str(tmp_path / "raw")
    save_raw(numbers(spark, 1), path, "20240101")
    save_raw(numbers(spark, 2).withColumn("new", F.lit(9)), path, "20240102")
    got = read_batch(spark, path + "/", "20240102")
    assert got.dtypes == [("X", "int"), ("NEW", "int"), ("DT_IMPORT", "int")]
    assert rows(got) == [(2, 9, 20240102)]
    assert read_batch(spark, path, "20240103") is None
    assert read_batch(spark, str(tmp_path / "nothing"), "20240101") is None
    assert read_batch(spark, path, "20240101").inputFiles()[0].count("DT_IMPORT=20240101") == 1


def test_missing_source_is_an_error(spark, layers):
    with pytest.raises(ValueError, match="no Parquet data"):
        run_raw(spark, job("absent"), layers, "20240101")


def test_conditions_apply_to_incremental_runs_only(spark, layers):
    spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id AS INT)) AS d FROM range(10)").write.parquet(
        f"{layers['landing']}/t"
    )
    spec = job()
    spec["source"]["conditions"] = [{"filter_date": "d", "days": 0, "compare": ">="}]
    assert spark.read.parquet(run_raw(spark, spec, layers, "20240108")).count() == 3
    assert spark.read.parquet(run_raw(spark, spec, layers, "20240108", incremental=False)).count() == 10


@pytest.mark.parametrize("date", ["2024-01-01", "20241301", "x"])
def test_batch_dates_are_checked(spark, layers, date):
    with pytest.raises(ValueError):
        run_raw(spark, job(), layers, date)
