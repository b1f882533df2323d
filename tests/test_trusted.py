import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake import run_raw, run_trusted, save_trusted
from tests.conftest import rows


def pairs(spark, *values):
    return spark.createDataFrame(list(values), "p string, x int")


def job(ingest_type, **trusted):
    return {
        "job_name": "t",
        "source": {"type": "parquet", "path": "t"},
        "destination": {"path": "d/t/", "table_name": "t", "trusted": {"ingest_type": ingest_type, **trusted}},
    }


def load(spark, layers, spec, date, df, **how):
    """Run both steps of a job over ``df``."""
    df.write.mode("overwrite").parquet(f"{layers['landing']}/t")
    run_raw(spark, spec, layers, date)
    return run_trusted(spark, spec, layers, date, **how)


@pytest.mark.parametrize("kind", ["Replace", "Full"])
@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_replace(spark, tmp_path, kind, partitions):
    path = str(tmp_path / "t")
    trusted = {"ingest_type": kind, "partitions": partitions}
    save_trusted(pairs(spark, ("a", 1), ("b", 2)), path, trusted)
    save_trusted(pairs(spark, ("b", 3)), path, trusted)
    assert rows(spark.read.parquet(path), "p", "x") == [("b", 3)]


def test_replace_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    trusted = {"ingest_type": "ReplacePartition", "partitions": ["P"]}
    save_trusted(pairs(spark, ("a", 1), ("b", 2)), path, trusted)
    save_trusted(pairs(spark, ("b", 3), ("c", 4)), path, trusted)
    assert rows(spark.read.parquet(path), "p", "x") == [("a", 1), ("b", 3), ("c", 4)]


def test_replace_partition_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    save_trusted(pairs(spark, ("a", 1)), path, {"ingest_type": "ReplacePartition"})
    save_trusted(pairs(spark, ("b", 2)), path, {"ingest_type": "ReplacePartition"})
    assert rows(spark.read.parquet(path)) == [("b", 2)]


def test_one_file_per_small_partition(spark, tmp_path):
    """Rows meet before the write, whatever task they come from."""
    path = tmp_path / "t"
    df = spark.range(1000).select(F.col("id") % 3, "id").toDF("p", "x").repartition(8)
    save_trusted(df, str(path), {"ingest_type": "Replace", "partitions": ["p"]})
    assert len(list(path.glob("p=*/*.parquet"))) == 3


def test_options_reach_the_writer(spark, tmp_path):
    path = tmp_path / "t"
    trusted = {"ingest_type": "Replace", "options": {"compression": "gzip"}}
    save_trusted(pairs(spark, ("a", 1)), str(path), trusted)
    assert all(f.name.endswith(".gz.parquet") for f in path.glob("*.parquet"))


def test_session_settings_stay(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    save_trusted(pairs(spark, ("a", 1)), str(tmp_path / "t"), {"ingest_type": "ReplacePartition", "partitions": ["p"]})
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_unknown_ingest_type(spark, tmp_path):
    with pytest.raises(ValueError, match="ingest type must be one of"):
        save_trusted(pairs(spark, ("a", 1)), str(tmp_path / "t"), {"ingest_type": "Merge"})


@pytest.mark.parametrize("kind", ["Replace", "ReplacePartition"])
def test_table(spark, tmp_path, database, kind):
    path = str(tmp_path / "t")
    trusted = {"ingest_type": kind, "partitions": ["p"], "database": database}
    odd = "it's 50% \\ \"x\"/y=z"
    save_trusted(pairs(spark, ("a", 1), (odd, 2), (None, 3)), path, trusted, "t")
    assert rows(spark.table(f"{database}.t"), "p", "x") == rows(pairs(spark, ("a", 1), (odd, 2), (None, 3)))
    save_trusted(pairs(spark, (odd, 4), (None, 5), ("new", 6)), path, trusted, "t")
    want = [(odd, 4), (None, 5), ("new", 6)] + ([("a", 1)] if kind == "ReplacePartition" else [])
    assert rows(spark.table(f"{database}.t"), "p", "x") == sorted(want, key=repr)


def test_table_without_partitions(spark, tmp_path, database):
    path = str(tmp_path / "t")
    trusted = {"ingest_type": "Replace", "database": database}
    save_trusted(pairs(spark, ("a", 1)), path, trusted, "t")
    save_trusted(pairs(spark, ("a", 1)).withColumn("y", F.lit(2)), path, trusted, "t")
    assert rows(spark.table(f"{database}.t")) == [("a", 1, 2)]


def test_unknown_database_fails_before_the_write(spark, tmp_path):
    with pytest.raises(ValueError, match="no such database"):
        save_trusted(pairs(spark, ("a", 1)), str(tmp_path / "t"), {"ingest_type": "Replace", "database": "no"}, "t")
    assert not (tmp_path / "t").exists()


def test_batch_id_is_a_number_in_trusted(spark, layers):
    result = load(spark, layers, job("Replace"), "20240101", pairs(spark, ("a", 1)))
    got = spark.read.parquet(result.path)
    assert got.dtypes == [("P", "string"), ("X", "int"), ("DT_IMPORT", "int")]
    assert rows(got) == [("a", 1, 20240101)]
    assert result.rows == 1


def test_only_the_batch_of_the_date_is_taken(spark, layers):
    spec = job("Replace")
    load(spark, layers, spec, "20240102", pairs(spark, ("b", 2)))
    result = load(spark, layers, spec, "20240101", pairs(spark, ("a", 1)))
    assert rows(spark.read.parquet(result.path)) == [("a", 1, 20240101)]
    assert rows(spark.read.parquet(run_trusted(spark, spec, layers, "20240102").path)) == [("b", 2, 20240102)]


def test_missing_batch_is_no_error(spark, layers):
    result = run_trusted(spark, job("Replace"), layers, "20240101")
    assert result.rows == 0
    spec = job("Replace")
    load(spark, layers, spec, "20240101", pairs(spark, ("a", 1)))
    result = run_trusted(spark, spec, layers, "20240102")
    assert result.rows == 0
    assert rows(spark.read.parquet(result.path)) == [("a", 1, 20240101)]


def test_empty_batch_leaves_trusted_as_it_is(spark, layers):
    spec = job("Replace")
    load(spark, layers, spec, "20240101", pairs(spark, ("a", 1)))
    result = load(spark, layers, spec, "20240102", pairs(spark))
    assert result.rows == 0
    assert rows(spark.read.parquet(result.path)) == [("a", 1, 20240101)]


def test_new_column_of_a_batch_reaches_trusted(spark, layers):
    spec = job("Replace")
    load(spark, layers, spec, "20240101", pairs(spark, ("a", 1)))
    result = load(spark, layers, spec, "20240102", pairs(spark, ("a", 1)).withColumn("y", F.lit(7)))
    assert rows(spark.read.parquet(result.path), "P", "X", "Y") == [("a", 1, 7)]


def test_reader_options_of_the_destination(spark, layers):
    spec = job("Replace")
    spec["destination"]["options"] = {"mergeSchema": "true"}
    result = load(spark, layers, spec, "20240101", pairs(spark, ("a", 1)))
    assert result.rows == 1


def test_transforms_run_between_the_layers(spark, layers):
    spec = job(
        "Replace",
        transformations=[
            {"name": "Trim", "parameters": [{"column_name": "*"}]},
            {"name": "CastDate", "parameters": [{"column_name": "P", "source_format": "yyyyMMdd"}]},
            {
                "name": "RenameCast",
                "parameters": [{"column_name": "X", "new_column_name": "N", "data_type": "Integer"}],
            },
        ],
    )
    result = load(spark, layers, spec, "20240101", pairs(spark, (" 20240131 ", 1)))
    assert rows(spark.read.parquet(result.path)) == [(dt.date(2024, 1, 31), 1, 20240101)]
    result = load(spark, layers, spec, "20240101", pairs(spark, (" 20240131 ", 1)), transform_mode="last")
    assert rows(spark.read.parquet(result.path)) == [(" 20240131 ", 1, 20240101)]


def test_a_transform_that_cannot_work_writes_nothing(spark, layers, tmp_path):
    spec = job("Replace", transformations=[{"name": "Trim", "parameters": [{"column_name": "ABSENT"}]}])
    with pytest.raises(ValueError, match="no column 'ABSENT'"):
        load(spark, layers, spec, "20240101", pairs(spark, ("a", 1)))
    assert not (tmp_path / "trusted").exists()
