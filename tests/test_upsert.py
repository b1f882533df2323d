from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake import latest_per_key, save_trusted, upsert
from stratalake.operators.merge import Rule, merge_newest
from stratalake.sinks import staging, storage
from stratalake.sinks import upsert as upsert_module
from tests.conftest import rows


def batch(spark, *values, schema="k int, o int, v string"):
    return spark.createDataFrame(list(values), schema)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "trusted" / "t")


def stored(spark, path):
    return rows(spark.read.parquet(path))


# One row per key


def test_latest_takes_the_largest_order(spark):
    df = batch(spark, (1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, None, "d"), (2, 0, "e"), (None, 1, "f"))
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 3, "b"), (2, 0, "e"), (None, 1, "f")]


def test_latest_breaks_ties_by_all_columns(spark):
    df = batch(spark, (1, 1, "a"), (1, 1, "c"), (1, 1, None), (1, 1, "b"))
    for shuffled in (df, df.repartition(4), df.orderBy(F.desc("v"))):
        assert rows(latest_per_key(shuffled, ["k"], ["o"])) == [(1, 1, "c")]


def test_latest_with_columns_that_have_no_order(spark):
    df = spark.sql(
        """
        SELECT 1 AS k, 1 AS o, map('a', x) AS m, array(map('b', x)) AS ms, named_struct('s', map('c', x)) AS n
        FROM VALUES (1), (3), (2) AS t(x)
        """
    )
    (got,) = latest_per_key(df, ["k"], ["o"]).collect()
    assert got.m == {"a": 3}


def test_a_hot_key_shuffles_one_row_per_task(spark):
    df = spark.range(100_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o")
    )
    latest = latest_per_key(df, ["k"], ["o"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert before < plan.index("Exchange hashpartitioning") < after
    assert latest.filter("k = 0").first().o == 99_999


@pytest.mark.parametrize("partitions", [[], ["p"]])
@pytest.mark.parametrize(
    ("values", "broadcast_bytes", "way"),
    [
        ([(i, 1, "a", i, i, i, i, i) for i in range(30)], 10_000, "as they are"),
        ([(i % 25, i, "a", i, i, i, i, i) for i in range(30)], 10_000, "repeated ones"),
        ([(0 if i % 3 else i, 1, "a", i, i, i, i, i) for i in range(30)], 10_000, "repeated ones"),
        ([(i % 15, i, "a", i, i, i, i, i) for i in range(30)], 100, "all"),
    ],
)
def test_a_large_batch_is_searched_for_repeated_keys(
    spark, path, monkeypatch, values, broadcast_bytes, way, partitions
):
    df = batch(spark, *values, schema="k int, o int, p string, c1 int, c2 int, c3 int, c4 int, c5 int")
    want = rows(latest_per_key(df, ["k"], ["o"]), *df.columns)
    taken = []

    def watched(name, function):
        return lambda *given: taken.append(name) or function(*given)

    monkeypatch.setattr(upsert_module, "LARGE_BATCH_ROWS", 30)
    for name, function in (("repeated ones", "latest_of_repeated"), ("all", "latest_per_key")):
        monkeypatch.setattr(upsert_module, function, watched(name, getattr(upsert_module, function)))
    upsert(df, path, ["k"], ["o"], partitions, broadcast_bytes=broadcast_bytes, rows=30)
    assert (taken or ["as they are"]) == [way]
    assert rows(spark.read.parquet(path), *df.columns) == want
    assert beside(path) == {"t"}


def test_null_keys_in_a_large_batch(spark, path, monkeypatch):
    monkeypatch.setattr(upsert_module, "LARGE_BATCH_ROWS", 0)
    wide = batch(spark, (1, 1, "a"), (None, 1, "b"), (None, 2, "c")).withColumn("w", F.lit(1))
    with pytest.raises(ValueError, match="NULL in a key column"):
        upsert(wide, path, ["k"], ["o"], rows=3)
    assert not Path(path).parent.exists() or beside(path) == set()


# Merging


def test_first_load(spark, path):
    schema, written = upsert(batch(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c")), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 2, "b"), (2, 1, "c")]
    assert schema.names == ["k", "o", "v"]
    assert written == []


def test_insert_replace_keep(spark, path):
    upsert(batch(spark, (1, 1, "a"), (2, 1, "b")), path, ["k"], ["o"])
    upsert(batch(spark, (2, 2, "B"), (3, 2, "C")), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 1, "a"), (2, 2, "B"), (3, 2, "C")]


def test_newest_wins_and_a_tie_goes_to_the_batch(spark, path):
    upsert(batch(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, None, "d"), (5, 1, "e")), path, ["k"], ["o"])
    upsert(batch(spark, (1, 2, "A"), (2, 2, "B"), (3, 2, "C"), (4, None, "D"), (5, None, "E")), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 2, "A"), (2, 2, "B"), (3, 3, "c"), (4, None, "D"), (5, 1, "e")]


def test_incoming_wins(spark, path):
    upsert(batch(spark, (1, 3, "a"), (2, 3, "b")), path, ["k"], ["o"])
    upsert(batch(spark, (1, 1, "A")), path, ["k"], ["o"], stale="incoming_wins")
    assert stored(spark, path) == [(1, 1, "A"), (2, 3, "b")]
    with pytest.raises(ValueError, match="stale must be"):
        upsert(batch(spark, (1, 1, "A")), path, ["k"], ["o"], stale="oldest_wins")


def test_same_batch_twice_is_once(spark, path):
    upsert(batch(spark, (1, 1, "a"), (2, 1, "b")), path, ["k"], ["o"])
    for _ in range(2):
        upsert(batch(spark, (2, 2, "B"), (3, 2, "C")), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 1, "a"), (2, 2, "B"), (3, 2, "C")]


def test_composite_key_and_order(spark, path):
    schema = "a int, b string, o1 int, o2 int"
    upsert(batch(spark, (1, "x", 1, 5), (1, "y", 1, 1), schema=schema), path, ["a", "b"], ["o1", "o2"])
    upsert(batch(spark, (1, "x", 1, 4), (1, "y", 1, 2), (2, "x", 0, 0), schema=schema), path, ["A", "b"], ["o1", "O2"])
    assert stored(spark, path) == [(1, "x", 1, 5), (1, "y", 1, 2), (2, "x", 0, 0)]


@pytest.mark.parametrize(
    ("dtype", "older", "newer"),
    [
        ("date", "2024-01-01", "2024-01-02"),
        ("timestamp", "2024-01-01 10:00:00.000001", "2024-01-01 10:00:00.000002"),
        ("timestamp_ntz", "2024-01-01 10:00:00.000001", "2024-01-01 10:00:00.000002"),
        ("decimal(20,4)", "1.0001", "1.0002"),
        ("string", "a", "b"),
        ("double", "0.1", "0.2"),
        ("boolean", "false", "true"),
    ],
)
def test_order_of_any_type(spark, path, dtype, older, newer):
    def typed(*values):
        return batch(spark, *values, schema="k int, o string, v string").withColumn("o", F.col("o").cast(dtype))

    upsert(typed((1, newer, "a"), (2, older, "b"), (3, older, "c")), path, ["k"], ["o"])
    upsert(typed((1, older, "A"), (2, newer, "B"), (3, older, "C")), path, ["k"], ["o"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]


def test_null_keys_are_refused_and_nothing_changes(spark, path):
    upsert(batch(spark, (1, 1, "a")), path, ["k"], ["o"])
    with pytest.raises(ValueError, match="NULL in a key column"):
        upsert(batch(spark, (1, 2, "b"), (None, 2, "c")), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 1, "a")]
    assert not storage.exists(spark, staging.batch_stage(path))


def test_keys_and_order_are_needed(spark, path):
    for keys, order, message in (([], ["o"], "needs key"), (["k"], [], "needs key"), (["z"], ["o"], "no column 'z'")):
        with pytest.raises(ValueError, match=message):
            upsert(batch(spark, (1, 1, "a")), path, keys, order)


def test_empty_batch(spark, path):
    upsert(batch(spark), path, ["k"], ["o"])
    assert not storage.exists(spark, path)
    upsert(batch(spark, (1, 1, "a")), path, ["k"], ["o"])
    upsert(batch(spark), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 1, "a")]


def test_columns_come_and_go(spark, path):
    upsert(batch(spark, (1, 1, "a"), (2, 1, "b")), path, ["k"], ["o"])
    wider = batch(spark, (2, 2, 9), (3, 2, 8), schema="k int, o int, w int")
    upsert(wider, path, ["k"], ["o"])
    assert rows(spark.read.parquet(path), "k", "o", "v", "w") == [
        (1, 1, "a", None),
        (2, 2, None, 9),
        (3, 2, None, 8),
    ]


def test_a_new_order_column_beats_rows_without_it(spark, path):
    upsert(batch(spark, (1, 1, "a"), (2, 5, "b")), path, ["k"], ["o"])
    upsert(batch(spark, (2, 0, "B"), schema="k int, p int, v string"), path, ["k"], ["p"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "B")]


def test_numbers_widen_other_types_clash(spark, path):
    upsert(batch(spark, (1, 5, "a"), (2, 1, "b")), path, ["k"], ["o"])
    upsert(batch(spark, (1, 4, "A"), (2, 2**40, "B"), schema="k long, o long, v string"), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 5, "a"), (2, 2**40, "B")]
    with pytest.raises(ValueError, match="v: string and int"):
        upsert(batch(spark, (1, 9, 1), schema="k long, o long, v int"), path, ["k"], ["o"])


# Partitions


def in_parts(spark, *values):
    return batch(spark, *values, schema="k int, o int, p string")


def test_keys_are_unique_within_a_partition(spark, path):
    upsert(in_parts(spark, (1, 1, "a"), (1, 1, "b"), (2, 1, "b")), path, ["k"], ["o"], ["p"])
    upsert(in_parts(spark, (1, 2, "b"), (3, 2, "c")), path, ["k"], ["o"], ["p"])
    assert stored(spark, path) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "b"), (3, 2, "c")]


def test_only_touched_partitions_are_rewritten(spark, path, tmp_path):
    def files():
        return {f.parent.name: f.name for f in (tmp_path / "trusted" / "t").glob("p=*/*.parquet")}

    upsert(in_parts(spark, (1, 1, "a"), (1, 1, "b"), (1, 1, "c")), path, ["k"], ["o"], ["p"])
    before = files()
    _, written = upsert(in_parts(spark, (1, 2, "b"), (1, 1, "d")), path, ["k"], ["o"], ["p"])
    after = files()
    assert sorted(written) == ["p=b", "p=d"]
    assert {p for p in before if before[p] == after[p]} == {"p=a", "p=c"}


def test_only_new_partitions_are_not_merged(spark, path):
    upsert(in_parts(spark, (1, 1, "a")), path, ["k"], ["o"], ["p"])
    _, written = upsert(in_parts(spark, (1, 2, "b"), (1, 1, "b")), path, ["k"], ["o"], ["p"])
    assert written == ["p=b"]
    assert stored(spark, path) == [(1, 1, "a"), (1, 2, "b")]


def test_partition_values_that_look_like_other_types(spark, path, tmp_path):
    values = ["001", "1", "2024-01-01", "1e3", "a/b=c %", "it's"]
    for order in (1, 2):
        upsert(in_parts(spark, *[(1, order, v) for v in values]), path, ["k"], ["o"], ["p"])
    assert (tmp_path / "trusted" / "t" / "p=001").exists()
    got = spark.read.schema("k int, o int, p string").parquet(path)
    assert rows(got) == sorted([(1, 2, v) for v in values], key=repr)


@pytest.mark.parametrize(
    ("dtype", "one", "other"),
    [
        ("int", "7", "-1"),
        ("bigint", "7", str(2**40)),
        ("date", "2024-01-01", "1999-12-31"),
        ("timestamp", "2024-01-01 10:00:00.5", "2024-01-01 00:00:00"),
        ("timestamp_ntz", "2024-01-01 10:00:00.5", "2024-01-01 00:00:00"),
        ("decimal(10,2)", "1.50", "2.00"),
        ("boolean", "true", "false"),
        ("double", "1.5", "2.0"),
    ],
)
def test_partitions_of_any_type(spark, path, dtype, one, other):
    def typed(*values):
        return in_parts(spark, *values).withColumn("p", F.col("p").cast(dtype))

    upsert(typed((1, 1, one), (2, 1, other), (3, 1, None)), path, ["k"], ["o"], ["p"])
    upsert(typed((1, 2, one), (2, 2, one), (3, 2, None)), path, ["k"], ["o"], ["p"])
    got = spark.read.schema(f"k int, o int, p {dtype}").parquet(path)
    assert rows(got) == rows(typed((1, 2, one), (2, 1, other), (2, 2, one), (3, 2, None)))


def test_a_cached_frame_sees_the_publish(spark, path):
    upsert(in_parts(spark, (1, 1, "a")), path, ["k"], ["o"], ["p"])
    cached = spark.read.parquet(path).cache()
    assert cached.count() == 1
    upsert(in_parts(spark, (2, 1, "a")), path, ["k"], ["o"], ["p"])
    assert spark.read.parquet(path).count() == 2


def test_null_and_empty_partition_values_are_one(spark, path):
    upsert(in_parts(spark, (1, 1, None), (2, 1, "a")), path, ["k"], ["o"], ["p"])
    upsert(in_parts(spark, (1, 2, None), (1, 3, ""), (2, 2, "a")), path, ["k"], ["o"], ["p"])
    assert stored(spark, path) == [(1, 3, None), (2, 2, "a")]


def test_two_levels_and_a_key_that_is_a_partition(spark, path):
    schema = "k int, o int, y int, d date"
    day = F.lit("2024-01-01").cast("date")
    first = batch(spark, (1, 1, 2024, None), (2, 1, 2023, None), schema=schema).withColumn("d", day)
    upsert(first, path, ["k", "y"], ["o"], ["y", "d"])
    _, written = upsert(first.filter("y = 2024").withColumn("o", F.lit(2)), path, ["k", "y"], ["o"], ["y", "d"])
    assert written == ["y=2024/d=2024-01-01"]
    assert rows(spark.read.parquet(path), "k", "o", "y") == [(1, 2, 2024), (2, 1, 2023)]


def test_partitions_written_at_different_times_keep_their_columns(spark, path):
    """One partition has a column the other never had; a batch for both keeps it."""
    upsert(in_parts(spark, (1, 1, "a"), (2, 1, "a")), path, ["k"], ["o"], ["p"])
    upsert(in_parts(spark, (1, 1, "b"), (2, 1, "b")).withColumn("w", F.lit(7)), path, ["k"], ["o"], ["p"])
    upsert(in_parts(spark, (1, 2, "a"), (1, 2, "b")), path, ["k"], ["o"], ["p"])
    got = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(got, "k", "o", "w", "p") == [(1, 2, None, "a"), (1, 2, None, "b"), (2, 1, 7, "b"), (2, 1, None, "a")]


def test_layout_cannot_change_by_the_way(spark, path):
    upsert(in_parts(spark, (1, 1, "a")), path, ["k"], ["o"], ["p"])
    with pytest.raises(ValueError, match="not stored by partitions"):
        upsert(in_parts(spark, (1, 1, "a")), path, ["k"], ["o"])
    other = path + "_plain"
    upsert(in_parts(spark, (1, 1, "a")), other, ["k"], ["o"])
    with pytest.raises(ValueError, match="not stored by partitions"):
        upsert(in_parts(spark, (1, 1, "a")), other, ["k"], ["o"], ["p"])


def test_partitioned_numbers_do_not_widen(spark, path):
    upsert(in_parts(spark, (1, 1, "a")), path, ["k"], ["o"], ["p"])
    with pytest.raises(ValueError, match="o: int and bigint"):
        upsert(batch(spark, (1, 1, "a"), schema="k int, o long, p string"), path, ["k"], ["o"], ["p"])


def test_files_do_not_pile_up(spark, path, tmp_path):
    for order in range(8):
        upsert(in_parts(spark, *[(order * 10 + i, order, "a") for i in range(10)]), path, ["k"], ["o"], ["p"])
    assert len(list((tmp_path / "trusted" / "t" / "p=a").glob("*.parquet"))) <= 3
    assert len(stored(spark, path)) == 80


def test_a_shuffled_merge_does_not_scatter_partitions(spark, path, tmp_path):
    df = spark.range(3000).selectExpr("id AS k", "1 AS o", "concat('p', id % 3) AS p")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for order in (1, 2):
            upsert(df.withColumn("o", F.lit(order)), path, ["k"], ["o"], ["p"], broadcast_bytes=0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(list((tmp_path / "trusted" / "t").glob("p=*/*.parquet"))) == 3


# Ways to join and to publish


@pytest.mark.parametrize("publish", ["rename", "rewrite"])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_every_way_gives_the_same(spark, path, publish, broadcast_bytes, partitions):
    how = {"broadcast_bytes": broadcast_bytes, "publish": publish}
    upsert(in_parts(spark, *[(i, i % 5, "007") for i in range(50)]), path, ["k"], ["o"], partitions, **how)
    upsert(in_parts(spark, *[(i, 2, "007") for i in range(25, 75)]), path, ["k"], ["o"], partitions, **how)
    want = [(i, i % 5 if i < 25 or (i < 50 and i % 5 > 2) else 2) for i in range(75)]
    assert rows(spark.read.parquet(path), "k", "o") == sorted(want, key=repr)
    assert beside(path) == {"t"}


def beside(path):
    return {f.name for f in Path(path).parent.iterdir()}


@pytest.fixture
def parquet(spark, tmp_path):
    def write(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return write


def test_stored_rows_are_not_shuffled_for_a_small_batch(spark, parquet):
    target = parquet("target", spark.range(1000).selectExpr("id AS k", "1 AS o", "'x' AS payload"))
    changes = parquet("changes", spark.range(10).selectExpr("id AS k", "2 AS o", "'y' AS payload"))
    merged = merge_newest(target, changes, Rule(["k"], ["o"]), oldest="2", broadcast_known=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    kept = plan[: plan.index("LeftAnti") + plan[plan.index("LeftAnti") + 1 :].index("LeftAnti")]
    assert "Exchange hashpartitioning" not in kept
    assert "PushedFilters: [IsNotNull(o), GreaterThan(o,2), IsNotNull(k)], ReadSchema: struct<k:bigint,o:int>" in plan


@pytest.mark.parametrize("partitions", [[], ["p"]])
@pytest.mark.parametrize("stale", ["newest_wins", "incoming_wins"])
@pytest.mark.parametrize(
    ("first", "last", "broadcast_bytes", "way"),
    [
        (190, 210, 10_000, "keys broadcast"),
        (190, 900, 10_000, "known broadcast"),
        (10, 190, 10_000, "kept broadcast"),
        (0, 200, 10_000, "kept broadcast"),
        (100, 300, 5_000, "shuffle"),
    ],
)
def test_what_is_small_is_broadcast(
    spark, path, monkeypatch, first, last, broadcast_bytes, way, partitions, stale
):
    """A few keys, many new keys, and nearly all keys again each spare the stored rows a shuffle."""
    taken = []
    merge = upsert_module.merge_newest

    def watched(target, batch, rule, oldest, known=None, broadcast_known=False, kept=None):
        if broadcast_known:
            taken.append("keys broadcast" if known is None else "known broadcast")
        else:
            taken.append("shuffle" if kept is None else "kept broadcast")
        return merge(target, batch, rule, oldest, known, broadcast_known, kept)

    monkeypatch.setattr(upsert_module, "merge_newest", watched)
    upsert(in_parts(spark, *[(i, 3 if i % 50 == 0 else 1, "a") for i in range(200)]), path, ["k"], ["o"], partitions)
    changes = in_parts(spark, *[(i, 2, "a") for i in range(first, last)])
    upsert(changes, path, ["k"], ["o"], partitions, stale=stale, broadcast_bytes=broadcast_bytes)
    assert taken == [way]
    want = {i: 3 if i % 50 == 0 else 1 for i in range(200)}
    want.update({i: 2 for i in range(first, last) if stale == "incoming_wins" or want.get(i, 0) < 3})
    assert rows(spark.read.parquet(path), "k", "o") == sorted(want.items(), key=repr)
    assert beside(path) == {"t"}


def test_stored_rows_with_null_or_repeated_keys_stay_or_go_as_they_should(spark, path):
    """A dataset that was not written by upserts may have both."""
    save_trusted(
        in_parts(spark, (None, 1, "a"), (None, None, "a"), (1, 1, "a"), (1, 5, "a"), (2, 1, "a"), (2, 1, "a")),
        path,
        {"ingest_type": "Replace"},
    )
    changes = in_parts(spark, *[(i, 2, "a") for i in [1, *range(10, 60)]])
    upsert(changes, path, ["k"], ["o"], broadcast_bytes=1000)
    want = [(None, 1), (None, None), (1, 5), (2, 1), (2, 1)] + [(i, 2) for i in range(10, 60)]
    assert rows(spark.read.parquet(path), "k", "o") == sorted(want, key=repr)


def test_a_large_batch_joins_by_shuffle(spark, parquet):
    """Nothing is broadcast on the library's word; the session's own limit decides."""
    target = parquet("target", spark.range(1000).selectExpr("id AS k", "1 AS o"))
    changes = parquet("changes", spark.range(500).selectExpr("id AS k", "2 AS o"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_newest(target, changes, Rule(["k"], ["o"]))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
        assert plan.count("SortMergeJoin") == 3
        assert merged.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# Runs that die


class Died(Exception):
    pass


def die(*_, **__):
    raise Died


FIRST = [(1, 1, "a"), (2, 1, "b")]
SECOND = [(2, 2, "a"), (3, 2, "b")]
THIRD = [(4, 3, "a")]


@pytest.mark.parametrize("publish", ["rename", "rewrite"])
@pytest.mark.parametrize("partitions", [[], ["p"]])
@pytest.mark.parametrize("where", ["_rename", "_rewrite", "write_stage", "write_text"])
def test_a_run_that_dies_is_made_good_by_the_next(spark, path, monkeypatch, publish, partitions, where):
    """Whether the dead run's batch counts depends on how far it came, its rows are never halved."""

    def run(values):
        upsert(in_parts(spark, *values), path, ["k"], ["o"], partitions, publish=publish)

    run(FIRST)
    before = rows(spark.read.parquet(path), "k", "o")
    with monkeypatch.context() as broken:
        if where == "write_text":
            broken.setattr(storage, "write_text", die)
        elif where == "write_stage":
            whole = staging.write_stage

            def half(df, stage, *rest):
                whole(df.limit(1), stage, *rest)
                raise Died

            broken.setattr(staging, "write_stage", half)
        else:
            broken.setattr(staging, where, die)
        try:
            run(SECOND)
            died = False
        except Died:
            died = True
    if died:
        assert rows(spark.read.parquet(path), "k", "o") == before
    run(THIRD)
    counted = FIRST + THIRD if where in ("write_stage", "write_text") else FIRST + SECOND + THIRD
    newest = {}
    for k, o, p in counted:
        newest[(k, p) if partitions else k] = (k, o)
    assert rows(spark.read.parquet(path), "k", "o") == sorted(newest.values(), key=repr)
    assert beside(path) == {"t"}


@pytest.mark.parametrize("partitions", [[], ["p"]])
def test_dying_halfway_through_the_moves(spark, path, monkeypatch, partitions):
    def run(values):
        upsert(in_parts(spark, *values), path, ["k"], ["o"], partitions, publish="rename")

    run(FIRST)
    moves = []
    move = storage.replace_directory

    def once(session, source, target, aside):
        if moves:
            raise Died
        moves.append(target)
        move(session, source, target, aside)
        if not partitions:
            raise Died

    with monkeypatch.context() as broken:
        broken.setattr(storage, "replace_directory", once)
        with pytest.raises(Died):
            run([(1, 2, "a"), (2, 2, "b")])
    run(THIRD)
    assert rows(spark.read.parquet(path), "k", "o") == [(1, 2), (2, 2), (4, 3)]


def test_dying_between_delete_and_move(spark, path, monkeypatch):
    upsert(in_parts(spark, *FIRST), path, ["k"], ["o"], publish="rename")

    def half(session, source, target, aside):
        storage.delete(session, target)
        raise Died

    with monkeypatch.context() as broken:
        broken.setattr(storage, "replace_directory", half)
        with pytest.raises(Died):
            upsert(in_parts(spark, *SECOND), path, ["k"], ["o"], publish="rename")
    assert not storage.exists(spark, path)
    upsert(in_parts(spark, *THIRD), path, ["k"], ["o"])
    assert rows(spark.read.parquet(path), "k", "o") == [(1, 1), (2, 2), (3, 2), (4, 3)]


def left_unpublished(spark, path, monkeypatch, values, partitions):
    with monkeypatch.context() as broken:
        for way in ("_rename", "_move_files"):
            broken.setattr(staging, way, die)
        with pytest.raises(Died):
            upsert(in_parts(spark, *values), path, ["k"], ["o"], partitions, publish="rename")


def test_recovery_keeps_the_layout_of_the_run_that_died(spark, path, monkeypatch):
    """The next run has another idea of the partitions; untouched partitions must not go."""
    upsert(in_parts(spark, *FIRST), path, ["k"], ["o"], ["p"])
    left_unpublished(spark, path, monkeypatch, [(2, 2, "b")], ["p"])
    with pytest.raises(ValueError, match="not stored by partitions"):
        upsert(in_parts(spark, *THIRD), path, ["k"], ["o"])
    assert stored(spark, path) == [(1, 1, "a"), (2, 2, "b")]


def test_all_moved_but_still_marked(spark, path):
    upsert(in_parts(spark, *FIRST), path, ["k"], ["o"], ["p"])
    stage = staging.merge_stage(path)
    Path(stage).mkdir()
    storage.write_text(spark, stage + "__ready", '["p"]')
    upsert(in_parts(spark, (9, 1, "z")), path, ["k"], ["o"], ["p"])
    assert stored(spark, path) == [(1, 1, "a"), (2, 1, "b"), (9, 1, "z")]
    assert beside(path) == {"t"}


def test_a_marker_that_broke_off_counts_as_none(spark, path):
    upsert(in_parts(spark, *FIRST), path, ["k"], ["o"])
    stage = staging.merge_stage(path)
    in_parts(spark, (5, 5, "a")).write.parquet(stage)
    storage.write_text(spark, stage + "__ready", "")
    upsert(in_parts(spark, *THIRD), path, ["k"], ["o"])
    assert rows(spark.read.parquet(path), "k", "o") == [(1, 1), (2, 1), (4, 3)]


def test_a_replace_is_not_undone_by_a_run_that_died_before_it(spark, path, monkeypatch):
    upsert(in_parts(spark, *FIRST), path, ["k"], ["o"])
    left_unpublished(spark, path, monkeypatch, SECOND, [])
    save_trusted(in_parts(spark, (7, 7, "x")), path, {"ingest_type": "Replace"})
    upsert(in_parts(spark, *THIRD), path, ["k"], ["o"])
    assert rows(spark.read.parquet(path), "k", "o") == [(4, 3), (7, 7)]


def test_a_partition_replace_comes_after_a_run_that_died_before_it(spark, path, monkeypatch):
    upsert(in_parts(spark, *FIRST), path, ["k"], ["o"], ["p"])
    left_unpublished(spark, path, monkeypatch, SECOND, ["p"])
    save_trusted(in_parts(spark, (7, 7, "b")), path, {"ingest_type": "ReplacePartition", "partitions": ["p"]})
    assert rows(spark.read.parquet(path), "k", "o") == [(1, 1), (2, 2), (7, 7)]


# As a job stores it


def test_registered(spark, path, database):
    trusted = {"ingest_type": "Upsert", "database": database, "key_column": "k", "order_column": ["o"]}
    save_trusted(batch(spark, (1, 1, "a")), path, trusted, "t")
    save_trusted(batch(spark, (1, 2, "b"), (2, 1, "c")), path, trusted, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, 2, "b"), (2, 1, "c")]
    wider = batch(spark, (3, 1, "d")).withColumn("w", F.lit(1))
    save_trusted(wider, path, trusted, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, 2, "b", None), (2, 1, "c", None), (3, 1, "d", 1)]


def test_registered_with_partitions(spark, path, database):
    trusted = {
        "ingest_type": "Upsert",
        "database": database,
        "key_column": ["k"],
        "order_column": "o",
        "partitions": ["p"],
    }
    save_trusted(in_parts(spark, (1, 1, "x=1"), (1, 1, None)), path, trusted, "t")
    save_trusted(in_parts(spark, (1, 2, "x=1"), (1, 2, "it's"), (2, 1, None)), path, trusted, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, 1, None), (1, 2, "it's"), (1, 2, "x=1"), (2, 1, None)]


def test_table_keeps_columns_of_partitions_a_batch_does_not_touch(spark, path, database):
    trusted = {
        "ingest_type": "Upsert",
        "database": database,
        "key_column": ["k"],
        "order_column": "o",
        "partitions": ["p"],
    }
    save_trusted(in_parts(spark, (1, 1, "a")).withColumn("w", F.lit(7)), path, trusted, "t")
    save_trusted(in_parts(spark, (1, 1, "b")), path, trusted, "t")
    save_trusted(in_parts(spark, (2, 1, "b")).withColumn("x", F.lit(8)), path, trusted, "t")
    table = spark.table(f"{database}.t")
    assert rows(table, "k", "p", "w", "x") == [(1, "a", 7, None), (1, "b", None, None), (2, "b", None, 8)]


def test_odd_column_names(spark, path, database):
    trusted = {
        "ingest_type": "Upsert",
        "database": database,
        "key_column": ["the key"],
        "order_column": "o.o",
        "partitions": ["part 1"],
    }
    for order in (1, 2):
        odd = spark.createDataFrame([(1, order, "a b"), (2, order, "c")], "`the key` int, `o.o` int, `part 1` string")
        save_trusted(odd, path, trusted, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, 2, "a b"), (2, 2, "c")]


def test_upsert_onto_a_replaced_dataset(spark, path):
    save_trusted(in_parts(spark, (1, 1, "a"), (2, 1, "b")), path, {"ingest_type": "Replace", "partitions": ["p"]})
    upsert(in_parts(spark, (1, 2, "a")), path, ["k"], ["o"], ["p"])
    assert stored(spark, path) == [(1, 2, "a"), (2, 1, "b")]


# Against a plain fold

ROWS = st.lists(
    st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("xyz")),
    min_size=1,
    max_size=12,
)


def fold(batches, partitioned, incoming_wins):
    table = {}
    for values in batches:
        winners = {}
        for k, o, p in values:
            key = (k, p) if partitioned else k
            rank = (-1 if o is None else o, p)
            if key not in winners or rank > winners[key][0]:
                winners[key] = (rank, (k, o, p))
        for key, (rank, row) in winners.items():
            if key not in table or incoming_wins or rank[0] >= table[key][0][0]:
                table[key] = (rank, row)
    return sorted((row for _, row in table.values()), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    batches=st.lists(ROWS, min_size=2, max_size=3),
    partitioned=st.booleans(),
    incoming_wins=st.booleans(),
    broadcast_bytes=st.sampled_from([0, 1 << 20]),
)
def test_upserts_equal_a_fold(spark, tmp_path_factory, batches, partitioned, incoming_wins, broadcast_bytes):
    path = str(tmp_path_factory.mktemp("fold") / "t")
    for values in batches:
        upsert(
            in_parts(spark, *values),
            path,
            ["k"],
            ["o"],
            ["p"] if partitioned else [],
            stale="incoming_wins" if incoming_wins else "newest_wins",
            broadcast_bytes=broadcast_bytes,
        )
    assert rows(spark.read.parquet(path), "k", "o", "p") == fold(batches, partitioned, incoming_wins)
