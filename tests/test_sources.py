from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import duckdb
import pytest

from stratalake import read_source, register_reader
from stratalake.layers import layer_path
from stratalake.sources.jdbc import bounds_options, jdbc_options, literal, quantiles_options, range_predicates, read_jdbc, split_options
from tests.conftest import rows


@pytest.mark.parametrize(
    ("root", "path", "joined"),
    [
        ("/lake/raw", "a/b/", "/lake/raw/a/b/"),
        ("/lake/raw/", "a", "/lake/raw/a"),
        ({"path": "s3a://bucket"}, "a", "s3a://bucket/a"),
    ],
)
def test_layer_path(root, path, joined):
    assert layer_path({"raw": root}, "raw", path) == joined


def test_unknown_layer():
    with pytest.raises(ValueError, match="no such layer"):
        layer_path({"raw": "/r"}, "landing", "a")


@pytest.mark.parametrize("kind", ["csv", "txt"])
def test_delimited_columns_are_text(spark, layers, tmp_path, kind):
    (tmp_path / "landing" / "t").mkdir(parents=True)
    (tmp_path / "landing" / "t" / "f.txt").write_text("id;day\n1;2024-01-05\n2;\n")
    source = {"type": kind, "path": "t", "options": {"sep": ";", "header": "true"}}
    df = read_source(spark, source, layers)
    assert df.dtypes == [("id", "string"), ("day", "string")]
    assert rows(df) == [("1", "2024-01-05"), ("2", None)]


def test_columns_name_by_position(spark, layers, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "f.csv").write_text("1,x\n2,y\n")
    source = {"type": "csv", "path": "f.csv", "columns": ["ID", "NAME"]}
    assert rows(read_source(spark, source, layers), "NAME", "ID") == [("x", "1"), ("y", "2")]
    with pytest.raises(ValueError, match="names 1 columns, the source has 2"):
        read_source(spark, {**source, "columns": ["ID"]}, layers)


@pytest.mark.parametrize("exists", [False, True])
def test_parquet_source_without_data(spark, layers, tmp_path, exists):
    if exists:
        (tmp_path / "landing" / "none").mkdir(parents=True)
    with pytest.raises(ValueError, match="no Parquet data"):
        read_source(spark, {"type": "parquet", "path": "none"}, layers)


def test_a_broken_file_is_not_taken_for_missing_data(spark, layers, tmp_path):
    (tmp_path / "landing" / "t").mkdir(parents=True)
    (tmp_path / "landing" / "t" / "f.parquet").write_text("this is not Parquet")
    with pytest.raises(Exception, match="(?i)footer|not a Parquet file") as raised:
        read_source(spark, {"type": "parquet", "path": "t"}, layers)
    assert not isinstance(raised.value, ValueError)


def test_unknown_format(spark, layers):
    with pytest.raises(ValueError, match="unable to read format 'xml'"):
        read_source(spark, {"type": "xml", "path": "x"}, layers)


def test_own_reader(spark, layers):
    register_reader("numbers", lambda spark, source, layers: spark.range(source["upto"]))
    assert read_source(spark, {"type": "numbers", "upto": 3}, layers).count() == 3


SECRET = {"host": "db", "port": 1433, "dbname": "sales", "username": "me", "password": "pw"}
SQLSERVER = {"type": "jdbc", "dbtype": "sqlserver", "secret_name": "s", "table": "SD2010"}


def test_jdbc_table():
    assert jdbc_options(SQLSERVER, SECRET) == {
        "url": "jdbc:sqlserver://db:1433;databaseName=sales",
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "user": "me",
        "password": "pw",
        "dbtable": "SD2010",
    }


def test_jdbc_query_comes_before_table():
    options = jdbc_options({**SQLSERVER, "query": "SELECT 1"}, SECRET)
    assert options["query"] == "SELECT 1"
    assert "dbtable" not in options


def test_jdbc_options_of_the_job_win():
    own = {"fetchsize": "50000", "driver": "my.Driver", "partitionColumn": "ID", "numPartitions": "64"}
    options = jdbc_options({**SQLSERVER, "options": own}, SECRET)
    assert own.items() <= options.items()


def test_jdbc_driver_of_a_known_database_is_fixed():
    options = jdbc_options({**SQLSERVER, "driver": "ignored.Driver"}, SECRET)
    assert options["driver"] == "com.microsoft.sqlserver.jdbc.SQLServerDriver"


def test_jdbc_ready_url():
    source = {"type": "jdbc", "url": "jdbc:other://x", "driver": "o.Driver", "table": "T"}
    assert jdbc_options(source, {}) == {"url": "jdbc:other://x", "driver": "o.Driver", "dbtable": "T"}


def test_jdbc_unknown_database():
    with pytest.raises(ValueError, match="no url template for dbtype 'oracle'"):
        jdbc_options({**SQLSERVER, "dbtype": "oracle"}, SECRET)


def test_jdbc_incomplete_credentials():
    with pytest.raises(ValueError, match=r"credentials lack \['port'\]"):
        jdbc_options(SQLSERVER, {"host": "db", "dbname": "sales"})


class _Reader:
    """Stands in for ``spark.read``: no database may be started here."""

    def format(self, name):
        self.name = name
        return self

    def options(self, **options):
        self.given = options
        return self

    def load(self):
        return self


def test_jdbc_asks_for_the_named_secret():
    asked = []
    spark = SimpleNamespace(read=_Reader())
    loaded = read_jdbc(spark, SQLSERVER, {}, lambda name: asked.append(name) or SECRET)
    assert asked == ["s"]
    assert loaded.name == "jdbc"
    assert loaded.given == jdbc_options(SQLSERVER, SECRET)


SPLIT = {"column": "ROW_NO", "partitions": 16}


@pytest.mark.parametrize(("more", "relation"), [({}, "SD2010"), ({"query": "SELECT * FROM T"}, "(SELECT * FROM T) q")])
def test_jdbc_split_reads_ranges(more, relation):
    """Options only: no database is there to read."""
    options = jdbc_options({**SQLSERVER, **more}, SECRET)
    asked = bounds_options(options, SPLIT)
    assert asked["query"] == f"SELECT MIN(ROW_NO) AS lo, MAX(ROW_NO) AS hi FROM {relation}"
    assert "dbtable" not in asked and asked["url"] == options["url"]
    ranged = split_options(options, SPLIT, (7, 5000))
    assert ranged["dbtable"] == relation and "query" not in ranged
    assert [ranged[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["ROW_NO", "7", "5000", "16"]


@pytest.mark.parametrize("bounds", [None, (None, None)])
def test_jdbc_split_of_nothing(bounds):
    options = jdbc_options(SQLSERVER, SECRET)
    assert split_options(options, SPLIT, bounds) == options


VALUES = {
    "integer": [1, 1, 1, 1, 1, 1, 1, 5, 9, 900, 10_000, None],
    "varchar": ["", "o'neil", "'", "a", "a", "a", "B", "é", None, "zz"],
    "date": [date(2024, 1, 1 + d) for d in range(20)] + [None, None],
    "timestamp": [datetime(2024, 1, 1, 10, 0, s, 123_456) for s in range(20)] + [None],
    "decimal(9,3)": [Decimal(n) / 8 for n in range(-9, 9)],
    "double": [-1e300, 1e-300, 0.5, 0.25, None],
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("parts", [1, 2, 3, 7, 50])
def test_jdbc_quantiles_leave_no_gap(kind, parts):
    """The conditions are held against a database within this process: every row meets one."""
    own = duckdb.connect()
    own.execute(f"CREATE TABLE t (c {kind})")
    own.executemany("INSERT INTO t VALUES (?)", [(v,) for v in VALUES[kind]])
    query = quantiles_options({"dbtable": "t", "url": "u"}, {"column": "c", "partitions": parts})["query"]
    starts = [row[1] for row in sorted(own.execute(query).fetchall())]
    found = range_predicates("c", starts)
    assert len(found) <= parts
    met = [own.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in found]
    meets = " + ".join(f"coalesce(({p})::int, 0)" for p in found)
    assert not found or own.execute(f"SELECT DISTINCT {meets} FROM t").fetchall() == [(1,)]
    if kind == "date" and parts == 7:
        assert len(met) == 7 and max(met) <= 5


def test_jdbc_quantiles_of_nothing():
    assert range_predicates("c", []) == range_predicates("c", [3]) == range_predicates("c", [3, 3]) == []
    assert literal("o'n") == "'o''n'" and literal(date(2024, 2, 1)) == "'2024-02-01'"


class _QuantileReader(_Reader):
    def load(self):
        return SimpleNamespace(collect=lambda: [(2, 40), (1, 7)])

    def jdbc(self, url, table, predicates, properties):
        self.asked = (url, table, predicates, properties)
        return self


@pytest.mark.parametrize(("more", "relation"), [({}, "SD2010"), ({"query": "SELECT * FROM T"}, "(SELECT * FROM T) q")])
def test_jdbc_split_by_quantiles(more, relation):
    spark = SimpleNamespace(read=_QuantileReader())
    source = {**SQLSERVER, **more, "split": {**SPLIT, "by": "quantiles"}}
    read_jdbc(spark, source, {}, lambda _: SECRET)
    url, table, predicates, properties = spark.read.asked
    assert table == relation and predicates == ["ROW_NO < 40 OR ROW_NO IS NULL", "ROW_NO >= 40"]
    assert url.startswith("jdbc:") and not {"url", "dbtable", "query"} & set(properties) and properties["user"]
    with pytest.raises(ValueError, match="a split is by"):
        read_jdbc(spark, {**source, "split": {**SPLIT, "by": "luck"}}, {}, lambda _: SECRET)


def test_jdbc_split_needs_partitions():
    with pytest.raises(ValueError, match="one partition"):
        quantiles_options(jdbc_options(SQLSERVER, SECRET), {"column": "A", "partitions": 0})
    with pytest.raises(ValueError, match="one partition"):
        split_options(jdbc_options(SQLSERVER, SECRET), {"column": "A", "partitions": 0}, (1, 2))
