import datetime as dt
import operator

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake import incremental_filter
from stratalake.operators.incremental import COMPARISONS
from tests.conftest import rows


def condition(name, compare, days=0, fmt=None):
    return {"filter_date": name, "compare": compare, "days": days, **({"date_format": fmt} if fmt else {})}


def kept(df, *conditions, batch_date="20240110"):
    return sorted(r[0] for r in incremental_filter(df, conditions, batch_date).select("id").collect())


@pytest.fixture(scope="module")
def days(spark):
    return spark.sql(
        """
        SELECT id, d, CAST(d AS TIMESTAMP) + INTERVAL 12 HOURS AS t,
               CAST(CAST(d AS TIMESTAMP_NTZ) + INTERVAL 12 HOURS AS TIMESTAMP_NTZ) AS n,
               date_format(d, 'yyyyMMdd') AS text, CAST(date_format(d, 'yyyyMMdd') AS INT) AS num,
               date_format(d, 'yyyy-MM-dd') AS iso, date_format(d, 'dd/MM/yyyy') AS br
        FROM (SELECT CAST(id AS INT) AS id, date_add(DATE '2024-01-07', CAST(id AS INT)) AS d FROM range(7))
        """
    ).cache()


@pytest.mark.parametrize(
    ("compare", "want"),
    [
        ("<", [0, 1]),
        ("<=", [0, 1, 2]),
        (">", [3, 4, 5, 6]),
        (">=", [2, 3, 4, 5, 6]),
        ("=", [2]),
        ("==", [2]),
        ("!=", [0, 1, 3, 4, 5, 6]),
        ("<>", [0, 1, 3, 4, 5, 6]),
    ],
)
@pytest.mark.parametrize(
    ("name", "fmt"),
    [
        ("d", None),
        ("iso", None),
        ("text", "yyyyMMdd"),
        ("num", "yyyyMMdd"),
        ("iso", "yyyy-MM-dd"),
        ("br", "dd/MM/yyyy"),
        ("t", "yyyyMMdd"),
        ("n", "yyyyMMdd"),
        ("d", "yyyyMMdd"),
    ],
)
def test_by_day(days, name, fmt, compare, want):
    assert kept(days, condition(name, compare, -1, fmt)) == want


def test_instants_without_a_format(days):
    """Noon is after the midnight the cutoff stands for."""
    for name in "tn":
        assert kept(days, condition(name, ">", -1)) == [2, 3, 4, 5, 6]
        assert kept(days, condition(name, "<=", -1)) == [0, 1]
        assert kept(days, condition(name, "=", -1)) == []


def test_conditions_are_joined_by_and(days):
    both = condition("d", ">=", -2), condition("d", "<", 1)
    assert kept(days, *both) == [1, 2, 3]
    assert kept(days) == list(range(7))


def test_each_condition_has_its_own_format(spark):
    df = spark.createDataFrame([(1, "20240105"), (2, "05/01/2024"), (3, "20240120")], "id int, s string")
    assert kept(df, condition("s", "<", 0, "yyyyMMdd")) == [1]
    assert kept(df, condition("s", "<", 0, "dd/MM/yyyy")) == [2]
    assert kept(df, condition("s", "<", 0, "yyyyMMdd"), condition("s", "<", 0, "dd/MM/yyyy")) == []


def test_bad_text_is_never_kept(spark):
    texts = [None, "", "bad", "20240230", " 20240101", "20240101 ", "2024-01-01", "9999", "+120240101"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    assert kept(df, condition("s", "<>", 0, "yyyyMMdd")) == [8]
    assert kept(df, condition("s", ">", 0, "yyyyMMdd")) == [8]
    assert kept(df, condition("s", "<", 0, "yyyyMMdd")) == []
    assert kept(df, condition("s", "<>")) == [6, 7]


def test_days_may_be_text_and_columns_any_case(days):
    assert kept(days, condition("D", ">=", "2")) == [5, 6]


def test_columns_stay_as_they_are(days):
    withhelpers = days.withColumn("dt_corte", F.lit(1))
    got = incremental_filter(withhelpers, [condition("text", ">=", 0, "yyyyMMdd")], "20240110")
    assert got.columns == withhelpers.columns


@pytest.mark.parametrize(
    ("wrong", "message"),
    [
        (condition("d", "BETWEEN"), "compare must be one of"),
        (condition("d", "> 0 OR 1 ="), "compare must be one of"),
        (condition("zz", ">"), "no column 'zz'"),
        (condition("id", ">"), "a int column needs a date_format"),
    ],
)
def test_wrong_conditions(days, wrong, message):
    with pytest.raises(ValueError, match=message):
        incremental_filter(days, [wrong], "20240110")


def test_formatted_fraction_is_an_error(spark):
    with pytest.raises(ValueError, match="cannot parse a date out of a double"):
        incremental_filter(spark.sql("SELECT 1D AS x"), [condition("x", ">", 0, "yyyy")], "20240110")


@pytest.mark.parametrize(
    ("name", "fmt", "pushed"),
    [
        ("n", None, "GreaterThanOrEqual(n,2024-01-09T00:00)"),
        ("d", None, "GreaterThanOrEqual(d,2024-01-09)"),
        ("text", "yyyyMMdd", "GreaterThanOrEqual(text,20240109)"),
    ],
)
def test_filter_reaches_the_scan(spark, days, tmp_path, name, fmt, pushed):
    days.write.parquet(str(tmp_path / "days"))
    got = incremental_filter(
        spark.read.parquet(str(tmp_path / "days")), [condition(name, ">=", -1, fmt)], "20240110"
    )
    assert pushed in got._jdf.queryExecution().executedPlan().toString()


FORMATS = {"yyyyMMdd": "%Y%m%d", "yyyy-MM-dd": "%Y-%m-%d", "yyyyMMddHHmmss": "%Y%m%d%H%M%S"}
MOMENTS = st.datetimes(dt.datetime(2023, 12, 20), dt.datetime(2024, 1, 30))
NOISE = st.sampled_from(["", "x", "-20240105", "+120240105", "2024", "20240105x", "00000000", "99999999"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    moments=st.lists(MOMENTS, min_size=1, max_size=20),
    noise=st.lists(NOISE, max_size=5),
    fmt=st.sampled_from(sorted(FORMATS)),
    compare=st.sampled_from(sorted(COMPARISONS)),
    days=st.integers(-15, 15),
)
def test_text_bounds_change_nothing(spark, moments, noise, fmt, compare, days):
    """The pushed-down text comparison keeps just what comparing parsed days keeps."""
    texts = [m.strftime(FORMATS[fmt]) for m in moments] + noise
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = incremental_filter(df, [condition("s", compare, days, fmt)], "20240110")
    cutoff = F.date_add(F.lit("2024-01-10").cast("date"), days)
    operation = getattr(operator, COMPARISONS[compare].__name__)
    assert rows(got) == rows(df.filter(operation(F.try_to_date("s", fmt), cutoff)))
