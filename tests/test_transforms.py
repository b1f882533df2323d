import datetime as dt

import pytest

from stratalake import apply_transforms, register_transform
from tests.conftest import rows


def trim(*names):
    return {"name": "Trim", "parameters": [{"column_name": n} for n in names]}


def cast_date(name, fmt):
    return {"name": "CastDate", "parameters": [{"column_name": name, "source_format": fmt}]}


def rename_cast(*entries):
    keys = ("column_name", "new_column_name", "data_type")
    return {"name": "RenameCast", "parameters": [dict(zip(keys, e, strict=True)) for e in entries]}


@pytest.fixture
def typed(spark):
    schema = "id int, s string, day string, n string, w string"
    data = [
        (1, "  a b ", "20240131", "2.5", " \tx\n "),
        (2, "", "bad", "-2.9", None),
        (3, None, "20240230", "x", "   "),
    ]
    return spark.createDataFrame(data, schema)


def test_trim_takes_spaces_only(typed):
    got = apply_transforms(typed, [trim("s", "w")])
    assert rows(got, "id", "s", "w") == [(1, "a b", "\tx\n"), (2, "", None), (3, None, "")]
    assert dict(got.dtypes)["id"] == "int"


def test_trim_all_makes_text_of_all_but_the_batch_id(spark):
    df = spark.sql(
        "SELECT 1 AS i, 1.5D AS d, DATE '2024-01-31' AS day, true AS b, X'6162' AS x, ' t ' AS t, 20240101 AS DT_IMPORT"
    )
    got = apply_transforms(df, [trim("*")])
    assert got.dtypes == [(c, "string") for c in "i d day b x t".split()] + [("DT_IMPORT", "int")]
    assert rows(got) == [("1", "1.5", "2024-01-31", "true", "ab", "t", 20240101)]


def test_trim_names_ignore_case_and_may_have_dots(spark):
    df = spark.createDataFrame([(" x ", " y ")], "`A.B` string, C string")
    assert rows(apply_transforms(df, [trim("a.b", "C")])) == [("x", "y")]


def test_trim_refuses_nested_columns(spark):
    df = spark.sql("SELECT array('a') AS xs, 'b' AS s")
    with pytest.raises(ValueError, match=r"nested: \['xs'\]"):
        apply_transforms(df, [trim("*")])
    assert rows(apply_transforms(df, [trim("s")])) == [(["a"], "b")]


def test_cast_date_turns_bad_text_to_null(typed):
    got = apply_transforms(typed, [cast_date("day", "yyyyMMdd")])
    assert rows(got, "id", "day") == [(1, dt.date(2024, 1, 31)), (2, None), (3, None)]


def test_cast_date_of_dates_times_and_numbers(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-31 23:59:00' AS t, DATE '2024-01-31' AS d, 20240131 AS n")
    got = apply_transforms(df, [cast_date(c, "yyyyMMdd") for c in "tdn"])
    assert rows(got) == [(dt.date(2024, 1, 31),) * 3]


def test_cast_date_of_fractions_is_an_error(spark):
    """A chain that makes a number of a date text and then parses it cannot mean anything."""
    df = spark.createDataFrame([("20240131",)], "d string")
    steps = [rename_cast(("d", "d", "Float")), cast_date("d", "yyyyMMdd")]
    with pytest.raises(ValueError, match="CastDate on 'd': cannot parse a date out of a float column"):
        apply_transforms(df, steps)
    assert rows(apply_transforms(df, steps, mode="last")) == [(dt.date(2024, 1, 31),)]


def test_cast_to_whole_numbers_drops_the_fraction(spark):
    texts = ["2.5", "-2.9", "x", "99999999999", "7", " 8 ", "-0.5", "1e3", "1.9999999999", "", None]
    texts += ["+3", "4.", ".9", "-.9", ".", "-", "1.2.3", "5 6", "0x10", "1,5", "12d", "\t9.1\n", "000000000012"]
    df = spark.createDataFrame([(t, t) for t in texts], "t string, n string")
    got = apply_transforms(df, [rename_cast(("n", "n", "Integer"))])
    want = [2, -2, None, None, 7, 8, 0, None, 1, None, None]
    want += [3, 4, 0, 0, None, None, None, None, None, None, None, 9, 12]
    assert dict((r.t, r.n) for r in got.collect()) == dict(zip(texts, want, strict=True))


def test_cast_to_long_keeps_every_digit(spark):
    df = spark.createDataFrame([("9223372036854775807.9",), ("9223372036854775808",)], "n string")
    got = apply_transforms(df, [rename_cast(("n", "n", "Long"))])
    assert [r.n for r in got.collect()] == [9223372036854775807, None]


@pytest.mark.parametrize(
    ("name", "value", "want"),
    [
        ("Float", "1.5", 1.5),
        ("float", "nope", None),
        ("Date", "2024-01-31", dt.date(2024, 1, 31)),
        ("Date", "20240131x", None),
        ("Double", "0.25", 0.25),
        ("Boolean", "true", True),
        ("String", "s", "s"),
        ("Timestamp", "bad", None),
    ],
)
def test_cast_names(spark, name, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert rows(apply_transforms(df, [rename_cast(("v", "w", name))])) == [(want,)]


def test_overflow_is_null_not_an_error(spark):
    df = spark.sql("SELECT 3000000000L AS n, 1e300D AS d")
    got = apply_transforms(df, [rename_cast(("n", "n", "Integer"), ("d", "d", "Integer"))])
    assert rows(got) == [(None, None)]


def test_rename_cast_goes_entry_by_entry(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    got = apply_transforms(df, [rename_cast(("a", "c", "Integer"), ("b", "a", "Integer"), ("c", "d", "String"))])
    assert got.dtypes == [("d", "string"), ("a", "int")]
    assert rows(got) == [("1", 2)]


def test_rename_onto_another_column(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(ValueError, match="appear more than once"):
        apply_transforms(df, [rename_cast(("a", "B", "Integer"))])


def test_missing_column(typed):
    for step in (trim("zz"), cast_date("zz", "yyyy"), rename_cast(("zz", "y", "Date"))):
        with pytest.raises(ValueError, match="no column 'zz'"):
            apply_transforms(typed, [step])


def test_chain_and_last(typed):
    steps = [trim("s"), cast_date("day", "yyyyMMdd")]
    chained = apply_transforms(typed.filter("id = 1"), steps)
    assert rows(chained, "s", "day") == [("a b", dt.date(2024, 1, 31))]
    last = apply_transforms(typed.filter("id = 1"), steps, mode="last")
    assert rows(last, "s", "day") == [("  a b ", dt.date(2024, 1, 31))]
    with pytest.raises(ValueError, match="transform mode"):
        apply_transforms(typed, steps, mode="first")


def test_no_transforms(typed):
    assert apply_transforms(typed, []).columns == typed.columns
    assert apply_transforms(typed, [], mode="last").columns == typed.columns


def test_own_and_unknown_transforms(typed):
    register_transform("Only", lambda df, parameters: df.select(*[p["column_name"] for p in parameters]))
    assert apply_transforms(typed, [{"name": "Only", "parameters": [{"column_name": "id"}]}]).columns == ["id"]
    with pytest.raises(ValueError, match="no such transform: 'CastData'"):
        apply_transforms(typed, [{"name": "CastData", "parameters": []}])


def test_a_chain_is_one_projection(typed):
    steps = [trim("*"), cast_date("day", "yyyyMMdd"), rename_cast(("n", "m", "Float"), ("id", "key", "String"))]
    plan = apply_transforms(typed, steps)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1
