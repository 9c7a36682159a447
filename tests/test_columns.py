"""Column selection and scalar expressions on edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.functions import scalars as S


def values(spark, inputs, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_numeric_types(spark):
    df = spark.sql(
        "SELECT 1 a, 1L b, CAST(1 AS FLOAT) c, CAST(1 AS DOUBLE) d, CAST(1 AS DECIMAL(5,2)) e,"
        " CAST(1 AS SMALLINT) f, true g, 'x' h, 'y' name_norm, DATE '2000-01-01' i"
    )
    assert C.numeric_columns(df) == ["a", "b", "c", "d"]
    assert C.numeric_columns(df, exclude=["a"], decimals=True) == ["b", "c", "d", "e"]
    assert C.categorical_columns(df) == ["h"]


def test_constant_columns(spark):
    rows = [(1, None, None, 3.0, float("nan")), (2, None, 5, 3.0, float("nan"))]
    df = spark.createDataFrame(rows, "id int, empty double, gappy int, flat double, `a%` double")
    assert C.constant_columns(df, df.columns) == ["empty", "flat", "a%"]
    assert C.drop_constant_columns(df).columns == ["id", "gappy"]
    assert C.constant_columns(df.limit(0), ["id"]) == ["id"]


def test_duplicate_names_drop_every_copy(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS a, 4 AS c")
    assert C.drop_duplicate_columns(df).columns == ["b", "c"]


def test_prefix_and_drop(spark):
    df = spark.sql("SELECT 1 AS name_norm, 2 AS `x%`")
    assert C.prefix_columns(df, "ss_").columns == ["name_norm", "ss_x%"]
    assert C.drop_if_present(df, ["x%", "zzz"]).columns == ["name_norm"]


def test_drop_null_rows_counts_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert C.drop_null_rows(df, ["x"]).count() == 1


def test_find_target(spark):
    df = spark.sql("SELECT 1 AS experience, 2 AS ss_PER")
    assert C.find_target(df, ["ss_PER"], "PER") == "ss_PER"
    assert C.find_target(df, [], "PER") == "experience"
    with pytest.raises(ValueError):
        C.find_target(df, ["zzz"])


def test_features_leave_out_copies_of_the_target(spark):
    df = spark.sql("SELECT 1 AS PER, 2 AS PER_minmax, 3 AS PERx, 4 AS y, 'a' AS z")
    assert C.select_features(df, "PER") == ["PERx", "y"]
    assert C.select_features(df, "PER", drop_derived=False) == ["PER_minmax", "PERx", "y"]


def test_parse_length(spark):
    cases = {
        "6-7": 79, "0-0": 0, "180": 71, " 180 ": 71, "180.34": 71, "-5": -2, "a-b": None, "6-7-8": None,
        "5-": None, "-": None, "": None, "nan": None, "inf": None, "Infinity": None, "5d": None, "0x10": None,
        "1e2": 39, "1e-2": 0, "-5e-2": None, "1_0": 4, "1__0": None, "+254": 100, ".5": 0, "5.": 2,
        "99999999999-1": None, "6 -7": None, "--7": None, "3.81": 2, "6.35": 2, "1.27": 0, None: None,
    }
    got = values(spark, list(cases), S.parse_length_inches)
    assert dict(zip(cases, got)) == cases


def test_parse_length_of_numbers(spark):
    assert values(spark, [254.0, None, float("nan")], S.parse_length_inches, "double") == [100, None, None]


def test_normalize_key(spark):
    inputs = ["  Ab C\t", "", None, "   ", " X ", "\n\x1cy\x1f"]
    assert values(spark, inputs, S.normalize_key) == ["ab c", None, None, "", "x", "y"]


def test_strip_suffix_and_dates(spark):
    assert values(spark, ["PF-C", "C", "-x", None], S.strip_suffix) == ["PF", "C", "", None]
    assert values(spark, [None, dt.date(2001, 2, 3)], S.fill_date, "date") == [
        dt.date(1900, 1, 1), dt.date(2001, 2, 3),
    ]


def test_paths(spark):
    paths = ["file:/d/Forest/1.png", "/d/deforest/2.png", "/sea/forest/3", None]
    assert values(spark, paths, S.normalize_path)[0] == "/d/Forest/1.png"
    assert values(spark, paths, lambda c: S.path_label(c, ["forest", "sea"])) == [0, -1, 0, -1]
    assert values(spark, paths, lambda c: S.path_label(c, ["forest"], "substring"))[:3] == [0, 0, 0]


def test_argmax_takes_the_first(spark):
    got = values(spark, [[0.2, 0.5, 0.5], [1.0]], S.argmax_class, "array<double>")
    assert got == [1, 0]


def test_unit_hash_is_uniform_and_seeded(spark):
    row = spark.range(20000).select(
        F.avg(S.unit_hash(F.col("id"))), F.corr(S.unit_hash(F.col("id")), S.unit_hash(F.col("id"), 7))
    ).first()
    assert abs(row[0] - 0.5) < 0.01 and abs(row[1]) < 0.03


def test_reshape_and_scale(spark):
    got = values(spark, [[0.0, 255.0, 51.0, 102.0]], lambda c: S.reshape_pixels(S.scale_pixels(c), 2, 2), "array<double>")
    assert got == [[[0.0, 1.0], [0.2, 0.4]]]
