"""One case per missing-value, tie and ordering rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from florametrics import functions as fn
from florametrics.operators import aggregates as A
from florametrics.operators import columns as C
from florametrics.operators import joins as J
from florametrics.operators import ordered as O
from florametrics.operators import ranking as K
from florametrics.operators import reshape as R


def test_missing_keys_match(spark, rows):
    l = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    r = spark.createDataFrame([(None, 10), ("b", 20)], "k string, y int")
    assert rows(J.full_join_ns(l, r, "k"), "k", "x", "y") == [(None, 2, 10), ("a", 1, None), ("b", None, 20)]
    assert rows(J.semi_ns(l, r, "k")) == [(None, 2)]
    assert rows(J.anti_ns(l, r, "k")) == [("a", 1)]
    assert rows(J.flag_member(l, r, "k", "in"), "x", "in") == [(1, "No"), (2, "Yes")]


def test_clashing_columns_get_suffixes(spark):
    l = spark.createDataFrame([("a", 1)], "k string, v int")
    r = spark.createDataFrame([("a", 2)], "k string, v int")
    assert J.left_join_ns(l, r, "k").columns == ["k", "v_x", "v_y"]
    assert J.full_join_ns(l, r, "k").columns == ["k", "v_x", "v_y"]


def test_natural_join_needs_common_columns(spark):
    with pytest.raises(ValueError):
        J.natural_left(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int"))


def test_negated_filters_keep_missing(spark, rows):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "p string")
    assert rows(C.where_in(df, "p", ["x"], negate=True)) == [(None,), ("y",)]
    assert rows(C.where_matches(df, "p", "^x", negate=True)) == [(None,), ("y",)]
    assert rows(C.where_matches(df, "p", "^x")) == [("x",)]


def test_aggregates_propagate_missing(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0)], "g string, v double")
    out = A.describe_by(df, ["g"], "v", n50="n50")
    assert rows(out, "g", "mean", "max", "n", "total", "median") == [
        ("a", None, None, 2, None, None), ("b", 3.0, 4.0, 2, 6.0, 3.0)]
    assert rows(A.count_true(df, ["g"], F.col("v") > 2)) == [("a", None), ("b", 1)]


def test_paste_and_conditions(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    got = df.select(
        fn.paste("x", "y", sep="-").alias("p"), fn.if_else_na(F.col("y") == "q", F.lit("t"), F.lit("f")).alias("i"),
        fn.case((F.col("y") == "q", "t"), default="f").alias("c")).first()
    assert tuple(got) == ("a-NA", None, "f")


def test_top_n_keeps_ties_and_drops_missing(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("a", None), ("b", None)], "g string, w int")
    assert rows(K.top_n(df, ["g"], "w", 1)) == [("a", 3), ("a", 3)]
    assert rows(K.top_n(df, ["g"], "w", 2)) == [("a", 3), ("a", 3)]
    assert rows(K.top_n(df, ["g"], "w", 3)) == [("a", 1), ("a", 3), ("a", 3)]


def test_cascade_can_empty_a_group(spark, rows):
    df = spark.createDataFrame(
        [("a", 9.0, None), ("a", 8.0, 1.0), ("b", 5.0, 1.0), ("b", 5.0, 2.0), ("b", 5.0, 1.0)], "g string, x double, y double")
    assert rows(K.cascade_top(df, ["g"], [("x", "desc"), ("y", "asc")])) == [("b", 5.0, 1.0), ("b", 5.0, 1.0)]


def test_separate_drops_extras_and_pads(spark, rows):
    df = spark.createDataFrame([("UC-003.05.9",), ("UC",), (None,)], "s string")
    out = R.separate(df, "s", ["a", "n", "m"], {"n": "int", "m": "int"})
    assert rows(out) == [(None, None, None), ("UC", None, None), ("UC", 3, 5)]


def test_extract_without_match_is_missing(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert tuple(df.select(fn.extract("s", "[0-9]+"), fn.taxid("s")).first()) == (None, None)


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("x", "no date"), (" 2.5 ", "2024/02/03")], "n string, d string")
    got = [tuple(r) for r in df.select(fn.lenient_number("n"), fn.lenient_date("d")).collect()]
    assert got == [(None, None), (2.5, dt.date(2024, 2, 3))]


def test_padding_never_truncates(spark):
    df = spark.createDataFrame([("LD", 1234, 5), ("LD", None, None), (None, 7, 123)], "a string, n int, m int")
    got = [r[0] for r in df.select(fn.padded_id("a", "n", "m")).collect()]
    assert got == ["LD-1234.05", "LD- NA.NA", "NA-007.123"]


def test_sort_puts_missing_last(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    for direction, want in (("asc", [1, 3, None]), ("desc", [3, 1, None])):
        assert [r.v for r in K.sort_na_last(df, [("v", direction)]).collect()] == want


def test_pool_names(spark):
    names = ["MMF.16S.100_MMF.16S.101_SamLight.finalPhy_rdp.rds", "SM100_SM101_SamLight.finalPhy_rdp.rds", "/a/b/SM36.x.rds"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(fn.pool_id("f")).collect()] == [
        "MMF.16S.100_MMF.16S.101_SamLight", "SM100_SM101_SamLight", "SM36"]


def test_subject_ids(spark):
    names = ["200101-UC-003.05", "200101-Donor-D1.2.S", "HT-005-01"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert [r[0] for r in df.select(fn.subject_id("f")).collect()] == ["UC-003.05", "D1002", "HT-005.01"]


def test_strand_swap_uses_original_values(spark, rows):
    df = spark.createDataFrame([(1, 9, "minus"), (2, 8, "plus"), (3, 7, None)], "s int, e int, t string")
    assert rows(C.orient(df, "s", "e", "t"), "s", "e") == [(2, 8), (3, 7), (9, 1)]


def test_single_value_check_counts_missing(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", None), ("c", None)], "g string, v string")
    assert rows(A.single_by(df, ["g"], ["v"]), "g", "ambiguous") == [("a", False), ("b", True), ("c", False)]


def test_first_row_keeps_file_order(spark, rows):
    df = spark.createDataFrame([("a", 2, "later"), ("a", 1, "first"), ("a", None, "unplaced")], "k string, o int, v string")
    assert rows(A.first_by(df, ["k"], ["o"]), "k", "v") == [("a", "first")]


def test_quantiles_of_a_single_value_and_negative_numbers(spark):
    df = spark.createDataFrame([("a", -5.0), ("b", -3.5), ("b", -1.0), ("b", 0.0), ("b", 1e9)], "g string, v double")
    got = {r.g: r.m for r in A.quantiles_by(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {"a": -5.0, "b": -0.5}


def test_order_levels_number_missing_last(spark, rows):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "x string")
    assert rows(O.order_levels(df, ["x"])) == [(None, 3), ("a", 1), ("b", 2)]


def test_guards(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        C.require_columns(df, ["a", "b"])
