"""One small case per null, text and number rule."""

import pytest
from pyspark.sql import functions as F

from registrar.functions import semantics as sem
from registrar.operators.joins import left_join
from registrar.operators.reshape import eav_wide, split_pair


def column(spark, values, ddl="x string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def values(df, *columns):
    rows = df.select(*columns).collect()
    return [r[0] for r in rows] if len(columns) == 1 else [tuple(r) for r in rows]


def test_missing_key_equals_missing_key(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10)], "k string, w int")
    got = left_join(left, right, ["k"])
    assert sorted(values(got, "v", "w")) == [(1, 10), (2, None)]


def test_pasted_missing_reads_na(spark):
    df = spark.createDataFrame(
        [(None, "Ann", None)],
        "preferred_last_name string, preferred_first_name string, registration_group string",
    )
    assert values(df, sem.label_reg()) == ["NA Ann (NA)"]


def test_regex_on_missing_is_false(spark):
    df = column(spark, [None, "Extra TIME", "no"])
    assert values(df, sem.matches(F.col("x"), "extra time")) == [False, True, False]


def test_alternatives_ignore_case_in_every_branch(spark):
    df = column(spark, ["GCSE x", "BTEC y", "A level"])
    assert values(df, sem.matches(F.col("x"), sem.any_of(["gcse", "btec"]))) == [True, True, False]


def test_conditional_on_missing_is_missing(spark):
    df = column(spark, [None, "a", "b"])
    assert values(df, sem.ifelse(F.col("x") == "a", "yes", "no")) == [None, "yes", "no"]


def test_white_british_flag(spark):
    df = spark.createDataFrame(
        [("Welsh", None), ("Other", None), ("Welsh", "True"), (None, "True"), ("White English", "False")],
        "e string, p string",
    )
    got = values(df, sem.white_british_pp(F.col("e"), F.col("p")))
    assert got == [None, "False", "True", "False", "False"]


def test_na_cells_become_null_but_lists_of_na_stay(spark):
    df = sem.na_cells_to_null(column(spark, ["NA", "NA, NA", "Nan", None]))
    assert values(df, "x") == [None, "NA, NA", "Nan", None]


def test_number_text(spark):
    df = column(spark, [6.0, 5.5, None], "x double")
    assert values(df, sem.number_text(F.col("x"))) == ["6", "5.5", None]


def test_unreadable_number_is_null(spark):
    df = column(spark, ["6", "x", "", " 7 ", "5.7", None])
    assert values(df, sem.to_integer(F.col("x"))) == [6, None, None, 7, 5, None]


def test_rounding_is_half_to_even(spark):
    df = column(spark, [0.5, 1.5, 2.5], "x double")
    assert values(df, F.bround("x", 0)) == [0.0, 2.0, 2.0]


def test_out_of_domain_becomes_null_and_sorts_last(spark):
    df = column(spark, ["12", "11", "7", None])
    assert values(df, sem.in_domain(F.col("x"), sem.YEAR_GROUPS)) == [None, "11", "7", None]
    ordered = df.orderBy(sem.domain_order(F.col("x"), sem.YEAR_GROUPS), F.col("x").asc_nulls_last())
    assert values(ordered, "x") == ["7", "11", "12", None]


def test_split_pads_and_drops(spark):
    df = column(spark, ["6/5", "7", "1/2/3", None])
    assert values(df, *split_pair(F.col("x"), "/", "a", "b")) == [
        ("6", "5"), ("7", None), ("1", "2"), (None, None),
    ]


def test_backslash_mark_is_folded(spark):
    assert values(column(spark, ["\\", "/", None]), sem.fold_present(F.col("x"))) == ["/", "/", None]


def test_pivot_policies(spark):
    eav = spark.createDataFrame(
        [("1", "A", "x"), ("1", "A", "w"), ("1", "B", "z"), ("2", "C", "q")],
        "student_id string, name string, value string",
    )
    wanted = [(eav, {"A": "a", "Missing": "m"})]
    assert values(eav_wide(wanted), "student_id", "a", "m") == [("1", "w", None)]
    assert values(eav_wide(wanted, duplicates="list"), "a", "m") == [(["w", "x"], [])]
    with pytest.raises(Exception, match="more than one value of a"):
        eav_wide(wanted, duplicates="error").collect()
    with pytest.raises(ValueError):
        eav_wide(wanted, duplicates="first")


def test_impute_only_nulls(spark):
    df = column(spark, [None, "k"])
    assert values(sem.impute(df, {"x": "Unknown"}), "x") == ["Unknown", "k"]


def test_matches_folds_the_case_of_all_letters(spark):
    from registrar.functions.semantics import matches

    df = spark.createDataFrame([("MÜLLER Ann (7A)",), ("ÉLODIE",), ("Muller",), (None,)], "name string")
    assert [r[0] for r in df.select(matches(F.col("name"), "müller|élo")).collect()] == [True, True, False, False]
