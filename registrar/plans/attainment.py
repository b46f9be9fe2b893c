"""Examination results, grades, targets and markbooks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.functions.semantics import (
    PUPIL_DEFAULTS,
    UNKNOWN_HML,
    YEAR_GROUPS,
    all_text,
    any_of,
    domain_order,
    impute,
    in_domain,
    matches,
    na_text,
    number_text,
    to_integer,
    white_british_pp,
)
from registrar.operators.joins import left_join, left_join_where, same_where_met, with_hash_key
from registrar.operators.reshape import split_pair
from registrar.plans.classlists import (
    TEACHER_COLUMNS,
    attach_targets,
    class_list_columns,
    class_list_pupils,
    class_places,
    explode_targets,
    grades_with_type,
    target_lists,
    year_group_range,
)
from registrar.plans.common import (
    GENERAL_BAND,
    SENSITIVE_PP,
    class_membership,
    coded_subjects,
    join_pupils,
    pupil_dim,
    pupil_texts,
)
from registrar.sources.catalog import SchoolCatalog

# Fixed values.
GRADE_TYPE_EXTERNAL = "External examination"
DOUBLE_GRADE_SUBJECT = "Combined Science 9-1"

_IDENTITY = ["upn", "registration_group", "year_group"]
_NO_SUBJECT = "\u0000no group"
_MISSING_SUBJECT = "\u0000missing"
_PUPIL_KEY = ["__pupil", "__no_pupil"]

MARK_COLUMNS = ["markbook", "strand", "mark", "max", "grade"]
TARGET_COLUMNS = [
    "staff_code", "ac_year", "year_group", "subject", "class", "upn", "gfsid",
    "surname_forename_reg", "surname_forename_id", "gender", "reg", "ethnicity", "pp", "wbr_pp",
    "hml_band", "sen", "sen_notes", "target",
]
_DERIVED = ["ac_year", "surname_forename_id", "wbr_pp"]  # from other columns of the row


def exam_results(
    cat: SchoolCatalog,
    academic_year: int,
    year_group: str,
    type: str | Sequence[str] | None = None,
) -> DataFrame:
    """External results of one year group with class, staff and pupil details.

    ``type`` keeps qualification titles matching any of the given patterns.
    """
    results = cat.rows("exam_results", academic_year, year_groups=[year_group])
    if type is not None:
        results = results.filter(matches(F.col("qualification_title"), any_of(type)))
    results = results.select("student_id", "subject_id", "qualification_title", "grade")
    df = left_join(results, coded_subjects(cat, academic_year), ["subject_id"])
    pupils = pupil_dim(cat, academic_year, _IDENTITY, GENERAL_BAND, SENSITIVE_PP)
    df = _by_class(cat, academic_year, df, ["qualification_title", "grade"], pupils).select(
        "staff_code", "year_group", "qualification_title", "subject", "class", "upn",
        F.col("student_id").alias("gfsid"),
        *[text.alias(c) for c, text in pupil_texts().items()],
        F.col("preferred_last_name").alias("surname"),
        F.col("preferred_first_name").alias("forename"),
        F.col("registration_group").alias("reg"),
        F.col("sex").alias("gender"),
        "pp", "hml_band",
        F.lit(GRADE_TYPE_EXTERNAL).alias("grade_type"),
        "grade",
    )
    return impute(df, {"hml_band": UNKNOWN_HML})


def _by_class(
    cat: SchoolCatalog, academic_year: int, df: DataFrame, details: list[str], pupils: DataFrame
) -> DataFrame:
    """Distinct results with the pupil's classes in the subject and pupil columns.

    The membership is distinct, so one pupil has at most as many rows as the
    school has classes and staff. Results and membership meet by pupil, the
    subject is tested there, and the pupil columns are joined where the many
    rows of the join are. Where a subject's name stands for one code, distinct
    results and classes make distinct rows; only others are made so afterwards.
    """
    one_code = F.coalesce("one_code", F.lit(False))
    df = df.select("student_id", "subject_code", "subject", one_code.alias("one_code"), *details).distinct()
    df = with_hash_key(df, "student_id", *_PUPIL_KEY)
    classes = class_membership(cat, academic_year).withColumnRenamed("subject_code", "class_code")
    classes = with_hash_key(classes, "student_id", *_PUPIL_KEY)
    same_subject = same_where_met(F.col("subject_code"), F.col("class_code"))

    def placed(results: DataFrame) -> DataFrame:
        rows = left_join_where(results, classes, _PUPIL_KEY, same_subject, never_null=True)
        return rows.select("staff_code", "subject", "class", *_PUPIL_KEY, *details)

    clear = _join_by_pupil(placed(df.filter("one_code")), pupils)
    unclear = _join_by_pupil(placed(df.filter(~F.col("one_code"))).distinct(), pupils)
    return _with_pupil_id(clear.unionByName(unclear))


def attainment(cat: SchoolCatalog, academic_year: int, year_group: str) -> DataFrame:
    """All grades of one year group."""
    return _attainment(cat, academic_year, [year_group])


def attainment_multiple(
    cat: SchoolCatalog,
    academic_year: int,
    year_group_from: str = "7",
    year_group_to: str = "11",
) -> DataFrame:
    """All grades of an inclusive range of year groups: one pruned scan."""
    return _attainment(cat, academic_year, year_group_range(year_group_from, year_group_to))


def _attainment(cat: SchoolCatalog, academic_year: int, year_groups: list[str]) -> DataFrame:
    df = grades_with_type(cat, academic_year, year_groups)
    df = _by_class(
        cat, academic_year, df, ["grade_type", "grade"], pupil_dim(cat, academic_year, _IDENTITY)
    )
    return df.select(
        "staff_code", "year_group", "subject", "class", "upn",
        F.col("student_id").alias("gfsid"),
        *[text.alias(c) for c, text in pupil_texts().items()],
        F.col("preferred_last_name").alias("surname"),
        F.col("preferred_first_name").alias("forename"),
        F.col("registration_group").alias("reg"),
        F.col("sex").alias("gender"),
        "grade_type", "grade",
    )


def targets(
    cat: SchoolCatalog,
    academic_year: int,
    subject: str | None = None,
    double_grade_subject: str = DOUBLE_GRADE_SUBJECT,
    ordered: bool = True,
) -> DataFrame:
    """Target grades with the leaving-cohort code, for all or one subject.

    A double-grade subject stores ``a/b``; its target is the mean of the two.
    """
    places = class_places(cat, academic_year)
    if subject is not None:
        places = places.filter(F.col("subject") == subject)
    df = attach_targets(cat, academic_year, places, year_group_range("7", "11"))
    df = explode_targets(join_pupils(cat, df, _target_pupils(cat, academic_year)))
    doubled = subject is not None and subject == double_grade_subject
    if doubled:
        pair = df.select("*", *split_pair(F.col("target"), "/", "first_grade", "second_grade"))
        mean = (to_integer(F.col("first_grade")) + to_integer(F.col("second_grade"))) / 2
        df = pair.withColumn("target", number_text(mean)).drop("first_grade", "second_grade")
    stored = [c for c in TARGET_COLUMNS if c not in _DERIVED]
    df = class_list_columns(df, stored)
    if doubled:
        df = df.distinct()
    df = df.withColumn("year_group", in_domain(F.col("year_group"), YEAR_GROUPS))
    if ordered:
        df = df.orderBy(
            domain_order(F.col("year_group"), YEAR_GROUPS),
            *[
                F.col(c).asc_nulls_last()
                for c in ("class", "surname_forename_reg", "gfsid", "staff_code", "target")
            ],
        )
    # What other columns spell out is added to the sorted rows and does not move with them.
    leaving = academic_year + int(YEAR_GROUPS[-1]) - to_integer(F.col("year_group"))
    reg, ident = na_text(F.col("reg")), na_text(F.col("gfsid"))
    name = F.substring(
        "surname_forename_reg", F.lit(1), F.length("surname_forename_reg") - F.length(reg) - 2
    )
    return df.select(
        "*",
        F.concat(F.lit("c"), leaving.cast("string")).alias("ac_year"),
        F.concat(name, F.lit("("), ident, F.lit(")")).alias("surname_forename_id"),
        white_british_pp(F.col("ethnicity"), F.col("pp")).alias("wbr_pp"),
    ).select(*TARGET_COLUMNS)


def _target_pupils(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """The pupil columns of a target row, distinct: distinct places and targets joined to them stay distinct."""
    pupils = impute(class_list_pupils(cat, academic_year), PUPIL_DEFAULTS)
    return pupils.select(
        "student_id", "year_group", "upn", "surname_forename_reg", "sex", "registration_group",
        "ethnicity", "pp", "hml_band", "sen", "sen_notes",
    ).distinct()


def markbook_attainment(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Class list with every markbook mark of the pupil in that class.

    A mark belongs to a subject and a subject has many classes, so joining
    marks to classes first multiplies them. Here the places of the class list
    carry the subjects of their class and meet the pupil's marks: places,
    marks, targets and pupil columns are all put by pupil, once each, and the
    many rows of the result are made where they are and do not move.
    """
    class_subjects = (
        cat.rows("teaching_groups", academic_year)
        .select(F.col("name").alias("class"), "subject_id")
        .distinct()
    )
    # A mark whose subject has no group has no class either, and so belongs to
    # class list rows without a class; a marker subject stands for it.
    no_class = cat.spark.range(1).select(
        F.lit(None).cast("string").alias("class"), F.lit(_NO_SUBJECT).alias("subject_id")
    )
    subject = F.coalesce("subject_id", F.lit(_MISSING_SUBJECT))
    subjects_of_class = (
        class_subjects.unionByName(no_class).groupBy("class").agg(F.collect_set(subject).alias("class_subjects"))
    )
    places = class_places(cat, academic_year, of_class=subjects_of_class)
    marks = _marks_by_pupil(cat, academic_year, class_subjects.select("subject_id").distinct(), subject)
    df = with_hash_key(places, "student_id", *_PUPIL_KEY)
    df = left_join_where(
        df, marks, _PUPIL_KEY, F.arrays_overlap("class_subjects", "mark_subjects"), never_null=True
    )
    df = _join_by_pupil(df, target_lists(cat, academic_year, year_group_range("7", "11")))
    df = _join_by_pupil(df, class_list_pupils(cat, academic_year))
    return class_list_columns(_with_pupil_id(explode_targets(df)), [*TEACHER_COLUMNS, *MARK_COLUMNS])


def _join_by_pupil(df: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of rows put by the pupil's hash key to a table with a pupil id; the rows stay where they are."""
    return left_join(df, with_hash_key(right, "student_id", *_PUPIL_KEY), _PUPIL_KEY, never_null=True)


def _with_pupil_id(df: DataFrame) -> DataFrame:
    value, missing = _PUPIL_KEY
    return df.withColumn("student_id", F.when(~F.col(missing), F.col(value))).drop(*_PUPIL_KEY)


def _marks_by_pupil(
    cat: SchoolCatalog, academic_year: int, grouped: DataFrame, subject: Column
) -> DataFrame:
    """Distinct marks, put by pupil, with the set of subjects in which the pupil has them.

    ``grouped`` are the subjects that have groups, and ``subject`` names one.
    """
    known = grouped.withColumn("known", F.lit(True))
    # Also the subject of a mark without a column, which is missing.
    missing_known = grouped.select(F.coalesce(F.bool_or(F.col("subject_id").isNull()), F.lit(False))).scalar()
    columns = cat.rows("markbooks", academic_year).select(
        "column_id", "subject_id", F.col("markbook_name").alias("markbook"),
        F.col("strand_name").alias("strand"),
    )
    columns = left_join(all_text(columns), known, ["subject_id"]).select(
        "column_id", "markbook", "strand", F.when(F.col("known"), subject).otherwise(F.lit(_NO_SUBJECT)).alias("found"),
    )
    marks = all_text(cat.rows("marks", academic_year).select("column_id", "student_id", "mark", "max", "grade"))
    marks = left_join(marks, columns, ["column_id"])
    no_column = F.when(missing_known, F.lit(_MISSING_SUBJECT)).otherwise(F.lit(_NO_SUBJECT))
    marks = marks.select("student_id", *MARK_COLUMNS, F.coalesce("found", no_column).alias("found"))
    marks = with_hash_key(marks, "student_id", *_PUPIL_KEY).repartition(*_PUPIL_KEY)
    return marks.groupBy(*_PUPIL_KEY, *MARK_COLUMNS).agg(F.collect_set("found").alias("mark_subjects"))
