"""Class lists by teacher and by pupil."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.functions.semantics import PUPIL_DEFAULTS, impute, matches
from registrar.operators.joins import anti_join, inner_join, left_join, left_join_many
from registrar.plans.common import (
    GENERAL_CLASS_LIST,
    NAMELESS,
    SENSITIVE_CLASS_LIST,
    coded_subjects,
    group_dim,
    group_members,
    join_pupils,
    pupil_dim,
    pupil_texts,
    subjects,
)
from registrar.sources.catalog import SchoolCatalog

TARGET = "Target"  # fixed value: name of the grade type that holds targets

_IDENTITY = ["upn", "registration_group", "year_group"]


def year_group_range(first: str, last: str) -> list[str]:
    """Inclusive range of year groups, as the text the source tables use."""
    return [str(y) for y in range(int(first), int(last) + 1)]


def grades_with_type(cat: SchoolCatalog, academic_year: int, year_groups: list[str]) -> DataFrame:
    """Grades of some year groups with type, subject name and code, and whether the name stands for one code."""
    grades = cat.rows("attainment_grades", academic_year, year_groups=year_groups).select(
        "student_id", "subject_id", "grade_type_id", "grade"
    )
    types = (
        cat.rows("attainment_grade_types", academic_year, year_groups=year_groups)
        .select(F.col("id").alias("grade_type_id"), F.col("name").alias("grade_type"))
        .distinct()
    )
    df = left_join(grades, types, ["grade_type_id"])
    return left_join(df, coded_subjects(cat, academic_year), ["subject_id"])


def class_list_pupils(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    return pupil_dim(
        cat, academic_year, _IDENTITY, GENERAL_CLASS_LIST, SENSITIVE_CLASS_LIST
    )


def class_places(
    cat: SchoolCatalog,
    academic_year: int,
    staff: Sequence[str] | None = None,
    pupils: DataFrame | None = None,
    of_class: DataFrame | None = None,
) -> DataFrame:
    """Distinct (staff, subject, class, pupil); a group without pupils is kept.

    ``staff`` is tested on the groups, which cuts the membership join, and
    ``pupils`` before the rows are made distinct, which cuts that shuffle.
    ``of_class`` adds columns of the class, one row per class.
    """
    groups = group_dim(cat, academic_year)
    added = []
    if of_class is not None:
        added = [c for c in of_class.columns if c != "class"]
        groups = left_join(groups, of_class, ["class"])
    if staff is not None:
        groups = groups.filter(F.col("staff_code").isin(list(staff)))
    places = left_join_many(groups, group_members(cat, academic_year), ["group_id"])
    if pupils is not None:
        places = inner_join(places, pupils.select("student_id").distinct(), ["student_id"])
    return places.select("staff_code", "subject", "class", "student_id", *added).distinct()


def _code(column: str) -> Column:
    """A code that is never null, as ``isin`` knows no missing values."""
    return F.coalesce(F.col(column), F.lit("\u0000missing"))


def target_lists(cat: SchoolCatalog, academic_year: int, year_groups: list[str]) -> DataFrame:
    """Each pupil's distinct (subject, target) pairs as one array.

    As many pairs as the pupil has subjects and target values, however often
    they are repeated, and combined before they move. The grade type is
    tested by a subquery in a filter, which reaches the scan, so that other
    grades are not joined to anything.
    """
    types = cat.rows("attainment_grade_types", academic_year, year_groups=year_groups)
    types = types.filter(F.col("name") == TARGET).select(_code("id"))
    grades = cat.rows("attainment_grades", academic_year, year_groups=year_groups).select(
        "student_id", "subject_id", "grade_type_id", F.col("grade").alias("target")
    )
    grades = grades.filter(_code("grade_type_id").isin(types)).drop("grade_type_id")
    grades = left_join(grades, subjects(cat, academic_year), ["subject_id"])
    pairs = F.collect_set(F.struct("subject", "target"))
    return grades.groupBy("student_id").agg(F.array_distinct(pairs).alias("targets"))


def attach_targets(
    cat: SchoolCatalog, academic_year: int, places: DataFrame, year_groups: list[str]
) -> DataFrame:
    """Attach the pupil's target pairs to each place: joined by pupil, as the pupil columns are, so places move once."""
    return left_join(places, target_lists(cat, academic_year, year_groups), ["student_id"])


def explode_targets(df: DataFrame) -> DataFrame:
    """A row per target of the pupil in the row's subject, or one without a target."""
    of_subject = F.filter("targets", lambda t: t["subject"].eqNullSafe(F.col("subject")))
    values = F.transform(of_subject, lambda t: t["target"])
    return df.withColumn("target", F.explode_outer(values)).drop("targets")


_RENAMED = {
    "gfsid": "student_id",
    "reg": "registration_group",
    "surname": "preferred_last_name",
    "forename": "preferred_first_name",
    "gender": "sex",
}


def class_list_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = pupil_texts(wbr_pp=True)
    df = df.select(
        *[texts[c].alias(c) if c in texts else F.col(_RENAMED.get(c, c)).alias(c) for c in columns]
    )
    return impute(df, {c: v for c, v in PUPIL_DEFAULTS.items() if c in columns})


TEACHER_COLUMNS = [
    "staff_code", "year_group", "reg", "subject", "class", "upn", "gfsid", "uci",
    "surname_forename_reg", "surname_forename_id", "surname", "forename", "gender", "lac",
    "ethnicity", "eal", "fsm", "pp", "wbr_pp", "hml_band", "target", "sen", "sen_notes",
    "keyworker",
]
STUDENT_COLUMNS = [
    "upn", "gfsid", "uci", "surname_forename_reg", "surname_forename_id", "surname", "forename",
    "gender", "lac", "ethnicity", "eal", "fsm", "pp", "wbr_pp", "hml_band", "sen", "sen_notes",
    "keyworker", "year_group", "reg", "subject", "class", "staff_code",
]


def class_list_teacher(
    cat: SchoolCatalog,
    academic_year: int,
    staff_code: str | Sequence[str] | None = None,
    year_group_from: str = "7",
    year_group_to: str = "11",
) -> DataFrame:
    """Every class of all or some staff, a row per pupil and target grade.

    Places, targets and pupils are each distinct and all their columns are
    kept, so the wide rows are distinct as they are.
    """
    staff = [staff_code] if isinstance(staff_code, str) else staff_code
    df = class_places(cat, academic_year, staff)
    df = attach_targets(cat, academic_year, df, year_group_range(year_group_from, year_group_to))
    df = join_pupils(cat, df, class_list_pupils(cat, academic_year))
    return class_list_columns(explode_targets(df), TEACHER_COLUMNS)


def class_list_student(cat: SchoolCatalog, academic_year: int, student: str) -> DataFrame:
    """Every class of the pupils whose label matches a pattern.

    The label needs pupil columns only, so it is tested on the pupil
    dimension and the survivors pick their places. Places without pupil
    details all carry the same label; that branch disappears from the plan
    when the pattern does not match it.
    """
    pupils = class_list_pupils(cat, academic_year)
    named = pupils.filter(matches(F.col("surname_forename_reg"), student))
    found = class_places(cat, academic_year, pupils=named)
    found = inner_join(found, named, ["student_id"])
    nameless = anti_join(class_places(cat, academic_year), pupils, ["student_id"])
    nameless = nameless.filter(matches(F.lit(NAMELESS), student))
    df = found.unionByName(nameless, allowMissingColumns=True)
    return class_list_columns(df, STUDENT_COLUMNS)
