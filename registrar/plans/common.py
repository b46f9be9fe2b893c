"""Sub-plans that several products share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.functions.semantics import label_id, label_reg, paste, white_british_pp
from registrar.operators.joins import full_join, left_join, left_join_many
from registrar.operators.reshape import eav_wide, list_text
from registrar.sources.catalog import PUPIL_TABLES, SchoolCatalog

# Attribute names of the two pupil attribute tables.
GENERAL_FULL = {
    "Admission number": "ad_no",
    "UCI": "uci",
    "HML Band": "hml_band",
    "3.  SEN Code": "sen",
    "4. SEN Notes": "sen_notes",
    "5. Keyworker Name": "keyworker",
    "Admission date": "date_admission",
}
GENERAL_CLASS_LIST = {
    a: c for a, c in GENERAL_FULL.items() if c not in ("ad_no", "date_admission")
}
GENERAL_BAND = {"HML Band": "hml_band"}
SENSITIVE_FULL = {
    "Looked after": "lac",
    "Ethnicity": "ethnicity",
    "EAL": "eal",
    "FSM": "fsm",
    "FSMEver6": "fsm6",
    "Pupil Premium Indicator": "pp",
}
SENSITIVE_CLASS_LIST = {a: c for a, c in SENSITIVE_FULL.items() if c != "fsm6"}
SENSITIVE_PP = {"Pupil Premium Indicator": "pp"}

NAMELESS = "NA NA (NA)"  # label of a row without pupil details

NAMES = ["preferred_last_name", "preferred_first_name", "sex"]


def students(cat: SchoolCatalog, year: int) -> DataFrame:
    """Pupils: ``student_id`` and names, no duplicates."""
    return (
        cat.rows("students", year)
        .select(F.col("id").alias("student_id"), *NAMES)
        .distinct()
    )


def edu_details(cat: SchoolCatalog, year: int, columns: Sequence[str]) -> DataFrame:
    return cat.rows("student_edu_details", year).select("student_id", *columns).distinct()


def attributes(
    cat: SchoolCatalog,
    year: int,
    general: Mapping[str, str],
    sensitive: Mapping[str, str],
    duplicates: str = "min",
) -> DataFrame:
    """Both attribute tables, widened together: one row per pupil, all text.

    Under the ``list`` policy, repeated values read ``a, b``.
    """
    wide = eav_wide(
        [
            (cat.rows("student_general", year), general),
            (cat.rows("student_sensitive", year), sensitive),
        ],
        duplicates=duplicates,
    )
    if duplicates == "list":
        columns = [*general.values(), *sensitive.values()]
        wide = wide.withColumns({c: list_text(F.col(c)) for c in columns})
    return wide


def pupil_dim(
    cat: SchoolCatalog,
    year: int,
    edu: Sequence[str],
    general: Mapping[str, str] | None = None,
    sensitive: Mapping[str, str] | None = None,
    duplicates: str = "min",
) -> DataFrame:
    """Everything about a pupil in one dimension.

    A full join, because a fact joined to each pupil table in turn keeps the
    details of a pupil missing from the roll. One dimension means a fact is
    shuffled once for all of them, in a single join whose hot keys adaptive
    execution can split. Its rows are distinct, so a distinct fact joined to
    it needs no second ``distinct`` over the wide rows. ``on_roll`` is null
    for a pupil known from the other tables only.
    """
    roll = students(cat, year).withColumn("on_roll", F.lit(True))
    known = cat.never_null(*PUPIL_TABLES)
    dim = full_join(roll, edu_details(cat, year, edu), "student_id", known)
    if general or sensitive:
        wide = attributes(cat, year, general or {}, sensitive or {}, duplicates)
        dim = full_join(dim, wide, "student_id", known)
    derived = {
        "surname_forename_reg": label_reg(),
        "surname_forename_id": label_id(F.col("student_id")),
    }
    if sensitive and {"ethnicity", "pp"} <= set(sensitive.values()):
        derived["wbr_pp"] = white_british_pp(F.col("ethnicity"), F.col("pp"))
    return dim.withColumns(derived)


def join_pupils(cat: SchoolCatalog, df: DataFrame, pupils: DataFrame) -> DataFrame:
    """Left join of a fact or class list to pupils made of the pupil tables."""
    return left_join(df, pupils, ["student_id"], cat.never_null(*PUPIL_TABLES))


def pupil_texts(wbr_pp: bool = False) -> dict[str, Column]:
    """The labels of a fact row joined to the pupil dimension.

    They are made once per pupil, in the dimension, where they are never
    null; a fact row without a pupil gets what its missing details spell.
    """
    reg, ident = F.col("surname_forename_reg"), F.col("surname_forename_id")
    texts = {
        "surname_forename_reg": F.coalesce(reg, F.lit(NAMELESS)),
        "surname_forename_id": F.coalesce(ident, paste("NA NA (", F.col("student_id"), ")")),
    }
    if wbr_pp:
        texts["wbr_pp"] = F.when(reg.isNull(), F.lit("False")).otherwise(F.col("wbr_pp"))
    return texts


def subjects(cat: SchoolCatalog, year: int) -> DataFrame:
    return cat.rows("teaching_subjects", year).select(
        F.col("id").alias("subject_id"),
        F.col("name").alias("subject"),
        F.col("code").alias("subject_code"),
    )


def coded_subjects(cat: SchoolCatalog, year: int) -> DataFrame:
    """Subjects, marked where the name stands for one code; a missing name never does."""
    code = F.coalesce("subject_code", F.lit("\u0000missing"))
    codes = F.collect_set(code).over(Window.partitionBy("subject"))
    one_code = F.col("subject").isNotNull() & (F.size(codes) == 1)
    return subjects(cat, year).withColumn("one_code", one_code)


def group_dim(cat: SchoolCatalog, year: int) -> DataFrame:
    """Teaching groups with subject and staff, no duplicates."""
    groups = cat.rows("teaching_groups", year).select(
        F.col("id").alias("group_id"), F.col("name").alias("class"), "subject_id"
    )
    group_teachers = cat.rows("teaching_groups_teachers", year).select("group_id", "teacher_ids")
    teachers = cat.rows("teachers", year).select(
        F.col("id").alias("teacher_ids"), F.col("code").alias("staff_code")
    )
    dim = left_join(groups, subjects(cat, year), ["subject_id"])
    dim = left_join(dim, group_teachers, ["group_id"])
    dim = left_join(dim, teachers, ["teacher_ids"])
    return dim.select("group_id", "class", "subject", "subject_code", "staff_code").distinct()


def group_members(cat: SchoolCatalog, year: int) -> DataFrame:
    return cat.rows("teaching_groups_students", year).select(
        "group_id", F.col("student_ids").alias("student_id")
    )


def class_membership(cat: SchoolCatalog, year: int) -> DataFrame:
    """Which pupil sits in which class, with whom, per subject code."""
    return (
        left_join_many(group_dim(cat, year), group_members(cat, year), ["group_id"])
        .select("class", "student_id", "subject_code", "staff_code")
        .distinct()
    )
