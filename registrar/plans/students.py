"""Pupil profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.functions.semantics import (
    PUPIL_DEFAULTS,
    all_text,
    impute,
    label_id,
    label_reg,
    matches,
    white_british_pp,
)
from registrar.operators.joins import left_join_many
from registrar.operators.reshape import non_empty_columns
from registrar.plans.common import (
    GENERAL_FULL,
    SENSITIVE_FULL,
    attributes,
    edu_details,
    join_pupils,
    students,
)
from registrar.sources.catalog import SchoolCatalog

DETAIL_COLUMNS = [
    "year_group", "upn", "gfsid", "surname_forename_reg", "surname_forename_id", "surname",
    "forename", "reg", "gender", "ethnicity", "eal", "fsm", "fsm6", "pp", "wbr_pp", "hml_band",
    "ad_no", "uci", "sen", "sen_notes", "keyworker", "lac", "date_admission",
]
SEARCH_COLUMNS = [
    "year_group", "upn", "gfsid", "surname_forename_reg", "surname_forename_id", "gender", "eal",
    "fsm", "fsm6", "pp", "wbr_pp", "hml_band", "uci", "sen", "sen_notes", "keyworker", "lac",
]


def student_details(cat: SchoolCatalog, academic_year: int, duplicates: str = "min") -> DataFrame:
    """One row per pupil: identity, demographics, support and attributes.

    Each input is distinct and every input column is kept in the result, so
    the joined rows are distinct without another shuffle.
    """
    df = join_pupils(
        cat,
        students(cat, academic_year),
        edu_details(
            cat, academic_year, ["upn", "national_curriculum_year", "registration_group"]
        ),
    )
    wide = attributes(cat, academic_year, GENERAL_FULL, SENSITIVE_FULL, duplicates)
    df = join_pupils(cat, df, wide)
    df = df.select(
        F.col("national_curriculum_year").alias("year_group"),
        "upn",
        F.col("student_id").alias("gfsid"),
        label_reg().alias("surname_forename_reg"),
        label_id(F.col("student_id")).alias("surname_forename_id"),
        F.col("preferred_last_name").alias("surname"),
        F.col("preferred_first_name").alias("forename"),
        F.col("registration_group").alias("reg"),
        F.col("sex").alias("gender"),
        "ethnicity", "eal", "fsm", "fsm6", "pp",
        white_british_pp(F.col("ethnicity"), F.col("pp")).alias("wbr_pp"),
        "hml_band", "ad_no", "uci", "sen", "sen_notes", "keyworker", "lac", "date_admission",
    )
    return impute(all_text(df), PUPIL_DEFAULTS)


def send_search(
    cat: SchoolCatalog, academic_year: int, notes_search: str, ordered: bool = True
) -> DataFrame:
    """Pupils whose support notes match a pattern, youngest year group first."""
    df = student_details(cat, academic_year)
    df = df.filter(matches(F.col("sen_notes"), notes_search)).select(*SEARCH_COLUMNS)
    if ordered:
        # Year groups are few and equal sort keys share a task, so ties are broken.
        df = df.orderBy(
            F.col("year_group").try_cast("double").asc_nulls_last(), F.col("gfsid").asc_nulls_last()
        )
    return df


def student_raw_attributes(
    cat: SchoolCatalog, academic_year: int, columns: list[str] | None = None
) -> DataFrame:
    """Every stored attribute of every pupil as key and value.

    Attribute-table columns that hold nothing at all are dropped first, so a
    table without a single value gives a result without that column. That
    test reads the year's two columns once while the plan is built;
    ``columns`` names the ones to keep and skips it.
    """
    general = cat.rows("student_general", academic_year)
    kept = columns or non_empty_columns(general, ["name", "value"])
    renamed = {"name": "key", "value": "value"}
    pupils = cat.rows("student_edu_details", academic_year).select("student_id", "upn")
    df = left_join_many(pupils, general.select("student_id", *kept), ["student_id"])
    return df.select(
        "upn",
        F.col("student_id").alias("gfsid"),
        *[F.col(c).alias(renamed[c]) for c in kept],
    )
