"""Session and lesson attendance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.functions.semantics import (
    all_text,
    fold_present,
    label_id,
    label_reg,
    paste,
)
from registrar.operators.joins import inner_join, left_join
from registrar.operators.reshape import list_text
from registrar.plans.common import edu_details, join_pupils, students
from registrar.sources.catalog import SchoolCatalog

SUMMARY_MEASURES = {
    "possible_sessions": "possible_session",
    "present": "present",
    "approved_educational_activity": "approved_ea",
    "late": "late",
    "authorised_absence": "authorised_absence",
    "unauthorised_absence": "unauthorised_absence",
    "attendance_not_required": "attendance_no_required",
    "missing_mark": "missing_mark",
}


def attendance_codes(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Mark id (as text) to code and label."""
    return (
        cat.rows("attendance_codes", academic_year)
        .select(F.col("id").cast("string").alias("mark_id"), F.col("code").alias("mark"), "label")
        .distinct()
    )


def _pupils(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Pupils on the roll with identity columns, distinct."""
    edu = edu_details(cat, academic_year, ["upn", "national_curriculum_year", "registration_group"])
    df = join_pupils(cat, students(cat, academic_year), edu)
    return df.select(
        "student_id",
        "upn",
        label_reg().alias("surname_forename_reg"),
        label_id(F.col("student_id")).alias("surname_forename_id"),
        F.col("preferred_last_name").alias("surname"),
        F.col("preferred_first_name").alias("forename"),
        F.col("national_curriculum_year").alias("year_group"),
        F.col("registration_group").alias("reg"),
        F.col("sex").alias("gender"),
    )


def _session_marks(
    cat: SchoolCatalog, academic_year: int, dates: tuple[str, str], session: str | None
) -> DataFrame:
    """Decoded marks under the date predicate, distinct while still narrow.

    Only dated marks of pupils on the roll survive, so pupils and marks meet
    in an inner join. The code table is joined first and the narrow rows are
    made distinct on all their columns, which spreads a hot pupil evenly; the
    join to the distinct pupils then cannot create duplicates.
    """
    marks = cat.rows("session_marks", academic_year, dates=dates).filter(F.col("date").isNotNull())
    if session is not None:
        marks = marks.filter(F.col("session") == session.upper())
    decoded = left_join(
        marks, attendance_codes(cat, academic_year), [("session_mark_id", "mark_id")]
    )
    return decoded.select(
        "student_id",
        "date",
        "session",
        F.col("mark").alias("session_mark"),
        F.col("label").alias("session_label"),
        F.col("session_minutes_late").alias("session_late_minutes"),
        "session_notes",
    ).distinct()


def attendance_session_range(
    cat: SchoolCatalog,
    academic_year: int,
    date_start: str,
    date_end: str,
    session: str | None = None,
) -> DataFrame:
    """Session marks over an inclusive range of dates, AM, PM or both."""
    marks = _session_marks(cat, academic_year, (date_start, date_end), session)
    df = inner_join(marks, _pupils(cat, academic_year), ["student_id"], cat.never_null("students"))
    return all_text(
        df.select(
            "upn", F.col("student_id").alias("gfsid"), "surname_forename_reg",
            "surname_forename_id", "surname", "forename", "year_group", "reg", "gender",
            "date", "session",
            # After the distinct: the two present marks stay two rows.
            fold_present(F.col("session_mark")).alias("session_mark"),
            "session_label", "session_late_minutes", "session_notes",
        )
    )


def attendance_session(
    cat: SchoolCatalog, academic_year: int, date: str, session: str | None = None
) -> DataFrame:
    """Session marks of one day."""
    return attendance_session_range(cat, academic_year, date, date, session)


def _class_stack(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Classes with period and teacher; a class without teachers is kept."""
    classes = cat.rows("classes", academic_year).select(
        F.col("id").alias("class_id"),
        "period_id",
        F.explode_outer("teacher_ids").alias("teacher_id"),
        list_text(F.col("rooms")).alias("room"),
        "year_group",
        F.col("subject_code").alias("subject"),
        F.col("group_code").alias("class"),
    )
    periods = cat.rows("periods", academic_year).select(
        "period_id", F.col("name").alias("lesson_id"), F.col("display_name").alias("lesson")
    )
    teachers = cat.rows("teachers", academic_year).select(
        F.col("id").alias("teacher_id"), "title", F.col("preferred_last_name").alias("last_name")
    )
    df = left_join(classes, periods, ["period_id"])
    df = left_join(df, teachers, ["teacher_id"])
    return df.drop("period_id", "teacher_id").distinct()


def _lesson_rows(cat: SchoolCatalog, academic_year: int, dates: tuple[str, str]) -> DataFrame:
    marks = cat.rows("lesson_marks", academic_year, dates=dates).filter(F.col("date").isNotNull())
    df = left_join(marks, attendance_codes(cat, academic_year), [("lesson_mark_id", "mark_id")])
    df = left_join(df, _class_stack(cat, academic_year), ["class_id"])
    narrow = df.select(
        "lesson_id", "lesson",
        # Built after the join: a mark without a class reads "NA NA".
        paste(F.col("title"), " ", F.col("last_name")).alias("teacher"),
        "room", "student_id", "year_group", "date", "subject", "class",
        F.col("mark").alias("lesson_mark"),
        F.col("label").alias("lesson_label"),
        F.col("lesson_minutes_late").alias("lesson_late_minutes"),
        "lesson_notes",
    ).distinct()
    pupils = _pupils(cat, academic_year).drop("year_group")
    # Two curriculum years of one pupil differ only in the column dropped here.
    df = inner_join(narrow, pupils.distinct(), ["student_id"], cat.never_null("students"))
    return all_text(
        df.select(
            "lesson_id", "lesson", "teacher", "room", "upn",
            F.col("student_id").alias("gfsid"), "surname_forename_reg", "surname_forename_id",
            "surname", "forename", "gender", "year_group", "reg", "date", "subject", "class",
            fold_present(F.col("lesson_mark")).alias("lesson_mark"),
            "lesson_label", "lesson_late_minutes", "lesson_notes",
        )
    )


def attendance_lesson(
    cat: SchoolCatalog, academic_year: int, date: str, ordered: bool = True
) -> DataFrame:
    """Lesson marks of one day, by lesson."""
    df = _lesson_rows(cat, academic_year, (date, date))
    return _sorted(df, "lesson") if ordered else df


def attendance_lesson_range(
    cat: SchoolCatalog, academic_year: int, date_start: str, date_end: str, ordered: bool = True
) -> DataFrame:
    """Lesson marks over an inclusive range, by date and lesson."""
    df = _lesson_rows(cat, academic_year, (date_start, date_end))
    return _sorted(df, "date", "lesson", "lesson_id") if ordered else df


def _sorted(df: DataFrame, *columns: str) -> DataFrame:
    """Sort with tie-breaks: lessons are few, and equal sort keys share a task."""
    ties = ["gfsid", "class", "teacher", "room", "lesson_mark", "lesson_notes"]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in (*columns, *ties)])


def attendance_summary(cat: SchoolCatalog, academic_year: int) -> DataFrame:
    """Attendance totals per pupil; a pupil without totals is kept."""
    totals = (
        cat.rows("attendance_summary", academic_year)
        .select("student_id", *[F.col(c).alias(f"total_{n}") for c, n in SUMMARY_MEASURES.items()])
        .distinct()
    )
    df = left_join(_pupils(cat, academic_year), totals, ["student_id"], cat.never_null("students"))
    return all_text(
        df.select(
            "upn", F.col("student_id").alias("gfsid"), "surname_forename_reg",
            "surname_forename_id", "surname", "forename", "gender", "year_group", "reg",
            *[F.col(f"total_{n}").alias(n) for n in SUMMARY_MEASURES.values()],
        )
    )


# Which mark codes count towards which measure. Schools may pass their own.
DEFAULT_CATEGORIES = {
    "present": ["/", "L"],
    "approved_educational_activity": ["B", "P", "V", "W"],
    "late": ["L"],
    "authorised_absence": ["C", "E", "H", "I", "M", "R", "S", "T"],
    "unauthorised_absence": ["G", "N", "O", "U"],
    "attendance_not_required": ["X", "Y", "Z", "#"],
}


def attendance_totals(
    cat: SchoolCatalog,
    academic_year: int,
    categories: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Totals per pupil from the session marks: the shape of the summary table.

    Counted with partial aggregation, so a hot pupil shrinks before it moves.
    """
    categories = categories or DEFAULT_CATEGORIES
    marks = cat.rows("session_marks", academic_year).filter(F.col("date").isNotNull())
    decoded = left_join(
        marks, attendance_codes(cat, academic_year), [("session_mark_id", "mark_id")]
    )

    def counted(condition: Column, name: str) -> Column:
        return F.count_if(condition).cast("int").alias(name)

    return decoded.groupBy("student_id").agg(
        F.count("*").cast("int").alias("possible_sessions"),
        *[
            counted(fold_present(F.col("mark")).isin(codes), name)
            for name, codes in categories.items()
        ],
        counted(F.col("mark").isNull(), "missing_mark"),
    )
