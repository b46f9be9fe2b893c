"""The products as named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.plans import (
    attainment,
    attendance,
    behaviour,
    classlists,
    readability,
    school,
    students,
    timetable,
)
from registrar.sources.catalog import SchoolCatalog
from registrar.sources.derived import BASE_TABLES, DUCKDB, YEAR, DerivedSchool, derived_sql

Query = Callable[[SparkSession, str], DataFrame]

# The event table spans January 2024; the range covers all of it.
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-31"
RANGE = (FIRST_DAY, LAST_DAY)
ONE_DAY = "2024-01-15"


def _without_values(cat: DerivedSchool) -> SchoolCatalog:
    """The school with an attribute table of which no value is filled in."""
    general = cat.rows("student_general", YEAR).withColumn("value", F.lit(""))
    pupils = cat.rows("student_edu_details", YEAR)
    return SchoolCatalog(cat.spark, tables={"student_general": general, "student_edu_details": pupils})


PRODUCTS: dict[str, Callable[[DerivedSchool], DataFrame]] = {
    "school_years": school.school_years,
    "school_population": school.school_population,
    "student_details": lambda c: students.student_details(c, YEAR),
    "send_search": lambda c: students.send_search(c, YEAR, "extra time"),
    "student_raw_kv": lambda c: students.student_raw_attributes(c, YEAR),
    "student_raw_empty_values": lambda c: students.student_raw_attributes(_without_values(c), YEAR),
    "exam_results": lambda c: attainment.exam_results(c, YEAR, "11"),
    "exam_results_typed": lambda c: attainment.exam_results(c, YEAR, "11", ["gcse", "btec"]),
    "attainment": lambda c: attainment.attainment(c, YEAR, "10"),
    "attainment_multiple": lambda c: attainment.attainment_multiple(c, YEAR, "7", "11"),
    "targets_all": lambda c: attainment.targets(c, YEAR),
    "targets_subject": lambda c: attainment.targets(c, YEAR, "Subject 8"),
    "targets_double_grade": lambda c: attainment.targets(c, YEAR, "Combined Science 9-1"),
    "markbook_attainment": lambda c: attainment.markbook_attainment(c, YEAR),
    "attendance_session": lambda c: attendance.attendance_session(c, YEAR, ONE_DAY, "am"),
    "attendance_session_both": lambda c: attendance.attendance_session(c, YEAR, ONE_DAY),
    "attendance_session_range_am": lambda c: attendance.attendance_session_range(
        c, YEAR, *RANGE, session="am"
    ),
    "attendance_session_range": lambda c: attendance.attendance_session_range(c, YEAR, *RANGE),
    "attendance_lesson": lambda c: attendance.attendance_lesson(c, YEAR, ONE_DAY),
    "attendance_lesson_range": lambda c: attendance.attendance_lesson_range(c, YEAR, *RANGE),
    "attendance_summary": lambda c: attendance.attendance_summary(c, YEAR),
    "attendance_totals": lambda c: attendance.attendance_totals(c, YEAR),
    "behaviour_events": lambda c: behaviour.behaviour_events_range(c, YEAR, *RANGE),
    "exclusions": lambda c: behaviour.exclusions(c, YEAR, *RANGE),
    "exclusions_cumulative": lambda c: behaviour.exclusions_cumulative(c, YEAR, *RANGE),
    "detentions": lambda c: behaviour.detentions(c, YEAR, *RANGE),
    "detentions_cumulative": lambda c: behaviour.detentions_cumulative(c, YEAR, *RANGE),
    "class_list_student": lambda c: classlists.class_list_student(c, YEAR, "nation_1|NA building"),
    "class_list_teacher": lambda c: classlists.class_list_teacher(c, YEAR),
    "class_list_teacher_staff": lambda c: classlists.class_list_teacher(c, YEAR, ["T3", "T7"]),
    "timetable": lambda c: timetable.timetable(c, YEAR),
    "readability": lambda c: readability.readability(c.rows("documents")),
    "readability_full": lambda c: readability.readability(c.rows("documents"), True),
    "readability_corpus_means": lambda c: readability.corpus_means(
        c.load("documents"), ["lang", "source"]
    ),
}


def _query(build: Callable[[DerivedSchool], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(DerivedSchool(spark, sf_dir))


def spark_queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in PRODUCTS.items()}


def sql_twins(folder: Path | None = None) -> dict[str, str]:
    """One self-contained statement per query.

    ``oracle/<query>.sql`` reads ``src_<table>`` and other queries by name;
    what it reads, directly or not, is put in front of it as WITH parts.
    """
    import re

    folder = folder or Path(__file__).resolve().parents[2] / "oracle"
    bodies = {p.stem: p.read_text().strip().rstrip(";") for p in sorted(folder.glob("*.sql"))}
    inputs = {t: t for t in BASE_TABLES}
    parts = {f"src_{n}": s.format(**inputs) for n, s in derived_sql(DUCKDB).items()} | bodies
    word = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)", re.IGNORECASE)

    def needs(name: str, done: list[str]) -> list[str]:
        for used in word.findall(parts[name]):
            if used in parts and used != name and used not in done:
                needs(used, done)
                done.append(used)
        return done

    statements = {}
    for name in PRODUCTS:
        if name in bodies:
            with_parts = ",\n".join(f"{n} AS (\n{parts[n]}\n)" for n in needs(name, []))
            statements[name] = f"WITH {with_parts}\nSELECT * FROM (\n{bodies[name]}\n) AS result"
    return statements
