"""A school small enough to work out by hand."""

import datetime as dt

from registrar.sources.catalog import SchoolCatalog
from registrar.sources.schemas import SOURCES

YEAR = 2023
D = dt.date

ROWS = {
    "school": [("Test School", [2022, 2023, 2024], 2023)],
    "students": [
        ("1", "Ames", "Ann", "F"),
        ("2", "Bell", None, "M"),
        ("3", "NA", "Cy", "M"),
        ("4", None, "Di", "F"),
    ],
    "student_edu_details": [
        ("1", "U1", "7", "7", "7A"),
        ("2", "U2", "12", "12", None),
        ("3", None, "8", "8", "8B"),
    ],
    "student_general": [
        ("1", "UCI", "C1", True),
        ("1", "HML Band", "High", False),
        ("1", "4. SEN Notes", "Extra Time", False),
        ("2", "1. Reading Age", "9", False),
        ("3", "HML Band", "Low", False),
        ("3", "HML Band", "High", False),
    ],
    "student_sensitive": [
        ("1", "Ethnicity", "White - English"),
        ("1", "Pupil Premium Indicator", "True"),
        ("2", "Ethnicity", "Welsh"),
        ("3", "Ethnicity", "Other"),
        ("3", "EAL", "True"),
    ],
    "teaching_subjects": [
        ("s1", "Maths", "Ma", "7", "d1", "GCSE Maths"),
        ("s2", "Combined Science 9-1", "Sc", "7", "d1", "GCSE Science"),
        ("s3", "Lessons", None, "8", None, None),
        ("s4", "Admin", "Ac", "8", None, None),
    ],
    "departments": [("d1", "Numbers")],
    "teaching_groups": [
        ("g1", "7Ma1", "s1", "x"),
        ("g2", "7Sc1", "s2", "x"),
        ("g3", "8Xx1", "s3", "x"),
        ("g4", "Empty", "s1", "x"),
        ("g5", "8Ac1", "s4", "x"),
    ],
    "teaching_groups_students": [
        ("g1", "1"), ("g1", "1"), ("g1", "2"), ("g2", "1"), ("g3", "3"), ("g5", "3"),
    ],
    "teaching_groups_teachers": [("g1", "t1"), ("g1", "t2"), ("g2", "t1"), ("g3", "t9")],
    "teachers": [("t1", "T1", "Mr", "One", "A"), ("t2", "T2", None, "Two", "B")],
    "attainment_grade_types": [("1", "Target", "7"), ("2", "Mock", "7"), ("1", "Target", "8")],
    "attainment_grades": [
        ("1", "s1", "1", "6", "7"),
        ("1", "s2", "1", "6/5", "7"),
        ("1", "s2", "2", "4/4", "7"),
        ("3", "s3", "1", "B", "8"),
        ("9", "s1", "2", "A", "7"),
    ],
    "exam_results": [
        ("1", "s1", "GCSE (9-1)", "7", "11"),
        ("3", "s3", "BTEC Level 2", "P", "11"),
        ("1", "s2", None, "U", "11"),
    ],
    "markbooks": [
        ("s1", "Book", "c1", "Strand"),
        ("s9", "Orphan", "c2", "Strand"),
    ],
    "marks": [
        ("c1", "1", "12", "A", "20"),
        ("c1", "1", "12", "A", "20"),
        ("c2", "1", "3", "C", "20"),
        ("c9", "1", "5", "D", "20"),
    ],
    "attendance_codes": [(1, "/", "Present"), (2, "\\", "Present"), (3, "E", "Excluded"), (4, "L", "Late")],
    "session_marks": [
        ("1", "1", D(2024, 1, 1), "AM", None, None),
        ("1", "2", D(2024, 1, 1), "AM", None, None),
        ("1", "2", D(2024, 1, 1), "AM", None, None),
        ("1", "3", D(2024, 1, 2), "PM", None, "x"),
        ("1", "3", D(2024, 1, 2), "AM", None, "x"),
        ("2", "3", D(2024, 1, 3), "AM", 4, None),
        ("2", "3", None, "AM", 4, None),
        ("3", "9", D(2024, 1, 3), "AM", None, None),
        ("9", "1", D(2024, 1, 1), "AM", None, None),
    ],
    "lesson_marks": [
        ("1", "k1", "1", D(2024, 1, 1), None, None),
        ("1", "k1", "2", D(2024, 1, 1), None, None),
        ("2", "k9", "4", D(2024, 1, 2), 3, "n"),
        ("2", "k2", "4", None, 3, "n"),
    ],
    "attendance_summary": [("1", 10, 8, 0, 1, 1, 0, 0, 0)],
    "calendar": [
        (D(2024, 1, 1), 1, "OPEN", "tt"),
        (D(2024, 1, 2), 1, "OPEN", "tt"),
        (D(2024, 1, 15), 1, "OPEN", "tt"),
        (D(2024, 1, 29), 1, "OPEN", "tt"),
        (D(2024, 1, 6), 1, "CLOSED", "tt"),
    ],
    "periods": [
        ("p1", "RMon:1", "P1", "Monday", 1, "9:00", "10:00"),
        ("p2", "RTue:1", "P1", "Tuesday", 1, "9:00", "10:00"),
        ("p3", "RMon:9", "P9", "Monday", 1, "16:00", "17:00"),
        ("p4", "BSat:1", "P1", "Saturday", 2, "9:00", "10:00"),
    ],
    "classes": [
        ("k1", "p1", ["t1", "t2"], ["R1", "R2"], "7", "Ma", "7Ma1"),
        ("k2", "p1", ["t1"], [], "7", "Sc", "7Sc1"),
        ("k0", "p1", ["t1"], None, "7", "Sc", "7Sc1"),
        ("k3", "p2", [], None, "8", "Ap", "8HRB1"),
        ("k4", "p3", None, ['c("L"\\)'], "12", "Ma", "7Ma1"),
        ("k5", "p1", ["t1"], ["R9"], "7", "Ma", None),
    ],
    "student_classes": [
        ("k1", "1", D(2023, 9, 1), None),
        ("k2", "1", D(2023, 9, 1), D(2024, 8, 1)),
        ("k0", "1", D(2023, 9, 1), None),
        ("k3", "3", D(2023, 9, 1), None),
        ("k3", "4", None, None),
        ("k4", "2", D(2023, 9, 1), None),
        ("k1", "2", D(2023, 9, 1), D(2023, 12, 1)),
    ],
    "behaviour_events": [
        ("e1", "y1", "a1", "f1", "1", "u1", "Ma", None, D(2024, 1, 1), "2024-01-01 09:00:00", "NA", "hi"),
        ("e1", "y1", "a1", "f2", "1", "u1", "Ma", None, D(2024, 1, 1), "2024-01-01 09:00:00", "NA", "hi"),
        ("e1", "y1", "a2", "f1", "1", "u1", "Ma", None, D(2024, 1, 1), "2024-01-01 09:00:00", "NA", "hi"),
        ("e2", "y1", None, None, "3", "u9", None, "Own", D(2024, 1, 2), "t", "R1", None),
        ("e3", "y2", None, None, "3", "u1", None, None, D(2024, 1, 2), "t", "R1", None),
        ("e4", "y1", "a1", None, "3", "u1", "Ac", None, D(2024, 1, 6), "t", "R1", None),
        ("e5", "y1", None, "f1", None, "u1", "Ma", None, D(2024, 1, 9), "t", "R1", None),
    ],
    "behaviour_immediate": [("a1", "Warn", "v"), ("a2", "Call", "h")],
    "behaviour_followup": [("f1", "Letter", "h"), ("f2", "Meet", "h")],
    "behaviour_event_types": [
        ("y1", "Rude", "R", "Negative", -1, "c1"),
        ("y2", "Kind", "K", "Positive", 1, None),
    ],
    "behaviour_classification": [("c1", "Lunch DETENTION")],
    "staff": [("u1", "User One", "User.One@School.EXAMPLE")],
    "documents": [("d1", "The cat sat. The dog ran!"), ("d2", ""), ("d3", "Hmm")],
}


def catalog(spark, **changes):
    """The school, with some tables replaced."""
    rows = ROWS | changes
    tables = {n: spark.createDataFrame(r, SOURCES[n]) for n, r in rows.items()}
    past = spark.createDataFrame([(2022, "7"), (2022, "8")], "academic_year int, id string")
    students = tables["students"].selectExpr(f"{YEAR} AS academic_year", "*")
    tables["students"] = students.unionByName(past, allowMissingColumns=True)
    return SchoolCatalog(spark, tables=tables)


def dicts(df):
    return [r.asDict() for r in df.collect()]
