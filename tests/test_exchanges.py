"""Large rows move as seldom as they can: what the plans shuffle, and that the results stay whole."""

import re

import pytest
from school import D, YEAR, catalog, dicts

from registrar.plans import attainment, classlists, timetable
from registrar.sources.derived import DerivedSchool


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def first_path(df, until):
    """Operators from the result down the left sides to the first line that matches."""
    path = []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        path.append(line.strip(" :+-"))
        if re.search(until, line):
            return path
    raise AssertionError(f"no {until} in the plan")


def exchanges(path):
    return [line for line in path if line.startswith("Exchange")]


def test_rows_with_marks_do_not_move(spark, no_broadcast):
    """the rows that marks multiply are made in their last stage."""
    df = attainment.markbook_attainment(catalog(spark), YEAR)
    assert exchanges(first_path(df, r"SortMergeJoin.*arrays_overlap\(class_subjects")) == []


def test_one_mark_of_two_subjects_of_a_class_is_one_row(spark):
    groups = [("g1", "7Ma1", "s1", "x"), ("g2", "7Ma1", "s2", "x"), ("g3", "7Xx1", "s4", "x"), ("g4", "7Nn1", None, "x")]
    members = [("g1", "1"), ("g2", "1"), ("g3", "1"), ("g4", "2"), ("g4", None)]
    books = [("s1", "Book", "c1", "Strand"), ("s2", "Book", "c2", "Strand"), ("s2", "Other", "c3", "Strand")]
    marks = [("c1", "1", "12", "A", "20"), ("c2", "1", "12", "A", "20"), ("c3", "1", "9", "B", "20"),
             ("c9", "2", "4", "C", "20"), ("c9", None, "6", "D", "20")]
    cat = catalog(spark, teaching_groups=groups, teaching_groups_students=members, markbooks=books, marks=marks)
    rows = {(r["class"], r["subject"], r["gfsid"], r["staff_code"], r["markbook"], r["mark"])
            for r in dicts(attainment.markbook_attainment(cat, YEAR))}
    both = [("7Ma1", "Combined Science 9-1", "1", "T1"), ("7Ma1", "Maths", "1", "T1"), ("7Ma1", "Maths", "1", "T2")]
    expected = {(*place, *mark) for place in both for mark in (("Book", "12"), ("Other", "9"))}
    # A mark without a column has no subject, and neither has the last group.
    expected |= {("7Xx1", "Admin", "1", None, None, None), ("7Nn1", None, "2", None, None, "4"),
                 ("7Nn1", None, None, None, None, "6")}
    got = dicts(attainment.markbook_attainment(cat, YEAR))
    assert len(got) == len(rows)
    assert {r for r in rows if r[3] != "T9"} == expected


def test_target_rows_move_for_their_order_only(spark, no_broadcast):
    """places, targets and pupils are distinct, so the wide rows are not made distinct again."""
    path = first_path(attainment.targets(catalog(spark), YEAR), "Generate explode")
    assert [e for e in exchanges(path) if "rangepartitioning" not in e] == []
    assert len(exchanges(path)) == 1
    assert [line for line in path if "Aggregate" in line] == []


def test_target_rows_of_a_pupil_held_twice(spark):
    """Pupil rows that differ in columns outside the result are one row."""
    details = [("1", "U1", "7", "7", "7A"), ("1", "U1", "8", "7", "7A"), ("1", "U1", "7", "9", "7A")]
    people = [("1", "Ames", "Ann", "F"), ("1", "Ames", "Ann", "F")]
    cat = catalog(spark, student_edu_details=details, students=people)
    got = [(r["class"], r["staff_code"], r["year_group"], r["ac_year"], r["target"], r["surname_forename_id"], r["wbr_pp"])
           for r in dicts(attainment.targets(cat, YEAR)) if r["gfsid"] == "1"]
    expected = [
        (name, staff, year, leaving, target, "AMES Ann (1)", "True")
        for year, leaving in (("7", "c2027"), ("9", "c2025"))
        for name, staff, target in (("7Ma1", "T1", "6"), ("7Ma1", "T2", "6"), ("7Sc1", "T1", "6/5"))
    ]
    assert got == expected


def test_graded_rows_move_once(spark, no_broadcast):
    """classes and pupil columns are joined where the grades are; their rows are not moved to be made distinct."""
    path = first_path(attainment.attainment_multiple(catalog(spark), YEAR), r"SortMergeJoin.*class_code")
    assert exchanges(path) == []
    results = attainment.exam_results(catalog(spark), YEAR, "11")
    assert exchanges(first_path(results, r"SortMergeJoin.*class_code")) == []


def test_grades_of_a_subject_name_with_two_codes(spark):
    subjects = [("s1", "Maths", "Ma", "7", "d1", "x"), ("s2", "Maths", "Mb", "7", "d1", "x"), ("s3", None, "Mc", "7", "d1", "x")]
    groups = [("g1", "7Ma1", "s1", "x"), ("g2", "7Ma1", "s2", "x"), ("g3", "8Ma1", "s1", "x"), ("g4", "8Xx1", "s3", "x")]
    members = [("g1", "1"), ("g2", "1"), ("g3", "2"), ("g4", "1"), ("g4", None)]
    teachers = [("g1", "t1"), ("g2", "t1"), ("g3", "t1"), ("g4", "t2")]
    grades = [("1", "s1", "1", "6", "7"), ("1", "s1", "1", "6", "7"), ("1", "s2", "1", "6", "7"), ("2", "s1", "1", "5", "7"),
              ("2", "s2", "1", "5", "7"), ("1", "s3", "1", "4", "7"), ("1", "s9", "1", "4", "7"), (None, "s3", "1", "3", "7")]
    cat = catalog(spark, teaching_subjects=subjects, teaching_groups=groups, teaching_groups_students=members,
                  teaching_groups_teachers=teachers, attainment_grades=grades)
    rows = [(r["gfsid"], r["subject"], r["class"], r["staff_code"], r["grade"])
            for r in dicts(attainment.attainment_multiple(cat, YEAR))]
    expected = [
        ("1", "Maths", "7Ma1", "T1", "6"),  # both codes lead to one class
        ("2", "Maths", "8Ma1", "T1", "5"), ("2", "Maths", None, None, "5"),  # no class of the second code
        ("1", None, "8Xx1", "T2", "4"), ("1", None, None, None, "4"), (None, None, "8Xx1", "T2", "3"),
    ]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_places_move_once_after_they_are_distinct(spark, no_broadcast):
    """targets and pupil columns meet the places by pupil, so one task sorts them once."""
    path = first_path(classlists.class_list_teacher(catalog(spark), YEAR), r"Aggregate\(keys=\[staff_code")
    assert len(exchanges(path)) == 1


def test_grades_of_other_types_are_left_at_the_scan(spark, sf_dir):
    """one grade in seven is a target; the others are not joined to orders, parts and subjects."""
    plan = classlists.target_lists(DerivedSchool(spark, sf_dir), YEAR, ["7"])._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = {name: min(len(re.match(r"[ :+-]*", l).group()) for l in lines if name in l) for name in ("LeftSemi", "Join Inner, (l_orderkey")}
    assert depth["LeftSemi"] > depth["Join Inner, (l_orderkey"]


def test_timetable_rows_move_to_their_pupil_once(spark, sf_dir, no_broadcast):
    """rows are made distinct and meet the details where they have been put by pupil; only the periods are broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    path = first_path(timetable.timetable(DerivedSchool(spark, sf_dir), YEAR), r"REPARTITION_BY_COL")
    assert len(exchanges(path)) == 1
    assert [line for line in path if "Aggregate" in line] != []


def test_timetable_rows_that_look_alike_are_one(spark):
    """Two classes that differ in their id alone, an enrolment held twice, and a pupil known under two UPNs."""
    start, none = D(2023, 9, 1), None
    classes = [("k1", "p1", ["t1"], ["R1"], "7", "Ma", "7Ma1"), ("k2", "p1", ["t1"], ["R1"], "7", "Ma", "7Ma1"),
               ("k3", "p2", ["t1", "t2"], none, "7", "Ma", "7Ma1")]
    enrolled = [("k1", "1", start, none), ("k1", "1", start, none), ("k2", "1", start, none), ("k3", "1", start, none),
                ("k3", "2", start, none), ("k3", "2", start, D(2024, 9, 1))]
    details = [("1", "U1", "7", "7", "7A"), ("1", "V1", "7", "7", "7A"), ("2", "U2", "7", "7", "7B")]
    cat = catalog(spark, classes=classes, student_classes=enrolled, student_edu_details=details)
    got = [(r["lesson_id"], r["staff_code"], r["upn"], r["gfsid"], r["room"], r["reg"], r["lesson_start"])
           for r in dicts(timetable.timetable(cat, YEAR))]
    expected = [("RMon:1", "T1", upn, "1", "R1", "7A", "9:00") for upn in ("U1", "V1")]
    expected += [("RTue:1", staff, upn, pupil, None, reg, "9:00") for staff in ("T1", "T2")
                 for upn, pupil, reg in (("U1", "1", "7A"), ("V1", "1", "7A"), ("U2", "2", "7B"))]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
