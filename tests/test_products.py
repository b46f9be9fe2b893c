"""Every product on a school worked out by hand."""

import datetime as dt

import pytest

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
from school import YEAR, catalog, dicts


@pytest.fixture(scope="module")
def cat(spark):
    return catalog(spark)


def pick(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_school_years_and_population(cat):
    assert pick(school.school_years(cat), "name", "academic_year", "current_academic_year") == [
        ("Test School", y, 2023) for y in (2022, 2023, 2024)
    ]
    assert pick(school.school_population(cat), "academic_year", "n") == [(2022, 2), (2023, 4), (2024, 0)]


def test_student_details(cat):
    df = students.student_details(cat, YEAR)
    assert df.columns == students.DETAIL_COLUMNS
    rows = {r["gfsid"]: r for r in dicts(df)}
    assert set(rows) == {"1", "2", "3", "4"}
    one = rows["1"]
    assert one["surname_forename_reg"] == "AMES Ann (7A)"
    assert one["surname_forename_id"] == "AMES Ann (1)"
    assert (one["wbr_pp"], one["hml_band"], one["eal"]) == ("True", "High", "False")
    # White British, premium unknown: the flag is unknown.
    assert rows["2"]["wbr_pp"] is None
    assert rows["2"]["surname_forename_reg"] == "BELL NA (NA)"
    assert rows["2"]["hml_band"] == "Unknown.HML"
    assert rows["3"]["hml_band"] == "High"  # least of High and Low
    assert (rows["3"]["eal"], rows["3"]["wbr_pp"]) == ("True", "False")
    assert rows["4"]["surname_forename_id"] == "NA Di (4)"
    assert rows["4"]["ethnicity"] == "Unknown.Ethnicity"


def test_student_details_with_listed_duplicates(cat):
    rows = {r["gfsid"]: r for r in dicts(students.student_details(cat, YEAR, duplicates="list"))}
    assert rows["3"]["hml_band"] == "High, Low"
    assert (rows["1"]["hml_band"], rows["1"]["wbr_pp"]) == ("High", "True")
    assert rows["2"]["hml_band"] == "Unknown.HML"
    with pytest.raises(Exception, match="more than one value of hml_band"):
        students.student_details(cat, YEAR, duplicates="error").collect()


def test_send_search(cat):
    df = students.send_search(cat, YEAR, "EXTRA")
    assert df.columns == students.SEARCH_COLUMNS
    assert pick(df, "gfsid", "sen_notes") == [("1", "Extra Time")]


def test_raw_attributes(cat, spark):
    df = students.student_raw_attributes(cat, YEAR)
    assert df.columns == ["upn", "gfsid", "key", "value"]
    assert df.count() == 6
    empty = catalog(spark, student_general=[("1", "UCI", "", True), ("2", "UCI", "", True)])
    df = students.student_raw_attributes(empty, YEAR)
    assert pick(df, "gfsid", "key") == [("1", "UCI"), ("2", "UCI"), ("3", None)]
    assert "value" not in df.columns


def test_exam_results(cat):
    df = attainment.exam_results(cat, YEAR, "11")
    got = pick(df, "gfsid", "subject", "class", "staff_code", "grade", "year_group", "pp", "hml_band")
    assert got == [
        ("1", "Combined Science 9-1", "7Sc1", "T1", "U", "7", "True", "High"),
        ("1", "Maths", "7Ma1", "T1", "7", "7", "True", "High"),
        ("1", "Maths", "7Ma1", "T2", "7", "7", "True", "High"),
        # A subject without code meets the class of a subject without code.
        ("3", "Lessons", "8Xx1", None, "P", "8", None, "High"),
    ]
    assert {r["grade_type"] for r in dicts(df)} == {"External examination"}
    typed = attainment.exam_results(cat, YEAR, "11", ["gcse", "btec"])
    assert pick(typed, "gfsid", "qualification_title")[0] == ("1", "GCSE (9-1)")
    assert typed.count() == 3
    assert attainment.exam_results(cat, YEAR, "11", "btec").count() == 1
    assert attainment.exam_results(cat, YEAR, "10").count() == 0


def test_attainment(cat):
    df = attainment.attainment(cat, YEAR, "7")
    got = pick(df, "gfsid", "subject", "class", "staff_code", "grade_type", "grade")
    assert got == [
        ("1", "Combined Science 9-1", "7Sc1", "T1", "Mock", "4/4"),
        ("1", "Combined Science 9-1", "7Sc1", "T1", "Target", "6/5"),
        ("1", "Maths", "7Ma1", "T1", "Target", "6"),
        ("1", "Maths", "7Ma1", "T2", "Target", "6"),
        ("9", "Maths", None, None, "Mock", "A"),
    ]
    unknown = [r for r in dicts(df) if r["gfsid"] == "9"][0]
    assert unknown["surname_forename_reg"] == "NA NA (NA)"
    assert unknown["surname_forename_id"] == "NA NA (9)"
    assert attainment.attainment_multiple(cat, YEAR).count() == 6
    assert attainment.attainment_multiple(cat, YEAR, "8", "9").count() == 1


def test_class_list_teacher(cat):
    df = classlists.class_list_teacher(cat, YEAR)
    assert df.columns == classlists.TEACHER_COLUMNS
    got = pick(df, "class", "staff_code", "gfsid", "target")
    assert got == [
        ("7Ma1", "T1", "1", "6"), ("7Ma1", "T1", "2", None),
        ("7Ma1", "T2", "1", "6"), ("7Ma1", "T2", "2", None),
        ("7Sc1", "T1", "1", "6/5"), ("8Ac1", None, "3", None), ("8Xx1", None, "3", "B"),
        ("Empty", None, None, None),
    ]
    empty = [r for r in dicts(df) if r["class"] == "Empty"][0]
    assert empty["surname_forename_reg"] == "NA NA (NA)"
    assert (empty["wbr_pp"], empty["hml_band"], empty["eal"]) == ("False", "Unknown.HML", "False")
    assert pick(classlists.class_list_teacher(cat, YEAR, "T2"), "gfsid") == [("1",), ("2",)]
    assert classlists.class_list_teacher(cat, YEAR, ["t2"]).count() == 0  # case-sensitive
    early = classlists.class_list_teacher(cat, YEAR, year_group_from="7", year_group_to="7")
    assert ("8Xx1", None) in pick(early, "class", "target")


def test_class_list_student(cat):
    df = classlists.class_list_student(cat, YEAR, "ames|cy")
    assert df.columns == classlists.STUDENT_COLUMNS
    assert {r["gfsid"] for r in dicts(df)} == {"1", "3"}
    # A group without pupils carries the nameless label, which a pattern may match.
    nameless = classlists.class_list_student(cat, YEAR, r"^na na \(na\)$")
    assert pick(nameless, "class", "gfsid") == [("Empty", None)]


def test_targets(cat):
    df = attainment.targets(cat, YEAR)
    assert df.columns == attainment.TARGET_COLUMNS
    rows = dicts(df)
    assert [r["year_group"] for r in rows] == ["7", "7", "7", "8", "8", None, None, None]
    cohort = {r["gfsid"]: r["ac_year"] for r in rows}
    assert cohort == {"1": "c2027", "2": None, "3": "c2026", None: None}
    double = attainment.targets(cat, YEAR, "Combined Science 9-1")
    assert pick(double, "gfsid", "target") == [("1", "5.5")]
    plain = attainment.targets(cat, YEAR, "Maths")
    assert {r["target"] for r in dicts(plain)} == {"6", None}


def test_markbook_attainment(cat, spark):
    df = attainment.markbook_attainment(cat, YEAR)
    got = pick(df, "class", "staff_code", "gfsid", "markbook", "mark", "max", "grade")
    assert ("7Ma1", "T1", "1", "Book", "12", "20", "A") in got
    assert ("7Ma1", "T2", "1", "Book", "12", "20", "A") in got
    # Every class list row stays; marks of subjects without a group go nowhere.
    assert len(got) == 8
    # ... unless a class has no name either: then missing meets missing.
    groups = [(None if r[0] == "g1" else r[1], r) for r in _groups()]
    odd = catalog(spark, teaching_groups=[(r[0], n, r[2], r[3]) for n, r in groups])
    got = pick(attainment.markbook_attainment(odd, YEAR), "class", "staff_code", "gfsid", "mark")
    nameless = [g for g in got if g[0] is None and g[2] == "1"]
    assert sorted({g[3] for g in nameless}) == ["12", "3", "5"]


def _groups():
    from school import ROWS

    return ROWS["teaching_groups"]


def test_session_marks(cat):
    df = attendance.attendance_session_range(cat, YEAR, "2024-01-01", "2024-01-03")
    got = pick(df, "gfsid", "date", "session", "session_mark", "session_late_minutes")
    assert got == [
        # The slash and the backslash stay two rows, and read alike.
        ("1", "2024-01-01", "AM", "/", None),
        ("1", "2024-01-01", "AM", "/", None),
        ("1", "2024-01-02", "AM", "E", None),
        ("1", "2024-01-02", "PM", "E", None),
        ("2", "2024-01-03", "AM", "E", "4"),
        ("3", "2024-01-03", "AM", None, None),
    ]
    one_day = attendance.attendance_session(cat, YEAR, "2024-01-02", "am")
    assert pick(one_day, "gfsid", "session") == [("1", "AM")]


def test_lesson_marks(cat):
    df = attendance.attendance_lesson_range(cat, YEAR, "2024-01-01", "2024-01-03")
    got = [
        tuple(r)
        for r in df.select(
            "date", "lesson_id", "teacher", "room", "year_group", "lesson_mark", "gfsid"
        ).collect()
    ]
    assert sorted(got[:4], key=repr) == [
        ("2024-01-01", "RMon:1", "Mr One", "R1, R2", "7", "/", "1"),
        ("2024-01-01", "RMon:1", "Mr One", "R1, R2", "7", "/", "1"),
        ("2024-01-01", "RMon:1", "NA Two", "R1, R2", "7", "/", "1"),
        ("2024-01-01", "RMon:1", "NA Two", "R1, R2", "7", "/", "1"),
    ]
    assert got[4:] == [("2024-01-02", None, "NA NA", None, None, "L", "2")]
    assert attendance.attendance_lesson(cat, YEAR, "2024-01-02").count() == 1


def test_attendance_summary_and_totals(cat):
    df = attendance.attendance_summary(cat, YEAR)
    assert pick(df, "gfsid", "possible_session", "present") == [
        ("1", "10", "8"), ("2", None, None), ("3", None, None), ("4", None, None),
    ]
    totals = attendance.attendance_totals(cat, YEAR)
    got = pick(totals, "student_id", "possible_sessions", "present", "authorised_absence", "missing_mark")
    assert got == [("1", 5, 3, 2, 0), ("2", 1, 0, 1, 0), ("3", 1, 0, 0, 1), ("9", 1, 1, 0, 0)]


def test_behaviour_events(cat):
    df = behaviour.behaviour_events_range(cat, YEAR, "2024-01-01", "2024-01-31")
    assert df.columns[: len(behaviour.EVENT_COLUMNS)] == [
        "gfsid" if c == "gfsid" else c for c in behaviour.EVENT_COLUMNS
    ]
    rows = {r["event_id"]: r for r in dicts(df)}
    assert len(rows) == df.count() == 5
    one = rows["e1"]
    # Warn stands on two rows (two follow-ups), Letter on two (two actions).
    assert one["action_immediate"] == "Call, Warn, Warn"
    assert one["action_followup"] == "Letter, Letter, Meet"
    assert (one["class"], one["room"], one["email_staff"]) == ("7Ma1", None, "user.one@school.example")
    assert (one["school_week"], one["day_type"], one["score"]) == ("1", "OPEN", "-1")
    assert one["ethnicity"] == "White - English"
    two = rows["e2"]
    assert (two["class"], two["staff"], two["action_immediate"]) == ("Own", None, None)
    assert two["surname"] is None  # a surname NA is nulled with the other NA cells
    assert rows["e3"]["class"] is None  # classes of a missing subject code are missing
    assert rows["e4"]["class"] == "Ac"
    assert (rows["e4"]["day_type"], rows["e2"]["day_type"]) == ("CLOSED", "OPEN")
    assert rows["e5"]["surname_forename_id"] == "NA NA (NA)"
    distinct = behaviour.behaviour_events_range(
        cat, YEAR, "2024-01-01", "2024-01-01", distinct_actions=True
    )
    assert pick(distinct, "action_immediate", "action_followup") == [("Call, Warn", "Letter, Meet")]


def test_behaviour_repeats_follow_classes(spark):
    """A pupil in two classes of the subject doubles the lists, as the rows do."""
    groups = _groups() + [("g6", "7Ma2", "s1", "x")]
    from school import ROWS

    cat = catalog(
        spark,
        teaching_groups=groups,
        teaching_groups_students=ROWS["teaching_groups_students"] + [("g6", "1")],
    )
    df = behaviour.behaviour_events_range(cat, YEAR, "2024-01-01", "2024-01-01")
    assert pick(df, "class", "action_immediate") == [
        ("7Ma1", "Call, Call, Warn, Warn, Warn, Warn"),
        ("7Ma2", "Call, Call, Warn, Warn, Warn, Warn"),
    ]


def test_no_behaviour_events(spark, cat):
    df = behaviour.behaviour_events_range(cat, YEAR, "2020-01-01", "2020-01-02")
    assert df.count() == 0


def test_exclusions(cat):
    df = behaviour.exclusions(cat, YEAR, "2024-01-01", "2024-01-31")
    got = pick(df, "gfsid", "year_group", "session", "ethnicity", "hml_band")
    assert got == [
        ("1", "7", "AM", "White - English", "High"),
        ("1", "7", "PM", "White - English", "High"),
        ("2", None, "AM", "Welsh", "Unknown.HML"),
    ]
    series = behaviour.exclusions_cumulative(cat, YEAR, "2024-01-01", "2024-01-31")
    assert pick(series, "year_group", "date", "upn", "n", "cum_sum") == [
        ("7", dt.date(2024, 1, 2), "U1", 2, 2),
        (None, dt.date(2024, 1, 3), "U2", 1, 1),
    ]


def test_detentions(cat):
    df = behaviour.detentions(cat, YEAR, "2024-01-01", "2024-01-31")
    assert {r["event_id"] for r in dicts(df)} == {"e1", "e2", "e4", "e5"}
    series = behaviour.detentions_cumulative(cat, YEAR, "2024-01-01", "2024-01-31")
    assert pick(series, "year_group", "date", "n", "cum_sum") == [
        ("7", dt.date(2024, 1, 1), 1, 1),
        ("8", dt.date(2024, 1, 2), 1, 1),
        ("8", dt.date(2024, 1, 6), 1, 2),
        (None, dt.date(2024, 1, 9), 1, 1),
    ]


def test_timetable(cat):
    df = timetable.timetable(cat, YEAR)
    assert df.columns == timetable.COLUMNS
    got = pick(df, "gfsid", "class", "lesson_id", "room", "staff_code")
    one = [g for g in got if g[0] == "1"]
    # Places in order: k0 (no room), k1 (R1, R2), k2 (no room). The first day
    # leaves k0 without a room, the later days carry in R2 from the day before.
    assert one == [
        ("1", "7Ma1", "RMon:1", "R1", "T1"), ("1", "7Ma1", "RMon:1", "R1", "T2"),
        ("1", "7Ma1", "RMon:1", "R2", "T1"), ("1", "7Ma1", "RMon:1", "R2", "T2"),
        ("1", "7Sc1", "RMon:1", "R2", "T1"), ("1", "7Sc1", "RMon:1", None, "T1"),
    ]
    # No UPN: 3 and 4 share a slot, and 4's missing start hides its latest one.
    assert [g for g in got if g[0] in ("3", "4")] == []
    # Room text is tidied; a lesson outside the fifty codes and year 12 are nulled.
    two = [r for r in dicts(df) if r["gfsid"] == "2"]
    assert [(r["lesson_id"], r["year_group"], r["room"], r["week_colour"]) for r in two] == [
        (None, None, "L", "Red")
    ]
    assert {r["department"] for r in dicts(df) if r["gfsid"] == "1"} == {"Numbers"}


def test_timetable_rule_rooms_and_latest_start(spark):
    from school import D, ROWS

    cat = catalog(
        spark,
        student_classes=[("k3", "1", D(2023, 9, 1), None), ("k1", "1", D(2023, 9, 1), None),
                         ("k2", "1", D(2023, 10, 1), None)],
    )
    got = pick(timetable.timetable(cat, YEAR), "class", "room", "day")
    # k2 started last in its slot; its room was carried over from k1.
    assert got == [("7Sc1", "R2", "Monday"), ("8HRB1", "HRB", "Tuesday")]
    assert ROWS["classes"][3][6] == "8HRB1"


def test_readability(cat):
    df = readability.readability(cat.rows("documents"), return_full=True)
    assert df.columns == [
        "text", "types", "tokens", "words", "sentences", "mean_words_ps", "mean_syllables_pw",
        "flesch", "age", "notes",
    ]
    rows = {r["text"]: r for r in dicts(df)}
    one = rows["d1"]
    # The cat sat . The dog ran !
    assert (one["types"], one["tokens"], one["words"], one["sentences"]) == (7, 8, 6, 2)
    assert (one["mean_words_ps"], one["mean_syllables_pw"]) == (3.0, 1.0)
    assert (one["flesch"], one["age"]) == (119.0, None)  # above 100 there is no band
    assert (rows["d2"]["words"], rows["d2"]["flesch"], rows["d2"]["age"]) == (0, None, None)
    assert rows["d3"]["mean_syllables_pw"] == 1.0  # no vowel still counts one
    short = readability.readability(cat.rows("documents"))
    assert short.columns == ["text", "flesch", "age", "notes"]


def test_bands(spark):
    from pyspark.sql import functions as F

    scores = [101, 100, 90, 89, 80, 70, 60, 50, 30, 29, 10, 9, 0, -1]
    df = spark.createDataFrame([(float(s),) for s in scores], "s double")
    got = [r[0] for r in df.select(readability._band(F.col("s"), 0)).collect()]
    assert got == [
        None, "10-11", "10-11", "11-12", "11-12", "12-13", "13-15", "15-18", "Undergraduate",
        "Graduate", "Graduate", "Professional", "Professional", None,
    ]
