"""Products on a bucketed store equal those on plain tables, and joins by pupil keep the buckets."""

import pytest
from pyspark.sql import functions as F

from registrar.operators.joins import left_join
from registrar.plans import attainment, attendance, behaviour, classlists, students, timetable
from registrar.sources.catalog import SchoolCatalog
from registrar.sources.schemas import SOURCES
from registrar.sources.store import PUPIL_KEY, store_school
from school import YEAR, catalog

DAYS = ("2024-01-01", "2024-01-31")
PRODUCTS = {
    "details": lambda c: students.student_details(c, YEAR),
    "raw": lambda c: students.student_raw_attributes(c, YEAR),
    "exams": lambda c: attainment.exam_results(c, YEAR, "11"),
    "attainment": lambda c: attainment.attainment(c, YEAR, "7"),
    "markbook": lambda c: attainment.markbook_attainment(c, YEAR),
    "sessions": lambda c: attendance.attendance_session_range(c, YEAR, *DAYS),
    "lessons": lambda c: attendance.attendance_lesson_range(c, YEAR, *DAYS),
    "summary": lambda c: attendance.attendance_summary(c, YEAR),
    "behaviour": lambda c: behaviour.behaviour_events_range(c, YEAR, *DAYS),
    "exclusions": lambda c: behaviour.exclusions(c, YEAR, *DAYS),
    "classes": lambda c: classlists.class_list_teacher(c, YEAR),
    "timetable": lambda c: timetable.timetable(c, YEAR),
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The hand-made school, with pupils and marks of a missing id, plain and stored."""
    plain = catalog(spark)
    extra = {
        "session_marks": "NULL AS student_id, '3' AS session_mark_id, DATE '2024-01-02' AS date, 'AM' AS session",
        "student_edu_details": "NULL AS student_id, 'U0' AS upn, '7' AS national_curriculum_year",
    }
    tables = {name: plain.load(name) for name in SOURCES}
    for name, row in extra.items():
        more = spark.sql(f"SELECT {row}")
        tables[name] = tables[name].unionByName(more, allowMissingColumns=True)
    plain = SchoolCatalog(spark, tables=tables)
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_school")
    bucketed = store_school(
        plain, "stored_school", 4, path=str(tmp_path_factory.mktemp("stored")), by_date=True
    )
    yield plain, SchoolCatalog(spark, database="stored_school"), bucketed
    spark.sql("DROP DATABASE stored_school CASCADE")


def rows(df):
    return sorted(repr(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(PRODUCTS))
def test_store_changes_no_product(stored, name):
    plain, store, _ = stored
    expected = rows(PRODUCTS[name](plain))
    assert expected and rows(PRODUCTS[name](store)) == expected


def test_tables_with_a_pupil_are_bucketed_and_missing_ids_known(stored):
    _, store, bucketed = stored
    assert {n for n, b in bucketed.items() if b} == set(PUPIL_KEY)
    known = {n for n in PUPIL_KEY if store.never_null(n)}
    missing = {"session_marks", "student_edu_details", "behaviour_events", "teaching_groups_students"}
    assert PUPIL_KEY.keys() - known <= missing
    assert not {"session_marks", "student_edu_details", "behaviour_events"} & known
    assert not store.never_null("students", "student_edu_details")


def test_a_hot_pupil_leaves_the_table_without_buckets(spark, stored, tmp_path):
    plain, _, _ = stored
    spark.sql("CREATE DATABASE IF NOT EXISTS hot_school")
    try:
        bucketed = store_school(
            plain, "hot_school", 4, ["session_marks", "students"], path=str(tmp_path), rows_per_pupil=3
        )
        assert bucketed == {"session_marks": False, "students": True}
        got = spark.table("hot_school.session_marks").count()
        assert got == plain.load("session_marks").count()
    finally:
        spark.sql("DROP DATABASE hot_school CASCADE")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled_scans(df, table):
    """Scans of a table, and those of them with a shuffle between scan and the next join."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-|*")) for line in plan]
    found, shuffled = 0, 0
    for i, line in enumerate(plan):
        if f"FileScan parquet spark_catalog.{table}[" in line:
            found += 1
            level, j = depth[i], i
            while j > 0 and "Join" not in plan[j]:
                j -= 1
                if depth[j] < level:
                    level = depth[j]
                    if " Exchange " in plan[j]:
                        shuffled += 1
                        break
    return found, shuffled


def test_joins_by_pupil_do_not_shuffle_the_buckets(spark, tmp_path, no_broadcast):
    """J01 to J04: roll, details, attribute tables and facts meet on the pupil."""
    spark.sql("CREATE DATABASE IF NOT EXISTS clean_school")
    try:
        plain = catalog(spark)
        store_school(plain, "clean_school", 4, path=str(tmp_path))
        store = SchoolCatalog(spark, database="clean_school")
        details = students.student_details(store, YEAR)
        assert shuffled_scans(details, "clean_school.students") == (1, 0)
        assert shuffled_scans(details, "clean_school.student_edu_details") == (1, 0)
        marks = attendance.attendance_session_range(store, YEAR, *DAYS)
        assert shuffled_scans(marks, "clean_school.students")[1] == 0
        roll = store.rows("students", YEAR).select(F.col("id").alias("student_id"), "sex")
        for fact in ("exam_results", "attainment_grades", "lesson_marks", "attendance_summary"):
            joined = left_join(store.rows(fact, YEAR), roll, ["student_id"], store.never_null("students"))
            assert shuffled_scans(joined, f"clean_school.{fact}") == (1, 0), fact
            assert rows(joined) == rows(left_join(plain.rows(fact, YEAR), roll, ["student_id"]))
        null_safe = left_join(store.rows("exam_results", YEAR), roll, ["student_id"])
        assert shuffled_scans(null_safe, "clean_school.exam_results") == (1, 1)
        for name in ("details", "sessions", "summary", "attainment"):
            assert rows(PRODUCTS[name](store)) == rows(PRODUCTS[name](plain)), name
    finally:
        spark.sql("DROP DATABASE clean_school CASCADE")
