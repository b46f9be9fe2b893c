import datetime as dt

import pytest

from registrar.plans import attendance, school
from registrar.sources.catalog import SchoolCatalog, conform
from registrar.sources.schemas import SOURCES
from registrar.sources.textdir import read_text_dir
from school import ROWS, YEAR, catalog


def test_text_directory(spark, tmp_path):
    (tmp_path / "one.txt").write_bytes("Café au lait.".encode("latin-1"))
    (tmp_path / "two.txt").write_bytes(b"Plain.")
    (tmp_path / "skip.bin").write_bytes(b"\x00")
    df = read_text_dir(spark, str(tmp_path), glob="*.txt")
    assert sorted(map(tuple, df.collect())) == [("one.txt", "Café au lait."), ("two.txt", "Plain.")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_text_dir(spark, str(tmp_path / "nowhere"))


def test_conform_adds_missing_and_drops_unknown_columns(spark):
    df = spark.createDataFrame([("1", 5, "x")], "id string, sex int, shoe string")
    got = conform(df, "students")
    assert got.schema == SOURCES["students"]
    assert got.first().asDict() == {
        "id": "1", "preferred_last_name": None, "preferred_first_name": None, "sex": "5",
    }


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The hand-made school written as partitioned Parquet."""
    root = tmp_path_factory.mktemp("school")
    cat = catalog(spark)
    for name in ROWS:
        df = cat.load(name)
        parts = []
        if name not in ("school", "staff", "documents"):
            if "academic_year" not in df.columns:
                df = df.selectExpr("*", f"{YEAR} AS academic_year")
            parts = ["academic_year"]
            if name in ("session_marks", "lesson_marks"):
                parts.append("date")
        df.write.partitionBy(*parts).parquet(str(root / name))
    return SchoolCatalog(spark, root=str(root))


def test_stored_school_gives_the_same_products(spark, stored):
    made = catalog(spark)
    for build in (
        school.school_population,
        lambda c: attendance.attendance_session_range(c, YEAR, "2024-01-01", "2024-01-03"),
    ):
        assert sorted(map(repr, build(stored).collect())) == sorted(map(repr, build(made).collect()))


def test_arguments_prune_partitions(stored):
    df = attendance.attendance_session(stored, YEAR, "2024-01-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "session_mark_id" in line)
    assert "PartitionFilters: [isnotnull(academic_year" in scan
    assert "date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert dt.date(2024, 1, 2).isoformat() in scan
    # Only the used columns are read.
    assert "ReadSchema: struct<student_id:string,session_mark_id:string,session:string," in scan


def test_catalog_tables(spark):
    spark.createDataFrame(ROWS["teachers"], SOURCES["teachers"]).createOrReplaceTempView("teachers")
    with pytest.raises(KeyError):
        SchoolCatalog(spark).load("teachers")
    assert SchoolCatalog(spark, tables={"teachers": spark.table("teachers")}).rows("teachers").count() == 2


@pytest.mark.parametrize("kind", ["DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "STRING"])
def test_days_of_dates_times_and_text(spark, kind):
    times = ["2024-01-14 23:59:59", "2024-01-15 00:00:00", "2024-01-15 08:30:00", "2024-01-16 23:59:59",
             "2024-01-17 00:00:00", None]
    rows = [(str(i), t) for i, t in enumerate(times)]
    stored = spark.createDataFrame(rows, "student_id string, t string").selectExpr(
        "student_id", "student_id AS session_mark_id", "'AM' AS session", "'x' AS session_minutes_late",
        f"CAST({'substr(t, 1, 10)' if kind == 'STRING' else 't'} AS {kind}) AS date",
    )
    if kind == "STRING":
        stored = stored.unionByName(stored.limit(1).selectExpr("'9' AS student_id", "session_mark_id", "session", "session_minutes_late", "'soon' AS date"))
    cat = SchoolCatalog(spark, tables={"session_marks": stored})
    ids = lambda *days: sorted(r.student_id for r in cat.rows("session_marks", 2023, dates=days).collect())
    assert ids("2024-01-15", "2024-01-15") == ["1", "2"]
    assert ids("2024-01-15", "2024-01-16") == ["1", "2", "3"]
    # Unreadable numbers become null.
    assert {r.session_minutes_late for r in cat.rows("session_marks", 2023).collect()} == {None}


def test_times_are_pushed_down(spark, tmp_path):
    spark.sql("SELECT '1' AS student_id, TIMESTAMP'2024-01-15 08:30:00' AS date").write.parquet(str(tmp_path / "m"))
    cat = SchoolCatalog(spark, tables={"session_marks": spark.read.parquet(str(tmp_path / "m"))})
    plan = cat.rows("session_marks", 2023, dates=("2024-01-15", "2024-01-15"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(date" in pushed and "LessThan(date" in pushed


def test_year_group_partitions_read_as_numbers(spark, tmp_path):
    rows = [("1", "7", "a"), ("2", "11", "b")]
    spark.createDataFrame(rows, "student_id string, year_group string, grade string").write.partitionBy("year_group").parquet(str(tmp_path / "g"))
    cat = SchoolCatalog(spark, tables={"exam_results": spark.read.parquet(str(tmp_path / "g"))})
    got = cat.rows("exam_results", 2023, year_groups=["11"]).collect()
    assert [(r.student_id, r.year_group, r.grade) for r in got] == [("2", "11", "b")]


def test_readability_of_a_directory(spark, tmp_path):
    from registrar.plans.readability import readability, readability_dir

    texts = {"one.txt": "The cat sat on the mat. It was happy.", "two.txt": "Considerable institutional responsibility."}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    made = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    for full in (False, True):
        assert sorted(readability_dir(spark, str(tmp_path), full).collect()) == sorted(readability(made, full).collect())


def test_files_by_line_equal_whole_files(spark, tmp_path):
    from registrar.plans.readability import readability_dir
    from registrar.sources.textdir import read_text_lines

    prose = "The cat sat. Did it?\r\nIt's a well-\nknown caf\xe9!\rHmm... e.g. this\n\n - one two"
    texts = {"a.txt": prose, "empty.txt": "", "blank.txt": "\n \n", "end.txt": "No end", "large.txt": (prose + "\n") * 4000}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode("latin-1"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        lines, _ = read_text_lines(spark, str(tmp_path), "large.txt")
        splits = lines.selectExpr("spark_partition_id() AS p", "text").where("text <> ''").select("p").distinct().count()
        assert splits > 5
        whole = readability_dir(spark, str(tmp_path), True)
        by_line = readability_dir(spark, str(tmp_path), True, by_line=True)
        assert by_line.schema.simpleString() == whole.schema.simpleString()
        expected = sorted(repr(r) for r in whole.collect())
        assert len(expected) == 4 and sorted(repr(r) for r in by_line.collect()) == expected  # not the empty file
        assert readability_dir(spark, str(tmp_path), glob="end*", by_line=True).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
