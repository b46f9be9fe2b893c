"""The school as catalog tables bucketed by pupil.

Nearly every product joins a table to the pupils by pupil id. On plain files
both sides of such a join are shuffled each time; here the id decides the
bucket once, when the table is written, and joins and distinct rows by pupil
read the buckets as they are. Read the result with
``SchoolCatalog(spark, database=...)``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.sources.catalog import NEVER_NULL, SchoolCatalog
from registrar.sources.schemas import DATE_COLUMN, SOURCES

# Pupil id of the tables that have one.
PUPIL_KEY = {
    "students": "id",
    "student_general": "student_id",
    "student_edu_details": "student_id",
    "student_sensitive": "student_id",
    "student_classes": "student_id",
    "exam_results": "student_id",
    "attainment_grades": "student_id",
    "marks": "student_id",
    "teaching_groups_students": "student_ids",
    "session_marks": "student_id",
    "lesson_marks": "student_id",
    "attendance_summary": "student_id",
    "behaviour_events": "student_ids",
}

#: A pupil id (or a missing one) of more rows is too much for the one task that reads its bucket.
ROWS_PER_PUPIL = 1_000_000


def store_school(
    cat: SchoolCatalog,
    database: str,
    buckets: int,
    tables: Iterable[str] | None = None,
    *,
    path: str | None = None,
    by_date: bool = False,
    rows_per_pupil: int = ROWS_PER_PUPIL,
) -> dict[str, bool]:
    """Write tables of a school to ``database``; says which of them are bucketed.

    Give as many ``buckets`` as shuffles have partitions, or more: Spark keeps
    the buckets of a join only if they are no fewer. Tables are partitioned by
    year and, with ``by_date``, fact tables by day (buckets x days files). An
    existing table is replaced. ``path`` is a folder for the files, by default
    the warehouse.

    Rows are counted per pupil first (one number comes back): a table in which
    one id holds more than ``rows_per_pupil`` rows stays without buckets, as
    adaptive execution can split a hot key of a shuffle but not a bucket. A
    table without missing ids is marked so, and is joined by plain equality;
    one that has some keeps the null-safe join, shuffle and result of plain
    files. Empty tables are written as they are.
    """
    return {
        name: _store(cat.rows(name), name, database, buckets, path, by_date, rows_per_pupil)
        for name in (tables if tables is not None else SOURCES)
    }


def _store(
    df: DataFrame, name: str, database: str, buckets: int, path: str | None, by_date: bool, rows_per_pupil: int
) -> bool:
    key = PUPIL_KEY.get(name)
    parts = [c for c in ("academic_year",) if c in df.columns]
    if by_date and name in DATE_COLUMN:
        parts.append(DATE_COLUMN[name])
    bucketed = never_null = False
    if key is not None:
        counted = df.groupBy(key).agg(F.count("*").alias("n")).agg(
            F.max("n").alias("most"), F.count_if(F.col(key).isNull()).alias("missing")
        )
        seen = counted.first()
        never_null, bucketed = seen["missing"] == 0, (seen["most"] or 0) <= rows_per_pupil
    if bucketed:
        # One task for each bucket, so one file for each bucket and partition.
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    else:
        writer = df.write
    if parts:
        writer = writer.partitionBy(*parts)
    if path is not None:
        writer = writer.option("path", f"{path}/{name}")
    table = f"{database}.{name}"
    writer.format("parquet").mode("overwrite").saveAsTable(table)
    if never_null:
        df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{NEVER_NULL}' = '{key}')")
    return bucketed
