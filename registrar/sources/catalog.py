"""Where the products find their source tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.sources.schemas import DATE_COLUMN, SOURCES, WITHOUT_YEAR


# Property of a catalog table that names the column in which no value is missing.
NEVER_NULL = "registrar.never_null"

PUPIL_TABLES = ("students", "student_edu_details", "student_general", "student_sensitive")


class SchoolCatalog:
    """Source tables of one school.

    Give ``root`` for a directory with one dataset per table
    (``root/students``, ``root/session_marks``...), ``database`` for catalog
    tables, or ``tables`` for DataFrames made elsewhere. The arguments of a
    product become predicates on the table, so partition pruning and Parquet
    push-down apply.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        *,
        database: str | None = None,
        tables: Mapping[str, DataFrame] | None = None,
        format: str = "parquet",
    ):
        self.spark = spark
        self._root = root
        self._database = database
        self._tables = dict(tables or {})
        self._format = format
        self._loaded: dict[tuple[str, int | None], DataFrame] = {}
        self._marked: dict[str, bool] = {}

    def load(self, name: str, academic_year: int | None = None) -> DataFrame:
        """The stored table, before columns are conformed.

        Resolved once: a new catalog sees files that arrive later.
        """
        key = (name, academic_year)
        if key not in self._loaded:
            self._loaded[key] = self._read(name, academic_year)
        return self._loaded[key]

    def _read(self, name: str, academic_year: int | None) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        if self._database is not None:
            return self.spark.table(f"{self._database}.{name}")
        if self._root is not None:
            return self.spark.read.format(self._format).load(f"{self._root}/{name}")
        raise KeyError(f"no source for table {name!r}")

    def never_null(self, *names: str) -> bool:
        """Whether these are catalog tables that ``store_school`` found without a missing pupil id."""
        if self._database is None:
            return False
        for name in names:
            if name not in self._marked and name not in self._tables:
                properties = self.spark.sql(f"SHOW TBLPROPERTIES {self._database}.{name}")
                self._marked[name] = properties.filter(F.col("key") == NEVER_NULL).first() is not None
        return all(self._marked.get(name, False) for name in names)

    def rows(
        self,
        name: str,
        academic_year: int | None = None,
        *,
        year_groups: Iterable[str] | None = None,
        dates: tuple[str, str] | None = None,
    ) -> DataFrame:
        """Declared columns of a table under the given predicates."""
        df = self.load(name, academic_year)
        if academic_year is not None and name not in WITHOUT_YEAR and "academic_year" in df.columns:
            df = df.filter(F.col("academic_year") == academic_year)
        if year_groups is not None:
            df = df.filter(F.col("year_group").isin(list(year_groups)))
        if dates is not None:
            df = df.filter(in_days(df, DATE_COLUMN[name], *dates))
        return conform(df, name)


def in_days(df: DataFrame, column: str, first: str, last: str) -> Column:
    """Whether a stored date, time or text falls on one of the days, both ends included.

    A comparison of the stored column with literals, so that partitions are
    pruned and the predicate is pushed down: a time is compared with the
    midnights of the first day and of the day after the last. Text is read
    as a date; what is no date falls on no day.
    """
    start, end = (F.to_date(F.lit(d)) for d in (first, last))
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (value >= start.cast(kind)) & (value < F.date_add(end, 1).cast(kind))
    if isinstance(kind, T.StringType):
        value = value.try_cast("date")
    return value.between(start, end)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the declared columns; an absent one and unreadable text become null."""
    columns = []
    present = {f.name: f.dataType for f in df.schema}
    for field in SOURCES[name]:
        if field.name not in present:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif present[field.name] != field.dataType:
            columns.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            columns.append(field.name)
    if "academic_year" in present and name not in WITHOUT_YEAR:
        columns.append("academic_year")
    return df.select(*columns)
