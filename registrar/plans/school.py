"""School record and population."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.operators.joins import left_join
from registrar.sources.catalog import SchoolCatalog


def school_record(cat: SchoolCatalog) -> DataFrame:
    """The school: name, academic years on file, current year."""
    return cat.rows("school")


def school_years(cat: SchoolCatalog) -> DataFrame:
    """One row per academic year on file."""
    return school_record(cat).select(
        "name",
        F.explode("academic_years").alias("academic_year"),
        "current_academic_year",
    )


def school_population(cat: SchoolCatalog) -> DataFrame:
    """Pupils per academic year; a year without pupils counts 0.

    Counted before the join, so only one row per year moves.
    """
    counts = cat.rows("students").groupBy("academic_year").agg(F.count("*").alias("n"))
    years = school_years(cat).select("academic_year")
    return left_join(years, counts, ["academic_year"]).select(
        "academic_year", F.coalesce("n", F.lit(0)).alias("n")
    )
