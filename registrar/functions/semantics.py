"""Null, text and number rules that differ from plain Spark expressions.

The products follow a statistics-language model of missing values: a missing
value pasted into text reads "NA", a regex test on it is false, and a
conditional on it is missing. Each rule is one helper here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values the results depend on.
YEAR_GROUPS = ["7", "8", "9", "10", "11"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
WEEK_COLOURS = ["Red", "Blue"]
WHITE_BRITISH = "english|scottish|welsh"
SPECIAL_SUBJECT_CODES = ["Ac", "Al", "Ap", "Ea"]
UNKNOWN_HML = "Unknown.HML"
UNKNOWN_ETHNICITY = "Unknown.Ethnicity"
BACKSLASH = "\\"


def na_text(column: Column) -> Column:
    """Text of a value, with missing rendered as ``NA``."""
    return F.coalesce(column.cast("string"), F.lit("NA"))


def paste(*parts: Column | str) -> Column:
    """Concatenate; plain strings are literals, missing columns read ``NA``."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else na_text(p) for p in parts])


def matches(column: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Regex search that is false, not null, on a missing value; case is folded for all letters."""
    flagged = f"(?iu)(?:{pattern})" if ignore_case else pattern
    return F.coalesce(column.rlike(flagged), F.lit(False))


def any_of(patterns: str | Sequence[str]) -> str:
    """One pattern or several, as a single alternation."""
    return patterns if isinstance(patterns, str) else "|".join(patterns)


def ifelse(condition: Column, yes: Column | str, no: Column | str) -> Column:
    """Conditional that stays missing where its condition is missing."""
    lift = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(condition, lift(yes)).when(~condition, lift(no))


def in_domain(column: Column, levels: Sequence[str]) -> Column:
    """Keep values of an ordered category domain; anything else is null."""
    return F.when(column.isin(list(levels)), column)


def domain_order(column: Column, levels: Sequence[str]) -> Column:
    """Sort key: position in the domain, outsiders and nulls last."""
    rank = F.array_position(F.array(*[F.lit(v) for v in levels]), column)
    return F.nullif(rank, F.lit(0)).asc_nulls_last()


def to_integer(column: Column) -> Column:
    """Integer part of number text; anything unreadable is null."""
    return column.try_cast("double").try_cast("int")


def number_text(column: Column) -> Column:
    """Shortest text of a number: 6.0 reads ``6``, 5.5 stays ``5.5``."""
    return F.regexp_replace(column.cast("string"), r"\.0$", "")


def all_text(df: DataFrame) -> DataFrame:
    """Cast every column to string."""
    others = [f.name for f in df.schema if not isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.col(c).cast("string") for c in others}) if others else df


def na_cells_to_null(df: DataFrame) -> DataFrame:
    """Null out text cells that read exactly ``NA``."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("NA")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def label_reg() -> Column:
    """``SURNAME Forename (registration group)``."""
    return _label(F.col("registration_group"))


def label_id(student_id: Column) -> Column:
    """``SURNAME Forename (pupil id)``."""
    return _label(student_id)


def _label(tail: Column) -> Column:
    return paste(
        F.upper("preferred_last_name"), " ", F.col("preferred_first_name"), " (", tail, ")"
    )


def white_british_pp(ethnicity: Column, pp: Column) -> Column:
    """White-British pupil premium flag as text; null only where the ethnicity
    matches and the premium indicator is missing."""
    return ifelse(matches(ethnicity, WHITE_BRITISH) & (pp == "True"), "True", "False")


def fold_present(code: Column) -> Column:
    """The backslash attendance mark means the same as the slash."""
    return F.when(code == BACKSLASH, F.lit("/")).otherwise(code)


def impute(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Fill nulls with constants, column by column."""
    return df.fillna(defaults)


PUPIL_DEFAULTS = {
    "hml_band": UNKNOWN_HML,
    "ethnicity": UNKNOWN_ETHNICITY,
    "eal": "False",
}
