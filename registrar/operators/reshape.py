"""Attribute pivots, column tests and code splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eav_wide(
    parts: Sequence[tuple[DataFrame, Mapping[str, str]]],
    key: str = "student_id",
    duplicates: str = "min",
) -> DataFrame:
    """Widen entity-attribute-value tables that share a key, in one aggregate.

    ``parts`` pairs each table (``key, name, value``) with its wanted
    attributes, ``{attribute name: output column}``. The attribute filter
    reaches the scans; the tables are unioned so several pivots cost one
    shuffle, and partial aggregation shrinks a hot entity before it moves.
    An attribute nobody has gives an all-null column.

    ``duplicates`` says what to do with a repeated (entity, attribute):
    ``min`` keeps the least value, ``list`` keeps the sorted values as an
    array, ``error`` fails the query.
    """
    if duplicates not in ("min", "list", "error"):
        raise ValueError(f"unknown duplicates policy {duplicates!r}")
    narrow = []
    for table, attributes in parts:
        output = reduce(
            lambda acc, item: acc.when(F.col("name") == item[0], F.lit(item[1])),
            attributes.items(),
            F,
        )
        narrow.append(
            table.filter(F.col("name").isin(list(attributes))).select(
                key, output.alias("name"), F.col("value").cast("string").alias("value")
            )
        )
    columns = [c for _, attributes in parts for c in attributes.values()]
    long = reduce(DataFrame.unionByName, narrow)
    return long.groupBy(key).agg(*[_widened(c, duplicates) for c in columns])


def _widened(column: str, duplicates: str) -> Column:
    value = F.when(F.col("name") == column, F.col("value"))
    if duplicates == "list":
        return F.array_sort(F.collect_list(value)).alias(column)
    least = F.min(value)
    if duplicates == "error":
        seen = F.count(F.when(F.col("name") == column, F.lit(1)))
        message = F.lit(f"more than one value of {column} for one entity")
        least = F.when(seen > 1, F.raise_error(message).cast("string")).otherwise(least)
    return least.alias(column)


def non_empty_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those columns that are neither all null nor all empty text.

    One aggregate over the table; the driver receives a single row of flags.
    """
    flags = []
    for c in columns:
        present = F.count(c)
        blank = F.count(F.when(F.col(c).cast("string") == "", F.lit(1)))
        dropped = (present == 0) | (blank == F.count("*"))
        flags.append((~dropped).alias(c))
    row = df.agg(*flags).first()
    return [c for c in columns if row[c]]


def split_pair(column: Column, separator: str, first: str, second: str) -> list[Column]:
    """Split into two columns: missing pieces are null, extra ones are dropped."""
    pieces = F.split(column, separator)
    return [
        F.try_element_at(pieces, F.lit(1)).alias(first),
        F.try_element_at(pieces, F.lit(2)).alias(second),
    ]


def list_text(column: Column, separator: str = ", ") -> Column:
    """Array as display text; an empty or missing array is null."""
    return F.nullif(F.concat_ws(separator, column), F.lit(""))
