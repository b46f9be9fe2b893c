"""Comma lists per group, built from counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrar.functions.semantics import na_text


def repeated_list_text(entries: Column, distinct: bool, separator: str = ", ") -> Column:
    """Sorted comma list from an array of (name, copies).

    The aggregation ships one counter per distinct name; the repeats are
    written out only in the result text.
    """
    ordered = F.array_sort(entries)
    if distinct:
        names = F.transform(ordered, lambda e: na_text(e["name"]))
    else:
        names = F.flatten(
            F.transform(
                ordered, lambda e: F.array_repeat(na_text(e["name"]), e["copies"].cast("int"))
            )
        )
    return F.array_join(names, separator)
