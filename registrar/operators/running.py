"""Running totals and carried values that do not put a whole group into one task.

Both are scans in order inside groups. A group is cut by its first order key
(a day, say) and each of these parts, if it is large, by ranges of the next
key between its least and greatest. Parts are summed up first, with a map-side
combine; what stands before a part comes from a window over the parts,
and only the rows of one part meet in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.operators.joins import inner_join

#: A part of more rows is cut into ranges of the next order key, of about so many rows if that is spread evenly.
ROWS_PER_PART = 10_000
#: Most ranges of a part.
MOST_RANGES = 1 << 14
#: First characters of a text by which it is put into a range.
CHARACTERS = 24


@dataclass
class _Scan:
    """How rows, then parts, add up; ``None`` stands for nothing yet."""

    rows: Callable[[], Column]
    parts: Callable[[str, Column], Column]
    before: Callable[[str, WindowSpec], Column]
    inside: Callable[[WindowSpec], Column]
    both: Callable[[Column, Column], Column]


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, output: str, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Cumulative sum of ``value`` per ``by`` group, in ``order`` (nulls last).

    ``order`` must be unique inside a group.
    """
    return _scan(df, by, order, output, rows_per_part, _Scan(
        rows=lambda: F.sum(value),
        parts=lambda total, _: F.sum(total),
        before=lambda total, window: F.sum(total).over(window),
        inside=lambda window: F.sum(value).over(window),
        both=lambda before, here: F.coalesce(before + here, before, here),
    ))


def carried_forward(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, output: str, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """The last non-null ``value`` of the group up to each row, in ``order`` (nulls last).

    Rows that tie in all of ``order`` must have the same value, or
    ``value`` must be one of ``order``.
    """
    return _scan(df, by, order, output, rows_per_part, _Scan(
        rows=lambda: F.max_by(value, F.when(F.col(value).isNotNull(), _key(order))),
        parts=lambda last, at: F.max_by(last, F.when(F.col(last).isNotNull(), at)),
        before=lambda last, window: F.last(last, ignorenulls=True).over(window),
        inside=lambda window: F.last(value, ignorenulls=True).over(window),
        both=lambda before, here: F.coalesce(here, before),
    ))


def _scan(df: DataFrame, by: Sequence[str], order: Sequence[str], output: str, rows_per_part: int, scan: _Scan) -> DataFrame:
    """Three levels: first order keys of a group, ranges of the next key, rows."""
    first, *rest = order
    # With one order key the ranges are of that key, over the group as a whole.
    outer = [*by, first] if rest else list(by)
    ranged = _with_ranges(df, outer, (rest or [first])[0], rows_per_part)
    part = [*outer, "__range"]
    parts = ranged.groupBy(*part).agg(scan.rows().alias("__total"))
    earlier = Window.unboundedPreceding, -1
    in_outer = Window.partitionBy(*outer).orderBy("__range").rowsBetween(*earlier)
    before = parts.select(*part, scan.before("__total", in_outer).alias("__before"))
    if rest:
        heads = parts.groupBy(*outer).agg(scan.parts("__total", F.col("__range")).alias("__total"))
        in_group = Window.partitionBy(*by).orderBy(F.col(first).asc_nulls_last()).rowsBetween(*earlier)
        heads = heads.select(*outer, scan.before("__total", in_group).alias("__ahead"))
        both = inner_join(before, heads, outer)
        before = both.select(*part, scan.both(F.col("__ahead"), F.col("__before")).alias("__before"))
    so_far = (
        Window.partitionBy(*part)
        .orderBy(*[F.col(c).asc_nulls_last() for c in (rest or [first])])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = ranged.withColumn("__inside", scan.inside(so_far))
    joined = inner_join(scanned, before, part)
    return joined.withColumn(output, scan.both(F.col("__before"), F.col("__inside"))).drop("__range", "__before", "__inside")


def _key(order: Sequence[str]) -> Column:
    """The order as one comparable value, nulls last."""
    return F.struct(*[p for c in order for p in (F.col(c).isNull(), F.col(c))])


def _with_ranges(df: DataFrame, outer: Sequence[str], key: str, rows_per_part: int) -> DataFrame:
    """Number in ``__range`` the ranges of ``key`` that a part of many rows is cut into; nulls are the last range.

    The ranges lie evenly between the part's least and greatest key. A text counts
    by its first characters, as digits that run from the part's least to its
    greatest character of that place. Rounding may only join ranges: they keep the
    order whatever the keys are, and how evenly they fill depends on the keys.
    """
    digits = _digits(F.col(key), df.schema[key].dataType)
    sized = df.groupBy(*outer).agg(
        F.least(F.ceil(F.count("*") / rows_per_part), F.lit(MOST_RANGES)).alias("__ranges"),
        F.array(*[F.min(d) for d in digits]).alias("__least"), F.array(*[F.max(d) for d in digits]).alias("__most"),
    )
    joined = inner_join(df, sized, outer)
    place, size = F.lit(0.0), F.lit(1.0)
    for i, digit in enumerate(digits):
        base = F.get("__most", F.lit(i)) - F.get("__least", F.lit(i)) + 1
        place, size = place * base + (digit - F.get("__least", F.lit(i))), size * base
    at = F.when(F.col("__ranges") > 1, F.least(F.floor(place * F.col("__ranges") / size), F.col("__ranges"))).otherwise(0)
    number = F.when(F.col(key).isNull(), F.col("__ranges")).otherwise(F.coalesce(at, F.lit(0)))
    return joined.withColumn("__range", number.cast("int")).drop("__ranges", "__least", "__most")


def _digits(key: Column, kind: T.DataType) -> list[Column]:
    """Numbers that order as the keys do, the first ones first; a missing character is the least."""
    if isinstance(kind, T.StringType):
        return [F.ascii(F.substring(key, i + 1, 1)).cast("double") for i in range(CHARACTERS)]
    if isinstance(kind, T.DateType):
        return [F.unix_date(key).cast("double")]
    if isinstance(kind, T.TimestampNTZType):
        return [F.unix_micros(key.cast("timestamp")).cast("double")]
    return [(key.cast("int") if isinstance(kind, T.BooleanType) else key).cast("double")]
