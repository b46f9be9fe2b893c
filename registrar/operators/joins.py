"""Left joins with the products' key semantics: a missing key equals a missing key.

A null-safe key is hashed as a stand-in for null beside a null flag, which hides
the buckets of a stored table. Where one side is known to have no missing key,
``never_null=True`` joins by plain equality instead: the same rows, and the
buckets stay as they are.

Inputs are projected before joining, so a join never leaves duplicate names.
Nothing is broadcast by hint; Spark broadcasts a side only when its size is
known to be under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Key = str | tuple[str, str]

# Stand-ins for null keys, by type; numbers use 0.
_DEFAULTS = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp_ntz": "1970-01-01"}


def _prepare(
    left: DataFrame, right: DataFrame, on: Sequence[Key], never_null: bool = False
) -> tuple[DataFrame, Column, list[str]]:
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    temps = [f"__right_key_{i}" for i in range(len(pairs))]
    right = right.withColumnsRenamed({r: t for (_, r), t in zip(pairs, temps)})
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides carry {sorted(clash)}; project before joining")
    equal = Column.__eq__ if never_null else Column.eqNullSafe
    condition = reduce(Column.__and__, [equal(F.col(l), F.col(t)) for (l, _), t in zip(pairs, temps)])
    return right, condition, temps


def left_join(left: DataFrame, right: DataFrame, on: Sequence[Key], never_null: bool = False) -> DataFrame:
    """Null-safe left join; the right key columns are dropped.

    For a right side that is a dimension: few rows per key. A hot key on the
    left is split by adaptive execution's skew join.
    """
    right, condition, temps = _prepare(left, right, on, never_null)
    return left.join(right, condition, "left").drop(*temps)


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[Key]) -> DataFrame:
    """Null-safe left join for a right side with many rows per key.

    Adaptive execution may split a hot key only on the left of an outer join,
    but on both sides of an inner join, and an inner join may also broadcast
    a small left side. So the matched rows come from an inner join and the
    unmatched ones from a check against the right side's distinct keys, which
    are combined map-side. Both branches read the same left plan, and its
    exchange is reused.
    """
    right, condition, temps = _prepare(left, right, on)
    matched = left.join(right, condition, "inner").drop(*temps)
    unmatched = _without_partner(left, right, on, temps)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def _without_partner(
    left: DataFrame, right: DataFrame, on: Sequence[Key], temps: list[str]
) -> DataFrame:
    """Left rows that match none of the distinct keys of ``right``.

    The keys are made distinct in the form a null-safe join hashes them, a
    default for null beside a null flag, so that one shuffle serves both the
    ``distinct`` and the join. An outer join with a marker, as an anti join
    would be pushed below unions, where a branch with a constant null key
    leaves it without a key to hash.
    """
    types = {f.name: f.dataType for f in right.schema}
    pairs = list(zip([k if isinstance(k, str) else k[0] for k in on], temps))

    def hashed(column: str, key: str) -> list[Column]:
        default = _DEFAULTS.get(types[key].typeName(), 0)
        return [F.coalesce(F.col(column), F.lit(default).cast(types[key])), F.col(column).isNull()]

    keys = right.select(
        *[c.alias(f"{t}_{i}") for _, t in pairs for i, c in enumerate(hashed(t, t))]
    ).distinct()
    keys = keys.withColumn("__partner", F.lit(True))
    condition = reduce(
        Column.__and__,
        [c == F.col(f"{t}_{i}") for l, t in pairs for i, c in enumerate(hashed(l, t))],
    )
    return left.join(keys, condition, "left").filter(F.col("__partner").isNull()).select(*left.columns)


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[Key], never_null: bool = False) -> DataFrame:
    """Null-safe inner join; the right key columns are dropped."""
    right, condition, temps = _prepare(left, right, on, never_null)
    return left.join(right, condition, "inner").drop(*temps)


def left_join_where(
    left: DataFrame, right: DataFrame, on: Sequence[Key], condition: Column, never_null: bool = False
) -> DataFrame:
    """Null-safe left join hashed on ``on`` alone; the condition is tested on the pairs that meet.

    For rows that have been put by ``on`` already, or will be needed by it
    afterwards: a further hash key would move them once more. The pairs of
    one key are all looked at, so a key should have few rows on each side.
    """
    right, equal, temps = _prepare(left, right, on, never_null)
    return left.join(right, equal & condition, "left").drop(*temps)


def same_where_met(left: Column, right: Column) -> Column:
    """Null-safe equality for ``left_join_where``, as a range so that it is not taken for a hash key."""
    return left.between(right, right) | (left.isNull() & right.isNull())


def with_hash_key(df: DataFrame, column: str, value: str, missing: str) -> DataFrame:
    """Replace a key by the two columns that a null-safe join would hash: a stand-in for null and a null flag.

    Rows put by these columns may be made distinct and joined by plain
    equality (``never_null=True``) where they are.
    """
    kind = df.schema[column].dataType
    stand_in = F.lit(_DEFAULTS.get(kind.typeName(), 0)).cast(kind)
    rest = [c for c in df.columns if c != column]
    return df.select(
        F.coalesce(F.col(column), stand_in).alias(value), F.col(column).isNull().alias(missing), *rest
    )


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[Key]) -> DataFrame:
    """Left rows without a partner, null-safe."""
    keys = right.select(*[k if isinstance(k, str) else k[1] for k in on])
    right, _, temps = _prepare(left, keys, on)
    return _without_partner(left, right, on, temps)


def full_join(left: DataFrame, right: DataFrame, key: str, never_null: bool = False) -> DataFrame:
    """Null-safe full outer join on one key, kept once."""
    right, condition, (temp,) = _prepare(left, right, [key], never_null)
    joined = left.join(right, condition, "full")
    rest = [c for c in joined.columns if c not in (key, temp)]
    return joined.select(F.coalesce(F.col(key), F.col(temp)).alias(key), *rest)


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Null-safe left join on every column the two sides share."""
    common = [c for c in left.columns if c in right.columns]
    return left_join(left, right, common)
