"""Joins of a large table to a smaller one that is unique on the join key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
}


def _type_width(kind: T.DataType) -> int:
    """Bytes of a value of the type in a row; texts and arrays without their contents."""
    if isinstance(kind, T.StructType):
        return 16 + sum(_type_width(f.dataType) for f in kind.fields)
    return 8 + _FIXED_WIDTH.get(type(kind), 8)


def memory_bytes(df: DataFrame) -> int:
    """Size of a table in memory, measured in one pass: rows times fixed width, plus text lengths and array contents."""
    fixed = _type_width(df.schema)
    measures = [F.count("*").alias("n")]
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            measures.append(F.sum(F.octet_length(field.name)).alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            each = _type_width(field.dataType.elementType)
            measures.append(F.sum(F.size(field.name) * each).alias(field.name))
    rows, *contents = df.agg(*measures).first()
    return rows * fixed + sum(c or 0 for c in contents)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the measured size of the whole table is within the bound."""
    return memory_bytes(df) <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``left`` to ``right``, which holds at most one row per ``on`` (give it written, as it is measured).

    A right side whose size was checked is broadcast, so ``left`` is not shuffled. Beyond the bound it is a sort-merge join, whose
    hot keys adaptive execution splits; the hint keeps Spark from broadcasting what only looks small in its compressed file.
    ``small`` passes on a check made before; with ``null_safe`` null keys meet null keys.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported lookup join: {how}")
    side = F.broadcast(right) if (fits_broadcast(right, max_bytes) if small is None else small) else right.hint("merge")
    if not null_safe:
        return left.join(side, on, how)
    side = side.withColumnsRenamed({c: f"_on_{c}" for c in on})
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return left.join(side, equal, how).drop(*[f"_on_{c}" for c in on])


def one_row(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a frame of exactly one row (a global aggregate) to every row."""
    return df.crossJoin(F.broadcast(stats))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
