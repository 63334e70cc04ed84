"""Joins whose small side is sent to all tasks only after its size was checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.plans.storage import materialize

#: Estimated bytes up to which a side may be broadcast.
BROADCAST_BYTES = 64 << 20


def small_enough(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def sized(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if a count shows that it is small; Spark's own choice otherwise."""
    return F.broadcast(df) if small_enough(df.count(), row_bytes) else df


def keep_or_drop(rows: DataFrame, keys: DataFrame, on: list[str], keep: bool, row_bytes: int = 64) -> DataFrame:
    """Rows whose (null-safe) key is in ``keys``, or is not. A large key table is joined by sorted merge."""
    other = sized(keys.select(*[F.col(c).alias(f"_k_{c}") for c in on]), row_bytes)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in on])
    return rows.join(other, same, "left_semi" if keep else "left_anti")


#: Columns that identify a row's document: its id and two hashes of its text.
KEYS = ["_id", "_h1", "_h2"]


def key_columns(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Whole rows as ``_row`` beside their keys, so that no column name of ``docs`` can clash."""
    return docs.select(*key_columns(id_col, text_col), F.struct(*docs.columns).alias("_row"))


def _split_repeats(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Keyed rows whose key is not in ``keys``, and one row for each key that is (None if there are none)."""
    rows = keyed(docs, id_col, text_col)
    if keys.isEmpty():
        return rows, None
    once = keep_or_drop(rows, keys, KEYS, keep=True, row_bytes=32).groupBy(*KEYS).agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return keep_or_drop(rows, keys, KEYS, keep=False, row_bytes=32), once


def kept_rows(docs: DataFrame, judged: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose key has a kept row in ``judged`` (keys and ``_kept``, one row per row of ``docs`` that was
    compared with others); a key that occurs several times gives one row."""
    per_key = judged.groupBy(*KEYS).agg(F.max("_kept").alias("_any"), F.count("*").alias("_n")).where("not _any or _n > 1")
    per_key = materialize(per_key, "decisions")
    rest = per_key.where("not _any").select(*KEYS)
    single, once = _split_repeats(docs, per_key.where("_any").select(*KEYS), id_col, text_col)
    out = keep_or_drop(single, rest, KEYS, keep=False, row_bytes=32)
    out = out.select("_row") if once is None else out.select("_row").union(once.select("_row"))
    return out.select("_row.*")
