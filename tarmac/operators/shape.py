"""Row filters, projections and small joins."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.plans.lookup import lookup_join


def class_split(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows of class 1 and of class 0; a null class is in neither."""
    return df.filter(F.col(target) == 1), df.filter(F.col(target) == 0)


def delayed(df: DataFrame, cols: tuple[str, ...] = ("DepDelay", "ArrDelay")) -> DataFrame:
    """Rows late in any of ``cols``."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) > 0 for c in cols]))


def route_year(df: DataFrame, date: str, year: int | None = None, origin: str | None = None, dest: str | None = None) -> DataFrame:
    """Rows of a year and route. The year is a date range, which a parquet scan can skip by."""
    if year is not None:
        df = df.filter(F.col(date).between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")))
    if origin is not None:
        df = df.filter(F.col("Origin") == origin)
    return df if dest is None else df.filter(F.col("Dest") == dest)


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows without any null or NaN."""
    return df.na.drop("any")


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows before and after dropping duplicates, in one pass of map-side combined counts."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("before_rows"), F.count("*").alias("after_rows")
    )


def distinct_on(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in cols.items()]).distinct()


def locations(df: DataFrame) -> DataFrame:
    """All airport codes seen as origin or destination."""
    return df.select(F.explode(F.array("Origin", "Dest")).alias("Location")).distinct()


def feature_names(columns: list[str], exclude: list[str], target: str) -> list[str]:
    return [c for c in columns if c not in exclude and c != target]


def sum_of(*cols: str) -> Column:
    """Sum of columns, null when any part is null."""
    return reduce(add, [F.col(c) for c in cols])


def with_coordinates(airports: DataFrame, places: DataFrame) -> DataFrame:
    """Airports with their coordinates (null when unknown), sorted by code."""
    return lookup_join(airports, places, ["Location"]).orderBy(F.col("Location").asc_nulls_last())
