"""Calendar columns and the public-holiday dimension."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.lookup import lookup_join

# The years and the distance in days used by the delay tables.
HOLIDAY_YEARS = (2018, 2022)
NEAR_DAYS = 3
WEEKEND_DAYS = (1, 7)
# Periods of the cyclical columns. 2358 is kept for equal results although the times are minutes by then
# (1440 would close the circle), likewise 365 for leap years.
PERIODS = {"CRSDepTime": 2358, "CRSArrTime": 2358, "DayOfYear": 365, "DayOfWeek": 7, "Month": 12}

# Fixed-date federal holidays (month, day, first year).
_FIXED = [("New Year", 1, 1, 1), ("Juneteenth", 6, 19, 2021), ("Independence", 7, 4, 1), ("Veterans", 11, 11, 1), ("Christmas", 12, 25, 1)]
# Floating ones (month, weekday with Monday = 1, which one; -1 for the last).
_FLOATING = [
    ("Martin Luther King", 1, 1, 3),
    ("Presidents", 2, 1, 3),
    ("Memorial", 5, 1, -1),
    ("Labor", 9, 1, 1),
    ("Columbus", 10, 1, 2),
    ("Thanksgiving", 11, 4, 4),
]


def monday_first(date: Column) -> Column:
    """Weekday 1 (Monday) to 7 (Sunday)."""
    return F.weekday(date) + 1


def calendar_parts(df: DataFrame, date: str) -> DataFrame:
    """Add Year, Month, DayOfWeek and DayOfYear of ``date``."""
    d = F.col(date)
    return df.withColumns(
        {"Year": F.year(d), "Month": F.month(d), "DayOfWeek": monday_first(d), "DayOfYear": F.dayofyear(d)}
    )


def holidays(spark: SparkSession, years: tuple[int, int] = HOLIDAY_YEARS) -> DataFrame:
    """Federal holidays (one column ``holiday``) of ``years`` inclusive, with observed days of fixed-date ones.

    An observed day counts when it falls in a listed year: Friday for a Saturday, Monday for a Sunday.
    """
    # one year past the end, because its New Year may be observed on the last Friday of December
    span = spark.range(years[0], years[1] + 2).select(F.col("id").cast("int").alias("y"))
    rules = F.array(
        *[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(0).alias("wd"), F.lit(0).alias("nth"), F.lit(first).alias("since")) for _, m, d, first in _FIXED],
        *[F.struct(F.lit(m).alias("m"), F.lit(1).alias("d"), F.lit(wd).alias("wd"), F.lit(nth).alias("nth"), F.lit(1).alias("since")) for _, m, wd, nth in _FLOATING],
    )
    base = span.select("y", F.explode(rules).alias("r")).filter("y >= r.since")
    start = F.make_date("y", "r.m", "r.d")
    # first wanted weekday on or after the 1st, then whole weeks; the last one by stepping back from the month's end
    nth_day = F.date_add(start, (F.col("r.wd") - monday_first(start) + 7) % 7 + (F.col("r.nth") - 1) * 7)
    month_end = F.last_day(start)
    last_day = F.date_sub(month_end, (monday_first(month_end) - F.col("r.wd") + 7) % 7)
    actual = F.when(F.col("r.wd") == 0, start).when(F.col("r.nth") > 0, nth_day).otherwise(last_day)
    shift = F.when(F.col("r.wd") != 0, 0).when(monday_first(start) == 6, -1).when(monday_first(start) == 7, 1).otherwise(0)
    days = base.select(F.explode(F.array(actual, F.date_add(actual, shift))).alias("holiday"))
    return days.filter(F.year("holiday").between(*years)).distinct()


def add_holiday_flags(
    df: DataFrame, date: str, years: tuple[int, int] = HOLIDAY_YEARS, near_days: int = NEAR_DAYS
) -> DataFrame:
    """Add Holiday_Indicator and Near_Holiday (0/1). Only holidays of ``years`` count."""
    near = holidays(df.sparkSession, years).select(
        "holiday", F.explode(F.expr(f"sequence(holiday - {near_days}, holiday + {near_days})")).alias(date)
    )
    dim = near.groupBy(date).agg(F.max((F.col("holiday") == F.col(date)).cast("int")).alias("_hol"))
    out = lookup_join(df, dim, [date])
    flags = {"Holiday_Indicator": F.coalesce("_hol", F.lit(0)), "Near_Holiday": F.col("_hol").isNotNull().cast("int")}
    return out.withColumns(flags).select(*[c for c in df.columns if c not in flags], *flags)


def add_weekend_flag(df: DataFrame, day: str = "DayOfWeek", weekend: tuple[int, ...] = WEEKEND_DAYS) -> DataFrame:
    return df.withColumn("Weekend_Indicator", F.coalesce(F.col(day).isin(*weekend), F.lit(False)).cast("int"))


def add_working_day(df: DataFrame) -> DataFrame:
    off = (F.col("Weekend_Indicator") == 1) | (F.col("Holiday_Indicator") == 1)
    return df.withColumn("Working_Day", F.when(off, 0).otherwise(1))


def add_cyclical(df: DataFrame, periods: dict[str, float] | None = None) -> DataFrame:
    """Add ``{c}_sin`` and ``{c}_cos`` for each column of ``periods`` that exists."""
    wanted = {c: p for c, p in (periods or PERIODS).items() if c in df.columns}
    angle = {c: F.lit(2 * math.pi) * F.col(c) / F.lit(float(p)) for c, p in wanted.items()}
    return df.withColumns({f"{c}_{n}": fn(a) for c, a in angle.items() for n, fn in (("sin", F.sin), ("cos", F.cos))})
