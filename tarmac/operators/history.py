"""Trailing history: rolling daily means, past-flight means, flights before on the same day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.plans.lookup import lookup_join
from tarmac.plans.ordering import block_rows, fill_along, global_index, with_halo
from tarmac.plans.storage import materialize
from tarmac.sources.readers import ELEMENTS

# Names and lengths (in rows) of the rolling frames, and the past-flight frames.
PERIODS = {"weekly": 7, "monthly": 30}
PAST_FLIGHTS = (10, 50, 100)
HOT_ROWS = 2_000_000


def daily_mean(df: DataFrame, key: str, date: str, cols: list[str]) -> DataFrame:
    return df.groupBy(key, date).agg(*[F.avg(c).alias(c) for c in cols])


def fill_gaps(df: DataFrame, key: str, date: str, cols: list[str]) -> DataFrame:
    """Per key: carry the last value forward, then the first one back. For tables with one row per key and day."""
    ahead = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(key).orderBy(F.col(date).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({c: F.last(c, True).over(ahead) for c in cols})
    return out.withColumns({c: F.last(c, True).over(back) for c in cols})


def rolling_means(
    daily: DataFrame,
    key: str,
    date: str,
    cols: dict[str, str],
    periods: dict[str, int] | None = None,
    boundary: str = "key",
    at_least: int = 100_000,
) -> DataFrame:
    """Mean of the previous rows of a daily table, current day excluded; returns key, date and the new columns.

    ``cols`` maps a source column to the suffix of its new names, ``{period}_avg_{suffix}``. ``boundary='key'`` stays
    inside a key; ``'global'`` lets the first days of a key look back into the key before it in sort order.
    """
    periods = periods or PERIODS
    filled = fill_gaps(daily.select(key, date, *cols), key, date, list(cols))
    if boundary == "key":
        window = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last())
        base = filled
    elif boundary == "global":
        indexed = global_index(filled, [F.col(key).asc_nulls_last(), F.col(date).asc_nulls_last()])
        width = max(periods.values())
        base = with_halo(indexed, max(width, block_rows(indexed, at_least)), width)
        window = Window.partitionBy("_block").orderBy("gidx")
    else:
        raise ValueError("boundary is 'key' or 'global'")
    means = [
        F.avg(c).over(window.rowsBetween(-w, -1)).alias(f"{p}_avg_{suffix}")
        for p, w in periods.items()
        for c, suffix in cols.items()
    ]
    own = ["_own"] if boundary == "global" else []
    out = base.select(key, date, *own, *means)
    return out.filter("_own").drop("_own") if own else out


def rolling_weather(merged: DataFrame, side: str, boundary: str = "key", date: str = "FlightDate") -> DataFrame:
    """Rolling means of the five weather measures of one side (``Origin`` or ``Dest``)."""
    cols = {f"{side}_{e}": f"{side.lower()}_{e.lower()}" for e in ELEMENTS}
    return rolling_means(daily_mean(merged, side, date, list(cols)), side, date, cols, boundary=boundary)


def rolling_delay(
    flights: DataFrame, cols: tuple[str, ...] = ("DepDelayMinutes",), boundary: str = "key", date: str = "FlightDate"
) -> DataFrame:
    names = {c: f"origin_{c.lower()}" for c in cols}
    return rolling_means(daily_mean(flights, "Origin", date, list(cols)), "Origin", date, names, boundary=boundary)


def merge_rolling_weather(merged: DataFrame, boundary: str = "key") -> DataFrame:
    out = merged
    for side in ("Origin", "Dest"):
        table = materialize(rolling_weather(merged, side, boundary), f"rolling-{side.lower()}")
        out = lookup_join(out, table, [side, "FlightDate"])
    return out


def merge_rolling_delay(flights: DataFrame, boundary: str = "key") -> DataFrame:
    table = materialize(rolling_delay(flights, boundary=boundary), "rolling-delay")
    return lookup_join(flights, table, ["Origin", "FlightDate"])


def has_hot_key(df: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> bool:
    """True when one key holds more rows than a single task should sort."""
    return bool(df.groupBy(*keys).count().filter(F.col("count") > limit).limit(1).count())


def flight_history(
    df: DataFrame,
    tie_break: list[str],
    column: str = "DepDelayMinutes",
    frames: tuple[int, ...] = PAST_FLIGHTS,
    fill: str = "none",
    layout: str = "auto",
    at_least: int = 100_000,
    with_counts: bool = True,
    whole: bool = False,
) -> DataFrame:
    """Mean of the previous k values at the same origin, and flights earlier on the same day at it.

    Order: origin, day, scheduled time, then ``tie_break`` (needed for a total order). ``layout='keyed'`` sorts each
    origin in one task with a single shuffle; ``'blocks'`` works in even blocks with a halo, for origins that hold a
    large share of all rows; ``'auto'`` counts rows per origin and chooses. ``fill='reference'`` also fills missing means
    from the next row, else the row before, across origins; on the first flight this reveals its own delay.

    Integers, decimals and, with ``whole``, doubles that hold whole numbers (others are an error) are averaged by differences of
    exact running sums, at the same cost for any frame; other doubles by adding up each frame.
    """
    in_day = [F.col(c).asc_nulls_last() for c in ("CRSDepTime", *tie_break)]
    # plain ascending keys: the day window then needs no second sort (flights without a day have no order to keep)
    by_time = [F.col("FlightDate").asc(), *in_day]
    order = [F.col("Origin").asc(), *by_time]
    if layout == "auto":
        layout = "blocks" if has_hot_key(df, ["Origin"]) else "keyed"
    names = {k: f"past_{k}_avg_delay" for k in frames}
    counts = ["cumulative_flights_before"] if with_counts else []

    exact = _exact(df, column, whole)

    def with_means(rows: DataFrame, window, more: list[Column]) -> DataFrame:
        if exact is None:
            return rows.select("*", *[F.avg(column).over(window.rowsBetween(-k, -1)).alias(n) for k, n in names.items()], *more)
        so_far = window.rowsBetween(Window.unboundedPreceding, 0)
        sums = rows.select("*", F.coalesce(F.sum(exact).over(so_far), F.lit(0).cast(rows.select(exact).dtypes[0][1])).alias("_sum"), F.count(column).over(so_far).alias("_known"), *more)

        def inside(c: str, k: int) -> Column:
            return F.coalesce(F.lag(c, 1).over(window), F.lit(0)) - F.coalesce(F.lag(c, k + 1).over(window), F.lit(0))

        apart = sums.select("*", *[inside(c, k).alias(f"{c}_{k}") for k in names for c in ("_sum", "_known")])
        kept = [c for c in sums.columns if c not in ("_sum", "_known")]
        return apart.select(*kept, *[(F.col(f"_sum_{k}").cast("double") / F.nullif(F.col(f"_known_{k}"), F.lit(0).cast("long"))).alias(n) for k, n in names.items()])

    if layout == "keyed":
        window = Window.partitionBy("Origin").orderBy(*by_time)
        same_day = Window.partitionBy("Origin", "FlightDate").orderBy(*in_day)
        seen = [(F.row_number().over(same_day) - 1).cast("long").alias(c) for c in counts]
        out = with_means(df, window, seen)
        if fill == "reference":
            out = global_index(out, order)
    elif layout == "blocks":
        indexed = global_index(df, order)
        width = max(frames)
        halo = with_halo(indexed, max(width, block_rows(indexed, at_least)), width)
        window = Window.partitionBy("_block", "Origin").orderBy("gidx")
        out = with_means(halo.select(*df.columns, "gidx", "_own", "_block"), window, []).filter("_own").drop("_own", "_block")
        if counts:
            starts = materialize(indexed.groupBy("Origin", "FlightDate").agg(F.min("gidx").alias("_first")), "day-start")
            out = lookup_join(out, starts, ["Origin", "FlightDate"], null_safe=True).withColumn(counts[0], F.col("gidx") - F.col("_first"))
        if fill == "reference":
            out = materialize(out, "past-means")
    else:
        raise ValueError("layout is 'auto', 'keyed' or 'blocks'")
    if fill == "reference":
        out = fill_along(out, list(names.values()), at_least)
    elif fill != "none":
        raise ValueError("fill is 'none' or 'reference'")
    return out.select(*df.columns, *names.values(), *counts)


def _exact(df: DataFrame, column: str, whole: bool) -> Column | None:
    """The column as a number whose sums are exact, or None."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(column)
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    if not whole:
        return None
    broken = F.col(column) != F.floor(column)
    return F.when(broken, F.raise_error(F.lit(f"{column} holds values that are not whole")).cast("long")).otherwise(F.col(column).cast("long"))


def group_size(df: DataFrame, keys: list[str], column: str | None = None, name: str = "group_size") -> DataFrame:
    """Rows (or non-null values) of a row's group on each row, by a map-side combined count joined back.

    Keys must not be null; a group of any size is never gathered in one task.
    """
    counts = materialize(df.groupBy(*keys).agg(F.count(column or "*").alias(name)), "group-size")
    return lookup_join(df, counts, keys)
