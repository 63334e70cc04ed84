"""Bands, bins, clock times and target transforms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper limits (exclusive) of the bands; the band number is stored as text.
AIRTIME_LIMITS = (120, 360)
DISTANCE_LIMITS = (500, 2500)
CLOCK_LIMITS = (600, 1200, 1800)
# Right-closed bins and their labels.
DELAY_BINS = ((-10, 0, 15, 300), ("On-time", "Moderate Delay", "Severe Delay"))
DISTANCE_BINS = ((0, 500, 1500, 3000), ("Short", "Medium", "Long"))
CLOCK_LABELS = ("Early Morning", "Morning", "Afternoon", "Evening")


def band(value: Column | str, limits: tuple[float, ...], missing: str = "Unknown") -> Column:
    """Band number as text: below the first limit is "0"; a null value gives ``missing``."""
    value = F.col(value) if isinstance(value, str) else value
    out = F.when(value.isNull(), missing)
    for number, limit in enumerate(limits):
        out = out.when(value < limit, str(number))
    return out.otherwise(str(len(limits)))


def clock_label(value: Column | str) -> Column:
    """Name of the part of the day of an HHMM number; a missing time falls to the last label."""
    value = F.col(value) if isinstance(value, str) else value
    out = F
    for limit, label in zip(CLOCK_LIMITS, CLOCK_LABELS):
        out = out.when(value < limit, label)
    return out.otherwise(CLOCK_LABELS[-1])


def right_closed(value: Column | str, edges: tuple[float, ...], labels: tuple[str, ...]) -> Column:
    """Label of the bin (edge, next edge] that holds the value, null outside."""
    value = F.col(value) if isinstance(value, str) else value
    out = F
    for low, high, label in zip(edges, edges[1:], labels):
        out = out.when((value > low) & (value <= high), label)
    return out


def clock_minutes(value: Column | str) -> Column:
    """Minutes after midnight of an HHMM number, null when it is not a time of day."""
    value = F.col(value) if isinstance(value, str) else value
    hours, minutes = F.floor(value / 100), value % 100
    return F.when((minutes < 60) & (hours < 24), hours * 60 + minutes).cast("int")


def severe(value: Column | str, limit: float = 60) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value > limit, F.lit(False)).cast("int")


def add_bands(df: DataFrame) -> DataFrame:
    """AirTimeCategory, DistanceCategory and TimeofDay; run before clock times become minutes."""
    return df.withColumns(
        {
            "AirTimeCategory": band("AirTime", AIRTIME_LIMITS),
            "DistanceCategory": band("Distance", DISTANCE_LIMITS),
            "TimeofDay": band("CRSDepTime", CLOCK_LIMITS),
        }
    )


def add_clock_minutes(df: DataFrame, cols: tuple[str, ...] = ("CRSDepTime", "CRSArrTime")) -> DataFrame:
    return df.withColumns({c: clock_minutes(c) for c in cols})


def finite(value: Column) -> Column:
    """Null for NaN and infinite values."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def target_transforms(df: DataFrame, target: str) -> DataFrame:
    """Transformed targets: log and root after a shift by the minimum, reciprocal of the log, clipped at zero, log1p."""
    y = F.col(target).cast("double")
    low = df.agg(F.min(y).alias("_low"))
    shifted = y - F.col("_low") + 1
    floor = F.when(y <= 1e-5, F.lit(1e-5)).otherwise(y)
    out = {
        "y_log": finite(F.log1p(shifted)),
        "y_sqrt": finite(F.sqrt(shifted)),
        "y_recip": finite(F.lit(1.0) / F.log1p(floor)),
        "y_clip": F.greatest(y, F.when(y.isNotNull(), 0.0)),
        "y_log1p": F.log1p(F.greatest(y, F.when(y.isNotNull(), 0.0))),
    }
    return df.crossJoin(F.broadcast(low)).withColumns(out).drop("_low")
