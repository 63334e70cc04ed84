"""From raw flights, readings and stations to the train and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import bands, calendar
from tarmac.operators import encoding, history, sampling, weather
from tarmac.plans.lookup import fits_broadcast, lookup_join
from tarmac.plans.ordering import even_parts
from tarmac.plans.storage import materialize
from tarmac.sources.readers import ELEMENTS

TARGETS = ("DepDelayMinutes", "DepDel15")
# Columns that are target-encoded, and those left as they are when the rest is standardised.
ENCODED = ["Airline", "Origin", "Dest", "AirTimeCategory", "DistanceCategory"]
FLAGS = ["Holiday_Indicator", "Near_Holiday", "Weekend_Indicator", "Working_Day"]
CYCLICAL = [f"{c}_{f}" for c in calendar.PERIODS for f in ("sin", "cos")]


def clean_flights(flights: DataFrame, years: tuple[int, int] = calendar.HOLIDAY_YEARS, date: str = "FlightDate") -> DataFrame:
    """Row features in their fixed order: bands, then minutes, then cyclical and calendar columns."""
    return add_calendar(add_clock(flights), years, date)


def add_clock(flights: DataFrame) -> DataFrame:
    """Bands, and times as minutes, in which the history orders the flights of a day."""
    return bands.add_clock_minutes(bands.add_bands(flights))


def add_calendar(df: DataFrame, years: tuple[int, int] = calendar.HOLIDAY_YEARS, date: str = "FlightDate") -> DataFrame:
    """Cyclical and calendar columns, which follow from other columns of a row: no sort or shuffle needs to carry them."""
    df = calendar.add_cyclical(df.withColumn("DayOfYear", F.dayofyear(date)))
    return calendar.add_working_day(calendar.add_weekend_flag(calendar.add_holiday_flags(df, date, years)))


def with_history(
    flights: DataFrame,
    daily: DataFrame,
    tie_break: list[str],
    boundary: str = "key",
    fill: str = "none",
    airports: dict[str, DataFrame] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Weather at both ends and all trailing history.

    Same result as ``merge_weather``, ``merge_rolling_weather``, ``merge_rolling_delay`` and ``flight_history`` in a row,
    without carrying the weather columns through the sort: all flights of an airport and day share one weather row, so
    the daily tables come from one narrow aggregation over both sides, and flights meet the finished daily tables last.
    Delays are whole minutes, so trailing means come from exact running sums. ``airports`` is that of ``merge_weather``.
    Flights are sorted in parts of bounded length: ``rows`` is their number or a bound, and is counted without it.
    """
    stations = daily.select("STATION", F.col("DATE").alias("FlightDate"))
    small = fits_broadcast(stations)
    parts = even_parts(flights.sparkSession, flights.count() if rows is None else rows)
    kept = flights
    for side in ("Dest", "Origin"):
        # a side whose airports are known may be small when the whole is not
        own = (airports or {}).get(side) if not small else None
        seen = weather.weather_of(stations, own).withColumnRenamed("STATION", side)
        fits = small if own is None else fits_broadcast(seen)
        kept = _meet(kept, seen.withColumn(f"_has_{side}", F.lit(True)), side, fits, parts)
    kept = kept.filter("_has_Origin IS NOT NULL OR _has_Dest IS NOT NULL").select(*flights.columns)

    ends = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("airport")) for s in ("Origin", "Dest")])
    days = (
        kept.select("FlightDate", "DepDelayMinutes", F.explode(ends).alias("e"))
        .groupBy("e.side", "e.airport", "FlightDate")
        .agg(F.avg("DepDelayMinutes").alias("DepDelayMinutes"), F.count("*").alias("_n"))
    )
    days = materialize(days, "days")
    busiest = days.filter("side = 'Origin'").groupBy("airport").agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] or 0
    layout = "blocks" if busiest > history.HOT_ROWS else "keyed"
    if layout == "keyed":
        kept = kept.repartition(parts, "Origin")
    out = history.flight_history(kept, tie_break, fill=fill, layout=layout, whole=True)
    for side in ("Origin", "Dest"):
        today = daily.select(
            F.col("STATION").alias(side), F.col("DATE").alias("FlightDate"), *[F.col(e).alias(f"{side}_{e}") for e in ELEMENTS]
        )
        mine = days.filter(F.col("side") == side).select(F.col("airport").alias(side), "FlightDate", "DepDelayMinutes")
        mine = mine.join(today if small else today.hint("merge"), [side, "FlightDate"], "left")
        names = {f"{side}_{e}": f"{side.lower()}_{e.lower()}" for e in ELEMENTS}
        if side == "Origin":
            names["DepDelayMinutes"] = "origin_depdelayminutes"
        rolled = history.rolling_means(mine, side, "FlightDate", names, boundary=boundary)
        table = rolled.join(mine.drop("DepDelayMinutes"), [side, "FlightDate"], "left")
        table = materialize(table, f"days-{side.lower()}")
        out = _meet(out, table, side, fits_broadcast(table), parts)
    measures = [f"{s}_{e}" for s in ("Origin", "Dest") for e in ELEMENTS]
    rest = [c for c in out.columns if c not in measures and c not in flights.columns]
    return out.select(*flights.columns, *measures, *rest)


def _meet(flights: DataFrame, table: DataFrame, side: str, fits: bool, parts: int) -> DataFrame:
    """Look up a table by airport of a side and day; flights that must be shuffled for it are sorted in ``parts`` parts or more."""
    on = [side, "FlightDate"]
    if not fits:
        flights, table = flights.repartition(parts, *on), table.repartition(parts, *on)
    return lookup_join(flights, table, on, small=fits)


def training_tables(
    flights: DataFrame,
    observations: DataFrame,
    station_key: DataFrame,
    ids: list[str],
    years: tuple[int, int] = calendar.HOLIDAY_YEARS,
    boundary: str = "key",
    fill: str = "none",
    balance: str = "before",
    fit_on: str = "all",
    seed: int = 42,
    airports: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test tables: features, both targets, and the row ids (to be dropped by feature selection).

    ``balance`` runs the undersampling per year before the history (as the delay tables were made) or ``'after'`` it.
    ``fit_on`` fits the scaling on all rows or only on the train rows. ``airports`` is that of ``merge_weather``.
    """
    df = flights.withColumn("_year", F.year("FlightDate"))
    if balance == "before":
        df = materialize(sampling.undersample(df, "DepDel15", ids, per=["_year"], seed=seed), "balanced")
    daily = materialize(weather.daily_weather(observations, station_key), "weather")
    order = clean_flights(df, years).columns
    df = with_history(add_clock(df), daily, ids, boundary, fill, airports)
    order += [c for c in df.columns if c not in order]
    if balance == "after":
        df = add_calendar(materialize(df, "history"), years).select(*order)
        df = sampling.undersample(df, "DepDel15", ids, per=["_year"], seed=seed).na.drop("any")
    else:
        df = add_calendar(df.na.drop("any"), years).na.drop("any")
    df = materialize(df.select(*order).drop("_year", "FlightDate"), "complete")
    df = sampling.mark_fraction(df, 0.2, ids, seed=seed, flag="_test")
    df = materialize(df, "split")
    kept = {*ENCODED, *CYCLICAL, *FLAGS, *TARGETS, *ids, "_test"}
    scaled = [c for c in df.columns if c not in kept]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in scaled})
    basis = df if fit_on == "all" else df.filter(~F.col("_test"))
    df = encoding.standardize(df, scaled, basis)
    train, test = df.filter(~F.col("_test")).drop("_test"), df.filter("_test").drop("_test")
    return encoding.target_encode(train, test, ENCODED, "DepDel15", ids, seed=seed)
