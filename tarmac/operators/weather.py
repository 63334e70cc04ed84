"""Daily weather: from long station readings to one row per airport and day, and its join to flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.lookup import lookup_join
from tarmac.sources.readers import ELEMENTS, ZERO_FILLED


def unique_stations(station_key: DataFrame) -> DataFrame:
    """One airport per station; the last line wins, so mapping never multiplies rows."""
    return station_key.groupBy(F.col("Closest_Station").alias("STATION")).agg(F.max_by("Airport", "line").alias("Airport"))


def filter_stations(obs: DataFrame, station_key: DataFrame) -> DataFrame:
    """Keep readings of stations in the lookup."""
    stations = station_key.select(F.col("Closest_Station").alias("STATION")).distinct()
    return lookup_join(obs, stations, ["STATION"], "left_semi")


def filter_elements(obs: DataFrame, elements: tuple[str, ...] = ELEMENTS) -> DataFrame:
    return obs.filter(F.col("ELEMENT").isin(*elements))


def map_station(obs: DataFrame, station_key: DataFrame) -> DataFrame:
    """Replace the station id by the airport code; readings of other stations drop out."""
    joined = lookup_join(obs, unique_stations(station_key), ["STATION"], "inner")
    return joined.withColumn("STATION", F.col("Airport")).select(*obs.columns)


def parse_day(text: str = "DATE", fmt: str = "yyyyMMdd"):
    return F.to_date(F.col(text), fmt)


def pivot_weather(obs: DataFrame, elements: tuple[str, ...] = ELEMENTS) -> DataFrame:
    """First non-null value per (STATION, DATE) and element, in ``obs_order``.

    One aggregation with a column per element of the fixed list: partial results are combined before the one shuffle,
    an element that never occurs still has its (null) column, and groups without any value do not appear.
    """
    usable = obs.filter(F.col("VALUE").isNotNull() & F.col("ELEMENT").isin(*elements))

    def first_of(e: str):
        return F.min_by("VALUE", F.when(F.col("ELEMENT") == e, F.col("obs_order"))).alias(e)

    return usable.groupBy("STATION", "DATE").agg(*[first_of(e) for e in elements])


def zero_fill(weather: DataFrame, columns: tuple[str, ...] = ZERO_FILLED) -> DataFrame:
    return weather.fillna(0.0, list(columns))


def daily_weather(obs: DataFrame, station_key: DataFrame) -> DataFrame:
    """The whole weather stage: membership, elements, airport code, day, pivot, zero fill."""
    mapped = map_station(filter_elements(obs), station_key).withColumn("DATE", parse_day())
    return zero_fill(pivot_weather(mapped))


def weather_of(weather: DataFrame, airports: DataFrame | None) -> DataFrame:
    """The weather of some airports (column ``Airport``); all of it without them."""
    if airports is None:
        return weather
    return lookup_join(weather, airports.select(F.col("Airport").alias("STATION")).distinct(), ["STATION"], "left_semi")


def merge_weather(flights: DataFrame, weather: DataFrame, elements: tuple[str, ...] = ELEMENTS, airports: dict[str, DataFrame] | None = None) -> DataFrame:
    """Attach origin and destination weather of the day; keep a flight when at least one side was found.

    ``weather`` holds one row per airport and day and is read twice, so give it written or cheap to compute. ``airports`` may name, for
    a side, all airports that occur at it: when their weather is small, flights are not shuffled for that side.
    """
    out = flights
    for side in ("Origin", "Dest"):
        side_weather = weather_of(weather, (airports or {}).get(side)).select(
            F.col("STATION").alias(side),
            F.col("DATE").alias("FlightDate"),
            *[F.col(e).alias(f"{side}_{e}") for e in elements],
            F.lit(True).alias(f"_has_{side}"),
        )
        out = lookup_join(out, side_weather, [side, "FlightDate"])
    found = F.col("_has_Origin").isNotNull() | F.col("_has_Dest").isNotNull()
    measures = [f"{side}_{e}" for side in ("Origin", "Dest") for e in elements]
    return out.filter(found).select(*flights.columns, *measures)
