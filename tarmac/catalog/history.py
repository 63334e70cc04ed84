"""Rolling and past-flight history, ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.base import R, merged, query, r6, side_columns
from tarmac.operators import explore as ex
from tarmac.operators import history as hx
from tarmac.sources import demo

ID = ", ".join(demo.ROW_ID)
_ORDER = f"FlightDate, CRSDepTime NULLS LAST, {ID}"
_FULL = f"Origin, {_ORDER}"


def _rolled(key: str) -> list[str]:
    return [f"{p}_avg_{n}" for p in hx.PERIODS for n in side_columns(key).values()]


def _register_weather(mode: str):
    cols = [*_rolled("Origin")]

    @query(
        f"roll_weather_{mode}",
        f"SELECT 'Origin' AS side, Origin AS airport, FlightDate, {', '.join(R(c, c.replace('origin_', '')) for c in cols)} FROM roll_origin_{mode}\n"
        f"UNION ALL SELECT 'Dest', Dest, FlightDate, {', '.join(R(c, c.replace('dest_', '')) for c in _rolled('Dest'))} FROM roll_dest_{mode}",
    )
    def roll_weather(spark, sf):
        base = merged(spark, sf)
        sides = []
        for side in ("Origin", "Dest"):
            df = hx.rolling_weather(base, side, mode)
            names = {c: c.replace(f"{side.lower()}_", "") for c in _rolled(side)}
            sides.append(
                df.select(F.lit(side).alias("side"), F.col(side).alias("airport"), "FlightDate", *[F.round(c, 6).alias(n) for c, n in names.items()])
            )
        return sides[0].unionByName(sides[1])


def _register_delay(mode: str):
    cols = [f"{p}_avg_origin_depdelayminutes" for p in hx.PERIODS]

    @query(f"roll_delay_{mode}", f"SELECT Origin, FlightDate, {', '.join(R(c) for c in cols)} FROM roll_delays_{mode}")
    def roll_delay(spark, sf):
        return r6(hx.rolling_delay(demo.flights(spark, sf), boundary=mode), *cols)


for _mode in ("key", "global"):
    _register_weather(_mode)
    _register_delay(_mode)

_PAST = [f"past_{k}_avg_delay" for k in hx.PAST_FLIGHTS]
_PAST_SQL = ", ".join(
    f"avg(DepDelayMinutes) OVER (PARTITION BY Origin ORDER BY {_ORDER} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS past_{k}_avg_delay"
    for k in hx.PAST_FLIGHTS
)
_COLS = [*demo.ROW_ID, "Origin", "FlightDate", "CRSDepTime", "DepDelayMinutes"]


@query("past_flights", f"SELECT {ID}, {', '.join(R(c) for c in _PAST)} FROM (SELECT {ID}, {_PAST_SQL} FROM flights)")
def past_flights(spark, sf):
    df = hx.flight_history(demo.flights(spark, sf).select(*_COLS), demo.ROW_ID, with_counts=False, whole=True)
    return r6(df.select(*demo.ROW_ID, *_PAST), *_PAST)


@query("past_flights_blocks", f"SELECT {ID}, {', '.join(R(c) for c in _PAST)} FROM (SELECT {ID}, {_PAST_SQL} FROM flights)")
def past_flights_blocks(spark, sf):
    """The layout for origins that hold a large share of all rows."""
    base = demo.flights(spark, sf).select(*_COLS)
    df = hx.flight_history(base, demo.ROW_ID, layout="blocks", with_counts=False, at_least=5000, whole=True)
    return r6(df.select(*demo.ROW_ID, *_PAST), *_PAST)


_FILLED = ", ".join(
    f"coalesce(first_value({c} IGNORE NULLS) OVER (ORDER BY {_FULL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY {_FULL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS {c}"
    for c in _PAST
)


@query(
    "past_flights_filled",
    f"SELECT {ID}, {', '.join(R(c) for c in _PAST)} FROM (SELECT {ID}, {_FILLED} FROM (SELECT {ID}, Origin, FlightDate, CRSDepTime, {_PAST_SQL} FROM flights))",
)
def past_flights_filled(spark, sf):
    base = demo.flights(spark, sf).select(*_COLS)
    df = hx.flight_history(base, demo.ROW_ID, fill="reference", with_counts=False, whole=True)
    return r6(df.select(*demo.ROW_ID, *_PAST), *_PAST)


_SEEN = f"SELECT {ID}, CAST(row_number() OVER (PARTITION BY Origin, FlightDate ORDER BY CRSDepTime NULLS LAST, {ID}) - 1 AS BIGINT) AS cumulative_flights_before FROM flights"


@query("cumulative_flights", _SEEN)
def cumulative_flights(spark, sf):
    df = hx.flight_history(demo.flights(spark, sf).select(*_COLS), demo.ROW_ID, frames=())
    return df.select(*demo.ROW_ID, "cumulative_flights_before")


@query("cumulative_flights_blocks", _SEEN)
def cumulative_flights_blocks(spark, sf):
    base = demo.flights(spark, sf).select(*_COLS)
    df = hx.flight_history(base, demo.ROW_ID, frames=(10,), layout="blocks", at_least=5000)
    return df.select(*demo.ROW_ID, "cumulative_flights_before")


@query(
    "ffill_bfill",
    """
WITH daily AS (SELECT Dest, FlightDate, avg(Dest_TMAX) AS tmax, avg(Dest_TMIN) AS tmin FROM merged GROUP BY ALL),
ahead AS (SELECT Dest, FlightDate, last_value(tmax IGNORE NULLS) OVER w AS tmax, last_value(tmin IGNORE NULLS) OVER w AS tmin
  FROM daily WINDOW w AS (PARTITION BY Dest ORDER BY FlightDate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
back AS (SELECT Dest, FlightDate, last_value(tmax IGNORE NULLS) OVER w AS tmax, last_value(tmin IGNORE NULLS) OVER w AS tmin
  FROM ahead WINDOW w AS (PARTITION BY Dest ORDER BY FlightDate DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT Dest, FlightDate, round(tmax, 6) + 0 AS tmax, round(tmin, 6) + 0 AS tmin FROM back""",
)
def ffill_bfill(spark, sf):
    base = merged(spark, sf).withColumnsRenamed({"Dest_TMAX": "tmax", "Dest_TMIN": "tmin"})
    daily = hx.daily_mean(base, "Dest", "FlightDate", ["tmax", "tmin"])
    return r6(hx.fill_gaps(daily, "Dest", "FlightDate", ["tmax", "tmin"]), "tmax", "tmin")


@query(
    "airport_congestion",
    f"SELECT {ID}, Origin, count(DepDelay) OVER (PARTITION BY Origin, isodow(FlightDate)) AS AirportCongestion FROM flights",
)
def airport_congestion(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "Origin", "DepDelay", (F.weekday("FlightDate") + 1).alias("DayOfWeek"))
    df = hx.group_size(df, ["Origin", "DayOfWeek"], "DepDelay", "AirportCongestion")
    return df.select(*demo.ROW_ID, "Origin", "AirportCongestion")


_DELAYED = "SELECT Airline, Origin, count(*) AS delays FROM flights WHERE DepDelayMinutes > 0 GROUP BY ALL"


@query(
    "avg_rank",
    f"""
WITH d AS ({_DELAYED})
SELECT Airline, Origin, delays, rank() OVER (PARTITION BY Airline ORDER BY delays DESC)
  + (count(*) OVER (PARTITION BY Airline, delays) - 1) / 2.0::DOUBLE AS rank FROM d""",
)
def avg_rank(spark, sf):
    d = demo.flights(spark, sf).filter("DepDelayMinutes > 0").groupBy("Airline", "Origin").agg(F.count("*").alias("delays"))
    return ex.rank_average(d, "delays", ["Airline"])


@query(
    "top5_per_group",
    f"""
WITH d AS ({_DELAYED})
SELECT * FROM (SELECT Airline, Origin, delays, CAST(row_number() OVER (PARTITION BY Airline ORDER BY delays DESC, Origin) AS INT) AS place FROM d) WHERE place <= 5""",
)
def top5_per_group(spark, sf):
    d = demo.flights(spark, sf).filter("DepDelayMinutes > 0").groupBy("Airline", "Origin").agg(F.count("*").alias("delays"))
    return ex.top_per_group(d, ["Airline"], "delays", ["Origin"])


@query(
    "sort_multi",
    f"SELECT {ID}, CAST(row_number() OVER (ORDER BY {_FULL}) - 1 AS BIGINT) AS position FROM flights",
)
def sort_multi(spark, sf):
    from tarmac.plans.ordering import global_index

    base = demo.flights(spark, sf).select(*demo.ROW_ID, "Origin", "FlightDate", "CRSDepTime")
    order = [F.col(c).asc_nulls_last() for c in ("Origin", "FlightDate", "CRSDepTime", *demo.ROW_ID)]
    return global_index(base, order, "position").select(*demo.ROW_ID, "position")


@query(
    "top_k",
    f"SELECT {ID}, Distance, DepDelayMinutes FROM flights ORDER BY Distance DESC NULLS LAST, {ID} LIMIT 10",
)
def top_k(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "Distance", "DepDelayMinutes")
    return df.orderBy(F.desc_nulls_last("Distance"), *demo.ROW_ID).limit(10)
