"""Query registry and the shared pieces of the checking SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import weather as wx
from tarmac.plans.storage import materialize
from tarmac.sources import demo
from tarmac.sources.readers import ELEMENTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_first = ",\n  ".join(
    f"min_by(VALUE, obs_order) FILTER (WHERE ELEMENT = '{e}' AND VALUE IS NOT NULL) AS {e}" for e in ELEMENTS
)
_zeroed = ", ".join(f"coalesce({e}, 0.0::DOUBLE) AS {e}" if e in ("PRCP", "SNOW", "SNWD") else e for e in ELEMENTS)
_sides = ", ".join(f"{p}.{e} AS {s}_{e}" for s, p in (("Origin", "wo"), ("Dest", "wd")) for e in ELEMENTS)


def rolling_sql(source: str, key: str, cols: dict[str, str], boundary: str) -> str:
    """Checking SQL of the rolling means of a daily table (key, FlightDate, columns)."""
    part = f"PARTITION BY {key} " if boundary == "key" else ""
    day = "ORDER BY FlightDate"
    ahead = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {key} {day} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in cols)
    back = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {key} {day} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in cols)
    means = ", ".join(
        f"avg({c}) OVER ({part}ORDER BY {key}, FlightDate ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS {p}_avg_{n}"
        for p, w in (("weekly", 7), ("monthly", 30))
        for c, n in cols.items()
    )
    return f"""
SELECT {key}, FlightDate, {means}
FROM (SELECT {key}, FlightDate, {back}
      FROM (SELECT {key}, FlightDate, {ahead} FROM ({source})))"""


def daily_sql(key: str, cols: list[str], source: str) -> str:
    return f"SELECT {key}, FlightDate, {', '.join(f'avg({c}) AS {c}' for c in cols)} FROM {source} GROUP BY ALL"


def side_columns(side: str) -> dict[str, str]:
    return {f"{side}_{e}": f"{side.lower()}_{e.lower()}" for e in ("TMIN", "TMAX", "PRCP", "SNOW", "SNWD")}


VIEWS = {
    **demo.DUCK_VIEWS,
    "key_obs": """
SELECT k.Airport AS STATION, o.DATE, o.ELEMENT, o.VALUE, o.obs_order
FROM observations o JOIN station_key k ON o.STATION = k.Closest_Station""",
    "pivoted": f"""
SELECT STATION, CAST(strptime(DATE, '%Y%m%d') AS DATE) AS DATE,
  {_first}
FROM key_obs WHERE VALUE IS NOT NULL GROUP BY ALL""",
    "weather": f"SELECT STATION, DATE, {_zeroed} FROM pivoted",
    "merged": f"""
SELECT f.*, {_sides}
FROM flights f
LEFT JOIN weather wo ON f.Origin = wo.STATION AND f.FlightDate = wo.DATE
LEFT JOIN weather wd ON f.Dest = wd.STATION AND f.FlightDate = wd.DATE
WHERE wo.STATION IS NOT NULL OR wd.STATION IS NOT NULL""",
}
for _side in ("Origin", "Dest"):
    for _mode in ("key", "global"):
        VIEWS[f"roll_{_side.lower()}_{_mode}"] = rolling_sql(
            daily_sql(_side, list(side_columns(_side)), "merged"), _side, side_columns(_side), _mode
        )
for _mode in ("key", "global"):
    VIEWS[f"roll_delays_{_mode}"] = rolling_sql(
        daily_sql("Origin", ["DepDelayMinutes"], "flights"), "Origin", {"DepDelayMinutes": "origin_depdelayminutes"}, _mode
    )


def duck(body: str) -> str:
    """Complete SQL: the body, preceded by the shared views it uses."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(view)
                if name not in needed:
                    needed.append(name)

    visit(body)
    body = body.strip()
    if not needed:
        return body
    head = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None):
    """Register a query function under ``name`` with its checking SQL."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = duck(sql)
        return fn

    return add


def r6(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round computed doubles (half away from zero), so that summation order does not show.

    Plain arithmetic, as in the checking SQL; the built-in decimal rounding is many times slower on wide results.
    """
    unit = F.lit(10.0**digits)
    return df.withColumns({c: F.signum(c) * F.floor(F.abs(c) * unit + 0.5) / unit + F.lit(0.0) for c in cols})


def R(expr: str, name: str | None = None, digits: int = 6) -> str:
    """The same in the checking SQL; adding zero turns -0.0 into 0.0."""
    return f"round({expr}, {digits}) + 0 AS {name or expr}"


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = wx.daily_weather(demo.observations(spark, sf_dir), demo.station_key(spark, sf_dir))
    return materialize(daily, "weather")


def arrivals(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Airports by side, where they can be had without joining the flights."""
    return {"Dest": materialize(demo.destinations(spark, sf_dir), "arrivals")}


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wx.merge_weather(demo.flights(spark, sf_dir), weather(spark, sf_dir), airports=arrivals(spark, sf_dir))
