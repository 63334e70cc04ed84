"""Scans, sinks, filters, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.base import R, arrivals, merged, query, r6, weather
from tarmac.operators import history as hx
from tarmac.operators import nearest as nx
from tarmac.operators import shape as sx
from tarmac.operators import weather as wx
from tarmac.plans.storage import stage_path
from tarmac.sources import demo
from tarmac.sources import readers as rd

ID = ", ".join(demo.ROW_ID)


@query("scan_project", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day, l_quantity FROM lineitem")
def scan_project(spark, sf):
    df = rd.scan_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"])
    return df.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_day"), "l_quantity")


@query("scan_observations", "SELECT STATION, DATE, ELEMENT, VALUE FROM observations")
def scan_observations(spark, sf):
    path = stage_path(spark, "observations-csv")
    obs = demo.observations(spark, sf).withColumn("note", F.lit("x")).drop("obs_order")
    obs.write.csv(path, header=True, compression="gzip")
    return rd.scan_observations(spark, path).drop("obs_order")


@query("station_lookup", "SELECT Airport, Closest_Station FROM station_key")
def station_lookup(spark, sf):
    path = stage_path(spark, "station-csv")
    rd.write_csv(demo.station_key(spark, sf).select("Airport", "Closest_Station"), path)
    return rd.scan_station_key(spark, path).drop("line")


@query(
    "year_from_name",
    """
WITH names AS (SELECT o_orderkey, 'extracted_' || year(o_orderdate) || '_' || (2000 + o_orderkey % 40) || '.parquet' AS file_name FROM orders),
years AS (SELECT list(CAST(y AS VARCHAR)) AS ys FROM range(2000, 2030) t(y))
SELECT o_orderkey, file_name, coalesce(list_min(list_filter(ys, lambda y: contains(file_name, y))), 'unknown') AS year FROM names, years""",
)
def year_from_name(spark, sf):
    orders = demo.table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    year, other = F.year("o_orderdate").cast("string"), (F.col("o_orderkey") % 40 + 2000).cast("string")
    name = F.concat(F.lit("extracted_"), year, F.lit("_"), other, F.lit(".parquet"))
    return orders.select("o_orderkey", name.alias("file_name")).withColumn("year", rd.year_from_name(F.col("file_name")))


@query(
    "year_coverage",
    """
WITH wanted AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders),
f AS (SELECT DISTINCT CAST(year(CalendarDate) AS INT) AS year FROM flights),
w AS (SELECT DISTINCT CAST(year(ts) - 24 - user_id % 3 AS INT) AS year FROM events)
SELECT year, year IN (SELECT year FROM f) AS has_flights, year IN (SELECT year FROM w) AS has_weather,
  year IN (SELECT year FROM f) AND year IN (SELECT year FROM w) AS usable FROM wanted""",
)
def year_coverage(spark, sf):
    wanted = demo.table(spark, sf, "orders", "o_orderdate").select(F.year("o_orderdate").alias("year")).distinct()
    flights = demo.flights(spark, sf).select(F.year("CalendarDate").alias("year"))
    events = demo.table(spark, sf, "events", "ts", "user_id")
    obs = events.select((F.year("ts") - 24 - F.col("user_id") % 3).cast("int").alias("year"))
    return rd.year_coverage(wanted, flights, obs)


@query(
    "union_years",
    f"SELECT {ID}, FlightDate, Airline, Month FROM (SELECT *, CAST(month(FlightDate) AS INT) AS Month FROM flights) ",
)
def union_years(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "FlightDate", "Airline", "CalendarDate")
    df = df.withColumn("Month", F.month("FlightDate"))
    early = df.filter("CalendarDate < DATE'1998-07-01'").drop("CalendarDate")
    late = df.filter("CalendarDate >= DATE'1998-07-01'").select("Month", "Airline", "FlightDate", *demo.ROW_ID)
    return rd.union_years([early, late])


@query(
    "parquet_roundtrip",
    f"SELECT {ID}, Airline, Distance, CAST(year(CalendarDate) AS INT) AS year FROM flights",
)
def parquet_roundtrip(spark, sf):
    path = stage_path(spark, "flights-by-year")
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "Airline", "Distance", F.year("CalendarDate").alias("year"))
    rd.write_parquet(df, path, ["year"])
    return rd.scan_parquet(spark, path)


@query("csv_roundtrip", "SELECT Airport, Closest_Station FROM station_key")
def csv_roundtrip(spark, sf):
    path = stage_path(spark, "pairs-csv")
    rd.write_csv(demo.station_key(spark, sf).select("Airport", "Closest_Station"), path)
    return spark.read.schema("Airport string, Closest_Station string").csv(path, header=True)


@query(
    "filter_stations",
    "SELECT STATION, DATE, ELEMENT, VALUE FROM observations WHERE STATION IN (SELECT Closest_Station FROM station_key)",
)
def filter_stations(spark, sf):
    obs = demo.observations(spark, sf).drop("obs_order")
    return wx.filter_stations(obs, demo.station_key(spark, sf))


@query(
    "filter_elements",
    "SELECT STATION, DATE, ELEMENT, VALUE FROM observations WHERE ELEMENT IN ('PRCP', 'TMAX', 'TMIN')",
)
def filter_elements(spark, sf):
    return wx.filter_elements(demo.observations(spark, sf).drop("obs_order"), ("PRCP", "TMAX", "TMIN"))


@query("map_station", "SELECT STATION, DATE, ELEMENT, VALUE FROM key_obs")
def map_station(spark, sf):
    return wx.map_station(demo.observations(spark, sf).drop("obs_order"), demo.station_key(spark, sf))


@query("pivot_weather", "SELECT * FROM pivoted")
def pivot_weather(spark, sf):
    obs = wx.map_station(demo.observations(spark, sf), demo.station_key(spark, sf))
    return wx.pivot_weather(obs.withColumn("DATE", wx.parse_day()))


@query("pivot_weather_filled", "SELECT * FROM weather")
def pivot_weather_filled(spark, sf):
    return wx.daily_weather(demo.observations(spark, sf), demo.station_key(spark, sf))


_MEASURES = [f"{s}_{e}" for s in ("Origin", "Dest") for e in rd.ELEMENTS]


@query("merge_weather", f"SELECT {ID}, FlightDate, Origin, Dest, {', '.join(_MEASURES)} FROM merged")
def merge_weather(spark, sf):
    return merged(spark, sf).select(*demo.ROW_ID, "FlightDate", "Origin", "Dest", *_MEASURES)


_ROLLED = [
    f"{p}_avg_{s}_{e.lower()}" for s in ("origin", "dest") for p in ("weekly", "monthly") for e in ("TMIN", "TMAX", "PRCP", "SNOW", "SNWD")
]


@query(
    "merge_rolling_weather",
    f"""
SELECT {ID}, m.FlightDate, {', '.join(R(c) for c in _ROLLED)}
FROM merged m LEFT JOIN roll_origin_key o ON m.Origin = o.Origin AND m.FlightDate = o.FlightDate
LEFT JOIN roll_dest_key d ON m.Dest = d.Dest AND m.FlightDate = d.FlightDate""",
)
def merge_rolling_weather(spark, sf):
    out = hx.merge_rolling_weather(merged(spark, sf))
    return r6(out.select(*demo.ROW_ID, "FlightDate", *_ROLLED), *_ROLLED)


_DELAYS = ["weekly_avg_origin_depdelayminutes", "monthly_avg_origin_depdelayminutes"]


@query(
    "merge_rolling_delay",
    f"""
SELECT {ID}, f.FlightDate, {', '.join(R(c) for c in _DELAYS)}
FROM flights f LEFT JOIN roll_delays_key r ON f.Origin = r.Origin AND f.FlightDate = r.FlightDate""",
)
def merge_rolling_delay(spark, sf):
    out = hx.merge_rolling_delay(demo.flights(spark, sf))
    return r6(out.select(*demo.ROW_ID, "FlightDate", *_DELAYS), *_DELAYS)


@query(
    "flight_history",
    f"""
WITH past AS (
  SELECT {ID}, {', '.join(f"avg(DepDelayMinutes) OVER (PARTITION BY Origin ORDER BY FlightDate, CRSDepTime NULLS LAST, {ID} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS past_{k}_avg_delay" for k in (10, 50, 100))},
    row_number() OVER (PARTITION BY Origin, FlightDate ORDER BY CRSDepTime NULLS LAST, {ID}) - 1 AS cumulative_flights_before
  FROM merged),
daily AS (SELECT Origin, FlightDate, avg(DepDelayMinutes) AS d FROM merged GROUP BY ALL),
filled AS (SELECT Origin, FlightDate, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY Origin ORDER BY FlightDate ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(d IGNORE NULLS) OVER (PARTITION BY Origin ORDER BY FlightDate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS d FROM daily),
rolled AS (SELECT Origin, FlightDate, {', '.join(f"avg(d) OVER (PARTITION BY Origin ORDER BY FlightDate ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS {p}_avg_origin_depdelayminutes" for p, w in hx.PERIODS.items())} FROM filled)
SELECT {', '.join('m.' + c for c in demo.ROW_ID)}, m.FlightDate, {', '.join(_MEASURES)}, {', '.join(R(c) for c in _ROLLED + _DELAYS)},
  {', '.join(R(f'past_{k}_avg_delay') for k in (10, 50, 100))}, CAST(cumulative_flights_before AS BIGINT) AS cumulative_flights_before
FROM merged m
LEFT JOIN roll_origin_key o ON m.Origin = o.Origin AND m.FlightDate = o.FlightDate
LEFT JOIN roll_dest_key d ON m.Dest = d.Dest AND m.FlightDate = d.FlightDate
LEFT JOIN rolled r ON m.Origin = r.Origin AND m.FlightDate = r.FlightDate
JOIN past p ON m.ok = p.ok AND m.ln = p.ln AND m.pk = p.pk AND m.sk = p.sk""",
)
def flight_history(spark, sf):
    """The flagship: flights with weather at both ends and all trailing history."""
    from tarmac.plans.training_table import with_history

    df = with_history(demo.flights(spark, sf), weather(spark, sf), demo.ROW_ID, airports=arrivals(spark, sf), rows=demo.line_count(spark, sf))
    past = [f"past_{k}_avg_delay" for k in hx.PAST_FLIGHTS]
    cols = [*_ROLLED, *_DELAYS, *past]
    return r6(df.select(*demo.ROW_ID, "FlightDate", *_MEASURES, *cols, "cumulative_flights_before"), *cols)


@query("class_filter", f"SELECT {ID}, DepDel15 FROM flights WHERE DepDel15 = 1 OR DepDel15 = 0")
def class_filter(spark, sf):
    delayed, on_time = sx.class_split(demo.flights(spark, sf).select(*demo.ROW_ID, "DepDel15"), "DepDel15")
    return delayed.unionByName(on_time)


@query("delayed_flights", f"SELECT {ID}, Airline, DepDelay, ArrDelay FROM flights WHERE DepDelay > 0 OR ArrDelay > 0")
def delayed_flights(spark, sf):
    return sx.delayed(demo.flights(spark, sf)).select(*demo.ROW_ID, "Airline", "DepDelay", "ArrDelay")


@query(
    "route_year_filter",
    f"SELECT {ID}, CalendarDate, Origin, Dest FROM flights WHERE year(CalendarDate) = 1999 AND Origin = 'A7' AND Dest LIKE 'A1%' AND DepDelayMinutes > 0",
)
def route_year_filter(spark, sf):
    df = sx.route_year(demo.flights(spark, sf), "CalendarDate", year=1999, origin="A7")
    df = df.filter(F.col("Dest").startswith("A1") & (F.col("DepDelayMinutes") > 0))
    return df.select(*demo.ROW_ID, "CalendarDate", "Origin", "Dest")


_ALL_M = " AND ".join(f"{c} IS NOT NULL" for c in ["AirTime", *_MEASURES])


@query("dropna_any", f"SELECT {ID}, AirTime, {', '.join(_MEASURES)} FROM merged WHERE {_ALL_M}")
def dropna_any(spark, sf):
    return sx.drop_missing(merged(spark, sf).select(*demo.ROW_ID, "AirTime", *_MEASURES))


@query("drop_duplicates", "SELECT DISTINCT Origin, Dest, FlightDate, CRSDepTime FROM flights")
def drop_duplicates(spark, sf):
    return demo.flights(spark, sf).select("Origin", "Dest", "FlightDate", "CRSDepTime").dropDuplicates()


@query(
    "duplicate_counts",
    """SELECT count(*) AS before_rows, (SELECT count(*) FROM (SELECT DISTINCT Origin, Dest, FlightDate, CRSDepTime FROM flights)) AS after_rows FROM flights""",
)
def duplicate_counts(spark, sf):
    return sx.duplicate_counts(demo.flights(spark, sf).select("Origin", "Dest", "FlightDate", "CRSDepTime"))


@query("distinct_airports", "SELECT DISTINCT FlightDate, Origin AS Location FROM flights")
def distinct_airports(spark, sf):
    return sx.distinct_on(demo.flights(spark, sf), {"FlightDate": "FlightDate", "Origin": "Location"})


@query("union_distinct", "SELECT Origin AS Location FROM flights UNION SELECT Dest FROM flights")
def union_distinct(spark, sf):
    return sx.locations(demo.flights(spark, sf))


@query(
    "feature_projection",
    f"SELECT {ID}, Origin, Dest, CRSDepTime, CRSArrTime, AirTime, Distance, Cancelled, Diverted FROM flights",
)
def feature_projection(spark, sf):
    drop = ["FlightDate", "CalendarDate", "Airline", "DepDel15", "ArrDelayMinutes", "DepDelay", "ArrDelay"]
    df = demo.flights(spark, sf)
    return df.select(*sx.feature_names(df.columns, exclude=drop, target="DepDelayMinutes"))


@query("total_delay", f"SELECT {ID}, DepDelayMinutes + ArrDelayMinutes AS total_delay FROM flights")
def total_delay(spark, sf):
    df = demo.flights(spark, sf)
    return df.select(*demo.ROW_ID, sx.sum_of("DepDelayMinutes", "ArrDelayMinutes").alias("total_delay"))


_RISK = [f"{s}_{e}" for e in ("PRCP", "SNOW", "SNWD") for s in ("Origin", "Dest")]


@query("weather_risk", f"SELECT {ID}, {R(' + '.join(_RISK), 'WeatherRiskScore')} FROM merged")
def weather_risk(spark, sf):
    out = merged(spark, sf).select(*demo.ROW_ID, sx.sum_of(*_RISK).alias("WeatherRiskScore"))
    return r6(out, "WeatherRiskScore")


@query(
    "count_map",
    f"SELECT {ID}, Airline, count(*) OVER (PARTITION BY Airline) AS flights_of_airline FROM flights",
)
def count_map(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "Airline")
    return hx.group_size(df, ["Airline"], name="flights_of_airline")


@query(
    "airport_coords",
    """
SELECT a.Location, s.s_acctbal AS Latitude, s.s_nationkey AS Longitude
FROM (SELECT DISTINCT concat('A', CAST(l_suppkey AS VARCHAR)) AS Location FROM lineitem) a
LEFT JOIN supplier s ON a.Location = concat('A', CAST(s.s_suppkey + 3 AS VARCHAR))""",
)
def airport_coords(spark, sf):
    airports = demo.table(spark, sf, "lineitem", "l_suppkey").distinct()
    airports = airports.select(F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("Location"))
    path = stage_path(spark, "airports-csv")
    sup = demo.table(spark, sf, "supplier", "s_name", "s_suppkey", "s_acctbal", "s_nationkey")
    sup.withColumn("s_suppkey", F.concat(F.lit("A"), (F.col("s_suppkey") + 3).cast("string"))).write.csv(path)
    places = rd.scan_positional(spark, path, {1: "Location", 2: "Latitude", 3: "Longitude"})
    places = places.withColumns({"Latitude": F.col("Latitude").cast("double"), "Longitude": F.col("Longitude").cast("int")})
    return sx.with_coordinates(airports, places)


_POINTS = "SELECT vec_id, embedding[1]::DOUBLE * 300 AS lat, embedding[2]::DOUBLE * 600 AS lon, label FROM embeddings"


def _nearest_sql(distance: str) -> str:
    return f"""
WITH p AS ({_POINTS}),
pairs AS (SELECT a.vec_id AS airport, s.vec_id AS station, {distance} AS d
  FROM (SELECT * FROM p WHERE label % 2 = 0) a, (SELECT * FROM p WHERE label % 2 = 1) s)
SELECT airport, arg_min(station, (d, station)) AS station, {R('min(d) * 6371', 'distance_km')} FROM pairs GROUP BY airport"""


def _points(spark, sf):
    e = demo.table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    p = e.select(
        "vec_id",
        (F.col("embedding")[0].cast("double") * 300).alias("lat"),
        (F.col("embedding")[1].cast("double") * 600).alias("lon"),
        "label",
    )
    airports = p.filter("label % 2 = 0").select(F.col("vec_id").alias("airport"), "lat", "lon")
    stations = p.filter("label % 2 = 1").select(F.col("vec_id").alias("station"), "lat", "lon")
    return airports, stations


@query(
    "nearest_station",
    _nearest_sql("sqrt(pow(radians(a.lat) - radians(s.lat), 2) + pow(radians(a.lon) - radians(s.lon), 2))"),
)
def nearest_station(spark, sf):
    airports, stations = _points(spark, sf)
    return r6(nx.nearest(airports, stations, "airport", "station"), "distance_km")


@query(
    "nearest_station_haversine",
    _nearest_sql("2 * asin(least(1.0, sqrt(pow(sin((radians(a.lat) - radians(s.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(s.lat)) * pow(sin((radians(a.lon) - radians(s.lon)) / 2), 2))))"),
)
def nearest_station_haversine(spark, sf):
    airports, stations = _points(spark, sf)
    return r6(nx.nearest(airports, stations, "airport", "station", metric="haversine"), "distance_km")
