"""Exploration queries and row features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.base import R, arrivals, query, r6, weather
from tarmac.functions import bands, calendar
from tarmac.operators import explore as ex
from tarmac.operators import history as hx
from tarmac.operators import shape as sx
from tarmac.operators import weather as wx
from tarmac.plans.ordering import even_parts
from tarmac.sources import demo

ID = ", ".join(demo.ROW_ID)


@query("daily_mean", f"SELECT FlightDate, {R('avg(DepDelayMinutes)', 'DepDelayMinutes')}, {R('avg(ArrDelayMinutes)', 'ArrDelayMinutes')}, Origin FROM flights GROUP BY Origin, FlightDate")
def daily_mean(spark, sf):
    cols = ["DepDelayMinutes", "ArrDelayMinutes"]
    return r6(hx.daily_mean(demo.flights(spark, sf), "Origin", "FlightDate", cols), *cols)


def _calendar(spark, sf):
    return demo.flights(spark, sf).withColumns({"Month": F.month("CalendarDate"), "DayOfWeek": calendar.monday_first(F.col("CalendarDate"))})


_CAL = "SELECT *, CAST(month(CalendarDate) AS INT) AS Month, CAST(isodow(CalendarDate) AS INT) AS DayOfWeek FROM flights"


def _register_count(name: str, key: str, late: bool):
    where = " WHERE DepDelay > 0 OR ArrDelay > 0" if late else ""

    @query(name, f"SELECT {key}, count(FlightDate) AS n FROM ({_CAL}){where} GROUP BY {key}")
    def count(spark, sf):
        df = _calendar(spark, sf)
        return ex.count_by(sx.delayed(df) if late else df, key, "FlightDate")


for _name, _key, _late in (
    ("count_by_month", "Month", False),
    ("count_by_weekday", "DayOfWeek", False),
    ("count_by_airline", "Airline", False),
    ("delays_by_month", "Month", True),
    ("delays_by_weekday", "DayOfWeek", True),
):
    _register_count(_name, _key, _late)

_SUMMED = ["AirTime", "Distance", "DepDelayMinutes", "ArrDelayMinutes"]


@query("sum_by_airline", f"SELECT Airline, {', '.join(R(f'sum({c})', c, 3) for c in _SUMMED)} FROM flights GROUP BY Airline")
def sum_by_airline(spark, sf):
    df = ex.sum_numeric(demo.flights(spark, sf).select("Airline", "FlightDate", *_SUMMED), "Airline")
    return r6(df, *_SUMMED, digits=3)


_FULL, _PLAIN = ["DepDelayMinutes", "ArrDelayMinutes"], ["Distance"]
_MULTI = [(c, n) for c in _FULL for n in ("mean", "median", "sum")] + [(c, n) for c in _PLAIN for n in ("mean", "sum")]
_AGG = {"mean": "avg", "median": "median", "sum": "sum"}


@query(
    "multi_agg",
    f"SELECT Airline, Month, {', '.join(R(f'{_AGG[n]}({c})', f'{c}_{n}', 4) for c, n in _MULTI)} FROM ({_CAL}) GROUP BY Airline, Month",
)
def multi_agg(spark, sf):
    df = ex.mean_median_sum(_calendar(spark, sf), ["Airline", "Month"], _FULL, _PLAIN)
    return r6(df, *[f"{c}_{n}" for c, n in _MULTI], digits=4)


@query(
    "crosstab",
    "SELECT Cancelled, count(*) FILTER (WHERE NOT Diverted) AS Diverted_False, count(*) FILTER (WHERE Diverted) AS Diverted_True FROM flights GROUP BY Cancelled",
)
def crosstab(spark, sf):
    return ex.crosstab(demo.flights(spark, sf), "Cancelled", "Diverted", [False, True])


_DESC = ["DepDelayMinutes", "ArrDelayMinutes", "AirTime", "Distance", "CRSDepTime"]


def _describe_sql(c: str) -> str:
    q = ", ".join(R(f"quantile_cont({c}, {p})", n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
    return f"SELECT '{c}' AS feature, count({c}) AS count, {R(f'avg({c})', 'mean')}, {R(f'stddev_samp({c})', 'std')}, {R(f'min({c})::DOUBLE', 'min')}, {R(f'max({c})::DOUBLE', 'max')}, {q} FROM flights"


@query("describe", "\nUNION ALL ".join(_describe_sql(c) for c in _DESC))
def describe(spark, sf):
    df = ex.describe(demo.flights(spark, sf), _DESC)
    return r6(df, "mean", "std", "min", "max", "p25", "p50", "p75")


_NULLS = {"ok": "bigint", "FlightDate": "date", "AirTime": "double", "DepDelayMinutes": "double", "Cancelled": "boolean"}


@query("null_counts", "\nUNION ALL ".join(f"SELECT '{c}' AS feature, '{t}' AS type, count(*) - count({c}) AS nulls FROM flights" for c, t in _NULLS.items()))
def null_counts(spark, sf):
    return ex.null_counts(demo.flights(spark, sf).select(*_NULLS))


_GAPS = "SELECT ok, ln, pk, sk, CASE WHEN ln % 3 = 0 THEN NULL ELSE Airline END AS Airline, AirTime, DepDelayMinutes FROM flights"


@query(
    "impute_mode_median",
    f"""
WITH g AS ({_GAPS}),
m AS (SELECT Airline AS mode FROM g WHERE Airline IS NOT NULL GROUP BY Airline ORDER BY count(*) DESC, Airline LIMIT 1),
d AS (SELECT median(AirTime) AS a, median(DepDelayMinutes) AS b FROM g)
SELECT {ID}, coalesce(Airline, mode) AS Airline, coalesce(AirTime, a) AS AirTime, coalesce(DepDelayMinutes, b) AS DepDelayMinutes FROM g, m, d""",
)
def impute_mode_median(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, F.when(F.col("ln") % 3 != 0, F.col("Airline")).alias("Airline"), "AirTime", "DepDelayMinutes")
    return ex.impute_mode_median(df, ["Airline", "AirTime", "DepDelayMinutes"])


_CAPPED = ["Distance", "ArrDelay", "AirTime"]


@query(
    "cap_outliers",
    f"""
WITH q AS (SELECT {', '.join(f'quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi' for c in _CAPPED)} FROM flights)
SELECT {ID}, {', '.join(R(f'CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, {c}_hi), {c}_lo) END', c) for c in _CAPPED)} FROM flights, q""",
)
def cap_outliers(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, *_CAPPED)
    return r6(ex.cap_outliers(df, _CAPPED), *_CAPPED)


@query("nunique", "\nUNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n FROM flights" for c in ("Airline", "Origin", "Dest")))
def nunique(spark, sf):
    return ex.nunique(demo.flights(spark, sf), ["Airline", "Origin", "Dest"])


@query("value_counts", "SELECT Dest, count(*) AS n FROM flights GROUP BY Dest")
def value_counts(spark, sf):
    return ex.value_counts(demo.flights(spark, sf), "Dest")


@query("avg_snow_route", f"SELECT FlightDate, Origin, Dest, {R('avg(Origin_SNOW)', 'avg_origin_snow')}, {R('avg(Dest_SNOW)', 'avg_dest_snow')} FROM merged GROUP BY FlightDate, Origin, Dest")
def avg_snow_route(spark, sf):
    """All flights of a route and day meet the same two weather rows, whose values are the means."""
    parts = even_parts(spark, demo.table(spark, sf, "lineitem", "l_orderkey").count())
    # parts of even length: adaptive execution would pack them by compressed bytes, which say little about these keys in memory
    routes = demo.flights(spark, sf).select("FlightDate", "Origin", "Dest").repartition(parts, "Origin", "FlightDate").dropDuplicates()
    out = wx.merge_weather(routes, weather(spark, sf), ("SNOW",), arrivals(spark, sf))
    out = out.withColumnsRenamed({"Origin_SNOW": "avg_origin_snow", "Dest_SNOW": "avg_dest_snow"})
    return r6(out, "avg_origin_snow", "avg_dest_snow")


@query(
    "minmax_norm",
    f"""
WITH c AS (SELECT {ID}, count(*) OVER (PARTITION BY Airline) AS n FROM flights), e AS (SELECT min(n) AS lo, max(n) AS hi FROM c)
SELECT {ID}, n, {R('(n - lo) / nullif(hi - lo, 0)::DOUBLE', 'normalized_count')} FROM c, e""",
)
def minmax_norm(spark, sf):
    df = ex.map_counts(demo.flights(spark, sf).select(*demo.ROW_ID, "Airline"), "Airline", "n").drop("Airline")
    return r6(ex.minmax_norm(df, "n", "normalized_count"), "normalized_count")


@query(
    "zscore_airline",
    f"""
WITH t AS (SELECT Airline, sum(DepDelayMinutes + ArrDelayMinutes) AS total FROM flights GROUP BY Airline)
SELECT Airline, total, {R('(total - (SELECT avg(total) FROM t)) / (SELECT stddev_samp(total) FROM t)', 'z')} FROM t""",
)
def zscore_airline(spark, sf):
    df = demo.flights(spark, sf).withColumn("total_delay", sx.sum_of("DepDelayMinutes", "ArrDelayMinutes"))
    return r6(ex.zscore_totals(df, "Airline", "total_delay", "z"), "z")


@query(
    "histogram",
    f"""
WITH e AS (SELECT min(DepDelay) AS lo, (max(DepDelay) - min(DepDelay)) / 50 AS w FROM flights),
c AS (SELECT least(floor((DepDelay - lo) / w), 49)::BIGINT AS bin, count(*) AS n FROM flights, e WHERE DepDelay IS NOT NULL GROUP BY ALL)
SELECT bin, {R('lo + bin * w', 'low')}, {R('lo + bin * w + w', 'high')}, coalesce(n, 0)::BIGINT AS n
FROM (SELECT b::BIGINT AS bin FROM range(50) t(b)) LEFT JOIN c USING (bin), e""",
)
def histogram(spark, sf):
    return r6(ex.histogram(demo.flights(spark, sf), "DepDelay", 50), "low", "high")


@query(
    "box_stats",
    f"""
WITH q AS (SELECT quantile_cont(Distance, 0.25) AS q1, quantile_cont(Distance, 0.5) AS median, quantile_cont(Distance, 0.75) AS q3 FROM flights)
SELECT {R('q1')}, {R('median')}, {R('q3')},
  {R('min(Distance) FILTER (WHERE Distance BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))', 'low')},
  {R('max(Distance) FILTER (WHERE Distance BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))', 'high')},
  count(*) FILTER (WHERE Distance NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM flights, q GROUP BY q1, median, q3""",
)
def box_stats(spark, sf):
    return r6(ex.box_stats(demo.flights(spark, sf), "Distance"), "q1", "median", "q3", "low", "high")


# Row features


@query("parse_date", "SELECT STATION, CAST(strptime(DATE, '%Y%m%d') AS DATE) AS DATE, VALUE FROM observations")
def parse_date(spark, sf):
    from tarmac.operators.weather import parse_day

    return demo.observations(spark, sf).select("STATION", parse_day().alias("DATE"), "VALUE")


_MIXED = "CASE WHEN VALUE > 40 THEN 'n/a ' || DATE ELSE DATE END"


@query("parse_date_lenient", f"SELECT STATION, VALUE, CAST(try_strptime({_MIXED}, '%Y%m%d') AS DATE) AS DATE FROM observations")
def parse_date_lenient(spark, sf):
    mixed = F.when(F.col("VALUE") > 40, F.concat(F.lit("n/a "), F.col("DATE"))).otherwise(F.col("DATE"))
    obs = demo.observations(spark, sf).select("STATION", "VALUE", mixed.alias("text"))
    return obs.select("STATION", "VALUE", ex.parse_date_lenient("text").alias("DATE"))


@query("to_numeric_columns", "SELECT STATION, CAST(DATE AS DOUBLE) AS DATE, ELEMENT, VALUE FROM observations")
def to_numeric_columns(spark, sf):
    return ex.to_numeric_columns(demo.observations(spark, sf).drop("obs_order"))


def _band_sql(col: str, limits) -> str:
    cases = " ".join(f"WHEN {col} < {limit} THEN '{i}'" for i, limit in enumerate(limits))
    return f"CASE WHEN {col} IS NULL THEN 'Unknown' {cases} ELSE '{len(limits)}' END"


def _register_column(name: str, alias: str, sql: str, column, source: str = "CRSDepTime"):
    @query(name, f"SELECT {ID}, {source}, {sql} AS {alias} FROM flights")
    def feature(spark, sf):
        return demo.flights(spark, sf).select(*demo.ROW_ID, source, column(source).alias(alias))


_register_column("airtime_band", "AirTimeCategory", _band_sql("AirTime", (120, 360)), lambda c: bands.band(c, bands.AIRTIME_LIMITS), "AirTime")
_register_column("distance_band", "DistanceCategory", _band_sql("Distance", (500, 2500)), lambda c: bands.band(c, bands.DISTANCE_LIMITS), "Distance")
_register_column("time_band", "TimeofDay", _band_sql("CRSDepTime", (600, 1200, 1800)), lambda c: bands.band(c, bands.CLOCK_LIMITS))
_register_column(
    "time_label",
    "TimeOfDay",
    "CASE WHEN CRSDepTime < 600 THEN 'Early Morning' WHEN CRSDepTime < 1200 THEN 'Morning' WHEN CRSDepTime < 1800 THEN 'Afternoon' ELSE 'Evening' END",
    bands.clock_label,
)
_register_column(
    "hhmm_minutes",
    "minutes",
    "CASE WHEN CRSDepTime % 100 < 60 AND CRSDepTime < 2400 THEN CAST(CRSDepTime // 100 * 60 + CRSDepTime % 100 AS INT) END",
    bands.clock_minutes,
)
_register_column("severe_flag", "SevereDelay", "CASE WHEN DepDelayMinutes > 60 THEN 1 ELSE 0 END", bands.severe, "DepDelayMinutes")


@query(
    "cut_bins",
    f"""SELECT {ID},
CASE WHEN DepDelay > -10 AND DepDelay <= 0 THEN 'On-time' WHEN DepDelay > 0 AND DepDelay <= 15 THEN 'Moderate Delay' WHEN DepDelay > 15 AND DepDelay <= 300 THEN 'Severe Delay' END AS DepDelayCategory,
CASE WHEN Distance > 0 AND Distance <= 500 THEN 'Short' WHEN Distance > 500 AND Distance <= 1500 THEN 'Medium' WHEN Distance > 1500 AND Distance <= 3000 THEN 'Long' END AS DistanceCategory
FROM flights""",
)
def cut_bins(spark, sf):
    df = demo.flights(spark, sf)
    return df.select(
        *demo.ROW_ID,
        bands.right_closed("DepDelay", *bands.DELAY_BINS).alias("DepDelayCategory"),
        bands.right_closed("Distance", *bands.DISTANCE_BINS).alias("DistanceCategory"),
    )


_CYC = {"CRSDepTime": 2358, "CRSArrTime": 2358, "DayOfYear": 365, "DayOfWeek": 7, "Month": 12}
_CYC_SQL = ", ".join(R(f"{fn}(2 * pi() * {c} / {p})", f"{c}_{fn}") for c, p in _CYC.items() for fn in ("sin", "cos"))


@query(
    "cyclical",
    f"""
WITH c AS (SELECT {ID}, CAST(month(CalendarDate) AS INT) AS Month, CAST(isodow(CalendarDate) AS INT) AS DayOfWeek, CAST(dayofyear(CalendarDate) AS INT) AS DayOfYear,
  CASE WHEN CRSDepTime % 100 < 60 AND CRSDepTime < 2400 THEN CRSDepTime // 100 * 60 + CRSDepTime % 100 END AS CRSDepTime,
  CASE WHEN CRSArrTime % 100 < 60 AND CRSArrTime < 2400 THEN CRSArrTime // 100 * 60 + CRSArrTime % 100 END AS CRSArrTime FROM flights)
SELECT {ID}, {_CYC_SQL} FROM c""",
)
def cyclical(spark, sf):
    df = calendar.calendar_parts(bands.add_clock_minutes(demo.flights(spark, sf)), "CalendarDate")
    names = [f"{c}_{fn}" for c in _CYC for fn in ("sin", "cos")]
    return r6(calendar.add_cyclical(df).select(*demo.ROW_ID, *names), *names)


@query(
    "calendar_parts",
    f"""SELECT {ID}, CalendarDate, CAST(year(CalendarDate) AS INT) AS Year, CAST(month(CalendarDate) AS INT) AS Month,
  CAST(isodow(CalendarDate) AS INT) AS DayOfWeek, CAST(dayofyear(CalendarDate) AS INT) AS DayOfYear FROM flights""",
)
def calendar_parts(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "CalendarDate")
    return calendar.calendar_parts(df, "CalendarDate")


_HOLIDAYS = """
days AS (SELECT CAST(d AS DATE) AS d FROM range(DATE '1995-01-01', DATE '2002-02-01', INTERVAL 1 DAY) t(d)),
named AS (SELECT d, (month(d), day(d)) IN ((1, 1), (7, 4), (11, 11), (12, 25)) OR (month(d) = 6 AND day(d) = 19 AND year(d) >= 2021) AS fixed,
  (month(d) IN (1, 2) AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21) OR (month(d) = 5 AND isodow(d) = 1 AND day(d) > 24)
  OR (month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7) OR (month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14)
  OR (month(d) = 11 AND isodow(d) = 4 AND day(d) BETWEEN 22 AND 28) AS floating FROM days),
hol AS (SELECT DISTINCT h FROM (
  SELECT d AS h FROM named WHERE fixed OR floating
  UNION ALL SELECT d - 1 FROM named WHERE fixed AND isodow(d) = 6
  UNION ALL SELECT d + 1 FROM named WHERE fixed AND isodow(d) = 7) WHERE year(h) BETWEEN 1995 AND 2001),
near AS (SELECT DISTINCT h + CAST(k AS INT) AS h FROM hol, range(-3, 4) t(k)),
flags AS (SELECT ok, ln, pk, sk, CalendarDate, CAST(isodow(CalendarDate) AS INT) AS DayOfWeek,
  CAST(CalendarDate IN (SELECT h FROM hol) AS INT) AS Holiday_Indicator,
  CAST(CalendarDate IN (SELECT h FROM near) AS INT) AS Near_Holiday,
  CAST(isodow(CalendarDate) IN (1, 7) AS INT) AS Weekend_Indicator FROM flights)"""


def _flags(spark, sf):
    df = demo.flights(spark, sf).select(*demo.ROW_ID, "CalendarDate", calendar.monday_first(F.col("CalendarDate")).alias("DayOfWeek"))
    df = calendar.add_holiday_flags(df, "CalendarDate", demo.CALENDAR_YEARS)
    return calendar.add_working_day(calendar.add_weekend_flag(df))


def _register_flag(name: str, column: str, sql: str):
    @query(name, f"WITH {_HOLIDAYS.strip()}\nSELECT {ID}, CalendarDate, {sql} AS {column} FROM flags")
    def flag(spark, sf):
        return _flags(spark, sf).select(*demo.ROW_ID, "CalendarDate", column)


_register_flag("holiday_flag", "Holiday_Indicator", "Holiday_Indicator")
_register_flag("near_holiday", "Near_Holiday", "Near_Holiday")
_register_flag("weekend_flag", "Weekend_Indicator", "Weekend_Indicator")
_register_flag("working_day", "Working_Day", "CASE WHEN Weekend_Indicator = 1 OR Holiday_Indicator = 1 THEN 0 ELSE 1 END")

_TRANSFORMS = {
    "y_log": "ln(1 + y - lo + 1)",
    "y_sqrt": "sqrt(y - lo + 1)",
    "y_recip": "1 / ln(1 + CASE WHEN y <= 1e-5 THEN 1e-5 ELSE y END)",
    "y_clip": "CASE WHEN y IS NULL THEN NULL ELSE greatest(y, 0) END",
    "y_log1p": "CASE WHEN y IS NULL THEN NULL ELSE ln(1 + greatest(y, 0)) END",
}


@query(
    "target_transforms",
    f"""
WITH t AS (SELECT {ID}, DepDelay AS y, min(DepDelay) OVER () AS lo FROM flights)
SELECT {ID}, y AS DepDelay, {', '.join(R(e, n, 4 if n == 'y_recip' else 6) for n, e in _TRANSFORMS.items())} FROM t""",
)
def target_transforms(spark, sf):
    df = bands.target_transforms(demo.flights(spark, sf).select(*demo.ROW_ID, "DepDelay"), "DepDelay")
    return r6(r6(df, *[c for c in _TRANSFORMS if c != "y_recip"]), "y_recip", digits=4)
