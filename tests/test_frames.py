"""Hand-made frames: boundaries, missing values, ties, leap days."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.functions import bands, calendar, pvalues
from tarmac.operators import explore as ex
from tarmac.operators import history as hx
from tarmac.operators import stats as st
from tarmac.operators import weather as wx
from tarmac.operators.quantiles import exact_quantiles, quantile_map
from tarmac.sources import readers as rd

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def keyed(spark):
    keys, values = "AAABBC", [1.0, 2.0, 3.0, 100.0, 200.0, None]
    return spark.createDataFrame([(k, day(i), v) for i, (k, v) in enumerate(zip(keys, values))], "k string, d date, x double")


def test_rolling_inside_and_across_keys(spark):
    def run(boundary):
        out = hx.rolling_means(keyed(spark), "k", "d", {"x": "x"}, {"w": 2}, boundary, at_least=2)
        return [r["w_avg_x"] for r in out.orderBy("k", "d").collect()]

    assert run("key") == [None, 1.0, 1.5, None, 100.0, None]
    assert run("global") == [None, 1.0, 1.5, 2.5, 51.5, 150.0]


@pytest.mark.parametrize("layout", ["keyed", "blocks"])
def test_past_flights_fill(spark, layout):
    df = keyed(spark).select(F.col("k").alias("Origin"), F.col("d").alias("FlightDate"), F.lit(0).alias("CRSDepTime"), "x")

    def run(fill):
        out = hx.flight_history(df, ["x"], "x", (10,), fill, layout, at_least=10)
        return [(r["past_10_avg_delay"], r["cumulative_flights_before"]) for r in out.orderBy("Origin", "FlightDate").collect()]

    assert [a for a, _ in run("none")] == [None, 1.0, 1.5, None, 100.0, None]
    assert [a for a, _ in run("reference")] == [1.0, 1.0, 1.5, 100.0, 100.0, 100.0]
    assert {b for _, b in run("none")} == {0}


def test_clock_minutes(spark):
    df = spark.createDataFrame([(0,), (959,), (2359,), (2400,), (1261,), (None,)], "t int")
    assert [r[0] for r in df.select(bands.clock_minutes("t")).collect()] == [0, 599, 1439, None, None, None]


def test_bins_and_bands(spark):
    df = spark.createDataFrame([(v,) for v in (-10.0, 0.0, 1.0, 15.0, 16.0, 300.0, 301.0, None)], "v double")
    got = [r[0] for r in df.select(bands.right_closed("v", *bands.DELAY_BINS)).collect()]
    assert got == [None, "On-time", "Moderate Delay", "Moderate Delay", "Severe Delay", "Severe Delay", None, None]
    air = spark.createDataFrame([(119.0,), (120.0,), (360.0,), (None,)], "v double")
    assert [r[0] for r in air.select(bands.band("v", bands.AIRTIME_LIMITS)).collect()] == ["0", "1", "2", "Unknown"]
    assert [r[0] for r in air.select(bands.clock_label("v"))[["*"]].collect()][-1] == "Evening"


def test_average_rank_and_percentile(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 1)], "g int, v int")
    assert sorted(r["rank"] for r in ex.rank_average(df, "v", ["g"]).collect()) == [1.5, 1.5, 3.0]
    four = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "v double")
    assert quantile_map(four, ["v"], [0.99])["v"][0.99] == pytest.approx(3.97)


@pytest.mark.parametrize("one_task", [1_000_000, 1])
def test_percentiles_by_bracket(spark, one_task):
    """Small accuracy, so that the bracket path and the block-wise ranking run on little data."""
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 20_011 / 7).alias("v"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, ["v"], probs, ["g"], accuracy=200, one_task=one_task).collect()
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert len(got) == 18
    for r in got:
        assert r["q"] == pytest.approx(want[r["g"]][probs.index(r["p"])], rel=1e-12)


def test_percentiles_with_null_group_and_nan(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", float("nan")), ("b", 5.0)], "g string, v double")
    got = {r["g"]: r["q"] for r in exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert got == {None: 2.0, "b": 5.0}


def test_holidays(spark):
    days = {r[0] for r in calendar.holidays(spark, (2018, 2022)).collect()}
    # public dates, observed days included
    for d in ("2018-01-01", "2018-11-12", "2019-01-21", "2020-07-03", "2020-07-04", "2021-06-19", "2021-06-18", "2021-12-24", "2021-12-31", "2022-05-30", "2022-11-24", "2022-12-26"):
        assert dt.date.fromisoformat(d) in days, d
    for d in ("2020-06-19", "2023-01-01", "2023-01-02", "2018-12-31"):
        assert dt.date.fromisoformat(d) not in days, d


def test_near_holiday_and_working_day(spark):
    rows = [(dt.date(2019, 7, d),) for d in (1, 3, 4, 7, 8)] + [(None,)]
    df = spark.createDataFrame(rows, "FlightDate date").withColumn("DayOfWeek", F.weekday("FlightDate") + 1)
    out = calendar.add_working_day(calendar.add_weekend_flag(calendar.add_holiday_flags(df, "FlightDate")))
    got = {r["FlightDate"]: (r["Holiday_Indicator"], r["Near_Holiday"], r["Weekend_Indicator"], r["Working_Day"]) for r in out.collect()}
    assert got[dt.date(2019, 7, 1)] == (0, 1, 1, 0)
    assert got[dt.date(2019, 7, 3)] == (0, 1, 0, 1)
    assert got[dt.date(2019, 7, 4)] == (1, 1, 0, 0)
    assert got[dt.date(2019, 7, 7)] == (0, 1, 1, 0)
    assert got[dt.date(2019, 7, 8)] == (0, 0, 1, 0)
    assert got[None] == (0, 0, 0, 1)


def test_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2020, 12, 31),), (dt.date(2020, 2, 29),)], "d date")
    assert [r["DayOfYear"] for r in calendar.calendar_parts(df, "d").collect()] == [366, 60]


def test_pivot_takes_first_value_and_keeps_absent_elements(spark):
    rows = [("S", DAY, "PRCP", None, 1), ("S", DAY, "PRCP", 2.0, 2), ("S", DAY, "PRCP", 3.0, 3), ("S", DAY, "TMAX", 9.0, 4), ("T", DAY, "TMIN", None, 1)]
    obs = spark.createDataFrame(rows, "STATION string, DATE date, ELEMENT string, VALUE double, obs_order int")
    (row,) = wx.zero_fill(wx.pivot_weather(obs)).collect()
    assert row.asDict() == {"STATION": "S", "DATE": DAY, "PRCP": 2.0, "SNOW": 0.0, "SNWD": 0.0, "TMAX": 9.0, "TMIN": None}


def test_duplicate_station_never_multiplies_rows(spark):
    key = spark.createDataFrame([("A1", "S", 0), ("A2", "S", 1)], "Airport string, Closest_Station string, line int")
    obs = spark.createDataFrame([("S", "20240101", "PRCP", 1.0), ("X", "20240101", "PRCP", 1.0)], rd.OBSERVATION_SCHEMA)
    assert [r["STATION"] for r in wx.map_station(obs, key).collect()] == ["A2"]


def test_merge_keeps_either_side(spark):
    weather = spark.createDataFrame([("A", DAY, 1.0, 0.0, 0.0, None, None)], "STATION string, DATE date, PRCP double, SNOW double, SNWD double, TMAX double, TMIN double")
    flights = spark.createDataFrame([(1, "A", "Z", DAY), (2, "Z", "A", DAY), (3, "Z", "Z", DAY), (4, "A", "A", None)], "id int, Origin string, Dest string, FlightDate date")
    got = {r["id"]: (r["Origin_PRCP"], r["Dest_PRCP"]) for r in wx.merge_weather(flights, weather).collect()}
    assert got == {1: (1.0, None), 2: (None, 1.0)}


def test_first_line_is_skipped_and_order_is_kept(spark, tmp_path):
    (tmp_path / "o.csv").write_text("S,20240101,PRCP,1.5,,x,7\nS,20240101,PRCP,2.5,,x,7\nS,20240101,PRCP,3.5\n")
    got = rd.scan_observations(spark, str(tmp_path)).orderBy("obs_order").collect()
    assert [r["VALUE"] for r in got] == [2.5, 3.5]
    assert len(rd.scan_observations(spark, str(tmp_path), skip_first_line=False).collect()) == 3


def test_year_from_name(spark):
    names = ["extracted_2021_2019.parquet", "x1999.csv", "flight_2022.parquet", "2030"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(rd.year_from_name(F.col("n"))).collect()] == ["2019", "unknown", "2022", "unknown"]


def test_year_of_files(spark, tmp_path):
    for y in ("2019", "2021"):
        spark.range(2).coalesce(1).toPandas().to_parquet(tmp_path / f"flight_{y}.parquet")
    got = rd.scan_years(spark, str(tmp_path)).groupBy("year").count().collect()
    assert {r["year"]: r["count"] for r in got} == {"2019": 2, "2021": 2}


def test_broadcast_bound_is_measured(spark):
    from tarmac.plans.lookup import fits_broadcast

    long_text = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert fits_broadcast(spark.range(100), 10_000)
    assert not fits_broadcast(long_text, 100_000)
    assert not fits_broadcast(spark.range(10).select(F.sequence(F.lit(1), F.lit(1000)).alias("a")), 50_000)


def test_numeric_text_columns(spark):
    df = spark.createDataFrame([("1", "x", None), ("2.5", "3", None)], "a string, b string, c string")
    assert dict(ex.to_numeric_columns(df).dtypes) == {"a": "double", "b": "string", "c": "double"}


def test_histogram_of_constant_and_empty(spark):
    one = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [r["n"] for r in ex.histogram(one, "v", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_known_tail_probabilities():
    # published table values
    assert pvalues.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.t_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.t_two_sided(1.96, 1e7) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.chi2_upper(3.841, 1) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.chi2_upper(18.307, 10) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert pvalues.fisher_two_sided(8, 2, 1, 5) == pytest.approx(0.0349650350)
    assert pvalues.fisher_two_sided(0, 5, 5, 0) == pytest.approx(2 / math.comb(10, 5))


@pytest.mark.parametrize("spread, far", [(30.0, 1e4), (1.0, 0.0)])
def test_density_is_the_sum_over_rows(spark, spread, far):
    n = 200_000
    u = F.log((F.col("id") + 1) / F.lit(n + 1.0)) * -spread
    df = spark.range(n).select(F.when(F.col("id") == n - 1, F.lit(far)).otherwise(u).alias("x"))
    x = np.array(df.toPandas()["x"])
    h = x.std(ddof=1) * n**-0.2
    rows = sorted(st.kde_curve(df, "x").collect())
    at = np.linspace(x.min(), x.max(), 200)
    exact = np.array([np.exp(-(((a - x) / h) ** 2) / 2).sum() for a in at]) / (n * h * math.sqrt(2 * math.pi))
    assert [r["point"] for r in rows] == list(range(200))
    assert [r["density"] for r in rows] == pytest.approx(list(exact), rel=5e-3, abs=1e-6 * exact.max())


def test_density_of_odd_columns(spark):
    assert st.kde_curve(spark.createDataFrame([(None,)], "x double"), "x").count() == 0
    for values in ([1.0], [2.0, 2.0, None]):
        rows = st.kde_curve(spark.createDataFrame([(v,) for v in values], "x double"), "x").collect()
        assert len(rows) == 200 and {r["density"] for r in rows} == {None}
