"""Shapes of physical plans."""

import contextlib
import io
import re

import pytest

from tarmac.catalog import QUERIES
from tarmac.operators import history as hx
from tarmac.sources import demo

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_history_is_one_exchange_and_one_sort(spark):
    base = demo.flights(spark, SF_DIR)
    text = plan(hx.flight_history(base, demo.ROW_ID, layout="keyed"))
    tree = text[: text.index("(1) Scan")]
    scan_side = plan(base)
    before = scan_side[: scan_side.index("(1) Scan")]
    assert len(re.findall(r" Exchange \(", tree)) - len(re.findall(r" Exchange \(", before)) == 1
    assert len(re.findall(r" Sort \(", tree)) == 1


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["count_by_airline"](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert not any("l_extendedprice" in s or "l_quantity" in s for s in schemas)


def test_year_filter_reaches_the_scan(spark):
    df = demo.table(spark, SF_DIR, "lineitem", "l_orderkey", "l_quantity", "l_suppkey").filter("l_suppkey = 7")
    assert "EqualTo(l_suppkey,7)" in plan(df)


ROW_LEVEL = [
    "merge_weather", "merge_rolling_weather", "flight_history", "past_flights", "cumulative_flights", "undersample", "kfold_assign",
    "train_test_split", "target_encode_train", "airport_congestion", "holiday_flag", "describe", "multi_agg", "nearest_station", "drop_duplicates",
]


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_no_pairing_joins_and_no_single_task_windows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    windows = text.count(" Window (")
    assert not (windows and "SinglePartition" in text and re.search(r"Arguments: SinglePartition.*\n\n\(\d+\) Sort", text))


def test_flights_are_not_shuffled_for_a_side_of_few_airports(spark, monkeypatch):
    import inspect

    from pyspark.sql import functions as F

    from tarmac.operators import weather as wx
    from tarmac.plans import lookup

    days = spark.range(4_000).select(
        F.concat(F.lit("A"), (F.col("id") % 400).cast("string")).alias("STATION"), F.expr("date'2024-01-01' + cast(id div 400 as int)").alias("DATE"),
        *[F.col("id").cast("double").alias(e) for e in ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")],
    )
    flights = spark.range(3_000).select(
        "id", F.expr("date'2024-01-01' + cast(id % 12 as int)").alias("FlightDate"), F.concat(F.lit("A"), (F.col("id") % 700).cast("string")).alias("Origin"),
        F.concat(F.lit("A"), (F.col("id") % 9 + 395).cast("string")).alias("Dest"),
    )
    bytes_of_few = lookup.memory_bytes(days.filter("STATION >= 'A395' AND STATION <= 'A399'")) * 3
    for function in (lookup.fits_broadcast, lookup.lookup_join):
        defaults = [bytes_of_few if v == lookup.BROADCAST_BYTES else v for v in function.__defaults__]
        assert "max_bytes" in inspect.signature(function).parameters
        monkeypatch.setattr(function, "__defaults__", tuple(defaults))
    conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, known = wx.merge_weather(flights, days), wx.merge_weather(flights, days, airports={"Dest": flights.select(F.col("Dest").alias("Airport"))})
        joins = [plan(d).count("SortMergeJoin") for d in (plain, known)]
        assert joins[1] < joins[0] and "BroadcastHashJoin" in plan(known)
        assert sorted(map(str, plain.collect())) == sorted(map(str, known.collect())) and known.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)


def test_percentiles_beside_other_columns_read_a_written_table(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tarmac.operators import explore as ex

    joined = spark.range(40).withColumn("k", F.col("id") % 2).join(spark.range(30), "id").withColumn("v", F.col("id").cast("double"))
    asked = []
    for name in ("exact_quantiles", "quantile_map"):
        monkeypatch.setattr(ex, name, lambda df, *a, own=getattr(ex, name): (asked.append(plan(df)), own(df, *a))[1])
    got = {r["k"]: (r["v_mean"], r["v_median"], r["id_sum"]) for r in ex.mean_median_sum(joined, ["k"], ["v"], ["id"]).collect()}
    assert got == {0: (14.0, 14.0, 210), 1: (15.0, 15.0, 225)}
    assert ex.cap_outliers(joined, ["v"], 0.1, 0.9).agg(F.min("v"), F.max("v")).first()[:] == pytest.approx((2.9, 26.1))
    assert len(asked) == 2 and not any("Join" in text for text in asked)


def test_routes_are_dealt_over_parts_of_bounded_length(spark, monkeypatch):
    from tarmac.plans import ordering

    monkeypatch.setattr(ordering, "PART_ROWS", 250)
    lines = demo.table(spark, SF_DIR, "lineitem", "l_orderkey").count()
    assert ordering.even_parts(spark, lines) == -(-lines // 250) > 8 == ordering.even_parts(spark, 1)
    out = QUERIES["avg_snow_route"](spark, SF_DIR)
    assert f"{-(-lines // 250)}), REPARTITION_BY_NUM" in plan(out)
    assert out.count() == out.select("FlightDate", "Origin", "Dest").distinct().count() > 0


def test_the_history_carries_no_columns_that_follow_from_others(spark, monkeypatch):
    from tarmac.plans import training_table as tt

    carried, own = [], tt.with_history

    def seen(flights, *rest):
        carried.append(flights.columns)
        return own(flights, *rest)

    monkeypatch.setattr(tt, "with_history", seen)
    train = QUERIES["final_train"](spark, SF_DIR)
    late = {*tt.CYCLICAL, *tt.FLAGS, "DayOfYear"}
    assert not late & set(carried[0]) and late <= set(train.columns)


def test_a_lookup_beyond_the_bound_is_not_broadcast_for_its_small_file(spark, tmp_path):
    from tarmac.plans.lookup import lookup_join

    spark.range(2_000_000).withColumnRenamed("id", "k").selectExpr("k", "true as found").write.parquet(f"{tmp_path}/right")
    right = spark.read.parquet(f"{tmp_path}/right").withColumnRenamed("k", "id")
    joined = lookup_join(spark.range(100), right.select("id", "found"), ["id"], max_bytes=1 << 20)
    text = plan(joined)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert joined.filter("found").count() == 100


def test_flights_are_sorted_in_parts_by_their_number(spark, monkeypatch):
    from tarmac.catalog.base import weather
    from tarmac.plans import lookup, training_table
    from tarmac.plans.ordering import PART_ROWS

    daily = weather(spark, SF_DIR)
    for function in (lookup.fits_broadcast, lookup.lookup_join):
        monkeypatch.setattr(function, "__defaults__", tuple(1 if v == lookup.BROADCAST_BYTES else v for v in function.__defaults__))
    many = training_table.with_history(demo.flights(spark, SF_DIR), daily, demo.ROW_ID, rows=19 * PART_ROWS - 5)
    text = plan(many)
    assert "BroadcastHashJoin" not in text
    assert re.search(r"hashpartitioning\(Origin#\d+, 19\)", text) and re.search(r"hashpartitioning\(Origin#\d+, FlightDate#\d+, 19\)", text)
    monkeypatch.undo()
    few = training_table.with_history(demo.flights(spark, SF_DIR), daily, demo.ROW_ID)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
