"""Flight, weather and station views derived from the driver's test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.lookup import fits_broadcast, lookup_join
from tarmac.plans.ordering import even_parts
from tarmac.sources.readers import scan_parquet, spread

CALENDAR_YEARS = (1995, 2001)
ROW_ID = ["ok", "ln", "pk", "sk"]
ELEMENT_OF_EVENT = {"purchase": "PRCP", "view": "SNOW", "click": "SNWD", "signup": "TMAX"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet", list(columns) or None)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per order line. Line 7 stands for cancelled flights, whose measures are null."""
    line = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    order = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").withColumnRenamed("o_orderkey", "l_orderkey")
    small = fits_broadcast(order)
    if small:
        line = spread(line, "l_orderkey")
    else:
        parts = even_parts(spark, line_count(spark, sf_dir))
        line, order = line.repartition(parts, "l_orderkey"), order.repartition(parts, "l_orderkey")
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    qty = F.col("l_quantity")
    flown = ln != 7

    def measured(value):
        return F.when(ln.isNull() | flown, value)

    return lookup_join(line, order, ["l_orderkey"], "inner", small=small).select(
        ok.alias("ok"),
        ln.alias("ln"),
        pk.alias("pk"),
        sk.alias("sk"),
        F.date_add(F.lit("2024-01-01").cast("date"), ((ok + ln * 7) % 31).cast("int")).alias("FlightDate"),
        F.col("l_shipdate").cast("date").alias("CalendarDate"),
        F.col("o_orderpriority").alias("Airline"),
        F.concat(F.lit("A"), sk.cast("string")).alias("Origin"),
        _destination(pk).alias("Dest"),
        ((ok * 37 % 25) * 100 + pk % 61).cast("int").alias("CRSDepTime"),
        ((ok * 11 % 24) * 100 + pk % 60).cast("int").alias("CRSArrTime"),
        measured(qty * 10).alias("AirTime"),
        (F.col("l_extendedprice") / 20).alias("Distance"),
        measured(F.when(qty > 30, (qty - 30) * 5).otherwise(0.0)).alias("DepDelayMinutes"),
        measured(F.when(qty >= 33, 1.0).otherwise(0.0)).alias("DepDel15"),
        measured((pk % 50).cast("double")).alias("ArrDelayMinutes"),
        measured((qty - 30) * 5).alias("DepDelay"),
        measured((pk % 50 - 10).cast("double")).alias("ArrDelay"),
        (ln == 7).alias("Cancelled"),
        ((ln == 6) & (ok % 5 == 0)).alias("Diverted"),
    )


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Order lines, at least as many as flights, from the footers of the files."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def _destination(part: Column) -> Column:
    return F.concat(F.lit("A"), (part % 100 + 1).cast("string"))


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All airports that flights arrive at, from one column of the order lines."""
    return table(spark, sf_dir, "lineitem", "l_partkey").select(_destination(F.col("l_partkey")).alias("Airport")).distinct()


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long weather: one station reading per event."""
    ev = spread(table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value"), "user_id")
    element = F
    for event, name in ELEMENT_OF_EVENT.items():
        element = element.when(F.col("event_type") == event, name)
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("STATION"),
        F.date_format("ts", "yyyyMMdd").alias("DATE"),
        element.otherwise("TMIN").alias("ELEMENT"),
        F.col("value").alias("VALUE"),
        F.col("ts").alias("obs_order"),
    )


def station_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events", "user_id").filter("user_id % 3 <> 0").distinct()
    uid = F.col("user_id").cast("string")
    return users.select(
        F.concat(F.lit("A"), uid).alias("Airport"),
        F.concat(F.lit("U"), uid).alias("Closest_Station"),
        F.col("user_id").alias("line"),
    )


# The same views for the checking engine.
DUCK_VIEWS = {
    "flights": """
SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk,
  (DATE '2024-01-01' + CAST((l.l_orderkey + l.l_linenumber * 7) % 31 AS INT)) AS FlightDate,
  CAST(l.l_shipdate AS DATE) AS CalendarDate,
  o.o_orderpriority AS Airline,
  concat('A', CAST(l.l_suppkey AS VARCHAR)) AS Origin,
  concat('A', CAST(l.l_partkey % 100 + 1 AS VARCHAR)) AS Dest,
  CAST((l.l_orderkey * 37 % 25) * 100 + l.l_partkey % 61 AS INT) AS CRSDepTime,
  CAST((l.l_orderkey * 11 % 24) * 100 + l.l_partkey % 60 AS INT) AS CRSArrTime,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_quantity * 10 END AS AirTime,
  l.l_extendedprice / 20 AS Distance,
  CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_quantity > 30 THEN (l.l_quantity - 30) * 5 ELSE CAST(0 AS DOUBLE) END AS DepDelayMinutes,
  CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_quantity >= 33 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS DepDel15,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_partkey % 50 AS DOUBLE) END AS ArrDelayMinutes,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE (l.l_quantity - 30) * 5 END AS DepDelay,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_partkey % 50 - 10 AS DOUBLE) END AS ArrDelay,
  (l.l_linenumber = 7) AS Cancelled,
  (l.l_linenumber = 6 AND l.l_orderkey % 5 = 0) AS Diverted
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "observations": """
SELECT concat('U', CAST(user_id AS VARCHAR)) AS STATION, strftime(ts, '%Y%m%d') AS DATE,
  CASE event_type WHEN 'purchase' THEN 'PRCP' WHEN 'view' THEN 'SNOW' WHEN 'click' THEN 'SNWD'
                  WHEN 'signup' THEN 'TMAX' ELSE 'TMIN' END AS ELEMENT,
  value AS VALUE, ts AS obs_order
FROM events""",
    "station_key": """
SELECT DISTINCT concat('A', CAST(user_id AS VARCHAR)) AS Airport, concat('U', CAST(user_id AS VARCHAR)) AS Closest_Station
FROM events WHERE user_id % 3 <> 0""",
}
