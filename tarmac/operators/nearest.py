"""Nearest station of each airport, without comparing every airport to every station."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.plans.lookup import fits_broadcast, lookup_join
from tarmac.plans.storage import materialize

EARTH_KM = 6371.0
MAX_DEPTH = 24


def _axes(metric: str) -> list[Column]:
    """Coordinates whose straight distance orders stations as the metric does."""
    lat, lon = F.radians("lat"), F.radians("lon")
    if metric == "radian":
        return [lat, lon]
    if metric == "haversine":
        return [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]
    raise ValueError("metric is 'radian' or 'haversine'")


def _length(parts: list[Column]) -> Column:
    return F.sqrt(reduce(add, [p * p for p in parts]))


def _constant(row) -> Column:
    """A (nested) row as a constant struct."""
    return F.struct(*[(_constant(v) if isinstance(v, tuple) else F.lit(v).cast("long" if isinstance(v, int) else "double")).alias(n) for n, v in row.asDict().items()])


def nearest(
    airports: DataFrame, stations: DataFrame, airport: str, station: str, metric: str = "radian", leaf: int = 16
) -> DataFrame:
    """One row per airport: id, nearest station id, distance_km. Equal distances go to the smaller station id.

    ``metric='radian'`` is the straight distance between (lat, lon) in radians times the earth radius, without a
    cos(lat) factor or wrap at 180 degrees; ``'haversine'`` is the great circle. An airport without coordinates, or without any
    station, keeps null station and distance.

    The stations are laid in nested cells, halved per level until a cell holds at most ``leaf`` places. Airports go down
    level by level and keep only the cells that can still hold their nearest station, so an airport meets a handful of
    cells however many stations there are and wherever they crowd.
    """
    axes = _axes(metric)
    dims = range(len(axes))
    a = airports.select(F.col(airport).alias("_a"), *[x.alias(f"_a{i}") for i, x in enumerate(axes)])
    a = a.na.drop("any")
    places = stations.select(F.col(station).alias("_s"), *[x.alias(f"_s{i}") for i, x in enumerate(axes)])
    places = places.na.drop("any").groupBy(*[f"_s{i}" for i in dims]).agg(F.min("_s").alias("_s"))
    places = materialize(places, "stations")
    box = places.agg(
        F.count("*").alias("n"), *[f(f"_s{i}").alias(f"{n}{i}") for i in dims for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()

    def cell(depth: int) -> Column:
        side = 2**depth
        numbers = []
        for i in dims:
            low, high = (box[f"lo{i}"], box[f"hi{i}"]) if box["n"] else (0.0, 1.0)
            span = max(high - low, 1e-12)
            spot = F.floor((F.col(f"_s{i}") - low) / span * side)
            numbers.append(F.least(F.greatest(spot, F.lit(0)), F.lit(side - 1)).alias(f"c{i}"))
        return F.struct(*numbers)

    depth = 0
    if box["n"] and box["n"] > leaf:
        every = F.array(*[F.struct(F.lit(d).alias("d"), cell(d).alias("c")) for d in range(1, MAX_DEPTH + 1)])
        fullest = places.select(F.explode(every).alias("x")).groupBy("x.d", "x.c").count().groupBy("d").agg(F.max("count").alias("n"))
        fits = [r["d"] for r in fullest.filter(F.col("n") <= leaf).collect()]
        depth = min(fits, default=MAX_DEPTH)

    # one table for all levels: cell -> its (four or eight) children with the extent of their places
    bounds = [f(f"_s{i}").alias(f"{n}{i}") for i in dims for n, f in (("lo", F.min), ("hi", F.max))]
    coords = [f"_s{i}" for i in dims]
    links = F.array(*[F.struct(F.lit(d).alias("level"), cell(d - 1).alias("_cell"), cell(d).alias("child")) for d in range(1, depth + 1)])
    todo = a.withColumn("_cell", F.struct(*[F.lit(0).cast("long").alias(f"c{i}") for i in dims]))
    per_airport = Window.partitionBy("_a")
    if depth:
        below = places.select(*coords, F.explode(links).alias("x")).groupBy("x.level", "x._cell", "x.child").agg(*bounds)
        child = F.struct("child", *[f"{n}{i}" for i in dims for n in ("lo", "hi")])
        tree = materialize(below.groupBy("level", "_cell").agg(F.collect_list(child).alias("_below")), "cells", ["level"])
        small = fits_broadcast(tree)
    for d in range(1, depth + 1):
        children = tree.filter(F.col("level") == d).drop("level")
        if d == 1:  # the one top cell: its few children are constants
            cells = F.array(*[_constant(b) for b in children.first()["_below"]])
            open_ = a.withColumn("_b", F.explode(cells))
        else:
            open_ = lookup_join(todo, children, ["_cell"], "inner", small=small).withColumn("_b", F.explode("_below"))
        gaps, reach = [], []
        for i in dims:
            low, high, here = F.col(f"_b.lo{i}"), F.col(f"_b.hi{i}"), F.col(f"_a{i}")
            gaps.append(F.greatest(low - here, here - high, F.lit(0.0)))
            reach.append(F.greatest(F.abs(here - low), F.abs(here - high)))
        open_ = open_.withColumns({"_near": _length(gaps), "_far": _length(reach)})
        open_ = open_.withColumn("_bound", F.min("_far").over(per_airport))
        # a hair of slack, so that rounding never drops the right cell
        keep = F.col("_near") <= F.col("_bound") * (1 + 1e-12)
        todo = open_.filter(keep).select(*a.columns, F.col("_b.child").alias("_cell"))

    place = F.struct("_s", *[f"_s{i}" for i in dims])
    leaves = materialize(places.groupBy(cell(depth).alias("_cell")).agg(F.collect_list(place).alias("_in")), "leaves")
    pairs = lookup_join(todo, leaves, ["_cell"], "inner").withColumn("_p", F.explode("_in"))
    away = _length([F.col(f"_a{i}") - F.col(f"_p._s{i}") for i in dims])
    found = pairs.groupBy("_a").agg(F.min(F.struct(away.alias("d"), F.col("_p._s").alias("s"))).alias("_best"))
    best = airports.select(F.col(airport).alias("_a")).distinct().join(found, "_a", "left")
    d = F.col("_best.d")
    angle = d if metric == "radian" else 2 * F.asin(F.least(d / 2, F.lit(1.0)))
    return best.select(
        F.col("_a").alias(airport), F.col("_best.s").alias(station), (angle * EARTH_KM).alias("distance_km")
    )
