"""Hot keys and equal rows: the ways around them give the same rows as the plain ones."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators import history as hx
from tarmac.operators import nearest as nx
from tarmac.operators import sampling as sp
from tarmac.plans import ordering
from tarmac.plans.lookup import lookup_join


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows are equal, and most rows share one origin."""
    base = spark.range(6000).withColumn("dup", F.col("id") % 3 == 0)
    key = F.when(F.col("dup"), 0).otherwise(F.col("id"))
    return base.select(
        key.alias("id"), (key % 2).cast("double").alias("y"), F.when(key % 10 < 7, "HUB").otherwise(F.concat(F.lit("A"), (key % 5).cast("string"))).alias("Origin"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int")).alias("FlightDate"), (key % 7).cast("int").alias("CRSDepTime"), (key % 13).cast("double").alias("DepDelayMinutes"),
    )


def test_blocks_equal_keyed(spark, skewed):
    keyed, blocks = (hx.flight_history(skewed, ["id"], layout=m, at_least=500) for m in ("keyed", "blocks"))
    assert rows(keyed) == rows(blocks)
    filled = [hx.flight_history(skewed, ["id"], fill="reference", layout=m, at_least=500) for m in ("keyed", "blocks")]
    assert rows(filled[0]) == rows(filled[1])


def test_hot_key_is_seen(spark, skewed):
    assert hx.has_hot_key(skewed, ["Origin"], 1000)
    assert not hx.has_hot_key(skewed, ["Origin"], 10_000)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, skewed, how):
    right = spark.createDataFrame([("HUB", 1), ("A1", 2)], "Origin string, v int")
    assert rows(lookup_join(skewed, right, ["Origin"], how)) == rows(lookup_join(skewed, right, ["Origin"], how, small=False))


def test_running_totals(spark, skewed):
    counts = skewed.groupBy("Origin", "id").agg(F.count("*").alias("n"))
    got = ordering.running_totals(counts, [F.col("id")], {"run": "n"}, ["Origin"], at_least=100)
    want = counts.withColumn("run", F.sum("n").over(Window.partitionBy("Origin").orderBy("id")))
    assert rows(got) == rows(want)
    plain = ordering.running_totals(counts, [F.col("id")], {"run": "n"}, at_least=100).agg(F.max("run")).first()[0]
    assert plain == skewed.count()


def test_global_index_is_dense_and_sorted(spark, skewed):
    out = ordering.global_index(skewed, [F.col("Origin"), F.col("id")]).orderBy("gidx").collect()
    assert [r["gidx"] for r in out] == list(range(6000))
    keys = [(r["Origin"], r["id"]) for r in out]
    assert keys == sorted(keys)


@pytest.mark.parametrize("k", [0, 1, 1999, 2000, 2001, 3500, 6000])
def test_exact_size_with_equal_rows(spark, skewed, k):
    out = sp.mark_exact(skewed, lambda sizes: sizes.withColumn("_k", F.lit(k).cast("long")), ["id"])
    assert out.count() == 6000
    assert out.filter("picked").count() == k
    assert rows(out.drop("picked")) == rows(skewed)


def test_folds_are_even(spark, skewed):
    out = sp.kfold_assign(skewed, 5, ["id"], ["y"])
    for r in out.groupBy("y").agg(*[F.count_if(F.col("fold") == f).alias(str(f)) for f in range(5)]).collect():
        sizes = list(r)[1:]
        assert max(sizes) - min(sizes) <= 1
    assert rows(out) == rows(sp.kfold_assign(skewed.repartition(3), 5, ["id"], ["y"]))


@pytest.mark.parametrize("k", [1, 2, 3, 7, 50])
def test_folds_are_parts_of_the_hash_order(spark, k):
    df = spark.range(40).select((F.col("id") % 23).alias("id"), F.when(F.col("id") < 30, "a").when(F.col("id") < 37, None).otherwise("b").alias("g"), F.col("id").alias("v"))
    out = sp.kfold_assign(df, k, ["id"], ["g"]).withColumn("h", sp.hash_key(["id"])).collect()
    for g in ("a", None, "b"):
        own = sorted((r["h"], r["v"], r["fold"]) for r in out if r["g"] == g)
        assert [f for _, _, f in own] == [i * k // len(own) for i in range(len(own))]
    assert "Exchange rangepartitioning" not in sp.kfold_assign(spark.range(1000), 5, ["id"])._jdf.queryExecution().executedPlan().toString()


def test_split_is_disjoint_complete_and_stable(spark, skewed):
    distinct = skewed.dropDuplicates(["id"])
    n = distinct.count()
    seen = []
    for parts in ("1", "4", "50"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            train, test = sp.train_test_split(distinct.repartition(int(parts), F.rand(int(parts))), ["id"])
            ids = sorted(r["id"] for r in test.collect())
            assert len(ids) == -(-n // 5)
            assert not set(ids) & {r["id"] for r in train.collect()}
            assert len(ids) + train.count() == n
            seen.append(ids)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2]


def test_undersample_is_even_and_reports_shortage(spark, skewed):
    df = skewed.withColumn("late", F.when(F.col("id") % 5 == 1, 1.0).when(F.col("id") % 5 != 2, 0.0))
    out = sp.undersample(df, "late", ["id"], ["Origin"])
    for r in out.groupBy("Origin").agg(F.count_if(F.col("late") == 1).alias("a"), F.count_if(F.col("late") == 0).alias("b")).collect():
        assert r["a"] == r["b"]
    assert rows(out.filter("late = 1")) == rows(df.filter("late = 1"))
    with pytest.raises(ValueError, match="fewer on-time"):
        sp.undersample(df.withColumn("late", 1 - F.col("late")), "late", ["id"])


@pytest.mark.parametrize("metric", ["radian", "haversine"])
def test_nearest_against_all_pairs(spark, metric):
    """Crowded and far stations, equal positions, ties."""
    lat = F.when(F.col("id") % 3 == 0, 10 + F.rand(1) / 1000).otherwise(F.rand(2) * 160 - 80)
    lon = F.when(F.col("id") % 3 == 0, 10 + F.rand(3) / 1000).otherwise(F.rand(4) * 340 - 170)
    stations = spark.range(400).select(F.col("id").alias("s"), F.round(lat, 4).alias("lat"), F.round(lon, 4).alias("lon")).persist()
    stations = stations.unionByName(stations.withColumn("s", F.col("s") + 1000))
    airports = spark.range(60).select(F.col("id").alias("a"), (F.rand(5) * 160 - 80).alias("lat"), (F.rand(6) * 340 - 170).alias("lon")).persist()
    got = {r["a"]: (r["s"], round(r["distance_km"], 6)) for r in nx.nearest(airports, stations, "a", "s", metric, leaf=4).collect()}
    import math

    def dist(p, q):
        a, b, c, d = (math.radians(v) for v in (p["lat"], p["lon"], q["lat"], q["lon"]))
        if metric == "radian":
            return math.hypot(a - c, b - d) * 6371
        h = math.sin((a - c) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((b - d) / 2) ** 2
        return 2 * math.asin(math.sqrt(h)) * 6371

    places = stations.collect()
    for a in airports.collect():
        d, s = min((dist(a, q), q["s"]) for q in places)
        assert got[a["a"]] == (s, pytest.approx(d, abs=1e-5))
    single = nx.nearest(airports, stations.limit(1), "a", "s", metric)
    assert single.count() == 60


def test_folds_leave_values_of_a_hot_id_untouched(spark):
    df = spark.range(40).select(F.lit(7).alias("id"), F.when(F.col("id") % 2 == 0, F.lit(-0.0)).otherwise(1.0).alias("x"), F.create_map(F.lit("a"), F.col("id") % 3).alias("m"))
    out = sp.kfold_assign(df, 5, ["id"]).collect()
    assert sorted(str(r["x"]) for r in out) == ["-0.0"] * 20 + ["1.0"] * 20
    assert sorted(r["m"]["a"] for r in out) == sorted(i % 3 for i in range(40))
    assert sorted(r["fold"] for r in out) == sorted(list(range(5)) * 8)
