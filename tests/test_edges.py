"""Nulls, constants and absent classes; equal results on both sides of every plan switch."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tarmac.ml import evaluate
from tarmac.ml.models import make_estimator
from tarmac.operators import encoding, history, nearest, stats
from tarmac.plans import lookup

ROOT = Path(__file__).resolve().parents[1]
FLIGHTS = [
    ("A", "2024-01-01", 10, 1, 5.0), ("A", "2024-01-01", 20, 2, 7.0), ("A", None, 5, 3, -0.0), ("A", None, 6, 4, None), ("A", None, None, 5, 1.0),
    (None, "2024-01-01", 10, 6, 2.0), (None, "2024-01-01", 10, 7, 3.0), (None, None, None, 8, 4.0), (None, None, None, 9, float("nan")),
]


def test_history_layouts_agree_on_null_keys(spark):
    df = spark.createDataFrame(FLIGHTS, "Origin string, FlightDate string, CRSDepTime int, id int, DepDelayMinutes double")
    got = {}
    for layout in ("keyed", "blocks"):
        rows = history.flight_history(df, ["id"], frames=(2, 3), layout=layout, at_least=3).collect()
        got[layout] = sorted((r.id, str(r.past_2_avg_delay), str(r.past_3_avg_delay), r.cumulative_flights_before) for r in rows)
    assert got["keyed"] == got["blocks"] and len(got["keyed"]) == len(FLIGHTS)


@pytest.mark.parametrize("leaf", [1, 100])
def test_airports_without_coordinates_stay(spark, leaf):
    airports = spark.createDataFrame([("A", 1.0, 1.0), ("B", None, 2.0), ("C", 3.0, None)], "a string, lat double, lon double")
    stations = spark.createDataFrame([(f"S{i}", float(i), float(i)) for i in range(9)], "s string, lat double, lon double")
    got = {r.a: (r.s, r.distance_km is None) for r in nearest.nearest(airports, stations, "a", "s", leaf=leaf).collect()}
    assert got == {"A": ("S1", False), "B": (None, True), "C": (None, True)}
    assert nearest.nearest(airports, stations.limit(0), "a", "s", leaf=leaf).count() == 3


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_lookup_join_with_null_keys(spark, max_bytes):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (None, 20)], "k int, w int")
    plain = {r.v: r.w for r in lookup.lookup_join(left, right, ["k"], max_bytes=max_bytes).collect()}
    safe = {r.v: r.w for r in lookup.lookup_join(left, right, ["k"], max_bytes=max_bytes, null_safe=True).collect()}
    assert plain == {"a": 10, "b": None, "c": None} and safe == {"a": 10, "b": 20, "c": None}


def test_constants_give_null(spark):
    df = spark.createDataFrame([(1.0, float(i), None if i < 7 else 2.0 * i, "x" if i % 2 else "y") for i in range(10)], "c double, x double, y double, g string")
    r = {(p.a, p.b): p.r for p in stats.pearson_matrix(df, ["c", "x", "y"]).collect()}
    assert r["c", "x"] is None and r["x", "y"] == pytest.approx(1.0)
    best = {p.feature: p.f_score for p in encoding.select_k_best(df, ["c", "y"], "x").collect()}
    assert best["c"] is None and best["y"] > 1e9
    row = stats.welch_t(df, "g", "c", "x", "y", p_value=False).first()
    assert row.t is None and row.dof is None


def test_pairs_are_counted_per_feature(spark):
    rows = [(float(i), float(i * i % 7) if i < 10 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "t double, f double")
    whole, part = (encoding.select_k_best(x, ["f"], "t").first().f_score for x in (df, df.where("f is not null")))
    assert whole == pytest.approx(part)


def test_absent_class(spark):
    preds = spark.createDataFrame([("m", 0.1, 0.0), ("m", 0.9, 0.0)], "model string, score double, label double")
    assert evaluate.roc_auc(preds).first().auc is None
    assert {p.tpr for p in evaluate.roc_curve(preds).collect()} == {0.0, None}


def test_perceptron_penalty_is_shared_by_a_batch():
    assert make_estimator("mlp_reg", {"alpha": 1.0}, rows=1000).getOrDefault("alpha") == pytest.approx(1 / 200)
    assert make_estimator("mlp_reg", {"alpha": 1.0}, rows=50).getOrDefault("alpha") == pytest.approx(1 / 50)
    with pytest.raises(ValueError):
        make_estimator("mlp_clf", {"trainer": "layers", "activation": "relu"}, rows=10, width=3)


def test_workers_get_the_package_from_any_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', {str(tmp_path)!r}).getOrCreate()
import __spark_entry__ as e
print('ROWS', e.queries()['fisher_exact'](spark, '/root/testdata/sf0.001').count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_scopes_delete_their_own_stage_tables_only(spark):
    from pathlib import Path

    from tarmac.plans import storage as st

    outer = st.materialize(spark.range(5), "outer")
    with st.stages(spark) as name:
        inner = st.materialize(spark.range(7), "inner")
        path = Path(st._made[name][0])
        assert inner.count() == 7 and path.exists()
    assert not path.exists() and name not in st._made and outer.count() == 5
    assert st.drop_stages(spark) >= 1 and st.drop_stages(spark) == 0
