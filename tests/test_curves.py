"""Trend, curve, scatter, importance and run store beside plain computations."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tarmac.ml import blocks as bl
from tarmac.ml import evaluate as ev
from tarmac.ml.boosting import HistBoost
from tarmac.ml.store import RunStore
from tarmac.operators import stats as st
from tarmac.operators.trend import lowess
from tarmac.plans.storage import drop_stages


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    drop_stages(spark)


def textbook(x, y, share=2 / 3, rounds=3):
    """A fit at every row."""
    n, k = len(x), int(2 / 3 * len(x) + 1e-10)
    robust, fits = np.ones(n), np.zeros(n)
    for turn in range(rounds + 1):
        for i in range(n):
            d = np.abs(x - x[i])
            h = np.sort(d)[k - 1]
            w = np.maximum(1 - (d / h) ** 3, 0) ** 3 * robust
            m = (w * x).sum() / w.sum()
            slope = (w * (x - m) * y).sum() / (w * (x - m) ** 2).sum()
            fits[i] = (w * y).sum() / w.sum() + slope * (x[i] - m)
        r = np.abs(y - fits)
        robust = np.maximum(1 - (r / (6 * np.median(r))) ** 2, 0) ** 2
    return fits


@pytest.mark.parametrize("rows", [8_192, 50])
def test_lowess_equals_the_textbook(spark, monkeypatch, rows):
    monkeypatch.setattr(bl, "MIN_ROWS", rows)
    rng = np.random.default_rng(0)
    x = np.sort(rng.exponential(2, 151))
    y = np.sin(x) + rng.normal(size=151) * 0.1
    y[::10] += 20
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, None)], "x double, y double").repartition(3)
    got = lowess(df, "x", "y", places=151).orderBy("x").collect()
    expected = textbook(x, y)
    assert [r["x"] for r in got] == pytest.approx(list(x))
    assert max(abs(r["trend"] - e) for r, e in zip(got, expected)) < 1e-3
    coarse = lowess(df, "x", "y", places=60).orderBy("x").collect()
    assert np.abs(np.interp(x, [r["x"] for r in coarse], [r["trend"] for r in coarse]) - expected).max() < 0.1


def test_lowess_of_few_values(spark):
    one = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    assert [tuple(r) for r in lowess(one, "x", "y").collect()] == [(0, 2.0, 2.0)]
    assert lowess(one.limit(0), "x", "y").collect() == []


def test_curve_keeps_corners_and_area(spark):
    rng = np.random.default_rng(1)
    rows = [(m, float(rng.random() < 0.4), 0.0, float(np.round(rng.random(), d))) for m, d in (("fine", 6), ("coarse", 1)) for _ in range(400)]
    preds = spark.createDataFrame(rows, "model string, label double, prediction double, score double").repartition(4)
    full, thin = ({m: sorted((r.fpr, r.tpr) for r in df.collect() if r.model == m) for m in ("fine", "coarse")} for df in (ev.roc_curve(preds, False), ev.roc_curve(preds)))
    for m in full:
        area = [np.trapezoid([t for _, t in pts], [f for f, _ in pts]) for pts in (full[m], thin[m])]
        assert area[0] == pytest.approx(area[1]) and set(thin[m]) <= set(full[m]) and thin[m][-1] == (1.0, 1.0)
    assert len(thin["fine"]) < 0.8 * len(full["fine"])


def test_corners_across_blocks(spark, monkeypatch):
    from tarmac.plans import ordering

    preds = spark.createDataFrame([("m", float(i % 4 == 0), 0.0, float(i)) for i in range(200)] + [("n", 1.0, 0.0, 1.0)], "model string, label double, prediction double, score double").repartition(4)
    whole = sorted(map(str, ev.roc_curve(preds).collect()))
    monkeypatch.setattr(ordering, "MIN_BLOCK", 3)
    monkeypatch.setattr(ordering.block_rows, "__defaults__", (3,))
    monkeypatch.setattr(ordering.totals_along, "__defaults__", (3,))
    assert sorted(map(str, ev.roc_curve(preds).collect())) == whole


def test_scatter_counts_every_row(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b)) for a, b in rng.normal(size=(3000, 2))] + [(0.25, 0.25)] * 500 + [(None, 1.0)] * 7
    df = spark.createDataFrame(rows, "x double, y double").repartition(5)
    cells = st.scatter_cells(df, "x", "y", cells=50, depth=6, at_once=2).collect()
    assert sum(c.n for c in cells) == len(rows) and {c.n for c in cells if c.level is None} == {7}
    assert all(c.n <= 70 or c.level == 6 for c in cells if c.level is not None)
    x, y = np.array([r for r in rows if r[0] is not None]).T
    for c in cells:
        if c.level is not None:
            last = 2**c.level - 1
            right, top = x < c.x_high if c.cx < last else x <= x.max(), y < c.y_high if c.cy < last else y <= y.max()
            assert c.n == ((x >= c.x_low) & right & (y >= c.y_low) & top).sum()
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    assert [c.n for c in st.scatter_cells(same, "x", "y", cells=2, depth=3).collect()] == [5]
    assert st.scatter_cells(same.limit(0), "x", "y").collect() == []


def test_importance_is_a_shift_in_hash_order(spark):
    df = spark.range(40).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    df = df.withColumns({"label": F.col("a") * 3 + F.col("b") * 0.1, "features": array_to_vector(F.array("a", "b"))}).persist()
    model = LinearRegression().fit(df)
    got = {r.feature: r.importance for r in ev.permutation_importance(model, "m", df, ["a", "b"], "reg", ["id"], repeats=3).collect()}
    from tarmac.operators.sampling import hash_key

    rows = sorted((r.h, r.a, r.b, r.label) for r in df.select(hash_key(["id"]).alias("h"), "a", "b", "label").collect())
    a, b, y = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    w, c = model.coefficients, model.intercept
    for name, k in (("a", 0), ("b", 1)):
        lost = []
        for t in range(3):
            moved = [a, b]
            moved[k] = np.roll(moved[k], -(1 + int((t + 0.5) * 39 / 3)))
            lost.append((((y - c - w[0] * moved[0] - w[1] * moved[1]) ** 2).sum() - ((y - c - w[0] * a - w[1] * b) ** 2).sum()) / ((y - y.mean()) ** 2).sum())
        assert got[name] == pytest.approx(np.mean(lost), abs=1e-9)


def test_run_store(spark, tmp_path):
    df = spark.range(50).select(F.col("id").cast("double").alias("label"), array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    store = RunStore(spark, str(tmp_path / "runs"))
    assert store.runs() == []
    scores = spark.createDataFrame([("m", 0.5)], "model string, r2 double")
    for rounds in (1, 3):
        model = HistBoost(maxIter=rounds, leastRows=1).fit(df)
        store.save("hgb_reg", "tuned", model, scores, {"max_iter": rounds})
    store.save("search", "table", None, scores, {})
    assert store.runs() == [("hgb_reg", "tuned"), ("search", "table")]
    assert store.params("hgb_reg", "tuned") == {"max_iter": 3} and store.scores("hgb_reg", "tuned").collect() == scores.collect()
    again = store.model("hgb_reg", "tuned")
    assert [r.prediction for r in again.transform(df).collect()] == [r.prediction for r in model.transform(df).collect()]
    with pytest.raises(KeyError):
        store.model("hgb_reg", "base")


def test_trend_sums_meet_the_places_once_for_each_value():
    from tarmac.operators import trend

    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 9, 4000).astype(float), rng.normal(size=4000)
    block = bl.Block(0, x[:, None], y[:, None], np.full(4000, -1), np.arange(4000))
    places, radius, before = np.array([0.0, 3.5, 8.0]), np.array([2.0, 0.0, 5.0]), (np.array([0.1, -0.1, 0.0]), 2.0)
    seen = []
    real = np.abs
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(trend.np, "abs", lambda v: seen.append(np.shape(v)) or real(v))
        got = trend._sums(block, places, radius, 4.0, before)
    robust = np.maximum(1 - ((y - np.interp(x, places, before[0])) / 2.0) ** 2, 0) ** 2
    for k, (p, r) in enumerate(zip(places, radius)):
        w = np.maximum(1 - (np.abs(x - p) / r if r else (x != p) * 1.0) ** 3, 0) ** 3 * robust
        assert got[:, k] == pytest.approx([w.sum(), (w * (x - 4)).sum(), (w * (x - 4) ** 2).sum(), (w * y).sum(), (w * (x - 4) * y).sum()])
    assert (9, 3) in seen and all(len(s) == 1 or s[0] == 9 for s in seen)
