"""Unlimited forests beside plain computations."""

import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tarmac.ml import blocks as bl
from tarmac.ml import forest as fo
from tarmac.plans.storage import drop_stages


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    drop_stages(spark)


def frame(spark, x, y):
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join([*[f"x{i} double" for i in range(x.shape[1])], "label double"]))
    return df.withColumn("features", array_to_vector(F.array(*[f"x{i}" for i in range(x.shape[1])]))).select("features", "label").repartition(4)


@pytest.mark.parametrize("kind", ["clf", "reg"])
@pytest.mark.parametrize("node_rows", [1 << 18, 40])
def test_trees_are_grown_to_purity(spark, monkeypatch, kind, node_rows):
    monkeypatch.setattr(bl, "MIN_ROWS", 100)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 0.5).astype(float) if kind == "clf" else rng.normal(size=400)
    df = frame(spark, x, y)
    model = fo.fit_forest(df, fo.ForestPlan(kind, 2, bootstrap=False), node_rows=node_rows)
    out = model.transform(df).collect()
    assert len(out) == 400 and max(abs(r.prediction - r.label) for r in out) < 1e-9
    assert (max(len(t[0]) for t in model.tops) > 1) == (node_rows == 40)
    assert model.importances.sum() == pytest.approx(1) and (model.importances > 0).all()


def test_forest_finds_what_matters_and_repeats(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = (x[:, 2] + 0.3 * rng.normal(size=600) > 0).astype(float)
    train, test = frame(spark, x[:450], y[:450]), frame(spark, x[450:], y[450:])
    runs = [fo.fit_forest(d, fo.ForestPlan("clf", 25)) for d in (train, train.repartition(2))]
    scores = [sorted(r.score for r in m.transform(test).collect()) for m in runs]
    assert scores[0] == pytest.approx(scores[1])
    assert runs[0].importances.argmax() == 2 and runs[0].importances[2] > 0.5
    hit = runs[0].transform(test).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert hit > 0.85


def test_equal_rows_with_other_labels_end_in_one_leaf(spark):
    df = frame(spark, np.ones((6, 2)), np.array([0, 0, 0, 1, 1, 1.0]))
    model = fo.fit_forest(df, fo.ForestPlan("reg", 1, bootstrap=False), node_rows=2)
    assert {r.prediction for r in model.transform(df).collect()} == {0.5}
    assert model.transform(df.limit(0)).collect() == []


def test_limited_forests_keep_the_place_of_a_row_between_levels():
    from tarmac.ml.models import make_estimator

    assert all(make_estimator(name, {}).getOrDefault("cacheNodeIds") for name in ("rf_clf", "rf_reg"))


def plain_gains(x, y, w):
    """Gain by feature of the tree with pure leaves, one node and one cut at a time."""
    total, waiting = np.zeros(x.shape[1]), [np.arange(len(x))]
    while waiting:
        rows = waiting.pop()
        cuts = [(f, c) for f in range(x.shape[1]) for c in np.unique(x[rows, f])[:-1]]
        if len(set(y[rows])) < 2 or not cuts:
            continue

        def square(part):
            return (w[part] * y[part]).sum() ** 2 / w[part].sum()

        gains = [square(rows[x[rows, f] <= c]) + square(rows[x[rows, f] > c]) - square(rows) for f, c in cuts]
        f, c = cuts[int(np.argmax(gains))]
        total[f] += max(gains)
        waiting += [rows[x[rows, f] <= c], rows[x[rows, f] > c]]
    return total


@pytest.mark.parametrize("tried", [1, 3])
def test_all_nodes_of_a_level_are_split_at_once(monkeypatch, tried):
    calls, cuts = [], fo._best_cuts
    monkeypatch.setattr(fo, "_best_cuts", lambda *a: calls.append(1) or cuts(*a))
    rng = np.random.default_rng(3)
    x, y, w = rng.normal(size=(2000, 3)), rng.normal(size=2000), rng.integers(1, 4, 2000).astype(float)
    piece = fo.grow(x, y, w, tried, rng)
    assert len(piece[0]) == 3999 and len(calls) < 100
    assert np.abs(fo.predict(piece[:5], x) - y).max() < 1e-9
    mean = (w * y).sum() / w.sum()
    assert piece[4][0] == pytest.approx(mean) and piece[5].sum() == pytest.approx((w * (y - mean) ** 2).sum())


def test_level_by_level_growth_finds_the_splits_of_a_plain_loop():
    rng = np.random.default_rng(4)
    x, y, w = rng.permutation(240).reshape(60, 4) * 1.0, rng.normal(size=60), rng.integers(1, 4, 60).astype(float)
    w[:5] = 2
    x[:20, 0] = x[0, 0]  # long runs of one value
    x[:, 3] = 1.0  # one value only, looked at by every node
    gains = fo.grow(x, y, w, 4, np.random.default_rng(0))[5]
    # in nodes of two rows any feature gains the same, so only the sums over the whole tree and larger nodes agree
    assert gains.sum() == pytest.approx(plain_gains(x, y, w).sum()) and gains[3] == 0
    alone = fo.grow(x[:, :1], y, w, 1, np.random.default_rng(0))
    assert alone[5] == pytest.approx(plain_gains(x[:, :1], y, w))
    first = [(f, c) for f in range(4) for c in np.unique(x[:, f])[:-1]]
    scores = [sum((w[m] * y[m]).sum() ** 2 / w[m].sum() for m in (x[:, f] <= c, x[:, f] > c)) for f, c in first]
    root = fo.grow(x, y, w, 4, np.random.default_rng(0))
    f, c = first[int(np.argmax(scores))]
    assert root[0][0] == f and np.array_equal(x[:, f] <= root[1][0], x[:, f] <= c)
    same = fo.grow(np.ones((6, 2)), np.array([0, 0, 0, 1, 1, 1.0]), np.ones(6), 1, rng)
    assert len(same[0]) == 1 and same[4][0] == 0.5 and same[2][0] == 0
    assert len(fo.grow(np.ones((1, 2)), np.ones(1), np.ones(1), 2, rng)[0]) == 1


def test_rows_are_sent_in_large_portions(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(fo, "SENT_ROWS", 25)
    batches = [pd.DataFrame({"x": [[float(i), 1.0]] * 10, "_fid": np.arange(10) + 10 * i}) for i in range(7)] + [pd.DataFrame({"x": [], "_fid": []})]
    found = list(fo._gathered(iter(batches), 2))
    assert [len(ids) for _, ids in found] == [30, 30, 10] and np.array_equal(np.concatenate([i for _, i in found]), np.arange(70))
    assert np.array_equal(np.concatenate([x for x, _ in found])[:, 0], np.arange(70) // 10)


@pytest.mark.parametrize("kind", ["clf", "reg"])
def test_only_splits_of_upper_levels_come_to_the_driver(spark, monkeypatch, kind):
    monkeypatch.setattr(bl, "MIN_ROWS", 100)
    monkeypatch.setattr(fo, "SUM_BYTES", 3 * 2 * 4 * 256 * 8)  # three nodes at a time
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 4))
    y = x[:, 1] + rng.normal(size=900)
    y = (y > 0).astype(float) if kind == "clf" else y
    rows, columns = bl.vector_columns(frame(spark, x, y), "features", ["label"])
    packed = bl.pack(rows, columns, ["label"])
    sent, collect = [], type(packed.rdd).collect

    def watched(rdd):
        found = collect(rdd)
        sent.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", watched)
    monkeypatch.setattr(type(packed.rdd), "collect", watched)
    plan = fo.ForestPlan(kind, 6)
    edges = [np.array(e) for e in fo.bin_edges(rows, columns, fo.BINS)]
    tops = fo._tops(packed, plan, edges, 60)
    assert max(sent) < 2 * 4 * 256 * 8 and len(sent) > 10  # less than the sums of one node
    blocks = collect(packed.rdd)
    for number, top in enumerate(tops):
        tree, ends = top.tree.packed(), {}
        for block in blocks:
            w = fo._weights(plan, number, block)
            for node, weight in zip(fo.leaf_of(tree, fo.code_rows(block.x, edges, fo.BINS), fo.BINS), w):
                ends[int(node)] = ends.get(int(node), 0) + int(weight)
        leaves = [n for n in range(len(tree[3])) if tree[3][n] == n]
        assert len(leaves) > 8 and all(top.rows[n] == ends.get(n, 0) and (top.rows[n] <= 60 or n in top.closed) for n in leaves)
