"""Boosted trees, stochastic steps, perceptrons and searches beside plain reference loops."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tarmac.ml import blocks as bl
from tarmac.ml import boosting as bo
from tarmac.ml import epochs as ep
from tarmac.ml import gram
from tarmac.ml import search as se
from tarmac.ml.gradient import gradient, loss_and_slope
from tarmac.plans.storage import drop_stages


@pytest.fixture(autouse=True)
def clean(spark):
    yield
    drop_stages(spark)


def table(n: int, seed: int = 0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = np.where(np.isnan(x[:, 1]), 3.0, x[:, 0] * (x[:, 2] > 0)) + rng.normal(size=n) * 0.1
    return x, y


def frame(spark, x, y, **more):
    rows = [tuple(map(float, [*a, b])) + tuple(int(v[i]) for v in more.values()) for i, (a, b) in enumerate(zip(x, y))]
    names = [f"x{i}" for i in range(x.shape[1])] + ["label"] + list(more)
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n in more else 'double'}" for n in names)).repartition(5)
    return df.withColumn("features", array_to_vector(F.array(*[f"x{i}" for i in range(x.shape[1])]))).persist()


def test_blocks_hold_every_row_once_and_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(bl, "MIN_ROWS", 64)
    x, y = table(500)
    df = frame(spark, x, y).unionByName(frame(spark, x[:1].repeat(300, 0), y[:1].repeat(300)))
    a, b = (bl.pack(d, ["x0", "x1", "x2"], ["label"]) for d in (df, df.repartition(2)))
    one, two = ({k.number: k for k in p.rdd.collect()} for p in (a, b))
    assert a.blocks == len(one) == 13 and max(len(k.x) for k in one.values()) == 64 and sum(len(k.x) for k in one.values()) == 800
    for i in one:
        assert np.array_equal(one[i].x, two[i].x, equal_nan=True) and np.array_equal(one[i].y, two[i].y)
    assert bl.rows_per_block(10**9, 7) == -(-(10**9) // 1024) and bl.rows_per_block(10**12, 7) * 7 * 8 <= bl.MOST_BYTES
    monkeypatch.setattr(bl, "DIRECT", 2)
    assert bl.add_up(a.rdd, lambda k: len(k.x), lambda p, q: p + q) == 800


def plain_boost(x, y, plan: bo.BoostPlan, edges):
    """Best-first trees, one split at a time, every histogram summed anew."""
    codes = bo.code_rows(x, [np.array(e) for e in edges], plan.bins)
    raw = np.full(len(y), y.mean() if plan.kind == "reg" else math.log(y.mean() / (1 - y.mean())))
    for _ in range(plan.rounds):
        g, h = bo._slopes(plan.kind, raw, y)
        h = np.ones(len(y)) if h is None else h

        def sums(rows):
            out = np.zeros((3, x.shape[1], plan.bins + 1))
            for f in range(x.shape[1]):
                for k, w in enumerate((g, h, np.ones(len(y)))):
                    out[k, f] = np.bincount(codes[f, rows], w[rows], plan.bins + 1)
            return out

        leaves = {0: (np.arange(len(y)), 0)}
        best = {0: bo.best_split(sums(leaves[0][0]), plan)}
        count = 1
        while count < plan.leaves:
            open_ = [(-best[i][0], i) for i in leaves if best[i] and (plan.depth is None or leaves[i][1] < plan.depth)]
            if not open_:
                break
            _, i = min(open_)
            _, f, cut, missing_left = best[i]
            rows, depth = leaves.pop(i)
            code = codes[f, rows]
            left = np.where(code == plan.bins, missing_left, code <= cut)
            for part in (rows[left], rows[~left]):
                j = max([*best]) + 1
                leaves[j] = (part, depth + 1)
                best[j] = bo.best_split(sums(part), plan)
            count += 1
        for rows, _ in leaves.values():
            raw[rows] -= plan.step * g[rows].sum() / (h[rows].sum() + plan.l2)
    return raw


@pytest.mark.parametrize("kind,leaves,depth,rows", [("reg", 31, None, 100), ("reg", 6, 3, 1000), ("clf", 12, 4, 100), ("clf", 12, 4, 1000)])
def test_boosting_equals_plain_loop(spark, monkeypatch, kind, leaves, depth, rows):
    monkeypatch.setattr(bo, "BLOCK_ROWS", rows)
    x, y = table(600)
    y = (y > 0.5).astype(float) if kind == "clf" else y
    df = frame(spark, x, y)
    est = bo.HistBoost(kind=kind, maxIter=9, stepSize=0.3, maxDepth=depth or 0, maxLeaves=leaves, maxBins=32, leastRows=5, l2=0.7)
    model = est.fit(df)
    edges = bo.bin_edges(df, ["x0", "x1", "x2"], 32)
    expected = plain_boost(x, y, est.plan(), edges)
    assert model.rounds == 9 and all(0 < len(e) < 32 for e in edges)
    assert bo._from_json(model.getOrDefault("state")).raw(x) == pytest.approx(expected, abs=1e-9)
    scores = [r["score"] for r in model.transform(df).orderBy("label").select("score").collect()]
    assert sorted(scores) == pytest.approx(sorted(expected if kind == "reg" else 1 / (1 + np.exp(-expected))))


def test_penalty_and_early_stop(spark, tmp_path):
    x, y = table(12_000)
    df = frame(spark, x, y)
    free, tight = (bo.HistBoost(maxIter=20, l2=v).fit(df) for v in (0.0, 50.0))
    assert free.getOrDefault("state") != tight.getOrDefault("state")
    stopped = bo.HistBoost(maxIter=1000, stepSize=0.3).fit(df)
    assert 10 < stopped.rounds < 200
    stopped.write().save(str(tmp_path / "m"))
    again = bo.HistBoostModel.load(str(tmp_path / "m"))
    assert again.getOrDefault("state") == stopped.getOrDefault("state")
    error = stopped.transform(df).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0]
    assert error < 0.05 * np.var(y)
    with pytest.raises(ValueError, match="no rows"):
        bo.HistBoost(maxIter=3).fit(df.limit(0))


def plain_sgd(x, y, plan: ep.SgdPlan, epochs: int, number: int = 0):
    w, b, t, eta = np.zeros(x.shape[1]), 0.0, 0, plan.eta0
    best, bad = math.inf, 0
    for epoch in range(epochs):
        total = 0.0
        for i in np.random.default_rng([plan.seed, epoch, number]).permutation(len(x)):
            target = 2 * y[i] - 1 if plan.kind == "clf" else y[i]
            value, slope = loss_and_slope(plan.loss, np.array([x[i] @ w + b]), np.array([target]))
            t += 1
            rate = {"optimal": 1 / (plan.alpha * (plan.offset + t - 1)), "invscaling": plan.eta0 / t**plan.power}.get(plan.schedule, eta)
            total += value[0]
            w = w * max(0, 1 - rate * plan.alpha * (1 - plan.l1)) - rate * slope[0] * x[i]
            b -= rate * slope[0]
            w = np.sign(w) * np.maximum(np.abs(w) - rate * plan.alpha * plan.l1, 0)
        loss = total / len(x)
        bad = bad + 1 if loss > best - plan.tol else 0
        best = min(best, loss)
        if bad >= plan.patience:
            if plan.schedule != "adaptive" or eta <= 1e-6:
                break
            eta, bad = eta / 5, 0
    return np.r_[w, b]


def test_step_schedules_equal_a_plain_loop_and_differ(spark):
    x, y = table(300)
    x = np.nan_to_num(x)
    df = frame(spark, x, y)
    packed = bl.pack(df, ["x0", "x1", "x2"], ["label"])
    (block,) = packed.rdd.collect()
    plans = [ep.SgdPlan(schedule=s, eta0=0.02, alpha=0.01, l1=0.15, epochs=12, tol=1e-3) for s in ep.SCHEDULES]
    side = [w for w, _ in ep.learn(packed, plans)]
    for plan, weights in zip(plans, side):
        assert weights == pytest.approx(plain_sgd(block.x, block.y[:, 0], plan, 12), rel=1e-9, abs=1e-12)
    assert len({tuple(np.round(w, 6)) for w in side}) == 4
    again = [w for w, _ in ep.learn(packed, plans)]
    assert all(np.array_equal(a, b) for a, b in zip(side, again))


def test_blocks_are_averaged_by_rows(spark, monkeypatch):
    monkeypatch.setattr(bl, "MIN_ROWS", 120)
    x, y = table(300)
    df = frame(spark, np.nan_to_num(x), y)
    packed = bl.pack(df, ["x0", "x1", "x2"], ["label"])
    plan = ep.SgdPlan(schedule="constant", eta0=0.02, epochs=1)
    got = ep.learn(packed, [plan])[0][0]
    parts = [(len(b.x), plain_sgd(b.x, b.y[:, 0], plan, 1, b.number)) for b in packed.rdd.collect()]
    assert len(parts) == 3 and got == pytest.approx(sum(n * w for n, w in parts) / 300)


def test_side_by_side_equals_one_by_one(spark):
    x, y = table(200)
    x, y = np.nan_to_num(x), (y > 0.5).astype(float)
    packed = bl.pack(frame(spark, x, y, fold=np.arange(200) % 3), ["x0", "x1", "x2"], ["label"], "fold")
    plans = [ep.SgdPlan("clf", loss, 0.01, 0.15, "optimal", epochs=5, fold=f) for loss in ("hinge", "log_loss", "modified_huber") for f in (None, 0, 2)]
    plans += [ep.MlpPlan("clf", "log_loss", (4,), "tanh", s, epochs=6, fold=1) for s in ("adam", "sgd", "lbfgs")]
    together = ep.learn(packed, plans)
    for plan, (weights, score) in zip(plans, together):
        ((w, s),) = ep.learn(packed, [plan])
        assert w == pytest.approx(weights) and (s is None) == (plan.fold is None) and s == score
    assert len({s for _, s in together}) > 3


@pytest.mark.parametrize("solver", ["adam", "sgd", "lbfgs"])
def test_perceptron_solvers_learn(spark, solver):
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (400, 2))
    df = frame(spark, x, (x[:, 0] * x[:, 1] > 0).astype(float))
    step = {"adam": 0.02, "sgd": 0.1}.get(solver, 1e-3)
    model = ep.EpochEstimator(kind="clf", loss="log_loss", hidden=[8], activation="tanh", solver=solver, eta0=step, maxIter=400).fit(df)
    assert model.transform(df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.9


def test_quasi_newton_finds_least_squares(spark):
    """A perceptron without curvature to fight: the gradient at the end is (nearly) zero."""
    x, y = table(300)
    x = np.nan_to_num(x)
    packed = bl.pack(frame(spark, x, y), ["x0", "x1", "x2"], ["label"])
    plan = ep.MlpPlan(hidden=(3,), activation="tanh", solver="lbfgs", alpha=0.1, epochs=500, tol=1e-6)
    flat = ep.learn(packed, [plan])[0][0]
    _, g = gradient([3, 3, 1], flat, x, y, "tanh", "squared_error")
    g = (g + 0.1 * ep.weight_mask([3, 3, 1]) * flat) / 300
    assert np.abs(g).max() < 1e-3


def test_gram_sums_equal_direct_fits(spark):
    x, y = table(240)
    x = np.nan_to_num(x)
    fold = np.arange(240) % 4
    packed = bl.pack(frame(spark, x, y, fold=fold), ["x0", "x1", "x2"], ["label"], "fold")
    for penalty, l1 in ((0.0, 0.0), (0.5, 0.0), (0.05, 0.5)):
        scores = gram.fold_scores(packed, 4, 0, penalty, l1)
        for f, score in enumerate(scores):
            own = fold != f
            a = x[own] - x[own].mean(0)
            b = y[own] - y[own].mean()
            if l1:
                w = gram.solve(gram.fold_grams(packed, 4).sum(0) - gram.fold_grams(packed, 4)[f], 3, 0, penalty, l1)[1:]
                slope = a.T @ (a @ w - b) / own.sum() + penalty * (1 - l1) * w
                assert all(abs(s + penalty * l1 * np.sign(v)) < 1e-6 if v else abs(s) <= penalty * l1 + 1e-9 for s, v in zip(slope, w))
            else:
                w = np.linalg.solve(a.T @ a / own.sum() + penalty * np.eye(3), a.T @ b / own.sum())
            e = y[~own] - (y[own].mean() + (x[~own] - x[own].mean(0)) @ w)
            assert score == pytest.approx(1 - (e**2).sum() / ((y[~own] - y[~own].mean()) ** 2).sum())
    assert gram.solve(np.zeros((6, 6)), 4, 0).tolist() == [0.0] * 5


@pytest.mark.parametrize("rows", [60, 1000])
def test_boosted_folds_side_by_side(spark, monkeypatch, rows):
    monkeypatch.setattr(bo, "BLOCK_ROWS", rows)
    x, y = table(200)
    df = frame(spark, x, y, fold=np.arange(200) % 3)
    sets = [bo.HistBoost(maxIter=3, maxLeaves=4, maxBins=b, leastRows=3) for b in (16, 32)]
    scores = bo.fit_side_by_side(sets, df, ["label"], "fold", 3)
    own = bo._from_json(sets[1].fit(df.where("fold <> 2")).getOrDefault("state"))
    left = np.arange(200) % 3 == 2
    assert [len(s) for s in scores] == [3, 3] and all(-1 < v < 1 for s in scores for v in s)
    # bins come from all rows here and from the training rows there, so scores are close, not equal
    e = ((own.raw(x[left]) - y[left]) ** 2).sum()
    assert scores[1][2] == pytest.approx(1 - e / ((y[left] - y[left].mean()) ** 2).sum(), abs=0.1)


def test_failed_folds_cancel_the_others(spark):
    x, y = table(60)
    df = frame(spark, np.nan_to_num(x), y, fold=np.arange(60) % 2)

    class Broken:
        def fit(self, data):
            raise ValueError("no fit")

    with pytest.raises(ValueError, match="no fit"):
        se.fold_scores(Broken, df, "reg", 2)
    assert spark.range(3).count() == 3


def test_scores_that_are_not_numbers_come_last(spark):
    rows = se.results_frame(spark, [("m", "a", float("nan")), ("m", "b", -1.0), ("m", "c", 2.0)]).collect()
    assert [(r["params"], r["mean_score"], r["place"]) for r in rows] == [("c", 2.0, 1), ("b", -1.0, 2), ("a", None, 3)]


def test_sums_of_rows_equal_sums_of_blocks_and_write_nothing(spark):
    from tarmac.plans import storage as st

    x, y = table(240)
    df = frame(spark, np.nan_to_num(x), y, fold=np.arange(240) % 3)
    blocks = gram.fold_grams(bl.pack(df, ["x0", "x1", "x2"], ["label"], "fold"), 3)
    before = {k: list(v) for k, v in st._made.items()}
    assert gram.row_grams(df, ["x0", "x1", "x2"], ["label"], "fold", 3) == pytest.approx(blocks)
    assert st._made == before
    assert not gram.row_grams(df.limit(0), ["x0", "x1", "x2"], ["label"], "fold", 3).any()


def test_lanes_step_together_as_they_would_alone_and_bound_the_steps(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(ep, "LANE_ROWS", 50)
    made = [bl.Block(k, rng.normal(size=(n, 3)), rng.integers(0, 2, (n, 2)).astype(float), rng.integers(0, 3, n), np.arange(n)) for k, n in enumerate((50, 120, 7))]
    rows, _, fold = ep._lanes(made, 42, 1)
    assert rows.shape == (50, 3, 5) and (fold >= 0).sum() == 177  # 50, three lanes of 120, 7
    assert np.sort(rows[:, 0][fold >= 0]) == pytest.approx(np.sort(np.concatenate([b.x[:, 0] for b in made])))
    plans = [ep.SgdPlan("clf", loss, 0.01, 0.15, schedule, label=k % 2, fold=k % 3 or None) for k, (loss, schedule) in enumerate(zip(("log_loss", "hinge", "modified_huber", "log_loss"), ep.SCHEDULES))]
    asks = [ep.Ask(p, "sgd", np.array([0.1, -0.2, 0.3, 0.05]), step=30.0, eta=0.01, epoch=1) for p in plans]
    whole, parts = ep.sgd_pass(asks, made), [ep.sgd_pass(asks, [b]) for b in made]
    for j in range(4):
        for key in ("flat", "n", "loss", "steps", "blocks"):
            assert whole[j][key] == pytest.approx(sum(p[j][key] for p in parts))
    assert [w["blocks"] for w in whole] == [5.0] * 4


@pytest.mark.parametrize("missing", [False, True])
def test_rows_by_node_are_those_of_the_plain_descent(missing):
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 32, (3, 500)).astype(np.uint8)
    if missing:
        codes[1, :60] = 32
    tree = bo.Tree()
    for node, f, cut, way in ((0, 0, 15, False), (1, 1, 9, True), (2, 1, 20, False), (3, 2, 7, True)):
        tree.split(node, f, cut, way)
    packed, rows = tree.packed(), np.arange(500)
    ends = bo.leaf_of(packed, codes, 32)
    for wanted in (None, (7, 5), (8,)):
        got = dict(bo.rows_by_node(packed, codes, 32, rows, wanted))
        assert set(got) == set(wanted or (4, 5, 6, 7, 8)) and all(np.array_equal(own, np.flatnonzero(ends == n)) for n, own in got.items())


def test_long_tables_give_boosting_work_for_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(bo, "BLOCK_ROWS", 300)
    monkeypatch.setattr(bl, "SPREAD_ROWS", 50)
    x, y = table(600)
    df = frame(spark, x, y)
    packed = bl.pack(df, ["x0", "x1", "x2"], ["label"], least=300)
    assert packed.blocks == 12 and packed.rdd.getNumPartitions() == 12
    assert bl.pack(df.limit(300), ["x0", "x1", "x2"], ["label"], least=300).blocks == 1
    assert bl.parts_of(2_500_000, 39) == 24 and bl.parts_of(150 << 20, 1024) == 150


def test_a_perceptron_goes_through_the_blocks_of_a_task_in_one_chain(monkeypatch):
    rng = np.random.default_rng(4)
    made = [bl.Block(k, rng.normal(size=(n, 3)), rng.integers(0, 2, (n, 1)).astype(float), rng.integers(0, 3, n), np.arange(n)) for k, n in enumerate((450, 450, 90))]
    for solver in ("adam", "sgd"):
        plan = ep.MlpPlan("clf", "log_loss", (4,), "tanh", solver, fold=1)
        flat = ep._first_weights(plan, 3, 0.0)
        memory = (np.zeros_like(flat), np.zeros_like(flat))
        whole = ep.mlp_pass(ep.Ask(plan, "mlp", flat, memory, eta=0.01, epochs=1), made)
        first, second, step, loss = *memory, 0.0, 0.0
        for at in np.random.default_rng([42, 0, 0, 3]).permutation(3):
            got = ep.mlp_pass(ep.Ask(plan, "mlp", flat, (first, second), step, 0.01, 0, 1), [made[at]])
            flat, first, second = (got[k] / got["n"] for k in ("flat", "first", "second"))
            step, loss = step + got["steps"], loss + got["losses"][0]
        assert whole["flat"] / whole["n"] == pytest.approx(flat) and whole["losses"][0] == pytest.approx(loss)
        assert (whole["steps"], whole["blocks"]) == (step, 1.0) and whole["n"] == sum((b.fold != 1).sum() for b in made)
    assert [ep.local_epochs(rows, 24) for rows in (1_000, 411_091, 800_000, 24_000_000)] == [4, 4, 2, 1]
    assert ep.local_epochs(150 << 20, 150) == 1
    ask = ep.Ask(ep.MlpPlan("clf", "log_loss", (4,), "logistic"), "gradient", flat)
    once = ep._whole(ask, *made[0][1:4])
    monkeypatch.setattr(ep, "SUMMED", 100)
    parts = ep._whole(ask, *made[0][1:4])
    assert parts["grad"] == pytest.approx(once["grad"]) and parts["value"] == pytest.approx(once["value"])


@pytest.mark.parametrize("kind", ["reg", "clf"])
def test_a_task_with_helpers_grows_the_same_trees(monkeypatch, kind):
    monkeypatch.setattr(bo, "HAND_ROWS", 50)
    monkeypatch.setattr(bo, "EARLY_ROWS", 100)
    x, y = table(700)
    y = (y > 0.5).astype(float) if kind == "clf" else y * np.pi
    plan = bo.BoostPlan(kind, 8, 0.3, 5, 9, 32, 3, 0.1)
    edges = [np.unique(np.nanquantile(c, np.arange(1, 32) / 32)) for c in x.T]
    codes, given = bo.code_rows(x, edges, 32), (y[:, None], np.full(700, -1), np.arange(700))
    alone, shared = bo._alone(plan, codes, *given), bo._alone(plan, codes, *given, hands=5)
    assert alone[0] == shared[0] and [vars(t) for t in alone[1]] == [vars(t) for t in shared[1]] and len(alone[1]) == 8
    monkeypatch.setattr(bo, "JOINT_CELLS", 1)
    assert [vars(t) for t in bo._alone(plan, codes, *given)[1]] == [vars(t) for t in alone[1]]


def test_tables_of_a_few_blocks_are_boosted_without_passes(spark, monkeypatch):
    x, y = table(600)
    df = frame(spark, x, y)
    est = bo.HistBoost(maxIter=5, maxLeaves=6, maxBins=32, leastRows=5)
    monkeypatch.setattr(bo, "BLOCK_ROWS", 250)
    monkeypatch.setattr(bl, "SPREAD_ROWS", 100)
    with monkeypatch.context() as m:
        m.setattr(bo, "add_up", None)
        few = est.fit(df)
    monkeypatch.setattr(bo, "ALONE", 1)
    passes = est.fit(df)
    got, expected = (bo._from_json(m.getOrDefault("state")).raw(x) for m in (few, passes))
    assert got == pytest.approx(expected, abs=1e-9)


def test_edges_are_values_at_the_ranks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.stack([rng.normal(size=5000), rng.integers(0, 4, 5000), np.full(5000, np.nan)], axis=1)
    df = frame(spark, x, x[:, 1])
    exact = bo.bin_edges(df, ["x0", "x1", "x2"], 16)
    ranks = np.sort(x[:, 0])[[int(np.ceil(5000 * k / 16)) - 1 for k in range(1, 16)]]
    assert exact[0] == pytest.approx(ranks) and exact[1:] == [[0.0, 1.0, 2.0], []]
    monkeypatch.setattr(bo, "EDGE_POINTS", 200)
    near = bo.bin_edges(df, ["x0", "x1", "x2"], 16)
    assert near[1:] == exact[1:] and np.abs(np.searchsorted(np.sort(x[:, 0]), near[0]) - np.searchsorted(np.sort(x[:, 0]), exact[0])).max() <= 5000 / 200 + 5


def test_rows_of_several_batches_go_through_the_trees_together(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(bo, "PREDICTED", 25)
    batches = [pd.Series([[float(i), 1.0]] * 10) for i in range(7)]
    found = list(bo._portions(iter(batches), 2))
    assert [len(x) for x in found] == [30, 30, 10] and np.array_equal(np.concatenate(found)[:, 0], np.arange(70) // 10)


def test_linear_models_of_short_tables_share_tasks(spark, monkeypatch):
    assert [ep.lane_tasks(n) for n in (1, 246_655, 2_466_547)] == [1, 6, 51]
    monkeypatch.setattr(bl, "MIN_ROWS", 50)
    monkeypatch.setattr(ep, "LANE_ROWS", 50)
    x, y = table(600)
    packed = bl.pack(frame(spark, np.nan_to_num(x), y), ["x0", "x1", "x2"], ["label"])
    asked, add_up = [], bl.add_up
    monkeypatch.setattr(ep, "add_up", lambda rdd, *more: asked.append(rdd.getNumPartitions()) or add_up(rdd, *more))
    plans = [ep.SgdPlan(schedule="constant", eta0=0.02, epochs=3), ep.SgdPlan(loss="squared_epsilon_insensitive", epochs=3)]
    few = ep.learn(packed, plans)
    assert set(asked) == {2} and packed.rdd.getNumPartitions() == 12
    monkeypatch.setattr(ep, "TASK_LANES", 1)
    asked.clear()
    for (w, _), (v, _) in zip(few, ep.learn(packed, plans)):
        assert w == pytest.approx(v, rel=1e-12)
    assert set(asked) == {12}
