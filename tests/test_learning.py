"""Encoders, models, search and the train and test tables."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tarmac.catalog import QUERIES
from tarmac.catalog import models as cm
from tarmac.ml import evaluate as ev
from tarmac.ml import models as md
from tarmac.ml import search as se
from tarmac.ml.epochs import EpochEstimator
from tarmac.ml.gradient import GradientModel
from tarmac.operators import encoding as en
from tarmac.plans import training_table as tt
from tarmac.sources import demo

SF_DIR = "/root/testdata/sf0.001"


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    out = en.standardize(df, ["a", "b"])
    s = out.agg(F.avg("a"), F.stddev_pop("a"), F.max("b"), F.min("b")).first()
    assert s[0] == pytest.approx(0) and s[1] == pytest.approx(1) and s[2] == s[3] == 0.0


def test_target_encoding_bounds_and_unseen(spark):
    train = spark.range(500).select("id", F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("c"), (F.col("id") % 3 == 0).cast("double").alias("y"))
    test = spark.createDataFrame([(1000, "c1", 0.0), (1001, "new", 1.0)], "id long, c string, y double")
    enc_train, enc_test = en.target_encode(train, test, ["c"], "y", ["id"])
    mean = train.agg(F.avg("y")).first()[0]
    by = {r["c"]: r["m"] for r in train.groupBy("c").agg(F.avg("y").alias("m")).collect()}
    got = {r["id"]: r["c"] for r in enc_test.collect()}
    assert got[1001] == pytest.approx(mean)
    assert min(by["c1"], mean) <= got[1000] <= max(by["c1"], mean)
    assert enc_train.count() == 500 and enc_train.filter("c IS NULL").count() == 0
    constant, _ = en.target_encode(train.withColumn("y", F.lit(1.0)), test, ["c"], "y", ["id"])
    assert constant.agg(F.min("c"), F.max("c")).first()[:] == (1.0, 1.0)


def points(spark):
    df = spark.range(400).select("id", (F.rand(1) * 2 - 1).alias("a"), (F.rand(2) * 2 - 1).alias("b"))
    df = df.withColumns({"label": (F.col("a") + F.col("b") > 0).cast("double"), "features": array_to_vector(F.array("a", "b"))})
    return df.persist()


@pytest.mark.parametrize("loss", ["log_loss", "hinge", "squared_hinge", "modified_huber", "perceptron"])
def test_linear_losses(spark, loss):
    data = points(spark)
    est = EpochEstimator(kind="clf", loss=loss, maxIter=40, schedule="optimal", alpha=1e-3)
    first, second = est.fit(data), est.fit(data)
    assert first.getOrDefault("weights") == pytest.approx(second.getOrDefault("weights"))
    hit = first.transform(data).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert hit > 0.9


def test_network_learns_and_round_trips(spark, tmp_path):
    df = points(spark).withColumn("label", (F.col("a") * F.col("b") > 0).cast("double"))
    model = EpochEstimator(kind="clf", loss="log_loss", hidden=[8], activation="tanh", maxIter=400, eta0=0.02).fit(df)
    out = model.transform(df)
    assert out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.9
    model.write().save(str(tmp_path / "m"))
    again = GradientModel.load(str(tmp_path / "m")).transform(df)
    assert [r["score"] for r in again.orderBy("id").collect()] == [r["score"] for r in out.orderBy("id").collect()]


def test_gradient_matches_differences():
    import numpy as np

    from tarmac.ml.gradient import gradient

    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(20, 3)), rng.choice([-1.0, 1.0], 20)
    sizes = [3, 4, 2, 1]
    flat = rng.normal(size=3 * 4 + 4 + 4 * 2 + 2 + 2 + 1)
    for activation in ("tanh", "logistic"):
        _, grad = gradient(sizes, flat, x, y, activation, "log_loss")
        for i in range(0, len(flat), 5):
            step = np.zeros_like(flat)
            step[i] = 1e-6
            up, down = (gradient(sizes, flat + s, x, y, activation, "log_loss")[0] for s in (step, -step))
            assert (up - down) / 2e-6 == pytest.approx(grad[i], rel=1e-4, abs=1e-5)


def test_registry_and_draws():
    assert md.select_models("sgd_clf") == ["sgd_clf"]
    assert len(md.select_models("all")) == 8 and len(md.select_models("reg")) == 4
    with pytest.raises(ValueError):
        md.select_models("log_clf")
    assert md.model_params("hgb_reg", base=True) == {"random_state": 42} and md.model_params("lin_reg", base=True) == {}
    sizes = {"hgb_reg": 5760, "sgd_reg": 2880, "mlp_clf": 1800, "sgd_clf": 240, "log_reg": 1, "lin_reg": 1}
    for name, size in sizes.items():
        assert len(se.draw(md.MODELS[name].grid, 10_000)) == size
    drawn = se.draw(md.MODELS["sgd_clf"].grid, 30)
    assert len({str(d) for d in drawn}) == 30 and drawn == se.draw(md.MODELS["sgd_clf"].grid, 30)


def test_undefined_metrics_are_zero(spark):
    preds = spark.createDataFrame([("m", 1.0, 0.0, 0.1), ("m", 0.0, 0.0, 0.2)], "model string, label double, prediction double, score double")
    row = ev.clf_metrics(preds).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)
    assert {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(preds).collect()} == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_importance_tables(spark):
    a = spark.createDataFrame([("a", "x", 0.5), ("a", "y", 0.1), ("a", "z", 0.1)], "model string, feature string, importance double")
    b = spark.createDataFrame([("b", "x", 0.2), ("b", "y", 0.6), ("b", "z", 0.6)], "model string, feature string, importance double")
    table = ev.importance_table([a, b]).collect()
    assert [(r["feature"], r["rank"]) for r in table] == [("x", 2.0), ("y", 2.0), ("z", 2.0)]
    assert [tuple(r) for r in ev.top_features(a.unionByName(b), 2).collect()] == [(1, "x", "y"), (2, "y", "z")]


def test_training_tables(spark):
    sf = "/root/testdata/sf0.01"
    flights = demo.flights(spark, sf).select(
        *demo.ROW_ID, "FlightDate", F.month("CalendarDate").alias("Month"), (F.weekday("CalendarDate") + 1).alias("DayOfWeek"),
        "Airline", "Origin", "Dest", "CRSDepTime", "CRSArrTime", "AirTime", "Distance", "DepDelayMinutes", "DepDel15",
    )
    train, test = tt.training_tables(flights, demo.observations(spark, sf), demo.station_key(spark, sf), demo.ROW_ID, (2024, 2024))
    features = [c for c in train.columns if c not in demo.ROW_ID]
    assert len(features) == 65 and train.columns == test.columns
    scaled = [c for c in features if c not in {*tt.ENCODED, *tt.CYCLICAL, *tt.FLAGS, *tt.TARGETS}]
    assert len(scaled) == 44
    both = train.unionByName(test)
    n, m = both.count(), test.count()
    assert m == -(-n // 5) and n > 100
    s = both.agg(*[F.avg(c).alias(c) for c in scaled]).first().asDict()
    assert max(abs(v) for v in s.values()) < 1e-9
    assert both.na.drop("any").count() == n


def test_same_model_for_same_seed(spark):
    train, test = cm.split(spark, SF_DIR)
    runs = []
    for _ in range(2):
        model, features = md.train_model("hgb_clf", train, demo.ROW_ID, overrides={"max_iter": 2, "max_depth": 3})
        data = md.assemble(test, features, "DepDel15", demo.ROW_ID)
        runs.append(model.transform(data).agg(F.sum("prediction")).first()[0])
    assert runs[0] == runs[1]


@pytest.mark.parametrize("name", ["sgd_reg", "sgd_reg_epsilon", "hgb_reg", "mlp_reg", "sgd_clf", "sgd_clf_hinge", "sgd_clf_huber", "hgb_clf", "mlp_clf", "mlp_clf_logistic", "gbt_log_target", "rf_clf", "rf_reg", "permutation_importance"])
def test_queries_train_with_tuned_parameters(spark, monkeypatch, name):
    class Asked(Exception):
        pass

    def stop(model, params, *_):
        raise Asked(model, params)

    one = spark.range(1).select(*[F.lit(0.0).alias(c) for c in [*cm.FEATURES, "DepDelayMinutes", "DepDel15"]], *[F.lit(0).alias(c) for c in demo.ROW_ID])
    monkeypatch.setattr(cm, "split", lambda *_: (one, one))
    monkeypatch.setattr(md, "make_estimator", stop)
    with pytest.raises(Asked) as asked:
        QUERIES[name](spark, "")
    model, params = asked.value.args
    named = {"loss", "penalty", "activation", "solver"}
    tuned = md.MODELS[model].params if model in md.MODELS else {}
    assert {k: v for k, v in params.items() if k not in named} == {k: v for k, v in tuned.items() if k not in named}


def test_search_query_draws_the_whole_number(spark, monkeypatch):
    monkeypatch.setattr(cm, "split", lambda *_: (None, None))
    monkeypatch.setattr(cm.se, "random_search", lambda *a, **k: spark.createDataFrame([(0.0, str(k))], "mean_score double, asked string"))
    assert QUERIES["random_search"](spark, "").first()["asked"] == "{}"


def test_top_features_are_of_every_regressor(spark, monkeypatch):
    one = spark.range(1).select(*[F.lit(0.0).alias(c) for c in [*cm.FEATURES, "DepDelayMinutes", "DepDel15"]], *[F.lit(0).alias(c) for c in demo.ROW_ID])

    def found(model, name, data, features, *_):
        return spark.createDataFrame([(name, f, float(i if name == "mlp_reg" else -i)) for i, f in enumerate(features)], "model string, feature string, importance double")

    monkeypatch.setattr(cm, "split", lambda *_: (one, one))
    monkeypatch.setattr(md, "train_model", lambda name, *_: (None, cm.FEATURES))
    monkeypatch.setattr(ev, "permutation_importance", found)
    table = QUERIES["importance_top5"](spark, "")
    assert table.columns == ["place", "hgb_reg", "lin_reg", "mlp_reg", "sgd_reg"]
    rows = table.collect()
    assert [r["sgd_reg"] for r in rows] == cm.FEATURES[:5] and [r["mlp_reg"] for r in rows] == cm.FEATURES[:-6:-1]
