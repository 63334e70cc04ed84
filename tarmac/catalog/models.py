"""Training and search on a feature table built from all flights."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.catalog.base import R, query, r6
from tarmac.functions import bands
from tarmac.ml import evaluate as ev
from tarmac.ml import gram
from tarmac.ml import models as md
from tarmac.ml import search as se
from tarmac.ml.boosting import HistBoost, fit_side_by_side
from tarmac.ml.forest import ForestPlan, fit_forest
from tarmac.operators import encoding as en
from tarmac.operators import sampling as sp
from tarmac.plans.storage import keep_rounds, materialize, stage_path
from tarmac.sources import demo

IDS = demo.ROW_ID
FEATURES = ["ElapsedTime", "Distance", "CRSDepTime", "CRSArrTime", "ArrDelayMinutes", "DayOfWeek", "Month"]


def frame(spark, sf):
    """Scaled features, both targets and the row ids of all flights with a target."""
    df = demo.flights(spark, sf).filter("DepDel15 IS NOT NULL")
    elapsed = F.col("AirTime") + F.col("ok") * 13 % 160
    df = df.withColumns({"DayOfWeek": F.weekday("CalendarDate") + 1, "Month": F.month("CalendarDate"), "ElapsedTime": elapsed})
    df = df.select(*IDS, *[F.col(c).cast("double") for c in FEATURES], "DepDelayMinutes", "DepDel15")
    return en.standardize(materialize(df, "features"), FEATURES)


def split(spark, sf):
    return sp.train_test_split(frame(spark, sf), IDS)


def evaluated(name, model, features, train, test):
    """Metrics of a model on the test table beside a baseline that needs no features."""
    spec = md.MODELS[name]
    data = md.assemble(test, features, spec.target)
    preds = md.predictions(model, data, name)
    if spec.kind == "reg":
        guess = train.agg(F.avg(spec.target).alias("g"))
    else:
        guess = train.agg((F.avg(spec.target) >= 0.5).cast("double").alias("g"))
    base = data.crossJoin(F.broadcast(guess)).select(
        F.lit("baseline").alias("model"), "label", F.col("g").alias("prediction"), F.col("g").alias("score")
    )
    both = preds.unionByName(base)
    return r6(ev.reg_metrics(both), "rmse", "mae", "r2") if spec.kind == "reg" else r6(ev.clf_metrics(both), "accuracy", "precision", "recall", "f1")


def _register(query_name: str, name: str, base: bool = False, **overrides):
    @query(query_name)
    def train(spark, sf):
        train, test = split(spark, sf)
        model, features = md.train_model(name, train, IDS, base, overrides)
        return evaluated(name, model, features, train, test)


# Tuned parameters and all rows; the variants only name another loss, penalty, activation or solver.
_register("lin_reg", "lin_reg")
_register("sgd_reg", "sgd_reg")
_register("sgd_reg_epsilon", "sgd_reg", loss="squared_epsilon_insensitive", penalty="l1")
_register("hgb_reg", "hgb_reg")
_register("mlp_reg", "mlp_reg")
_register("log_reg", "log_reg")
_register("sgd_clf", "sgd_clf")
_register("sgd_clf_hinge", "sgd_clf", loss="hinge", penalty="l2")
_register("sgd_clf_huber", "sgd_clf", loss="modified_huber")
_register("hgb_clf", "hgb_clf")
_register("mlp_clf", "mlp_clf")
_register("mlp_clf_logistic", "mlp_clf", activation="logistic", solver="lbfgs")


@query(
    "lin_reg_single",
    f"""
WITH f AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in IDS)}))) <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test
  FROM flights WHERE DepDel15 IS NOT NULL),
m AS (SELECT regr_slope(DepDelayMinutes, AirTime + ok * 13 % 160) AS b, regr_intercept(DepDelayMinutes, AirTime + ok * 13 % 160) AS a FROM f WHERE NOT is_test),
e AS (SELECT DepDelayMinutes AS y, DepDelayMinutes - a - b * (AirTime + ok * 13 % 160) AS e FROM f, m WHERE is_test)
SELECT 'lin_reg' AS model, {R('sqrt(avg(e * e))', 'rmse', 4)}, {R('avg(abs(e))', 'mae', 4)}, {R('1 - sum(e * e) / (count(*) * var_pop(y))', 'r2', 4)} FROM e""",
)
def lin_reg_single(spark, sf):
    train, test = split(spark, sf)
    model = md.make_estimator("lin_reg", {}).fit(md.assemble(train, ["ElapsedTime"], "DepDelayMinutes"))
    preds = md.predictions(model, md.assemble(test, ["ElapsedTime"], "DepDelayMinutes"), "lin_reg")
    return r6(ev.reg_metrics(preds), "rmse", "mae", "r2", digits=4)


@query("train_registry")
def train_registry(spark, sf):
    """One regression and one classifier by name, with base parameters: target, number of features, test metrics."""
    train, test = split(spark, sf)
    out = None
    for name in ("lin_reg", "log_reg"):
        spec = md.MODELS[name]
        model, features = md.train_model(name, train, IDS, base=True)
        m = ev.residuals(md.predictions(model, md.assemble(test, features, spec.target), name)).groupBy("model")
        m = m.agg(F.avg(F.abs("residual")).alias("mean_abs_residual")).withColumns(
            {"kind": F.lit(spec.kind), "target": F.lit(spec.target), "features": F.lit(len(features))}
        )
        out = m if out is None else out.unionByName(m)
    return r6(out, "mean_abs_residual")


@query("base_beside_tuned")
def base_beside_tuned(spark, sf):
    """Test metrics of two classifiers with base and with tuned parameters, one row per model and mode."""
    train, test = split(spark, sf)
    out = None
    for name in ("log_reg", "sgd_clf"):
        for mode in ("base", "tuned"):
            model, features = md.train_model(name, train, IDS, base=mode == "base")
            m = ev.clf_metrics(md.predictions(model, md.assemble(test, features, md.MODELS[name].target), name)).withColumn("mode", F.lit(mode))
            out = m if out is None else out.unionByName(m)
    return r6(out, "accuracy", "precision", "recall", "f1")


def _forest(name: str, target: str, kind: str):
    @query(name)
    def forest(spark, sf):
        train, test = split(spark, sf)
        est = md.make_estimator(name, {})
        model = est.fit(md.assemble(train, FEATURES, target))
        preds = md.predictions(model, md.assemble(test, FEATURES, target), name)
        metrics = ev.clf_metrics(preds) if kind == "clf" else ev.reg_metrics(preds)
        long = [F.struct(F.lit("metric").alias("part"), F.lit(c).alias("name"), F.col(c).alias("value")) for c in metrics.columns[1:]]
        weights = [F.struct(F.lit("importance").alias("part"), F.lit(f).alias("name"), F.lit(float(w)).alias("value")) for f, w in zip(FEATURES, model.featureImportances.toArray())]
        out = metrics.select(F.explode(F.array(*long, *weights)).alias("x")).select("x.*")
        return r6(out, "value")


_forest("rf_clf", "DepDel15", "clf")
_forest("rf_reg", "DepDelayMinutes", "reg")


def _deep_forest(query_name: str, target: str, kind: str):
    @query(query_name)
    def forest(spark, sf):
        """A hundred trees grown to purity: test metrics and importances."""
        train, test = split(spark, sf)
        model = fit_forest(md.assemble(train, FEATURES, target), ForestPlan(kind))
        preds = md.predictions(model, md.assemble(test, FEATURES, target), query_name)
        metrics = ev.clf_metrics(preds) if kind == "clf" else ev.reg_metrics(preds)
        long = [F.struct(F.lit("metric").alias("part"), F.lit(c).alias("name"), F.col(c).alias("value")) for c in metrics.columns[1:]]
        weights = [F.struct(F.lit("importance").alias("part"), F.lit(f).alias("name"), F.lit(float(w)).alias("value")) for f, w in zip(FEATURES, model.importances)]
        return r6(metrics.select(F.explode(F.array(*long, *weights)).alias("x")).select("x.*"), "value")


_deep_forest("rf_clf_deep", "DepDel15", "clf")
_deep_forest("rf_reg_deep", "DepDelayMinutes", "reg")


@query("gbt_log_target")
def gbt_log_target(spark, sf):
    """Boosted trees on the plain and on the log1p target, both measured in minutes."""
    train, test = split(spark, sf)
    keep_rounds(spark)
    est = md.make_estimator("hgb_reg", md.model_params("hgb_reg"))
    data = md.assemble(test, FEATURES, "DepDelayMinutes")
    both = md.assemble(train.withColumn("logged", F.log1p("DepDelayMinutes")), FEATURES, "DepDelayMinutes", ["logged"])
    plain, logged = fit_side_by_side([est, est], both, ["label", "logged"])
    plain = md.predictions(plain, data, "plain")
    back = md.predictions(logged, data, "log1p").withColumn("prediction", F.expm1("prediction"))
    return r6(ev.reg_metrics(plain.unionByName(back)), "rmse", "mae", "r2")


@query("random_search")
def random_search(spark, sf):
    train, _ = split(spark, sf)
    return r6(se.random_search("sgd_clf", train, IDS), "mean_score")


@query("grid_search")
def grid_search(spark, sf):
    train, _ = split(spark, sf)
    folded = materialize(sp.kfold_assign(train, 3, IDS), "folds")
    data = md.assemble(folded, FEATURES, "DepDelayMinutes", ["fold"])
    grid = {"regParam": [0.0, 1.0], "elasticNetParam": [0.0, 0.5]}
    return r6(se.grid_search(LinearRegression(standardization=False), grid, data, "reg", 3), "mean_score")


@query("cv_scores")
def cv_scores(spark, sf):
    """Mean cross-validated R2 of a linear model on the raw, log, root and reciprocal target, and on degree-2 features."""
    folded = materialize(sp.kfold_assign(frame(spark, sf), 5, IDS).select(*FEATURES, "DepDelayMinutes", "fold"), "folds")
    folded = bands.target_transforms(folded, "DepDelayMinutes")
    folded = en.standardize(folded, ["y_recip"])
    targets = {"raw": "DepDelayMinutes", "log": "y_log", "sqrt": "y_sqrt", "recip": "y_recip"}
    poly = en.poly_features(folded, FEATURES)
    names = [c for c in poly.columns if c not in folded.columns and c != "bias"]
    found = _mean_scores(folded, FEATURES, targets) + _mean_scores(poly, [*FEATURES, *names], {"poly": "DepDelayMinutes"})
    return r6(se.results_frame(spark, found).withColumnRenamed("params", "target"), "mean_score")


def _mean_scores(folded, features, targets, folds=5):
    """(model, target, mean R2 over the folds) of least squares for every target, from one pass."""
    grams = gram.row_grams(folded, features, list(targets.values()), "fold", folds)
    return [("lin_reg", name, sum(gram.gram_scores(grams, len(features), i)) / folds) for i, name in enumerate(targets)]


_FOLDED = f"""
WITH f AS (SELECT *, AirTime + ok * 13 % 160 AS x, ((row_number() OVER (ORDER BY md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in IDS)}))) - 1) * 5) // count(*) OVER () AS fold
  FROM flights WHERE DepDel15 IS NOT NULL)"""


@query(
    "cv_scores_single",
    f"""{_FOLDED},
t AS (SELECT fold, x, 'raw' AS target, DepDelayMinutes::DOUBLE AS y FROM f UNION ALL SELECT fold, x, 'log', ln(2 + DepDelayMinutes - min(DepDelayMinutes) OVER ()) FROM f),
m AS (SELECT h.fold, t.target, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t JOIN (SELECT DISTINCT fold FROM f) h ON t.fold <> h.fold GROUP BY ALL),
s AS (SELECT t.target, t.fold, 1 - sum((y - a - b * x) * (y - a - b * x)) / (count(*) * var_pop(y)) AS r2 FROM t JOIN m ON t.fold = m.fold AND t.target = m.target GROUP BY ALL)
SELECT 'lin_reg' AS model, target, {R('avg(r2)', 'mean_score')}, CAST(row_number() OVER (ORDER BY avg(r2) DESC) AS INTEGER) AS place FROM s GROUP BY target""",
)
def cv_scores_single(spark, sf):
    """Mean cross-validated R2 of a line through one feature, on the raw and the log target."""
    folded = materialize(sp.kfold_assign(frame(spark, sf), 5, IDS).select("ElapsedTime", "DepDelayMinutes", "fold"), "folds")
    folded = bands.target_transforms(folded, "DepDelayMinutes")
    found = _mean_scores(folded, ["ElapsedTime"], {"raw": "DepDelayMinutes", "log": "y_log"})
    return r6(se.results_frame(spark, found).withColumnRenamed("params", "target"), "mean_score")


@query(
    "grid_search_single",
    f"""{_FOLDED},
z AS (SELECT fold, DepDelayMinutes AS y, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x FROM f),
g AS (SELECT unnest([0.0::DOUBLE, 0.1, 1.0]) AS p),
k AS (SELECT h.fold, covar_pop(y, x) AS c, var_pop(x) AS v, avg(y) AS my, avg(x) AS mx FROM z JOIN (SELECT DISTINCT fold FROM f) h ON z.fold <> h.fold GROUP BY h.fold),
m AS (SELECT fold, p, c / (v + p) AS b, my - mx * c / (v + p) AS a FROM k, g),
s AS (SELECT p, z.fold, 1 - sum((y - a - b * x) * (y - a - b * x)) / (count(*) * var_pop(y)) AS r2 FROM z JOIN m ON z.fold = m.fold GROUP BY ALL)
SELECT 'LinearRegression' AS model, '{{"regParam": ' || p || '}}' AS params, {R('avg(r2)', 'mean_score')}, CAST(row_number() OVER (ORDER BY avg(r2) DESC) AS INTEGER) AS place FROM s GROUP BY p""",
)
def grid_search_single(spark, sf):
    """Every penalty of a grid for a line through one scaled feature."""
    folded = materialize(sp.kfold_assign(frame(spark, sf), 5, IDS), "folds")
    data = md.assemble(folded, ["ElapsedTime"], "DepDelayMinutes", ["fold"])
    return r6(se.grid_search(LinearRegression(standardization=False), {"regParam": [0.0, 0.1, 1.0]}, data, "reg", 5), "mean_score")


@query(
    "boost_one_round",
    f"""
WITH f AS (SELECT DepDelayMinutes AS y, month(CalendarDate) AS m FROM flights WHERE DepDel15 IS NOT NULL)
SELECT CAST(m AS DOUBLE) AS "Month", {R('avg(y)', 'prediction')} FROM f GROUP BY m""",
)
def boost_one_round(spark, sf):
    """One boosted tree with full step on one feature: its leaves are the means of the months."""
    df = demo.flights(spark, sf).filter("DepDel15 IS NOT NULL").select(F.month("CalendarDate").cast("double").alias("Month"), "DepDelayMinutes")
    data = materialize(md.assemble(df, ["Month"], "DepDelayMinutes", ["Month"]), "month")
    model = HistBoost(maxIter=1, stepSize=1.0, leastRows=1, earlyStop="no").fit(data)
    return r6(model.transform(data.dropDuplicates(["Month"])).select("Month", "prediction"), "prediction")


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Save and reload a model: both give the same predictions on every test row."""
    train, test = split(spark, sf)
    model = md.make_estimator("lin_reg", {}).fit(md.assemble(train, FEATURES, "DepDelayMinutes"))
    path = stage_path(spark, "model")
    model.write().overwrite().save(path)
    again = LinearRegressionModel.load(path)
    data = md.assemble(test, FEATURES, "DepDelayMinutes", IDS)
    a = model.transform(data).select(*IDS, "features", F.col("prediction").alias("saved"))
    return r6(again.transform(a).select(*IDS, "saved", F.col("prediction").alias("loaded")), "saved", "loaded")


def _importances(spark, sf, names):
    """Importances of trained models, five repeats, on a tenth of the test rows (balanced by class for classifiers)."""
    train, test = split(spark, sf)
    for name in names:
        spec = md.MODELS[name]
        model, features = md.train_model(name, train, IDS)
        sample = sp.stratified_sample(test, 0.1, IDS, ["DepDel15"] if spec.kind == "clf" else [])
        data = md.assemble(materialize(sample, "sample"), features, spec.target, IDS)
        yield ev.permutation_importance(model, name, data, features, spec.kind, IDS)


@query("permutation_importance")
def permutation_importance(spark, sf):
    return r6(ev.importance_table(list(_importances(spark, sf, ("log_reg", "sgd_clf")))), "log_reg", "sgd_clf", "mean_importance")


@query("permutation_importance_reg")
def permutation_importance_reg(spark, sf):
    return r6(ev.importance_table(list(_importances(spark, sf, ("lin_reg", "hgb_reg")))), "lin_reg", "hgb_reg", "mean_importance")


@query("importance_top5")
def importance_top5(spark, sf):
    """The five most important features of each regressor, side by side."""
    found = reduce(DataFrame.unionByName, _importances(spark, sf, md.select_models("reg")))
    return ev.top_features(materialize(found, "importances"))


@query(
    "importance_single",
    f"""
WITH f AS (SELECT *, AirTime + ok * 13 % 160 AS x, md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in IDS)})) AS h FROM flights WHERE DepDel15 IS NOT NULL),
p AS (SELECT *, row_number() OVER (ORDER BY h) <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM f),
m AS (SELECT regr_slope(DepDelayMinutes, x) AS b, regr_intercept(DepDelayMinutes, x) AS a FROM p WHERE NOT is_test),
t AS (SELECT x, DepDelayMinutes AS y, row_number() OVER (ORDER BY h) - 1 AS i, count(*) OVER () AS n FROM p WHERE is_test),
s AS (SELECT r, 1 + floor((r + 0.5::DOUBLE) * ((SELECT max(n) FROM t) - 1) / 5)::BIGINT AS shift FROM range(5) q(r)),
d AS (SELECT r, t.y, t.x, o.x AS xd FROM s, t JOIN t o ON o.i = (t.i + shift) % t.n),
e AS (SELECT r, 1 - sum((y - a - b * x) ** 2) / (count(*) * var_pop(y)) AS whole, 1 - sum((y - a - b * xd) ** 2) / (count(*) * var_pop(y)) AS mixed FROM d, m GROUP BY r)
SELECT 'lin_reg' AS model, 'ElapsedTime' AS feature, {R('avg(whole - mixed)', 'importance')} FROM e""",
)
def importance_single(spark, sf):
    """Importance of the only feature of a line, on all test rows."""
    train, test = split(spark, sf)
    model = md.make_estimator("lin_reg", {}).fit(md.assemble(train, ["ElapsedTime"], "DepDelayMinutes"))
    data = md.assemble(test, ["ElapsedTime"], "DepDelayMinutes", IDS)
    return r6(ev.permutation_importance(model, "lin_reg", data, ["ElapsedTime"], "reg", IDS), "importance")
