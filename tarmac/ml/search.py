"""Cross-validation, random and exhaustive search."""

from __future__ import annotations

import json
import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.ml.blocks import pack, vector_columns
from tarmac.ml.boosting import HistBoost, fit_side_by_side
from tarmac.ml.epochs import EpochEstimator, learn
from tarmac.ml.gram import gram_scores, row_grams
from tarmac.ml.models import MODELS, SEED, assemble, features_of, make_estimator
from tarmac.operators.sampling import kfold_assign, stratified_sample
from tarmac.plans.storage import materialize


def evaluator(kind: str):
    return MulticlassClassificationEvaluator(metricName="accuracy") if kind == "clf" else RegressionEvaluator(metricName="r2")


def draw(grid: dict[str, list], n_iter: int, seed: int = SEED) -> list[dict]:
    """Parameter sets drawn without replacement from a grid; all of them when there are fewer."""
    names = sorted(grid)
    total = 1
    for n in names:
        total *= len(grid[n])
    out = []
    for spot in random.Random(seed).sample(range(total), min(n_iter, total)):
        params = {}
        for n in names:
            spot, i = divmod(spot, len(grid[n]))
            params[n] = grid[n][i]
        out.append(params)
    return out


def fold_scores(make, data: DataFrame, kind: str, folds: int, fold_col: str = "fold", parallelism: int = 4) -> list[float]:
    """Score of each fold: fit on the others, evaluate on it. Folds are independent Spark jobs."""
    metric = evaluator(kind)

    def one(f: int) -> float:
        spark.sparkContext.setJobGroup(group, "fits without one fold", interruptOnCancel=True)
        model = make().fit(data.filter(F.col(fold_col) != f))
        return metric.evaluate(model.transform(data.filter(F.col(fold_col) == f)))

    spark = data.sparkSession
    group = f"folds-{uuid.uuid4().hex}"
    with ThreadPoolExecutor(parallelism) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(one), f) for f in range(folds)]
        try:
            return [s.result() for s in started]
        except BaseException:
            # nothing may go on reading tables that the caller then deletes
            for s in started:
                s.cancel()
            spark.sparkContext.cancelJobGroup(group)
            raise


def side_by_side(estimators: list[Estimator], data: DataFrame, kind: str, folds: int, fold_col: str = "fold") -> list[list[float]]:
    """Scores on each fold for every estimator (all of one family), with ``data`` assembled and foldered.

    Boosted trees, stochastic linear models and perceptrons of all parameter sets and folds are trained in common passes; least
    squares needs one pass for all. Other estimators are fitted one by one, their folds as parallel jobs.
    """
    first = estimators[0]
    if isinstance(first, HistBoost):
        return fit_side_by_side(estimators, data, ["label"], fold_col, folds)
    if isinstance(first, (EpochEstimator, LinearRegression)):
        rows, columns = vector_columns(data, "features", ["label"], (fold_col,))
        if isinstance(first, LinearRegression):
            grams, get = row_grams(rows, columns, ["label"], fold_col, folds), LinearRegression.getOrDefault
            return [gram_scores(grams, len(columns), 0, get(e, "regParam"), get(e, "elasticNetParam")) for e in estimators]
        packed = pack(rows, columns, ["label"], fold_col)
        try:
            scores = [s for _, s in learn(packed, [e.plan(fold=f) for e in estimators for f in range(folds)])]
        finally:
            packed.free()
        return [scores[i * folds : (i + 1) * folds] for i in range(len(estimators))]
    return [fold_scores(lambda e=e: e, data, kind, folds, fold_col) for e in estimators]


def random_search(
    name: str,
    train: DataFrame,
    ids: list[str],
    n_iter: int | None = None,
    folds: int = 5,
    fraction: float = 0.1,
    overrides: dict | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per drawn parameter set: the parameters as fitted as JSON text, mean score and its place.

    All sets and folds are trained side by side on a class-balanced sample of the train table; a set that does not converge to
    finite weights has the score null and comes last. The drawn sets are bounded by ``n_iter``, so the result is small.
    """
    spec = MODELS[name]
    sample = stratified_sample(train, fraction, ids, ["DepDel15"], seed)
    sample = materialize(kfold_assign(sample, folds, ids, ["DepDel15"] if spec.kind == "clf" else None, seed), "search")
    features = [f for f in features_of(sample.columns, name, ids) if f != "fold"]
    data = assemble(sample, features, spec.target, ["fold"])
    sets = [{**params, **(overrides or {})} for params in draw(spec.grid, n_iter or spec.n_iter, seed)]
    rows = data.count()
    scores = side_by_side([make_estimator(name, params, rows) for params in sets], data, spec.kind, folds)
    found = [(name, json.dumps(params, sort_keys=True), sum(s) / folds) for params, s in zip(sets, scores)]
    return results_frame(train.sparkSession, found)


def results_frame(spark: SparkSession, found: list[tuple[str, str, float]]) -> DataFrame:
    found = [(m, p, None if s is None or math.isnan(s) else float(s)) for m, p, s in found]
    ordered = sorted(found, key=lambda r: (r[2] is None, -(r[2] or 0.0), r[1]))
    schema = T.StructType(
        [
            T.StructField("model", T.StringType()),
            T.StructField("params", T.StringType()),
            T.StructField("mean_score", T.DoubleType()),
            T.StructField("place", T.IntegerType()),
        ]
    )
    return spark.createDataFrame([(*r, i + 1) for i, r in enumerate(ordered)], schema)


def best_params(results: DataFrame) -> str:
    """Best parameter set as JSON text."""
    return results.filter("place = 1").first()["params"]


def grid_search(estimator: Estimator, grid: dict[str, list], data: DataFrame, kind: str, folds: int, fold_col: str = "fold") -> DataFrame:
    """Mean score over given folds for every combination of a grid of estimator parameters."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    scores = side_by_side([estimator.copy(m) for m in maps], data, kind, folds, fold_col)
    text = [json.dumps({p.name: v for p, v in m.items()}, sort_keys=True) for m in maps]
    return results_frame(data.sparkSession, [(type(estimator).__name__, t, sum(s) / folds) for t, s in zip(text, scores)])
