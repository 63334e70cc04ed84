"""Model registry: from a name and parameters to a fitted ``pyspark.ml`` model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.ml.boosting import HistBoost, fit_side_by_side
from tarmac.ml.epochs import EpochEstimator, fit_together
from tarmac.operators.shape import feature_names
from tarmac.plans.storage import keep_rounds, materialize

SEED = 42


@dataclass(frozen=True)
class ModelSpec:
    kind: str
    target: str
    exclude: tuple[str, ...]
    params: dict = field(default_factory=dict)
    n_iter: int = 10
    grid: dict[str, list] = field(default_factory=dict)


_REG = ("reg", "DepDelayMinutes", ("DepDel15",))
_CLF = ("clf", "DepDel15", ("DepDelayMinutes",))
# Tuned parameters and search spaces of the eight models.
_TREE_GRID = {
    "learning_rate": [0.01, 0.05, 0.1, 0.2, 0.3, 0.5],
    "max_depth": [3, 5, 10, 15],
    "min_samples_leaf": [1, 3, 5, 10, 20],
    "max_iter": [100, 200, 500, 1000],
    "l2_regularization": [0.0, 0.1, 0.5, 1.0],
    "max_bins": [63, 127, 255],
}
_NET_GRID = {
    "hidden_layer_sizes": [[50], [100], [50, 50], [100, 50], [100, 100]],
    "activation": ["relu", "tanh", "logistic"],
    "solver": ["adam", "sgd", "lbfgs"],
    "alpha": [0.0001, 0.001, 0.01, 0.1, 1.0],
    "learning_rate": ["constant", "adaptive"],
    "max_iter": [500, 1000, 2000, 5000],
}
_ALPHAS = [0.00001, 0.0001, 0.001, 0.01, 0.1, 1.0]
_STEPS = [1000, 2000, 5000, 10000]
MODELS: dict[str, ModelSpec] = {
    "lin_reg": ModelSpec(*_REG),
    "hgb_reg": ModelSpec(
        *_REG,
        {"random_state": 42, "min_samples_leaf": 20, "max_iter": 1000, "max_depth": 10, "max_bins": 255, "learning_rate": 0.05, "l2_regularization": 0.1},
        40,
        _TREE_GRID,
    ),
    "sgd_reg": ModelSpec(
        *_REG,
        {"random_state": 42, "penalty": "l2", "max_iter": 1000, "loss": "squared_error", "learning_rate": "adaptive", "eta0": 0.001, "alpha": 0.001},
        30,
        {
            "loss": ["squared_error", "squared_epsilon_insensitive"],
            "alpha": _ALPHAS,
            "max_iter": _STEPS,
            "eta0": [0.0001, 0.001, 0.01, 0.1, 1.0],
            "learning_rate": ["constant", "optimal", "invscaling", "adaptive"],
            "penalty": ["l2", "l1", "elasticnet"],
        },
    ),
    "mlp_reg": ModelSpec(
        *_REG,
        {"random_state": 42, "solver": "adam", "max_iter": 1000, "learning_rate": "adaptive", "hidden_layer_sizes": [100], "alpha": 1.0, "activation": "logistic"},
        20,
        _NET_GRID,
    ),
    "log_reg": ModelSpec(*_CLF, {"random_state": 42}, 10, {"random_state": [42]}),
    "hgb_clf": ModelSpec(
        *_CLF,
        {"random_state": 42, "min_samples_leaf": 3, "max_iter": 500, "max_depth": 10, "max_bins": 63, "learning_rate": 0.05, "l2_regularization": 0.5},
        40,
        _TREE_GRID,
    ),
    "sgd_clf": ModelSpec(
        *_CLF,
        {"random_state": 42, "penalty": "elasticnet", "max_iter": 5000, "loss": "log_loss", "alpha": 0.001},
        30,
        {
            "loss": ["hinge", "log_loss", "modified_huber", "squared_hinge", "perceptron"],
            "alpha": _ALPHAS,
            "max_iter": _STEPS,
            "penalty": ["l2", "elasticnet"],
        },
    ),
    "mlp_clf": ModelSpec(
        *_CLF,
        {"random_state": 42, "solver": "sgd", "max_iter": 2000, "learning_rate": "constant", "hidden_layer_sizes": [100, 100], "alpha": 0.01, "activation": "tanh"},
        20,
        _NET_GRID,
    ),
}
# Share of the absolute penalty per penalty name.
_L1_SHARE = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.15, None: 0.0}

def select_models(selection: str) -> list[str]:
    """A model name, or ``all``, ``clf``, ``reg``."""
    if selection in MODELS:
        return [selection]
    names = [n for n, s in MODELS.items() if selection in ("all", s.kind)]
    if not names:
        raise ValueError(f"unknown model selection: {selection}")
    return names


def model_params(name: str, base: bool = False) -> dict:
    """Tuned parameters, or for the base model only the seed where one is listed."""
    params = MODELS[name].params
    return {k: v for k, v in params.items() if k == "random_state"} if base else dict(params)


def assemble(df: DataFrame, features: list[str], label: str, keep: list[str] | None = None) -> DataFrame:
    """Columns ``features`` (vector) and ``label``, plus those to keep. Rows with missing features are an error."""
    vec = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    return vec.transform(df).select("features", F.col(label).cast("double").alias("label"), *(keep or []))


def make_estimator(name: str, params: dict, rows: int = 1) -> Estimator:
    """Estimator for a model name and its parameters. ``rows`` sets the penalty of the logistic regression (C = 1 is 1/n here)."""
    p = params.get
    seed = p("random_state", SEED)
    if name == "lin_reg":
        return LinearRegression(regParam=0.0, solver="normal")
    if name == "log_reg":
        return LogisticRegression(regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False)
    if name in ("hgb_reg", "hgb_clf"):
        return HistBoost(
            kind=name[4:], maxIter=p("max_iter", 100), maxDepth=p("max_depth") or 0, stepSize=p("learning_rate", 0.1), maxBins=p("max_bins", 255),
            leastRows=p("min_samples_leaf", 20), l2=float(p("l2_regularization", 0.0)), seed=seed,
        )
    if name in ("sgd_reg", "sgd_clf"):
        reg = name == "sgd_reg"
        return EpochEstimator(
            kind=name[4:], loss=p("loss", "squared_error" if reg else "hinge"), alpha=p("alpha", 1e-4), l1Ratio=_L1_SHARE[p("penalty", "l2")],
            schedule=p("learning_rate", "invscaling" if reg else "optimal"), eta0=p("eta0", 0.01), maxIter=p("max_iter", 1000), seed=seed,
        )
    if name in ("mlp_reg", "mlp_clf"):
        return EpochEstimator(
            kind=name[4:], loss="squared_error" if name == "mlp_reg" else "log_loss", hidden=p("hidden_layer_sizes", [100]), activation=p("activation", "relu"),
            solver=p("solver", "adam"), alpha=p("alpha", 1e-4), schedule=p("learning_rate", "constant"), eta0=p("learning_rate_init", 1e-3), maxIter=p("max_iter", 200), seed=seed,
        )
    if name == "rf_clf":
        return RandomForestClassifier(numTrees=p("n_estimators", 100), maxDepth=p("max_depth", 10), cacheNodeIds=True, seed=seed)
    if name == "rf_reg":
        return RandomForestRegressor(numTrees=p("n_estimators", 100), maxDepth=p("max_depth", 10), cacheNodeIds=True, seed=seed)
    raise ValueError(f"unknown model: {name}")


def features_of(columns: list[str], name: str, ids: list[str]) -> list[str]:
    spec = MODELS[name]
    return feature_names(columns, [*spec.exclude, *ids], spec.target)


def train_model(name: str, train: DataFrame, ids: list[str], base: bool = False, overrides: dict | None = None) -> tuple[Model, list[str]]:
    """Fit a registered model on a train table; returns the model and its feature list."""
    spec = MODELS[name]
    features = features_of(train.columns, name, ids)
    keep_rounds(train.sparkSession)
    data = assemble(train, features, spec.target).persist()
    try:
        params = {**model_params(name, base), **(overrides or {})}
        return make_estimator(name, params, data.count()).fit(data), features
    finally:
        data.unpersist()


def train_models(train: DataFrame, ids: list[str], wanted: list[tuple[str, bool]]) -> dict[tuple[str, bool], tuple[Model, list[str]]]:
    """Models by (name, base): those of one family are trained in common passes over the train table."""
    keep_rounds(train.sparkSession)
    families: dict[type, list[tuple[str, bool]]] = {}
    data = materialize(train, "train")
    rows = data.count()
    made = {key: make_estimator(key[0], model_params(*key), rows) for key in wanted}
    for key, estimator in made.items():
        families.setdefault(type(estimator), []).append(key)
    out = {}
    for family, keys in families.items():
        features = {key: features_of(data.columns, key[0], ids) for key in keys}
        together = {HistBoost: fit_side_by_side, EpochEstimator: fit_together}.get(family)
        if together is None:
            for key in keys:
                out[key] = made[key].fit(assemble(data, features[key], MODELS[key[0]].target)), features[key]
            continue
        # regressors and classifiers learn from the same features, so one table serves both
        for shared in {tuple(f) for f in features.values()}:
            own = [key for key in keys if tuple(features[key]) == shared]
            targets = [MODELS[key[0]].target for key in own]
            vectors = VectorAssembler(inputCols=list(shared), outputCol="features", handleInvalid="error").transform(data).select("features", *sorted(set(targets)))
            for key, model in zip(own, together([made[key] for key in own], vectors, targets)):
                out[key] = model, list(shared)
    return out


def score_column(df: DataFrame) -> DataFrame:
    """Add ``score``: probability of class 1 when the model gives one, else its decision value."""
    if "score" in df.columns:
        return df
    for c in ("probability", "rawPrediction"):
        if c in df.columns:
            return df.withColumn("score", vector_to_array(c)[1])
    return df.withColumn("score", F.col("prediction"))


def predictions(model: Model, data: DataFrame, name: str) -> DataFrame:
    """Rows of (model, label, prediction, score) for the metrics."""
    out = score_column(model.transform(data))
    return out.select(F.lit(name).alias("model"), "label", "prediction", "score")
