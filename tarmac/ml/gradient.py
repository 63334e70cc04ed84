"""Losses, layers and the fitted model of linear models and perceptrons; ``epochs`` trains them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasStepSize, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _act(name: str, z: np.ndarray) -> np.ndarray:
    """Activations, in the place of ``z``."""
    if name == "relu":
        return np.maximum(z, 0, out=z)
    if name == "tanh":
        return np.tanh(z, out=z)
    with np.errstate(over="ignore"):
        np.exp(np.negative(z, out=z), out=z)
    z += 1
    return np.divide(1, z, out=z)


def _times_slope(name: str, delta: np.ndarray, a: np.ndarray) -> np.ndarray:
    """``delta`` times the slopes at the activations, in its place."""
    if name == "relu":
        return np.multiply(delta, a > 0, out=delta)
    slope = a * a
    np.subtract(1 if name == "tanh" else a, slope, out=slope)
    return np.multiply(delta, slope, out=delta)


def slope_of(name: str, z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope of a row's loss in z. Class labels are -1 and 1."""
    if name == "squared_error":
        return z - y
    if name == "squared_epsilon_insensitive":
        e = z - y
        return 2 * (e - np.minimum(np.maximum(e, -0.1), 0.1))
    m = y * z
    if name == "log_loss":
        return -y / (1 + np.exp(np.minimum(np.maximum(m, -500), 500)))
    if name == "hinge":
        return np.where(m < 1, -y, 0.0)
    if name == "squared_hinge":
        return -2 * y * np.maximum(1 - m, 0)
    if name == "perceptron":
        return np.where(m <= 0, -y, 0.0)
    if name == "modified_huber":
        return np.where(m >= -1, -2 * y * np.maximum(1 - m, 0), -4 * y)
    raise ValueError(f"unknown loss: {name}")


def loss_and_slope(name: str, z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss per row and its slope in z. Class labels are -1 and 1."""
    slope = slope_of(name, z, y)
    if name == "squared_error":
        return slope * slope / 2, slope
    if name == "squared_epsilon_insensitive":
        return slope * slope / 4, slope
    m = y * z
    if name == "log_loss":
        return np.logaddexp(0, -m), slope
    if name == "perceptron":
        return np.maximum(-m, 0), slope
    h = np.maximum(1 - m, 0)
    if name == "hinge":
        return h, slope
    return (h * h, slope) if name == "squared_hinge" else (np.where(m >= -1, h * h, -4 * m), slope)


def _layers(sizes: list[int], flat: np.ndarray):
    at = 0
    for n_in, n_out in zip(sizes, sizes[1:]):
        w = flat[at : at + n_in * n_out].reshape(n_in, n_out)
        at += n_in * n_out
        yield w, flat[at : at + n_out]
        at += n_out


def forward(sizes: list[int], flat: np.ndarray, x: np.ndarray, activation: str) -> list[np.ndarray]:
    out = [x]
    layers = list(_layers(sizes, flat))
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w
        z += b
        out.append(_act(activation, z) if i < len(layers) - 1 else z)
    return out


def gradient(sizes: list[int], flat: np.ndarray, x: np.ndarray, y: np.ndarray, activation: str, loss: str):
    outs = forward(sizes, flat, x, activation)
    value, slope = loss_and_slope(loss, outs[-1][:, 0], y)
    layers = list(_layers(sizes, flat))
    delta, parts = slope[:, None], []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(delta.sum(axis=0))
        parts.append((outs[i].T @ delta).ravel())
        if i:
            delta = _times_slope(activation, delta * layers[i][0].T if delta.shape[1] == 1 else delta @ layers[i][0].T, outs[i])
    return float(value.sum()), np.concatenate(parts[::-1])


def weight_mask(sizes: list[int]) -> np.ndarray:
    """1 for weights, 0 for intercepts, which carry no penalty."""
    return np.concatenate([np.r_[np.ones(a * b), np.zeros(b)] for a, b in zip(sizes, sizes[1:])])


class GradientParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasTol, HasSeed):
    loss = Param(Params._dummy(), "loss", "loss name", TypeConverters.toString)
    hidden = Param(Params._dummy(), "hidden", "sizes of hidden layers, empty for a linear model", TypeConverters.toListInt)
    activation = Param(Params._dummy(), "activation", "relu, tanh or logistic", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty weight", TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "share of the absolute penalty", TypeConverters.toFloat)
    kind = Param(Params._dummy(), "kind", "clf or reg", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "decision value or probability", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(
            loss="squared_error", hidden=[], activation="relu", alpha=1e-4, l1Ratio=0.0, kind="reg", scoreCol="score",
            maxIter=100, stepSize=0.1, tol=1e-6, seed=42,
        )


class GradientModel(Model, GradientParams, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "all weights in a row", TypeConverters.toListFloat)
    sizes = Param(Params._dummy(), "sizes", "layer sizes", TypeConverters.toListInt)
    shift = Param(Params._dummy(), "shift", "mean of the target", TypeConverters.toFloat)
    scale = Param(Params._dummy(), "scale", "spread of the target", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, weights=None, sizes=None, shift=None, scale=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        flat, sizes, activation = np.array(get("weights")), get("sizes"), get("activation")
        shift, scale = get("shift"), get("scale")

        @F.pandas_udf(T.DoubleType())
        def decide(x: pd.Series) -> pd.Series:
            return pd.Series(forward(sizes, flat, np.stack(x.to_numpy()), activation)[-1][:, 0] * scale + shift)

        out = dataset.withColumn(get("scoreCol"), decide(vector_to_array(get("featuresCol"))))
        score = F.col(get("scoreCol"))
        if get("kind") == "reg":
            return out.withColumn(get("predictionCol"), score)
        out = out.withColumn(get("predictionCol"), (score > 0).cast("double"))
        return out.withColumn(get("scoreCol"), 1 / (1 + F.exp(-score))) if get("loss") == "log_loss" else out
