"""Linear models by stochastic steps and perceptrons, trained by local epochs over matrix blocks.

In a pass each block takes the common weights through its rows in a seeded order, row by row. Perceptrons go in batches through all
blocks of a task, one block after the other, so that a pass over more rows makes more steps of the same model. The linear models of a task's blocks step in lockstep, a row of each block at a time, and long blocks are cut
into lanes of ``LANE_ROWS`` rows that start from the same weights, so a pass over more rows takes no more steps in turn. The weights (and the memory of the solver) are then averaged over the blocks by their rows. The quasi-Newton
solver instead asks for gradients summed over all rows. Any number of models (parameter sets, folds, targets) are trained side
by side: the linear ones as columns of one weight matrix, with a mask that leaves a column's fold out.

Step schedules and stopping rules are those of the usual stochastic solvers: constant, optimal, invscaling and adaptive steps;
a model stops after some epochs without a fall of its training loss.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Generator
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tarmac.ml.blocks import Block, Packed, add_up, pack, vector_columns
from tarmac.ml.gradient import GradientModel, GradientParams, forward, gradient, loss_and_slope, slope_of, weight_mask

#: Epochs of a perceptron between two averages at most and the rows of a task they go through at least, rows of its batches, rows whose
#: gradient is summed at a time, and the memory of the quasi-Newton solver.
LOCAL_EPOCHS, LOCAL_ROWS, BATCH, SUMMED, MEMORY = 4, 1 << 16, 200, 512, 10
#: Rows of a lane at most, rows of the lanes that step together, and numbers that are prepared at a time.
LANE_ROWS, TOGETHER, PREPARED = 8_192, 1 << 20, 1 << 20
#: Lanes of a task, if there are so many: a step of several takes hardly longer than that of one.
TASK_LANES = 6
SCHEDULES = ("constant", "optimal", "invscaling", "adaptive")
_CLIP = 1e12


@dataclass(frozen=True)
class SgdPlan:
    """A linear model."""

    kind: str = "reg"
    loss: str = "squared_error"
    alpha: float = 1e-4
    l1: float = 0.0
    schedule: str = "invscaling"
    eta0: float = 0.01
    power: float = 0.25
    epochs: int = 1000
    tol: float = 1e-3
    patience: int = 5
    fold: int | None = None
    label: int = 0
    seed: int = 42

    @property
    def offset(self) -> float:
        """Where the counter of the optimal schedule begins, so that first steps suit the size of the weights."""
        typical = math.sqrt(1 / math.sqrt(max(self.alpha, 1e-12)))
        slope = loss_and_slope(self.loss, np.array([-typical]), np.array([1.0]))[1][0]
        return 1 / (typical / max(1.0, abs(slope)) * max(self.alpha, 1e-12))


@dataclass(frozen=True)
class MlpPlan:
    """A perceptron with hidden layers."""

    kind: str = "reg"
    loss: str = "squared_error"
    hidden: tuple[int, ...] = (100,)
    activation: str = "relu"
    solver: str = "adam"
    alpha: float = 1e-4
    schedule: str = "constant"
    eta0: float = 1e-3
    epochs: int = 200
    tol: float = 1e-4
    patience: int = 10
    momentum: float = 0.9
    fold: int | None = None
    label: int = 0
    seed: int = 42


@dataclass(frozen=True)
class Ask:
    """A model's question to a pass: how its state moves, the gradient at its weights, or its score on the left-out fold."""

    plan: SgdPlan | MlpPlan
    kind: str
    flat: np.ndarray
    memory: tuple[np.ndarray, ...] = ()
    step: float = 0.0
    eta: float = 0.0
    epoch: int = 0
    epochs: int = 1


def _signed(kind: str, y: np.ndarray) -> np.ndarray:
    return 2 * y - 1 if kind == "clf" else y


def _lanes(blocks: list[Block], seed: int, epoch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (step, feature, lane), labels (step, label, lane) and folds (step, lane) of the lanes in their seeded orders; steps
    beyond the end of a lane have the fold -3."""
    cut = []
    for block in blocks:
        many = max(1, -(-len(block.x) // LANE_ROWS))
        for lane, own in enumerate(np.array_split(np.arange(len(block.x)), many)):
            order = np.random.default_rng([seed, epoch, block.number, lane] if lane else [seed, epoch, block.number]).permutation(len(own))
            cut.append((block, own[0] + order if len(own) else own))
    steps = max(len(own) for _, own in cut)
    x, y = np.zeros((steps, blocks[0].x.shape[1], len(cut))), np.zeros((steps, blocks[0].y.shape[1], len(cut)))
    fold = np.full((steps, len(cut)), -3)
    for k, (block, own) in enumerate(cut):
        x[: len(own), :, k], y[: len(own), :, k], fold[: len(own), k] = block.x[own], block.y[own], block.fold[own]
    return x, y, fold


def sgd_pass(asks: list[Ask], blocks: list[Block]) -> list[dict]:
    """One epoch of all linear models over some blocks: arrays (model, lane) that take one row of each lane at a time."""
    # models of one loss stand side by side
    order = sorted(range(len(asks)), key=lambda i: asks[i].plan.loss)
    asks = [asks[i] for i in order]
    plans = [a.plan for a in asks]
    x, y, fold = _lanes(blocks, plans[0].seed, asks[0].epoch)
    steps, width, lanes = x.shape
    models = len(plans)
    losses = {}
    for i, p in enumerate(plans):
        losses[p.loss] = slice(losses[p.loss].start if p.loss in losses else i, i + 1)

    def column(values: list) -> np.ndarray:
        return np.array(values, float)[:, None]

    alpha, l1 = column([p.alpha for p in plans]), column([p.l1 for p in plans])
    lasso, ridge = alpha * l1, alpha * (1 - l1)
    eta, eta0, power = column([a.eta for a in asks]), column([p.eta0 for p in plans]), column([p.power for p in plans])
    offset = column([p.offset if p.schedule == "optimal" else 0.0 for p in plans])
    optimal, scaled = column([p.schedule == "optimal" for p in plans]) > 0, column([p.schedule == "invscaling" for p in plans]) > 0
    left_out = np.array([-2 if p.fold is None else p.fold for p in plans])[:, None]
    label, clf = np.array([p.label for p in plans]), column([p.kind == "clf" for p in plans]) > 0
    absolute = bool(lasso.any())
    w = np.repeat(np.stack([a.flat[:-1] for a in asks], axis=1)[:, :, None], lanes, axis=2)
    b = np.repeat(column([a.flat[-1] for a in asks]), lanes, axis=1)
    t = np.repeat(column([a.step for a in asks]), lanes, axis=1)
    total, seen = np.zeros((models, lanes)), np.zeros((models, lanes))
    slope = np.zeros((models, lanes))
    chunk = max(1, min(512, PREPARED // (models * lanes)))
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        for begin in range(0, steps, chunk):
            rows = x[begin : begin + chunk]
            target = y[begin : begin + chunk][:, label]
            target = np.where(clf, 2 * target - 1, target)
            home = fold[begin : begin + chunk, None, :]
            use = ((home != left_out) & (home != -3)).astype(float)
            count = t + use.cumsum(axis=0)
            rate = np.broadcast_to(eta, count.shape)
            if optimal.any():
                rate = np.where(optimal, 1 / (alpha * (offset + count - 1)), rate)
            if scaled.any():
                rate = np.where(scaled, eta0 / np.maximum(count, 1) ** power, rate)
            # rows that do not count leave everything as it is
            rate = np.where(use > 0, rate, 0.0)
            keep, cut = np.maximum(0, 1 - rate * ridge), rate * lasso
            decision = np.empty_like(count)
            for i in range(len(rows)):
                row = rows[i][:, None, :]
                z = np.add((row * w).sum(axis=0), b, out=decision[i])
                for name, own in losses.items():
                    slope[own] = slope_of(name, z[own], target[i, own])
                move = np.minimum(np.maximum(slope, -_CLIP), _CLIP) * rate[i]
                w *= keep[i]
                w -= row * move
                b -= move
                if absolute:
                    w = np.copysign(np.maximum(np.abs(w) - cut[i], 0), w)
            value = np.empty_like(count)
            for name, own in losses.items():
                value[:, own] = loss_and_slope(name, decision[:, own], target[:, own])[0]
            total += np.where(use > 0, value, 0.0).sum(axis=0)
            seen += use.sum(axis=0)
            t = count[-1]
        out: list[dict] = [{}] * models
        for place, j in enumerate(order):
            flat = np.r_[w[:, place] @ seen[place], b[place] @ seen[place]]
            n = float(seen[place].sum())
            out[j] = {"flat": flat, "n": n, "loss": float(total[place].sum()), "steps": n, "blocks": float((seen[place] > 0).sum())}
    return out


def mlp_pass(ask: Ask, blocks: list[Block]) -> dict:
    """Some epochs of a perceptron over neighbouring blocks, in turn: one chain of steps."""
    plan = ask.plan
    made = []
    for block in blocks:
        own = np.flatnonzero(block.fold != plan.fold) if plan.fold is not None else np.arange(len(block.x))
        if len(own):
            made.append((block, own))
    sizes = [blocks[0].x.shape[1], *plan.hidden, 1]
    flat, n = ask.flat.copy(), sum(len(own) for _, own in made)
    penalty = plan.alpha * weight_mask(sizes)
    first, second = (m.copy() for m in ask.memory)
    step, losses = ask.step, np.zeros(ask.epochs)
    with np.errstate(over="ignore", invalid="ignore"):
        for e in range(ask.epochs if n else 0):
            for at in np.random.default_rng([plan.seed, ask.epoch + e, made[0][0].number, len(made)]).permutation(len(made)):
                block, own = made[at]
                order = own[np.random.default_rng([plan.seed, ask.epoch + e, block.number]).permutation(len(own))]
                x, y = block.x[order], _signed(plan.kind, block.y[order, plan.label])
                for begin in range(0, len(order), BATCH):
                    rows = slice(begin, begin + BATCH)
                    value, grad = gradient(sizes, flat, x[rows], y[rows], plan.activation, plan.loss)
                    shrink = penalty * flat
                    losses[e] += value + float(shrink @ flat) / 2
                    grad += shrink
                    grad /= len(y[rows])
                    step += 1
                    if plan.solver == "adam":
                        first = 0.9 * first + 0.1 * grad
                        second = 0.999 * second + 0.001 * grad * grad
                        flat = flat - ask.eta * math.sqrt(1 - 0.999**step) / (1 - 0.9**step) * first / (np.sqrt(second) + 1e-8)
                    else:
                        first = plan.momentum * first - ask.eta * grad
                        flat = flat + plan.momentum * first - ask.eta * grad
    return {"flat": flat * n, "n": float(n), "losses": losses, "first": first * n, "second": second * n, "steps": step - ask.step, "blocks": float(n > 0)}


def _whole(ask: Ask, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> dict:
    """Gradient over the rows a model learns from, or its score on those it does not."""
    plan = ask.plan
    sizes = [x.shape[1], *getattr(plan, "hidden", ()), 1]
    activation = getattr(plan, "activation", "relu")
    if ask.kind == "score":
        own = fold == plan.fold
        target = y[own, plan.label]
        z = forward(sizes, ask.flat, x[own], activation)[-1][:, 0]
        e = (z > 0) == (target == 1) if plan.kind == "clf" else (z - target) ** 2
        return {"sums": np.array([own.sum(), e.sum(), target.sum(), (target**2).sum()], float)}
    own = np.ones(len(x), bool) if plan.fold is None else fold != plan.fold
    target = y[own, plan.label]
    if ask.kind == "start":
        return {"sums": np.array([own.sum(), target.sum()], float)}
    value, grad, rows, target = 0.0, np.zeros(len(ask.flat)), x[own], _signed(plan.kind, target)
    with np.errstate(over="ignore", invalid="ignore"):
        # as many rows at a time as stay in a cache with all their activations
        for begin in range(0, len(rows), SUMMED):
            part = gradient(sizes, ask.flat, rows[begin : begin + SUMMED], target[begin : begin + SUMMED], activation, plan.loss)
            value, grad = value + part[0], grad + part[1]
    return {"value": value, "grad": grad, "n": float(own.sum())}


Learning = Generator[Ask, dict | None, tuple[np.ndarray, float | None]]


def _scored(plan: SgdPlan | MlpPlan, flat: np.ndarray) -> Learning:
    if plan.fold is None:
        return flat, None
    if not np.isfinite(flat).all():
        return flat, float("nan")
    m, e, y, yy = (yield Ask(plan, "score", flat))["sums"]
    spread = yy - y * y / m if m else 0.0
    return flat, float("nan") if not m else e / m if plan.kind == "clf" else 1 - e / spread if spread else float("nan")


def _sgd(plan: SgdPlan, width: int) -> Learning:
    flat, step, eta = np.zeros(width + 1), 0.0, plan.eta0
    best, bad = math.inf, 0
    for epoch in range(plan.epochs):
        got = yield Ask(plan, "sgd", flat, step=step, eta=eta, epoch=epoch)
        if not got or not got["n"]:
            break
        flat = got["flat"] / got["n"]
        step += got["steps"] / got["blocks"]
        loss = got["loss"] / got["n"]
        if not np.isfinite(flat).all() or not math.isfinite(loss):
            flat = np.full_like(flat, np.nan)
            break
        bad = bad + 1 if loss > best - plan.tol else 0
        best = min(best, loss)
        if bad >= plan.patience:
            if plan.schedule != "adaptive" or eta <= 1e-6:
                break
            eta, bad = eta / 5, 0
    return (yield from _scored(plan, flat))


def _first_weights(plan: MlpPlan, width: int, mean: float) -> np.ndarray:
    rng = np.random.default_rng(plan.seed)
    sizes = [width, *plan.hidden, 1]
    factor = 2 if plan.activation == "logistic" else 6
    flat = np.concatenate([np.r_[rng.uniform(-1, 1, a * b) * math.sqrt(factor / (a + b)), np.zeros(b)] for a, b in zip(sizes, sizes[1:])])
    flat[-1] = mean if plan.kind == "reg" else 0.0
    return flat


def local_epochs(rows: float, parts: int) -> int:
    """Epochs between two averages: tasks of few rows go through theirs more than once."""
    return max(1, min(LOCAL_EPOCHS, math.ceil(LOCAL_ROWS * parts / max(rows, 1))))


def _mlp(plan: MlpPlan, width: int, parts: int = 1) -> Learning:
    got = yield Ask(plan, "start", np.zeros(0))
    n, total = got["sums"] if got else (0, 0.0)
    flat = _first_weights(plan, width, total / n if n else 0.0)
    if not n:
        return flat, None
    if plan.solver == "lbfgs":
        flat = yield from _quasi_newton(plan, flat, width)
        return (yield from _scored(plan, flat))
    first, second, step, eta = np.zeros_like(flat), np.zeros_like(flat), 0.0, plan.eta0
    best, bad, epoch = math.inf, 0, 0
    while epoch < plan.epochs:
        several = min(local_epochs(n, parts), plan.epochs - epoch)
        got = yield Ask(plan, "mlp", flat, (first, second), step, eta, epoch, several)
        flat, first, second = (got[k] / got["n"] for k in ("flat", "first", "second"))
        step += got["steps"] / got["blocks"]
        epoch += several
        if not np.isfinite(flat).all():
            break
        for loss in got["losses"] / got["n"]:
            bad = bad + 1 if loss > best - plan.tol else 0
            best = min(best, loss)
        if bad > plan.patience:
            if plan.solver != "sgd" or plan.schedule != "adaptive" or eta <= 1e-6:
                break
            eta, bad = eta / 5, 0
    return (yield from _scored(plan, flat))


def _quasi_newton(plan: MlpPlan, flat: np.ndarray, width: int) -> Generator[Ask, dict, np.ndarray]:
    """Limited-memory quasi-Newton steps on the summed gradient, with halved steps until the loss falls enough."""
    mask = weight_mask([width, *plan.hidden, 1])

    def at(point: np.ndarray) -> Generator[Ask, dict, tuple[float, np.ndarray]]:
        got = yield Ask(plan, "gradient", point)
        n = got["n"]
        return (got["value"] + plan.alpha / 2 * float((mask * point * point).sum())) / n, (got["grad"] + plan.alpha * mask * point) / n

    value, grad = yield from at(flat)
    pairs: deque = deque(maxlen=MEMORY)
    for _ in range(plan.epochs):
        if np.abs(grad).max() <= plan.tol or not math.isfinite(value):
            break
        direction, used = -grad, []
        for s, y, rho in reversed(pairs):
            a = rho * float(s @ direction)
            direction = direction - a * y
            used.append(a)
        if pairs:
            s, y, rho = pairs[-1]
            direction = direction / (rho * float(y @ y))
        else:
            direction = direction / max(1.0, float(np.abs(grad).sum()))
        for (s, y, rho), a in zip(pairs, reversed(used)):
            direction = direction + (a - rho * float(y @ direction)) * s
        slope = float(grad @ direction)
        if slope >= 0:
            pairs.clear()
            direction, slope = -grad, -float(grad @ grad)
        rate = 1.0
        while rate > 1e-10:
            new_value, new_grad = yield from at(flat + rate * direction)
            if math.isfinite(new_value) and new_value <= value + 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = rate * direction, new_grad - grad
        if float(s @ y) > 1e-12:
            pairs.append((s, y, 1 / float(s @ y)))
        flat, fell, value, grad = flat + s, value - new_value, new_value, new_grad
        if fell <= 1e-9 * max(1.0, abs(value)):
            break
    return flat


def _answers(asks: dict[int, Ask]):
    linear = [i for i, a in asks.items() if a.kind == "sgd"]
    # columns of one matrix share the order of the rows, so they are taken by epoch and seed
    groups: dict[tuple, list[int]] = {}
    for i in linear:
        groups.setdefault((asks[i].epoch, asks[i].plan.seed), []).append(i)

    def answer(blocks: list[Block]) -> dict[int, dict]:
        out = {}
        for own in groups.values():
            out.update(zip(own, sgd_pass([asks[i] for i in own], blocks)))
        out.update({i: mlp_pass(ask, blocks) for i, ask in asks.items() if ask.kind == "mlp"})
        summed, rest = {i: ask for i, ask in asks.items() if ask.kind not in ("sgd", "mlp")}, None
        for block in blocks if summed else ():
            found = {i: _whole(ask, block.x, block.y, block.fold) for i, ask in summed.items()}
            rest = found if rest is None else _sum(rest, found)
        return {**out, **(rest or {})}

    return answer


def _sum(a: dict, b: dict) -> dict:
    return {i: {k: a[i][k] + b[i][k] for k in a[i]} for i in a}


def lane_tasks(rows: int) -> int:
    """Tasks of the linear models: they follow from the rows alone, as the sums of a pass do."""
    return max(1, -(-rows // (TASK_LANES * LANE_ROWS)))


def learn(packed: Packed, plans: list[SgdPlan | MlpPlan]) -> list[tuple[np.ndarray, float | None]]:
    """Weights of every plan, and its score where it leaves a fold out."""
    models = [_sgd(p, packed.width) if isinstance(p, SgdPlan) else _mlp(p, packed.width, packed.rdd.getNumPartitions()) for p in plans]
    asks, done = {i: next(m) for i, m in enumerate(models)}, {}
    rdd = packed.rdd
    if all(isinstance(p, SgdPlan) for p in plans) and lane_tasks(packed.rows) < rdd.getNumPartitions():
        rdd = rdd.coalesce(lane_tasks(packed.rows))
    while asks:
        got = add_up(rdd, _answers(dict(asks)), _sum, TOGETHER) or {i: None for i in asks}
        for i, answer in got.items():
            try:
                asks[i] = models[i].send(answer)
            except StopIteration as end:
                done[i] = end.value
                del asks[i]
    return [done[i] for i in range(len(plans))]


class _EpochParams(GradientParams):
    schedule = Param(Params._dummy(), "schedule", "constant, optimal, invscaling or adaptive", TypeConverters.toString)
    eta0 = Param(Params._dummy(), "eta0", "first step", TypeConverters.toFloat)
    solver = Param(Params._dummy(), "solver", "adam, sgd or lbfgs", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(schedule="constant", eta0=0.01, solver="adam", maxIter=1000)


class EpochEstimator(Estimator, _EpochParams, DefaultParamsReadable, DefaultParamsWritable):
    """A linear model (no hidden layer) or a perceptron; the same seed and rows give the same model on any cluster."""

    @keyword_only
    def __init__(self, *, loss=None, hidden=None, activation=None, alpha=None, l1Ratio=None, kind=None, schedule=None, eta0=None, solver=None, maxIter=None, seed=None, featuresCol=None, labelCol=None, predictionCol=None, scoreCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def plan(self, **more: Any) -> SgdPlan | MlpPlan:
        get = self.getOrDefault
        if get("schedule") not in SCHEDULES or get("solver") not in ("adam", "sgd", "lbfgs"):
            raise ValueError(f"unknown schedule or solver: {get('schedule')}, {get('solver')}")
        if get("hidden"):
            return MlpPlan(get("kind"), get("loss"), tuple(get("hidden")), get("activation"), get("solver"), get("alpha"), get("schedule"), get("eta0"), get("maxIter"), seed=get("seed"), **more)
        power = 0.25 if get("kind") == "reg" else 0.5
        return SgdPlan(get("kind"), get("loss"), get("alpha"), get("l1Ratio"), get("schedule"), get("eta0"), power, get("maxIter"), seed=get("seed"), **more)

    def _fit(self, dataset: DataFrame) -> GradientModel:
        return fit_together([self], dataset, [self.getOrDefault("labelCol")])[0]


def fit_together(estimators: list[EpochEstimator], dataset: DataFrame, labels: list[str]) -> list[GradientModel]:
    """Models of all estimators, trained in common passes; estimator i learns ``labels[i]``."""
    names = sorted(set(labels))
    rows, columns = vector_columns(dataset, estimators[0].getOrDefault("featuresCol"), names)
    packed = pack(rows, columns, names, seed=estimators[0].getOrDefault("seed"))
    try:
        found = learn(packed, [e.plan(label=names.index(y)) for e, y in zip(estimators, labels, strict=True)])
    finally:
        packed.free()
    return [
        e._copyValues(GradientModel(weights=[float(v) for v in flat], sizes=[len(columns), *e.getOrDefault("hidden"), 1], shift=0.0, scale=1.0))
        for e, (flat, _) in zip(estimators, found)
    ]
