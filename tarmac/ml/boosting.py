"""Boosted trees on byte-coded features.

Values are coded once as quantile bins, with a bin of their own for missing values. A pass over the blocks sums gradients,
hessians and rows per (node, feature, bin) for the nodes that are asked for; of two siblings only the smaller is summed, the
other is the parent minus it. Trees grow best gain first up to a number of leaves; to save passes, all open nodes that may still
be split are looked at together, and the splits are then taken in the order of their gains. Any number of models (parameter sets,
folds, targets) grow side by side: each pass answers what all of them ask.

A table of few blocks needs no passes: its rows are coded where they are, the codes go to one task, and the same growth runs inside it;
models run beside each other in several tasks. Idle cores of its executor help such a task, as processes that hold some of its rows and
answer over pipes; slopes are rounded to a unit in which all sums are exact, so the model does not depend on their number. What such a task may hold is bounded, so larger tables always take the passes.

A model stops after ten rounds in which the loss on a held-out tenth, each tenth row in hash order, did not fall.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.connection import Pipe
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasStepSize
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.ml.blocks import Block, Packed, add_up, pack, vector_columns

#: Trees whose values are worked out anew in each pass before they are written into the kept scores, and how often those are
#: written to the shared folder.
PENDING, CHECKPOINT = 4, 10
EARLY_ROWS = 10_000
#: Rows of a block at least, if its features are not too many.
BLOCK_ROWS = 1 << 20
#: Times ``BLOCK_ROWS`` up to which all codes go to one task, and their bytes at most: up to there that takes less time than the passes.
ALONE, ALONE_CODES = 3, 64 << 20
#: Cells of features that are counted together.
JOINT_CELLS = 1 << 16
#: Rows whose values are sent together to find the edges of bins, and values at most.
EDGE_ROWS, EDGE_POINTS = 1 << 20, 1 << 16
#: Rows that are led through the trees together.
PREDICTED = 1 << 16
#: Rows of a process at least, where a task uses several.
HAND_ROWS = 1 << 16
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class BoostPlan:
    """What to fit: one model."""

    kind: str = "reg"
    rounds: int = 100
    step: float = 0.1
    depth: int | None = None
    leaves: int = 31
    bins: int = 255
    least_rows: int = 20
    l2: float = 0.0
    #: None stops early on tables of more than ``EARLY_ROWS`` rows.
    early: bool | None = None
    flat: int = 10
    tol: float = 1e-7
    #: Rows of this fold are left out, and scored at the end.
    fold: int | None = None
    label: int = 0


@dataclass
class Tree:
    """Nodes in arrays; a leaf points at itself."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = len(self.left), len(self.left) + 1
        for child in (self.left[node], self.right[node]):
            self.feature.append(0)
            self.cut.append(0)
            self.missing_left.append(False)
            self.left.append(child)
            self.right.append(child)
            self.value.append(0.0)
            self.depth.append(self.depth[node] + 1)
        return self.left[node], self.right[node]

    def packed(self) -> tuple:
        return (
            np.array(self.feature), np.array(self.cut), np.array(self.missing_left), np.array(self.left), np.array(self.right),
            np.array(self.value), max(self.depth),
        )


def leaf_of(tree: tuple, codes: np.ndarray, missing: int) -> np.ndarray:
    """Node in which each row ends; ``codes`` holds a line per feature."""
    feature, cut, missing_left, left, right, _, depth = tree
    n = codes.shape[1]
    flat, begin = codes.reshape(-1), feature * n
    node = np.zeros(n, np.intp)
    rows = np.arange(n)
    any_missing = bool((codes == missing).any())
    for _ in range(depth):
        code = flat.take(begin.take(node) + rows)
        go_left = code <= cut.take(node)
        if any_missing:
            go_left = np.where(code == missing, missing_left.take(node), go_left)
        node = np.where(go_left, left.take(node), right.take(node))
    return node


def rows_by_node(tree: tuple, codes: np.ndarray, missing: int, rows: np.ndarray, wanted: tuple[int, ...] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The rows that end in each leaf, or those that come to each of the ``wanted`` nodes, of which none is above another. Only
    the ways to these are gone, so a row costs as much as its way is long."""
    feature, cut, missing_left, left, right, *_ = tree
    on_way = None if wanted is None else set(wanted)
    if on_way is not None:
        # a child stands behind its parent
        for node in range(len(left) - 1, -1, -1):
            if left[node] != node and (int(left[node]) in on_way or int(right[node]) in on_way):
                on_way.add(node)
    ends = on_way and set(wanted or ())
    waiting = [(0, rows)]
    while waiting:
        node, own = waiting.pop()
        if on_way is not None and node not in on_way:
            continue
        if left[node] == node or (ends and node in ends):
            yield node, own
            continue
        to_left, to_right = _parted(codes[feature[node]], own, cut[node], missing_left[node], missing)
        waiting.append((int(right[node]), to_right))
        waiting.append((int(left[node]), to_left))


def _parted(codes: np.ndarray, rows: np.ndarray, cut: int, missing_left: bool, missing: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that go to the left and to the right of a split on a line of codes."""
    code = codes.take(rows)
    goes_left = code <= cut
    if missing_left:
        goes_left |= code == missing
    return rows.compress(goes_left), rows.compress(~goes_left)


def add_tree(raw: np.ndarray, tree: tuple, codes: np.ndarray, missing: int) -> None:
    """Add the values of a tree to the scores of the rows."""
    for node, own in rows_by_node(tree, codes, missing, np.arange(codes.shape[1])):
        raw[own] += tree[5][node]


def code_rows(x: np.ndarray, edges: list[np.ndarray], bins: int) -> np.ndarray:
    """Bin of each value, a line per feature; ``bins`` stands for missing."""
    codes = np.empty((x.shape[1], len(x)), np.uint8)
    for f, e in enumerate(edges):
        codes[f] = np.where(np.isnan(x[:, f]), bins, np.searchsorted(e, x[:, f]))
    return codes


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Upper ends of the bins of each feature, at most ``bins`` - 1: its values if they are few, else quantiles.

    Tasks send the values and counts of each feature, as many as ``EDGE_POINTS`` for each ``EDGE_ROWS`` rows; beyond that, values of
    evenly spaced ranks stand for those before them. One task of each feature adds them up.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _joined(batches, EDGE_ROWS):
            for f, column in enumerate(x):
                values, counts = _ranked(column[~np.isnan(column)], EDGE_POINTS)
                yield pa.RecordBatch.from_pydict({"f": [f], "v": [values.tobytes()], "n": [counts.tobytes()]}, schema)

    def ended(key: tuple, found: pa.Table) -> pa.Table:
        values, counts = (np.concatenate([np.frombuffer(b, kind) for b in found[c].to_pylist()]) for c, kind in (("v", np.float64), ("n", np.int64)))
        order = values.argsort(kind="stable")
        values, total = values[order], counts[order].cumsum()
        edges = values[total.searchsorted(total[-1] * np.arange(1, bins) / bins)] if len(values) else values
        return pa.table({"f": [key[0].as_py()], "e": [sorted({float(e) for e in edges if e < values[-1]})]}, pa.schema([("f", pa.int32()), ("e", pa.list_(pa.float64()))]))

    schema = pa.schema([("f", pa.int32()), ("v", pa.binary()), ("n", pa.binary())])
    real = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(features)])
    points = real.mapInArrow(counted, "f int, v binary, n binary")
    rows = points.groupBy("f").applyInArrow(ended, "f int, e array<double>").collect()  # a row for each feature
    found = {r["f"]: list(r["e"]) for r in rows}
    return [found.get(f, []) for f in range(len(features))]


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    """Columns of the batches, of about ``rows`` rows at a time."""
    held, count = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        count += batch.num_rows
        if count >= rows:
            yield np.concatenate(held, axis=1)
            held, count = [], 0
    if held:
        yield np.concatenate(held, axis=1)


def _ranked(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values with their counts; of more than ``most``, those at evenly spaced ranks, with the counts up to them."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) > most:
        total = counts.cumsum()
        kept = np.unique(total.searchsorted(total[-1] * np.arange(1, most + 1) / most))
        found, counts = found[kept], np.diff(total[kept], prepend=0)
    return found, counts.astype(np.int64)


def _slopes(kind: str, raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    if kind == "reg":
        return raw - y, None
    p = np.negative(raw)
    np.exp(p, out=p)
    p += 1
    np.divide(1, p, out=p)
    hessian = 1 - p
    hessian *= p
    p -= y
    return p, hessian


def _loss_sum(kind: str, raw: np.ndarray, y: np.ndarray) -> float:
    if kind == "reg":
        return float(((raw - y) ** 2).sum() / 2)
    return float((np.logaddexp(0, raw) - y * raw).sum())


@dataclass(frozen=True)
class _Ask:
    """One model's question to a pass over the blocks."""

    plan: BoostPlan
    early: bool
    kind: str
    tree: tuple | None = None
    nodes: tuple[int, ...] = ()
    start: float = 0.0


def _train_rows(ask: _Ask, fold: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = np.ones(len(fold), bool) if ask.plan.fold is None else fold != ask.plan.fold
    held = own & (place % 10 == 0) if ask.early else np.zeros(len(fold), bool)
    return own & ~held, held


def _answer(ask: _Ask, codes: np.ndarray, raw: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray) -> np.ndarray:
    plan = ask.plan
    train, held = _train_rows(ask, fold, place)
    if ask.kind == "start":
        return np.array([train.sum(), y[train].sum()])
    if ask.kind == "score":
        left = fold == plan.fold
        e = (raw[left] > 0) == (y[left] == 1) if plan.kind == "clf" else (raw[left] - y[left]) ** 2
        return np.array([left.sum(), e.sum(), y[left].sum(), (y[left] ** 2).sum()])
    width, cells = codes.shape[0], plan.bins + 1
    own = np.flatnonzero(train)
    reached = [(0, own)] if ask.tree is None else rows_by_node(ask.tree, codes, plan.bins, own, ask.nodes)
    spots = {node: k for k, node in enumerate(ask.nodes)}
    out = np.zeros((len(ask.nodes), 3, width, cells))
    for node, rows in reached:
        _node_sums(out[spots[node]], codes, rows, *_slopes(plan.kind, raw[rows], y[rows]))
    held_loss = _loss_sum(plan.kind, raw[held], y[held]) if ask.early and ask.tree is None else 0.0
    return np.concatenate([[held_loss], out.ravel()])


def _node_sums(out: np.ndarray, codes: Sequence[np.ndarray], rows: np.ndarray, gradient: np.ndarray, hessian: np.ndarray | None) -> None:
    """Gradients, hessians and rows per feature and bin of one node."""
    cells = out.shape[2]
    for f in range(len(codes)):
        code = codes[f].take(rows).astype(np.intp)
        out[0, f] = np.bincount(code, gradient, cells)
        out[2, f] = np.bincount(code, minlength=cells)
        out[1, f] = out[2, f] if hessian is None else np.bincount(code, hessian, cells)


class _OwnRows:
    """Answers of a table that is held by one task; rows of nodes and slopes of a round are kept between the questions.

    Features whose bins have few pairs are counted together, and their sums are those of the pairs.
    """

    def __init__(self, plan: BoostPlan, codes: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray, unit: float) -> None:
        self.plan, self.codes, self.y, self.fold, self.place, self.unit = plan, codes, y, fold, place, unit
        self.raw = np.zeros(len(y))
        self.train = self.held = self.rest = np.zeros(0, np.intp)
        self.nodes: dict[int, np.ndarray] = {}
        self.tree: tuple | None = None
        self.gradient: np.ndarray | None = None
        self.hessian: np.ndarray | None = None
        self.groups: list[_Joint] = []

    def begin(self, start: float) -> None:
        self.raw[:] = start

    def add(self, tree: Tree) -> None:
        packed = tree.packed()
        feature, cut, missing_left, left, right, value, _ = packed
        waiting = [(0, 0, self.train)]
        while waiting:
            node, grown, rows = waiting.pop()
            if left[node] == node:
                self.raw[rows] += value[node]
                continue
            # rows are known where the tree was asked for sums
            a, b = (int(self.tree[side][grown]) for side in (3, 4)) if self.tree is not None and grown >= 0 else (grown, grown)
            if a != grown and a in self.nodes:
                waiting += [(int(left[node]), a, self.nodes[a]), (int(right[node]), b, self.nodes[b])]
            else:
                to_left, to_right = _parted(self.codes[feature[node]], rows, cut[node], missing_left[node], self.plan.bins)
                waiting += [(int(left[node]), -1, to_left), (int(right[node]), -1, to_right)]
        for node, rows in rows_by_node(packed, self.codes, self.plan.bins, self.rest):
            self.raw[rows] += value[node]

    def _put_first(self, ask: _Ask) -> None:
        """Rows to learn from stand before the others, so that those of the root need not be picked."""
        train, _ = _train_rows(ask, self.fold, self.place)
        order = np.argsort(~train, kind="stable")
        self.codes, self.y, self.fold, self.place = self.codes.take(order, axis=1), self.y[order], self.fold[order], self.place[order]
        self.train, self.rest = np.split(np.arange(len(order)), [int(train.sum())])
        self.held = np.flatnonzero(_train_rows(ask, self.fold, self.place)[1])
        self.groups = _joint_codes(self.codes, self.plan.bins)

    def _picked(self, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return values[: len(rows)] if rows is self.train else values.take(rows)

    def _rows(self, node: int, tree: tuple, parents: dict[int, int]) -> np.ndarray:
        if node not in self.nodes:
            feature, cut, missing_left, left, right, *_ = tree
            parent = parents[node]
            rows = self._rows(parent, tree, parents)
            self.nodes[int(left[parent])], self.nodes[int(right[parent])] = _parted(self.codes[feature[parent]], rows, cut[parent], missing_left[parent], self.plan.bins)
        return self.nodes[node]

    def answer(self, ask: _Ask) -> np.ndarray:
        if ask.kind != "sums":
            if ask.kind == "start":
                self._put_first(ask)
            return _answer(ask, self.codes, self.raw, self.y, self.fold, self.place)
        plan, width, cells = self.plan, self.codes.shape[0], self.plan.bins + 1
        held_loss, parents = 0.0, {}
        self.tree = ask.tree
        if ask.tree is None:
            self.nodes = {0: self.train}
            self.gradient, self.hessian = _slopes(plan.kind, self.raw, self.y)
            _exact(self.gradient, self.unit)
            if self.hessian is not None:
                _exact(self.hessian, self.unit)
            held_loss = _loss_sum(plan.kind, self.raw[self.held], self.y[self.held])
        else:
            left, right = ask.tree[3], ask.tree[4]
            parents = {int(c): i for i in range(len(left)) if left[i] != i for c in (left[i], right[i])}
        out = np.zeros((len(ask.nodes), 3, width, cells))
        for k, node in enumerate(ask.nodes):
            rows = self._rows(node, ask.tree, parents)
            self._sums(out[k], rows, self._picked(self.gradient, rows), None if self.hessian is None else self._picked(self.hessian, rows))
        return np.concatenate([[held_loss], out.ravel()])

    def _sums(self, out: np.ndarray, rows: np.ndarray, gradient: np.ndarray, hessian: np.ndarray | None) -> None:
        """As ``_node_sums``; groups of more cells than the node has rows are not worth their sums."""
        alone = []
        for group in self.groups:
            if group.cells > len(rows) or len(group.features) == 1:
                alone += group.features
                continue
            code = self._picked(group.codes, rows).astype(np.intp)
            found = [np.bincount(code, minlength=group.cells), np.bincount(code, gradient, group.cells)]
            found += [] if hessian is None else [np.bincount(code, hessian, group.cells)]
            axes = range(len(group.features))
            for axis, (f, places) in enumerate(zip(group.features, group.places)):
                others = tuple(a for a in axes if a != axis)
                n, g, *h = (v.reshape(group.shape).sum(axis=others) for v in found)
                out[0, f, places], out[1, f, places], out[2, f, places] = g, h[0] if h else n, n
        if alone:
            part = np.zeros((3, len(alone), out.shape[2]))
            _node_sums(part, [self.codes[f] for f in alone], rows, gradient, hessian)
            out[:, alone] = part


@dataclass(frozen=True)
class _Joint:
    """Features whose codes are counted together: one number stands for the codes of all."""

    features: list[int]
    #: Codes that occur in each feature, in the order of their numbers.
    places: list[np.ndarray]
    codes: np.ndarray

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(len(p) for p in self.places)

    @property
    def cells(self) -> int:
        return int(np.prod(self.shape))


def _joint_codes(codes: np.ndarray, missing: int) -> list[_Joint]:
    places = [np.flatnonzero(np.bincount(line, minlength=missing + 1)) for line in codes]
    groups: list[list[int]] = []
    for f in sorted(range(len(codes)), key=lambda f: -len(places[f])):
        size = {id(g): len(places[f]) * int(np.prod([len(places[k]) for k in g])) for g in groups}
        fitting = [g for g in groups if size[id(g)] <= JOINT_CELLS]
        max(fitting, key=lambda g: size[id(g)]).append(f) if fitting else groups.append([f])
    out = []
    for group in groups:
        joint = np.zeros(codes.shape[1] if len(group) > 1 else 0, np.intp)
        for f in group if len(group) > 1 else ():
            number = np.zeros(missing + 1, np.intp)
            number[places[f]] = np.arange(len(places[f]))
            joint *= len(places[f])
            joint += number.take(codes[f])
        # short numbers of scattered rows are read faster
        out.append(_Joint(group, [places[f] for f in group], joint.astype(np.min_scalar_type(JOINT_CELLS - 1))))
    return out


def _unit(plan: BoostPlan, y: np.ndarray) -> float:
    """Power of two, of which slopes are taken as multiples: sums over all rows are then exact, in whatever order they are added."""
    largest = 1.0 if plan.kind == "clf" or not len(y) else 2 * float(y.max() - y.min())
    return 2.0 ** (np.ceil(np.log2(max(largest, 1e-300))) + np.ceil(np.log2(len(y) + 1)) - 52)


def _exact(values: np.ndarray, unit: float) -> None:
    """Round to multiples of ``unit``, in place."""
    far = 1.5 * unit * 2.0**52
    values += far
    values -= far


def _alone(plan: BoostPlan, codes: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray, hands: int = 1) -> tuple:
    """One model inside one task, with rows dealt to as many processes as the task may use cores; the model is the same for any number."""
    y, hands = y[:, plan.label], max(1, min(hands, len(y) // HAND_ROWS))
    unit = _unit(plan, y)
    spots = [slice(*ends) for ends in zip(*(np.linspace(0, len(y), hands + 1).astype(int)[k : k + hands] for k in (0, 1)))]
    helpers: list[_Helper] = []
    own = _OwnRows(plan, codes[:, spots[0]], y[spots[0]], fold[spots[0]], place[spots[0]], unit)
    model = _train(plan, len(y), codes.shape[0], ahead=hands > 1)
    try:
        for spot in spots[1:]:
            helpers.append(_Helper(helpers, plan, codes[:, spot], y[spot], fold[spot], place[spot], unit))
        said = next(model)
        while True:
            for helper in helpers:
                helper.tell(said)
            answer = _said(own, said)
            for helper in helpers:
                other = helper.answer()
                answer = answer if answer is None else answer + other
            if isinstance(said, _Ask) and said.kind == "start":
                # a sum that does not depend on who adds it
                train, _ = _train_rows(said, fold, place)
                answer = np.array([train.sum(), y[train].sum()])
            said = next(model) if answer is None else model.send(answer)
    except StopIteration as end:
        return end.value
    finally:
        for helper in helpers:
            helper.end()


def _said(own: _OwnRows, said: Any) -> np.ndarray | None:
    """What rows answer to a question, a tree or the starting score."""
    if isinstance(said, _Ask):
        return own.answer(said)
    return own.add(said) if isinstance(said, Tree) else own.begin(said)


class _Helper:
    """A process beside this one that answers for some of its rows, over pipes; it ends with this one."""

    def __init__(self, others: list[_Helper], plan: BoostPlan, codes: np.ndarray, y: np.ndarray, fold: np.ndarray, place: np.ndarray, unit: float) -> None:
        heard, self.say = Pipe(duplex=False)
        self.hear, say = Pipe(duplex=False)
        self.pid = os.fork()
        if self.pid:
            heard.close()
            say.close()
            return
        try:
            # an end that is open here would keep another process waiting
            for helper in (self, *others):
                helper.say.close()
                helper.hear.close()
            own = _OwnRows(plan, codes, y, fold, place, unit)
            while True:
                say.send(_said(own, heard.recv()))
        except EOFError:
            pass
        finally:
            os._exit(0)

    def tell(self, said: Any) -> None:
        self.say.send(said)

    def answer(self) -> np.ndarray | None:
        return self.hear.recv()

    def end(self) -> None:
        self.say.close()
        self.hear.close()
        os.waitpid(self.pid, 0)


def _hands(packed: Packed, slots: int) -> int:
    """Cores of an executor for each of the tasks that it gets."""
    context = packed.rdd.context
    executors = max(1, context._jsc.sc().getExecutorMemoryStatus().size() - (0 if context.master.startswith("local[") or context.master == "local" else 1))
    return max(1, context.defaultParallelism // max(slots, executors))


def _all_alone(packed: Packed, edges: dict[int, list[np.ndarray]], plans: list[BoostPlan]) -> list[tuple]:
    """Models beside each other in several tasks, each of which holds the codes of all rows."""
    slots = min(len(plans), packed.rdd.context.defaultParallelism)
    hands = _hands(packed, slots)

    def coded(block: Block) -> Iterator[tuple]:
        part = block.number, {b: code_rows(block.x, own, b) for b, own in edges.items()}, block.y, block.fold, block.place
        return ((slot, part) for slot in range(slots))

    def trained(parts: Iterator[tuple]) -> Iterator[tuple]:
        for slot, own in _by_slot(parts):
            y, fold, place = (np.concatenate([p[k] for p in own]) for k in (2, 3, 4))
            codes = {b: np.concatenate([p[1][b] for p in own], axis=1) for b in edges}
            own.clear()
            for i in range(slot, len(plans), slots):
                yield i, _alone(plans[i], codes[plans[i].bins], y, fold, place, hands)

    found = packed.rdd.flatMap(coded).partitionBy(slots, int).mapPartitions(trained).collect()  # trees of each model
    return [value for _, value in sorted(found, key=lambda f: f[0])]


def _by_slot(parts: Iterator[tuple]) -> Iterator[tuple[int, list[tuple]]]:
    """The parts of each slot in the order of their blocks."""
    held: dict[int, list[tuple]] = {}
    for slot, part in parts:
        held.setdefault(slot, []).append(part)
    for slot in sorted(held):
        yield slot, sorted(held[slot], key=lambda p: p[0])


def best_split(hist: np.ndarray, plan: BoostPlan) -> tuple[float, int, int, bool] | None:
    """(gain, feature, cut, missing to the left) of the best split of a node's sums (3 x feature x bin), or None."""
    sums = hist[:, :, :-1].cumsum(axis=2)[:, :, :-1]
    lost = hist[:, :, -1:]
    total = hist.sum(axis=2, keepdims=True)
    left = np.stack([sums, sums + lost])
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[:, 0] ** 2 / (left[:, 1] + plan.l2) + right[:, 0] ** 2 / (right[:, 1] + plan.l2) - (total[0] ** 2 / (total[1] + plan.l2))
    fits = (np.minimum(left[:, 2], right[:, 2]) >= max(plan.least_rows, 1)) & (np.minimum(left[:, 1], right[:, 1]) >= LEAST_HESSIAN)
    gain = np.where(fits, gain, -np.inf)
    spot = int(gain.argmax())
    way, feature, cut = np.unravel_index(spot, gain.shape)
    best = gain[way, feature, cut]
    return (float(best), int(feature), int(cut), bool(way)) if np.isfinite(best) and best > 1e-12 else None


Growing = Generator[_Ask, np.ndarray, Any]


def _grow(plan: BoostPlan, early: bool, root: np.ndarray, ahead: bool = True) -> Growing:
    """A tree from the root's sums; asks for the sums of further nodes: of all that may be split, or only of the next one."""
    tree, sums, splits = Tree(), {0: root}, {}
    width, cells = root.shape[1], plan.bins + 1

    def look(node: int) -> None:
        deep = plan.depth is not None and tree.depth[node] >= plan.depth
        splits[node] = None if deep else best_split(sums[node], plan)

    def ends(node: int) -> bool:
        """Whether the children are leaves whatever they hold."""
        count = sums[node][2]
        rows = _side_rows(count, *splits[node][1:])
        larger = max(rows, count[0].sum() - rows)
        return (plan.depth is not None and tree.depth[node] + 1 >= plan.depth) or larger < 2 * max(plan.least_rows, 1)

    look(0)
    children: dict[int, tuple[int, int]] = {}
    # equal gains go by the way from the root, not by when a node was looked at
    way: dict[int, str] = {0: ""}
    while True:
        # take splits in the order of their gains, as far as the sums of both children are known
        heap = [(-splits[0][0], way[0], 0)] if splits[0] else []
        taken, open_ = [], []
        while heap and len(taken) + len(open_) < plan.leaves - 1:
            *_, node = heapq.heappop(heap)
            known = node in children and children[node][0] in sums
            if not known and not ends(node) and (open_ or len(taken) < plan.leaves - 2):
                open_.append(node)
                if not ahead:
                    break
                continue
            taken.append(node)
            for child in children[node] if known else ():
                if splits[child]:
                    heapq.heappush(heap, (-splits[child][0], way[child], child))
        if not open_:
            break
        asked = []
        for node in open_:
            if node not in children:
                _, feature, cut, missing_left = splits[node]
                children[node] = tree.split(node, feature, cut, missing_left)
                way.update(zip(children[node], (way[node] + "0", way[node] + "1")))
            a, b = children[node]
            rows = _side_rows(sums[node][2], *splits[node][1:])
            asked.append((node, a, b) if 2 * rows <= sums[node][2, 0].sum() else (node, b, a))
        found = yield _Ask(plan, early, "sums", tree.packed(), tuple(small for _, small, _ in asked))
        found = found[1:].reshape(len(asked), 3, width, cells)
        for (node, small, large), hist in zip(asked, found):
            sums[small], sums[large] = hist, sums[node] - hist
            look(small)
            look(large)
    return _cut_down(tree, taken, splits, sums, plan)


def _side_rows(count: np.ndarray, feature: int, cut: int, missing_left: bool) -> float:
    return count[feature, : cut + 1].sum() + (count[feature, -1] if missing_left else 0)


def _cut_down(grown: Tree, taken: list[int], splits: dict, sums: dict, plan: BoostPlan) -> Tree:
    """The tree of the taken splits, with the values of its leaves."""
    tree, chosen = Tree(), set(taken)
    waiting = [(0, 0, None)]
    while waiting:
        node, place, total = waiting.pop()
        hist = sums.get(node)
        total = hist[:, 0].sum(axis=1) if hist is not None else total
        if node in chosen:
            _, feature, cut, missing_left = splits[node]
            a, b = tree.split(place, feature, cut, missing_left)
            left = hist[:, feature, : cut + 1].sum(axis=1) + (hist[:, feature, -1] if missing_left else 0)
            known = grown.left[node] != node
            waiting.append((grown.left[node] if known else -1, a, left))
            waiting.append((grown.right[node] if known else -1, b, total - left))
        else:
            tree.value[place] = float(-plan.step * total[0] / (total[1] + plan.l2)) if total[1] + plan.l2 > 0 else 0.0
    return tree


def _train(plan: BoostPlan, rows: int, width: int, ahead: bool = True) -> Growing:
    """One model from its first question to its score on the left-out fold."""
    early = rows > EARLY_ROWS if plan.early is None else plan.early
    n, total = yield _Ask(plan, early, "start")
    mean = total / n if n else 0.0
    start = float(mean) if plan.kind == "reg" else float(np.log(min(max(mean, 1e-9), 1 - 1e-9) / (1 - min(max(mean, 1e-9), 1 - 1e-9))))
    trees: list[Tree] = []
    losses: list[float] = []
    yield start  # tells the driver where the scores begin
    for _ in range(plan.rounds):
        found = yield _Ask(plan, early, "sums", None, (0,))
        losses.append(found[0])
        if early and len(losses) > plan.flat and min(losses[-plan.flat :]) >= losses[-plan.flat - 1] - plan.tol * max(n, 1) / 9:
            break
        tree = yield from _grow(plan, early, found[1:].reshape(3, width, plan.bins + 1), ahead)
        if len(tree.left) == 1 and not tree.value[0]:
            break
        trees.append(tree)
        yield tree
    score = None
    if plan.fold is not None:
        m, e, y, yy = yield _Ask(plan, early, "score")
        spread = yy - y * y / m if m else 0.0
        score = float("nan") if not m else e / m if plan.kind == "clf" else 1 - e / spread if spread else float("nan")
    return start, trees, score


@dataclass(frozen=True)
class Boosted:
    """A fitted model: edges of the bins, the starting score and packed trees."""

    edges: list[list[float]]
    bins: int
    start: float
    trees: list[Tree]
    score: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return next(self.raws(iter([x])))

    def raws(self, portions: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        """Scores of the rows of each portion."""
        edges, trees = [np.array(e) for e in self.edges], [tree.packed() for tree in self.trees]
        for x in portions:
            codes, out = code_rows(x, edges, self.bins), np.full(len(x), self.start)
            for tree in trees:
                add_tree(out, tree, codes, self.bins)
            yield out


def boost(packed: Packed, edges: dict[int, list[list[float]]], plans: list[BoostPlan]) -> list[Boosted]:
    """Fit all plans side by side. ``edges`` holds the bin edges for each number of bins that the plans name."""
    spark_edges = {b: [np.array(e) for e in own] for b, own in edges.items()}
    if packed.blocks == 1 or (packed.rows <= ALONE * BLOCK_ROWS and packed.rows * packed.width <= ALONE_CODES):
        return [Boosted(edges[p.bins], p.bins, *value) for p, value in zip(plans, _all_alone(packed, spark_edges, plans))]
    sizes = sorted(edges)

    def coded(block):
        return block.y, block.fold, block.place, {b: code_rows(block.x, spark_edges[b], b) for b in sizes}, {}

    state: RDD = packed.rdd.map(coded).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [state]
    models = [_train(p, packed.rows, packed.width) for p in plans]
    asks = {i: next(m) for i, m in enumerate(models)}
    pending: dict[int, list] = {}
    starts: dict[int, float] = {}
    done: dict[int, tuple] = {}
    folds = 0
    while asks:
        found = add_up(state, _pass(asks, starts, pending), lambda a, b: {i: a[i] + b[i] for i in a})
        if found is None:  # no rows
            width = packed.width
            found = {i: np.zeros(1 + 3 * width * (a.plan.bins + 1) * max(1, len(a.nodes))) if a.kind == "sums" else np.zeros(4 if a.kind == "score" else 2) for i, a in asks.items()}
        for i, answer in found.items():
            try:
                said = models[i].send(answer)
                while not isinstance(said, _Ask):
                    if isinstance(said, Tree):
                        pending.setdefault(i, []).append(said.packed())
                    else:
                        starts[i] = said
                    said = next(models[i])
                asks[i] = said
            except StopIteration as end:
                done[i] = end.value
                del asks[i]
                pending.pop(i, None)
        if any(len(p) >= PENDING for p in pending.values()):
            state = state.map(_written(dict(pending), dict(starts), {i: plans[i].bins for i in asks}, set(asks))).persist(StorageLevel.MEMORY_AND_DISK)
            folds += 1
            if folds % CHECKPOINT == 0 and state.context.getCheckpointDir():
                state.checkpoint()
            kept.append(state)
            pending = {}
            while len(kept) > 2:
                kept.pop(0).unpersist()
    for rdd in kept:
        rdd.unpersist()
    return [Boosted(edges[p.bins], p.bins, *done[i]) for i, p in enumerate(plans)]


def _raw(i: int, bins: int, block: tuple, start: float, trees: list) -> np.ndarray:
    _, fold, _, codes, raws = block
    raw = raws[i].copy() if i in raws else np.full(len(fold), start)
    for tree in trees:
        add_tree(raw, tree, codes[bins], bins)
    return raw


def _pass(asks: dict[int, _Ask], starts: dict[int, float], pending: dict[int, list]):
    asks, starts, pending = dict(asks), dict(starts), {i: list(p) for i, p in pending.items()}

    def answer(block: tuple) -> dict[int, np.ndarray]:
        y, fold, place, codes, _ = block
        out = {}
        for i, ask in asks.items():
            bins = ask.plan.bins
            raw = _raw(i, bins, block, starts.get(i, 0.0), pending.get(i, []))
            out[i] = _answer(ask, codes[bins], raw, y[:, ask.plan.label], fold, place)
        return out

    return answer


def _written(pending: dict[int, list], starts: dict[int, float], bins: dict[int, int], alive: set[int]):
    def write(block: tuple) -> tuple:
        y, fold, place, codes, raws = block
        made = {i: _raw(i, bins[i], block, starts.get(i, 0.0), pending.get(i, [])) for i in alive}
        return y, fold, place, codes, made

    return write


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed):
    kind = Param(Params._dummy(), "kind", "clf or reg", TypeConverters.toString)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree, 0 for any number", TypeConverters.toInt)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, 255 at most", TypeConverters.toInt)
    leastRows = Param(Params._dummy(), "leastRows", "rows of a leaf at least", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty of leaf values", TypeConverters.toFloat)
    earlyStop = Param(Params._dummy(), "earlyStop", "yes, no or auto", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "probability of class 1, or the prediction", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(kind="reg", maxIter=100, stepSize=0.1, maxDepth=0, maxLeaves=31, maxBins=255, leastRows=20, l2=0.0, earlyStop="auto", scoreCol="score", seed=42)


class HistBoost(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for a number (squared error) or a class 0 / 1 (log loss)."""

    @keyword_only
    def __init__(self, *, kind=None, maxIter=None, stepSize=None, maxDepth=None, maxLeaves=None, maxBins=None, leastRows=None, l2=None, earlyStop=None, seed=None, featuresCol=None, labelCol=None, predictionCol=None, scoreCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def plan(self, **more) -> BoostPlan:
        get = self.getOrDefault
        early = {"yes": True, "no": False, "auto": None}[get("earlyStop")]
        return BoostPlan(
            get("kind"), get("maxIter"), get("stepSize"), get("maxDepth") or None, get("maxLeaves"), min(255, get("maxBins")), get("leastRows"), get("l2"), early, **more
        )

    def _fit(self, dataset: DataFrame) -> HistBoostModel:
        return fit_side_by_side([self], dataset, [self.getOrDefault("labelCol")])[0]


def fit_side_by_side(estimators: list[HistBoost], dataset: DataFrame, labels: list[str], fold: str | None = None, folds: int = 0) -> list:
    """Models of all estimators fitted in common passes; estimator i learns ``labels[i]`` or the only label. With ``fold`` each
    estimator is instead fitted once without each of the ``folds`` and the list holds its scores on them."""
    names = sorted(set(labels))
    rows, columns = vector_columns(dataset, estimators[0].getOrDefault("featuresCol"), names, (fold,) if fold else ())
    packed = pack(rows, columns, names, fold, estimators[0].getOrDefault("seed"), least=BLOCK_ROWS)
    try:
        sizes = {min(255, e.getOrDefault("maxBins")) for e in estimators}
        edges = {b: bin_edges(rows, columns, b) for b in sizes}
        each = [labels[i] if len(labels) > 1 else labels[0] for i in range(len(estimators))]
        if fold:
            plans = [e.plan(label=names.index(y), fold=f) for e, y in zip(estimators, each) for f in range(folds)]
            scores = [b.score for b in boost(packed, edges, plans)]
            return [scores[i * folds : (i + 1) * folds] for i in range(len(estimators))]
        fitted = boost(packed, edges, [e.plan(label=names.index(y)) for e, y in zip(estimators, each)])
    finally:
        packed.free()
    return [e._copyValues(HistBoostModel(state=_to_json(b))) for e, b in zip(estimators, fitted)]


def _to_json(b: Boosted) -> str:
    return json.dumps({"edges": b.edges, "bins": b.bins, "start": b.start, "trees": [vars(t) for t in b.trees]})


def _from_json(text: str) -> Boosted:
    got = json.loads(text)
    return Boosted(got["edges"], got["bins"], got["start"], [Tree(**t) for t in got["trees"]])


def _portions(batches: Iterator[pd.Series], width: int) -> Iterator[np.ndarray]:
    """Rows of several batches together: a tree costs about as much for few rows as for many."""
    held, count = [], 0
    for x in batches:
        held.append(np.array(x.tolist(), np.float64).reshape(len(x), width))
        count += len(x)
        if count >= PREDICTED:
            yield np.concatenate(held)
            held, count = [], 0
    if held:
        yield np.concatenate(held)


class HistBoostModel(Model, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "bins and trees", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def rounds(self) -> int:
        return len(json.loads(self.getOrDefault("state"))["trees"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = _from_json(self.getOrDefault("state"))
        width = len(fitted.edges)

        @F.pandas_udf(T.DoubleType())
        def decide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return map(pd.Series, fitted.raws(_portions(batches, width)))

        raw = decide(vector_to_array(self.getOrDefault("featuresCol")))
        out = dataset.withColumn(self.getOrDefault("scoreCol"), raw)
        score = F.col(self.getOrDefault("scoreCol"))
        if self.getOrDefault("kind") == "reg":
            return out.withColumn(self.getOrDefault("predictionCol"), score)
        out = out.withColumn(self.getOrDefault("predictionCol"), (score > 0).cast("double"))
        return out.withColumn(self.getOrDefault("scoreCol"), 1 / (1 + F.exp(-score)))


__all__ = ["BoostPlan", "Boosted", "HistBoost", "HistBoostModel", "best_split", "bin_edges", "boost", "fit_side_by_side"]
