"""Random forests of trees grown until their leaves are pure, without a limit of depth.

While a node of a tree holds more rows than one task should, it is split on quantile bins whose sums come from passes over the
matrix blocks, all trees side by side. The sums are added, and the splits found, in tasks that share the nodes; only splits come to the driver. The rows of each remaining (tree, node), now few enough, go to one task, which grows the
node on exact values to purity, level by level. Pieces of trees stay in a table of the shared folder, as a forest of that kind is as long as its
training table; to predict, rows are led through the upper levels and meet the pieces they belong to.

A split is the one that lowers the weighted variance of the label most; for a label of 0 and 1 that is the Gini rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.ml.blocks import Block, Packed, pack, vector_columns
from tarmac.ml.boosting import BoostPlan, Tree, _exact, best_split, bin_edges, code_rows, leaf_of
from tarmac.plans.storage import materialize

#: Rows of a node that one task may hold, bytes of their features, and bins of the upper levels.
NODE_ROWS, NODE_BYTES, BINS = 1 << 18, 64 << 20, 255
#: Bytes of the sums of nodes that a task holds at a time.
SUM_BYTES = 64 << 20
#: Rows whose sums are made by one task, if there are more tasks than cores.
SUMMED_ROWS = 1 << 22
#: Rows that are led through the upper levels together.
SENT_ROWS = 1 << 16


@dataclass(frozen=True)
class ForestPlan:
    kind: str = "clf"
    trees: int = 100
    #: Features looked at for a split; None is the root of their number for classes and all of them for numbers.
    features: int | None = None
    bootstrap: bool = True
    seed: int = 42

    def tried(self, width: int) -> int:
        return self.features or (max(1, int(width**0.5)) if self.kind == "clf" else width)


def _weights(plan: ForestPlan, tree: int, block: Block) -> np.ndarray:
    """How often each row of a block counts for a tree: as in drawing with replacement, independent for each row."""
    if not plan.bootstrap:
        return np.ones(len(block.x), np.int64)
    return np.random.default_rng([plan.seed, tree, block.number]).poisson(1.0, len(block.x))


def _chosen(plan: ForestPlan, tree: int, node: int, width: int) -> np.ndarray:
    return np.random.default_rng([plan.seed, 1 + tree, node]).permutation(width)[: plan.tried(width)]


@dataclass
class _Top:
    """Upper levels of a tree, with the rows and splits of its nodes."""

    tree: Tree = field(default_factory=Tree)
    rows: dict[int, float] = field(default_factory=dict)
    closed: set[int] = field(default_factory=set)
    gains: dict[int, float] = field(default_factory=dict)


def _node_sums(plan: ForestPlan, asked: dict[int, tuple[tuple, tuple[int, ...]]], edges: list[np.ndarray], unit: float, whole: bool):
    """((tree, node), sums of labels and rows per bin of the features that the node looks at, or of all) of the rows of a partition, one
    tree after the other. Labels are taken as multiples of ``unit``, whose sums are exact in any order."""

    def sums(blocks: Iterator[Block]) -> Iterator[tuple]:
        held = list(blocks)
        if not held:
            return
        codes, y, cells = np.concatenate([code_rows(block.x, edges, BINS) for block in held], axis=1), np.concatenate([block.y[:, 0] for block in held]), BINS + 1
        _exact(y, unit)
        for tree, (packed, nodes) in asked.items():
            places = np.full(len(packed[0]), -1, np.intp)
            places[list(nodes)] = np.arange(len(nodes))
            w = np.concatenate([_weights(plan, tree, block) for block in held])
            slot = places.take(leaf_of(packed, codes, BINS))
            own = np.flatnonzero((slot >= 0) & (w > 0))
            slot, w = slot.take(own) * cells, w.take(own).astype(float)
            wy, found = w * y.take(own), np.zeros((2, len(edges), len(nodes) * cells))
            for f in range(len(codes)):
                cell = slot + codes[f].take(own)
                found[0, f], found[1, f] = (np.bincount(cell, v, len(nodes) * cells) for v in (wy, w))
            for node, part in zip(nodes, found.reshape(2, len(edges), len(nodes), cells).transpose(2, 0, 1, 3)):
                yield (tree, node), np.concatenate([part[:, f, : len(edges[f]) + 1] for f in _looked_at(plan, tree, node, len(edges), whole)], axis=1)

    return sums


def _looked_at(plan: ForestPlan, tree: int, node: int, width: int, whole: bool) -> np.ndarray:
    return np.arange(width) if whole else np.sort(_chosen(plan, tree, node, width))


def _best(plan: ForestPlan, group: tuple, edges: list[np.ndarray], whole: bool) -> tuple:
    """((tree, node), its best split with the rows of both sides, or None) from the sums of all partitions."""
    (tree, node), parts = group
    hist, at, summed = np.zeros((3, len(edges), BINS + 1)), 0, sum(parts)
    for f in _looked_at(plan, tree, node, len(edges), whole):
        cells = len(edges[f]) + 1
        hist[0, f, :cells], hist[1, f, :cells] = summed[:, at : at + cells]
        at += cells
    hist[2] = hist[1]
    best = best_split(hist, BoostPlan(bins=BINS, least_rows=1))
    if best is None:
        return (tree, node), None
    _, feature, cut, _ = best
    left = float(hist[2, feature, : cut + 1].sum())
    return (tree, node), (*best, left, float(hist[2, feature].sum() - left))


def _splits(packed: Packed, plan: ForestPlan, asked: dict, edges: list[np.ndarray], unit: float, whole: bool) -> list[tuple]:
    """Best splits of the nodes asked for. Neighbouring partitions are summed by one task, and a node by one; the driver gets splits, not sums."""
    parts = max(1, min(packed.rdd.getNumPartitions(), max(packed.rdd.context.defaultParallelism, -(-packed.rows // SUMMED_ROWS))))
    out = []
    for portion in _portions(asked, packed.width):
        place = {key: i for i, key in enumerate((t, n) for t, (_, nodes) in portion.items() for n in nodes)}
        sums = packed.rdd.coalesce(parts).mapPartitions(_node_sums(plan, portion, edges, unit, whole))
        out += sums.groupByKey(parts, lambda key, place=place: place[key] % parts).map(lambda group: _best(plan, group, edges, whole)).collect()
    return sorted(out, key=lambda found: found[0])


def _portions(asked: dict[int, tuple[tuple, tuple[int, ...]]], width: int) -> Iterator[dict]:
    """Trees whose sums take about ``SUM_BYTES`` in a task, at least one at a time."""
    portion, nodes = {}, 0
    for tree, own in asked.items():
        if portion and (nodes + len(own[1])) * 2 * width * (BINS + 1) * 8 > SUM_BYTES:
            yield portion
            portion, nodes = {}, 0
        portion[tree] = own
        nodes += len(own[1])
    if portion:
        yield portion


def _tops(packed: Packed, plan: ForestPlan, edges: list[np.ndarray], most: int) -> list[_Top]:
    """Upper levels of all trees, split until no open node holds more than ``most`` rows."""
    largest = packed.rdd.map(lambda block: float(np.abs(block.y).max())).max()
    unit = 2.0 ** (np.ceil(np.log2(max(largest, 1e-300))) + np.ceil(np.log2(packed.rows + 1)) + 4 - 52)
    tops = [_Top(rows={0: float(packed.rows) * (1 if not plan.bootstrap else 1.01)}) for _ in range(plan.trees)]
    while True:
        asked = {}
        for t, top in enumerate(tops):
            nodes = tuple(n for n, rows in top.rows.items() if rows > most and top.tree.left[n] == n and n not in top.closed)
            if nodes:
                asked[t] = (top.tree.packed(), nodes)
        if not asked:
            return tops
        found = dict(_splits(packed, plan, asked, edges, unit, packed.width == plan.tried(packed.width)))
        none: dict[int, list[int]] = {}
        for t, node in (key for key, best in found.items() if best is None):
            none.setdefault(t, []).append(node)
        if plan.tried(packed.width) < packed.width and none:
            # the features looked at have one value in these nodes
            found.update(_splits(packed, plan, {t: (asked[t][0], tuple(nodes)) for t, nodes in none.items()}, edges, unit, True))
        for (t, node), best in found.items():
            top = tops[t]
            if best is None:
                # every value of the node falls into one bin, or one label is left: it is grown as it is
                top.closed.add(node)
                continue
            gain, feature, cut, missing_left, *rows = best
            top.gains[feature] = top.gains.get(feature, 0.0) + gain
            top.rows.update(zip(top.tree.split(node, feature, cut, missing_left), rows))


def _best_cuts(columns: np.ndarray, orders: np.ndarray, sizes: np.ndarray, wy: np.ndarray, w: np.ndarray, tried: int, rng: np.random.Generator) -> tuple:
    """(feature or -1, cut, gain) of the best split of each node; ``sizes`` are its rows, which follow each other in the order of every feature.

    A node looks at ``tried`` random features at a time, until one of them has two values. Equal gains go to the feature looked at first.
    """
    width, nodes = len(columns), len(sizes)
    rank = rng.random((nodes, width)).argsort(axis=1).argsort(axis=1)
    feature, cut, gained = np.full(nodes, -1), np.zeros(nodes), np.full(nodes, -np.inf)
    for begin in range(0, width, tried):
        open_ = feature < 0
        if not open_.any():
            break
        for f in range(width):
            looks = open_ & (rank[:, f] >= begin) & (rank[:, f] < begin + tried)
            own = np.flatnonzero(looks)
            if not len(own):
                continue
            size = sizes[own]
            rows = orders[f] if len(own) == nodes else orders[f].compress(looks.repeat(sizes))
            ends, x = size.cumsum(), columns[f].take(rows)
            h, g = w.take(rows).cumsum(), wy.take(rows).cumsum()
            before = [np.concatenate([[0.0], v[ends[:-1] - 1]]) for v in (h, g)]
            weight, total = h[ends - 1] - before[0], g[ends - 1] - before[1]
            # a cut follows the last row of a value that is not the last of the node
            last = np.flatnonzero(x[1:] > x[:-1])
            node = np.arange(len(own)).repeat(size)[last]
            inside = last + 1 < ends[node]
            last, node = last.compress(inside), node.compress(inside)
            if not len(last):
                continue
            h, g = h[last] - before[0][node], g[last] - before[1][node]
            gain = g * g / h + (total[node] - g) ** 2 / (weight[node] - h) - (total * total / weight)[node]
            heads = np.flatnonzero(np.diff(node, prepend=-1))
            top = np.maximum.reduceat(gain, heads)
            hit = np.flatnonzero(gain == top.repeat(np.diff(heads, append=len(node))))
            hit = hit[np.flatnonzero(np.diff(node[hit], prepend=-1))]
            mine = own[node[hit]]
            better = (top > gained[mine]) | ((top == gained[mine]) & (rank[mine, f] < rank[mine, feature[mine]]))
            mine, at = mine[better], last[hit[better]]
            low, high = x[at], x[at + 1]
            middle = low + (high - low) / 2
            feature[mine], cut[mine], gained[mine] = f, np.where(middle < high, middle, low), top[better]
    return feature, cut, gained


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, tried: int, rng: np.random.Generator) -> tuple:
    """(feature, cut, left, right, value, gain by feature) of a tree with pure leaves; a leaf points at itself.

    All open nodes of a level are split at once. Rows are sorted by each feature once; a split only parts each order in two.
    """
    columns, wy = np.ascontiguousarray(x.T), w * y
    orders = columns.argsort(axis=1, kind="stable")
    gains = np.zeros(len(columns))

    def measured(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean label of each node, and whether it is to be split."""
        starts = sizes.cumsum() - sizes
        weight, total = (np.add.reduceat(v[rows], starts) for v in (w, wy))
        mixed = np.minimum.reduceat(y[rows], starts) < np.maximum.reduceat(y[rows], starts)
        return np.divide(total, weight, out=np.zeros(len(sizes)), where=weight != 0), mixed

    sizes, number, made = np.array([len(x)]), np.array([0]), 1
    mean, mixed = measured(orders[0], sizes)
    levels = [(number, np.array([0]), np.array([0.0]), number, number, mean)]
    if not mixed[0]:
        sizes = sizes[:0]
    while len(sizes):
        feature, cut, gained = _best_cuts(columns, orders, sizes, wy, w, tried, rng)
        split = feature >= 0
        if not split.any():
            break
        if not split.all():
            orders = orders.take(np.flatnonzero(split.repeat(sizes)), axis=1)
            sizes, number, feature, cut, gained = (v[split] for v in (sizes, number, feature, cut, gained))
        gains += np.bincount(feature, np.maximum(gained, 0.0), len(columns))
        # rows that go left, and the places of both sides in the orders of the next level
        rows, goes = orders[0], np.empty(len(x), bool)
        goes[rows] = columns[feature.repeat(sizes), rows] <= cut.repeat(sizes)
        starts = sizes.cumsum() - sizes
        lefts = np.add.reduceat(goes[rows].astype(np.intp), starts)
        rights = sizes - lefts
        to_left = np.arange(lefts.sum()) + (starts - (lefts.cumsum() - lefts)).repeat(lefts)
        to_right = np.arange(rights.sum()) + (starts + lefts - (rights.cumsum() - rights)).repeat(rights)
        parted = np.empty_like(orders)
        for order, place in zip(orders, parted):
            left = goes.take(order)
            place[to_left], place[to_right] = order.compress(left), order.compress(~left)
        sizes, children = np.stack([lefts, rights], axis=1).ravel(), made + np.arange(2 * len(sizes))
        mean, mixed = measured(parted[0], sizes)
        levels.append((children, np.zeros(len(children), int), np.zeros(len(children)), children, children, mean))
        levels.append((number, feature, cut, children[::2], children[1::2], None))
        made += len(children)
        orders = parted if mixed.all() else parted.take(np.flatnonzero(mixed.repeat(sizes)), axis=1)
        sizes, number = sizes[mixed], children[mixed]
    out = np.zeros(made, np.int32), np.zeros(made), np.zeros(made, np.int32), np.zeros(made, np.int32), np.zeros(made)
    for place, *values in levels:
        for column, value in zip(out, values):
            if value is not None:
                column[place] = value
    return *out, gains


def predict(piece: tuple, x: np.ndarray) -> np.ndarray:
    feature, cut, left, right, value = piece
    node, rows = np.zeros(len(x), np.intp), np.arange(len(x))
    while len(rows):
        inner = left[node[rows]] != node[rows]
        rows = rows[inner]
        at = node[rows]
        node[rows] = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
    return value[node]


_PIECE = "tree int, node int, feature binary, cut binary, left_ binary, right_ binary, value binary, gains binary"


def fit_forest(dataset: DataFrame, plan: ForestPlan, label: str = "label", features_col: str = "features", node_rows: int = NODE_ROWS) -> ForestModel:
    """Forest over a features vector without missing values and a numeric label (0 or 1 for classes)."""
    rows, columns = vector_columns(dataset, features_col, [label])
    packed = pack(rows, columns, [label], seed=plan.seed)
    edges = bin_edges(rows, columns, BINS)
    arrays = [np.array(e) for e in edges]
    try:
        tops = _tops(packed, plan, arrays, min(node_rows, NODE_BYTES // (8 * packed.width)))
        trees = [t.tree.packed() for t in tops]

        def dealt(block: Block) -> Iterator[tuple]:
            codes = code_rows(block.x, arrays, BINS) if any(len(t[0]) > 1 for t in trees) else None
            for number, tree in enumerate(trees):
                w = _weights(plan, number, block)
                node = leaf_of(tree, codes, BINS) if len(tree[0]) > 1 else np.zeros(len(w), np.intp)
                for n in np.unique(node[w > 0]):
                    own = np.flatnonzero((node == n) & (w > 0))
                    yield (number, int(n)), (block.number, block.x[own], block.y[own, 0], w[own].astype(float))

        def grown(group: tuple) -> tuple:
            (number, node), parts = group
            parts = sorted(parts, key=lambda p: p[0])
            x, y, w = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            made = grow(x, y, w, plan.tried(x.shape[1]), np.random.default_rng([plan.seed, number, node, 7]))
            return (number, node, *[bytearray(a.tobytes()) for a in made])

        tasks = max(packed.blocks, min(1024, sum(sum(1 for i, c in enumerate(t[3]) if c == i) for t in trees)))
        pieces = packed.rdd.flatMap(dealt).groupByKey(tasks, lambda key: hash_place(key, len(trees))).map(grown)
        table = materialize(dataset.sparkSession.createDataFrame(pieces, _PIECE), "forest")
    finally:
        packed.free()
    return ForestModel(plan, columns, edges, trees, [t.gains for t in tops], table, features_col)


def hash_place(key: tuple[int, int], trees: int) -> int:
    """Partition of a (tree, node): trees in turn, the same in every task."""
    return key[0] + key[1] * trees


def _gathered(batches: Iterator[pd.DataFrame], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their ids, many at a time: a piece of a tree is sent once for each of these portions."""
    held, count = [], 0
    for batch in batches:
        if len(batch):
            held.append((np.array(batch["x"].tolist(), np.float64).reshape(len(batch), width), batch["_fid"].to_numpy()))
            count += len(batch)
        if count >= SENT_ROWS:
            yield tuple(np.concatenate(part) for part in zip(*held))
            held, count = [], 0
    if held:
        yield tuple(np.concatenate(part) for part in zip(*held))


@dataclass
class ForestModel:
    plan: ForestPlan
    columns: list[str]
    edges: list[list[float]]
    tops: list[tuple]
    top_gains: list[dict[int, float]]
    pieces: DataFrame
    features_col: str = "features"

    @property
    def importances(self) -> np.ndarray:
        """Share of each feature in the gains of a tree, averaged over the trees."""
        width = len(self.columns)

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                gains = np.stack([np.frombuffer(g) for g in batch["gains"]]) if len(batch) else np.zeros((0, width))
                yield pd.DataFrame({"tree": np.repeat(batch["tree"].to_numpy(), width), "f": np.tile(np.arange(width), len(batch)), "g": gains.ravel()})

        found = self.pieces.select("tree", "gains").mapInPandas(add, "tree int, f int, g double").groupBy("tree", "f").agg(F.sum("g").alias("g")).collect()
        total = np.zeros((len(self.tops), width))
        for t, gains in enumerate(self.top_gains):
            for f, g in gains.items():
                total[t, f] += g
        for r in found:  # trees x features numbers
            total[r["tree"], r["f"]] += r["g"]
        sums = total.sum(axis=1, keepdims=True)
        shares = np.where(sums > 0, total / np.where(sums > 0, sums, 1), 0.0).mean(axis=0)
        return shares / shares.sum() if shares.sum() else shares

    def transform(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with the mean of the trees as ``score``, and ``prediction``: the score, or the likelier class."""
        from pyspark.ml.functions import vector_to_array

        rows = materialize(dataset.withColumn("_fid", F.monotonically_increasing_id()), "forest-rows")
        trees, arrays, width = self.tops, [np.array(e) for e in self.edges], len(self.columns)

        def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x, ids in _gathered(batches, width):
                codes = code_rows(x, arrays, BINS)
                for number, tree in enumerate(trees):
                    node = leaf_of(tree, codes, BINS)
                    found = []
                    for n in np.unique(node):
                        own = np.flatnonzero(node == n)
                        found.append((number, int(n), ids[own].tobytes(), np.ascontiguousarray(x[own]).tobytes()))
                    yield pd.DataFrame(found, columns=["tree", "node", "ids", "x"])

        sent = rows.select("_fid", vector_to_array(self.features_col).alias("x")).mapInPandas(routed, "tree int, node int, ids binary, x binary")

        def answered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples():
                    ids = np.frombuffer(r.ids, np.int64)
                    piece = (np.frombuffer(r.feature, np.int32), np.frombuffer(r.cut), np.frombuffer(r.left_, np.int32), np.frombuffer(r.right_, np.int32), np.frombuffer(r.value))
                    yield pd.DataFrame({"_fid": ids, "v": predict(piece, np.frombuffer(r.x).reshape(len(ids), width))})

        met = sent.join(self.pieces.drop("gains"), ["tree", "node"]).select("ids", "x", "feature", "cut", "left_", "right_", "value")
        scores = met.mapInPandas(answered, "_fid long, v double").groupBy("_fid").agg((F.sum("v") / len(trees)).alias("score"))
        out = rows.join(scores, "_fid").drop("_fid")
        return out.withColumn("prediction", F.col("score") if self.plan.kind == "reg" else (F.col("score") > 0.5).cast("double"))
