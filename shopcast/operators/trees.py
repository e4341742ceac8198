"""Forests and boosted trees for regression, grown from blocks of bin numbers
(T3-T5).

Drop-in estimators with MLlib's parameters; what they return is MLlib's own
model, so scoring, importances and saving stay as they are.  The method is
MLlib's: up to ``maxBins`` quantile bins a feature, trees grown level by
level, the split of largest variance reduction among a node's features,
Poisson weights for forests, shares drawn without replacement for boosting,
pseudo-residuals of the squared loss.

MLlib keeps an object with an array of bins, and for forests one weight a
tree, for each row.  Here a partition holds blocks of rows as NumPy arrays:
a byte for each column of bins (features of few bins share a column) and the
label.  Weights are drawn again from (seed, tree, block) in each pass, rows
find their node by walking the tree, and only histograms leave a task.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import regression as ML
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.session import run_dir, workers_ready

col = F.col

# Most rows of a block, least and most rows of a partition, and
# bytes that a pass sends to the driver at most (more are added up by a shuffle).
BLOCK_ROWS = 1 << 16
TASK_ROWS = (1 << 18, 1 << 21)
DRIVER_BYTES = 32 << 20
#: A boosted run derives its residuals from the first blocks again after so many rounds, so lineage stays short.
REBASE = 20
#: Values of a column of bins, and of one that features of few bins share.
WIDTH, SHARED = 256, 128


def find_thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's split candidates of a sampled feature: midpoints between
    distinct values, all or those next to equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    mid = (distinct[:-1] + distinct[1:]) / 2.0
    if len(mid) <= bins - 1:
        return mid
    stride = len(values) / bins
    out, seen, target = [], counts[0], stride
    for i in range(1, len(distinct)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


class Layout:
    """Where a feature's bins are: its column, and within the column's value
    its stride and size; ``start`` is its first cell in a node's row of
    cells, one cell for each bin of each feature."""

    def __init__(self, thresholds: list[np.ndarray]):
        self.thresholds = thresholds
        self.size = np.array([len(t) + 1 for t in thresholds], dtype=np.intp)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.intp)
        self.cells = int(self.size.sum())
        self.column, self.stride = (np.zeros(len(thresholds), dtype=np.intp) for _ in range(2))
        self.widths: list[int] = []
        for f in np.argsort(self.size, kind="stable"):
            if not self.widths or self.widths[-1] * self.size[f] > SHARED:
                self.widths.append(1)
            self.column[f], self.stride[f] = len(self.widths) - 1, self.widths[-1]
            self.widths[-1] *= int(self.size[f])

    def encode(self, x: np.ndarray) -> np.ndarray:
        """(columns, rows) of bytes; a value on a threshold stays left."""
        out = np.zeros((len(self.widths), len(x)), dtype=np.uint8)
        for f, t in enumerate(self.thresholds):
            out[self.column[f]] += (np.searchsorted(t, x[:, f], side="left") * self.stride[f]).astype(np.uint8)
        return out

    def by_feature(self, sums: dict, nodes: int) -> np.ndarray:
        """(nodes, cells) from the sums by column value; 0 where a column is not there."""
        out = np.zeros((nodes, self.cells))
        for c, start, size, stride in zip(self.column, self.start, self.size, self.stride):
            if c in sums:
                out[:, start:start + size] = sums[c].reshape(nodes, -1, size, stride).sum(axis=(1, 3))
        return out


def to_blocks(data: DataFrame, layout: Layout, rows: int, partitions: int):
    """RDD of (key, bins, target): blocks of at most ``rows`` rows, dealt out
    evenly.  ``data`` has the features as an array and the label."""
    width = len(layout.thresholds)

    def encode(batches):
        part, k, held, n = TaskContext.get().partitionId(), 0, [], 0

        def block(x, y):
            return pa.record_batch([pa.array([part]), pa.array([k]), pa.array([layout.encode(x).tobytes()], pa.binary()),
                                    pa.array([y.tobytes()], pa.binary())], names=["part", "k", "bins", "label"])
        for b in batches:
            x = np.asarray(b.column(0).flatten()).reshape(-1, width)
            held.append((x, np.asarray(b.column(1))))
            n += len(x)
            while n >= rows:
                x, y = (np.concatenate(z) for z in zip(*held))
                yield block(x[:rows], y[:rows])
                held, n, k = [(x[rows:], y[rows:])], n - rows, k + 1
        if n:
            yield block(*(np.concatenate(z) for z in zip(*held)))

    columns = len(layout.widths)
    coded = data.mapInArrow(encode, "part long, k long, bins binary, label binary").repartition(partitions)
    return coded.rdd.map(lambda r: ((r.part, r.k), np.frombuffer(r.bins, np.uint8).reshape(columns, -1),
                                    np.frombuffer(r.label, np.float64)))


class Tree:
    """A tree under construction: parallel lists by node.  ``child`` is the
    left child, the right one follows it; 0 at a leaf."""

    def __init__(self):
        self.child, self.feature, self.split, self.gain = [0], [0], [0], [-1.0]
        self.stats = [None]                   # weight, sum, sum of squares
        self.open = [0]                       # nodes of the deepest level that may be split
        # of the level above, if known: sums by cell, totals; which of its nodes the pairs
        # in ``open`` come from, and the lighter side of each pair
        self.held, self.parents, self.lighter = None, [], []

    def extend(self, found: dict, last: bool) -> None:
        """Apply what a pass has found for the open nodes."""
        opened = []
        self.held, self.parents, self.lighter = found.get("held"), [], []
        for i, node in enumerate(self.open):
            self.stats[node] = found["total"][i]
            if not found["ok"][i]:
                continue
            left = len(self.child)
            self.parents.append(i)
            self.lighter.append(int(2 * found["left"][i][0] > found["total"][i][0]))
            self.child[node], self.gain[node] = left, float(found["gain"][i])
            self.feature[node], self.split[node] = int(found["feature"][i]), int(found["split"][i])
            for side in (found["left"][i], found["total"][i] - found["left"][i]):
                self.child.append(0), self.feature.append(0), self.split.append(0), self.gain.append(-1.0)
                self.stats.append(side)
                opened.append(len(self.child) - 1)
        self.open = [] if last else opened

    def predictions(self) -> np.ndarray:
        return np.array([s[1] / s[0] if s[0] else 0.0 for s in self.stats])

    def walker(self, layout: Layout):
        """Function (bins, rows) -> node of each of these rows."""
        child, f = np.array(self.child, dtype=np.intp), np.array(self.feature, dtype=np.intp)
        at = np.arange(WIDTH)
        right = (at // layout.stride[f][:, None]) % layout.size[f][:, None] > np.array(self.split)[:, None]
        leaf = child == 0
        right[leaf], child = False, np.where(leaf, np.arange(len(child)), child)
        after = (child[:, None] + right).reshape(-1)        # the next node by node and column value
        column, levels = layout.column[f], self.depth()

        def walk(bins, rows):
            flat, start, node = bins.reshape(-1), column * bins.shape[1], np.zeros(len(rows), dtype=np.intp)
            for _ in range(levels):
                at = start.take(node)
                at += rows
                node <<= 8
                node += flat.take(at)
                node = after.take(node)
            return node
        return walk

    def levels(self) -> list[int]:
        """The level of each node; nodes come level by level."""
        deep = [0] * len(self.child)
        for i, c in enumerate(self.child):
            if c:
                deep[c] = deep[c + 1] = deep[i] + 1
        return deep

    def depth(self) -> int:
        return max(self.levels())

    def cut(self, depth: int) -> Tree:
        """The tree as it is if grown no further than ``depth``."""
        out, deep = Tree(), self.levels()
        n = sum(x <= depth for x in deep)
        out.child = [c if d < depth else 0 for c, d in zip(self.child[:n], deep)]
        out.feature, out.split, out.gain, out.stats = self.feature[:n], self.split[:n], self.gain[:n], self.stats[:n]
        return out


def drawn(rate: float, replacement: bool) -> np.ndarray | None:
    """The weight of a row by a drawn 16-bit number; None if all weigh 1."""
    if not replacement and rate >= 1.0:
        return None
    at = (np.arange(1 << 16) + 0.5) / (1 << 16)
    if not replacement:
        return (at < rate).astype(np.uint8)
    p = np.exp(-rate) * np.cumprod(np.concatenate([[1.0], rate / np.arange(1, 60)]))
    return np.searchsorted(np.cumsum(p), at).astype(np.uint8)


def chosen_cells(layout: Layout, nodes: int, count: int, seed) -> np.ndarray:
    """(nodes, cells): the cells of the ``count`` features drawn for each node."""
    n = len(layout.size)
    if count >= n:
        return np.ones((nodes, layout.cells), dtype=bool)
    rank = np.random.default_rng(seed).random((nodes, n)).argsort(axis=1).argsort(axis=1)
    return np.repeat(rank < count, layout.size, axis=1)


def unpacked(parts: list[np.ndarray], layout: Layout, mask: np.ndarray, squares: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums by (moment, node, cell) and by (moment, node) from the flat sums
    of all partitions; the squares by cell are 0 if not sent."""
    nodes, kept = len(mask), int(mask.sum())
    flat = np.sum(parts, axis=0)
    sums = np.zeros((3, nodes, layout.cells))
    for i in range(3 if squares else 2):
        sums[i][mask] = flat[i * kept:(i + 1) * kept]
    return sums, flat[-3 * nodes:].reshape(3, nodes)


def with_siblings(sums: np.ndarray, total: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """The sums of both nodes of each pair from those of the lighter one and
    of the node above.  Weights are whole numbers, so an empty cell is known
    to be empty."""
    above, above_total = (x[:, tree.parents] for x in tree.held)
    rest, light = above - sums, np.array(tree.lighter)
    rest[1:, rest[0] == 0] = 0.0
    pairs, heads = np.empty((3, 2 * len(light), sums.shape[2])), np.empty((3, 2 * len(light)))
    at = 2 * np.arange(len(light))
    pairs[:, at + light], pairs[:, at + 1 - light] = sums, rest
    heads[:, at + light], heads[:, at + 1 - light] = total, above_total - total
    return pairs, heads


def best_splits(sums: np.ndarray, total: np.ndarray, layout: Layout, mask: np.ndarray, s: dict) -> dict:
    """Of the open nodes of one tree."""
    nodes = len(mask)
    left = np.zeros((3, nodes, layout.cells))
    for start, size in zip(layout.start, layout.size):
        left[:, :, start:start + size] = np.cumsum(sums[:, :, start:start + size], axis=2)
    n, t = total[0][:, None], total[1][:, None]
    with np.errstate(all="ignore"):
        ln, rn = left[0], n - left[0]
        gain = ln * rn / (n * n) * np.square(left[1] / ln - (t - left[1]) / rn)
        impure = (total[2] - total[1] ** 2 / total[0]) / total[0] > np.finfo(float).eps
    ends = np.zeros(layout.cells, dtype=bool)
    ends[layout.start + layout.size - 1] = True             # the last bin is no split
    least = max(s["least"], 1)
    gain[~mask | ends | (ln < least) | (rn < least) | ~np.isfinite(gain)] = -1.0
    best = gain.argmax(axis=1)
    top = gain[np.arange(nodes), best]
    feature = np.searchsorted(layout.start, best, side="right") - 1
    return {"total": total.T, "ok": impure & (top > 0) & (top >= s["min_gain"]), "gain": top, "feature": feature,
            "split": best - layout.start[feature], "left": left[:, np.arange(nodes), best].T}


def one_pass(blocks, partitions: int, layout: Layout, level: int, work: dict, last: bool, s: dict) -> dict:
    """Best splits of the open nodes of the trees of ``work`` (by number)."""
    table, seed, take = drawn(s["rate"], s["replacement"]), s["seed"], s["take"]
    size = sum(8 * (3 if last else 2) * len(t.open) * layout.cells for t in work.values()) * take / len(layout.size)
    on_driver, whole = size * partitions <= DRIVER_BYTES, take >= len(layout.size)
    # one node of a pair is what its sibling leaves of the node above
    halves = on_driver and whole and not last and all(t.held is not None for t in work.values())
    nodes = {k: [t.open[2 * i + side] for i, side in enumerate(t.lighter)] if halves else t.open for k, t in work.items()}

    def mask(number, count):
        return chosen_cells(layout, count, take, [seed, number, level, 1])

    def sums(part, held):
        walks, slots, acc, masks = {}, {}, {}, {}
        for number, tree in work.items():
            own = nodes[number]
            masks[number] = mask(number, len(own))
            read = sorted({int(layout.column[f]) for f in np.flatnonzero(masks[number].any(axis=0)[layout.start])})
            walks[number] = tree.walker(layout)
            slots[number] = np.full(len(tree.child), -1, dtype=np.intp)
            slots[number][own] = np.arange(len(own))
            acc[number] = ([{c: np.zeros(len(own) * layout.widths[c]) for c in read} for _ in range(3 if last else 2)],
                           np.zeros((3, len(own))))
        for key, bins, target in held:
            for number in work:
                if table is None:
                    rows, weight = np.arange(len(target)), np.ones(len(target))
                else:
                    draw = table[np.random.default_rng([seed, number, *key]).integers(0, 1 << 16, len(target), dtype=np.uint16)]
                    rows = np.flatnonzero(draw)
                    weight = draw.take(rows).astype(np.float64)
                slot = slots[number].take(walks[number](bins, rows))
                if (slot < 0).any():
                    on = np.flatnonzero(slot >= 0)
                    rows, weight, slot = rows.take(on), weight.take(on), slot.take(on)
                first = weight * target.take(rows)
                moments = [weight, first, first * target.take(rows)]
                cells, total = acc[number]
                for i, m in enumerate(moments):
                    total[i] += np.bincount(slot, m, total.shape[1])
                for c in cells[0]:
                    at = slot * layout.widths[c]
                    at += bins[c].take(rows)
                    for i in range(len(cells)):
                        cells[i][c] += np.bincount(at, moments[i], len(cells[i][c]))
        for number, (cells, total) in acc.items():
            flat = [layout.by_feature(x, total.shape[1])[masks[number]] for x in cells]
            yield number, (part, np.concatenate([*flat, total.reshape(-1)]))

    def best(parts_of):
        for number, parts in parts_of.items():
            own = [x for _, x in sorted(parts, key=lambda p: p[0])]
            sums, total = unpacked(own, layout, mask(number, len(nodes[number])), last)
            if halves:
                sums, total = with_siblings(sums, total, work[number])
            found = best_splits(sums, total, layout, mask(number, total.shape[1]), s)
            yield number, found | ({"held": (sums, total)} if on_driver and whole and not last else {})

    def gathered(pairs):
        out: dict = {}
        for number, x in pairs:
            out.setdefault(number, []).append(x)
        return best(out)

    made = blocks.mapPartitionsWithIndex(sums)
    if on_driver:
        return dict(gathered(made.collect()))
    return dict(made.partitionBy(min(partitions, len(work)), int).mapPartitions(gathered).collect())


def grow(blocks, partitions: int, layout: Layout, numbers, s: dict) -> list[Tree]:
    """Trees of these numbers, level by level, as many at a time as their
    sums fit ``s["bytes"]`` in a task."""
    trees = {k: Tree() for k in numbers}
    for level in range(s["depth"]):
        last, waiting = level == s["depth"] - 1, [k for k, t in trees.items() if t.open]
        while waiting:
            work, size = {}, 0
            while waiting:
                size += len(trees[waiting[0]].open) * sum(layout.widths) * 24
                if work and size > s["bytes"]:
                    break
                k = waiting.pop(0)
                work[k] = trees[k]
            for k, found in one_pass(blocks, partitions, layout, level, work, last, s).items():
                trees[k].extend(found, last)
    return list(trees.values())


def boosted(blocks, partitions: int, layout: Layout, rounds: int, step: float, s: dict) -> list[Tree]:
    """MLlib's boosting of the squared loss: the first tree on the labels
    with weight 1, each next one on twice the rest with weight ``step``."""
    trees: list[Tree] = []

    def advanced(since, first, new):
        walks = [(t.walker(layout), t.predictions()) for t in new]

        def on(held):
            for key, bins, target in held:
                rows = np.arange(len(target))
                for i, (walk, value) in enumerate(walks, first):
                    own = value.take(walk(bins, rows))
                    target = 2.0 * (target - own) if i == 0 else target - 2.0 * step * own
                yield key, bins, target
        return since.mapPartitions(on).persist(StorageLevel.MEMORY_AND_DISK)

    now, before = blocks, None
    try:
        for k in range(rounds):
            if k:
                base = k % REBASE == 0
                before, now = now, advanced(blocks if base else now, 0 if base else k - 1, trees if base else trees[-1:])
            trees += grow(now, partitions, layout, [k], s)
            if before is not None and before is not blocks:
                before.unpersist()
    finally:
        for x in (before, now):
            if x is not None and x is not blocks:
                x.unpersist()
    return trees


def node_rows(number: int, tree: Tree, layout: Layout) -> list[tuple]:
    """The tree as MLlib stores it, in preorder; a split whose two leaves
    predict the same is a leaf, as MLlib prunes it."""
    value, out = tree.predictions(), []

    def same(i):
        c = tree.child[i]
        return c and merged(c) and merged(c + 1) and value[c] == value[c + 1]

    def merged(i):
        return not tree.child[i] or same(i)

    def add(i):
        at, (n, total, square) = len(out), tree.stats[i]
        out.append(None)
        head = (at, float(value[i]), float(max((square - total * total / n) / n, 0.0)) if n else 0.0,
                [float(n), float(total), float(square)], int(round(n)))
        if merged(i):
            out[at] = (number, (*head, -1.0, -1, -1, (-1, [], -1)))
        else:
            f = tree.feature[i]
            left = add(tree.child[i])
            right = add(tree.child[i] + 1)
            cut = float(layout.thresholds[f][tree.split[i]])
            out[at] = (number, (*head, tree.gain[i], left, right, (f, [cut], -1)))
        return at

    add(0)
    return out


NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:long,"
         "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,"
         "numCategories:int>>")


def to_model(est, kind, spark, trees: list[Tree], weights: list[float], layout: Layout):
    """MLlib's model, by way of its own reader: the trees are written in the
    format of a saved model."""
    path, name = run_dir(spark, "trees"), kind.__name__

    def meta(cls, uid, **more):
        return json.dumps({"class": f"org.apache.spark.ml.regression.{cls}", "timestamp": 0, "sparkVersion": spark.version,
                           "uid": uid, "paramMap": {}, "defaultParamMap": {"impurity": "variance"}} | more)

    nodes = [r for k, t in enumerate(trees) for r in node_rows(k, t, layout)]
    heads = [(k, meta("DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}"), float(w)) for k, w in enumerate(weights)]
    head = meta(name, est.uid, numFeatures=len(layout.size), numTrees=len(trees))
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
    model = est._copyValues(kind.load(path))
    model._transfer_params_to_java()
    return model


def feature_count(strategy: str, features: int, trees: int) -> int | None:
    """Features drawn for a node, by MLlib's names; None for other names."""
    named = {"auto": "all" if trees == 1 else "onethird"}.get(strategy, strategy)
    return {"all": features, "onethird": int(np.ceil(features / 3.0)), "sqrt": int(np.ceil(np.sqrt(features))),
            "log2": max(1, int(np.ceil(np.log2(features))))}.get(named)


def fitted(est, data: DataFrame, kind, trees: int, make, cuts: list | None = None):
    """The model of ``make(blocks, partitions, layout, settings)``, which
    gives trees and their weights, or the models of its first trees cut at a
    depth, for each (estimator, trees, depth) of ``cuts``; None where only MLlib can fit ``est``
    (weights, other losses, nominal features, very deep trees) or there are
    no rows."""
    features, label, spark = est.getFeaturesCol(), est.getLabelCol(), workers_ready(data.sparkSession)
    plain = {"weightCol": None, "validationIndicatorCol": None, "lossType": "squared", "impurity": "variance",
             "minWeightFractionPerNode": 0.0, "leafCol": ""}
    if any(est.hasParam(k) and est.isDefined(k) and est.getOrDefault(k) != v for k, v in plain.items()):
        return None
    attrs = data.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if "nominal" in attrs or "binary" in attrs or est.getMaxBins() > WIDTH or not 0 < est.getMaxDepth() <= 12:
        return None
    rows = data.select(vector_to_array(features).alias("x"), col(label).cast("double").alias("y"))
    n = data.count()
    if n == 0:
        return None
    # as many rows as MLlib takes for its split candidates
    share = max(est.getMaxBins() ** 2, 10000) / n
    # by numbers of its own: rows drawn before by the same seed would be drawn in the same order
    own = (est.getSeed() * 0x9E3779B97F4A7C15 + 1) % 2 ** 63
    seen = rows.select("x") if share >= 1 else rows.select("x").sample(False, share, own)
    seen = np.array([r.x for r in seen.collect()] or [rows.first().x])
    take = feature_count(est.getFeatureSubsetStrategy(), seen.shape[1], trees)
    if take is None:
        return None
    layout = Layout([find_thresholds(seen[:, f], min(est.getMaxBins(), n)) for f in range(seen.shape[1])])
    cores, (least, most) = spark.sparkContext.defaultParallelism, TASK_ROWS
    partitions = min(cores, -(-n // least)) if n <= cores * most else cores * -(-n // (cores * most))
    s = {"depth": est.getMaxDepth(), "least": est.getMinInstancesPerNode(), "min_gain": est.getMinInfoGain(),
         "rate": est.getSubsamplingRate(), "replacement": est.hasParam("bootstrap") and est.getBootstrap(),
         "seed": est.getSeed() % 2 ** 63, "take": take, "bytes": est.getMaxMemoryInMB() << 20}
    blocks = to_blocks(rows, layout, max(1, min(BLOCK_ROWS, n // (partitions * 4))), partitions).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        grown, weights = make(blocks, partitions, layout, s)
    finally:
        blocks.unpersist()
    if cuts is None:
        return to_model(est, kind, spark, grown, weights, layout)
    return [to_model(e, kind, spark, [t.cut(depth) for t in grown[:k]], weights[:k], layout) for e, k, depth in cuts]


class RandomForestRegressor(ML.RandomForestRegressor):
    """MLlib's forest, grown from blocks."""

    def _grown(self, dataset: DataFrame, cuts: list | None = None):
        count = self.getNumTrees()
        return fitted(self, dataset, ML.RandomForestRegressionModel, count, lambda blocks, partitions, layout, s: (
            grow(blocks, partitions, layout, range(count), s), [1.0] * count), cuts)

    def _fit(self, dataset: DataFrame):
        model = self._grown(dataset)
        return super()._fit(dataset) if model is None else model

    def fit_cuts(self, dataset: DataFrame, settings: list[dict]) -> list:
        """The models of settings that differ in ``numTrees`` and ``maxDepth``.
        What a tree draws depends on its number and a node's level alone, so
        each of these forests is the beginning of the largest one, which is
        the only one to be grown.  A single tree takes other features."""
        ests = [self.copy({self.getParam(k): v for k, v in x.items()}) for x in settings]
        sizes = [(e, e.getNumTrees(), e.getMaxDepth()) for e in ests]
        models = None
        if min(k for _, k, _ in sizes) > 1 and min(d for *_, d in sizes) > 0:
            most = {self.numTrees: max(k for _, k, _ in sizes), self.maxDepth: max(d for *_, d in sizes)}
            models = ests[0].copy(most)._grown(dataset, sizes)
        return [e.fit(dataset) for e in ests] if models is None else models


class GBTRegressor(ML.GBTRegressor):
    """MLlib's boosted trees, grown from blocks."""

    def _fit(self, dataset: DataFrame):
        rounds, step = self.getMaxIter(), self.getStepSize()
        model = fitted(self, dataset, ML.GBTRegressionModel, 1, lambda blocks, partitions, layout, s: (
            boosted(blocks, partitions, layout, rounds, step, s), [1.0] + [step] * (rounds - 1)))
        return super()._fit(dataset) if model is None else model
