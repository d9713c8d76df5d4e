"""Trees, forests and boosting of Spark ML's regressors, grown over blocks of binned rows.

Features are put into bins once, a byte each; a block holds some ten thousand rows as numpy arrays. Each
level of a tree, or of all trees of a forest, takes one pass over the blocks, in which tasks count rows
and sum targets by node, feature and bin. What is grown becomes a model of Spark ML.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, TaskContext
from pyspark.ml import PipelineModel, regression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block; its arrays should stay in a processor's cache.
BLOCK_ROWS = 1 << 15
#: Rows that thresholds are taken from, at least.
SAMPLE_ROWS = 1 << 16
#: Histograms of a task up to this size meet in the driver, larger ones in a shuffle by node.
DIRECT_BYTES = 1 << 20
# Sums of signs and counts share one double; a block has far fewer rows.
_COUNT = float(1 << 26)
# Rows after which such sums are taken apart.
_APART = 1 << 24


@dataclass(frozen=True)
class Bins:
    """``thresholds`` of each number (the upper ends of its bins but the last) and None for categories,
    ``sizes`` in bins, and the features that can be split."""

    thresholds: list[np.ndarray | None]
    sizes: list[int]

    @property
    def width(self) -> int:
        return max(self.sizes)

    @property
    def split(self) -> list[int]:
        return [f for f, n in enumerate(self.sizes) if n > 1]


@dataclass(frozen=True)
class Blocks:
    """``rdd`` of (number, held out, bins by row of the features that can be split, label or what is left
    of it)."""

    rdd: RDD
    bins: Bins

    def unpersist(self) -> None:
        self.rdd.unpersist()


@dataclass
class Tree:
    """Nodes by heap number, the root 1. Rows of a node without a split go on to the left, so that all
    rows end among the ``1 << depth`` places of ``values``."""

    depth: int
    width: int
    splits: dict[int, tuple] = field(default_factory=dict)
    stats: dict[int, tuple[float, float]] = field(default_factory=dict)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """(place of the feature in a block by node, and by node and bin whether rows go to the right)."""
        feature = np.zeros(1 << self.depth, np.int64)
        right = np.zeros((1 << self.depth, self.width), np.uint8)
        for node, (_, place, _, goes) in self.splits.items():
            feature[node], right[node] = place, goes
        return feature, right

    def values(self) -> np.ndarray:
        out = np.zeros(1 << self.depth)
        for node, (n, s) in self.stats.items():
            if node not in self.splits:
                out[(node << self.depth - node.bit_length() + 1) - (1 << self.depth)] = s / n if n else 0.0
        return out


# ---- blocks -----------------------------------------------------------------------------------

def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Ends between the distinct values, or at even shares of the rows if there are more than ``most``."""
    found, n = np.unique(values, return_counts=True)
    if len(found) <= most:
        return (found[1:] + found[:-1]) / 2
    upto = np.cumsum(n)
    at = np.unique(np.searchsorted(upto, np.arange(1, most) * (upto[-1] / most)))
    at = at[at < len(found) - 1]
    return (found[at] + found[at + 1]) / 2


def bins_of(features: PipelineModel, rows: DataFrame, most: int, seed: int) -> Bins:
    """Bins of each feature, from a sample of at least ``SAMPLE_ROWS`` rows."""
    schema = features.transform(rows).schema["features"]
    nominal = {a["idx"]: len(a["vals"]) for a in
               schema.metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])}
    share = min(1.0, max(SAMPLE_ROWS, 64 * most) / max(rows.count(), 1))
    drawn = rows if share == 1 else rows.sample(share, seed)
    table = features.transform(drawn).select(vector_to_array("features").alias("x")).toArrow()
    x = table["x"].combine_chunks()
    values = np.asarray(x.flatten()).reshape(len(x), -1)
    cuts = [None if f in nominal else thresholds(values[:, f], most) for f in range(values.shape[1])]
    return Bins(cuts, [nominal[f] if cut is None else len(cut) + 1 for f, cut in enumerate(cuts)])


def blocked(features: PipelineModel, rows: DataFrame, bins: Bins, label: str = "label",
            held: bool = False) -> RDD:
    """The rows in blocks, with the numbers of their bins; rows with an unknown label are an error."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if bins.width <= 256 else np.uint16
        number, xs, ys, waiting = TaskContext.get().partitionId() << 24, [], [], 0

        def block() -> pa.RecordBatch:
            x, y = np.concatenate(xs, axis=1), np.concatenate(ys)
            return pa.RecordBatch.from_pydict({
                "number": pa.array([number], pa.int64()), "n": pa.array([len(y)], pa.int32()),
                "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

        for batch in batches:
            y = batch.column(0)
            flat = np.asarray(batch.column(1).flatten())
            if y.null_count or not np.isfinite(np.asarray(y)).all() or not np.isfinite(flat).all():
                raise ValueError("labels and features must be known and finite")
            values = flat.reshape(len(y), len(bins.sizes))
            for start in range(0, len(y), BLOCK_ROWS):
                part = values[start:start + BLOCK_ROWS]
                x = np.empty((len(bins.split), len(part)), kind)
                for i, f in enumerate(bins.split):
                    cut = bins.thresholds[f]
                    x[i] = part[:, f] if cut is None else np.searchsorted(cut, part[:, f])
                if waiting + len(part) > BLOCK_ROWS:
                    yield block()
                    number, xs, ys, waiting = number + 1, [], [], 0
                xs.append(x)
                ys.append(np.asarray(y)[start:start + BLOCK_ROWS])
                waiting += len(part)
        if waiting:
            yield block()

    def unpack(row):
        kind = np.uint8 if bins.width <= 256 else np.uint16
        x = np.frombuffer(row["x"], kind).reshape(len(bins.split), row["n"])
        return row["number"], held, x, np.frombuffer(row["y"])

    return (features.transform(rows)
            .select(F.col(label).cast("double"), vector_to_array("features").alias("x"))
            .mapInArrow(pack, "number long, n int, x binary, y binary").rdd.map(unpack))


def make_blocks(features: PipelineModel, train: DataFrame, most: int, seed: int = 42,
                valid: DataFrame | None = None) -> Blocks:
    """Blocks of ``train``, and of ``valid`` as held-out rows, kept by the executors."""
    bins = bins_of(features, train, most, seed)
    rdd, rows = blocked(features, train, bins), train.count()
    if valid is not None:
        rdd, rows = rdd.union(blocked(features, valid, bins, held=True)), rows + valid.count()
    # Tasks that all run at a time; on few rows not all cores are worth one.
    cores = train.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(cores, rows // (4 * BLOCK_ROWS)))
    dealt = rdd.keyBy(lambda b: (b[0] >> 24) + b[0] % (1 << 24)).partitionBy(tasks, int).values()
    return Blocks(_kept(dealt), bins)


def _kept(rdd: RDD) -> RDD:
    """Kept, and written to the shared folder, so that lost executors don't start from the tables again."""
    rdd = rdd.persist(StorageLevel.MEMORY_AND_DISK)
    rdd.checkpoint()
    rdd.count()
    return rdd


# ---- growth -----------------------------------------------------------------------------------

def _places(x: np.ndarray, feature: np.ndarray, right: np.ndarray, levels: int) -> np.ndarray:
    """Heap number of each row's node after ``levels`` levels."""
    n = x.shape[1]
    if not len(x):
        return np.full(n, 1 << levels)
    at, rows, flat, offset = np.ones(n, np.int64), np.arange(n), x.ravel(), feature * n
    goes, width = right.ravel(), right.shape[1]
    for _ in range(levels):
        place = offset.take(at)
        place += rows
        found = flat.take(place)
        np.multiply(at, width, out=place)
        place += found
        at += at
        at += goes.take(place)
    return at


def _poisson(draw: np.ndarray, rate: float) -> np.ndarray:
    """Counts of a Poisson variable from uniform draws."""
    out, chance, upto = np.zeros(len(draw)), math.exp(-rate), 0.0
    for k in range(1, 20):
        upto += chance
        out += draw >= upto
        chance *= rate / k
    return out


@dataclass(frozen=True)
class Growth:
    """How trees grow: ``rate`` of the rows for each, with replacement for a ``bootstrap``; ``features`` of
    each node to choose from; ``signs`` of the targets alone, or ``scale`` times them."""

    depth: int
    least: int
    gain: float
    rate: float
    bootstrap: bool
    features: int
    seed: int
    signs: bool = False
    scale: float = 1.0

    def target(self, left: np.ndarray) -> np.ndarray:
        return np.where(left < 0, -1.0, 1.0) if self.signs else left * self.scale

    def weights(self, number: int, tree: int, n: int) -> np.ndarray | None:
        if not self.bootstrap and self.rate >= 1:
            return None
        draw = np.random.default_rng([self.seed & 0xFFFFFFFF, tree, number]).random(n, np.float32)
        return _poisson(draw, self.rate) if self.bootstrap else (draw < self.rate).astype(float)


def _sums(blocks: Iterator, how: Growth, bins: Bins, tables: list, level: int,
          slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each tree counts and sums by feature, open node and bin over the blocks that aren't held out,
    and (sum, rows) of the absolute errors of those that are."""
    used, width = max(len(bins.split), 1), bins.width
    total = [np.zeros((2, used, (int(s.max()) + 1) * width)) for s in slots]
    # Counts and signs in one, until they are taken apart.
    joint = [np.zeros(found.shape[1:]) for found in total] if how.signs else []
    error, rows = np.zeros(2), 0

    def apart() -> None:
        for found, both in zip(total, joint):
            n = np.rint(both / _COUNT)
            found[0] += n
            found[1] += both - n * _COUNT
            both[:] = 0

    for number, held, x, left in blocks:
        if held:
            error += float(np.abs(left).sum()), len(left)
            continue
        if rows // _APART < (rows + len(left)) // _APART:
            apart()
        rows += len(left)
        goal = how.target(left)
        index = np.empty(len(left), np.int64)
        for t, (tree, (feature, right)) in enumerate(tables):
            base = slots[t].take(_places(x, feature, right, level))
            # The last slot takes the rows that are in no open node.
            cells = total[t].shape[2]
            weight = how.weights(number, tree, len(left))
            if weight is not None and not how.bootstrap:
                base[weight == 0] = cells // width - 1
                weight = None
            base *= width
            one = _COUNT + goal if how.signs else goal if weight is None else goal * weight
            for i in range(used):
                # Without any feature to split by, all rows are in one bin.
                np.add(base, x[i] if len(x) else 0, out=index)
                if how.signs:
                    joint[t][i] += np.bincount(index, one, cells)
                else:
                    total[t][0, i] += np.bincount(index, weight, cells)
                    total[t][1, i] += np.bincount(index, one, cells)
    apart()
    return [found.reshape(2, used, -1, width)[:, :, :-1] for found in total], error


def best_split(h: np.ndarray, how: Growth, bins: Bins, tree: int, node: int) -> tuple | None:
    """(feature, its place in a block, gain, bins that go to the right, (n, sum) on the left and on the
    right) of the split that lowers the variance most. ``h`` has counts and sums by feature and bin."""
    used, width = bins.split, bins.width
    if not used:
        return None
    rng = np.random.default_rng([how.seed & 0xFFFFFFFF, tree, node])
    mine = set(range(len(bins.sizes)) if how.features >= len(bins.sizes) else
               rng.choice(len(bins.sizes), how.features, replace=False).tolist())
    n, s = h
    order = np.tile(np.arange(width), (len(used), 1))
    for i, f in enumerate(used):
        if bins.thresholds[f] is None:
            mean = np.divide(s[i], n[i], out=np.full(width, np.inf), where=n[i] > 0)
            order[i] = np.argsort(mean, kind="stable")
    ln, ls = (np.cumsum(np.take_along_axis(a, order, 1), 1) for a in (n, s))
    count, total = ln[:, -1:], ls[:, -1:]
    rn, rs = count - ln, total - ls
    fine = (ln >= max(how.least, 1)) & (rn >= max(how.least, 1))
    fine &= np.array([f in mine for f in used])[:, None]
    if not fine.any():
        return None
    before = total ** 2 / count
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fine, (ls ** 2 / ln + rs ** 2 / rn - before) / count, -np.inf)
    i, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[i, k] > max(how.gain, 1e-12 * float(before[i, 0] / count[i, 0])):
        return None
    right = np.ones(width, np.uint8)
    right[order[i, :k + 1]] = 0
    return (used[i], int(i), float(gain[i, k]), right, (float(ln[i, k]), float(ls[i, k])),
            (float(rn[i, k]), float(rs[i, k])))


def _slots(open_: list[int], level: int) -> np.ndarray:
    """Number of an open node by its heap number; the others share the one behind."""
    slot = np.full(2 << level, len(open_), np.int64)
    slot[open_] = np.arange(len(open_))
    return slot


def _split(tree: Tree, node: int, n: float, s: float, split: tuple | None, how: Growth) -> list[int]:
    """Put the split into the tree; its children that may be split again."""
    tree.stats[node] = (n, s)
    if split is None or how.depth == 0:
        return []
    *known, left, right = split
    tree.splits[node] = tuple(known)
    tree.stats[2 * node], tree.stats[2 * node + 1] = left, right
    return [child for child, side in ((2 * node, left), (2 * node + 1, right))
            if side[0] >= 2 * max(how.least, 1)]


def grow(blocks: Blocks, how: Growth, number: int = 1) -> tuple[list[Tree], np.ndarray]:
    """``number`` trees, a pass over the blocks for each level of all of them, and (sum, rows) of the
    absolute errors of held-out rows."""
    bins, errors = blocks.bins, np.zeros(2)
    trees = [Tree(how.depth, bins.width) for _ in range(number)]
    open_: list[list[int]] = [[1]] * number
    for level in range(max(how.depth, 1)):
        some = [t for t in range(number) if open_[t]]
        if not some:
            break
        slots = [_slots(open_[t], level) for t in some]
        tables = [(t, trees[t].tables()) for t in some]
        nodes = [open_[t] for t in some]

        def sums(part: Iterator) -> Iterator:
            found, error = _sums(part, how, bins, tables, level, slots)
            yield None, error
            for i, h in enumerate(found):
                for k in range(h.shape[2]):
                    yield (i, k), np.ascontiguousarray(h[:, :, k])

        def choose(key: tuple | None, h: np.ndarray) -> tuple:
            if key is None:
                return None, h
            i, k = key
            return key, (float(h[0, 0].sum()), float(h[1, 0].sum()),
                         best_split(h, how, bins, some[i], nodes[i][k]))

        found = blocks.rdd.mapPartitions(sums)
        if 16 * len(bins.split) * bins.width * sum(len(x) for x in nodes) <= DIRECT_BYTES:
            direct: dict = {}
            for key, h in found.collect():
                direct[key] = direct[key] + h if key in direct else h
            chosen = [choose(*x) for x in direct.items()]
        else:
            chosen = found.reduceByKey(operator.add).map(lambda kv: choose(*kv)).collect()
        open_ = [[] for _ in range(number)]
        for key, split in chosen:
            if key is not None:
                i, k = key
                open_[some[i]] += _split(trees[some[i]], nodes[i][k], *split, how)
            elif level == 0:
                errors = split
        open_ = [sorted(x) for x in open_]
    return trees, errors


def _minus(part: Iterator, tree: Tree, weight: float) -> Iterator:
    feature, right = tree.tables()
    value = tree.values() * weight
    for number, held, x, left in part:
        at = _places(x, feature, right, tree.depth)
        at -= 1 << tree.depth
        yield number, held, x, left - value.take(at)


@dataclass
class Boosted:
    """``trees`` with ``weights``; mean absolute ``errors`` of the held-out rows after each tree, and the
    rows with what the trees leave of their labels."""

    trees: list[Tree]
    weights: list[float]
    errors: list[float]
    left: Blocks | None


def _error(part: Iterator) -> np.ndarray:
    return np.array([[float(np.abs(b[3]).sum()), len(b[3])] for b in part if b[1]] or [[0, 0]], float).sum(0)


def boost(gbt: regression.GBTRegressor, blocks: Blocks, more: bool = True) -> Boosted:
    """Gradient boosting with the settings of ``gbt``: the first tree fits the labels, the others the
    gradient of the loss. What a tree leaves is kept while the next one grows, and in the end if ``more``
    trees are to follow."""
    how, now = _growth(gbt, blocks.bins), blocks
    out = Boosted([], [], [], None)
    for m in range(gbt.getMaxIter()):
        after = replace(how, seed=how.seed + m, signs=m > 0 and gbt.getLossType() == "absolute",
                        scale=2.0 if m else 1.0)
        (tree,), error = grow(now, after)
        if m:
            # The pass for the root has read what the last tree leaves.
            out.errors.append(_mean(error))
            if before is not blocks:
                before.unpersist()
        out.trees.append(tree)
        out.weights.append(gbt.getStepSize() if m else 1.0)
        before, now = now, Blocks(now.rdd.mapPartitions(
            lambda part, tree=tree, weight=out.weights[-1]: _minus(part, tree, weight)), blocks.bins)
        if m + 1 < gbt.getMaxIter():
            now.rdd.persist(StorageLevel.MEMORY_AND_DISK)
    if more:
        out.left = Blocks(_kept(now.rdd), blocks.bins)
        out.errors.append(_mean(out.left.rdd.mapPartitions(lambda part: [_error(part)]).reduce(operator.add)))
    if before is not blocks:
        before.unpersist()
    return out


def _mean(error: np.ndarray) -> float:
    return float(error[0] / error[1]) if error[1] else math.nan


# ---- models -----------------------------------------------------------------------------------

def _growth(regressor, bins: Bins) -> Growth:
    forest = isinstance(regressor, regression.RandomForestRegressor)
    asked = regressor.getFeatureSubsetStrategy() if regressor.hasParam("featureSubsetStrategy") else "all"
    n = len(bins.sizes)
    if asked == "auto":
        asked = "onethird" if forest and regressor.getNumTrees() > 1 else "all"
    share = {"all": n, "onethird": n / 3, "sqrt": math.sqrt(n), "log2": math.log2(n)}.get(asked)
    if share is None:
        share = float(asked) * n if "." in asked else int(asked)
    return Growth(regressor.getMaxDepth(), regressor.getMinInstancesPerNode(), regressor.getMinInfoGain(),
                  regressor.getSubsamplingRate() if regressor.hasParam("subsamplingRate") else 1.0,
                  forest and regressor.getNumTrees() > 1 and regressor.getBootstrap(),
                  max(1, min(n, math.ceil(share))), regressor.getSeed())


def _java_doubles(values: Sequence[float]):
    sc = SparkContext.getOrCreate()
    out = sc._gateway.new_array(sc._jvm.double, len(values))
    sc._jvm.java.nio.ByteBuffer.wrap(np.array(values, ">f8").tobytes()).asDoubleBuffer().get(out)
    return out


def _java_trees(trees: Sequence[Tree], bins: Bins):
    sc = SparkContext.getOrCreate()
    tree_package = sc._jvm.org.apache.spark.ml.tree
    leaf_node, inner_node = tree_package.LeafNode, tree_package.InternalNode
    by_number, by_category = tree_package.ContinuousSplit, tree_package.CategoricalSplit
    calculator = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    kind, part = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, sc._jvm.java.util.Arrays
    # Squares aren't summed, so the impurity of a node isn't known; nothing that predicts reads it.
    stats = _java_doubles([v for tree in trees for n, s in tree.stats.values() for v in (n, s, math.nan)])
    start = 0

    def node(tree: Tree, places: dict[int, int], at: int):
        n, s = tree.stats[at]
        known = calculator(part.copyOfRange(stats, places[at], places[at] + 3), int(n))
        mean = s / n if n else 0.0
        if at not in tree.splits:
            return leaf_node(mean, math.nan, known)
        f, _, gain, right = tree.splits[at]
        if bins.thresholds[f] is None:
            left = [c for c in range(bins.sizes[f]) if not right[c]]
            split = by_category(f, _java_doubles(left), bins.sizes[f])
        else:
            split = by_number(f, float(bins.thresholds[f][int(right.argmax()) - 1]))
        return inner_node(mean, math.nan, gain, node(tree, places, 2 * at), node(tree, places, 2 * at + 1),
                          split, known)

    out = sc._gateway.new_array(kind, len(trees))
    for i, tree in enumerate(trees):
        places = {at: start + 3 * k for k, at in enumerate(tree.stats)}
        out[i] = kind(f"dtr_{i}", node(tree, places, 1), len(bins.sizes))
        start += 3 * len(places)
    return out


def _model(regressor, kind, java):
    """The model with the settings of the regressor, as a fit of Spark ML returns it."""
    regressor._transfer_params_to_java()
    empty = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.param.ParamMap.empty()
    return kind(regressor._java_obj.copyValues(java, empty))


def boosted_model(gbt: regression.GBTRegressor, trees: Sequence[Tree], weights: Sequence[float], bins: Bins
                  ) -> regression.GBTRegressionModel:
    java = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.regression.GBTRegressionModel(
        gbt.uid, _java_trees(trees, bins), _java_doubles(weights), len(bins.sizes))
    return _model(gbt, regression.GBTRegressionModel, java)


def grows(regressor) -> bool:
    """Whether :func:`fit` knows the kind of this regressor."""
    return isinstance(regressor, (regression.DecisionTreeRegressor, regression.RandomForestRegressor,
                                  regression.GBTRegressor))


def fit(regressor, blocks: Blocks):
    """The model of Spark ML that a tree, a forest or boosting with these settings comes to."""
    if isinstance(regressor, regression.GBTRegressor):
        found = boost(regressor, blocks, more=False)
        return boosted_model(regressor, found.trees, found.weights, blocks.bins)
    forest = isinstance(regressor, regression.RandomForestRegressor)
    trees, _ = grow(blocks, _growth(regressor, blocks.bins), regressor.getNumTrees() if forest else 1)
    java = _java_trees(trees, blocks.bins)
    if not forest:
        return _model(regressor, regression.DecisionTreeRegressionModel, java[0])
    kinds = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.regression
    return _model(regressor, regression.RandomForestRegressionModel, kinds.RandomForestRegressionModel(
        regressor.uid, java, len(blocks.bins.sizes)))


class GBTRegressor(regression.GBTRegressor):
    """Spark ML's settings of boosting, fitted over :class:`Blocks`."""

    def _fit(self, dataset: Blocks) -> Boosted:
        return boost(self, dataset)
