"""Random forest grown level by level on counts, all trees at once.

Spark ML's forest keeps an object and a draw per tree for every row, which
spills when tuples are many.  Here a row is the packed codes of its features
and its number ``n``; a tree's bootstrap takes it Poisson(``n``) times, drawn
from a hash of the tuple and the tree, as ``n`` rows drawn one by one would
be.  A job a level: every task walks its rows down each tree and counts them
per open node, drawn feature, value and class; the counts of a few nodes meet
in one group that finds their best splits.  Counts are whole numbers, so the
forest does not depend on how rows are dealt to tasks.  Splits, gain, leaves and
their pruning are Spark's (Gini, midpoints between the values that occur,
siblings of one prediction become a leaf), and the result is its model class.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.session import ensure_checkpoint_dir, staged

#: Rows a packed block: its arrays stay in a core's cache.
BLOCK = 1 << 17
#: Open nodes of a tree whose counts meet in one group.
GROUP = 64


def distinct_values(encoded: DataFrame, features: int) -> list[np.ndarray]:
    """Per feature the sorted values that occur (one aggregate)."""
    row = encoded.agg(*[F.collect_set(F.col("x")[i]).alias(f"v{i}") for i in range(features)]).first()
    return [np.array(sorted(row[f"v{i}"]), dtype=np.float64) for i in range(features)]


def packing(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per feature the shift and the mask of its code; bit 0 holds the class."""
    bits = [max(1, (len(v) - 1).bit_length()) for v in values]
    if sum(bits) > 62:
        raise ValueError("the features have too many distinct values to pack")
    return np.cumsum([1, *bits[:-1]]).astype(np.uint64), np.array([(1 << b) - 1 for b in bits], np.uint64)


def packed_rows(encoded: DataFrame, values: list[np.ndarray]) -> DataFrame:
    """Blocks of rows, ordered by ``n``: packed codes and numbers, written once."""
    shift, _ = packing(values)

    def block(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(n, kind="stable")
        return pa.RecordBatch.from_arrays([pa.array([key[order].tobytes()], pa.binary()),
                                           pa.array([n[order].astype(np.int64).tobytes()], pa.binary())], ["key", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, held = [], [], 0
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(-1, len(values))
            key = b.column(1).to_numpy().astype(np.uint64)
            for f, v in enumerate(values):
                key |= np.searchsorted(v, x[:, f]).astype(np.uint64) << shift[f]
            keys.append(key)
            numbers.append(b.column(2).to_numpy())
            held += len(key)
            while held >= BLOCK:
                key, n = np.concatenate(keys), np.concatenate(numbers)
                yield block(key[:BLOCK], n[:BLOCK])
                keys, numbers, held = [key[BLOCK:]], [n[BLOCK:]], held - BLOCK
        if held:
            yield block(np.concatenate(keys), np.concatenate(numbers))

    return staged(encoded.select("x", F.col("is_late").cast("int").alias("y"), "n").mapInArrow(pack, "key binary, n binary"), "forest-rows")


def poisson_steps(n: int) -> tuple[int, np.ndarray]:
    """The least draw of Poisson(n) that is looked at and the cumulative
    probabilities from there on; what is left out has less than 1e-16."""
    low, high = max(0, int(n - 9 * math.sqrt(n)) - 1), int(n + 10 * math.sqrt(n)) + 20
    k = np.arange(low, high)
    p = np.empty(len(k))
    p[0] = math.exp(low * math.log(n) - n - math.lgamma(low + 1))
    p[1:] = p[0] * np.cumprod(n / k[1:])
    return low, np.cumsum(p)


def uniform(key: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per tuple and salt (splitmix64)."""
    z = key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    for by, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(by)
        z *= np.uint64(mul)
    z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) * 2.0 ** -53


def draws(key: np.ndarray, n: np.ndarray, salt: int, steps: dict) -> np.ndarray:
    """How often a tree's bootstrap takes each row; ``n`` is sorted."""
    u = uniform(key, salt)
    out = np.empty(len(key), np.int64)
    cut = [0, *(np.flatnonzero(np.diff(n)) + 1), len(n)]
    for a, b in zip(cut[:-1], cut[1:]):
        of = int(n[a])
        if of not in steps:
            steps[of] = poisson_steps(of)
        low, cumulated = steps[of]
        out[a:b] = low + np.searchsorted(cumulated, u[a:b], side="right")
    return out


def _salt(seed: int, tree: int) -> int:
    return int(np.random.SeedSequence([seed, tree]).generate_state(1, np.uint64)[0])


class Tree:
    """Nodes in the order they were opened; a closed node leads to itself."""

    def __init__(self, features: int, drawn: int, seed: int, number: int):
        self.features, self.drawn = features, drawn
        self.rng = np.random.default_rng([seed, number])
        self.feature, self.cut, self.left = [], [], []
        self.gain, self.stats = [], []
        self.open: list[int] = []

    def add(self, stats, opened: bool) -> int:
        i = len(self.feature)
        self.feature.append(0)
        self.cut.append(1 << 62)
        self.left.append(i)
        self.gain.append(-1.0)
        self.stats.append(stats)
        if opened:
            self.open.append(i)
        return i

    def pick(self) -> np.ndarray:
        """Features that each open node may split by."""
        return np.sort(self.rng.random((len(self.open), self.features)).argsort(1)[:, :self.drawn], 1)


def gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = a + b
    with np.errstate(invalid="ignore", divide="ignore"):
        return 1.0 - (a / w) ** 2 - (b / w) ** 2


def best_splits(counts: np.ndarray, weights: np.ndarray, least_gain: float):
    """Per node of ``counts`` (node, drawn feature, value, class): the drawn
    feature and the value that it splits after (-1: a leaf), the gain, the
    counts of the node and of its left side."""
    left = counts.cumsum(2)
    total = left[:, :1, -1:]
    right = total - left
    l0, l1, r0, r1, t0, t1 = (z[..., c] * weights[c] for z in (left, right, total) for c in (0, 1))
    w = t0 + t1
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = gini(t0, t1) - (l0 + l1) / w * gini(l0, l1) - (r0 + r1) / w * gini(r0, r1)
    fits = (left.sum(3) > 0) & (right.sum(3) > 0) & (gain >= least_gain)
    flat = np.where(fits, gain, -1.0).reshape(len(counts), -1)
    at = flat.argmax(1)
    found = flat[np.arange(len(flat)), at]
    by, cut = np.divmod(at, counts.shape[2])
    return by, np.where(found >= least_gain, cut, -1), found, total[:, 0, 0], left.reshape(len(counts), -1, 2)[np.arange(len(flat)), at]


def _level(blocks: DataFrame, trees: list[Tree], picks: list[np.ndarray], depth: int, seed: int, values: list[np.ndarray],
           weights: np.ndarray, least_gain: float) -> pa.Table:
    shift, mask = packing(values)
    width = max(len(v) for v in values)
    plans = []
    for number, (t, pick) in enumerate(zip(trees, picks)):
        if t.open:
            feature = np.array(t.feature)
            place = np.full(len(feature), -1)
            place[t.open] = np.arange(len(t.open))
            plans.append((number, _salt(seed, number), shift[feature], mask[feature], np.array(t.cut), np.array(t.left), place, pick))
    shared = blocks.sparkSession.sparkContext.broadcast(plans)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(k.as_py(), np.uint64), np.frombuffer(n.as_py(), np.int64)) for b in batches for k, n in zip(*b.columns)]
        steps: dict = {}
        if not rows:
            return
        for number, salt, by, bits, cut, left, place, pick in shared.value:
            drawn = pick.shape[1]
            size = len(pick) * drawn * width * 2
            out = np.zeros(size)
            for key, n in rows:
                taken = draws(key, n, salt, steps)
                at = np.flatnonzero(taken)
                k, d = key.take(at), taken.take(at).astype(np.float64)
                node = np.zeros(len(k), np.int64)
                for _ in range(depth):
                    code = (k >> by.take(node)) & bits.take(node)
                    node = left.take(node) + (code.view(np.int64) > cut.take(node))
                slot = place.take(node)
                if depth:
                    at = np.flatnonzero(slot >= 0)
                    k, d, slot = k.take(at), d.take(at), slot.take(at)
                y = (k & np.uint64(1)).view(np.int64)
                for j in range(drawn):
                    code = (k >> shift[pick[:, j]].take(slot)) & mask[pick[:, j]].take(slot)
                    cell = ((slot * drawn + j) * width + code.view(np.int64)) * 2 + y
                    out += np.bincount(cell, d, size)
            whole = out.astype(np.int64)
            per = GROUP * drawn * width * 2
            for part in range(0, size, per):
                some = whole[part:part + per]
                if some.any():
                    small = next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if some.max() <= np.iinfo(t).max)
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part // per], pa.int32()), pa.array([len(some)], pa.int32()),
                                                      pa.array([some.astype(small).tobytes()], pa.binary())], ["tree", "part", "size", "counts"])

    drawn = picks[0].shape[1]

    def split(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number, part = (k.as_py() for k in key)
        total = 0
        for size, counts in zip(table["size"], table["counts"]):
            raw = counts.as_buffer()
            total = total + np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[raw.size // size.as_py()]).astype(np.int64)
        by, cut, gain, all_, left = best_splits(total.reshape(-1, drawn, width, 2), weights, least_gain)
        n = len(by)
        cols = [np.full(n, number, np.int32), (part * GROUP + np.arange(n)).astype(np.int32), by.astype(np.int32), cut.astype(np.int32),
                gain, all_[:, 0], all_[:, 1], left[:, 0], left[:, 1]]
        return pa.table([pa.array(c) for c in cols], ["tree", "node", "by", "cut", "gain", "n0", "n1", "l0", "l1"])

    counted = blocks.mapInArrow(count, "tree int, part int, size int, counts binary")
    return counted.groupBy("tree", "part").applyInArrow(
        split, "tree int, node int, by int, cut int, gain double, n0 long, n1 long, l0 long, l1 long").toArrow()


def grow(blocks: DataFrame, values: list[np.ndarray], weights: np.ndarray, trees: int, depth: int, seed: int, least_gain: float) -> list[Tree]:
    """``weights`` are the two classes' weights; of the features each node sees
    the root of their number, rounded up."""
    drawn = math.ceil(math.sqrt(len(values)))
    forest = [Tree(len(values), drawn, seed, i) for i in range(trees)]
    for t in forest:
        t.add((0, 0), depth > 0)
    for level in range(depth):
        if not any(t.open for t in forest):
            break
        picks = [t.pick() for t in forest]
        found = _level(blocks, forest, picks, level, seed, values, weights, least_gain)
        opened = [t.open for t in forest]
        for t in forest:
            t.open = []
        rows = found.sort_by([("tree", "ascending"), ("node", "ascending")]).to_pydict()
        for number, node, by, cut, gain, n0, n1, l0, l1 in zip(*rows.values()):
            t, i = forest[number], opened[number][node]
            t.stats[i] = (n0, n1)
            if cut >= 0:
                t.feature[i], t.cut[i], t.gain[i] = int(picks[number][node][by]), cut, gain
                t.left[i] = len(t.feature)
                for side in ((l0, l1), (n0 - l0, n1 - l1)):
                    t.add(side, level + 1 < depth and min(side) > 0)
    return forest


def node_rows(t: Tree, number: int, values: list[np.ndarray], weights: np.ndarray) -> list[dict]:
    """The tree's nodes from the root down, left before right, as Spark ML stores them."""
    stats = [(a * weights[0], b * weights[1]) for a, b in t.stats]
    late = [int(b > a) for a, b in stats]
    leaf = [left == i for i, left in enumerate(t.left)]
    for i in range(len(leaf) - 1, -1, -1):  # children come after their parent
        a = t.left[i]
        if not leaf[i] and leaf[a] and leaf[a + 1] and late[a] == late[a + 1]:
            leaf[i] = True
    out: list[dict] = []

    def put(i: int) -> int:
        at, (a, b) = len(out), stats[i]
        row = {"id": at, "prediction": float(late[i]), "impurity": float(1 - (a / (a + b)) ** 2 - (b / (a + b)) ** 2) if a + b > 0 else 0.0,
               "impurityStats": [float(a), float(b)], "rawCount": int(sum(t.stats[i])), "gain": -1.0, "leftChild": -1, "rightChild": -1,
               "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        out.append({"treeID": number, "nodeData": row})
        if not leaf[i]:
            f, c = t.feature[i], t.cut[i]
            row["gain"] = float(t.gain[i])
            row["split"] = {"featureIndex": f, "leftCategoriesOrThreshold": [float((values[f][c] + values[f][c + 1]) / 2)], "numCategories": -1}
            row["leftChild"] = put(t.left[i])
            row["rightChild"] = put(t.left[i] + 1)
        return at

    put(0)
    return out


_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                   ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])


def as_model(spark, forest: list[Tree], values: list[np.ndarray], weights: np.ndarray, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """The trees as Spark ML's model, by way of its file format."""
    path = f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    estimator.save(f"{path}/estimator")
    meta = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    package = "org.apache.spark.ml.classification."
    tree_params = ("featuresCol", "labelCol", "maxBins", "maxDepth", "minInfoGain", "seed", "weightCol")
    one = {**meta, "class": f"{package}DecisionTreeClassificationModel", "paramMap": {k: v for k, v in meta["paramMap"].items() if k in tree_params},
           "defaultParamMap": {k: v for k, v in meta["defaultParamMap"].items() if k not in ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")}}
    whole = {**meta, "class": f"{package}RandomForestClassificationModel", "numFeatures": len(values), "numClasses": 2, "numTrees": len(forest)}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame([(i, json.dumps({**one, "uid": f"dtc_{uuid.uuid4().hex[:12]}", "numFeatures": len(values), "numClasses": 2}), 1.0) for i in range(len(forest))],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    nodes = [r for i, t in enumerate(forest) for r in node_rows(t, i, values, weights)]
    spark.createDataFrame(pa.Table.from_pylist(nodes, pa.schema([("treeID", pa.int32()), ("nodeData", _NODE)]))).write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")


def fit_forest(encoder: PipelineModel, rows: DataFrame, estimator: RandomForestClassifier) -> PipelineModel:
    """``rows``: distinct (features, is_late) with their number ``n``; classes
    are weighed n / (2 n_class).  ``estimator`` holds the parameters."""
    encoded = encoder.transform(rows).select(vector_to_array("features").alias("x"), "is_late", "n")
    per = {r.is_late: r.n for r in rows.groupBy("is_late").agg(F.sum("n").alias("n")).collect()}
    both = sum(per.values())
    if not both:
        raise ValueError("no rows to grow a forest on")
    weights = np.array([both / (2 * per[y]) if per.get(y) else 1.0 for y in (0, 1)])
    values = distinct_values(encoded, len(encoder.stages[-1].getInputCols()))
    forest = grow(packed_rows(encoded, values), values, weights, estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed(), estimator.getMinInfoGain())
    return PipelineModel([*encoder.stages, as_model(rows.sparkSession, forest, values, weights, estimator)])
