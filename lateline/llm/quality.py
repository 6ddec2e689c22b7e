"""Quality classifier: supervised subword embeddings.

A text's features are its words, their character n-grams and its word pairs of
one word twice (which share a feature), each hashed to a learned vector.  A
document is the average of its features' vectors; a softmax
layer on top gives the class.  Both are trained by stochastic gradient descent
in numpy on a bounded sample of labelled rows.

The layer is linear, so scoring needs one number per class and feature only:
a word's features are summed once and kept in a bounded cache.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.llm.common import bounded_sample, text_batches

#: Character n-grams of a word, its marks < and > included.
ORDERS = (2, 3)


def grams(word: bytes) -> list[bytes]:
    w = b"<" + word + b">"
    return [w[i:i + k] for k in ORDERS for i in range(len(w) - k + 1)]


def feature(x: bytes, kind: int, buckets: int) -> int:
    """Bucket of a word (kind 1), an n-gram (2) or the repeated pair (3)."""
    return xxhash.xxh32_intdigest(x, kind) % buckets


def features(word: bytes, buckets: int) -> list[int]:
    """Hashed features of a word as it stands: case and punctuation matter."""
    return [feature(word, 1, buckets), *[feature(g, 2, buckets) for g in grams(word)]]


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def repeats(ws: list[bytes]) -> int:
    """Words that equal the one before."""
    return sum(map(operator.eq, ws, ws[1:]))


def count_features(ws: list[bytes], buckets: int) -> Counter:
    total: Counter = Counter()
    for w, c in Counter(ws).most_common():
        for f in features(w, buckets):
            total[f] += c
    if again := repeats(ws):
        total[feature(b"", 3, buckets)] += again
    return total


@dataclass(frozen=True)
class QualityModel:
    """``weights`` has one logit (of label 1 against 0) per feature bucket:
    the product of the feature vectors and the softmax layer."""

    weights: np.ndarray
    bias: float

    @property
    def buckets(self) -> int:
        return len(self.weights)


def train(docs: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, *, buckets: int, dim: int = 10,
          epochs: int = 8, rate: float = 20.0, layer_rate: float = 0.1, seed: int = 3) -> QualityModel:
    """Feature ids and their counts per document, labels 0 / 1 -> a model.

    Both classes weigh the same in the gradient; the bias then takes up the
    share of label 1, so a score is a probability under the labels' mix.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (buckets, dim))
    layer = rng.uniform(-1.0, 1.0, (dim, 2))
    n = len(labels)
    share = np.array([max(1e-9, (labels == c).mean()) for c in (0, 1)])
    weight = 0.5 / share[labels]
    steps, at = max(1, epochs * n), 0
    for _ in range(epochs):
        for i in rng.permutation(n):
            left = 1 - at / steps
            at += 1
            ids, c = docs[i], counts[i]
            total = c.sum()
            if not total:
                continue
            part = (c / total)[:, None]
            mean = (vectors[ids] * part).sum(0)
            z = mean @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1.0
            g = weight[i] * p
            back = layer @ g
            layer -= layer_rate * left * np.outer(mean, g)
            # an average spreads the gradient over the features, by their share
            vectors[ids] -= rate * left * part * back
    logit = vectors @ (layer[:, 1] - layer[:, 0])
    return QualityModel(logit.astype(np.float64), float(np.log(share[1] / share[0])))


def fit(labelled: DataFrame, *, text: str = "text", label: str = "quality", key: str = "doc_id",
        max_docs: int = 3_000, buckets: int = 1 << 18, **kw) -> QualityModel | None:
    """Learn from rows with a text and a label 0 or 1; None if there is none.

    About ``max_docs`` rows at most are learned from, picked by a hash of
    ``key``, all words of each; a row has ``buckets`` features at most, which
    bounds what the driver holds.  Scoring has no such bounds.
    """
    rows = labelled.where(F.col(label).isin(0, 1) & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    rows = bounded_sample(rows, F.col("key"), max_docs)

    def run(batches):
        for b in batches:
            ids, counts = [], []
            for x in b.column(1):
                total = count_features(words(x.as_py()), buckets)
                ids.append(list(total))
                counts.append(list(total.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["key", "label", "ids", "counts"])

    kind = rows.schema["key"].dataType.simpleString()
    got = rows.mapInArrow(run, f"key {kind}, label int, ids array<int>, counts array<int>").toArrow()
    if not got.num_rows:
        return None
    # the order of the rows must not depend on how Spark dealt them
    ids = [np.array(x.as_py(), np.int64) for x in got.column("ids")]
    counts = [np.array(x.as_py(), np.float64) for x in got.column("counts")]
    labels = got.column("label").to_numpy()
    order = sorted(range(len(ids)), key=lambda i: (str(got.column("key")[i].as_py()), len(ids[i]), counts[i].sum()))
    return train([ids[i] for i in order], [counts[i] for i in order], labels[order], buckets=buckets, **kw)


class Scorer:
    def __init__(self, model: QualityModel, cache: int = 300_000):
        self.m, self.cache, self.words, self.grams = model, cache, {}, {}
        self.pair = float(model.weights[feature(b"", 3, model.buckets)])

    def gram(self, g: bytes) -> float:
        if len(self.grams) >= self.cache:
            self.grams.clear()
        self.grams[g] = v = float(self.m.weights[feature(g, 2, self.m.buckets)])
        return v

    def word(self, w: bytes) -> tuple[float, int]:
        gs, get, gram = grams(w), self.grams.get, self.gram
        total = float(self.m.weights[feature(w, 1, self.m.buckets)])
        for g in gs:
            v = get(g)
            total += gram(g) if v is None else v
        if len(self.words) >= self.cache:
            self.words.clear()
        self.words[w] = v = (total, len(gs) + 1)
        return v

    def score(self, text: str | None) -> float:
        ws = words(text)
        n = repeats(ws)
        total = self.pair * n
        get, word = self.words.get, self.word
        for w, c in Counter(ws).items():
            s, k = get(w) or word(w)
            total += s * c
            n += k * c
        z = self.m.bias + (total / n if n else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))


def classify(docs: DataFrame, model: QualityModel | None, *, text: str = "text", score: str = "score",
             pred: str = "predicted", least: float = 0.7) -> DataFrame:
    """``docs`` with the probability of label 1 and the decision at ``least``.

    Columns of these names are replaced.  Null and empty texts, which have no
    feature, get the share of label 1 in training; without a model every score
    is 0.5.  Every row is scored on its whole text.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in (score, pred)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*src.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(pred, T.IntegerType())])

    def run(batches):
        s = Scorer(shared.value) if shared.value is not None else None
        for b in batches:
            p = [s.score(x.as_py()) if s else 0.5 for x in b.column(keep.index(text))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(p, pa.float64()), pa.array([int(x >= least) for x in p], pa.int32())],
                names=[*keep, score, pred])

    return src.mapInArrow(run, schema)
