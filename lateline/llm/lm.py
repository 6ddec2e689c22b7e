"""Language-model scoring: a causal self-attention model on subword ids.

The model is small and trained in numpy: an embedding of ids and places, one
attention head, a feed-forward layer, and a softmax over classes of ids; an
id's probability is its class's times its share of the class.  A text is a
stream of ids between two end marks; windows of fixed length overlap, and each
id is scored once, by the window that gives it more context.

Classes and shares come from the pairs of neighbouring ids of the whole
training fold, counted by Spark.  All texts of the fold are cut into windows,
and every id of them is learned from: by the driver if the windows are few;
else it begins the model with a bounded number of them, and then all are
learned from in the tasks, whose models are averaged.

Beside it, every text gets a word unigram score.  Its counts cover the whole
training fold: they are a distributed table.  Frequent words go to every task
in arrays of bounded size; all other words of the texts are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import Stage
from lateline.llm.secrets import default_vocabulary, load_encoding

#: The end mark, which also begins a stream; a free id of the vocabulary.
END = 50256
N_IDS = 50257
#: Window length, and ids of a window that only give context (but for the first).
WINDOW, CONTEXT = 32, 6
STEP = WINDOW - CONTEXT
#: Classes of the softmax; as many ids less GROUPS have a class of their own.
CLASSES, GROUPS = 256, 96
DIM, HIDDEN = 16, 32
#: Windows (about) that the driver learns from, and begins a model with if the fold
#: has more; it draws one for so many words at most, which is every id once.
HEAD_WINDOWS, WORDS_PER = 192_000, 32
#: Windows (about) that a task of the distributed training learns from, and its
#: rounds and rate.
TASK_WINDOWS, TURNS, TASK_RATE = 32_768, 2, 0.002
BATCH = 128
#: Words whose counts go to every task, at most (12 bytes each).
HEAD_WORDS = 2_000_000


# -- ids -------------------------------------------------------------------------

def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes know ASCII letters and blanks only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Ids:
    """Subword ids of a word sequence: each word with a blank before it.
    Ids of words are kept in a bounded cache."""

    def __init__(self, path: str, cache: int = 200_000):
        self.encode, self.cache, self.seen = load_encoding(path).encode_ordinary, cache, {}

    def word(self, w: bytes) -> bytes:
        if len(self.seen) >= self.cache:
            self.seen.clear()
        self.seen[w] = ids = np.array(self.encode(" " + w.decode("utf-8", "replace")), np.uint16).tobytes()
        return ids

    def stream(self, words: list[bytes]) -> np.ndarray:
        get, word = self.seen.get, self.word
        return np.frombuffer(b"".join([get(w) or word(w) for w in words]), np.uint16)


# -- the model -------------------------------------------------------------------

@dataclass
class LM:
    params: dict[str, np.ndarray]
    cls: np.ndarray        # id -> class
    share: np.ndarray      # id -> log share of its class

    def class_logits(self, x: np.ndarray, keep: slice = slice(None), safe: bool = False) -> np.ndarray:
        """Ids (windows x length) -> logits of the next id's class, a row for
        each kept place; ``safe`` guards the attention against scores out of
        range."""
        # one large product for each layer: windows are stacked, not looped over
        p = self.params
        n, t = x.shape
        e = p["ids"][x] + p["place"][:t]
        q, k, v = np.split((e.reshape(n * t, DIM) @ p["qkv"]).reshape(n, t, 3 * DIM), 3, axis=2)
        a = q[:, keep] @ k.transpose(0, 2, 1)
        a += MASK[:t, :t][keep]
        if safe:
            a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        o = a @ v
        o /= a.sum(2, keepdims=True)
        y = e[:, keep].reshape(-1, DIM) + o.reshape(-1, DIM) @ p["out"]
        u = y @ p["up"]
        u += p["up_b"]
        np.maximum(u, 0, out=u)
        y += u @ p["down"]
        logits = y @ p["cls"]
        logits += p["cls_b"]
        return logits


MASK = np.where(np.tril(np.ones((WINDOW, WINDOW), bool)), 0, -1e9).astype(np.float32)


def single_ids(counts: np.ndarray) -> np.ndarray:
    """The most frequent ids, which get a class each."""
    return np.argsort(-counts, kind="stable")[:CLASSES - GROUPS]


def make_classes(counts: np.ndarray, row: np.ndarray, col: np.ndarray, c: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Classes of ids, and each id's log share of its class, from the ids'
    counts.  The most frequent ids get a class each; the others are grouped by
    the company they keep: k-means on the frequent ids, or kinds of rare ones,
    that stand before and after them (``c`` times ``col`` beside id ``row``)."""
    single = CLASSES - GROUPS
    frequent = single_ids(counts)
    cls = np.full(len(counts), CLASSES - 1)         # ids that the fold lacks
    cls[frequent] = np.arange(single)
    rest = np.flatnonzero((counts > 0) & (cls == CLASSES - 1))
    rest = rest[np.argsort(-counts[rest], kind="stable")]
    if len(rest):
        at = np.full(len(counts), -1)
        at[rest] = np.arange(len(rest))
        f = np.zeros((len(rest), 2 * (single + 1)), np.float32)
        ok = at[row] >= 0
        np.add.at(f, (at[row[ok]], col[ok]), c[ok])
        f = np.sqrt(f / np.maximum(f.sum(1, keepdims=True), 1))
        k = min(GROUPS - 1, len(rest)) or 1
        mid = f[:k].copy()
        for _ in range(rounds):
            at = (f @ mid.T).argmax(1)
            sums = np.zeros_like(mid)
            np.add.at(sums, at, f * counts[rest][:, None].astype(np.float32))
            norm = np.linalg.norm(sums, axis=1)
            mid[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
        cls[rest] = single + at
    n = counts + 0.05
    return cls, np.log(n / np.bincount(cls, weights=n, minlength=CLASSES)[cls])


def init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    d, h, c = DIM, HIDDEN, CLASSES
    f = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    return {"ids": f(N_IDS, d, scale=0.3), "place": f(WINDOW, d, scale=0.1), "qkv": f(d, 3 * d, scale=d ** -0.5),
            "out": f(d, d, scale=d ** -0.5), "up": f(d, h, scale=d ** -0.5), "up_b": np.zeros(h, np.float32),
            "down": f(h, d, scale=h ** -0.5), "cls": f(d, c, scale=d ** -0.5), "cls_b": np.zeros(c, np.float32)}


def gradients(m: LM, x: np.ndarray, target: np.ndarray, ok: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean class loss over the places marked ok, and its gradients."""
    p = m.params
    n, t = x.shape
    e = p["ids"][x] + p["place"][:t]
    q, k, v = np.split(e @ p["qkv"], 3, axis=2)
    a = q @ k.transpose(0, 2, 1) + MASK[:t, :t]
    a = np.exp(a - a.max(2, keepdims=True))
    a /= a.sum(2, keepdims=True)
    o = a @ v
    y = e + o @ p["out"]
    pre = y @ p["up"] + p["up_b"]
    u = np.maximum(pre, 0)
    z = y + u @ p["down"]
    logits = z @ p["cls"] + p["cls_b"]
    logits -= logits.max(2, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(2, keepdims=True)
    i, j = np.indices(target.shape)
    loss = -np.log(prob[i, j, target] + 1e-30)[ok].mean()
    g = prob
    g[i, j, target] -= 1
    g *= (ok / max(1, ok.sum()))[:, :, None].astype(np.float32)
    grad = {}
    flat = lambda b: b.reshape(-1, b.shape[-1])
    grad["cls"], grad["cls_b"] = flat(z).T @ flat(g), flat(g).sum(0)
    dz = g @ p["cls"].T
    du = (dz @ p["down"].T) * (pre > 0)
    grad["down"] = flat(u).T @ flat(dz)
    grad["up"], grad["up_b"] = flat(y).T @ flat(du), flat(du).sum(0)
    dy = dz + du @ p["up"].T
    grad["out"] = flat(o).T @ flat(dy)
    do = dy @ p["out"].T
    da = do @ v.transpose(0, 2, 1)
    dv = a.transpose(0, 2, 1) @ do
    ds = a * (da - (da * a).sum(2, keepdims=True))
    dqkv = np.concatenate([ds @ k, ds.transpose(0, 2, 1) @ q, dv], 2)
    grad["qkv"] = flat(e).T @ flat(dqkv)
    de = dy + dqkv @ p["qkv"].T
    grad["place"] = np.zeros_like(p["place"])
    grad["place"][:t] = de.sum(0)
    rows, back = np.unique(x, return_inverse=True)
    sums = np.zeros((len(rows), DIM), np.float32)
    np.add.at(sums, back.reshape(-1), flat(de))
    grad["ids"] = (rows, sums)
    return float(loss), grad


def new_model(counts: np.ndarray, row: np.ndarray, col: np.ndarray, c: np.ndarray, seed: int = 11) -> LM:
    """An untrained model with the classes of these counts."""
    cls, share = make_classes(counts, row, col, c)
    m = LM(init(np.random.default_rng(seed)), cls, share)
    m.params["cls_b"] = np.log(np.bincount(cls, weights=counts, minlength=CLASSES) + 0.5).astype(np.float32)
    return m


def learn(m: LM, windows: np.ndarray, order: np.ndarray, rate: float) -> np.ndarray:
    """Adam on ``windows`` (ids, one more than WINDOW each), a batch for each
    row of ``order``; gives how often each id was learned from."""
    avg = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.params.items()}
    used = np.zeros(N_IDS)
    for step, pick in enumerate(order):
        w = windows[pick].astype(np.int64)
        x, target = w[:, :-1], w[:, 1:]
        # END END is the seam of two texts and not to be learned
        ok = ~((x == END) & (target == END))
        _, grad = gradients(m, x, m.cls[target], ok)
        lr = rate * min(1.0, (step + 1) / 20) * (1 - step / len(order))
        for k, g in grad.items():
            a, b = avg[k]
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            a[rows] = 0.9 * a[rows] + 0.1 * g
            b[rows] = 0.99 * b[rows] + 0.01 * g * g
            fix = 1 - 0.9 ** (step + 1), 1 - 0.99 ** (step + 1)
            m.params[k][rows] -= lr * (a[rows] / fix[0]) / (np.sqrt(b[rows] / fix[1]) + 1e-8)
            if k == "ids":
                used[rows] += 1
    return used


def train(streams: list[np.ndarray], *, steps: int = 1500, batch: int = BATCH, rate: float = 0.01, seed: int = 11) -> LM:
    """Streams of ids (without marks) -> the model, by Adam on random windows."""
    rng = np.random.default_rng(seed)
    all_ids = np.concatenate([np.concatenate([[END], s, [END]]) for s in streams]).astype(np.int64) if streams else np.array([END, END])
    counts = np.bincount(all_ids, minlength=N_IDS).astype(float)
    near = near_kinds(counts)
    m = new_model(counts, np.concatenate([all_ids[1:], all_ids[:-1]]),
                  np.concatenate([near[all_ids[:-1]], near[all_ids[1:]] + CLASSES - GROUPS + 1]), np.ones(2 * len(all_ids) - 2), seed)
    if len(all_ids) < WINDOW + 1:
        all_ids = np.resize(all_ids, WINDOW + 1)
    windows = np.lib.stride_tricks.sliding_window_view(all_ids, WINDOW + 1)
    learn(m, windows, rng.integers(0, len(windows), (steps, batch)), rate)
    return m


def near_kinds(counts: np.ndarray) -> np.ndarray:
    """id -> its turn among the frequent ids, or their number for all others."""
    near = np.full(N_IDS, CLASSES - GROUPS)
    near[single_ids(counts)] = np.arange(CLASSES - GROUPS)
    return near


def next_logs(m: LM, x: np.ndarray, keep: slice, nxt: np.ndarray, safe: bool = False) -> np.ndarray:
    """Log probability of the ids that follow the kept places."""
    with np.errstate(over="ignore", invalid="ignore"):
        logits = m.class_logits(x, keep, safe)
        if safe:
            logits -= logits.max(1, keepdims=True)
        flat = nxt.reshape(-1)
        hit = logits[np.arange(len(flat)), m.cls[flat]]
        np.exp(logits, out=logits)
        return (hit - np.log(logits.sum(1)) + m.share[flat]).reshape(nxt.shape)


def score_streams(m: LM, streams: list[np.ndarray], chunk: int = 192) -> np.ndarray:
    """Log10 probability of each stream and the end mark after it."""
    lens = np.array([len(s) + 1 for s in streams])
    if not len(lens):
        return np.zeros(0)
    mark = np.array([END], np.uint16)
    parts = [mark]
    for s in streams:
        parts += [s, mark]
    flat = np.concatenate(parts)                    # an end mark is the next text's begin mark
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    n_win = np.maximum(1, -(-(lens - CONTEXT) // STEP))
    doc = np.repeat(np.arange(len(lens)), n_win)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    start = first[doc] + turn * STEP
    stop = (first + lens)[doc]
    total = np.zeros(len(lens))
    ids = np.concatenate([flat, np.full(WINDOW + 1, END, np.uint16)]).astype(np.int64)
    place = np.arange(WINDOW)
    late = turn > 0
    for some, keep in ((np.flatnonzero(~late), slice(None)), (np.flatnonzero(late), slice(CONTEXT, None))):
        for i in range(0, len(some), chunk):
            w = some[i:i + chunk]
            at = start[w][:, None] + place
            x = ids[at]
            nxt = ids[at[:, keep] + 1]
            ok = at[:, keep] < stop[w][:, None]
            lp = next_logs(m, x, keep, nxt)
            if not np.isfinite(lp).all():
                lp = next_logs(m, x, keep, nxt, safe=True)
            lp = np.where(ok, lp, 0.0).sum(1)
            total += np.bincount(doc[w], weights=lp, minlength=len(lens))
    return total / math.log(10)


# -- texts -----------------------------------------------------------------------

def word_hash(w: bytes) -> int:
    return xxhash.xxh3_64_intdigest(w) - (1 << 63)


def count_words(rows: DataFrame, text: str) -> DataFrame:
    """``(word, c)``: counts of the words' 64-bit hashes over all rows."""

    def run(batches):
        def out(c):
            return pa.RecordBatch.from_arrays(
                [pa.array([word_hash(w) for w in c], pa.int64()), pa.array(list(c.values()), pa.int64())], names=["word", "c"])

        c: Counter = Counter()
        for b in batches:
            for x in b.column(0):
                c.update(lower_words(x.as_py()))
            if len(c) > 300_000:
                yield out(c)
                c = Counter()
        yield out(c)

    return rows.select(text).mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def count_pairs(rows: DataFrame, text: str, path: str) -> DataFrame:
    """``(a, b, c)``: how often id b follows id a, over all rows, end marks included."""

    def run(batches):
        def out(held):
            pair, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair // N_IDS, pa.int32()), pa.array(pair % N_IDS, pa.int32()), pa.array(c, pa.int64())], names=["a", "b", "c"])

        ids, held, n = Ids(path), [], 0
        for b in batches:
            for x in b.column(0):
                s = np.concatenate([[END], ids.stream(lower_words(x.as_py())), [END]]).astype(np.int64)
                held.append(s[:-1] * N_IDS + s[1:])
                n += len(s)
                if n > 2_000_000:
                    yield out(held)
                    held, n = [], 0
        if held:
            yield out(held)

    return rows.where(F.col(text).isNotNull()).select(text).mapInArrow(run, "a int, b int, c long").groupBy("a", "b").agg(F.sum("c").alias("c"))


def count_company(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of all ids, and of the kinds of ids beside the less frequent
    ones (``make_classes``); at most N_IDS times the kinds are gathered."""
    got = pairs.groupBy("b").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(N_IDS)
    counts[got.column("b").to_numpy()] = got.column("c").to_numpy()
    kinds = CLASSES - GROUPS + 1
    frequent = pairs.sparkSession.createDataFrame([(int(i), k) for k, i in enumerate(single_ids(counts))], "id int, kind int")
    kind = lambda c, name: F.broadcast(frequent.select(F.col("id").alias(c), F.col("kind").alias(name)))
    p = pairs.join(kind("a", "ka"), "a", "left").join(kind("b", "kb"), "b", "left")
    both = p.where("kb is null").groupBy(F.col("b").alias("id"), F.coalesce("ka", F.lit(kinds - 1)).alias("near")).agg(F.sum("c").alias("c"))
    both = both.union(p.where("ka is null").groupBy(F.col("a").alias("id"), (F.coalesce("kb", F.lit(kinds - 1)) + kinds).alias("near")).agg(F.sum("c").alias("c")))
    got = both.select("id", F.col("near").cast("short").alias("near"), F.col("c").cast("float").alias("c")).toArrow()
    return counts, *(got.column(k).to_numpy() for k in ("id", "near", "c"))


def draw_windows(rows: DataFrame, text: str, key: str, path: str, per_word: float) -> DataFrame:
    """``(h, ids)``: windows that begin at random ids of whole texts, about
    ``per_word`` for each word and end mark; the same in every run."""
    rows = rows.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("text"))

    def run(batches):
        ids = Ids(path)
        for b in batches:
            hs, out = [], []
            for h, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ws = lower_words(x.as_py())
                rng = np.random.default_rng(h & ((1 << 64) - 1))
                n = int((len(ws) + 1) * per_word + rng.random())
                for i in rng.integers(-1, len(ws), n).tolist():  # -1: the mark at which the text begins
                    # each word has an id at least
                    s = ids.stream(ws[max(i, 0):i + WINDOW + 1])
                    if i < 0:
                        s = np.append(np.uint16(END), s)
                    else:
                        s = s[int(rng.integers(0, max(1, len(ids.stream(ws[i:i + 1]))))):]
                    s = s[:WINDOW + 1]
                    out.append(np.append(s, np.full(WINDOW + 1 - len(s), END, np.uint16)).tobytes())
                    hs.append(int(rng.integers(-(1 << 63), 1 << 63)))
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(out, pa.binary())], names=["h", "ids"])

    return rows.mapInArrow(run, "h long, ids binary")


def cut_windows(rows: DataFrame, text: str, key: str, path: str) -> DataFrame:
    """``(h, ids)``: all windows of all texts.  Each begins with the last id of
    the one before, so every id and end mark is learned from once; ``h`` puts
    them in an order that is the same in every run."""
    rows = rows.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("text"))

    def run(batches):
        ids = Ids(path)
        for big in batches:
            for lo in range(0, big.num_rows, 256):
                b = big.slice(lo, 256)
                hs, out = [], []
                for h, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    s = ids.stream(lower_words(x.as_py()))
                    n = -(-(len(s) + 1) // WINDOW)
                    w = np.full(n * WINDOW + 1, END, np.uint16)
                    w[1:len(s) + 1] = s
                    out += [v.tobytes() for v in np.lib.stride_tricks.sliding_window_view(w, WINDOW + 1)[::WINDOW]]
                    hs.append(np.random.default_rng(h & ((1 << 64) - 1)).integers(-(1 << 63), 1 << 63, n))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs), pa.int64()), pa.array(out, pa.binary())], names=["h", "ids"])

    return rows.mapInArrow(run, "h long, ids binary")


def as_windows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, WINDOW + 1)


def learn_in_tasks(m: LM, windows: DataFrame, n: int) -> None:
    """Every task learns from its windows, beginning with the model as it is;
    the tasks' models are averaged (an id's vector by how often it was used)
    and a new round begins.  Parameters travel as rows of DIM numbers, so what
    the driver gets is of the model's size whatever the number of tasks."""
    names = [k for k in m.params if k != "ids"]
    tasks = max(1, n // TASK_WINDOWS)
    dealt = windows.repartition(tasks, "h").sortWithinPartitions("h", "ids")
    for turn in range(TURNS):
        shared = windows.sparkSession.sparkContext.broadcast(m)

        def run(batches, shared=shared, rate=TASK_RATE / 2 ** turn):
            w = [as_windows(b.column(1)) for b in batches if b.num_rows]
            if not w:
                return
            w = np.concatenate(w)
            old = shared.value
            new = LM({k: v.copy() for k, v in old.params.items()}, old.cls, old.share)
            steps = max(1, len(w) // BATCH)
            # every window once, in the order of the hash
            used = learn(new, w, np.arange(len(w))[:steps * BATCH].reshape(steps, -1) if len(w) >= BATCH else np.arange(len(w))[None], rate)
            at = np.flatnonzero(used)
            flat = np.concatenate([new.params[k].reshape(-1) for k in names]).reshape(-1, DIM)
            v = np.concatenate([new.params["ids"][at], flat]).astype(np.float64)
            row = np.concatenate([at, N_IDS + np.arange(len(flat))])
            weight = np.concatenate([used[at], np.full(len(flat), float(len(w)))])
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(weight), *(pa.array(v[:, i] * weight) for i in range(DIM))],
                                             names=["row", "w", *(f"v{i}" for i in range(DIM))])

        got = dealt.mapInArrow(run, "row int, w double, " + ", ".join(f"v{i} double" for i in range(DIM)))
        got = got.groupBy("row").agg(F.sum("w").alias("w"), *(F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM))).orderBy("row").toArrow()
        row = got.column("row").to_numpy()
        v = np.stack([got.column(f"v{i}").to_numpy() for i in range(DIM)], 1) / got.column("w").to_numpy()[:, None]
        v = v.astype(np.float32)
        params = dict(m.params)
        params["ids"] = params["ids"].copy()
        params["ids"][row[row < N_IDS]] = v[row < N_IDS]
        flat, at = v[row >= N_IDS].reshape(-1), 0
        for k in names if len(flat) else ():
            params[k] = flat[at:at + params[k].size].reshape(params[k].shape)
            at += params[k].size
        m.params = params


def fit(stage: Stage, rows: DataFrame, text: str, key: str, path: str, n_words: int, *, steps: int = 1500, rate: float = 0.01, seed: int = 11) -> LM:
    """The model of a training fold of ``n_words`` words and end marks.  All its
    windows are learned from: by the driver if they are few; else the driver
    begins the model with some, and the tasks learn from all."""
    m = new_model(*count_company(stage.save(count_pairs(rows, text, path), "pairs")), seed)
    cut = stage.save(cut_windows(rows, text, key, path), "windows")
    n = cut.count()
    few = n <= HEAD_WINDOWS * 1.1
    got = (cut if few else draw_windows(rows, text, key, path, min(1 / WORDS_PER, HEAD_WINDOWS / max(1, n_words)))).toArrow()
    w = as_windows(got.column("ids"))
    w = w[np.lexsort((*w.T[::-1], got.column("h").to_numpy()))] if len(w) else np.full((1, WINDOW + 1), END, np.uint16)
    if few:
        steps = max(steps, -(-len(w) // BATCH))
    # whole turns through the windows, each in another order
    rng = np.random.default_rng(seed)
    turns = -(-steps * BATCH // len(w))
    learn(m, w, np.concatenate([rng.permutation(len(w)) for _ in range(turns)])[:steps * BATCH].reshape(steps, BATCH), rate)
    if not few:
        learn_in_tasks(m, cut, n)
    stage.drop(cut)
    return m


def score_texts(docs: DataFrame, train_rows: Column, *, doc_id: str = "doc_id", text: str = "text",
                vocabulary: str | None = None, steps: int = 1500) -> DataFrame:
    """Per row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    Rows where ``train_rows`` holds are learned from, whole: for the word
    counts, the classes of ids and the attention model.  Every row is scored on its whole text; null texts are
    empty and have the end mark alone.  Repeated rows count as often as they
    occur; an empty table gives an empty result; other columns are ignored.
    """
    spark, stage = docs.sparkSession, Stage(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    rows = docs.where(train_rows)
    counts = stage.save(count_words(rows, text), "counts")
    got = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_docs = rows.count()
    n_train = (got["n"] or 0) + n_docs
    n_kinds = got["v"] + (1 if n_docs else 0)
    norm = math.log10(n_train + n_kinds + 1)
    end = math.log10(n_docs + 1)
    # the least count at which the frequent words are few enough
    least, have = 1, 0
    for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).toArrow().to_pylist():
        have += r["n"]
        if have > HEAD_WORDS:
            least = r["c"] + 1
            break
    head = counts.where(F.col("c") >= least).toArrow()
    order = np.argsort(head.column("word").to_numpy())
    model = fit(stage, rows, text, doc_id, path, n_train, steps=steps)
    shared = spark.sparkContext.broadcast(
        (model, head.column("word").to_numpy()[order], np.log10(head.column("c").to_numpy()[order] + 1.0), least == 1))
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m, words, logs, all_here = shared.value
        ids, uid = Ids(path), TaskContext.get().partitionId() << 40
        seen: dict[bytes, float] = {}               # log10(count + 1); nan: not among the frequent words

        def look_up(ws):
            if len(seen) > 300_000:
                seen.clear()
            new = [w for w in set(ws) if w not in seen]
            if new:
                h = np.array([word_hash(w) for w in new], np.int64)
                at = np.minimum(np.searchsorted(words, h), max(0, len(words) - 1))
                hit = words[at] == h if len(words) else np.zeros(len(h), bool)
                v = np.where(hit, logs[at], 0.0 if all_here else np.nan) if len(words) else np.full(len(h), 0.0 if all_here else np.nan)
                seen.update(zip(new, v.tolist(), strict=True))
            return np.array([seen[w] for w in ws])

        for big in batches:
            for lo in range(0, big.num_rows, 256):
                b = big.slice(lo, 256)
                cols = {k: [] for k in ("n", "known", "sum", "tail")}
                streams = []
                for x in b.column(1):
                    ws = lower_words(x.as_py())
                    try:
                        v = np.array([seen[w] for w in ws])
                    except KeyError:
                        v = look_up(ws)
                    rare = np.isnan(v)
                    cols["n"].append(len(ws) + 1)
                    cols["known"].append(int((v > 0).sum()) + (1 if n_docs else 0))
                    cols["sum"].append(float(v[~rare].sum()) + end)
                    cols["tail"].append([{"word": word_hash(w), "n": c} for w, c in Counter(ws[i] for i in np.flatnonzero(rare)).items()])
                    streams.append(ids.stream(ws))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(uid, uid + b.num_rows), pa.int64()), b.column(0), pa.array(cols["n"], pa.int64()),
                     pa.array(cols["known"], pa.int64()), pa.array(cols["sum"], pa.float64()),
                     pa.array(score_streams(m, streams), pa.float64()),
                     pa.array(cols["tail"], pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())])))],
                    names=["uid", "doc_id", "n_tokens", "known", "sum", "score", "tail"])
                uid += b.num_rows

    schema = f"uid long, doc_id {kind}, n_tokens long, known long, sum double, score double, tail array<struct<word:long,n:long>>"
    rows = stage.save(src.mapInArrow(run, schema), "rows")
    tail = rows.select("uid", F.inline("tail"))
    rare = counts.where(F.col("c") < least)
    more = tail.join(rare, "word").groupBy("uid").agg(
        F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("add"))
    out = rows.drop("tail").join(more, "uid", "left")
    total = F.col("sum") + F.coalesce("add", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)
    return out.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                      F.lit(n_train).cast("long").alias("train_tokens"), total.alias("base_score"), "score")
