"""Best-fit packing of token pieces into sequences of a fixed length.

The plan is made from the histogram of piece lengths alone: patterns of two or
three lengths that fill a sequence exactly are enumerated, repeat counts are
fitted to the histogram by non-negative least squares and rounded, and what is
left is packed best-fit, longest first, length by length.  The plan maps the
r-th piece of a length to a sequence and a place in it, so assigning the
pieces is a distributed ranking and a look-up; no task sees more than its
share, however many pieces have one length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.common import Stage
from lateline.llm.secrets import default_vocabulary, load_encoding

#: Fixed values of the contract.
SEQUENCE = 2048
SEPARATOR = 0

#: Pieces of one ranking bucket, on average; a parameter of the layout only.
BUCKET_ROWS = 500


# -- the plan, from a histogram ------------------------------------------------

def patterns(counts: np.ndarray, size: int) -> np.ndarray:
    """All (a, b, c) with a <= b <= c and a + b + c = size whose lengths occur;
    a = 0 stands for a pattern of two."""
    have = counts > 0
    have[0] = True
    out = []
    for a in range(0, size // 3 + 1):
        if have[a]:
            b = np.arange(max(a, 1), (size - a) // 2 + 1)
            c = size - a - b
            ok = have[b] & have[c]
            out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit_repeats(pats: np.ndarray, counts: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative least squares: repeat counts x >= 0 that minimise the
    squared difference between the lengths used and the histogram.  Scaled
    multiplicative steps, which never leave x >= 0; each costs one pass over
    the patterns' three lengths."""
    n = len(counts)
    target = counts.astype(float)
    target[0] = 0.0

    def used(x):
        y = sum(np.bincount(pats[:, j], weights=x, minlength=n) for j in range(3))
        y[0] = 0.0
        return y

    # a start in proportion to how often the lengths of a pattern occur
    rate = np.maximum(target / max(target.sum(), 1.0), 1e-12)
    rate[0] = 1.0 / max(1, n)
    x = rate[pats].prod(1)
    x *= target.sum() / max(used(x).sum(), 1e-300)
    up = sum(target[pats[:, j]] for j in range(3))
    for _ in range(rounds):
        y = used(x)
        x *= up / np.maximum(sum(y[pats[:, j]] for j in range(3)), 1e-300)
    return x


def plan_counts(counts: np.ndarray, size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Histogram of lengths (index 1 to ``size``) -> (lengths of a sequence,
    number of such sequences); every piece is in exactly one."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        plan.append(((size,), int(left[size])))
        left[size] = 0
    pats = patterns(left, size)
    if len(pats):
        x = fit_repeats(pats, left)
        # running sums are rounded, so small repeat counts do not all vanish
        edge = np.floor(np.cumsum(x) + 0.5).astype(np.int64)
        repeat = np.diff(edge, prepend=0)
        for i in np.flatnonzero(repeat):
            lengths = [int(v) for v in pats[i] if v]
            need = {v: lengths.count(v) for v in lengths}
            n = min(int(repeat[i]), *(int(left[v]) // k for v, k in need.items()))
            if n > 0:
                plan.append((tuple(sorted(lengths, reverse=True)), n))
                for v, k in need.items():
                    left[v] -= k * n
    # residuals: best fit, longest first, on counts of open sequences by room
    opened: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    rooms = np.zeros(size + 1, np.int64)
    for length in range(size - 1, 0, -1):
        n = int(left[length])
        while n:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                pat, k = opened[room].popitem()
                use = min(n, k)
                if use < k:
                    opened[room][pat] = k - use
                rooms[room] -= use
            else:
                # none has room: as many of this length as a sequence holds go together
                per = min(size // length, n)
                use, pat = n // per, (length,) * (per - 1)
                room = size - length * (per - 1)
                n -= use * (per - 1)
            new, rest = (*pat, length), room - length
            n -= use
            opened[rest][new] = opened[rest].get(new, 0) + use
            rooms[rest] += use
    for by in opened.values():
        plan += by.items()
    return plan


class Slots:
    """The plan as sorted look-up arrays: ranks of a length -> sequence, offset.
    Its size is bounded by the number of patterns, not by that of the pieces."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]]):
        length, repeat, seq, offset = [], [], [], []
        first = 0
        for lengths, n in plan:
            at = 0
            for v in lengths:
                length.append(v)
                repeat.append(n)
                seq.append(first)
                offset.append(at)
                at += v
            first += n
        self.n_sequences = first
        length, repeat = np.array(length, np.int64), np.array(repeat, np.int64)
        order = np.argsort(length, kind="stable")
        self.length, self.seq, self.offset = length[order], np.array(seq, np.int64)[order], np.array(offset, np.int64)[order]
        self.end = np.cumsum(repeat[order])
        self.start = self.end - repeat[order]
        lo = np.searchsorted(self.length, np.arange(SEQUENCE + 2))
        self.base = np.concatenate([self.start, [self.end[-1] if len(self.end) else 0]])[lo]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.base[length] + rank
        i = np.searchsorted(self.end, at, side="right")
        return self.seq[i] + at - self.start[i], self.offset[i]


# -- tokens and pieces ---------------------------------------------------------

def cut_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of a document of n ids: whole sequences, after a
    shorter first piece where n is no multiple."""
    if n <= size:
        return [n]
    first = n % size
    return ([first] if first else []) + [size] * (n // size)


def pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           size: int = SEQUENCE) -> DataFrame:
    """One row per piece of every whole text: ``doc_id, piece, start, length,
    ids_crc32`` and ``row_no``, the row's number within its task."""
    path = vocabulary or default_vocabulary()
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, row_no long"

    def run(batches):
        enc = load_encoding(path, {"<|endoftext|>": 50256})
        row_no = 0
        for b in batches:
            take, piece, start, length, crc = [], [], [], [], []
            for i, x in enumerate(b.column(1)):
                ids = enc.encode_to_numpy(x.as_py() or "", allowed_special="all").astype("<u4")
                ids = np.append(ids, np.uint32(SEPARATOR))
                at = 0
                for k, n in enumerate(cut_lengths(len(ids), size)):
                    take.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(ids[at:at + n].astype("<u4").tobytes()))
                    at += n
            n = len(take)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                pa.array(range(row_no, row_no + n), pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "row_no"])
            row_no += n

    return src.mapInArrow(run, schema)


def pack(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Pack the whole texts of ``docs`` into sequences of 2048 ids.

    Returns per piece ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``.  Ids are those of the byte-level vocabulary (special token
    strings are their one id), then the separator id 0; a null text is empty
    and has the separator alone.  Repeated rows are packed each; an empty
    table gives an empty result; other columns are ignored.
    """
    spark, stage = docs.sparkSession, Stage(docs.sparkSession)
    p = stage.save(pieces(docs, doc_id=doc_id, text=text, vocabulary=vocabulary), "pieces")
    # ranks within a length: buckets by hash, bucket totals summed up before
    hist = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(SEQUENCE + 1, np.int64)
    for k, n in hist.items():
        counts[k] = n
    slots = spark.sparkContext.broadcast(Slots(plan_counts(counts)))
    # a frequent length has more buckets; row_no was written with the piece, so
    # the bucket stays the same on a re-read
    lengths = spark.createDataFrame([(k, -(-n // BUCKET_ROWS)) for k, n in hist.items()], "length long, n_buckets long")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "row_no"), F.col("n_buckets"))
    p = p.join(F.broadcast(lengths), "length").withColumn("bucket", bucket).drop("n_buckets")
    totals = p.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    totals = stage.save(totals.select("length", "bucket", before.alias("before")), "totals")
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "row_no")) - 1
    ranked = p.withColumn("rank", rank).join(totals, ["length", "bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    kind = ranked.schema["doc_id"].dataType.simpleString()

    def assign(batches):
        s = slots.value
        for b in batches:
            seq, off = s.place(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(assign, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
