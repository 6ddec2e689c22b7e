"""Exact substring dedup by a distributed difference-cover suffix array.

Texts are bytes.  The least of the 8-byte hashes in every window of 48 places
is an anchor; where anchors lie depends on the bytes around them only, so equal
strings have equal anchors inside.  What lies between two anchors is a phrase,
and the texts become strings of phrases, some twenty-fifth as long.  On these
the difference-cover algorithm runs, on tables that Spark shuffles:

1. the suffixes at places 1 and 2 modulo 3 are the sample; their triples of
   phrases are sorted and named by rank;
2. an anchor stays only if, for some residue of a partner, the triples at all
   shifts that put both into the sample occur again; the rest is unique;
3. the sample is sorted by its names, two triples long, which is as deep as an
   answer needs; the remaining suffixes, at places 0, are sorted by phrase and
   the following sampled suffix, and merged with the sample: against place 1
   by one phrase and the suffix after it, against place 2 by two;
4. adjacent suffixes whose first six phrases are equal form a class.

Every string of 400 bytes begins at most 47 bytes before its first anchor and
contains six phrases after it, so its copies are in one class.  Within the
classes the exact check follows: first all strings of an anchor at once (one
hash of their union), then, where some of a class are not equal throughout,
each string by its own hash.

The unit that meets the answers again is a block of documents.  Equal rows are
first counted within the block, then aggregated by content, so a passage of
many documents is one row.  A task holds a block, or one bucket of the sorted
names, and about 70 bytes for each byte of its longest text.

Odd rows: null and empty texts have no bytes; texts shorter than the length
stay whole; a doc_id may be null or repeated, its rows are separate and equal
texts are each other's copies, so nothing is kept of both.  An empty table
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lateline.llm.common import Stage
from lateline.llm.jaccard import _C1, mix64, seed64

#: Fixed value of the contract: bytes of a string that must not occur again.
LENGTH = 400
#: Bytes hashed at a place, places of a window, and phrases that a string has after its first anchor.
GRAM, WINDOW, PHRASES = 8, 48, 6
#: Bytes after its first anchor in which a string's anchors do not depend on what surrounds it, and shifts looked at.
SPAN, SHIFTS = LENGTH - 2 * WINDOW - GRAM + 2, 12
#: Bytes of a block of documents, rows of a bucket of names, and strings of a bucket, on average.
BLOCK, BUCKET, STRINGS = 1 << 18, 2048, 1 << 18
#: Contents of a class from which on its strings are spread over all buckets.
LARGE = 4096

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _C1)
_BASE = _C1 | np.uint64(1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = np.uint64((1 << 32) - 1)
#: Blocks that go to Python at once, and shuffle files that go when a stage is written.
_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
             "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the stages written inside; the session's own come back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# -- one block ------------------------------------------------------------------------

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + (BLOCK >> 2))
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x)]), dtype=np.uint64) for x in (_BASE, _BACK)]
    return _POWERS[0][:n], _POWERS[1][:n]


class Text:
    """The bytes of a block with prefix sums of a polynomial in an odd base, modulo 2^64."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, self.ends = data, ends
        up, self.back = _powers(len(data) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * up[:-1], dtype=np.uint64)])

    def hashes(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        """63-bit hashes of strings [start, end), their lengths mixed in."""
        x = (self.sums[end] - self.sums[start]) * self.back[start]
        return (mix64(x + (end - start).astype(np.uint64) * _C1 + seed64(seed)) >> np.uint64(1)).astype(np.int64)

    def first(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)


class Anchors:
    """Anchors of a block: ``at``; ``lo`` to ``hi``, the strings of ``LENGTH``
    bytes that begin there and have this first anchor (none if hi < lo); ``h``,
    the phrase up to the next anchor (0 at a text's last); ``q``, the place in
    the text's string of phrases."""

    def __init__(self, t: Text):
        n = len(t.data)
        wide = WINDOW + GRAM - 1
        z = np.zeros(0, np.int64)
        self.at = self.lo = self.hi = self.h = self.q = z
        if n < wide:
            return
        x = (t.sums[GRAM:] - t.sums[:-GRAM]) * t.back[:n - GRAM + 1]
        x = (x ^ (x >> np.uint64(29))) * _C1
        x &= ~_PLACE
        x |= np.arange(len(x), dtype=np.uint64)
        step = 1
        while step * 2 <= WINDOW:
            x = np.minimum(x[:-step], x[step:])
            step *= 2
        rest = WINDOW - step
        if rest:
            x = np.minimum(x[:-rest], x[rest:])
        # windows that lie in one text
        first = t.first()
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, np.maximum(t.ends - wide + 1, first), 1)
        np.add.at(edge, t.ends, -1)
        inside = np.flatnonzero(np.cumsum(edge)[:len(x)] == 0)
        least = (x[inside] & _PLACE).astype(np.int64)
        if not len(least):
            return
        new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.at = least[new]
        self.lo = inside[new]
        text = np.searchsorted(t.ends, self.at, "right")
        self.hi = np.minimum(inside[np.append(new[1:], len(inside)) - 1], t.ends[text] - LENGTH)
        same = np.append(text[1:] == text[:-1], False)
        nxt = np.append(self.at[1:], 0)
        self.h = np.where(same, t.hashes(self.at, np.where(same, nxt, self.at), 1), 0)
        start = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        self.q = np.arange(len(text)) - np.repeat(start, np.diff(np.append(start, len(text))))
        self.left = np.repeat(np.append(start[1:], len(text)), np.diff(np.append(start, len(text)))) - np.arange(len(text))

    def ahead(self, v: np.ndarray, k: int) -> np.ndarray:
        """The value k anchors further on in the same text, else 0."""
        out = np.zeros(len(v), np.int64)
        if k < len(v):
            out[:len(v) - k] = np.where(self.left[:len(v) - k] > k, v[k:], 0)
        return out

    def sample(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Sampled anchors, the number of the triple of each, and of the
        distinct triples their counts and three phrases."""
        s = np.flatnonzero(self.q % 3 != 0) if len(self.at) else np.zeros(0, np.int64)
        three = [self.h[s], *(self.ahead(self.h, k)[s] for k in (1, 2))] if len(self.at) else [s, s, s]
        key = np.zeros(len(s), np.uint64)
        for v in three:
            key = mix64(key * _C1 + v.astype(np.uint64))
        _, one, slot, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return s, slot, one, count, [v[one] for v in three]


def kept_anchors(t: Text, names: np.ndarray, again: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors that may begin a repeated string, with the keys of the merge.
    ``names`` and ``again`` are those of the block's distinct sampled triples."""
    a = Anchors(t)
    s, slot, *_ = a.sample()
    name, rep = np.zeros(len(a.at), np.int64), np.zeros(len(a.at), np.int64)
    name[s], rep[s] = names[slot], again[slot]
    # a partner has any residue; at every shift at which both are sampled, and whose
    # triple lies in the string, the triple must occur again
    may = np.zeros(len(a.at), bool)
    for c in range(3):
        ok = (a.q + c) % 3 != 0
        for shift in range(c, SHIFTS, 3):
            end = a.ahead(a.at, shift + 3)
            ok &= (a.ahead(rep, shift) if shift else rep).astype(bool) | (end == 0) | (end - a.at > SPAN)
        may |= ok
    k = np.flatnonzero(may & (a.lo <= a.hi))
    get = lambda v, i: a.ahead(v, i)[k] if i else v[k]
    end = get(a.at, PHRASES)
    lo, hi, cls = a.lo[k], a.hi[k], a.q[k] % 3
    # a class compares by some of the keys only
    own, one, two = (lambda v, i: np.where(cls != 0, get(v, i), 0)), (lambda v, i: np.where(cls != 2, get(v, i), 0)), (lambda v, i: np.where(cls != 1, get(v, i), 0))
    return {"cls": cls, "h": a.h[k], "h1": two(a.h, 1), "o1": own(name, 0), "o2": own(name, 3), "a1": one(name, 1), "a2": one(name, 4),
            "b1": two(name, 2), "b2": two(name, 5), "p": t.hashes(a.at[k], end, 2), "f": t.hashes(lo, hi + LENGTH, 3), "lo": lo, "width": hi - lo + 1}


def merged_order(cls: np.ndarray, own: list[np.ndarray], one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Order of suffixes: the sampled ones (classes 1 and 2) by their names
    ``own``, merged with those of class 0, which compare with class 1 by
    ``one`` (phrase, next suffix's names) and with class 2 by ``two``."""

    def codes(rows: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        order = np.lexsort([k[rows] for k in reversed(keys)])
        differs = np.zeros(len(rows), bool)
        for k in keys:
            v = k[rows][order]
            differs[1:] |= v[1:] != v[:-1]
        out = np.zeros(len(cls), np.int64)
        out[rows[order]] = np.cumsum(differs)
        return out

    zero, first, second = (np.flatnonzero(cls == c) for c in (0, 1, 2))
    sampled = np.flatnonzero(cls != 0)
    code1, code2 = codes(np.flatnonzero(cls != 2), one), codes(np.flatnonzero(cls != 1), two)
    place = np.zeros(len(cls), np.int64)
    place[sampled[np.lexsort([k[sampled] for k in reversed(own)])]] = np.arange(len(sampled))
    place[zero[np.lexsort([code2[zero], code1[zero]])]] = np.arange(len(zero))
    less1, less2 = np.sort(code1[zero]), np.sort(code2[zero])
    place[first] += np.searchsorted(less1, code1[first])
    place[second] += np.searchsorted(less2, code2[second])
    place[zero] += np.searchsorted(np.sort(code1[first]), code1[zero]) + np.searchsorted(np.sort(code2[second]), code2[zero])
    return np.argsort(place, kind="stable")


def classes(t: pa.Table, large: int = LARGE) -> pa.Table:
    """Of the contents of one bucket those that share their first six phrases
    with an adjacent suffix, or occur twice themselves; ``all`` if the content
    occurs again in full, ``mixed`` if some of its class does not, ``large`` if
    the class has many contents."""
    c = {k: t.column(k).to_numpy() for k in ("cls", "h", "h1", "o1", "o2", "a1", "a2", "b1", "b2", "p", "n")}
    order = merged_order(c["cls"], [c["o1"], c["o2"]], [c["h"], c["a1"], c["a2"]], [c["h"], c["h1"], c["b1"], c["b2"]])
    p, full = c["p"][order], c["n"][order] > 1
    start = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    size = np.diff(np.append(start, len(p)))
    every = np.logical_and.reduceat(full, start)
    keep = np.repeat((size > 1) | every, size)
    out = t.take(pa.array(order)).select(["p", "f", "n", "block", "lo", "width"])
    out = out.append_column("all", pa.array(full)).append_column("mixed", pa.array(np.repeat(~every, size)))
    out = out.append_column("large", pa.array(np.repeat(size > large, size)))
    return out.filter(pa.array(keep))


# -- tables --------------------------------------------------------------------------

def _blocks(docs: DataFrame, kind: str) -> DataFrame:
    """Documents in blocks: ids, ends of the texts, bytes."""

    def run(batches):
        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def out():
            ends = np.cumsum([len(x) for x in texts], dtype=np.int64).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([ends], pa.binary()),
                                               pa.array([b"".join(texts)], pa.binary())], names=["block", "ids", "ends", "data"])

        for b in batches:
            id_type = b.schema.field(0).type
            for i, x in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                texts.append(x or b"")
                size += len(texts[-1])
                if size >= BLOCK or len(ids) >= 4096:
                    yield out()
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield out()

    return docs.mapInArrow(run, f"block long, ids array<{kind}>, ends binary, data binary")


def _text(ends: bytes, data: bytes) -> Text:
    return Text(np.frombuffer(data, np.uint8), np.frombuffer(ends, np.int64))


def _triples(blocks: DataFrame) -> DataFrame:
    """Distinct sampled triples of each block."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                _, _, _, count, three = Anchors(_text(b.column(1)[i].as_py(), b.column(2)[i].as_py())).sample()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(count), b.column(0)[i].as_py(), np.int64)), pa.array(np.arange(len(count), dtype=np.int32)),
                     *(pa.array(v) for v in three), pa.array(count.astype(np.int32))], names=["block", "slot", "h", "h1", "h2", "n"])

    return blocks.select("block", "ends", "data").mapInArrow(run, "block long, slot int, h long, h1 long, h2 long, n int")


def _bits(rows: int) -> int:
    return max(0, min(30, (rows // BUCKET).bit_length()))


def _bucket(h: str, rows: int):
    """Leading bits of a phrase's hash: an order-preserving, even split."""
    return F.shiftright(h, 63 - _bits(rows))


def _named(triples: DataFrame, rows: int) -> DataFrame:
    """Sorted triples, named by bucket and rank in it; ``again`` if one occurs more than once."""
    ranked = Window.partitionBy("bucket").orderBy("h", "h1", "h2")
    equal = Window.partitionBy("bucket", "h", "h1", "h2")
    return (triples.withColumn("bucket", _bucket("h", rows))
            .select("block", "slot", (F.shiftleft("bucket", 32) + F.dense_rank().over(ranked)).alias("name"),
                    (F.sum("n").over(equal) > 1).alias("again")))


_KEYS = ("cls", "h", "h1", "o1", "o2", "a1", "a2", "b1", "b2")


def _kept(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct contents of the anchors that stay, per block, with the merge's
    keys of one of them and the places of all."""
    schema = "block long, p long, f long, n long, width int, places binary, lo long, " + ", ".join(f"{k} long" for k in _KEYS)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left.column("block")[0].as_py()
        t = _text(left.column("ends")[0].as_py(), left.column("data")[0].as_py())
        slot = right.column("slot").to_numpy()
        name, again = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        name[slot], again[slot] = right.column("name").to_numpy(), right.column("again").to_numpy()
        k = kept_anchors(t, name, again)
        order = np.argsort(k["f"], kind="stable")
        f = k["f"][order]
        start = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]])) if len(f) else np.zeros(0, np.int64)
        one, ends = order[start], np.append(start[1:], len(f))[:len(start)]
        places, at = k["lo"][order].astype(np.int64), (np.append(start, len(f)) * 8).astype(np.int32)
        return pa.table({"block": np.full(len(one), block, np.int64), "p": k["p"][one], "f": k["f"][one], "n": (ends - start).astype(np.int64),
                         "width": k["width"][one].astype(np.int32),
                         "places": pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(at), pa.py_buffer(places)]),
                         "lo": k["lo"][one].astype(np.int64), **{c: k[c][one].astype(np.int64) for c in _KEYS}})

    return blocks.select("block", "ends", "data").groupBy("block").cogroup(names.groupBy("block")).applyInArrow(run, schema)


def _strings(blocks: DataFrame, mixed: DataFrame, buckets: int) -> DataFrame:
    """The single strings of each content, packed by bucket: a row has those of
    one block.  Bucket -1 has what occurs again in the block itself; its strings
    are in their buckets once.  A class is in one bucket, a large one in all."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        t = _text(left.column("ends")[0].as_py(), left.column("data")[0].as_py())
        c = {k: right.column(k).to_numpy() for k in ("p", "content", "lo", "width", "n", "large")}
        row = np.repeat(np.arange(len(c["lo"])), c["width"])
        off = np.arange(len(row)) - np.repeat(np.cumsum(c["width"]) - c["width"], c["width"])
        lo = c["lo"][row] + off
        own = t.hashes(lo, lo + LENGTH, 4).astype(np.uint64)
        p = c["p"].astype(np.uint64)[row]
        key = mix64(mix64(p) + own)
        bucket = mix64(p ^ np.where(c["large"][row], own, np.uint64(0))) % np.uint64(buckets)
        _, first, group, number = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        again = (number > 1)[group] | (c["n"][row] > 1)
        one = np.zeros(len(row), bool)
        one[first] = True
        any_again = np.zeros(len(first), bool)
        any_again[group[again]] = True
        here = np.flatnonzero(any_again[group])
        rows = np.flatnonzero(one)
        rows = rows[np.argsort(bucket[rows], kind="stable")]
        start = np.flatnonzero(np.concatenate([[True], bucket[rows][1:] != bucket[rows][:-1]])) if len(rows) else np.zeros(0, np.int64)
        packed = [here, *np.split(rows, start[1:])] if len(rows) else [here]
        number = [-1, *bucket[rows[start]].astype(np.int64).tolist()]
        return pa.table({"bucket": pa.array(number[:len(packed)], pa.int64()),
                         "keys": pa.array([key[x].tobytes() for x in packed], pa.binary()),
                         "again": pa.array([any_again[group[x]].tobytes() for x in packed], pa.binary()),
                         "contents": pa.array([c["content"][row[x]].tobytes() for x in packed], pa.binary()),
                         "offs": pa.array([off[x].astype(np.uint8).tobytes() for x in packed], pa.binary())})

    return (blocks.select("block", "ends", "data").join(mixed.select("block").distinct(), "block", "left_semi").groupBy("block")
            .cogroup(mixed.select("block", "p", "content", "lo", "width", "n", "large").groupBy("block"))
            .applyInArrow(run, "bucket long, keys binary, again binary, contents binary, offs binary"))


def repeated_strings(t: pa.Table) -> pa.Table:
    """Of one bucket the strings that occur again, as a bit mask per content."""
    read = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind)
    key, again, content, off = read("keys", np.uint64), read("again", bool), read("contents", np.int64), read("offs", np.uint8)
    if t.column("bucket")[0].as_py() >= 0:
        _, group, number = np.unique(key, return_inverse=True, return_counts=True)
        known = np.zeros(len(number), bool)
        known[group[again]] = True
        found = ((number > 1) | known)[group]
        content, off = content[found], off[found]
    order = np.argsort(content, kind="stable")
    content, bit = content[order], np.left_shift(np.int64(1), off[order].astype(np.int64))
    start = np.flatnonzero(np.concatenate([[True], content[1:] != content[:-1]])) if len(content) else np.zeros(0, np.int64)
    return pa.table({"content": content[start], "mask": np.bitwise_or.reduceat(bit, start) if len(start) else np.zeros(0, np.int64)})


def _cleaned(blocks: DataFrame, marks: DataFrame, kind: str) -> DataFrame:
    """Per document what is removed and the digest of the rest."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        data, ends = left.column("data")[0].as_py(), np.frombuffer(left.column("ends")[0].as_py(), np.int64)
        n = len(data)
        edge = np.zeros(n + 1, np.int64)
        raw = right.column("places").to_pylist()
        places, row = np.frombuffer(b"".join(raw), np.int64), np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw])
        mask = right.column("mask").fill_null(0).to_numpy()[row]
        full = right.column("mask").is_null().to_numpy()[row]
        at = places[full]  # every string of the anchor
        np.add.at(edge, at, 1)
        np.add.at(edge, at + (right.column("width").to_numpy()[row[full]] - 1 + LENGTH), -1)
        for off in range(WINDOW):
            at = places[(mask >> off & 1).astype(bool)] + off
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LENGTH, -1)
        gone = np.cumsum(edge[:n]) > 0
        first = np.concatenate([[0], ends[:-1]])
        removed = np.concatenate([[0], np.cumsum(gone)])
        begins = gone & ~np.concatenate([[False], gone[:-1]])[:n]
        begins[first[first < n]] = gone[first[first < n]]  # a run ends with its document
        spans = np.concatenate([[0], np.cumsum(begins)])
        rest = np.frombuffer(data, np.uint8)
        kept = [data[s:e] if removed[e] == removed[s] else rest[s:e][~gone[s:e]].tobytes() for s, e in zip(first.tolist(), ends.tolist(), strict=True)]
        return pa.table({"doc_id": left.column("ids").combine_chunks().flatten(), "n_bytes": ends - first, "n_removed": removed[ends] - removed[first],
                         "n_spans": spans[ends] - spans[first], "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept], "kept": pa.array(kept, pa.binary())})

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(run, schema)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """Every document without the bytes of strings of 400 that begin somewhere
    else as well: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and with
    ``texts`` the remaining bytes ``kept`` (cuts may fall inside a character)."""
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    stage = Stage(spark)
    with settings(spark, {k: v for k, v in _SETTINGS.items() if "arrow" not in k}):
        blocks = stage.save(_blocks(src, kind), "blocks")
    with settings(spark, _SETTINGS):
        n_bytes = blocks.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
        names = stage.save(_named(_triples(blocks), n_bytes * 4 // (3 * (WINDOW + 1))), "names")
    with settings(spark, {k: v for k, v in _SETTINGS.items() if "arrow" not in k}):
        kept = stage.save(_kept(blocks, names), "kept")
        stage.drop(names)
        keys = F.struct("block", "lo", "width", *_KEYS)
        contents = stage.save(kept.groupBy("p", "f").agg(F.sum("n").alias("n"), F.any_value(keys).alias("k")).select("p", "f", "n", "k.*"), "contents")
        large = LARGE
        found = contents.withColumn("bucket", _bucket("h", contents.count())).groupBy("bucket").applyInArrow(
            lambda t: classes(t, large), "p long, f long, n long, block long, lo long, width int, all boolean, mixed boolean, large boolean")
        found = stage.save(found.withColumn("content", F.monotonically_increasing_id()), "classes")
        stage.drop(contents)
        mixed = found.where("mixed")
        total = mixed.agg(F.sum("width")).first()[0] or 0
        strings = stage.save(_strings(blocks, mixed, 1 + total // STRINGS), "strings")
        masks = (strings.groupBy("bucket", F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("contents"), F.lit(1 + total // STRINGS))))
                 .applyInArrow(repeated_strings, "content long, mask long").groupBy("content").agg(F.bit_or("mask").alias("mask")))
        some = found.where("not all").join(masks, "content").select("p", "f", "mask")
        whole = found.where("all").select("p", "f", F.lit(None).cast("long").alias("mask"))
        repeated = stage.save(whole.unionByName(some), "repeated")
        stage.drop(strings)
        marks = stage.save(kept.select("block", "p", "f", "width", "places").join(repeated, ["p", "f"]).select("block", "width", "places", "mask"), "marks")
        stage.drop(kept)
        out = _cleaned(blocks, marks, kind)
        return stage.save(out if texts else out.drop("kept"), "cleaned")
