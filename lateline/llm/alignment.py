"""Cross-tokenizer alignment by sparse incidence matrices.

Two tokenizers cut the same bytes.  With A the token-byte incidence of the one
and B that of the other, both in compressed sparse rows, the entry (i, j) of
A B' is the number of bytes that token i and token j share: its non-zeros are
the overlap links.  Places where a token of either side ends cut both into
groups; the product of the token-group incidences has the links that share a
group.  Products are Gustavson's: a row of the result gathers the rows of B'
that a row of A names, and equal columns are added up.  Rows are taken in
blocks of bounded size, so a long text needs no more memory than its arrays.

How often a pair of ids is linked is counted over the corpus: in tasks, then by
key.  The most frequent pairs, up to ``FREQUENT``, go to all workers; the links
of other pairs are joined with the counts, so every link is counted.

Odd rows: a text that is null or empty, or whose tokens do not give its bytes
again (a text with U+2581, say, or one the tokenizer normalises), has no
tokens: zeros, and ''.  A doc_id may be null or repeated; rows are separate.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import Stage
from lateline.llm.secrets import default_vocabulary, load_encoding

#: Pairs that every worker holds, at most; the rest is joined.
FREQUENT = 1 << 20
#: Pairs that a task counts before it hands them on, and bytes of text that are aligned at once.
COUNTED, SLICE = 1 << 21, 1 << 20


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


# -- compressed sparse rows ----------------------------------------------------------

class Csr:
    """Rows of column numbers; ``values`` None stands for ones."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, width: int, values: np.ndarray | None = None):
        self.starts, self.columns, self.width, self.values = starts, columns, width, values

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))


def spans(sizes: np.ndarray) -> Csr:
    """Consecutive tokens of these sizes x bytes."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return Csr(starts, np.arange(starts[-1]), int(starts[-1]))


def spans_transposed(sizes: np.ndarray) -> Csr:
    """Bytes x consecutive tokens of these sizes."""
    n = int(sizes.sum())
    return Csr(np.arange(n + 1), np.repeat(np.arange(len(sizes)), sizes), len(sizes))


def row_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Entries that each row of a b gathers before equal columns are added."""
    each = np.diff(b.starts)[a.columns]
    return np.diff(np.concatenate([[0], np.cumsum(each)])[a.starts])


def product(a: Csr, b: Csr, limit: int = 1 << 22):
    """Gustavson's a b, as (rows, columns, values) in blocks of consecutive
    rows that gather about ``limit`` entries; a row alone may gather more."""
    gathered = np.concatenate([[0], np.cumsum(row_sizes(a, b))])
    lo = 0
    while lo < a.height:
        hi = max(lo + 1, int(np.searchsorted(gathered, gathered[lo] + limit, "right")) - 1)
        named = a.columns[a.starts[lo]:a.starts[hi]]
        each = b.starts[named + 1] - b.starts[named]
        rows = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.starts[lo:hi + 1])), each)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(each) - each - b.starts[named], each)
        cols = b.columns[at]
        key = rows * b.width + cols
        vals = None
        if a.values is not None or b.values is not None:
            left = np.ones(len(named), np.int64) if a.values is None else a.values[a.starts[lo]:a.starts[hi]]
            vals = np.repeat(left, each) * (1 if b.values is None else b.values[at])
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, vals = key[order], None if vals is None else vals[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        sums = np.diff(np.append(first, len(key))) if vals is None else np.add.reduceat(vals, first) if len(first) else vals
        yield key[first] // max(1, b.width), key[first] % max(1, b.width), sums
        lo = hi


# -- tokens -------------------------------------------------------------------------

class Pair:
    """Both tokenizers, the bytes of their tokens, and the decimal ids with
    what follows them in a group's text."""

    def __init__(self, vocabulary: str, pieces: str):
        import sentencepiece
        self.a = load_encoding(vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab - 1)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.ids = np.array([f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                             for i in range(n) for end in ends], object)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text on both sides; none where they do not give the bytes of space and text."""
        none = np.zeros(0, np.int64)
        left, right = [], []
        some = [t or "" for t in texts]
        for t, b in zip(some, self.b.encode(some, num_threads=1) if some else [], strict=True):
            x, y = none, none
            if t:
                want = b" " + t.encode()
                a = self.a.encode_ordinary(" " + t)
                if b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b)):
                    x, y = np.array(a, np.int64), np.array(b, np.int64)
            left.append(x)
            right.append(y)
        return left, right


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(vocabulary: str, pieces: str) -> Pair:
    if (vocabulary, pieces) not in _PAIRS:
        _PAIRS[vocabulary, pieces] = Pair(vocabulary, pieces)
    return _PAIRS[vocabulary, pieces]


class Aligned:
    """The tokens of several texts in a row.  Both sides of a text have the
    same bytes, so texts never share a token, a byte or a group."""

    def __init__(self, pair: Pair, left: list[np.ndarray], right: list[np.ndarray]):
        self.pair, self.left, self.right = pair, left, right
        self.a, self.b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        self.n_a, self.n_b = (np.array([len(v) for v in x], np.int64) for x in (left, right))
        self.a_size, self.b_size = pair.a_size[self.a], pair.b_size[self.b]
        ends_a, ends_b = np.cumsum(self.a_size), np.cumsum(self.b_size)
        mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool)
        mark[ends_b] = True
        self.cuts = ends_a[mark[ends_a]]
        self.a_group, self.b_group = np.searchsorted(self.cuts, ends_a), np.searchsorted(self.cuts, ends_b)
        self.a_text = np.repeat(np.arange(len(left)), self.n_a)

    def groups(self) -> np.ndarray:
        """Groups of each text."""
        text = np.full(len(self.cuts), -1)
        text[self.a_group] = self.a_text
        return np.bincount(text, minlength=len(self.left)).astype(np.int64)

    def overlaps(self):
        """Overlap links in blocks: token of A, token of B, bytes shared."""
        return product(spans(self.a_size), spans_transposed(self.b_size))

    def group_matrices(self) -> tuple[Csr, Csr]:
        a = Csr(np.arange(len(self.a) + 1), self.a_group, len(self.cuts))
        sizes = np.bincount(self.b_group, minlength=len(self.cuts))
        return a, Csr(np.concatenate([[0], np.cumsum(sizes)]), np.arange(len(self.b)), len(self.b))

    def shared_groups(self):
        """Links of tokens that share a group, in blocks."""
        return product(*self.group_matrices())

    def n_shared(self) -> np.ndarray:
        """Shared-group links of each text, from the product's row sizes alone."""
        sizes = row_sizes(*self.group_matrices())
        return np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(self.n_a)])])

    def group_texts(self) -> list[str]:
        """Per text ``a1,a2|b1;a3|b2,b3``."""
        if not len(self.a):
            return ["" for _ in self.left]
        in_a, in_b = (np.bincount(g, minlength=len(self.cuts)) for g in (self.a_group, self.b_group))
        before_a, before_b = np.cumsum(in_a), np.cumsum(in_b)
        out = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (self.a_group, self.b_group))
        out[np.arange(len(self.a)) + (before_b - in_b)[self.a_group]] = self.a * 2 + last_a
        out[np.arange(len(self.b)) + before_a[self.b_group]] = (len(self.pair.a_bytes) + self.b) * 2 + last_b
        words = self.pair.ids[out].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[s:e])[:-1] for s, e in zip([0, *ends], ends, strict=False)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, id pair) with their numbers of links, in order; an
        id pair is a's id times the size of b's vocabulary, plus b's."""
        wide = len(self.pair.a_bytes) * len(self.pair.b_bytes)
        keys, counts = [], []
        for i, j, _ in self.overlaps():
            k, n = np.unique(self.a_text[i] * wide + self.a[i] * len(self.pair.b_bytes) + self.b[j], return_counts=True)
            keys.append(k)
            counts.append(n)
        if len(keys) != 1:
            keys, counts = added(np.concatenate(keys) if keys else np.zeros(0, np.int64),
                                 np.concatenate(counts) if counts else np.zeros(0, np.int64))
        else:
            keys, counts = keys[0], counts[0]
        return keys // wide, keys % wide, counts


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys added up, in order."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _slices(column: pa.Array):
    """Texts of a batch, about ``SLICE`` characters at a time."""
    texts, size = [], 0
    for x in column:
        t = x.as_py()
        texts.append(t)
        size += len(t or "")
        if size >= SLICE:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _lists(raw: list[bytes]) -> pa.Array:
    return pa.array(raw, pa.binary())


# -- the operators --------------------------------------------------------------------

def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """Per document ``doc_id``, the ids ``a`` and ``b``, the overlap links
    ``overlaps`` (token of a, token of b, bytes shared) and the links of tokens
    that ``share`` a group."""
    files = vocabulary or default_vocabulary(), pieces or default_pieces()
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        pair = pair_of(*files)
        for b in batches:
            for i in range(b.num_rows):
                left, right = pair.encode([b.column(1)[i].as_py()])
                al = Aligned(pair, left, right)
                over = [(int(x), int(y), int(n)) for r, c, v in al.overlaps() for x, y, n in zip(r, c, v, strict=True)]
                same = [(int(x), int(y)) for r, c, _ in al.shared_groups() for x, y in zip(r, c, strict=True)]
                over_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())]))
                share_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), pa.array([left[0].tolist()], pa.list_(pa.int32())), pa.array([right[0].tolist()], pa.list_(pa.int32())),
                     pa.array([[{"a": x, "b": y, "bytes": n} for x, y, n in over]], over_type),
                     pa.array([[{"a": x, "b": y} for x, y in same]], share_type)], names=["doc_id", "a", "b", "overlaps", "share"])

    return src.mapInArrow(run, f"doc_id {kind}, a array<int>, b array<int>, overlaps array<struct<a:int,b:int,bytes:int>>, share array<struct<a:int,b:int>>")


def _aligned(src: DataFrame, files: tuple[str, str]) -> DataFrame:
    """Per document its figures, and its distinct id pairs with their links."""
    kind = src.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "uid", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256", "pairs", "numbers"]

    def run(batches):
        pair, uid = pair_of(*files), TaskContext.get().partitionId() << 40
        narrow = np.uint32 if len(pair.a_bytes) * len(pair.b_bytes) < 1 << 32 else np.uint64
        for b in batches:
            lo = 0
            for texts in _slices(b.column(1)):
                al = Aligned(pair, *pair.encode(texts))
                of, key, n = al.pairs()
                at = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
                key, sums, n = key.astype(narrow), np.concatenate([[0], np.cumsum(n)]), n.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(texts)), pa.array(range(uid, uid + len(texts)), pa.int64()), pa.array(al.n_a), pa.array(al.n_b),
                     pa.array(al.groups()), pa.array(np.diff(sums[at])), pa.array(al.n_shared()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in al.group_texts()]),
                     _lists([key[s:e].tobytes() for s, e in zip(at, at[1:], strict=False)]),
                     _lists([n[s:e].tobytes() for s, e in zip(at, at[1:], strict=False)])], names=names)
                uid += len(texts)
                lo += len(texts)

    return src.mapInArrow(run, f"doc_id {kind}, uid long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
                               "groups_sha256 string, pairs binary, numbers binary")


def _read(pairs: pa.Array, numbers: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a batch's rows, their links, and where each row's begin."""
    raw, counts = pairs.to_pylist(), numbers.to_pylist()
    sizes = np.array([len(x) // 4 for x in counts], np.int64)
    joined = b"".join(raw)
    width = np.uint32 if len(joined) == 4 * sizes.sum() else np.uint64
    return np.frombuffer(joined, width).astype(np.int64), np.frombuffer(b"".join(counts), np.uint32).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def _pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n)``: links of every id pair over the corpus."""

    def run(batches):
        keys, counts, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def out(k, n):
            for s in range(0, len(k), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(k[s:s + (1 << 16)]), pa.array(n[s:s + (1 << 16)])], names=["pair", "n"])

        for b in batches:
            k, n, _ = _read(b.column(0), b.column(1))
            keys.append(k)
            counts.append(n)
            size += len(k)
            if size > COUNTED:
                k, n = added(np.concatenate(keys), np.concatenate(counts))
                keys, counts, size = [k], [n], 0
                if len(k) > COUNTED // 2:
                    yield from out(k, n)
                    keys, counts = [], []
        if keys:
            yield from out(*added(np.concatenate(keys), np.concatenate(counts)))

    return aligned.select("pairs", "numbers").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> int:
    """Least number of links that at most ``most`` pairs reach; numbers are
    counted by an eighth of a power of two, so few rows come back."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 8)
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("level")).collect()
    total, least = 0, (1 << 63) - 1
    for r in rows:
        total += r.pairs
        if total > most:
            break
        least = r.least
    return least


def aligned_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                      pieces: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_group_links``; counts of id pairs are over all documents."""
    spark = docs.sparkSession
    files = vocabulary or default_vocabulary(), pieces or default_pieces()
    stage = Stage(spark)
    aligned = stage.save(_aligned(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), files), "aligned")
    width = len(pair_of(*files).b_bytes)
    counts = stage.save(_pair_counts(aligned), "counts")
    of_b = F.col("pair") % width
    best = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("best"))
    counts = stage.save(counts.withColumn("b", of_b).join(best, "b").select("pair", "n", (F.col("n") == F.col("best")).alias("is_best")), "ranked")

    least = _frequent(counts, frequent)
    top = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    shared = spark.sparkContext.broadcast(tuple(top[c].to_numpy()[order] for c in ("pair", "n", "is_best")))
    kind = aligned.schema["doc_id"].dataType.simpleString()
    figures = ["doc_id", "uid", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256"]

    def look_up(batches):
        keys, total, is_best = shared.value
        for b in batches:
            k, n, at = _read(b.column(len(figures)), b.column(len(figures) + 1))
            i = np.searchsorted(keys, k)
            found = np.zeros(len(k), bool)
            if len(keys):
                i = np.minimum(i, len(keys) - 1)
                found = keys[i] == k
            sums = np.zeros(len(k), np.int64)
            hits = np.zeros(len(k), np.int64)
            sums[found] = n[found] * total[i[found]]
            hits[found] = n[found] * is_best[i[found]]
            run = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[at])
            rest = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(run(~found))]), pa.int32()),
                                            pa.StructArray.from_arrays([pa.array(k[~found]), pa.array(n[~found])], ["pair", "links"]))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(figures)], pa.array(run(hits)), pa.array(run(sums)), rest],
                                             names=[*figures, "hits", "sums", "rest"])

    looked = stage.save(aligned.select(*figures, "pairs", "numbers").mapInArrow(
        look_up, f"doc_id {kind}, uid long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string, "
                 "hits long, sums long, rest array<struct<pair:long,links:long>>"), "looked_up")
    rest = (looked.select("uid", F.inline("rest")).join(counts.where(F.col("n") < least), "pair").groupBy("uid")
            .agg(F.sum(F.when(F.col("is_best"), F.col("links")).otherwise(0)).alias("more_hits"), F.sum(F.col("links") * F.col("n")).alias("more")))
    out = looked.drop("rest").join(rest, "uid", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("hits") + F.coalesce("more_hits", F.lit(0))).alias("n_best"),
                      (F.col("sums") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256", "n_group_links")
