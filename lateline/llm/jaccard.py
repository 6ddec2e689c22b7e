"""N-gram Jaccard join by token-combination prefixes.

A document's set holds its distinct k-word shingles ("tokens" below).  All
tokens have one global order: rare ones first, frequent ones last, by hash
within.  Two sets that link miss few of each other's tokens, so their prefixes
in that order must share something:

* of a rare token, the token itself is a signature;
* of frequent tokens, which are split into many classes, pairs of one class
  are.  A class of which a prefix holds m tokens counts for m - 1 only, so the
  prefix is extended until its rare tokens and its classes together count for
  one more than the tokens that a linked set may miss.

Pairs with a common signature are verified on the whole sets.  Documents with
equal sets are one class throughout.  Within a signature's bucket one leader,
the member with the fewest rare tokens (in a group of near copies that is the
text they come from), is compared with all others first; only members that are
then still in different components are compared further, and in the end all of
these are.  Sets that share rare tokens also meet in those tokens' buckets, so
where frequent ones meet a pair needs comparing only if the frequent tokens
alone could make a link.  So a large group of near copies costs a multiple of
its size, and no link that could join two components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import Stage, components

#: A token is frequent if more than so many sets have it in their first prefix.
FREQUENT = 32
#: At most so many frequent tokens (8 bytes each) go to every task: with more
#: entries in all prefixes than FREQUENT times this, the limit above rises.
MAX_FREQUENT_TOKENS = 4_000_000
#: Up to so many document keys (16 bytes each) are sent to every task to pick
#: their rows; beyond it the rows are shuffled.
BROADCAST_KEYS = 500_000
#: Frequent tokens of a document in one class, on average.
CLASS_TOKENS = 4
#: Sets below this size take frequent tokens singly.
SMALL_SET = 16
#: Rounds in which each bucket's leader meets the other components of it.
LEADER_ROUNDS = 1

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def seed64(i: int) -> np.uint64:
    """The i-th odd-spaced seed."""
    return np.uint64(i * int(_C1) & (1 << 64) - 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes."""

    def __init__(self, k: int, cache: int = 100_000):
        self.k, self.cache, self.seen = k, cache, {}

    def words(self, text: str | None) -> np.ndarray:
        # bytes: lower() and split() then know ASCII only, as the word rule does
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        seen = self.seen
        try:
            return np.array([seen[w] for w in words], np.uint64)
        except KeyError:
            if len(seen) > self.cache:
                seen.clear()
            for w in words:
                if w not in seen:
                    seen[w] = xxhash.xxh64_intdigest(w)
            return np.array([seen[w] for w in words], np.uint64)

    def tokens(self, text: str | None) -> np.ndarray:
        w = self.words(text)
        n, k = len(w), self.k
        if not n:
            return w
        k = min(n, k)
        h = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            h = mix64(h * _C1 + w[j:n - k + 1 + j])
        return np.unique(h)


def missing(n, percent: int):
    """Most tokens of a set of n that a linked set can lack."""
    return n - (percent * n + 99) // 100


def listed(n, percent: int):
    """Hashes of a set that are kept at hand: the first prefix, and some more
    so that a few frequent tokens among them can be passed over."""
    need = missing(n, percent) + 1
    return need + need // 3 + 6


def bands(percent: int, largest: float = 1e10) -> np.ndarray:
    """Lower ends of size bands; linked sets lie in one band or in neighbours."""
    out, r = [1.0], 100.0 / percent * 1.0001
    while out[-1] < largest:
        out.append(out[-1] * r)
    return np.array(out)


def signatures(h: np.ndarray, n: int, frequent: np.ndarray, percent: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Rare tokens that are signatures, signatures of frequent ones, and the
    number of frequent tokens, for a set of n of which ``h`` holds the smallest
    hashes; None if the set's other hashes are needed."""
    need = missing(n, percent) + 1
    at = np.searchsorted(frequent, h)
    is_frequent = frequent[np.minimum(at, len(frequent) - 1)] == h if len(frequent) else np.zeros(len(h), bool)
    rare = h[~is_frequent]
    none = np.zeros(0, np.uint64)
    if len(rare) >= need:
        return rare[:need], none, 0
    if len(h) < n:
        return None
    out, freq, need = [], h[is_frequent], need - len(rare)
    band = int(np.searchsorted(edges, n, side="right")) - 1
    for scheme in (band, band + 1):
        seed = seed64(scheme + 1)
        if edges[scheme] < SMALL_SET:
            out.append(mix64(freq[:need] ^ seed))
            continue
        n_classes = np.uint64(max(1, int(np.ceil(edges[scheme] / CLASS_TOKENS))))
        cls = mix64(freq + seed) % n_classes
        order = np.lexsort((freq, cls))
        cls, tok = cls[order], freq[order]
        # a prefix counts for its tokens, less one for each class begun
        first = np.r_[True, cls[1:] != cls[:-1]]
        worth = np.cumsum(~first)
        p = int(np.searchsorted(worth, need)) + 1
        cls, tok = cls[:p], tok[:p]
        gap = 1
        while gap < len(tok):
            same = cls[gap:] == cls[:-gap]
            if not same.any():
                break
            out.append(mix64(mix64(tok[:-gap][same] + seed) ^ tok[gap:][same]))
            gap += 1
    return rare, np.unique(np.concatenate(out)), len(freq)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(flat))


def sets(docs: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``n``, ``cls`` (the hash of the set;
    null for an empty one), ``prefix`` (its first hashes) and ``uid``."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        shingler, uid = Shingler(k), TaskContext.get().partitionId() << 40
        for b in batches:
            ns, cls, prefix = [], [], []
            for x in b.column(2):
                h = shingler.tokens(x.as_py())
                n = len(h)
                ns.append(n)
                cls.append(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64).item() if n else None)
                prefix.append(h[:listed(n, percent)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ns, pa.int64()), pa.array(cls, pa.int64()), _lists(prefix),
                 pa.array(range(uid, uid + len(ns)), pa.int64())],
                names=["doc_id", "text_hash", "n", "cls", "prefix", "uid"])
            uid += len(ns)

    return src.mapInArrow(run, f"doc_id {kind}, text_hash long, n long, cls long, prefix array<long>, uid long")


def _pick(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Texts of the rows named by ``keys (doc_id, text_hash, cls)``."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    keys = keys.select("doc_id", "text_hash", "cls")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return src.join(keys, src["doc_id"].eqNullSafe(keys["doc_id"]) & (src["text_hash"] == keys["text_hash"])).select("cls", "text")


def _whole_sets(rows: DataFrame, k: int) -> DataFrame:
    """``(cls, text)`` -> ``(cls, n, hashes)``, one row for each class."""

    def run(batches):
        shingler = Shingler(k)
        for b in batches:
            out = [shingler.tokens(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(h) for h in out], pa.int64()), _lists(out)], names=["cls", "n", "hashes"])

    return rows.mapInArrow(run, "cls long, n long, hashes array<long>").dropDuplicates(["cls"])


def _signature_rows(sets_: DataFrame, percent: int, frequent) -> DataFrame:
    """``(cls, n, hashes)`` -> ``(cls, n, f, rare, combined)``; ``rare`` is null
    where the whole set is needed and not at hand."""

    def run(batches):
        edges, none = bands(percent), np.zeros(0, np.uint64)
        for b in batches:
            f, rare, combined, ok = [], [], [], []
            for n, x in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                got = signatures(x.values.to_numpy().view(np.uint64), n, frequent.value, percent, edges)
                ok.append(got is not None)
                r, c, count = got or (none, none, 0)
                f.append(count)
                rare.append(r)
                combined.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(f, pa.int64()), pa.array(ok, pa.bool_()), _lists(rare), _lists(combined)],
                names=["cls", "n", "f", "ok", "rare", "combined"])

    return sets_.mapInArrow(run, "cls long, n long, f long, ok boolean, rare array<long>, combined array<long>")


def _fits(small: str, large: str, percent: int):
    """Sizes alone allow a link."""
    return (F.lit(100) * F.least(small, large)) >= (F.lit(percent) * F.greatest(small, large))


def _column(rows: DataFrame) -> np.ndarray:
    return rows.select("sig").toArrow().column("sig").to_numpy().view(np.uint64)


def links(stage: Stage, docs: DataFrame, found: DataFrame, doc_id: str, text: str, k: int, percent: int) -> DataFrame | None:
    """Components of the classes: ``(cls, comp)`` for linked ones; None if no
    two classes have a signature in common."""
    spark = docs.sparkSession
    # one row for each class
    first = found.where("cls is not null").groupBy("cls").agg(F.min("uid").alias("uid"))
    reps = stage.save(found.join(first.select("uid"), "uid", "left_semi")
                      .select("doc_id", "text_hash", "cls", "n", "prefix"), "classes")
    # frequent tokens of the first prefixes
    tokens = reps.select(F.explode("prefix").alias("sig"))
    counts = stage.save(tokens.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    total = reps.agg(F.sum(F.size("prefix"))).first()[0] or 0
    limit = max(FREQUENT, -(-total // MAX_FREQUENT_TOKENS))
    often = _column(counts.where(F.col("c") > limit))
    lists = reps.select("cls", "n", F.col("prefix").alias("hashes"))

    def at_hand(frequent):
        return stage.save(_signature_rows(lists, percent, spark.sparkContext.broadcast(frequent)), "signatures")

    def whole_of(cls):
        keys = stage.save(reps.join(cls, "cls", "left_semi").select("doc_id", "text_hash", "cls"), "keys")
        return stage.save(_whole_sets(_pick(docs, keys, doc_id, text), k), "whole")

    # sets with many frequent tokens share others too, which no list shows: the
    # frequent tokens are counted over these sets in full as well
    some = whole_of(at_hand(np.sort(often)).where("not ok").select("cls"))
    inside = some.select(F.explode("hashes").alias("sig")).groupBy("sig").agg(F.count("*").alias("c"))
    total = some.agg(F.sum("n")).first()[0] or 0
    often = np.union1d(often, _column(inside.where(F.col("c") > max(limit, -(-total // MAX_FREQUENT_TOKENS)))))
    # from here on the frequent tokens are fixed
    listed_sigs = at_hand(often)
    rest = listed_sigs.where("not ok").select("cls")
    whole = some.union(whole_of(rest.join(some.select("cls"), "cls", "left_anti")))
    more = stage.save(_signature_rows(whole.join(rest, "cls", "left_semi").select("cls", "n", "hashes"), percent,
                                      spark.sparkContext.broadcast(often)), "combinations")
    sigs = listed_sigs.where("ok").union(more)
    # a rare token of one listed prefix leads nowhere unless a whole set holds it
    # too; nor does a signature of one class.  f: tokens that could be common
    # where sets meet
    elsewhere = counts.select("sig").union(more.select(F.explode("rare").alias("sig"))).distinct()
    rare = (sigs.select("cls", "n", F.col("n").alias("f"), F.explode("rare").alias("sig"))
            .join(elsewhere, "sig").select("sig", "cls", "n", "f"))
    combined = sigs.select(F.explode("combined").alias("sig"), "cls", "n", "f")
    buckets = stage.save(rare.union(combined), "met")
    many = buckets.groupBy("sig").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("sig")
    buckets = stage.save(buckets.join(many, "sig"), "buckets")

    comp, done, good = None, None, None
    for turn in range(LEADER_ROUNDS + 1):
        b = buckets
        if comp is not None:
            b = b.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
            split = b.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("sig")
            b = stage.save(b.join(split, "sig"), f"open{turn}")
        else:
            b = b.withColumn("comp", F.col("cls"))
        if turn < LEADER_ROUNDS:
            lead = b.groupBy("sig").agg(F.min(F.struct(
                (F.col("n") - F.col("f")).alias("rare"), F.xxhash64(F.col("cls"), F.lit(turn)).alias("h"), F.col("cls").alias("y"),
                F.col("n").alias("ny"), F.col("f").alias("fy"), F.col("comp").alias("p"))).alias("l")).select("sig", "l.*")
            rest = lead.select("sig", "y", "ny", "fy", "p")
        else:
            # what is left of a bucket: every member outside its largest component with all others
            main = (b.groupBy("sig", "comp").agg(F.count("*").alias("size"))
                    .groupBy("sig").agg(F.max(F.struct("size", "comp"))["comp"].alias("main")))
            rest = b.join(main, "sig").where("comp <> main").select(
                "sig", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("f").alias("fy"), F.col("comp").alias("p"))
            # a member that no other set could link to by its frequent tokens has no use here
            rest = rest.where(F.lit(100) * F.col("fy") >= F.lit(percent) * F.col("ny"))
        both = F.least("f", "fy")
        enough = 100 * both >= percent * (F.col("n") + F.col("ny") - both)
        pairs = (b.join(rest, "sig").where((F.col("comp") != F.col("p")) & enough)
                 .select(F.col("cls").alias("x"), F.col("n").alias("nx"), "y", "ny"))
        pairs = pairs.where(_fits("nx", "ny", percent)).select(
            F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["x", "y"], "left_anti")
        pairs = stage.save(pairs, f"pairs{turn}")
        if not pairs.limit(1).count():
            continue
        checked, whole = verify(stage, docs, reps, pairs, whole, doc_id, text, k, percent)
        done = pairs if done is None else done.union(pairs)
        good = checked if good is None else good.union(checked)
        comp = components(stage, good.select(F.col("x").alias("a"), F.col("y").alias("b")))
        comp = comp.select(F.col("node").alias("cls"), "comp")
    return comp


def verify(stage: Stage, docs: DataFrame, reps: DataFrame, pairs: DataFrame, whole: DataFrame | None,
           doc_id: str, text: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs that link, by their whole sets; and the sets read so far.

    First the pairs' prefixes, which hold the smallest hashes of either set:
    below the lesser of their ends both are complete, and a pair that differs
    there by more than links allow is out.  This ships a part of the sets only.
    """
    p = reps.select("cls", F.col("n"), "prefix")
    near = (pairs.join(p.select(F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("prefix").alias("px")), "x")
            .join(p.select(F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("prefix").alias("py")), "y"))
    # hashes are in unsigned order; flipping the sign bit makes it the signed one
    flip = lambda c: c.bitwiseXOR(F.lit(-(1 << 63)))
    end = F.least(flip(F.element_at("px", -1)), flip(F.element_at("py", -1)))
    both = F.size(F.array_intersect("px", "py"))
    below = lambda c: F.size(F.filter(c, lambda v: flip(v) <= F.col("end")))
    near = near.withColumn("end", end)
    # |x ^ y| <= (1 - s) / (1 + s) * (|x| + |y|) for linked sets
    differ = below("px") + below("py") - 2 * both
    near = near.where((100 + percent) * differ <= (100 - percent) * (F.col("nx") + F.col("ny"))).select("x", "y")
    near = stage.save(near, "near")
    wanted = near.select(F.col("x").alias("cls")).union(near.select("y")).distinct()
    if whole is not None:
        wanted = wanted.join(whole.select("cls"), "cls", "left_anti")
    keys = stage.save(reps.join(wanted, "cls", "left_semi").select("doc_id", "text_hash", "cls"), "wanted")
    more = stage.save(_whole_sets(_pick(docs, keys, doc_id, text), k), "sets")
    whole = more if whole is None else whole.union(more)
    s = whole.select(F.col("cls").alias("x"), F.col("hashes").alias("hx"))
    t = whole.select(F.col("cls").alias("y"), F.col("hashes").alias("hy"))
    full = near.join(s, "x").join(t, "y")
    common = F.size(F.array_intersect("hx", "hy"))
    union = F.size("hx") + F.size("hy") - common
    return stage.save(full.where(100 * common >= percent * union).select("x", "y"), "links"), whole


def grouped(docs: DataFrame, *, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, n_shingles, component_id,
    first_hash``; the last two name the row of the component that comes first
    (smallest id, then text hash).

    Words are runs of anything but ASCII white space, A-Z in lower case; fewer
    than k words are one shingle.  Null texts and texts without a word have an
    empty set and are alone.  Repeated rows and equal texts are in one
    component; an empty table gives an empty result; other columns are ignored.
    """
    stage = Stage(docs.sparkSession)
    found = stage.save(sets(docs, doc_id, text, k, percent), "sets")
    slim = found.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "cls")
    comp = links(stage, docs, found, doc_id, text, k, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    by_class = slim.where("cls is not null").groupBy("cls").agg(first)
    if comp is not None:
        by_class = stage.save(by_class.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), "members")
        best = by_class.groupBy("comp").agg(F.min("first").alias("first"))
        by_class = by_class.select("cls", "comp").join(best, "comp").select("cls", "first")
    out = slim.join(by_class, "cls", "left")
    return out.select("doc_id", "text_hash", "n_shingles",
                      F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
                      F.when(F.col("cls").isNull(), F.col("text_hash")).otherwise(F.col("first.text_hash")).alias("first_hash"))


def keep_first(docs: DataFrame, *, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id's.  Rows with
    an empty set all stay, but for exact repetitions of a kept row with words."""
    stage = Stage(docs.sparkSession)
    g = grouped(docs, k=k, percent=percent, doc_id=doc_id, text=text)
    kept = F.col("component_id").eqNullSafe(F.col("doc_id")) & (F.col("first_hash") == F.col("text_hash"))
    g = g.groupBy("doc_id", "text_hash").agg(F.first(kept).alias("kept"), F.count("*").alias("copies"), F.max("n_shingles").alias("n"))
    g = stage.save(g.where("not kept or (copies > 1 and n > 0)").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("kept").alias("__kept")), "decisions")
    small = F.broadcast(g) if g.count() <= BROADCAST_KEYS else g
    cols = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*cols).alias("r"), F.col(doc_id).alias("i"), F.xxhash64(text).alias("h")).join(
        small, F.col("i").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__hash")), "left")
    single = marked.where("__kept is null").select("r.*")
    once = marked.where("__kept").groupBy("i", "h").agg(F.first("r").alias("r")).select("r.*")
    return single.union(once)
