"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector x is rotated at random and stored as the signs s of its
coordinates, with the correction factor f = <s / sqrt(D), x>.  For any other
vector q, <s / sqrt(D), q> / f estimates <x, q> without bias, and the error
exceeds eps * sqrt((1 - f^2) / f^2) / sqrt(D - 1) but rarely.  Pairs whose
upper bound stays below the threshold are skipped; all others are recomputed
exactly, so no pair below the threshold ever links.

Which pairs are estimated at all is decided by a coarse index: every vector
has a home cell (its nearest centre) and visits a few more; a pair meets where
one visits the other's home.  Centres come from a bounded sample, but every
vector is indexed.  Equal vectors are one class; a crowded cell is split into
blocks, and each task holds two blocks at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import Stage, bounded_sample, components

THRESHOLD = 0.93
#: Classes of one label in one cell, on average, and cells that a vector visits.
CELL_ROWS = 64
VISITS = 10
#: Vectors that the centres are fitted on, at most; and vectors in a block.
SAMPLE = 20_000
BLOCK = 1024
#: Width of the confidence bound, in units of the error's scale.
EPS = 4.0


def rotation(dim: int, seed: int = 17) -> np.ndarray:
    """A random orthogonal matrix; the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(col) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None where null, zero or not finite."""
    out = []
    for x in col:
        v = x.as_py()
        if not v or any(c is None for c in v):
            out.append(None)
            continue
        a = np.array(v, np.float64)
        n = np.linalg.norm(a) if np.isfinite(a).all() else 0.0
        if not 0.0 < n < np.inf:
            big = np.abs(a).max() if np.isfinite(a).all() else 0.0   # squares out of range
            a = a / big if big > 0 else a
            n = np.linalg.norm(a) if big > 0 else 0.0
        out.append(a / n if n > 0 else None)
    return out


def classes(rows: DataFrame) -> DataFrame:
    """``(id, label, embedding)`` -> with ``dim`` and ``cls``, the hash of label
    and vector; null for rows that link with nothing."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        for b in batches:
            cls, dims = [], []
            for label, v in zip(b.column(1), unit(b.column(2)), strict=True):
                if v is None or label.as_py() is None:
                    cls.append(None)
                    dims.append(None)
                else:
                    raw = repr(label.as_py()).encode() + b"\0" + v.tobytes()
                    cls.append(np.uint64(xxhash.xxh3_64_intdigest(raw)).astype(np.int64).item())
                    dims.append(len(v))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims, pa.int32()), pa.array(cls, pa.int64())],
                                             names=["id", "label", "embedding", "dim", "cls"])

    return rows.mapInArrow(run, f"id {kind['id']}, label {kind['label']}, embedding {kind['embedding']}, dim int, cls long")


def centres(sample: np.ndarray, n: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means on the sample."""
    c = sample[np.random.default_rng(seed).permutation(len(sample))[:n]].copy()
    for _ in range(rounds):
        near = (sample @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1)
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def index(reps: DataFrame, cells: dict[int, np.ndarray]) -> DataFrame:
    """One row for each class and cell it visits, its home first: the rotated
    vector, its code and factor, and all its visits (for counting a pair once)."""
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast(cells)
    kind = reps.schema["label"].dataType.simpleString()

    def run(batches):
        for b in batches:
            vs = unit(b.column(2))
            take, out = [], {k: [] for k in ("cell", "home", "code", "factor", "vec", "visits")}
            for i, v in enumerate(vs):
                c = shared.value[len(v)]
                near = c @ v
                m = min(VISITS, len(c))
                visits = np.argpartition(-near, m - 1)[:m]
                visits = visits[np.lexsort((visits, -near[visits]))]
                r = rotation_of(len(v)) @ v
                bits = r > 0
                factor = np.abs(r).sum() / np.sqrt(len(r))
                for j, cell in enumerate(visits):
                    take.append(i)
                    out["cell"].append(int(cell))
                    out["home"].append(int(visits[0]))
                    out["code"].append(np.packbits(bits).tobytes())
                    out["factor"].append(float(factor))
                    out["vec"].append(v.tobytes())
                    out["visits"].append(np.sort(visits).astype(np.int32).tobytes())
            t = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(t), b.column(1).take(t), b.column(3).take(t), b.column(4).take(t),
                 pa.array(out["cell"], pa.int32()), pa.array(out["home"], pa.int32()), pa.array(out["code"], pa.binary()),
                 pa.array(out["factor"], pa.float64()), pa.array(out["vec"], pa.binary()), pa.array(out["visits"], pa.binary())],
                names=["cls", "label", "dim", "size", "cell", "home", "code", "factor", "vec", "visits"])

    return reps.select("cls", "label", "embedding", "dim", "size").mapInArrow(
        run, f"cls long, label {kind}, dim int, size long, cell int, home int, code binary, factor double, vec binary, visits binary")


_ROTATIONS: dict[int, np.ndarray] = {}


def rotation_of(dim: int) -> np.ndarray:
    if dim not in _ROTATIONS:
        _ROTATIONS[dim] = rotation(dim)
    return _ROTATIONS[dim]


def candidates(vec: np.ndarray, codes: np.ndarray, factor: np.ndarray, threshold: float, eps: float = EPS) -> np.ndarray:
    """Estimates of all rows of ``vec`` (rotated) against the coded ones; True
    where the upper confidence bound reaches the threshold."""
    dim = vec.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    est = (vec.astype(np.float32) @ signs.T) / factor.astype(np.float32)
    slack = eps * np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / np.sqrt(max(dim - 1, 1)) + 1e-5
    return est + slack.astype(np.float32) >= threshold


def _block_links(table: pa.Table, threshold: float) -> pa.Table:
    """Links between the members of one block of a cell and those of another
    (or the cell's guests): per class the vectors linked, and one chain of
    edges for each connected group.  A task holds two blocks."""
    n = table.num_rows
    cls, size = table.column("cls").to_numpy(), table.column("size").to_numpy()
    home, cell = table.column("home").to_numpy(), int(table.column("cell")[0].as_py())
    side = table.column("side").to_numpy()
    own = bool(table.column("own")[0].as_py())
    vec = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(n, -1)
    dim = vec.shape[1]
    codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(n, -1)
    visits = np.frombuffer(b"".join(table.column("visits").to_pylist()), np.int32).reshape(n, -1)
    factor = table.column("factor").to_numpy()
    left = np.flatnonzero(side == 0)
    right = left if own else np.flatnonzero(side == 1)
    none = pa.table({"cls": pa.array([], pa.int64()), "linked": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
    if not len(left) or not len(right):
        return none
    # codes of the left side, full vectors of the right
    maybe = candidates(vec[right] @ rotation_of(dim).T, codes[left], factor[left], threshold)
    r, l = np.nonzero(maybe)
    r, l = right[r], left[l]
    if own:
        r, l = r[r < l], l[r < l]
    else:
        # guests whose home the member visits too: the pair counts in the lesser cell
        both = (visits[l] == home[r][:, None]).any(1) & (home[r] != cell)
        ok = ~both | (cell < home[r])
        r, l = r[ok], l[ok]
    good = np.empty(len(r), bool)
    for i in range(0, len(r), 1 << 16):  # exact, in double precision
        good[i:i + (1 << 16)] = np.einsum("ij,ij->i", vec[r[i:i + (1 << 16)]], vec[l[i:i + (1 << 16)]]) >= threshold
    r, l = r[good], l[good]
    if not len(r):
        return none
    linked = np.zeros(n, np.int64)
    np.add.at(linked, r, size[l])
    np.add.at(linked, l, size[r])
    low = np.arange(n)
    while True:
        m = np.minimum(low[r], low[l])
        new = low.copy()
        np.minimum.at(new, r, m)
        np.minimum.at(new, l, m)
        new = new[new]
        if (new == low).all():
            break
        low = new
    some = np.flatnonzero(linked)
    return pa.table({"cls": cls[some], "linked": linked[some], "other": cls[low[some]]})


def near_duplicates(rows: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Rows are compared if their labels are equal and not null and their vectors
    have one length.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing.  Equal vectors all link with each
    other, repeated ids included; ``component_id`` is the smallest id reached.
    An empty table gives an empty result; other columns are ignored.
    """
    spark, stage = rows.sparkSession, Stage(rows.sparkSession)
    src = rows.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    all_rows = stage.save(classes(src), "rows")
    reps = all_rows.where("cls is not null").groupBy("cls").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.first("dim").alias("dim"),
        F.count("*").alias("size"), F.min("id").alias("low"))
    reps = stage.save(reps, "classes")
    n_labels = max(1, reps.agg(F.approx_count_distinct("label")).first()[0])
    cells = {}
    for r in reps.groupBy("dim").agg(F.count("*").alias("n")).collect():
        some = bounded_sample(reps.where(F.col("dim") == r["dim"]), F.col("cls"), SAMPLE).orderBy("cls").select("embedding").toArrow()
        some = np.array([v for v in unit(some.column("embedding"))])
        cells[r["dim"]] = centres(some, max(1, min(len(some) // 4 or 1, r["n"] // (n_labels * CELL_ROWS))))
    visits = stage.save(index(reps, cells), "index")
    # blocks of members and of guests of a cell
    cell = ["label", "dim", "cell"]
    guest = (F.col("home") != F.col("cell")).cast("int")
    blocks = visits.groupBy(*cell).agg(F.ceil(F.sum(1 - guest) / BLOCK).cast("int").alias("members"),
                                       F.ceil(F.sum(guest) / BLOCK).cast("int").alias("guests"))
    v = visits.join(blocks, cell).where("members > 0").withColumn("guest", guest)
    block = F.pmod(F.xxhash64("cls"), F.when(guest == 1, F.col("guests")).otherwise(F.col("members"))).cast("int")
    v = v.withColumn("block", block)
    upto = lambda n: F.transform(F.sequence(F.lit(0), n - 1), lambda i: i)
    pair = lambda i, j, side, own, kind: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"), F.lit(own).alias("own"), F.lit(kind).alias("kind"))
    me, other = F.col("block"), upto(F.col("members"))
    # a member meets its own block, every other member block once, and every guest block
    as_member = F.concat(
        F.array(pair(me, me, 0, True, "m")),
        F.transform(F.filter(other, lambda j: j > me), lambda j: pair(me, j, 0, False, "m")),
        F.transform(F.filter(other, lambda j: j < me), lambda j: pair(j, me, 1, False, "m")),
        F.when(F.col("guests") > 0, F.transform(upto(F.col("guests")), lambda j: pair(me, j, 0, False, "g"))).otherwise(
            F.array().cast("array<struct<i:int,j:int,side:int,own:boolean,kind:string>>")))
    as_guest = F.transform(other, lambda i: pair(i, me, 1, False, "g"))
    v = v.withColumn("meet", F.explode(F.when(F.col("guest") == 1, as_guest).otherwise(as_member))).select(
        *cell, "cls", "size", "home", "code", "factor", "vec", "visits", "meet.*")
    found = v.groupBy(*cell, "i", "j", "own", "kind").applyInArrow(
        lambda t: _block_links(t, threshold), "cls long, linked long, other long")
    found = stage.save(found, "found")
    linked = found.groupBy("cls").agg(F.sum("linked").alias("linked"))
    comp = components(stage, found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    by_class = (reps.select("cls", "size", "low").join(linked, "cls", "left")
                .join(comp.select(F.col("node").alias("cls"), "comp"), "cls", "left")
                .withColumn("comp", F.coalesce("comp", "cls")))
    by_class = stage.save(by_class, "members")
    low = by_class.groupBy("comp").agg(F.min("low").alias("component"))
    by_class = by_class.join(low, "comp").select(
        "cls", (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component")
    out = all_rows.select("id", "cls").join(by_class, "cls", "left")
    comp_id = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.coalesce(comp_id == F.col("id"), F.lit(False)).alias("kept"))
