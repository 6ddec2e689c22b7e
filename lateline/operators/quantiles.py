"""Exact, interpolated quantiles that scale with the data.

Spark's ``percentile`` keeps a value->count map per group and merges every
partial map into one task per group.  That is fine for bounded domains
(whole days: a few hundred distinct values) but a global quantile of a
continuous column would pull every distinct value into one task.  This
operator selects by refinement instead: sketches bracket the ranks, then only
what lies in the brackets is looked at again, until each rank is exact.  No
value is shuffled or sorted but those in the last brackets.  Interpolation is
linear (pandas / ``quantile_cont`` semantics, S13); nulls and NaN are skipped
like pandas.

Running totals need every rank, so they put values into order-preserving
buckets, with literal borders taken from a sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entries of a sketch (its rank error is one part in so many), the share of rows that a
#: first bracket reaches to either side, and the cuts of a bracket in the second round.
SKETCH = 10_000
SLACK = 2 / SKETCH
GRID = 1024

#: Borders taken from the data, and equal parts of the span between two borders.
MAX_BORDERS = 256
PARTS = 16


def _names(probs, names):
    if names is not None:
        return list(names)
    return ["q" + ("%g" % p).replace("0.", "").replace(".", "_") for p in probs]


def bucket_borders(df: DataFrame, value: Column) -> list[float]:
    """Up to ``MAX_BORDERS`` approximate percentiles of a numeric column, as
    many as there are shuffle partitions: one aggregate, one row."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_BORDERS, max(8, n))
    v = value.cast("double")
    row = df.where(v.isNotNull() & ~F.isnan(v)).agg(
        F.percentile_approx(v, [i / n for i in range(n + 1)], 10 * n).alias("p")).first()
    return sorted(set(row["p"] or []))


def value_bucket(value: Column, borders: Sequence[float]) -> Column:
    """Non-decreasing in the value; null is first and NaN last, as in Spark's
    order.  A search tree over the literal borders, then equal parts between
    two borders."""
    v = value.cast("double")

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            if 0 < lo < len(borders):
                low, width = borders[lo - 1], borders[lo] - borders[lo - 1]
                part = F.floor((v - F.lit(low)) / F.lit(width) * PARTS)
                part = F.least(F.greatest(F.coalesce(part, F.lit(0)), F.lit(0)), F.lit(PARTS - 1))
            else:
                part = F.lit(0)
            return F.lit(lo * PARTS) + part
        mid = (lo + hi) // 2
        return F.when(v < F.lit(borders[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    last = (len(borders) + 1) * PARTS
    body = tree(0, len(borders)) if borders else F.lit(0)
    return F.when(v.isNull(), F.lit(-1)).when(F.isnan(v), F.lit(last)).otherwise(body).cast("long")


def select_quantiles(df: DataFrame, columns: dict[str, tuple[Column, dict[str, float]]], by: Sequence[str] = (),
                     moments: bool = False) -> DataFrame:
    """Exact interpolated quantiles of many columns by refinement: ``columns``
    maps a key to (numeric expression, {result name: probability}).  One row
    per group (one row overall without ``by``) with the results, and ``n_<key>``,
    the number of values.  Three rounds, each one aggregate over the input:

    1. a quantile sketch of every column brackets each probability;
    2. a sketch of what lies in each bracket, and the count below it, narrow
       the bracket down to a few millionths of the rows;
    3. the values in the bracket are sorted, the rows below it and at its ends
       counted: the value at a rank is exact.  A rank outside its bracket (the
       sketch's error is bounded, so it cannot be) would raise, not be guessed.

    A round's result is a scalar subquery of the next (with ``by``, which is for
    few groups: one row per group, broadcast), so building the plan runs nothing and no row is copied for
    a column.  Nulls and NaN are skipped; without values the result is null
    (with ``by``: no row for a group that has none in any column).  With
    ``moments`` the last round also yields ``mean_, std_, min_`` and ``max_<key>``."""
    by, keys = list(by), list(columns)
    targets = [(f"v{keys.index(key)}", name, float(p)) for key, (_, probs) in columns.items() for name, p in probs.items()]
    v = [f"v{i}" for i in range(len(keys))]
    base = df.select(*by, *[columns[k][0].cast("double").alias(x) for k, x in zip(keys, v, strict=True)])
    base = base.select(*by, *[F.expr(f"nullif({x}, double('NaN'))").alias(x) for x in v])
    if by:
        base = base.where(f"coalesce({', '.join(v)}) is not null")
    # texts of expressions: one parse each, where a column object costs a call for every node
    many = lambda texts: [F.expr(x) for x in texts]

    def attach(rows: DataFrame, one: DataFrame) -> DataFrame:
        # a round's results are one struct: its plan is in the next round's once
        row = one.select(*by, F.struct(*[c for c in one.columns if c not in by]).alias("_r"))
        # broadcast: a join by the key would put all rows of a group into one task
        return rows.join(F.broadcast(row), by) if by else rows.withColumn("_r", row.select("_r").scalar())

    ends = {x: [e for y, _, p in targets if y == x for e in (max(0.0, p - SLACK), min(1.0, p + SLACK))] for x in v}
    sketch = base.groupBy(*by).agg(*many([f"percentile_approx({x}, array({', '.join(f'{e!r}D' for e in ends[x])}), {SKETCH}) as s_{x}" for x in v]
                                         + [f"count({x}) as n_{x}" for x in v]))
    place = [sum(y == x for y, *_ in targets[:i]) for i, (x, *_) in enumerate(targets)]
    one = sketch.select(*by, *[f"n_{x}" for x in v], *many(
        f"s_{x}[{2 * at + j}] as {end}{i}" for i, (at, (x, *_)) in enumerate(zip(place, targets, strict=True)) for j, end in enumerate(("lo", "hi"))))

    def found_in(df: DataFrame, tests: list[str], agg: str, name: str) -> DataFrame:
        # the values that pass a target's test, by target: a few rows of all
        rows = ", ".join(f"if({test}, struct({i} as i, {x} as x), null)" for i, (test, (x, *_)) in enumerate(zip(tests, targets, strict=True)))
        hits = df.select(*by, F.expr(f"inline(array_compact(array({rows})))"))
        return hits.groupBy(*by, "i").agg(F.expr(f"struct(i, {agg}) as row")).groupBy(*by).agg(F.expr(f"collect_list(row) as {name}"))

    def with_found(df: DataFrame, found: DataFrame) -> DataFrame:
        return df.join(F.broadcast(found), by, "left") if by else df.withColumn(found.columns[-1], found.scalar())

    first = attach(base, one)
    grid = "cast(split('" + ",".join(f"{i / GRID!r}" for i in range(GRID + 1)) + "', ',') as array<double>)"
    cut = with_found(
        attach(first.groupBy(*by).agg(*many(f"count_if({x} < _r.lo{i}) as below{i}" for i, (x, *_) in enumerate(targets))), one),
        found_in(first, [f"{x} between _r.lo{i} and _r.hi{i}" for i, (x, *_) in enumerate(targets)],
                 f"count(x) as m, percentile_approx(x, {grid}, {SKETCH}) as g", "_cuts"))
    # per bracket the cuts around its rank: one lambda over the targets keeps the code small
    rows = ", ".join(f"struct({i} as i, (_r.n_{x} - 1) * {p!r}D - below{i} as rank)" for i, (x, _, p) in enumerate(targets))
    two = cut.select(*by, F.expr(
        f"transform(array({rows}), t -> get(transform(filter(_cuts, c -> c.i = t.i), c -> transform(array(-1, 3), d -> element_at(c.g, "
        f"1 + int(least(greatest(floor(t.rank / c.m * {GRID}) + d, 0), {GRID}))))), 0)) as cuts"), *many(f"_r.n_{x} as n_{x}" for x in v))

    last = attach(base, two)
    low, high = ([f"_r.cuts[{i}][{j}]" for i in range(len(targets))] for j in (0, 1))
    more = {f"{name}_{k}": f"{f}({x})" for k, x in zip(keys, v, strict=True)
            for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))} if moments else {}
    three = last.groupBy(*by).agg(*many(
        y for i, (x, *_) in enumerate(targets) for y in (
            f"count_if({x} < {low[i]}) as below{i}", f"count_if({x} = {low[i]}) as at_lo{i}",
            f"count_if({x} = {high[i]} and {high[i]} > {low[i]}) as at_hi{i}",
            f"max(if({x} < {low[i]}, {x}, null)) as prev{i}", f"min(if({x} > {high[i]}, {x}, null)) as next{i}")),
        *many(f"{y} as `{c}`" for c, y in more.items()))
    three = with_found(attach(three, two), found_in(last, [f"{x} > {low[i]} and {x} < {high[i]}" for i, (x, *_) in enumerate(targets)],
                                       "sort_array(collect_list(x)) as xs", "_inner"))
    # the value at a rank: the one below the bracket, its low end, inside, its high end, the one above
    rows = ", ".join(f"struct(if(_r.n_{x} > 0, (_r.n_{x} - 1) * {p!r}D, null) as h, {low[i]} as lo, {high[i]} as hi, below{i} as below, at_lo{i} as at_lo, at_hi{i} as at_hi, "
                     f"prev{i} as prev, next{i} as next, coalesce(get(filter(_inner, r -> r.i = {i}), 0).xs, array()) as inner)"
                     for i, (x, _, p) in enumerate(targets))
    at = ("transform(array(floor(t.h), ceil(t.h)), k -> case when k = t.below - 1 then t.prev when k >= t.below and k < t.below + t.at_lo then t.lo "
          "when k >= t.below + t.at_lo and k < t.below + t.at_lo + size(t.inner) then get(t.inner, int(k - t.below - t.at_lo)) "
          "when k >= t.below + t.at_lo + size(t.inner) and k < t.below + t.at_lo + size(t.inner) + t.at_hi then t.hi "
          "when k = t.below + t.at_lo + size(t.inner) + t.at_hi then t.next else raise_error('a rank lies outside its bracket') end)")
    done = three.select(*by, F.expr(f"transform(transform(array({rows}), t -> if(t.h is not null, struct({at} as two, t.h - floor(t.h) as part), null)), "
                                    "t -> t.two[0] + t.part * (t.two[1] - t.two[0])) as _found"),
                        *many(f"coalesce(_r.n_{x}, 0) as `n_{k}`" for k, x in zip(keys, v, strict=True)), *[f"`{c}`" for c in more])
    return done.select(*by, *[F.expr(f"_found[{i}] as `{name}`") for i, (_, name, _) in enumerate(targets)],
                       *[f"`n_{k}`" for k in keys], *[f"`{c}`" for c in more])


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, with_count: bool = False) -> DataFrame:
    """One row per group (one row overall when ``by`` is empty) with a column
    per probability.  No row is produced for a group without values."""
    names = _names(probs, names)
    out = select_quantiles(df, {"x": (F.col(value), dict(zip(names, probs, strict=True)))}, by)
    return out.where("n_x > 0").select(*by, *names, *([F.col("n_x").alias("n")] if with_count else []))


def builtin_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                      names: Sequence[str] | None = None) -> DataFrame:
    """Spark ``percentile`` (exact, one map per group): use for bounded domains
    such as whole days, where the per-group map stays small."""
    names = _names(probs, names)
    arr = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(float(p)) for p in probs]))
    g = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    agg = (g.groupBy(*by) if by else g).agg(arr.alias("_q"))
    return agg.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Exclusive running sums of ``sum_cols`` in ``order_col`` order (per
    ``by`` group; ``order_col`` should be unique within a group, e.g. after a
    group-by on it) without a single-partition window: order-preserving buckets
    of the numeric ``order_col`` (literal borders, see above) split the order
    over tasks, each bucket sums locally, and a table of at most buckets x
    groups rows supplies the offsets.  Adds ``<col>_before``."""
    by = list(by)
    borders = bucket_borders(df, F.col(order_col))
    ranged = df.withColumn("_pid", value_bucket(F.col(order_col), borders))
    key = ["_pid", *by]
    w_in = Window.partitionBy(*key).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(w_in), F.lit(0)).alias(f"_in_{c}")
                                 for c in sum_cols])
    part = local.groupBy(*key).agg(*[F.sum(c).alias(f"_pt_{c}") for c in sum_cols])
    w_grp = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_pid")
    part = part.select(*key, *[F.coalesce(F.sum(f"_pt_{c}").over(
        w_grp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{c}")
        for c in sum_cols])
    out = local.join(part, key)
    return out.select(*[c for c in df.columns],
                      *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{c}_before")
                        for c in sum_cols])
