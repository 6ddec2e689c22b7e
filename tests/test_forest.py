"""The forest's counts, splits and draws against plain loops over the rows."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array

from lateline.config import SYNTHETIC_CONFIG
from lateline.operators import forest as FO, risk as R
from test_risk import _rows

CFG = SYNTHETIC_CONFIG.with_(forest_trees=4, forest_depth=4)


def _text(model):
    return "\n".join(model.stages[-1].toDebugString.split("\n")[1:])


def test_draws_are_a_bootstrap_of_n_rows():
    key = np.arange(40_000, dtype=np.uint64)
    for n in (1, 3, 2500):
        got = FO.draws(key, np.full(len(key), n), 12345, {})
        assert abs(got.mean() - n) < 5 * (n / len(key)) ** 0.5 and abs(got.var() / n - 1) < 0.05
    mixed = np.sort(np.repeat([1, 2, 400], [20_000, 10_000, 10_000]))
    got = FO.draws(key, mixed, 7, {})
    assert all(abs(got[mixed == n].mean() - n) < 0.05 * n for n in (1, 2, 400))
    assert (FO.draws(key, mixed, 8, {}) != got).any()  # another tree draws other rows


def test_nodes_count_and_split_as_loops_over_the_rows_do(spark):
    rows = R.grouped_rows(_rows(spark, 600)).persist()
    encoded = Pipeline(stages=R._encoding()).fit(rows).transform(rows).select(vector_to_array("features").alias("x"), "is_late", "n")
    values = FO.distinct_values(encoded, len(R.FEATURES))
    weights = np.array([0.7, 1.9])
    blocks = FO.packed_rows(encoded, values)
    forest = FO.grow(blocks, values, weights, 3, 3, 42, 1e-9)
    key, n = (np.concatenate([np.frombuffer(b[c], t) for b in blocks.collect()]) for c, t in (("key", np.uint64), ("n", np.int64)))
    order = np.argsort(n, kind="stable")
    key, n = key[order], n[order]
    shift, mask = FO.packing(values)
    x = np.stack([(key >> s) & m for s, m in zip(shift, mask)], 1).astype(int)
    assert sorted((tuple(v[c] for v, c in zip(values, r)), int(k & np.uint64(1)), i) for r, k, i in zip(x, key, n)) \
        == sorted((tuple(r.x), r.is_late, r.n) for r in encoded.collect())
    y = (key & np.uint64(1)).astype(int)
    split = 0
    for number, t in enumerate(forest):
        taken = FO.draws(key, n, FO._salt(42, number), {})
        level = [(0, np.ones(len(key), bool))]
        while level:
            after = []
            for i, at in level:
                assert t.stats[i] == tuple(taken[at & (y == c)].sum() for c in (0, 1))
                if t.left[i] != i:
                    split += 1
                    goes = x[:, t.feature[i]] <= t.cut[i]
                    stats = lambda some: [taken[some & (y == c)].sum() * weights[c] for c in (0, 1)]
                    impurity = lambda s: 1 - sum((v / sum(s)) ** 2 for v in s)
                    whole, a, b = stats(at), stats(at & goes), stats(at & ~goes)
                    gain = impurity(whole) - sum(sum(s) / sum(whole) * impurity(s) for s in (a, b))
                    assert abs(gain - t.gain[i]) < 1e-12 and gain >= 1e-9
                    best = max(impurity(whole) - sum(sum(s) / sum(whole) * impurity(s) for s in (stats(at & (x[:, t.feature[i]] <= c)), stats(at & (x[:, t.feature[i]] > c))))
                               for c in range(len(values[t.feature[i]]) - 1)
                               if all(taken[at & z].sum() for z in (x[:, t.feature[i]] <= c, x[:, t.feature[i]] > c)))
                    assert abs(best - gain) < 1e-12
                    after += [(t.left[i], at & goes), (t.left[i] + 1, at & ~goes)]
            level = after
    assert split > 6


def test_forest_does_not_depend_on_how_rows_are_dealt(spark):
    rows = _rows(spark, 800).persist()
    one, other = R.train_forest(rows, CFG), R.train_forest(rows.repartition(13), CFG)
    assert _text(one) == _text(other) and one.stages[-1].getNumTrees == 4
    assert one.stages[-1].featureImportances == other.stages[-1].featureImportances
    assert abs(sum(one.stages[-1].featureImportances.toArray()) - 1) < 1e-9
    # thresholds lie between the values that occur
    assert {float(s.split()[-1].rstrip(")")) for s in _text(one).split("\n") if "feature 2 <=" in s} <= {7.0}
    few = R.train_forest(rows.where("is_late = 0"), CFG)
    assert {r.late_probability for r in R.score_risk(few, rows).collect()} == {0.0}
