"""Risk model on the smallest tables with few trees: metric floor,
attribution sum identity, exact split proportions."""

import re

from pyspark.sql import functions as F

from lateline.config import SYNTHETIC_CONFIG
from lateline.operators import fact as FT, risk as R
from lateline.sources import synthetic_tables

from fulfilment_fixtures import SF0001

CFG = SYNTHETIC_CONFIG.with_(gbt_trees=5, forest_trees=10, forest_depth=5)


def test_model_split_auc_attribution(spark):
    t = synthetic_tables(spark, SF0001)
    rows = R.ml_features(FT.fact_deliveries(t, CFG)).persist()
    train, test = R.stratified_split(rows, 0.2, 42)
    per = {r.is_late: r.n for r in rows.groupBy("is_late").agg(F.count(F.lit(1)).alias("n")).collect()}
    tr = {r.is_late: r.n for r in train.groupBy("is_late").agg(F.count(F.lit(1)).alias("n")).collect()}
    for k, n in per.items():
        assert abs(tr[k] - 0.8 * n) <= 1.0
    model = R.train_boosted(train, CFG)
    scored = R.score_risk(model, test)
    # the synthetic tables' lateness does not depend on the features: any AUC near
    # a half is luck (test_model_finds_a_signal has one), but it must be exact
    pairs = [(r.late_probability, r.is_late) for r in scored.collect()]
    pos, neg = ([p for p, y in pairs if y == k] for k in (1, 0))
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(R.roc_auc_exact(scored).first().roc_auc - want) < 1e-9
    assert set(r.risk_level for r in scored.select("risk_level").distinct().collect()) <= {
        "Low Risk", "Medium Risk", "High Risk", None}
    contrib = R.attribution(model, test.limit(20))
    err = (contrib.groupBy("order_id", "base_value", "value").agg(F.sum("contribution").alias("s"))
           .select(F.max(F.abs(F.col("s") - (F.col("value") - F.col("base_value"))))).first()[0])
    assert err < 1e-9
    rows.unpersist()


def test_roc_auc_exact_ties(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0)], "late_probability double, is_late int")
    assert abs(R.roc_auc_exact(df).first().roc_auc - 0.875) < 1e-12


def _rows(spark, n=400, states=5, seed=7):
    """Few distinct tuples, many rows each; lateness depends on state and month."""
    import random
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s, m, h = rnd.randrange(states), rnd.choice([3, 11]), rnd.choice([8, 20])
        late = int(rnd.random() < (0.7 if s == 2 and m == 11 else 0.15))
        out.append((f"S{s}", rnd.choice("XY"), m, 1, h, "Murah", "2017Q1", f"o{i}", late))
    return spark.createDataFrame(out, ", ".join(f"{c} string" if c in R.CATEGORICAL else f"{c} int" for c in R.FEATURES)
                                 + ", order_id string, is_late int")


def test_grouped_fit_grows_the_same_trees_with_thresholds(spark):
    rows = _rows(spark).persist()
    one, each = R.train_boosted(rows, CFG), R.train_boosted(rows, CFG, grouped=False)
    text = one.stages[-1].toDebugString
    plain = lambda m: re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda x: f"{float(x.group()):.9f}", "\n".join(m.stages[-1].toDebugString.split("\n")[1:]))
    assert plain(one) == plain(each)
    # codes are ordered numbers: no node asks for a set of categories
    assert " in {" not in text and "<=" in text
    assert " in {" not in R.train_forest(rows, CFG).stages[-1].toDebugString
    n, distinct = rows.count(), R.grouped_rows(rows)
    assert distinct.count() < n / 4 and distinct.agg(F.sum("n")).first()[0] == n
    a, b = ({r.order_id: r.late_probability for r in R.score_risk(m, rows).collect()} for m in (one, each))
    assert a == b
    w = R.with_class_weight(R.grouped_rows(rows), "balanced").agg(F.sum("weight")).first()[0]
    assert abs(w - n) < 1e-6


def test_attribution_against_brute_force(spark):
    import itertools
    import math
    rows = _rows(spark, 200).persist()
    model = R.train_boosted(rows, CFG)
    back = R.background_rows(rows, 3).collect()
    assert back == R.background_rows(rows.repartition(7), 3).collect() and len(back) == 3
    some = rows.where("order_id in ('o1', 'o2', 'o3', 'o4')")
    got = {(r.order_id, r.feature): r for r in R.attribution(model, some, R.background_rows(rows, 3)).collect()}
    m = len(R.FEATURES)
    mixes, where = [], {}
    xs = {r.order_id: r for r in some.collect()}
    for oid, x in xs.items():
        for mask in range(2 ** m):
            for j, b in enumerate(back):
                where[oid, mask, j] = len(mixes)
                mixes.append((len(mixes), *[x[c] if mask >> i & 1 else b[c] for i, c in enumerate(R.FEATURES)]))
    df = spark.createDataFrame(mixes, "k long, " + ", ".join(f"{c} string" if c in R.CATEGORICAL else f"{c} int" for c in R.FEATURES))
    f = {r.k: r._f for r in R.margin(model, df).collect()}
    p = {r.k: r.probability[1] for r in model.transform(df).select("k", "probability").collect()}
    assert all(abs(1 / (1 + math.exp(-f[k])) - p[k]) < 1e-9 for k in f)   # the margin is the log-odds
    v = {(o, mask): sum(f[where[o, mask, j]] for j in range(3)) / 3 for o in xs for mask in range(2 ** m)}
    for o in xs:
        for i, c in enumerate(R.FEATURES):
            want = 0.0
            for k in range(m):
                for s in itertools.combinations([j for j in range(m) if j != i], k):
                    mask = sum(1 << j for j in s)
                    want += math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) * (v[o, mask | 1 << i] - v[o, mask])
            assert abs(got[o, c].contribution - want) < 1e-9
        assert abs(got[o, c].base_value - v[o, 0]) < 1e-9 and abs(got[o, c].value - v[o, 2 ** m - 1]) < 1e-9


def test_model_finds_a_signal(spark):
    rows = _rows(spark, 3000).persist()
    train, test = R.stratified_split(rows, 0.2, 42)
    for model in (R.train_boosted(train, CFG), R.train_forest(train, CFG)):
        assert R.roc_auc_exact(R.score_risk(model, test)).first().roc_auc > 0.6


def test_attribution_reads_leaves_and_expands_no_coalitions(spark):
    import numpy as np
    rows = _rows(spark, 200).persist()
    model = R.train_boosted(rows, CFG)
    value, low, high = R.tree_leaves(model)
    got = R.margin(model, rows).select(*R.FEATURES, "_f").distinct().collect()
    x = model.transform(spark.createDataFrame([g[:-1] for g in got], rows.select(*R.FEATURES).schema)).select("features").collect()
    x = np.array([r.features.toArray() for r in x])
    inside = R.passed(x, low, high) == 2 ** len(R.FEATURES) - 1
    assert (inside.sum(1) == CFG.gbt_trees).all()          # one leaf of every tree
    assert np.allclose(inside @ value, [g._f for g in got], atol=1e-12)
    plan = R.attribution(model, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "bit_count" not in plan
    # no row to take absent features from: no contribution
    assert R.attribution(model, rows, rows.where("false")).count() == 0


def test_attribution_takes_absent_features_from_all_rows(spark):
    import itertools
    import math

    import numpy as np
    rows = _rows(spark, 120).persist()
    model = R.train_boosted(rows, CFG)
    some = rows.where("order_id in ('o1', 'o2', 'o3')")
    value, low, high = R.tree_leaves(model)
    enc = {r.order_id: r.features.toArray() for r in model.transform(rows).select("order_id", "features").collect()}
    back = np.array([*enc.values()])
    m = len(R.FEATURES)
    f = lambda x: ((R.passed(x, low, high) == 2 ** m - 1) @ value).mean()
    base = R.margin(model, rows).agg(F.avg("_f")).first()[0]
    got = R.attribution(model, some, rows).collect()
    assert len(got) == 3 * m and len({(tuple(b)) for b in back}) > R.BACKGROUND
    v = {}
    for r in got:
        x, i = enc[r.order_id], R.FEATURES.index(r.feature)
        want = 0.0
        for k in range(m):
            for s in itertools.combinations([j for j in range(m) if j != i], k):
                both = []
                for t in ((*s, i), s):
                    if (r.order_id, frozenset(t)) not in v:
                        mixed = back.copy()
                        mixed[:, list(t)] = x[list(t)]
                        v[r.order_id, frozenset(t)] = f(mixed)
                    both.append(v[r.order_id, frozenset(t)])
                want += math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) * (both[0] - both[1])
        assert abs(r.contribution - want) < 1e-9 and abs(r.base_value - base) < 1e-9
    # by default the rows themselves are the background: all margins average to the base value
    own = R.attribution(model, rows).agg(F.max("base_value").alias("b"), F.avg("value").alias("v")).first()
    assert abs(own.b - base) < 1e-9 and abs(own.v - base) < 1e-9


def test_attribution_row_has_the_baseline_of_all_rows(spark, monkeypatch):
    from lateline.plans import queries as Q
    rows = _rows(spark, 120).persist()
    model = R.train_boosted(rows, CFG)
    monkeypatch.setattr(Q, "_model", lambda c, kind: model)

    class Given:
        risk_rows = rows
    base = R.margin(model, rows).agg(F.avg("_f")).first()[0]
    got = Q._attribution_row(Given()).collect()
    assert len(got) == len(R.FEATURES) and {r.order_id for r in got} == {"o0"}
    assert all(abs(r.base_value - base) < 1e-9 for r in got)
