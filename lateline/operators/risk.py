"""Per-order lateness risk: features, encoding, weighted tree ensembles,
scores, evaluation and attribution, all on Spark ML.

* encoding: ``StringIndexer`` with alphabetical codes (S37), fed to the trees
  as ordinal numbers: splits are thresholds, not sets of categories;
* class weight: negatives / positives on the positive class (boosted),
  ``n / (2 n_c)`` per class (forest, "balanced");
* fit on sufficient statistics: one row per distinct (features, label) with
  the sum of its rows' weights, so the fit stops growing once all tuples have
  been seen; the forest (``forest.py``) draws Poisson(rows) of each tuple;
* boosted trees: ``GBTClassifier`` (first-order boosting, so scores are not
  numerically equal to the reference's second-order library; ranking quality
  and repeatability are what is promised);
* evaluation uses a hash-stratified 80/20 split whose per-class cut is an
  exact distributed quantile of the hash, exact ROC-AUC from distributed
  running totals, and one-pass confusion counts;
* attribution is exact Shapley of the margin against all background rows:
  what a leaf adds to a coalition depends on whether the row or the background
  passes each of its conditions, so its share of the 2^7 coalitions is a closed
  form.  One pass counts the background rows of each leaf and set of passed
  conditions; each distinct feature tuple is then looked at once, in its task,
  leaf by leaf of the fitted trees, and joined back to the orders.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lateline.config import DEFAULT_CONFIG, Config
from lateline.functions.buckets import risk_level
from lateline.functions.columns import with_scalars
from lateline.operators.forest import fit_forest
from lateline.operators.quantiles import running_totals, select_quantiles
from lateline.session import staged

#: Fixed values of the reference: features, the categorical ones, result columns.
FEATURES = ["customer_state", "seller_state", "purchase_month", "purchase_dayofweek",
            "purchase_hour", "freight_bucket", "seller_cohort"]
FACT_COLS = [*FEATURES, "order_id", "is_late"]
CATEGORICAL = ["customer_state", "seller_state", "freight_bucket", "seller_cohort"]
RISK_COLS = ["order_id", "customer_state", "seller_state", "seller_cohort", "purchase_month",
             "freight_bucket", "late_probability", "late_prediction", "risk_level", "is_late"]


def ml_features(fact: DataFrame) -> DataFrame:
    """Seven features, id and label; rows with any null are dropped."""
    return fact.select(*FEATURES, "order_id", "is_late").dropna()


def _encoded_names() -> list[str]:
    return [f"{c}_ord" if c in CATEGORICAL else c for c in FEATURES]


def grouped_rows(rows: DataFrame) -> DataFrame:
    """Distinct (features, label) with the number ``n`` of their rows."""
    return rows.groupBy(*FEATURES, "is_late").agg(F.count(F.lit(1)).alias("n"))


def with_class_weight(df: DataFrame, mode: str = "positive") -> DataFrame:
    """``positive``: weight neg/pos on positives, 1 on negatives;
    ``balanced``: n / (2 n_class).  Counts come from one aggregate; a grouped
    row weighs as much as its ``n`` rows."""
    y = F.col("is_late")
    n = F.col("n") if "n" in df.columns else F.lit(1)
    cnt = df.agg(F.sum(F.when(y == 0, n)).alias("_neg"), F.sum(F.when(y == 1, n)).alias("_pos"))
    j = with_scalars(df, cnt)
    neg = F.nullif(F.coalesce(F.col("_neg"), F.lit(0)).cast("double"), F.lit(0.0))
    pos = F.nullif(F.coalesce(F.col("_pos"), F.lit(0)).cast("double"), F.lit(0.0))
    if mode == "balanced":
        w = F.when(y == 1, (neg + pos) / (2 * pos)).otherwise((neg + pos) / (2 * neg))
    else:
        w = F.when(y == 1, neg / pos).otherwise(F.lit(1.0))
    return j.withColumn("weight", w * n).drop("_neg", "_pos")


def _encoding() -> list:
    idx = StringIndexer(inputCols=CATEGORICAL, outputCols=[f"{c}_code" for c in CATEGORICAL],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    # an expression of a code has no nominal attribute: the trees see an ordered number
    ordinal = SQLTransformer(statement="SELECT *, " + ", ".join(f"{c}_code + 0D AS {c}_ord" for c in CATEGORICAL) + " FROM __THIS__")
    asm = VectorAssembler(inputCols=_encoded_names(), outputCol="features")
    return [idx, ordinal, asm]


def max_bins(train: DataFrame, least: int = 64) -> int:
    """Bins for the trees: as many as the widest categorical feature has
    values, with a slot for unseen ones (one aggregate), so that every
    threshold between two codes is a candidate."""
    row = train.agg(*[F.countDistinct(c).alias(c) for c in CATEGORICAL]).first()
    return max(least, *[(row[c] or 0) + 2 for c in CATEGORICAL])


#: A split gains more than rounding: equal sums in another order then grow the same trees.
LEAST_GAIN = 1e-9


def train_boosted(train: DataFrame, cfg: Config = DEFAULT_CONFIG, grouped: bool = True) -> PipelineModel:
    # one table for the indexer, the bins, the weights and every tree
    rows = staged(grouped_rows(train) if grouped else train, "risk-train")
    gbt = GBTClassifier(labelCol="is_late", featuresCol="features", weightCol="weight",
                        maxIter=cfg.gbt_trees, maxDepth=cfg.gbt_depth, stepSize=cfg.gbt_step,
                        seed=cfg.seed, maxBins=max_bins(rows), minInfoGain=LEAST_GAIN)
    return Pipeline(stages=[*_encoding(), gbt]).fit(with_class_weight(rows, "positive"))


def train_forest(train: DataFrame, cfg: Config = DEFAULT_CONFIG) -> PipelineModel:
    rows = staged(grouped_rows(train), "risk-train")
    rf = RandomForestClassifier(labelCol="is_late", featuresCol="features", weightCol="weight",
                                numTrees=cfg.forest_trees, maxDepth=cfg.forest_depth,
                                seed=cfg.seed, minInfoGain=LEAST_GAIN)
    return fit_forest(Pipeline(stages=_encoding()).fit(rows), rows, rf)


def score_risk(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Probability of lateness (4 decimals, half-even), class at 0.5, level."""
    p = F.bround(vector_to_array(F.col("probability"))[1], 4)
    scored = model.transform(df)
    return (scored.withColumn("late_probability", p)
            .withColumn("late_prediction", F.col("prediction").cast("int"))
            .withColumn("risk_level", risk_level("late_probability"))
            .drop("features", "rawPrediction", "probability", "prediction",
                  *[f"{c}_{kind}" for c in CATEGORICAL for kind in ("code", "ord")]))


def fact_late_risk(fact: DataFrame, cfg: Config = DEFAULT_CONFIG,
                   model: PipelineModel | None = None) -> DataFrame:
    """Fit on all feature rows and score the same rows (pipeline behaviour)."""
    rows = ml_features(fact)
    model = model or train_boosted(rows, cfg)
    return score_risk(model, rows).select(*RISK_COLS)


# ------------------------------------------------------------------ evaluation
def split_hash(seed: int) -> "F.Column":
    return F.xxhash64(F.col("order_id"), F.lit(seed))


def stratified_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42):
    """Per class, the rows whose seeded hash is at or below the class's exact
    (1 - test_fraction) quantile of hashes train; the rest test.  Exact
    proportions per class; membership differs from the reference's shuffle."""
    h = df.withColumn("_h", split_hash(seed).cast("double"))
    cuts = select_quantiles(h, {f"c{y}": (F.when(F.col("is_late") == y, F.col("_h")), {f"_cut{y}": 1.0 - test_fraction}) for y in (0, 1)})
    # two rows, one per class
    cut = cuts.select(F.inline(F.array(*[F.struct(F.lit(y).alias("is_late"), F.col(f"_cut{y}").alias("_cut")) for y in (0, 1)])))
    j = h.join(F.broadcast(cut), "is_late")
    train = j.where(F.col("_h") <= F.col("_cut")).select(*df.columns)
    test = j.where(F.col("_h") > F.col("_cut")).select(*df.columns)
    return train, test


def split_report(train: DataFrame, test: DataFrame) -> DataFrame:
    t = train.agg(F.count(F.lit(1)).alias("n"), F.avg("is_late").alias("late_rate")) \
        .withColumn("split", F.lit("train"))
    s = test.agg(F.count(F.lit(1)).alias("n"), F.avg("is_late").alias("late_rate")) \
        .withColumn("split", F.lit("test"))
    return t.unionByName(s)


def roc_auc_exact(scored: DataFrame, score: str = "late_probability", label: str = "is_late") -> DataFrame:
    """AUC = P(score_pos > score_neg) + 0.5 P(tie), from positives/negatives
    per distinct score and distributed running counts of negatives below."""
    per = scored.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    per = staged(per, "auc-counts")  # read three times; the rows are scored once
    run = running_totals(per, "_s", ["neg"])
    return run.agg(((F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))))
                    / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("roc_auc"),
                   F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    return (scored.groupBy(F.col("is_late").alias("actual"),
                           F.col("late_prediction").alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class plus macro and weighted
    averages, from one aggregate of TP/FP/FN."""
    y, p = F.col("is_late"), F.col("late_prediction")
    c = scored.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                   F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))

    def cls(name, tp, fp, fn):
        prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
        rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        return prec, rec, f1, (tp + fn)

    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1, s1 = cls("1", tp, fp, fn)
    p0, r0, f0, s0 = cls("0", tn, fn, fp)
    n = F.nullif(s0 + s1, F.lit(0.0))

    def row(label, pr, rc, f, s):
        return F.struct(F.lit(label).alias("label"), pr.alias("precision"), rc.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"))
    rows = F.array(row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
                   row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
                   row("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                       (f0 * s0 + f1 * s1) / n, n))
    return c.select(F.inline(rows))


def evaluate(model: PipelineModel, test: DataFrame, name: str) -> DataFrame:
    """One row per model: AUC, recall and precision of the late class, counts."""
    s = staged(score_risk(model, test).select("late_probability", "late_prediction", "is_late"), "risk-scored")
    y, p = F.col("is_late"), F.col("late_prediction")
    c = s.agg(F.count_if((y == 1) & (p == 1)).alias("true_positives"),
              F.count_if((y == 1) & (p == 0)).alias("misses"),
              F.count_if((y == 0) & (p == 1)).alias("false_alarms"))
    auc = roc_auc_exact(s).select("roc_auc")
    out = with_scalars(c, auc).withColumn("model", F.lit(name))
    tp, fn, fp = (F.col(x).cast("double") for x in ("true_positives", "misses", "false_alarms"))
    return out.select("model", "roc_auc", (tp / F.nullif(tp + fn, F.lit(0.0))).alias("recall"),
                      (tp / F.nullif(tp + fp, F.lit(0.0))).alias("precision"),
                      "true_positives", "misses", "false_alarms")


def model_comparison(boosted: PipelineModel, forest: PipelineModel, test: DataFrame) -> DataFrame:
    return evaluate(forest, test, "forest").unionByName(evaluate(boosted, test, "boosted"))


def feature_importance(model: PipelineModel, name: str = "boosted") -> DataFrame:
    """Importances of the fitted trees (a 7-entry vector in the model)."""
    spark = model.stages[0].sparkSession if hasattr(model.stages[0], "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(FEATURES, imp), key=lambda r: (-r[1], r[0]))
    df = spark.createDataFrame([(name, f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                               "model string, feature string, importance double, rank int")
    return df


def top_features(importances: DataFrame, n: int = 3) -> DataFrame:
    return importances.orderBy("rank").limit(n)


def risk_distribution(scored: DataFrame) -> DataFrame:
    counts = scored.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))
    # a row for each level: a window over them, so that the rows are scored once
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select("risk_level", "n", (F.col("n") / total).alias("share"))


# ------------------------------------------------------------------ attribution
#: Rows of a small background set: the least seeded hashes of distinct feature tuples.
BACKGROUND = 4


def background_rows(rows: DataFrame, n: int = BACKGROUND, seed: int = 42) -> DataFrame:
    """A fixed, repeatable set of ``n`` rows that absent features can be taken from."""
    tuples = rows.select(*FEATURES).distinct()
    return tuples.orderBy(F.xxhash64(*FEATURES, F.lit(seed)), *FEATURES).limit(n)


def baseline_row(rows: DataFrame) -> DataFrame:
    """A background of one row: the most frequent value of every feature (ties -> smallest)."""
    return rows.agg(*[F.mode(F.col(c), True).alias(c) for c in FEATURES])


def tree_leaves(model: PipelineModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves of the boosted model's trees: what each adds to the margin, and
    per feature the open lower and closed upper end that a row must lie in."""
    value, low, high = [], [], []
    weight, path = 1.0, []
    for line in model.stages[-1].toDebugString.split("\n"):
        if m := re.match(r"\s*Tree \d+ \(weight (\S+)\)", line):
            weight, path = float(m[1]), []
        elif m := re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            if m[1] == "Else":  # the other branch of the last node whose first is done
                while path.pop()[0] != "If":
                    pass
            path.append((m[1], int(m[2]), m[3], float(m[4])))
        elif m := re.match(r"\s*Predict: (\S+)", line):
            lo, hi = np.full(len(FEATURES), -np.inf), np.full(len(FEATURES), np.inf)
            for _, f, op, at in path:
                if op == "<=":
                    hi[f] = min(hi[f], at)
                else:
                    lo[f] = max(lo[f], at)
            value.append(2 * weight * float(m[1]))
            low.append(lo)
            high.append(hi)
    return np.array(value), np.array(low), np.array(high)


def _leaf_shares() -> np.ndarray:
    """(needed, spoilt) -> Shapley value of each feature in the game that a
    coalition wins when it has all features of ``needed`` and none of
    ``spoilt``; both are bit masks, without a common feature."""
    m = len(FEATURES)
    f = math.factorial
    out = np.zeros((2 ** m, 2 ** m, m))
    for need in range(2 ** m):
        for spoil in range(2 ** m):
            if need & spoil:
                continue
            a, k = need.bit_count(), spoil.bit_count()
            for i in range(m):
                if need >> i & 1:
                    out[need, spoil, i] = f(a - 1) * f(k) / f(a + k)
                elif spoil >> i & 1:
                    out[need, spoil, i] = -f(a) * f(k - 1) / f(a + k)
    return out


def passed(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per row and leaf the bit mask of the features that lie in the leaf's ends."""
    out = np.zeros((len(x), len(low)), np.uint8)
    for i in range(x.shape[1]):
        values, at = np.unique(x[:, i], return_inverse=True)
        ok = (values[:, None] > low[:, i]) & (values[:, None] <= high[:, i])
        out |= (ok.astype(np.uint8) << i)[at]
    return out


def background_counts(masks: np.ndarray, n: np.ndarray, block: int = 256) -> np.ndarray:
    """Per leaf and bit mask the number of rows; a row of ``masks`` stands for ``n`` of them."""
    leaves, size = masks.shape[1], 2 ** len(FEATURES)
    out = np.zeros((leaves, size))
    for at in range(0, leaves, block):
        some = masks[:, at:at + block]
        k = some.shape[1]
        out[at:at + k] = np.bincount((some + np.arange(k) * size).ravel(), np.repeat(n, k), k * size).reshape(k, size)
    return out


def leaf_table(value: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Per leaf and bit mask of a row: what the leaf adds to the row's
    contributions, averaged over all background rows, and to its margin."""
    m, size = len(FEATURES), len(shares)
    # only the row can pass what the background fails; only the background passes what the row fails
    game = shares[::-1, ::-1].reshape(size, size * m)
    rows = counts[0].sum()
    out = np.zeros((len(value), size, m + 1))
    out[:, :, :m] = (counts / rows @ game).reshape(len(value), size, m) * value[:, None, None]
    out[:, size - 1, m] = value
    return out


def leaf_shapley(masks: np.ndarray, table: np.ndarray, block: int = 64) -> np.ndarray:
    """Per row its contributions and its margin, leaf by leaf."""
    out = np.zeros((len(masks), table.shape[2]))
    for at in range(0, len(table), block):
        part = table[at:at + block]
        slot = masks[:, at:at + block] + np.arange(len(part)) * table.shape[1]
        out += (np.ones((1, len(part))) @ part.reshape(-1, table.shape[2]).take(slot, 0))[:, 0]
    return out


def margin(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the boosted model's margin, the log-odds of lateness, as ``_f``."""
    raw = vector_to_array(F.col("rawPrediction"))[1] * 2
    return model.transform(df).select(*df.columns, raw.alias("_f"))


def _background(encoder: PipelineModel, background: DataFrame, leaves: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """``background_counts`` of all rows of ``background``: every task counts its tuples."""
    shared = background.sparkSession.sparkContext.broadcast(leaves)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, low, high = shared.value
        total = np.zeros((len(value), 2 ** len(FEATURES)))
        for b in batches:
            x, n = _matrix(b.column(0)), b.column(1).to_numpy()
            for at in range(0, len(x), 512):
                total += background_counts(passed(x[at:at + 512], low, high), n[at:at + 512])
        slot = np.flatnonzero(total)
        for at in range(0, len(slot), 1 << 16):
            some = slot[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total.take(some).astype(np.int64))], ["slot", "n"])

    tuples = background.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n"))
    part = encoder.transform(tuples).select(vector_to_array("features").alias("x"), "n").mapInArrow(count, "slot long, n long")
    found = part.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most the leaves' masks
    out = np.zeros((len(leaves[0]), 2 ** len(FEATURES)))
    np.put(out, found["slot"].to_numpy(), found["n"].to_numpy())
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(FEATURES))


def attribution(model: PipelineModel, rows: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """Exact Shapley contributions of the 7 features to the margin of the
    boosted model, absent features averaged over all background rows, by
    default all ``rows``: (order_id, feature, contribution, base_value, value).
    Contributions sum to value - base_value for every row."""
    background = rows if background is None else background
    encoder = PipelineModel(model.stages[:-1])
    leaves = tree_leaves(model)
    counts = _background(encoder, background, leaves)
    known = bool(counts.any())
    base = float(leaves[0] @ counts[:, -1] / counts[0].sum()) if known else 0.0
    shared = rows.sparkSession.sparkContext.broadcast((leaves, counts))

    @F.pandas_udf(ArrayType(DoubleType()))
    def shapley(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        (value, low, high), counts = shared.value
        table = leaf_table(value, counts, _leaf_shares())
        for b in batches:
            x = np.stack(b.to_numpy()) if len(b) else np.zeros((0, len(FEATURES)))
            out = [leaf_shapley(passed(x[at:at + 512], low, high), table) for at in range(0, len(x), 512)]
            yield pd.Series([r for o in out for r in o], dtype=object)

    # one row per order: fan-out copies (one per review) carry identical features
    orders = rows.select("order_id", *FEATURES).distinct()
    tuples = orders.select(*FEATURES).distinct()
    if not known:
        tuples = tuples.where(F.lit(False))
    found = encoder.transform(tuples).select(*FEATURES, shapley(vector_to_array("features")).alias("_s"))
    per_tuple = found.select(*FEATURES, *[F.col("_s")[i].alias(c) for i, c in enumerate([*[f"_c_{c}" for c in FEATURES], "value"])])
    per_row = orders.join(per_tuple, FEATURES).drop(*FEATURES).withColumn("base_value", F.lit(base))
    return per_row.select("order_id", "base_value", "value", *[F.col(f"_c_{c}").alias(c) for c in FEATURES]).unpivot(
        ["order_id", "base_value", "value"], FEATURES, "feature", "contribution")


def attribution_global(contrib: DataFrame) -> DataFrame:
    return (contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
            .orderBy(F.desc("mean_abs_contribution"), "feature"))


def attribution_row(contrib: DataFrame, rows: DataFrame, order_id) -> DataFrame:
    """One order's feature values (decoded labels, not codes) with their
    contributions.  ``order_id`` is a value or a one-row DataFrame of it."""
    if isinstance(order_id, DataFrame):
        pick = order_id.select("order_id")
    else:
        pick = rows.sparkSession.createDataFrame([(str(order_id),)], "order_id string")
    one = rows.join(pick, "order_id").select(
        "order_id", *[F.col(c).cast("string").alias(c) for c in FEATURES]).distinct()
    vals = one.unpivot(["order_id"], FEATURES, "feature", "feature_value")
    return contrib.join(pick, "order_id").join(vals, ["order_id", "feature"])
