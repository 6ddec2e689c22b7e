"""Language identification by words first, character n-grams as a fallback.

A word that the model knows scores its smoothed log frequency in each
language.  An unknown word falls back to its character n-grams: the longest
order of which the model knows any n-gram decides, then shorter ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.llm.common import Stage, bounded_sample, text_batches

UNKNOWN = "und"
#: Runs of letters (and the few other marks that \w takes beside digits and _).
_RUNS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LangModel:
    """Tables of a fitted model: all words and n-grams of the rows it learned from."""

    langs: tuple[str, ...]
    log_prior: np.ndarray          # per language
    words: dict[str, int]          # word -> row of table
    grams: dict[str, int]          # "^ab" -> row of table
    table: np.ndarray              # rows x languages, log frequencies
    max_order: int


def fit(docs: DataFrame, *, label: str = "lang", text: str = "text", key: str = "doc_id",
        max_docs: int = 10_000, max_order: int = 5, alpha: float = 0.5) -> LangModel:
    """Learn from the rows of ``docs`` with a label and a text.

    At most about ``max_docs`` rows are learned from, picked by a hash of
    ``key``.  Words and n-grams are counted by Spark per language; all of them
    are the model.  No usable row gives a model without languages.
    """
    spark = docs.sparkSession
    stage = Stage(spark)
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = bounded_sample(rows, F.col(key), max_docs).select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text"))
    word = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    counts = rows.select("lang", word).where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n"))
    counts = stage.save(counts, "words")
    prior = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = tuple(sorted(prior))
    if not langs:
        return LangModel((), np.zeros(0), {}, {}, np.zeros((0, 0)), max_order)
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    # a lambda with a second parameter would get the index there
    part = lambda k: lambda i: F.substring(padded, i, F.lit(k))
    grams = None
    for k in range(1, max_order + 1):
        g = counts.where(F.length("word") + 2 >= k).select("lang", "n", F.explode(F.transform(
            F.sequence(F.lit(1), F.length("word") + 3 - k), part(k))).alias("gram"))
        grams = g if grams is None else grams.union(g)
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    grams = stage.save(grams, "grams")
    at = {x: i for i, x in enumerate(langs)}

    def table(df: DataFrame, col: str) -> tuple[dict[str, int], np.ndarray]:
        """All keys, the most frequent first, with their counts per language."""
        got = df.select("lang", col, "n").toArrow()
        keys, by = (got.column(c).combine_chunks().dictionary_encode() for c in (col, "lang"))
        m = np.zeros((len(keys.dictionary), len(langs)))
        lang = np.array([at[x] for x in by.dictionary.to_pylist()], np.int64)
        if len(got):
            np.add.at(m, (keys.indices.to_numpy(), lang[by.indices.to_numpy()]), got.column("n").to_numpy())
        names = keys.dictionary.to_pylist()
        totals = m.sum(1)
        order = sorted(range(len(names)), key=lambda i: (-totals[i], names[i]))
        return {names[i]: k for k, i in enumerate(order)}, m[order]

    words, wm = table(counts, "word")
    gram_ids, gm = table(grams, "gram")
    total = np.maximum(1.0, wm.sum(0))
    wl = np.log((wm + alpha) / (total + alpha * (len(words) + 1)))
    gl = np.zeros_like(gm)
    order = np.array([len(g) for g in gram_ids]) if gram_ids else np.zeros(0, int)
    for k in range(1, max_order + 1):
        pick = order == k
        if pick.any():
            gl[pick] = np.log((gm[pick] + alpha) / (gm[pick].sum(0) + alpha * (pick.sum() + 1)))
    share = np.array([prior[x] for x in langs], float)
    return LangModel(langs, np.log(share / share.sum()), words,
                     {g: i + len(words) for g, i in gram_ids.items()}, np.vstack([wl, gl]), max_order)


class Scorer:
    """Scores texts with a model; keeps the scores of unknown words it has met
    (a bounded cache: it is emptied when full)."""

    def __init__(self, model: LangModel, cache: int = 100_000):
        self.m, self.cache = model, cache
        self.table = np.vstack([model.table, np.zeros((cache, len(model.langs)))]) if model.langs else None
        self.reset()

    def reset(self) -> None:
        self.ids = dict(self.m.words)
        self.n = len(self.m.table)

    def unknown(self, word: str) -> int:
        """Adds a word that the model lacks, scored by its n-grams."""
        m = self.m
        w = f"^{word}$"
        score = None
        for k in range(min(m.max_order, len(w)), 0, -1):
            rows = [r for i in range(len(w) - k + 1) if (r := m.grams.get(w[i:i + k])) is not None]
            if rows:
                score = m.table[rows].mean(0)
                break
        if self.n == len(self.table):
            self.reset()
        self.table[self.n] = 0.0 if score is None else score
        self.ids[word] = self.n
        self.n += 1
        return self.n - 1

    def score(self, text: str | None) -> tuple[str, float]:
        m = self.m
        words = _RUNS.findall(text.lower()) if text else []
        if not words or not m.langs:
            return UNKNOWN, 0.0
        if self.n + len(words) > len(self.table):
            self.reset()
            if len(words) > self.cache:      # a huge text: in parts
                total = m.log_prior.copy()
                letter = False
                for i in range(0, len(words), self.cache):
                    self.reset()
                    part, seen = self.total(words[i:i + self.cache])
                    total, letter = total + part, letter or seen
                return self.answer(total, letter)
        part, letter = self.total(words)
        return self.answer(m.log_prior + part, letter)

    def total(self, words: list[str]) -> tuple[np.ndarray, bool]:
        get, known = self.ids.get, len(self.m.words)
        rows = [get(w, -1) for w in words]
        if -1 in rows:
            rows = [r if r >= 0 else (get(w) if w in self.ids else self.unknown(w)) for r, w in zip(rows, words, strict=True)]
        # only a text without any known word may lack letters
        letter = min(rows) < known or any(c.isalpha() for w in words for c in w)
        return self.table[rows].sum(0), letter

    def answer(self, total: np.ndarray, letter: bool) -> tuple[str, float]:
        if not letter:
            return UNKNOWN, 0.0
        p = np.exp(total - total.max())
        i = int(p.argmax())
        return self.m.langs[i], float(p[i] / p.sum())


def identify(docs: DataFrame, model: LangModel, *, text: str = "text", pred: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and the posterior of it (0 to 1).

    Columns of these names are replaced.  Null texts, empty texts and texts
    without a letter give ``und`` with score 0; so does a model without
    languages.  Equal posteriors go to the first language by name.  Every row
    is scored on its whole text, whatever else the table holds.
    """
    spark = docs.sparkSession
    text_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in (pred, score)]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*src.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches):
        s = Scorer(shared.value)
        for b in batches:
            col = b.column(keep.index(text))
            out = [s.score(x.as_py()) for x in col]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                names=[*keep, pred, score])

    return src.mapInArrow(run, schema)


def rejected(pred: Column, score: Column, least: float = 0.5) -> Column:
    """Rows without a language, or whose best language is less likely than not."""
    return (pred == UNKNOWN) | (score < least)
