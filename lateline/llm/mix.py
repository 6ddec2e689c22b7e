"""Mixing sources to target weights, with DataFrame expressions only.

Every document gets a hash-random key.  Within a source the documents lie in
key order; a source's budget takes whole turns ("epochs") over that order and
then a leading part of one more.  Prefix sums are distributed: the key range
of a source is cut into buckets in proportion to its number of documents, the
bucket totals are summed up first, and only the one bucket in which the budget
ends is sorted at all.  A hot source has more buckets, not a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.common import WORD, Stage

#: Fixed values of the contract.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2

#: Documents of one key bucket, on average; a parameter of the layout only.
BUCKET_ROWS = 2_000
#: Up to so many sources the table of budgets is sent to every task (about
#: 100 bytes each); beyond that it is joined by shuffles.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(stage: Stage, sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, n_docs)`` -> the same with ``weight`` and ``target``.

    Weights repeat in the order of the sources' code points, null last.  All
    targets sum to ``share`` of all sizes; a target stops at ``max_epochs``
    times its source's size and the excess goes to the others by weight, again
    and again until none is above.  One row per source; the rounds stop when no
    further source is capped.  The rank needs the sources in one order: that is
    one small row per source, not per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = stage.save(sizes.withColumn("weight", w), "sources")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, n_capped = None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("weight") * level >= cap
        got = s.agg(F.sum(F.when(capped, cap).otherwise(0.0)).alias("c"),
                    F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("w"),
                    F.sum(capped.cast("int")).alias("n")).first()
        if not got["w"] or got["n"] == n_capped:
            break
        level, n_capped = max(0.0, share * total - got["c"]) / got["w"], got["n"]
    if level is None:
        return s.withColumn("target", F.lit(0.0))
    # six decimals: the sum of doubles above is not exact beyond that
    return s.withColumn("target", F.round(F.least(cap, F.col("weight") * level), 6))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        out: str = "mix") -> DataFrame:
    """Per row of ``docs``: all its columns, and in a struct column ``out``
    (replacing one of that name) ``size`` (words), ``source_size``, ``target`` (its source's) and ``taken``
    (words that the mix takes, repeats counted).

    The document in which the budget ends is taken with its first words only,
    so a source's taken words equal its target, rounded down.  The key is the
    md5 of id and text: reruns agree, and rows with equal id and text are
    interchangeable.  Null text or ids count as empty; a null source is a
    source of its own; an empty table gives an empty result.
    """
    spark, stage = docs.sparkSession, Stage(docs.sparkSession)
    text = F.col(text_col)
    size = n_words(text)
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                         F.md5(F.coalesce(text, F.lit("")))))
    # the key's first 52 bits as a fraction of the range
    unit = F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / float(1 << 52)
    slim = stage.save(docs.select(F.col(source_col).cast("string").alias("source"), size.alias("size"),
                                  key.alias("key"), unit.alias("unit")), "sizes")
    per = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    goal = targets(stage, per, weights, share, max_epochs)
    goal = (goal.withColumn("n_buckets", F.ceil(F.col("n_docs") / BUCKET_ROWS))
            .withColumn("budget", F.floor("target").cast("long"))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")))
    goal = stage.save(goal, "budgets")
    bounded = goal.count() <= BROADCAST_SOURCES
    small = F.broadcast(goal) if bounded else goal

    def bucketed(unit: Column) -> Column:
        return F.floor(unit * F.col("n_buckets")).cast("long")

    # the bucket in which each source's rest ends
    b = (slim.join(small.select(F.col("source").alias("s2"), "n_buckets"), F.col("source").eqNullSafe(F.col("s2")))
         .withColumn("bucket", bucketed(F.col("unit")))
         .groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    b = b.withColumn("before", before)
    cut = (b.join(goal.select(F.col("source").alias("s2"), "rest"), F.col("source").eqNullSafe(F.col("s2")))
           .where("before < rest and rest <= before + words")
           .select("source", F.col("bucket").alias("cut_bucket"), F.col("before").alias("cut_before")))
    # within that bucket: the document in which the rest ends
    ends = (goal.join(cut.withColumnRenamed("source", "s3"), F.col("source").eqNullSafe(F.col("s3")))
            .select(F.col("source").alias("s2"), "n_buckets", "rest", "cut_bucket", "cut_before"))
    ends = stage.save(ends, "cuts")
    inside = (slim.join(F.broadcast(ends) if bounded else ends, F.col("source").eqNullSafe(F.col("s2")))
              .where(bucketed(F.col("unit")) == F.col("cut_bucket")))
    # equal keys (repeated rows) are one step of the sum, shared out below
    steps = inside.groupBy("source", "key", "cut_before", "rest").agg(
        F.sum("size").alias("words"), F.count("*").alias("copies"))
    run = (F.sum("words").over(Window.partitionBy("source").orderBy("key")) - F.col("words") + F.col("cut_before"))
    at = (steps.withColumn("from", run).where("from < rest and rest <= from + words")
          .select("source", F.col("key").alias("cut_key"), (F.col("rest") - F.col("from")).alias("cut_words"),
                  F.col("copies").alias("cut_copies")))
    plan = (goal.alias("g").join(at.alias("a"), F.col("g.source").eqNullSafe(F.col("a.source")), "left")
            .select(F.col("g.source").alias("s2"), "source_size", "target", "epochs", "cut_key", "cut_words", "cut_copies"))
    plan = stage.save(plan, "plan")
    rows = docs.select(F.struct("*").alias("doc"), F.col(source_col).cast("string").alias("s1"),
                       size.alias("size"), key.alias("key"))
    rows = rows.join(F.broadcast(plan) if bounded else plan, F.col("s1").eqNullSafe(F.col("s2")))
    part = (F.when(F.col("cut_key").isNull() | (F.col("key") > F.col("cut_key")), F.lit(0))
            .when(F.col("key") < F.col("cut_key"), F.col("size"))
            .otherwise(F.floor(F.col("cut_words") / F.col("cut_copies")))).cast("long")
    took = F.struct("size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))
    return rows.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c != out], took.alias(out))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it was."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, n.cast("int")), "")


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: each document once per whole turn, and the document at
    a source's cut once more with the words that still fit.  Columns as in
    ``docs`` (``n_chars``, where there is one, follows a shortened text)."""
    text = kw.get("text_col", "text")
    m = mix(docs, out="__mix", **kw)
    size, taken = F.col("__mix.size"), F.col("__mix.taken")
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(F.lit(0)).cast("int")
    rest = F.when(size > 0, taken - whole * size).otherwise(F.lit(0))
    turns = F.concat(F.array_repeat(size, whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    m = m.select(F.struct("*").alias("r"), F.explode(turns).alias("take"))
    short = F.col("take") < F.col("r.__mix.size")
    cut_text = F.when(short, first_words(F.col(f"r.{text}"), F.col("take"))).otherwise(F.col(f"r.{text}"))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(cut_text.alias(c))
        elif c == "n_chars":
            out.append(F.when(short, F.char_length(cut_text).cast(docs.schema[c].dataType)).otherwise(F.col("r.n_chars")).alias(c))
        else:
            out.append(F.col(f"r.`{c}`").alias(c))
    return m.select(*out)
