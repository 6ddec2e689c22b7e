"""Quality rules with DataFrame expressions only: measures of a text by
itself, and lines that too many documents of a host share.

Lines are normalised and hashed; for every host the distinct documents that
hold a line are counted (equal texts are one document, so copies of a page do
not condemn each other).  Lines above the limits are boilerplate: they are
removed, and a document that loses most of its words that way is rejected.

A line above the share limit is in a fixed part of the host's documents, so a
host has few of them: at most lines per document / share, whatever its size.
They travel as one array per host, and documents are never joined line by line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import WORD, Stage

#: A line is boilerplate in more than this share of a host's distinct
#: documents, and in this many of them at least.
LINE_SHARE = 0.05
LINE_DOCS = 20
#: A document is depleted if less than this share of its words remains.
LEAST_LEFT = 0.3
#: Up to so many boilerplate lines (8 bytes each) and hosts go to every task.
BROADCAST_LINES = 1_000_000

#: Fixed values of the contract.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent
SYMBOLS = "#*$%&|<>"
_SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_lines(text: Column) -> Column:
    """Lines with a word, as they stand."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space as single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]", "0"), _SPACE + "+", " "))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more."""

    def places(windows: Column) -> Column:
        # equal windows lie side by side once sorted; both ends of each such pair count
        def near(s: Column) -> Column:
            m = F.size(s) - 1
            z = F.arrays_zip(F.slice(s, 1, m).alias("a"), F.slice(s, 2, m).alias("b"))
            twice = F.filter(z, lambda p: p["a"]["h"] == p["b"]["h"])
            at = F.flatten(F.transform(twice, lambda p: F.array(p["a"]["i"], p["b"]["i"])))
            cover = F.flatten(F.transform(F.array_distinct(at), lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(cover))

        numbered = F.arrays_zip(windows.alias("h"), F.sequence(F.lit(1), F.size(windows)).alias("i"))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.sort_array(numbered), near))

    def of(w: Column) -> Column:
        n = F.size(w) - 2
        z = F.arrays_zip(F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"))
        return F.when(n < 2, F.lit(0)).otherwise(let(F.transform(z, lambda x: F.xxhash64(x)), places))

    return let(words, of)


def boilerplate(stage: Stage, docs: DataFrame, text: str, host: str) -> DataFrame:
    """``(host, lines)``: hashes of each host's boilerplate lines."""
    lines = F.array_distinct(F.transform(text_lines(F.col(text)), lambda x: F.xxhash64(normalised(x))))
    d = docs.where(F.col(text).isNotNull()).select(
        F.col(host).cast("string").alias("host"), F.xxhash64(text).alias("doc"), lines.alias("lines"))
    d = stage.save(d, "lines")
    hosts = d.groupBy("host", "doc").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("docs"))
    seen = (d.select("host", "doc", F.explode("lines").alias("line")).distinct()
            .groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= LINE_DOCS))
    hosts = stage.save(hosts, "hosts").select(F.col("host").alias("h"), "docs")
    above = seen.join(hosts, F.col("host").eqNullSafe(F.col("h"))).where(F.col("n") > LINE_SHARE * F.col("docs"))
    return stage.save(above.groupBy("host").agg(F.collect_list("line").alias("lines")), "boilerplate")


def apply_rules(docs: DataFrame, *, text: str = "text", host: str = "source", out: str = "rules") -> DataFrame:
    """``docs`` with a struct column ``out`` (one of that name is replaced):
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long),
    ``n_left`` (words outside boilerplate lines), ``base_failed`` and ``kept``.

    Null texts have no words and fail; a null host is a host of its own.
    Repeated rows are judged alike; an empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession)
    common = boilerplate(stage, docs, text, host).select(F.col("host").alias("__host"), F.col("lines").alias("__common"))
    size = common.agg(F.coalesce(F.sum(F.size("__common") + 1), F.lit(0))).first()[0]
    common = F.broadcast(common) if size <= BROADCAST_LINES else common
    cols = [c for c in docs.columns if c != out]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("d"), F.col(host).cast("string").alias("s"),
                    F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.join(common, F.col("s").eqNullSafe(F.col("__host")), "left")
    t, none = F.col("t"), F.array().cast("array<bigint>")
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    plain = F.translate(t, " \t\n\x0b\x0c\r", "")
    removed = let(F.coalesce("__common", none), lambda c: F.when(F.size(c) == 0, F.lit(0)).otherwise(F.aggregate(
        text_lines(t), F.lit(0), lambda n, x: n + F.when(
            F.array_contains(c, F.xxhash64(normalised(x))), F.regexp_count(x, F.lit(WORD))).otherwise(0))))
    measures = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")))
    lines = let(text_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    d = d.select("d", measures.alias("m"), F.char_length(plain).cast("long").alias("word_chars"),
                 (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 lines.cast("long").alias("n_dup_lines"), removed.cast("long").alias("removed"))
    n = F.col("m.n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("m.n_repeat_words") > MOST_REPEATED * n)
    left = n - F.col("removed")
    return d.select(*[F.col(f"d.`{c}`") for c in cols], F.struct(
        "m.n_words", "word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", left.alias("n_left"),
        failed.alias("base_failed"), (~failed & (left >= LEAST_LEFT * n)).alias("kept")).alias(out))
