"""Registered queries of the corpus operators: each applies its operator with
production parameters to the whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.llm import alignment, embeddings, jaccard, langid, lm, mix, packing, quality, rules, secrets, substring, suffixes, whitening
from lateline.llm.common import bounded_sample, fold, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Labelled rows that op2 learns from, at most (about; picked by a hash of the id).
OP2_LABELS = 3_000


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold("doc_id", 4) == 2
    labels = read_table(spark, sf_dir, "labels").where(~held & F.col("quality").isin(0, 1))
    labels = bounded_sample(labels, F.col("doc_id"), OP2_LABELS).select(F.col("doc_id").alias("id"), "quality")
    labelled = docs.join(F.broadcast(labels), F.col("doc_id") == F.col("id"))
    model = quality.fit(labelled, max_docs=OP2_LABELS)
    return quality.classify(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix.mix(read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


SQL["op3_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat(coalesce(doc_id::VARCHAR, ''), ':', md5(coalesce(text, '')))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
      FROM d GROUP BY source),
t AS (SELECT *, 2.0 * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS total,
             coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped_before,
             sum(w) OVER (ORDER BY 2.0 * source_size / w DESC, source DESC NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w_from
      FROM s),
-- in the order of cap / weight the sources before the first that stays below its cap are capped
l AS (SELECT arg_min((1.5 * total - capped_before) / w_from, cap / w) FILTER
             ((1.5 * total - capped_before) / w_from <= cap / w) AS lvl FROM t),
g AS (SELECT source, source_size, round(least(cap, coalesce(w * lvl, cap))::DOUBLE, 6) AS target FROM t, l),
b AS (SELECT *, floor(target)::BIGINT AS budget,
             CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM g),
r AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r
"""


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold("doc_id", 3) == 1
    model = langid.fit(docs.where(~held))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = jaccard.grouped(read_table(spark, sf_dir, "documents"), k=4, percent=85)
    return g.select("doc_id", "n_shingles", "component_id")


@query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold("doc_id", 7) == 2
    s = lm.score_texts(docs, ~held)
    return s.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = rules.apply_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return d.select("doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines",
                    "rules.n_repeat_words", "rules.base_failed", "rules.kept")


SQL["op9_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, text IS NOT NULL AS has FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
tri AS (SELECT r, i, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri WHERE c IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM dup) GROUP BY r),
l0 AS (SELECT r, source, has, text, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
             trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
      FROM l0 WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d WHERE has GROUP BY source),
seen AS (SELECT source, norm, count(DISTINCT text) AS n FROM l GROUP BY source, norm),
com AS (SELECT seen.source, norm FROM seen JOIN hosts ON seen.source IS NOT DISTINCT FROM hosts.source
        WHERE n >= 20 AND n > 0.05 * docs),
gone AS (SELECT l.r, sum(l.n) AS n FROM l JOIN com ON l.source IS NOT DISTINCT FROM com.source AND l.norm = com.norm GROUP BY l.r),
dl AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
m AS (SELECT d.r, doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0) AS gone
      FROM d LEFT JOIN dl ON d.r = dl.r LEFT JOIN rep ON d.r = rep.r LEFT JOIN gone ON d.r = gone.r),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - gone >= 0.3 * n_words AS kept FROM f
"""


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read_table(spark, sf_dir, "documents"))


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(read_table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(read_table(spark, sf_dir, "embeddings"))
