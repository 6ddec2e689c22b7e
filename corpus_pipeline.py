"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.llm import jaccard, langid, mix, packing, secrets
from lateline.llm.common import Stage, read_table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: no letter, or no language
    that is likelier than all others together.  Learned from the labelled
    documents of the stage's own input."""
    model = langid.fit(docs)
    found = langid.identify(docs, model, pred="__pred", score="__score")
    return found.where(~langid.rejected(F.col("__pred"), F.col("__score"))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return jaccard.keep_first(docs, k=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret that the scan finds is replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, left out or, at a source's cut, shortened."""
    return mix.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Language scores, tokens and the packing are not expressible in SQL; the
#: stages are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, docs = Stage(spark), read_table(spark, sf_dir, "documents")
    for i, (name, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage.save(docs, name)
    return docs
