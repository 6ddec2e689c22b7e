import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lateline.session import LOCAL_JVM, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    yield get_session("local[*]", 8, extra=LOCAL_JVM)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    ties, and extra columns whose names the operators use themselves."""
    base = " ".join(f"word{i}" for i in range(120))
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000))
    rows = [(1, base, "en", "a"), (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "fr", None), (4, None, "en", "a"),
            (5, "", None, "b"), (6, " \n\t ", "de", "b"), (7, long, "en", "b"), (8, "123 456 !!", None, None),
            (None, "alpha beta gamma", "en", "a"), (9, None, None, None), (10, "<|endoftext|> x", "fr", "c")]
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("score", "size", "taken", "mix", "lang_pred", "rules", "secrets", "cls", "n", "comp", "key", "rank", "piece", "uid", "words"):
        df = df.withColumn(c, df.doc_id * 0 + 7)
    return df
