"""Small tables for the corpus operators."""

from __future__ import annotations

from pathlib import Path

SF = "/root/testdata/sf0.001"
HAVE_TABLES = Path(SF).exists()
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first_id=0):
    """Rows of the documents table from a list of texts."""
    rows = [
        (first_id + i, t, "en", f"src{i % 3}", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def collect(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
