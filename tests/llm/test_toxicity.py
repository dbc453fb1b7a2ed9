"""Toxicity: the query on the tables, and that held-out labels have no part in it."""

import zlib

import pytest
from pyspark.sql import functions as F

from cellhours.llm.queries import op4_toxicity
from tests.llm.helpers import HAVE_TABLES, collect

SF = "/root/testdata/sf0.01"  # the smaller tables hold too few toxic documents to learn from


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_scores_held_out_documents_without_their_labels(spark, tmp_path):
    out = collect(op4_toxicity(spark, SF))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(out) == docs.count()
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(out[i].score, y) for i, y in truth.items() if i in out and out[i].held_out and y is not None]
    high, low = [s for s, y in held if y], [s for s, y in held if not y]
    wins = sum((h > x) + 0.5 * (h == x) for h in high for x in low)
    assert high and wins >= 0.95 * len(high) * len(low)

    # Other labels for the held-out third, repeated rows and odd texts: the old rows score as before.
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    flipped = F.when(fold == 1, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    kind = labels.schema["toxic"].dataType
    labels.withColumn("toxic", flipped.cast(kind)).write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    again = collect(op4_toxicity(spark, str(tmp_path)))
    assert {i: r.score for i, r in again.items()} == {i: r.score for i, r in out.items()}
