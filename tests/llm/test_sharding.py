"""Sharding: the query against draws made one by one."""

import math
import zlib

import pytest
import xxhash

from cellhours.llm.queries import op3_sharding
from cellhours.llm.sharding import shard_records
from tests.llm.helpers import HAVE_TABLES, SF, collect, documents


def drawn(key, shards):
    """The shard of a key by rendezvous hashing with equal weights."""
    seed = xxhash.xxh64_intdigest(key.encode(), seed=42)
    draws = []
    for shard in range(shards):
        bits = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), seed=seed) >> 11
        draws.append((-math.log((bits + 0.5) / 2**53), shard))
    return min(draws)[1]


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_own_draws(spark):
    out, slots = collect(op3_sharding(spark, SF)), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        data, r = (d.text or "").encode(), out[d.doc_id]
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.shard == drawn(str(d.doc_id), 24) and r.grown_shard == drawn(str(d.doc_id), 25)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_long_texts_clashing_names_and_repeated_rows(spark):
    texts = ["long " * 200_000, "é🙂" * 50_000, "", None, "again"]
    docs = documents(spark, texts).withColumnRenamed("n_chars", "Slot").withColumnRenamed("lang", "_spread")
    rows = shard_records(docs.unionAll(docs)).collect()
    assert len(rows) == 10
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 8
        assert r.shard == drawn(str(r.doc_id), 24)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
