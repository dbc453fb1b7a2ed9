"""Quality, personal data, sharding, mixing, toxicity and neighbours against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellhours.llm.mixing import mix_sources, pfair_period, plan
from cellhours.llm.neighbours import nearest_neighbours
from cellhours.llm.pii import KINDS, find_pii, mask, spans_text
from cellhours.llm.quality import quality_rules
from cellhours.llm.queries import op2_pii, op8_quality, op10_neighbours
from cellhours.llm.sharding import shard_records
from cellhours.llm.toxicity import fit_toxicity, score_toxicity
from tests.llm.helpers import DOCS, HAVE_TABLES, SF, collect, documents

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(x - 9 * (x > 9) for x in twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


@needs_tables
def test_personal_data_of_the_table(spark):
    out = collect(op2_pii(spark, SF))
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = plain_spans(row.text or "")
        got = out[row.doc_id]
        assert got.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in KINDS] == [sum(w[1] == i for w in want) for i in range(4)]
        assert set(joined(want).split(",")) <= set(got.spans.split(","))


def test_personal_data_in_odd_texts(spark):
    pick = np.random.default_rng(3)
    texts = ["".join(pick.choice(list("a1.@-_+ (9%\x01\x02é🙂"), 60)) for _ in range(150)]
    texts += [
        None, "", "x@y_z@mail.example.com, a@b@c.de", "4111 1111 1111 1111 4111-1111-1111-1111",
        "+1 (743) 555-3824", "1.2.3.4.5.6.7.8", "007.0.0.1 256.1.1.1", "1 " * 20_000,
        "joe (at) mail (dot) org", "a." * 9000 + "@b.cc", "9" * 30_000, "1.1.1.1 " * 700,
    ]
    rows = find_pii(documents(spark, texts)).select(
        "doc_id", "text", "pii", spans_text(F.filter("pii", lambda x: x["base"])).alias("s"),
        mask(F.col("text"), F.col("pii")).alias("masked"),
    )
    for row in rows.collect():
        assert row.s == joined(plain_spans(row.text or "")), row.text[:80]
        if row.text and all(x.base for x in row.pii) and len({x.k for x in row.pii}) == 1:
            want, at = "", 0
            for x in row.pii:
                want, at = want + row.text[at : x.s] + f"[{KINDS[x.k].upper()}]", x.e
            assert row.masked == want + row.text[at:]
    assert find_pii(documents(spark, [])).count() == 0


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    marked = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked)


@needs_tables
def test_quality_counts_of_the_table(spark):
    out = collect(op8_quality(spark, SF))
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        got, want = out[row.doc_id], plain_counts(row.text or "")
        assert tuple(got)[1:6] == want
        assert got.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (got.base_failed and got.kept)


def test_quality_rejects_outliers_and_keeps_the_rest(spark):
    pick = np.random.default_rng(5)
    words = ["".join(pick.choice(list("abcdefgh"), 5)) for _ in range(900)]
    good = [" ".join(pick.choice(words, pick.integers(60, 200))) + "." for _ in range(300)]
    bad = [" ".join(w + "%%%" for w in pick.choice(words, 90)) for _ in range(20)]
    out = quality_rules(documents(spark, [*good, *bad, None, "", "few words", "a b " * 9000]))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 324))
    clash = documents(spark, good[:3]).withColumnRenamed("n_chars", "KEPT")
    assert quality_rules(clash).count() == 3 and quality_rules(documents(spark, [])).count() == 0


def test_shards(spark):
    texts = [f"text {i}" for i in range(600)] + [None, ""]
    docs = documents(spark, texts)
    docs = docs.unionAll(spark.createDataFrame([(None, "x", "e", "s", 1)] * 2, DOCS))
    rows = shard_records(docs, weights=[1.0, 1.0, 2.0]).collect()
    slots = {}
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        assert r.grown_shard in {r.shard, 3}
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 250 < len(slots[2]) < 350 and sum(r.grown_shard == 3 for r in rows) < 180
    assert shard_records(documents(spark, [])).count() == 0


def test_pfair_lag_stays_below_one_block(spark):
    share = {"a": 7, "b": 5, "c": 3, "d": 1}
    slots = pfair_period(share)
    for t in range(1, 17):
        for s, q in share.items():
            assert abs(sum(x < t for x in slots[s]) - q * t / 16) < 1
    phases = plan({"a": 30, "b": 4, "c": 9}, {"a": 1.0, "b": 1.0, "c": 2.0}, 64)
    assert sum(p.length for p in phases) == 43
    docs = documents(spark, [f"t{i}" for i in range(500)])
    rows = mix_sources(docs, {"src0": 3.0, "src1": 1.0}, block_rows=4, period=64).collect()
    assert sorted(r.doc_id for r in rows) == list(range(500))
    assert len({r.position for r in rows}) == 500
    assert {r.mix_source for r in rows} == {"src0", "src1", None}
    assert mix_sources(documents(spark, [])).count() == 0


def test_toxicity_finds_held_out_texts(spark):
    pick = np.random.default_rng(9)
    words = ["".join(pick.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    texts = [" ".join(pick.choice(words, 60)) for _ in range(400)]
    toxic = [int(i % 4 == 0) for i in range(400)]
    texts = [t + " you vile scoundrel" * y for t, y in zip(texts, toxic, strict=True)] + [None, ""]
    labels = spark.createDataFrame(
        [(i, y) for i, y in enumerate(toxic) if i % 3], "doc_id bigint, toxic int"
    )
    docs = documents(spark, texts).withColumnRenamed("n_chars", "Score")
    out = collect(score_toxicity(docs, fit_toxicity(docs, labels)))
    held = [(out[i].score, toxic[i]) for i in range(0, 400, 3)]
    assert all((s >= 0.7) == bool(y) for s, y in held)
    assert 0 <= out[400].score < 0.7 and out[400].score == out[401].score
    flat = score_toxicity(docs, fit_toxicity(docs, labels.limit(0))).collect()
    assert {r.score for r in flat} == {0.0}


@needs_tables
def test_neighbours_reach_the_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in op10_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = x @ x[q]
        score[q] = -2
        best = ids[np.argsort(-score)[:5]]
        hits += sum(b in got[ids[q]] for b in best)
        total += 5
    assert hits >= 0.9 * total


def test_neighbours_of_parallel_vectors_and_small_partitions(spark):
    rows = [(0, [1.0, 1.0])] + [(i, [float(i), float(i)]) for i in range(30, 0, -1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = nearest_neighbours(table, every=50, k=5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(i, 1.0) for i in range(1, 6)]
    # A small group far from all others: its partition has fewer than k candidates.
    pick = np.random.default_rng(2)
    rows = [(i + 1, (pick.normal(size=8) * 0.1 + np.eye(8)[0]).tolist()) for i in range(400)]
    rows += [(0, (-np.eye(8)[0]).tolist()), (1000, (-np.eye(8)[0] + 0.1 * np.eye(8)[1]).tolist())]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = nearest_neighbours(table, every=1000, k=5, partitions=32).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == [(q, n) for q in (0, 1000) for n in range(1, 6)]
    assert {r.vec_id for r in got if r["rank"] == 1} == {0, 1000}


def test_neighbours_over_several_levels(spark):
    """Partitions cut again by routers of their own: recall, and questions that find too few."""
    pick = np.random.default_rng(8)
    centres = pick.normal(size=(40, 16))
    x = centres[pick.integers(0, 40, 3000)] + 0.3 * pick.normal(size=(3000, 16))
    x = np.concatenate([x, -20 * np.ones((1, 16)), -20 * np.ones((1, 16)) + np.eye(16)[:1]])
    ids = np.arange(1, 3003)
    ids[-2] = 50_000
    table = spark.createDataFrame(
        [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>"
    )
    got = {}
    for r in nearest_neighbours(table, every=50, k=5, partitions=4, most_rows=60).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = units @ units[q]
        cosine[q] = -2
        assert sorted(got[ids[q]]) == [1, 2, 3, 4, 5]
        best = set(ids[np.argsort(-cosine)[:5]].tolist())
        hits, total = hits + len(best & set(got[ids[q]].values())), total + 5
    assert len(got) == 61 and hits >= 0.9 * total
    assert got[50_000][1] == 3002


def test_neighbours_take_wide_rows_and_clashing_names(spark):
    pick = np.random.default_rng(4)
    rows = [(i, pick.normal(size=3000).tolist(), i, 0.5, i) for i in range(60)]
    columns = "vec_id bigint, embedding array<double>, point bigint, score double, part int"
    got = nearest_neighbours(spark.createDataFrame(rows, columns), every=50, k=5).collect()
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in (0, 50):
        cosine = x @ x[q]
        cosine[q] = -2
        best = [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        assert best == np.argsort(-cosine)[:5].tolist()


def test_neighbours_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (None, [1.0, 1.0]),
        (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [0.5, 0.5]), (7, [1.0, 0.0, 3.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    out = nearest_neighbours(table, every=50, k=5).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in out] == [(0, 1, 1), (0, 2, 6)]
    assert nearest_neighbours(table.limit(0)).count() == 0
