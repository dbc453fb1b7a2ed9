"""The corpus pipeline on small tables with repeated and NULL ids."""

import random
from collections import Counter

import corpus_pipeline
from cellhours.llm.queries import op8_quality
from corpus_pipeline import STAGES, drop_near_copies, pack_windows
from cellhours.llm.simhash import fingerprint
from tests.llm.helpers import DOCS, documents


def prose(seed, words=300):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices("abcdefgh", k=5)) for _ in range(words))


def near(text, way):
    """A text within four bits of `text`, another one for each `way`."""
    mark = fingerprint(text.encode(), 4)
    found = (f"{text} tail{i}" for i in range(1000))
    close = (t for t in found if (fingerprint(t.encode(), 4) ^ mark).bit_count() <= 2)
    return [next(close) for _ in range(way + 1)][way]


def copies_left(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    kept = drop_near_copies(spark, docs, "").collect()
    return sorted(((r.doc_id, r.text) for r in kept), key=str)


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = map(prose, range(4))
    # Unrelated texts with one id: each names its component.
    assert copies_left(spark, [(1, a), (1, b), (2, near(a, 0))]) == sorted([(1, a), (1, b)], key=str)
    # A near copy whose id is that of another text's representative.
    assert copies_left(spark, [(3, a), (5, near(a, 0)), (5, b)]) == [(3, a), (5, b)]
    # Components without any id beside copies of a document that has one.
    rows = [(7, a), (None, a), (None, near(a, 0)), (None, c), (None, near(c, 0)), (None, near(c, 1)), (None, d)]
    left = copies_left(spark, rows)
    assert (7, a) in left and (None, d) in left and len(left) == 3
    assert sum(t in {c, near(c, 0), near(c, 1)} for _, t in left) == 1
    # Rows that repeat with their id.
    assert copies_left(spark, [(1, a), (1, a), (1, a), (None, b), (None, b)]) == sorted([(1, a), (None, b)], key=str)


def test_all_stages_on_a_small_table(spark, tmp_path):
    """Each stage against what a plain reading of it gives, and the run against its stages."""
    texts = [prose(i, 120 + i) for i in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [
        (50, texts[0], "en", "s1", 1), (None, texts[1], None, None, None), (None, texts[1], None, None, 2),
        (51, "too short", "en", "s1", 9), (52, None, "en", "s1", 0), (53, prose(99) + " call +1 (743) 555-3824 ok", "en", "s2", 3),
        (54, prose(98), "en", "s2", 3), (54, prose(98), "en", "s2", 3),
    ]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(STAGES)
    good = stages["quality_rules"](spark, docs, "").collect()
    verdict = Counter((r.doc_id, r.kept) for r in op8_quality(spark, str(tmp_path)).collect())
    assert Counter(r.doc_id for r in good) == Counter({i: n for (i, k), n in verdict.items() if k})
    assert not {51, 52} & {r.doc_id for r in good} and {0, 53, 54} <= {r.doc_id for r in good}
    one = stages["simhash_near_dedup"](spark, spark.createDataFrame(good, DOCS), "").collect()
    assert len(one) == len({fingerprint(r.text.encode(), 4) for r in good})
    masked = stages["pii"](spark, spark.createDataFrame(one, DOCS), "").collect()
    assert sum("[PHONE]" in r.text and "555" not in r.text for r in masked) == 1
    mixed = stages["mixing"](spark, spark.createDataFrame(masked, DOCS), "")
    assert mixed.columns == docs.columns and Counter(mixed.collect()) == Counter(masked)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed) == Counter(r.doc_id for r in masked)
    used = Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048
    empty = documents(spark, [])
    for _, stage in STAGES:
        assert stage(spark, empty, "").count() == 0


def test_sequences_follow_the_schedule(spark, tmp_path):
    """Packed in stretches along the mixing: every stretch has the sources at their shares."""
    rows = [(i, f"text {i} " + "word " * (i % 50), "en", "big" if i % 10 else "small", 1) for i in range(1500)]
    docs = spark.createDataFrame(rows, DOCS)
    path = str(tmp_path / "mixed")
    corpus_pipeline.mix_to_weights(spark, docs, "").write.parquet(path)
    stored = spark.read.parquet(path).selectExpr("*", "_metadata.file_name AS f", "_metadata.row_index AS r")
    from cellhours.llm.packing import pack_documents

    order = {r.doc_id: n for n, r in enumerate(stored.orderBy("f", "r").collect())}
    out = pack_documents(stored, order=["f", "r"], stretch_pieces=100).collect()
    blocks = {}
    for r in out:
        blocks.setdefault(r.sequence_id >> 32, []).append(order[r.doc_id])
    assert len(blocks) == 15
    spans = [(min(b), max(b)) for _, b in sorted(blocks.items())]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    # 1350 and 150 rows weigh as their roots, 3 to 1, until the small source is used up.
    early = [r for r in out if order[r.doc_id] < 400]
    share = sum(r.doc_id % 10 == 0 for r in early) / len(early)
    assert abs(share - 0.25) < 0.08
    assert {r.doc_id for r in pack_windows(spark, docs, "").collect()} == set(range(1500))
