import random

import numpy as np
import pytest
import xxhash

from cellhours.llm.common import connected_components
from cellhours.llm.queries import op5_simhash
from cellhours.llm.simhash import (
    block_forest,
    fingerprint,
    link_fingerprints,
    simhash_components,
    variants,
)
from tests.llm.helpers import DOCS, HAVE_TABLES, SF, collect, documents


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks, distance):
    """Smallest index reachable, by comparing all pairs."""
    values = np.array(marks, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    label = np.arange(len(marks))
    while True:
        low = np.where(near, label[None, :], len(marks)).min(axis=1)
        if (low == label).all():
            return label
        label = low


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    marks = [plain_fingerprint(r.text) for r in rows]
    label = plain_components(marks, 4)
    out = collect(op5_simhash(spark, SF))
    assert len(out) == len(rows)
    for i, row in enumerate(rows):
        assert out[row.doc_id].fingerprint == f"{marks[i]:016x}"
        assert out[row.doc_id].component_id == rows[label[i]].doc_id


@pytest.mark.parametrize("distance", [1, 3, 4, 6])
def test_links_of_dense_and_sparse_groups(spark, distance):
    pick = random.Random(distance)
    marks = {pick.getrandbits(64) for _ in range(60)}
    for _ in range(4):  # groups of near copies, chains between them
        centre = pick.getrandbits(64)
        for _ in range(80):
            value = centre
            for bit in pick.sample(range(64), pick.randint(1, 6)):
                value ^= 1 << bit
            marks.add(value)
    marks = sorted(marks)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    found = link_fingerprints(spark.createDataFrame([(m,) for m in signed], "fp bigint"), distance)
    root = {r.node: r.root for r in found.collect()}
    label = plain_components(marks, distance)
    groups = {}
    for i, m in enumerate(signed):
        groups.setdefault(root.get(m, m), set()).add(label[i])
    assert len(groups) == len(set(label))
    assert all(len(g) == 1 for g in groups.values())


def loose_group(pick, size, low=3, high=4):
    """Distinct values a few bits off one centre, most of them too far from each other."""
    centre, out = pick.getrandbits(64), set()
    while len(out) < size:
        value = centre
        for bit in pick.sample(range(64), pick.randint(low, high)):
            value ^= 1 << bit
        out.add(value)
    return sorted(out)


def check_components(found, marks, distance):
    root = {r.node: r.root for r in found.collect()}
    label = plain_components(marks, distance)
    groups = {}
    for i, m in enumerate(marks):
        value = m - (1 << 64) if m >> 63 else m
        groups.setdefault(root.get(value, value), set()).add(label[i])
    assert len(groups) == len(set(label))
    assert all(len(g) == 1 for g in groups.values())


@pytest.mark.parametrize("most_outer", [0, 32_768])
def test_links_of_a_loose_group(spark, most_outer):
    pick = random.Random(most_outer)
    marks = sorted({*loose_group(pick, 700), *loose_group(pick, 200, 5, 6)})
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    found = link_fingerprints(spark.createDataFrame(signed, "fp bigint"), 4, most_outer)
    check_components(found, marks, 4)


def test_links_kept_of_a_bucket_do_not_grow_with_its_pairs():
    pick = random.Random(6)
    for size in (500, 1000, 2000):
        marks = np.array(loose_group(pick, size), np.uint64).view(np.int64)
        comp = np.arange(size)
        links = block_forest(marks, comp, np.full(size, -1), 4)
        label = plain_components(marks.view(np.uint64), 4)
        assert len(links) == size - len(set(label.tolist()))


def test_variants_share_a_key_within_the_distance():
    rules = variants(4)
    assert len(rules) == 64
    pick = random.Random(1)
    for _ in range(300):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), 4):
            b ^= 1 << bit
        assert any((a ^ b) & mask == 0 for _, mask, _ in rules)


def test_odd_rows(spark):
    text = "one two three four five six"
    rows = [
        (1, text, "en", "a", 5),
        (2, None, "en", "a", 5),
        (3, "", None, None, None),
        (4, " \n\t ", "en", "a", 5),
        (None, text.upper(), "en", "a", 5),
        (1, text, "en", "a", 5),
        (7, "two words", "en", "a", 5),
        (9, "word " * 50_000, "en", "a", 5),
        (None, "nothing like the others at all", "en", "a", 5),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("n_chars", "Fingerprint")
    out = simhash_components(docs).collect()
    assert len(out) == len(rows)
    assert out[0].asDict().keys() == {"doc_id", "lang", "source", "fingerprint", "component_id"}
    assert sorted(r.component_id for r in out if r.fingerprint == "0" * 16) == [2, 2, 2]
    same = [r for r in out if r.fingerprint == f"{plain_fingerprint(text):016x}"]
    assert [r.component_id for r in same] == [1, 1, 1]
    assert sum(r.component_id is None for r in out) == 1
    assert simhash_components(documents(spark, [])).count() == 0


def test_upper_case_beyond_ascii_stays():
    assert fingerprint("É a".encode(), 4) != fingerprint("é a".encode(), 4)
    assert fingerprint(b"A B", 4) == fingerprint(b"a\x0bb", 4)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (700, 600), (600, 800)]
    out = connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), "test").collect()
    root = {r.node: r.root for r in out}
    assert {root[i] for i in range(1, 201)} == {0}
    assert root[700] == root[800] == 600 and 500 not in root
