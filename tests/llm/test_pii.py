"""Personal data: the estimates behind the added spans, and what these add."""

import itertools
import math

import numpy as np

from cellhours.llm.pii import (
    FEATURES,
    KINDS,
    LABELERS,
    estimate_reliability,
    find_pii,
    train_classifier,
)
from tests.llm.helpers import documents


def test_reliabilities_are_recovered():
    """Votes drawn from known rates, as expected counts of every pattern."""
    share, rates = 0.35, [(0.8, 0.02), (0.9, 0.2), (0.7, 0.1), (0.6, 0.05), (0.95, 0.6)]
    patterns, truth = {}, {}
    for votes in itertools.product((0, 1), repeat=len(LABELERS)):
        true, false = share, 1 - share
        for vote, (yes, no) in zip(votes, rates, strict=True):
            true *= yes if vote else 1 - yes
            false *= no if vote else 1 - no
        bits = sum(v << i for i, v in enumerate(votes))
        patterns[bits], truth[bits] = round(1e7 * (true + false)), true / (true + false)
    got_share, got_rates, posterior = estimate_reliability(patterns, rounds=500)
    assert abs(got_share - share) < 0.01
    assert np.allclose(got_rates, rates, atol=0.01)
    assert all(abs(posterior[b] - truth[b]) < 0.05 for b in patterns)


def test_classifier_fits_the_probabilities():
    weights = [0.5, -1.0, 2.0, 0.0, 1.5, -0.5, 0.25, 1.0]
    examples = {}
    for bits in range(1 << len(FEATURES)):
        score = -1 + sum(w * (bits >> i & 1) for i, w in enumerate(weights))
        examples[bits] = (1000, 1 / (1 + math.exp(-score)))
    bias, got = train_classifier(examples, rounds=2000)
    assert abs(bias + 1) < 0.1 and np.allclose(list(got.values()), weights, atol=0.1)
    assert train_classifier({}, rounds=5)[0] == 0


def test_added_spans_of_a_planted_table(spark):
    """Written-out mail and host addresses among base ones: what the classifier adds is planted."""
    pick = np.random.default_rng(6)
    names = ["".join(pick.choice(list("bcdfgaeiou"), 6)) for _ in range(400)]
    texts, planted = [], {}
    for i in range(400):
        a, b = names[i], names[(7 * i + 3) % 400]
        filler = " ".join(pick.choice(names, 12))
        host = ".".join(map(str, pick.integers(1, 255, 4)))
        kind, added = i % 5, None
        if kind == 0:
            span = f"{a}@{b}.com"
            text = f"{filler} contact: {span} {filler}"
        elif kind == 1:
            span = added = f"{a} (at) {b} (dot) org"
            text = f"{filler} email: {span}, {filler}"
        elif kind == 2:
            span = host
            text = f"{filler} server {span} {filler}"
        elif kind == 3:
            span = added = host.replace(".", "[.]")
            text = f"{filler} host {span} {filler}"
        else:
            text = f"{filler} look (at) the {a} 1.2 and 3[.]4 or {i}-{i + 1} {filler}"
        if added:
            planted[i] = (text.index(added), text.index(added) + len(added))
        texts.append(text)
    rows = find_pii(documents(spark, texts)).select("doc_id", "pii").collect()
    extra = {(r.doc_id, x.s, x.e) for r in rows for x in r.pii if not x.base}
    want = {(i, s, e) for i, (s, e) in planted.items()}
    hits = len(extra & want)
    print("added", len(extra), "right", hits, "planted", len(want))
    assert hits >= 0.95 * len(extra) and hits >= 0.9 * len(want)
    assert {KINDS[x.k] for r in rows for x in r.pii if not x.base} <= {"email", "ip"}
