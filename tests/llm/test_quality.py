"""Quality verdicts of small groups."""

import numpy as np

from cellhours.llm.quality import quality_rules
from tests.llm.helpers import DOCS


def test_a_small_source_is_judged_by_its_own_texts(spark):
    pick = np.random.default_rng(8)
    words = ["".join(pick.choice(list("abcdefgh"), 5)) for _ in range(900)]

    def text(end, rows):
        return [" ".join(w + end(i) for i, w in enumerate(pick.choice(words, pick.integers(60, 200)))) for _ in range(rows)]

    rows = [(t, f"plain{i % 5}") for i, t in enumerate(text(lambda i: "." * (i % 12 == 0), 600))]
    rows += [(t, "code") for t in text(lambda i: "%" * (i % 3 == 0), 120)]
    rows += [(t, f"plain{i % 5}") for i, t in enumerate(text(lambda i: "%%%", 20))]
    table = [(i, t, "en", s, len(t)) for i, (t, s) in enumerate(rows)]
    kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(table, DOCS)).collect()}
    assert all(kept[i] for i in range(720))
    assert not any(kept[i] for i in range(720, 740))


def test_names_of_the_estimates_as_extra_columns(spark):
    pick = np.random.default_rng(3)
    words = ["".join(pick.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows = [(i, " ".join(pick.choice(words, 40 + i % 30)), "en", f"s{i % 2}", i) for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS)
    names = ["x0", "m0", "l00", "z0", "d2", "model", "row", "in_lang", "bin", "k", "n"]
    wide = docs.selectExpr("*", *[f"doc_id AS {n}" for n in names])
    for with_text in (True, False):
        out = quality_rules(wide, with_text=with_text).collect()
        want = {r.doc_id: (r.kept, r.distance) for r in quality_rules(docs).collect()}
        assert {r.doc_id: (r.kept, r.distance) for r in out} == want
        assert all(r[n] == r.doc_id for r in out for n in names)
