import math

import pytest

from cellhours.llm.queries import op1_token_counts
from cellhours.llm.tokens import MARK, PieceTrie, token_counts, unigram_scores
from tests.llm.helpers import DOCS, HAVE_TABLES, SF, collect, documents

FILE = "piece_bpe_32k.model"


def plain_count(word, scores, byte_score):
    """Viterbi segmentation of one pre-token by itself."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = word[start:end]
            if piece in scores:
                score = best[start][0] + scores[piece]
                if score > best[end][0]:
                    best[end] = (score, best[start][1] + 1)
        if word[end - 1] not in scores:
            n = len(word[end - 1].encode())
            raw = best[end - 1][0] + n * byte_score
            if raw > best[end][0]:
                best[end] = (raw, best[end - 1][1] + n)
    return best[-1][1]


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_viterbi_word_by_word(spark):
    scores, _ = unigram_scores(FILE)
    low = min(scores.values()) - 1
    known = {}
    out = collect(op1_token_counts(spark, SF))
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(out) == len(rows)
    for row in rows:
        words = [MARK + w for w in (row.text or "").split()]
        for w in words:
            if w not in known:
                known[w] = plain_count(w, scores, low)
        assert out[row.doc_id].n_pretokens == len(words)
        assert out[row.doc_id].n_tokens == sum(known[w] for w in words)


def test_prefixes_are_shared():
    trie = PieceTrie({"a": -1.0, "ab": -1.5, "b": -1.0, "c": -1.0}, 2)
    assert trie.insert("abc") == 2
    nodes = len(trie.best)
    assert trie.insert("aba") == 2 and len(trie.best) == nodes + 1
    assert trie.insert("é") == 2  # two bytes


def test_odd_rows(spark):
    rows = [
        (None, None, "x", "y", 1), (1, "", "x", "y", 1), (2, " \n ", "x", "y", 1),
        (3, "x" * 20_000, "x", "y", 1), (4, "日本 🙂 word", "x", "y", 1), (4, "日本 🙂 word", "x", "y", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "N_Tokens")
    out = token_counts(docs).collect()
    assert [c for c in out[0].asDict()] == ["doc_id", "source", "n_chars", "n_pretokens", "n_tokens"]
    counts = sorted((r.doc_id or 0, r.n_pretokens) for r in out)
    assert counts == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 3), (4, 3)]
    small = token_counts(docs, max_nodes=3).collect()  # a new trie for almost every word
    assert sorted(r.n_tokens for r in small) == sorted(r.n_tokens for r in out)
    assert token_counts(documents(spark, [])).count() == 0
