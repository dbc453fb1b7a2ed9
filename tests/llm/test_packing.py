import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellhours.llm.packing import WordEncoder, best_fit_decreasing, pack_documents
from cellhours.llm.queries import op6_packing
from tests.llm.helpers import DOCS, HAVE_TABLES, SF, documents

FILE = "word_bpe_49k.json"


def check(rows, ids, window):
    """Every id in exactly one piece, sequences gapless and within the window."""
    parts, sequences = {}, {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert parts.keys() == ids.keys()
    for key, found in parts.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[key])
            piece = np.asarray(ids[key][at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece)
            at += r.length
        assert at == len(ids[key])
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return len(sequences)


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_round_trip(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(FILE))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = {
        d.doc_id: [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1] for d in docs
    }
    used = check(op6_packing(spark, SF).collect(), ids, 2048)
    least = -(-sum(map(len, ids.values())) // 2048)
    assert used <= least * 1.02 + 1


def test_word_cache_equals_the_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(FILE))
    pick, encoder = random.Random(4), WordEncoder(FILE)
    letters = "aB1é'.,!?-_ \n\t\r\x0b\x0c\x85\xa0 　ΣςİßʼÅ̊🙂#%<|endoftext|>"
    for _ in range(400):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 60)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want, repr(text)
    for text in ("a<|EndOfText|> B", "a <|endoftext|> B.", "É, ÿŸ. ªµß. <|startoftext|", "İ, ΟΣ. A."):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want, repr(text)


def test_best_fit_picks_the_tightest_window():
    place, offset = best_fit_decreasing(np.array([6, 5, 4, 3, 2, 10, 10]), 10)
    assert place.tolist() == [2, 3, 2, 3, 3, 0, 1]
    assert offset.tolist() == [0, 0, 6, 5, 8, 0, 0]
    pick = np.random.default_rng(0)
    sizes = pick.integers(1, 200, 500)
    place, _ = best_fit_decreasing(sizes, 256)
    assert np.bincount(place, weights=sizes).max() <= 256
    windows: list[int] = []
    for n in sorted(sizes.tolist(), reverse=True):  # the same by trying all windows
        fits = [w for w in windows if w >= n]
        if fits:
            windows.remove(min(fits))
        windows.append((min(fits) if fits else 256) - n)
    assert len(windows) == place.max() + 1


def test_odd_rows(spark):
    rows = [
        (None, None, "x", "y", 1), (1, "", "x", "y", 1), (1, "", "x", "y", 1),
        (2, "many words " * 500, "x", "y", 1), (3, "w" * 5000, "x", "y", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "offset")
    out = pack_documents(docs, window=64, with_ids=True).collect()
    assert sum(r.doc_id is None for r in out) == 1
    assert [r.length for r in out if r.doc_id == 1] == [1, 1]
    assert all(len(r.ids) == 4 * r.length for r in out)
    pieces = sorted((r.start, r.length) for r in out if r.doc_id == 2)
    assert [p[1] for p in pieces[:-1]] == [64] * (len(pieces) - 1)
    assert pack_documents(documents(spark, [])).count() == 0
