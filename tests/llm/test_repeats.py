import hashlib
import random
from collections import Counter

import pytest

from cellhours.llm.queries import op9_repeats
from cellhours.llm.repeats import WORD_GRAM, remove_repeats, repeat_extents
from tests.llm.helpers import DOCS, HAVE_TABLES, SF, collect, documents


def plain_runs(texts, length):
    """Removed runs of each text, from a table of all strings of `length` bytes."""
    seen = {}
    for data in texts:
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            seen[key] = seen.get(key, 0) + 1
    out = []
    for data in texts:
        runs, until = [], -1
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                if i <= until:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
                until = i + length
        out.append([tuple(r) for r in runs])
    return out


def check(spark, texts, length, **options):
    found = collect(remove_repeats(documents(spark, texts), length=length, **options))
    for i, (text, runs) in enumerate(
        zip(texts, plain_runs([(t or "").encode() for t in texts], length), strict=True)
    ):
        data = (text or "").encode()
        assert [(r.start, r.end) for r in found[i].removed] == runs, i
        kept = b"".join(data[a:b] for a, b in zip([0, *[e for _, e in runs]], [*[s for s, _ in runs], len(data)]))
        assert bytes(found[i].kept) == kept
        assert found[i].n_bytes == len(data)


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_a_table_of_all_strings(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    texts = [(r.text or "").encode() for r in rows]
    out = collect(op9_repeats(spark, SF))
    assert len(out) == len(rows)
    for row, data, runs in zip(rows, texts, plain_runs(texts, 400), strict=True):
        kept, at = b"", 0
        for start, end in runs:
            kept, at = kept + data[at:start], end
        kept += data[at:]
        got = out[row.doc_id]
        assert (got.n_bytes, got.n_removed, got.n_spans) == (len(data), len(data) - len(kept), len(runs))
        assert got.kept_sha256 == hashlib.sha256(kept).hexdigest()


def passages(pick, count, size):
    """Texts that share passages, overlap, repeat within themselves and copy each other."""
    def letters(n):
        return "".join(pick.choice("abcdefgh é\n") for _ in range(n))

    shared = [letters(pick.randint(60, 260)) for _ in range(6)]
    texts = []
    for _ in range(count):
        body = ""
        for _ in range(pick.randint(1, 4)):
            body += letters(pick.randint(0, size))
            part = pick.choice(shared)
            a = pick.randint(0, 60)
            body += part[a : a + pick.randint(50, 260)]
        texts.append(body)
    texts += [texts[0], texts[0][7:], texts[1] + "x" + texts[1], "ab" * 200, "a" * 300, "", None, "short"]
    return texts


@pytest.mark.parametrize(("seed", "most"), [(1, 20_000), (2, 2), (3, 1)])
def test_shared_passages(spark, seed, most):
    """`most` of 1 or 2 splits every bucket down to single strings."""
    check(spark, passages(random.Random(seed), 25, 120), 100, most=most)


def test_extents_of_nested_repeats():
    left = [b"xxab", b"yyab", b"zzzb", b""]
    right = [b"common-one", b"common-two", b"common-one", b"common"]
    back, ahead = repeat_extents(left, right, [1, 1, 1, 1], 9)
    assert list(zip(back, ahead, strict=True)) == [(2, 10), (2, 7), (1, 10), (0, 0)]


def plain_sharing(texts, words):
    """Whether a passage of `words` words of each text is in another one too."""
    grams = [
        {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        for w in (t.encode().split() for t in texts)
    ]
    held = Counter(gram for of_text in grams for gram in of_text)
    return [any(held[gram] > 1 for gram in of_text) for of_text in grams]


def test_short_passages_are_told_of_and_stay(spark):
    """51 common words of under 400 bytes: nothing is taken out, both rows say so."""
    pick = random.Random(4)

    def some(n):
        return ["".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(n)]

    passage, once = some(51), some(60)
    texts = [
        " ".join([*some(70), *passage, *some(9)]),
        " ".join(some(33)) + "\n" + "\t".join(passage),  # other white space, the same words
        " ".join([*some(30), *passage[:31], *some(30)]),  # less than a gram in common
        " ".join([*once, *once]),  # repeats itself only
        " ".join(passage[:50]),  # no passage of 51 words
        " ".join(some(200)),
        "",
        None,
        *2 * [" ".join(some(55))],
    ]
    assert len(" ".join(passage)) < 400
    found = collect(remove_repeats(documents(spark, texts), length=400, words=51))
    got = [found[i].shares_passage for i in range(len(texts))]
    assert got == plain_sharing([t or "" for t in texts], 51)
    assert got == [True, True, *6 * [False], True, True]
    assert [bool(found[i].removed) for i in (0, 1)] == [False, False]
    with pytest.raises(ValueError, match="words"):
        remove_repeats(documents(spark, texts), words=10)


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_tells_of_all_passages_of_over_50_words(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    texts = [r.text or "" for r in rows]
    out = collect(op9_repeats(spark, SF))
    assert any(plain_sharing(texts, 51))
    for row, sure, may in zip(
        rows, plain_sharing(texts, 51), plain_sharing(texts, WORD_GRAM), strict=True
    ):
        assert sure <= out[row.doc_id].shares_passage <= may


def test_odd_rows(spark):
    text = "abcdefghij" * 12
    rows = [(None, text, "x", "y", 1), (None, text, "x", "y", 1), (5, text[3:], "x", "y", 2)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("n_chars", "KEPT")
    out = remove_repeats(docs, length=64).collect()
    assert len(out) == 3 and all(bytes(r.kept) == b"" for r in out)
    assert "KEPT" not in out[0].asDict()
    assert remove_repeats(documents(spark, []), length=64).count() == 0
    with pytest.raises(ValueError, match="at least"):
        remove_repeats(docs, length=10)
