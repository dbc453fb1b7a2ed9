import hashlib
import random
from collections import Counter
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cellhours.llm.alignment import (
    EMPTY,
    align_tokenizers,
    compose,
    cut_fragment,
    cut_text,
    tokenizer_pair,
)
from cellhours.llm.queries import op11_alignment
from tests.llm.helpers import DOCS, HAVE_TABLES, SF, collect, documents

FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def byte_table():
    """Bytes of the visible characters that a byte-level vocabulary writes its tokens in."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Plain:
    """Token by token, with the vocabularies' own files."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path(FILES[1]))
        self.back = byte_table()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False)
        first = [
            (i, bytes(self.back[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)
        ]
        second = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            raw = piece.replace("▁", " ").encode()
            second.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else raw))
        whole = (" " + text).encode()
        if not text or any(b"".join(t for _, t in x) != whole for x in (first, second)):
            return [], []
        return first, second

    def groups(self, text):
        first, second = self.tokens(text)
        ends = []
        for side in (first, second):
            at, found = 0, set()
            for _, raw in side:
                at += len(raw)
                found.add(at)
            ends.append(found)
        common = sorted(ends[0] & ends[1])
        out = []
        for low, high in pairwise([0, *common]):
            group = []
            for side in (first, second):
                at, ids = 0, []
                for i, raw in side:
                    at += len(raw)
                    if low < at <= high:
                        ids.append(i)
                group.append(ids)
            out.append(group)
        return out


def plain_rows(texts):
    plain = Plain()
    grouped = [plain.groups(t or "") for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in grouped]
    held = Counter(pair for one in links for pair in one)
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for g, one in zip(grouped, links, strict=True):
        written = ";".join("|".join(",".join(map(str, ids)) for ids in x) for x in g)
        out.append(
            (
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                sum(one.values()),
                sum(n for p, n in one.items() if held[p] == top[p[0]]),
                sum(n * held[p] for p, n in one.items()),
                hashlib.sha256(written.encode()).hexdigest() if g else "",
            )
        )
    return out


def values(row):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return tuple(row[n] for n in names)


ODD = [
    None, "", " ", "\n", "x", "a  b\n\n c   ", "tail space ", "line\r\nend\t\ttabs \t x",
    "a ▁ mark", "▁", "<|endoftext|> <s></s><unk> <0x0A>", "é é ½ ﬁ 　x\xa0y",
    "日本語のテキスト 🙂👍🏽", "\x00\x01 \x1c \x85 z", "naïve façade—“quotes”", "word " * 300,
    "a" * 900, "ab" * 700 + " " * 500 + "c", "1234567890 " * 80, "same text", "same text",
]


@pytest.mark.parametrize("size", [5, 60, 16_384])
def test_odd_texts_equal_the_plain_alignment(spark, size):
    out = collect(align_tokenizers(documents(spark, ODD), piece_chars=size))
    for i, want in enumerate(plain_rows(ODD)):
        assert values(out[i]) == want, (size, ODD[i])


@pytest.mark.skipif(not HAVE_TABLES, reason="no generated tables here")
def test_query_equals_the_plain_alignment(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    out = collect(op11_alignment(spark, SF))
    assert len(out) == len(rows)
    for row, want in zip(rows, plain_rows([r.text for r in rows]), strict=True):
        assert values(out[row.doc_id]) == want


def test_fragments_are_a_monoid():
    two = tokenizer_pair(*FILES)
    pick = random.Random(4)
    text = "Öffnung naïveté 12345 unbelievably long-windedness\n\nquick 🙂 fox  " * 6
    (a, b), = two.ids([text], [True])
    a, b = np.array(a), np.array(b)
    ends_a, ends_b = np.cumsum(two.len_a[a]), np.cumsum(two.len_b[b])
    size = int(ends_a[-1])

    def cut(low, high):
        in_a, in_b = ((e > low) & (e <= high) for e in (ends_a, ends_b))
        return cut_fragment(two, a[in_a], b[in_b], ends_a[in_a], ends_b[in_b])

    def closed(groups, low, found, high):
        return [*low, *([found] if found else []), *high] if groups else []

    def written(group):
        return "|".join(",".join(map(str, ids)) for ids in group)

    def fold(parts):
        """Compose in a random order; the closed groups stay in the order of the text."""
        parts = [(f, g.text[0].split(";")[:-1]) for f, g in parts]
        while len(parts) > 1:
            i = pick.randrange(len(parts) - 1)
            (left, before), (right, after) = parts[i], parts[i + 1]
            whole, group = compose(left, right)
            parts[i : i + 2] = [(whole, [*before, *([written(group)] if group else []), *after])]
        fragment, groups = parts[0]
        assert fragment.ends and fragment.suffix == ((), ())
        return [written(fragment.prefix), *groups]

    want = [written(g) for g in Plain().groups(text)]
    for step in (1, 2, 3, 7, 40, 1000):
        edges = [0, *range(step, size, step), size]
        assert fold([cut(low, high) for low, high in pairwise(edges)]) == want
    some, _ = cut(5, 30)
    assert compose(EMPTY, some) == (some, None) and compose(some, EMPTY)[0] == some


def test_cut_places_change_no_token():
    two = tokenizer_pair(*FILES)
    pick = random.Random(8)
    letters = "ab é🙂.,'1\n \t\r  s　\x1c"
    for _ in range(300):
        text = "".join(pick.choice(letters) for _ in range(80))
        pieces = cut_text(text, 4)
        assert "".join(pieces) == text
        found = two.ids(pieces, [i == 0 for i in range(len(pieces))])
        (whole,) = two.ids([text], [True])
        assert all(found)
        for side in (0, 1):
            assert sum((list(f[side]) for f in found), []) == list(whole[side])


def test_repeated_rows_and_clashing_names(spark):
    rows = [(None, "one two", "en", "a", 5)] * 2 + [(1, "one two", "en", None, 5)] * 2
    rows += [(2, "three " * 40, None, "b", 9)] * 2
    docs = spark.createDataFrame(rows, DOCS).withColumnsRenamed(
        {"n_chars": "N_Best", "source": "_0", "lang": "code"}
    )
    out = align_tokenizers(docs, piece_chars=30).collect()
    assert len(out) == 6
    assert sorted(out[0].asDict()) == sorted(
        ["doc_id", "code", "_0", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    )
    want = plain_rows([r[1] for r in rows])
    assert sorted(values(r) for r in out) == sorted(want)
    assert align_tokenizers(documents(spark, [])).count() == 0
    assert values(collect(align_tokenizers(documents(spark, [None])))[0]) == (0,) * 6 + ("",)
