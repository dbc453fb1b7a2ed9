"""Aligning the tokens of two tokenizers: groups between common ends, composed as fragments."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from cellhours.sources.scratch import materialise

FAN_IN = 16  # neighbouring fragments that one step of the tree composes
BLOCK_PAIRS = 1_500_000  # id pairs of the documents that share a dictionary
CUT = re.compile(r"(?<=\S)[ \n](?=.)", re.DOTALL)

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
NEW = (*COUNTS, "n_best", "count_sum", "groups_sha256")


class TokenizerPair:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, file_a: str, file_b: str) -> None:
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        # The rank file holds the vocabulary of the JSON file of the same name and gives the same
        # ids several times faster; it knows no special tokens, so their strings are plain text.
        ranks_file = public_tokenizers.path(file_a.removesuffix(".json") + ".tiktoken")
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.first = tiktoken.Encoding(
            file_a, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.second = SentencePieceProcessor(model_file=public_tokenizers.path(file_b))
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.len_a = np.array([len(t) for t in self.bytes_a])
        self.len_b = np.array([len(t) for t in self.bytes_b])
        self.size_b = len(self.bytes_b)
        # No piece holds a word mark behind another character, or a line end: then no merge goes
        # over a space or line end that follows a character, and a text may be cut before it.
        self.divisible = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.mark = self.second.piece_to_id("▁")
        ids_a, ids_b = range(len(self.bytes_a)), range(self.size_b)
        self.written = [
            *(f"{i}," for i in ids_a),
            *(f"{i}|" for i in ids_a),
            *(f"{i}," for i in ids_b),
            *(f"{i};" for i in ids_b),
        ]

    def ids(self, parts: list[str], openings: list[bool]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of each part by both, or None where their bytes are not those of the part.

        An opening part is the begin of a text and gets a space in front; any other begins with
        the space or line end before which it was cut.
        """
        bare = [p if o or p[0] != " " else p[1:] for p, o in zip(parts, openings, strict=True)]
        out: list[tuple[list[int], list[int]] | None] = []
        for part, opening, b in zip(
            parts, openings, self.second.encode(bare, num_threads=1), strict=True
        ):
            whole = " " + part if opening else part
            if not opening and part[0] != " " and b[:1] == [self.mark]:
                b = b[1:]  # the mark that the tokenizer adds belongs to no byte of this part
            a = self.first.encode_ordinary(whole)
            raw = whole.encode()
            same = (
                b"".join(map(self.bytes_a.__getitem__, a)) == raw
                and b"".join(map(self.bytes_b.__getitem__, b)) == raw
            )
            out.append((a, b) if same else None)
        return out


@cache
def tokenizer_pair(file_a: str, file_b: str) -> TokenizerPair:
    return TokenizerPair(file_a, file_b)


@dataclass(frozen=True)
class Groups:
    """Closed groups of several units (documents or fragments) in a row.

    `text` is the written form of each unit's groups, each with a closing semicolon; `pairs` and
    `times` are its linked id pairs, each once with the number of its links.
    """

    counts: np.ndarray  # unit x (tokens of a, tokens of b, groups, links)
    text: list[str]
    pairs: list[np.ndarray]
    times: list[np.ndarray]


def close_groups(
    two: TokenizerPair, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray,
    unit_ends: np.ndarray,
) -> Groups:
    """Cut two token streams over the same bytes at their common ends.

    `unit_ends` are the ends of the units in the streams; each is a common end, or repeats the one
    before it if the unit is empty.
    """
    units = len(unit_ends)
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    n_a, n_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    unit_of = np.searchsorted(unit_ends, common)  # of several equal ends the first is not empty
    edges = np.concatenate(([0], np.searchsorted(common, unit_ends, side="right")))

    def per_unit(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[edges[1:]] - sums[edges[:-1]]

    counts = np.stack(
        [per_unit(n_a), per_unit(n_b), np.diff(edges), per_unit(n_a * n_b)], axis=1
    )
    # Written order: the tokens of a, then those of b, group by group.
    size_a, size_b = len(two.bytes_a), two.size_b
    order = np.empty(len(a) + len(b), np.int64)
    last_a = np.arange(len(a)) == (first_a + n_a)[group_a] - 1
    last_b = np.arange(len(b)) == (first_b + n_b)[group_b] - 1
    order[np.arange(len(a)) + first_b[group_a]] = a + last_a * size_a
    order[np.arange(len(b)) + (first_a + n_a)[group_b]] = 2 * size_a + b + last_b * size_b
    stops = np.cumsum(counts[:, 0] + counts[:, 1]).tolist()
    texts = [
        "".join(map(two.written.__getitem__, order[s:e].tolist()))
        for s, e in zip([0, *stops[:-1]], stops, strict=True)
    ] if units else []
    keys, times = _linked(a, b, n_a, n_b, first_a, first_b, unit_of, size_a, size_b)
    whole = size_a * size_b
    at = np.searchsorted(keys, np.arange(1, units) * whole)
    return Groups(counts, texts, np.split(keys % whole, at), np.split(times, at))


def _linked(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, first_a: np.ndarray,
    first_b: np.ndarray, unit_of: np.ndarray, size_a: int, size_b: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (unit, id of a, id of b) as one sorted integer, and the links of each."""
    links = n_a * n_b
    usual = links <= 4096
    # Every token of a in a usual group, once for each token of b there.
    rows = np.flatnonzero(np.repeat(usual, n_a))
    group = np.repeat(np.arange(len(n_a)), n_a)[rows]
    times = n_b[group]
    start = np.cumsum(times) - times
    partner = np.arange(int(times.sum())) - np.repeat(start - first_b[group], times)
    keys = (np.repeat(unit_of[group] * size_a + a[rows], times)) * size_b + b[partner]
    keys, count = np.unique(keys, return_counts=True)
    extra_keys, extra_count = [keys], [count]
    for g in np.flatnonzero(~usual).tolist():  # long groups: distinct ids against distinct ids
        ids_a, of_a = np.unique(a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        ids_b, of_b = np.unique(b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        extra_keys.append((((unit_of[g] * size_a + ids_a) * size_b)[:, None] + ids_b).ravel())
        extra_count.append((of_a[:, None] * of_b).ravel())
    if len(extra_keys) > 1:
        keys, back = np.unique(np.concatenate(extra_keys), return_inverse=True)
        count = np.zeros(len(keys), np.int64)
        np.add.at(count, back, np.concatenate(extra_count))
    return keys, count


@dataclass(frozen=True)
class Fragment:
    """What a byte range of a text contributes: an element of a monoid.

    Tokens belong to the range where they end. `prefix` are the ids up to the range's first
    common end, which a group begun in earlier ranges may own; `suffix` those after its last one.
    Between the two the groups are closed and need not move again. A range without a common end
    (`ends` is false) is all prefix. The empty fragment is the identity.
    """

    ends: bool
    prefix: tuple[tuple[int, ...], tuple[int, ...]]
    suffix: tuple[tuple[int, ...], tuple[int, ...]]


EMPTY = Fragment(False, ((), ()), ((), ()))


def compose(
    left: Fragment, right: Fragment
) -> tuple[Fragment, tuple[tuple[int, ...], tuple[int, ...]] | None]:
    """Both ranges as one, and the group that closes at the first common end of the right one.

    Associative: however a text is cut and whatever is composed first, the same groups close.
    """

    def joined(x: tuple, y: tuple) -> tuple[tuple[int, ...], tuple[int, ...]]:
        return x[0] + y[0], x[1] + y[1]

    if not left.ends:  # all of it goes on into the right one
        return Fragment(right.ends, joined(left.prefix, right.prefix), right.suffix), None
    if not right.ends:
        return Fragment(True, left.prefix, joined(left.suffix, right.prefix)), None
    return Fragment(True, left.prefix, right.suffix), joined(left.suffix, right.prefix)


def cut_fragment(
    two: TokenizerPair, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray
) -> tuple[Fragment, Groups]:
    """The fragment of the tokens that end in a range, and its closed groups as one unit."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if len(common) == 0:
        open_ends = (tuple(a.tolist()), tuple(b.tolist()))
        none = np.zeros(0, np.int64)
        empty = Groups(np.zeros((1, 4), np.int64), [""], [none], [none])
        return Fragment(False, open_ends, ((), ())), empty
    low_a, low_b = (int(np.searchsorted(e, common[0], side="right")) for e in (ends_a, ends_b))
    high_a, high_b = (int(np.searchsorted(e, common[-1], side="right")) for e in (ends_a, ends_b))
    closed = close_groups(
        two, a[low_a:high_a], b[low_b:high_b], ends_a[low_a:high_a], ends_b[low_b:high_b],
        common[-1:],
    )
    fragment = Fragment(
        True,
        (tuple(a[:low_a].tolist()), tuple(b[:low_b].tolist())),
        (tuple(a[high_a:].tolist()), tuple(b[high_b:].tolist())),
    )
    return fragment, closed


def cut_text(text: str, size: int) -> list[str]:
    """Pieces of at least `size` characters, cut where neither tokenizer can merge."""
    out, start = [], 0
    while (found := CUT.search(text, start + size)) is not None:
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def _nullable(df: DataFrame, columns: list[str], **new: object) -> StructType:
    kinds = df.select(*columns).schema.fields
    return StructType(
        [StructField(f.name, f.dataType, True) for f in kinds]
        + [StructField(name, kind, True) for name, kind in new.items()]
    )


class _Block:
    """Documents of a task that share a dictionary of their id pairs."""

    def __init__(self, names: list[str], first: int) -> None:
        self.names, self.number = names, first
        self.clear()

    def clear(self) -> None:
        self.rows: list[pa.RecordBatch] = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, rows: pa.RecordBatch, groups: Groups, digests: list[str]) -> None:
        self.rows.append(rows)
        self.counts.append(groups.counts)
        self.digests += digests
        self.pairs += groups.pairs
        self.times += groups.times
        self.size += sum(map(len, groups.pairs))

    def flush(self) -> Iterator[pa.RecordBatch]:
        total = len(self.digests)
        if not total:
            return
        counts = np.concatenate(self.counts)
        codes, at, docs = np.unique(
            np.concatenate(self.pairs), return_inverse=True, return_counts=True
        )
        at = at.astype("<i4")
        stops = np.cumsum([len(p) for p in self.pairs]).tolist()
        spans = list(zip([0, *stops[:-1]], stops, strict=True))
        places = pa.array([at[s:e].tobytes() for s, e in spans], pa.binary())
        times = pa.array([t.astype("<i4").tobytes() for t in self.times], pa.binary())
        one = pa.array([self.number] * total, pa.int64())
        # The dictionary rides on the first row.
        tail = [None] * (total - 1)
        lists = [
            pa.array([v.tolist(), *tail], pa.list_(k))
            for v, k in ((codes, pa.int64()), (docs, pa.int64()))
        ]
        columns = [
            *(
                pa.concat_arrays([r.column(i) for r in self.rows])
                for i in range(self.rows[0].num_columns)
            ),
            *(pa.array(counts[:, i], pa.int64()) for i in range(len(COUNTS))),
            pa.array(self.digests, pa.string()),
            one, places, times, *lists,
        ]
        yield pa.RecordBatch.from_arrays(columns, self.names)
        self.number += 1
        self.clear()


def _align_whole(docs: DataFrame, text: str, others: list[str], files: tuple[str, str]) -> DataFrame:
    """Counts and digest of each text, and its id pairs as places in its block's dictionary."""
    new = {
        **dict.fromkeys(COUNTS, LongType()), "groups_sha256": StringType(), "block": LongType(),
        "places": BinaryType(), "times": BinaryType(),
        "codes": ArrayType(LongType()), "docs": ArrayType(LongType()),
    }
    hidden = [f"_{i}" for i in range(len(others))]  # the new names cannot clash with these
    renamed = docs.select(
        F.col(text).alias("_text"), *(F.col(c).alias(h) for c, h in zip(others, hidden, strict=True))
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = tokenizer_pair(*files)
        block = _Block([*hidden, *new], TaskContext.get().partitionId() << 32)
        for whole in parts:
            for first in range(0, whole.num_rows, 200):
                part = whole.slice(first, 200)
                groups = _groups_of(two, [t or "" for t in part.column(0).to_pylist()])
                digests = [
                    hashlib.sha256(t[:-1].encode()).hexdigest() if t else "" for t in groups.text
                ]
                rows = pa.RecordBatch.from_arrays(part.columns[1:], hidden)
                block.add(rows, groups, digests)
                if block.size >= BLOCK_PAIRS:
                    yield from block.flush()
        yield from block.flush()

    return renamed.mapInArrow(batches, _nullable(renamed, hidden, **new))


def _groups_of(two: TokenizerPair, texts: list[str]) -> Groups:
    """The groups of whole texts; those that a tokenizer does not keep have none."""
    found = two.ids(texts, [True] * len(texts))
    kept = [pair if pair and text else ([], []) for pair, text in zip(found, texts, strict=True)]
    a, b = (np.concatenate([np.asarray(p[side], np.int64) for p in kept]) for side in (0, 1))
    sizes = [len(t.encode()) + 1 if p[0] else 0 for t, p in zip(texts, kept, strict=True)]
    return close_groups(
        two, a, b, np.cumsum(two.len_a[a]), np.cumsum(two.len_b[b]), np.cumsum(sizes)
    )


def _cut_pieces(
    docs: DataFrame, text: str, others: list[str], files: tuple[str, str], size: int
) -> DataFrame:
    """key, chunk, piece of each text; the other columns stand in its first row only."""
    hidden = [f"_{i}" for i in range(len(others))]
    renamed = docs.select(
        F.col(text).alias("_text"), *(F.col(c).alias(h) for c, h in zip(others, hidden, strict=True))
    )
    new = {"key": LongType(), "chunk": IntegerType(), "piece": StringType()}

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        divisible = tokenizer_pair(*files).divisible
        for whole in parts:
            for row in range(whole.num_rows):
                body = whole.column(0)[row].as_py()
                pieces = cut_text(body, size) if divisible else [body]
                own = pa.array([row] + [None] * (len(pieces) - 1), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.take(own) for c in whole.columns[1:]),
                        pa.array([key] * len(pieces), pa.int64()),
                        pa.array(range(len(pieces)), pa.int32()),
                        pa.array(pieces, pa.string()),
                    ],
                    [*hidden, *new],
                )
                key += 1

    return renamed.mapInArrow(batches, _nullable(renamed, hidden, **new))


IDS = ArrayType(IntegerType())
OPEN = {
    "ends": BooleanType(), "prefix_a": IDS, "prefix_b": IDS, "suffix_a": IDS, "suffix_b": IDS,
}
_IDS = pa.list_(pa.int32())


def _open_columns(found: list[Fragment]) -> list[pa.Array]:
    return [
        pa.array([f.ends for f in found], pa.bool_()),
        *(pa.array([f.prefix[i] for f in found], _IDS) for i in (0, 1)),
        *(pa.array([f.suffix[i] for f in found], _IDS) for i in (0, 1)),
    ]


def _fragments(pieces: DataFrame, files: tuple[str, str]) -> DataFrame:
    """The fragment of every piece, with its closed groups where it stands."""
    new = {
        "key": LongType(), "chunk": IntegerType(), "same": BooleanType(), **OPEN,
        **dict.fromkeys(COUNTS, LongType()), "closed": StringType(),
        "codes": ArrayType(LongType()), "times": ArrayType(LongType()),
    }

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = tokenizer_pair(*files)
        none = np.zeros(0, np.int64)
        for whole in parts:
            for first in range(0, whole.num_rows, 16):
                part = whole.slice(first, 16)
                chunks = part.column(1).to_pylist()
                found = two.ids(part.column(2).to_pylist(), [c == 0 for c in chunks])
                cut = []
                for pair in found:
                    a, b = (np.asarray(x, np.int64) for x in pair or ([], []))
                    ends = np.cumsum(two.len_a[a]), np.cumsum(two.len_b[b])
                    fragment, groups = cut_fragment(two, a, b, *ends)
                    counts = groups.counts[0].tolist()
                    counts[:2] = len(a), len(b)
                    cut.append((fragment, counts, groups))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([pair is not None for pair in found], pa.bool_()),
                        *_open_columns([c[0] for c in cut]),
                        *(pa.array([c[1][i] for c in cut], pa.int64()) for i in range(len(COUNTS))),
                        pa.array([c[2].text[0][:-1] for c in cut], pa.string()),
                        *(
                            pa.array([x.tolist() for x in column], pa.list_(pa.int64()))
                            for column in (
                                [(c[2].pairs or [none])[0] for c in cut],
                                [(c[2].times or [none])[0] for c in cut],
                            )
                        ),
                    ],
                    list(new),
                )

    schema = StructType([StructField(n, k, True) for n, k in new.items()])
    # By count and not by bytes: a few megabytes of text are seconds of work.
    parts = min(4096, max(1, math.ceil(pieces.count() / 64)))
    return (
        pieces.select("key", "chunk", "piece")
        .repartition(parts, "key", "chunk")
        .mapInArrow(batches, schema)
    )


GROUP = StructType(
    [StructField("place", IntegerType()), StructField("a", IDS), StructField("b", IDS)]
)


def _reduce_tree(fragments: DataFrame, most_chunks: int) -> DataFrame:
    """key, place, a, b: the groups that close where fragments meet.

    Only the open ends travel. Each round composes FAN_IN neighbours, so a text of a million
    pieces takes five rounds and no task ever holds more than FAN_IN fragments of it.
    `place` is the piece before whose own groups the group stands.
    """
    schema = StructType(
        [
            StructField("key", LongType()),
            StructField("at", IntegerType()),
            StructField("first", IntegerType()),
            *(StructField(n, k, True) for n, k in OPEN.items()),
            StructField("groups", ArrayType(GROUP)),
        ]
    )
    group_type = pa.list_(pa.struct([("place", pa.int32()), ("a", _IDS), ("b", _IDS)]))

    def step(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        whole, closed = EMPTY, []
        for row in rows.to_pylist():
            right = Fragment(
                row["ends"],
                (tuple(row["prefix_a"]), tuple(row["prefix_b"])),
                (tuple(row["suffix_a"]), tuple(row["suffix_b"])),
            )
            whole, group = compose(whole, right)
            if group is not None and (group[0] or group[1]):
                closed.append({"place": row["first"], "a": group[0], "b": group[1]})
        head = rows.slice(0, 1)
        return pa.Table.from_arrays(
            [
                head["key"],
                pa.array([head["at"][0].as_py() // FAN_IN], pa.int32()),
                head["first"],
                *_open_columns([whole]),
                pa.array([closed], group_type),
            ],
            schema.names,
        )

    level = fragments.select(
        "key", F.col("chunk").alias("at"), F.col("chunk").alias("first"), *OPEN
    )
    found, width = [], 1
    while width < most_chunks:
        level = materialise(
            level.groupBy("key", F.expr(f"at div {FAN_IN}").alias("up")).applyInArrow(step, schema),
            "align-level",
        )
        found.append(level.select("key", F.inline("groups")))
        width *= FAN_IN
    # The begin of a text is an end to the groups before it: what is still open there closes.
    out = level.where("size(prefix_a) + size(prefix_b) > 0").select(
        "key", F.lit(0).alias("place"), F.col("prefix_a").alias("a"), F.col("prefix_b").alias("b")
    )
    for groups in found:
        out = out.unionByName(groups)
    return out


def align_tokenizers(
    docs: DataFrame,
    text: str = "text",
    file_a: str = "byte_bpe_50k.json",
    file_b: str = "piece_bpe_32k.model",
    piece_chars: int = 16_384,
) -> DataFrame:
    """Every row of `docs` without its text, plus the alignment of its tokens by two tokenizers.

    A byte-level vocabulary (`file_a`, with its rank file beside it) reads a space and the text, a
    sentence-piece one (`file_b`) the text, to which it adds that space. Byte offsets where tokens
    of both end cut the tokens into groups; each token of the one is linked to each of the other
    in its group. New columns: n_a, n_b, n_groups, n_links; groups_sha256 (of the written groups
    `a1,a2|b1;a3|b2,b3`); n_best (links whose id pair is linked in as many rows of the table as
    any pair with that id of `file_a`) and count_sum (over the links, the rows that hold their pair).

    A text is aligned as a whole by one task up to twice `piece_chars` bytes. A longer one is cut
    before spaces and line ends, where neither tokenizer merges, into pieces that many tasks
    tokenize; their fragments are composed in a tree (see `Fragment`). Without such a place the
    text is one piece.

    Texts that are NULL or empty, or whose token bytes by either are not the space and the text,
    have no tokens: zeros and an empty digest. Repeated rows, also with NULL ids, each count as a
    row. Input columns called like a new one are replaced.
    """
    others = [c for c in docs.columns if c != text and c.lower() not in NEW]
    files = (file_a, file_b)
    hidden = [f"_{i}" for i in range(len(others))]
    kept = docs.select(*others, text)
    long_text = F.octet_length(F.col(text)) > 2 * piece_chars
    whole = materialise(
        _align_whole(kept.where(~F.coalesce(long_text, F.lit(False))), text, others, files),
        "align-whole",
    )
    pieces = materialise(
        _cut_pieces(kept.where(long_text), text, others, files, piece_chars), "align-pieces"
    )
    fragments = materialise(_fragments(pieces, files), "align-fragments")
    most = fragments.agg(F.max("chunk")).first()[0]
    met = materialise(_reduce_tree(fragments, 1 + (most or 0)), "align-met")
    lost = fragments.where("NOT same").select("key").distinct()  # one piece decides for the text
    fragments, met = (x.join(lost, "key", "left_anti") for x in (fragments, met))
    size_b = tokenizer_pair(*files).size_b
    long_pairs = materialise(
        fragments.select("key", F.inline(F.arrays_zip("codes", "times")))
        .toDF("key", "code", "times")
        .unionAll(
            met.select("key", F.explode("a").alias("a"), "b")
            .select("key", "a", F.explode("b").alias("b"))
            .select("key", F.expr(f"a * {size_b}L + b"), F.lit(1).cast("bigint"))
        )
        .groupBy("key", "code")
        .agg(F.sum("times").alias("times")),
        "align-long-pairs",
    )
    entries = (
        whole.where("codes IS NOT NULL")
        .select("block", F.posexplode(F.arrays_zip("codes", "docs")))
        .selectExpr("block AS owner", "pos AS at", "col.codes AS code", "col.docs AS docs")
    )
    held = (
        entries.select("code", "docs")
        .unionAll(long_pairs.select("code", F.lit(1).cast("bigint")))
        .groupBy("code")
        .agg(F.sum("docs").alias("held"))
    )
    held = materialise(held, "align-held")
    id_a = F.expr(f"code div {size_b}")
    tops = held.groupBy(id_a.alias("id_a")).agg(F.max("held").alias("top"))
    rated = (
        held.withColumn("id_a", id_a)
        .join(F.broadcast(tops), "id_a")  # a row per id of a vocabulary, at most
        .select("code", "held", (F.col("held") == F.col("top")).alias("best"))
    )
    rated = materialise(rated, "align-rated")
    short = _short_results(whole, entries.join(rated, "code"), hidden)
    return short.unionByName(_long_results(pieces, fragments, met, long_pairs, rated, hidden)).select(
        *(F.col(h).alias(c) for h, c in zip(hidden, others, strict=True)), *NEW
    )


def _short_results(whole: DataFrame, entries: DataFrame, hidden: list[str]) -> DataFrame:
    """Sums over the pairs of each document, from the looked-up dictionary of its block."""
    results = ["n_best", "count_sum"]
    columns = [*hidden, *COUNTS, "groups_sha256"]
    schema = _nullable(whole, columns, **dict.fromkeys(results, LongType()))

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        at = found["at"].to_numpy()
        held = np.zeros(len(at), np.int64)
        best = np.zeros(len(at), np.int64)
        held[at] = found["held"].to_numpy()
        best[at] = found["best"].to_numpy()
        places = rows["places"].to_pylist()
        place = np.frombuffer(b"".join(places), "<i4")
        times = np.frombuffer(b"".join(rows["times"].to_pylist()), "<i4").astype(np.int64)
        edges = np.concatenate(([0], np.cumsum([len(p) // 4 for p in places])))
        out = rows.select(columns)
        for name, values in zip(results, (best, held), strict=True):
            sums = np.concatenate(([0], np.cumsum(values[place] * times)))
            out = out.append_column(name, pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64()))
        return out

    return (
        whole.select("block", *columns, "places", "times")
        .groupBy("block")
        .cogroup(entries.select("owner", "at", "held", "best").groupBy("owner"))
        .applyInArrow(look_up, schema)
    )


def _long_results(
    pieces: DataFrame, fragments: DataFrame, met: DataFrame, long_pairs: DataFrame,
    rated: DataFrame, hidden: list[str],
) -> DataFrame:
    """The same of the texts that were cut: their groups in order, and sums over their pairs."""
    written = F.expr("concat(array_join(a, ','), '|', array_join(b, ','))")
    stands = (
        fragments.where("closed <> ''")
        .select("key", F.struct(F.col("chunk").alias("p"), F.lit(1).alias("o"), "closed").alias("s"))
        .unionAll(met.select("key", F.struct("place", F.lit(0), written)))
    )
    digests = stands.groupBy("key").agg(
        F.sha2(
            F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["closed"]), ";"),
            256,
        ).alias("groups_sha256")
    )
    counts = (
        fragments.select("key", "n_a", "n_b", "n_groups")
        .unionAll(met.select("key", F.lit(0), F.lit(0), F.lit(1)))
        .groupBy("key")
        .agg(*(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")))
    )
    sums = (
        long_pairs.join(rated, "code")
        .groupBy("key")
        .agg(
            F.sum("times").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.expr("times * held")).alias("count_sum"),
        )
    )
    heads = pieces.where("chunk = 0").select("key", *hidden)
    joined = (
        heads.join(counts, "key", "left").join(sums, "key", "left").join(digests, "key", "left")
    )
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *hidden,
        *(F.coalesce(c, zero).alias(c) for c in COUNTS),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
        *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")),
    )
