"""Packing token sequences into fixed windows: best fit decreasing on a capacity tree."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import starmap

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from cellhours.llm.common import with_fields
from cellhours.sources.scratch import materialise

MAX_CACHED_WORDS = 1_000_000


@cache
def _tokenizer(file: str):  # noqa: ANN202 - the library loads where it is used
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(file))


@cache
def _word_tokenizer(file: str):  # noqa: ANN202
    """The vocabulary's merges alone, for words that its rules would leave whole.

    Those words are lower case letters of the first 256 codes, so of the vocabulary's rules only
    the mapping of bytes to symbols is left to apply.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    full = _tokenizer(file)
    plain = Tokenizer(full.model)
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return plain


class WordEncoder:
    """Ids of whole texts, as little-endian bytes, from a cache of encoded words.

    The vocabulary drops white space and never joins across it, so the ids of a text are those
    of its space- and newline-separated parts in a row. Capitals do not matter to it, and a
    closing comma or full stop behind letters is a word of its own, so new parts are looked up
    without both.
    """

    def __init__(self, file: str) -> None:
        self.file = file
        self.known: dict[str, bytes] = {}
        self.marks = [t.content for t in _tokenizer(file).get_added_tokens_decoder().values()]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what is new in all of them is encoded at once."""
        parts = [self._lower(text).replace("\n", " ").split(" ") for text in texts]
        seen = set().union(*parts)
        new = seen.difference(self.known)
        if new:
            if len(self.known) + len(new) > MAX_CACHED_WORDS:
                self.known, new = {}, seen
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, words)) for words in parts]

    def _learn(self, new: set[str]) -> None:
        ended = [w for w in new if w[-1:] in {".", ","} and w[:-1].isalpha() and _is_latin(w)]
        wanted = new.difference(ended)
        wanted.update([w[:-1] for w in ended], (".", ","))
        wanted = wanted.difference(self.known)  # a lookup per word, unlike difference_update
        plain = [w for w in wanted if w.isalpha() and _is_latin(w)]
        words = _word_tokenizer(self.file)
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            found = words.encode(" ".join(some).lower(), add_special_tokens=False)
            ids = np.asarray(found.ids, "<u4").tobytes()
            edges = (np.searchsorted(found.word_ids, np.arange(len(some) + 1)) * 4).tolist()
            self.known.update(zip(some, map(ids.__getitem__, map(slice, edges, edges[1:]))))
        other = list(wanted.difference(plain))
        encoded = _tokenizer(self.file).encode_batch_fast(other, add_special_tokens=False)
        for word, one in zip(other, encoded, strict=True):
            self.known[word] = np.asarray(one.ids, "<u4").tobytes()
        known = self.known
        known.update([(w, known[w[:-1]] + known[w[-1]]) for w in ended])

    def _lower(self, text: str) -> str:
        """The text in lower case, if the vocabulary surely takes both for the same."""
        lower = text.lower() if _is_latin(text) else text
        return text if any(mark in lower for mark in self.marks) else lower


@cache
def _encoder(file: str) -> WordEncoder:
    """One in each Python worker: what a task has learned serves those after it."""
    return WordEncoder(file)


def _is_latin(text: str) -> bool:
    """Whether all characters are among the first 256 codes, which no rule composes."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return True


class CapacityTree:
    """Open windows by free tokens; finds the fullest one that still has room.

    A segment tree over the capacities 0..size: a node holds whether any window below is open.
    """

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, free: int, window: int) -> None:
        self.windows[free].append(window)
        node = self.leaves + free
        while node:
            self.open[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (free, window) with the least free >= need."""
        node = self.leaves + need
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        free = node - self.leaves
        window = self.windows[free].pop()
        while node:
            self.open[node] -= 1
            node >>= 1
        return free, window


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every piece; no piece is longer than the window."""
    tree, used = CapacityTree(window), 0
    place = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        free, number = tree.take(need) or (window, -1)
        if number < 0:
            number, used = used, used + 1
        place[i], offset[i] = number, window - free
        tree.put(free - need, number)
    return place, offset


def pieces(
    docs: DataFrame, doc_id: str, text: str, file: str, end_id: int, window: int, with_ids: bool,
    order: Sequence[str] = (),
) -> DataFrame:
    """Ids of each text and `end_id`, cut into full windows and a rest; a row per piece.

    Columns: doc_id, start, length, doc_tokens, ids_crc32; ids (binary, little-endian unsigned 32
    bit) if asked for; and the columns of `order`, as order0 and so on.
    """
    closing = np.asarray([end_id], "<u4").tobytes()
    new = {"start": LongType(), "length": LongType(), "doc_tokens": LongType()}
    new |= {"ids_crc32": LongType()} | ({"ids": BinaryType()} if with_ids else {})
    keys = docs.select(
        F.col(doc_id).alias("doc_id"),
        *[F.col(c).alias(f"order{i}") for i, c in enumerate(order)],
        F.col(text).alias("text"),
    )
    schema = StructType([*keys.drop("text").schema.fields, *starmap(StructField, new.items())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file)
        for whole in parts:
            for first in range(0, whole.num_rows, 250):
                part = whole.slice(first, 250)
                row_of, rows = [], []
                texts = [t or "" for t in part.columns[-1].to_pylist()]
                for row, ids in enumerate(encoder.encode(texts)):
                    ids += closing
                    for at in range(0, len(ids), 4 * window):
                        cut = ids[at : at + 4 * window]
                        row_of.append(row)
                        rows.append((at // 4, len(cut) // 4, len(ids) // 4, zlib.crc32(cut), cut))
                taken = pa.array(row_of, pa.int64())
                kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
                columns = [c.take(taken) for c in part.columns[:-1]]
                columns += [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return keys.mapInArrow(batches, schema)


def pack(
    parts: DataFrame, window: int, block_pieces: int = 100_000, order: Sequence[str] = ()
) -> DataFrame:
    """Add `sequence_id` and `offset` to rows with a `length` of at most `window`.

    The rows are dealt into blocks of about `block_pieces` pieces, a bound on the memory of a task;
    each block is packed by itself. Its windows are numbered from block number * 2**32, and at most
    one window of a block and length class stays half empty. Without `order` rows are dealt evenly,
    not by key, so nothing can be hot. With it a block is a stretch of consecutive rows and the
    blocks follow each other, so what stands together in the order is packed together.
    """
    blocks = max(1, math.ceil(parts.count() / block_pieces))
    columns = parts.columns
    dealt = parts.repartitionByRange(blocks, *order) if order else parts.repartition(blocks)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = pd.concat([*frames, pd.DataFrame(columns=columns)], ignore_index=True)
        if block.empty:
            return
        base = TaskContext.get().partitionId() << 32
        place, offset = best_fit_decreasing(block["length"].to_numpy(np.int64), window)
        yield block.assign(sequence_id=base + place, offset=offset)

    schema = with_fields(parts, columns, sequence_id=LongType(), offset=LongType())
    return dealt.mapInPandas(batches, schema)


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    file: str = "word_bpe_49k.json",
    end_id: int = 1,
    window: int = 2048,
    with_ids: bool = False,
    order: Sequence[str] = (),
    stretch_pieces: int = 8192,
) -> DataFrame:
    """Pack all texts of `docs`: one row per piece: doc_id, start, length, doc_tokens, ids_crc32,
    sequence_id, offset, and with `with_ids` the ids themselves (binary, little-endian).

    A text longer than the window is cut into full windows first; the rests and the short texts
    are packed best fit decreasing. A NULL or empty text is its `end_id` alone. Repeated rows and
    rows with a NULL id are packed like any other; other columns are not read.

    `order` names columns whose order (a mixing schedule, say) the sequences have to follow: each
    stretch of about `stretch_pieces` pieces in that order is packed by itself, and its sequences
    have greater ids than those of the stretches before it.
    """
    cut = pieces(docs, doc_id, text, file, end_id, window, with_ids, order)
    cut = materialise(cut, "packing-pieces")
    if not order:
        return pack(cut, window)
    keys = [f"order{i}" for i in range(len(order))]
    return pack(cut, window, stretch_pieces, [*keys, "doc_id", "start"]).drop(*keys)
