"""Exact removal of long repeated byte strings with a sparse enhanced suffix array.

A suffix array of every byte is not needed: `length - GRAM + 1` neighbouring grams of GRAM bytes
lie in each string of `length` bytes, and the least of their hashes picks the same place in every
copy of the string. Only these places (anchors, about one byte in 170) enter the suffix array, and
only where their gram occurs again. Anchors of one gram form a bucket; within it

* the anchors' suffixes are sorted, with the common prefixes of neighbours (the LCP array),
* a stack scan of the LCP array visits the tree of LCP intervals from the leaves up,
* in each interval the left contexts are put in order; where the left extensions of neighbours
  differ the interval falls into several maximal repeats, each with all of its occurrences, not
  just with neighbours of the suffix array.

Everything is compared byte by byte, so hash collisions cost time but never a wrong byte.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from cellhours.llm.common import fresh_name, with_fields
from cellhours.sources.scratch import materialise

GRAM = 64
WORD_GRAM = 32
_STEP = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Rolling hash of the `width` items from each place on, by doubling; a power of two."""
    hashes, have, step = data.astype(np.uint64) + np.uint64(1), 1, _STEP
    while have < width:
        hashes = hashes[:-have] * np.uint64(step) + hashes[have:]
        have, step = 2 * have, step * step % (1 << 64)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of `width` values, by doubling."""
    least, have = hashes, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def anchor_places(hashes: np.ndarray, width: int) -> list[int]:
    """First place of the least hash of every window of `width` hashes."""
    least = window_minima(hashes, width)
    turns = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts, ends = [0, *turns.tolist()], [*turns.tolist(), len(least)]
    places = []
    for start, end in zip(starts, ends, strict=True):
        while start < end:  # more than once only if the least hash recurs in the run
            start += int(hashes[start : start + width].argmin())
            places.append(start)
            start += 1
    return sorted(set(places))


def anchors(data: bytes, length: int) -> tuple[list[int], np.ndarray, list[int]]:
    """Places, gram hashes and context hashes of the anchors of one text."""
    if len(data) < length:
        return [], np.zeros(0, np.int64), []
    reach = length - GRAM
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    places = anchor_places(hashes, reach + 1)
    mark = xxhash.xxh3_64_intdigest
    around = [mark(data[max(0, p - reach) : p + length], min(p, reach)) for p in places]
    return places, hashes[places].view(np.int64), around


def passage_marks(data: bytes, words: int) -> np.ndarray:
    """Least gram hash of every passage of `words` words in a text, each hash once.

    Words stand between ASCII white space, grams are WORD_GRAM words. Equal passages have equal
    marks, and texts with a common mark have at least a gram in common.
    """
    found = data.split()
    if len(found) < words:
        return np.zeros(0, np.int64)
    digests = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    hashes = gram_hashes(digests, WORD_GRAM)
    return np.unique(window_minima(hashes, words - WORD_GRAM + 1)).view(np.int64)


def repeat_extents(
    left: list[bytes], right: list[bytes], copies: list[int], length: int
) -> tuple[np.ndarray, np.ndarray]:
    """How far each context is repeated to the left and right of its anchor; 0 and 0 if nowhere.

    The contexts are distinct. Every string of `length` bytes that contains the anchor and occurs
    in another context, or in a context with several copies, is within these extents.
    """
    size = len(left)
    if size == 2:
        return _extents_of_two(left, right, copies, length)
    several = np.asarray(copies) > 1
    back = np.where(several, [len(x) for x in left], 0)
    ahead = np.where(several, [len(x) for x in right], 0)
    order = sorted(range(size), key=right.__getitem__)
    lcp = _neighbour_lcp([right[i] for i in order])
    turned = [x[::-1] for x in left]
    by_left = sorted(range(size), key=turned.__getitem__)
    left_lcp = _neighbour_lcp([turned[i] for i in by_left])
    member = np.asarray(by_left)
    rank = np.empty(size, np.int64)
    rank[member] = np.arange(size)
    floor = length - max(map(len, left))

    def visit(ranks: np.ndarray, value: int) -> None:
        """One LCP interval: its members in left order, and their common prefix."""
        shared = np.minimum.reduceat(left_lcp, ranks[:-1])
        shared[-1] = left_lcp[ranks[-2] : ranks[-1]].min()  # the last one runs on to the end
        best = np.zeros(len(ranks), np.int64)
        best[:-1] = shared
        best[1:] = np.maximum(best[1:], shared)
        found = best + value >= length  # the runs of these are the maximal repeats
        who = member[ranks[found]]
        back[who] = np.maximum(back[who], best[found])
        ahead[who] = np.maximum(ahead[who], value)

    stack: list[tuple[int, list[np.ndarray]]] = []
    for k in range(1, size + 1):
        value = int(lcp[k - 1]) if k < size else -1
        node = rank[order[k - 1] : order[k - 1] + 1]
        while stack and stack[-1][0] > value:
            depth, parts = stack.pop()
            node = np.sort(np.concatenate([*parts, node]), kind="stable")
            visit(node, depth)
        if value < floor:
            continue  # no interval up here can reach the length
        if stack and stack[-1][0] == value:
            stack[-1][1].append(node)
        else:
            stack.append((value, [node]))
    return back, ahead


def _extents_of_two(
    left: list[bytes], right: list[bytes], copies: list[int], length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The same for the most frequent case: a tree of one interval."""
    back = _lcp(left[0][::-1], left[1][::-1])
    ahead = _lcp(*right)
    if back + ahead < length:
        back = ahead = 0
    extents = [
        (len(x), len(y)) if n > 1 else (back, ahead)
        for x, y, n in zip(left, right, copies, strict=True)
    ]
    return np.array([e[0] for e in extents]), np.array([e[1] for e in extents])


def _lcp(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:  # the first difference is in [low, high)
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def _neighbour_lcp(ordered: list[bytes]) -> np.ndarray:
    """Common prefix lengths of neighbours."""
    return np.fromiter(map(_lcp, ordered[:-1], ordered[1:]), np.int64, max(0, len(ordered) - 1))


def covered(size: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of [start, end) spans within a text of `size` bytes."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        start, end = max(0, start), min(size, end)
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    names = ["row_id", "text_key", "place", "gram", "around"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, keys, texts = (c.to_pylist() for c in part.columns)
            rows, places, grams, marks = [], [], [np.zeros(0, np.int64)], []
            for i, text in enumerate(texts):
                found, hashes, around = anchors(text, length)
                rows += [i] * len(found)
                places += found
                grams.append(hashes)
                marks += around
            at = np.asarray(rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.asarray(ids, np.int64)[at]),
                    pa.array(np.asarray(keys, np.int64)[at]),
                    pa.array(places, pa.int32()),
                    pa.array(np.concatenate(grams)),
                    pa.array(np.asarray(marks, np.uint64).view(np.int64)),
                ],
                names,
            )

    schema = "row_id bigint, text_key bigint, place int, gram bigint, around bigint"
    return docs.select("row_id", "text_key", "body").mapInArrow(batches, schema)


def _sharing_texts(docs: DataFrame, words: int) -> DataFrame:
    """`text_key`s of the texts with a mark that another row has too."""
    names = ["text_key", "mark"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys, texts = (c.to_pylist() for c in part.columns)
            marks = [passage_marks(text, words) for text in texts]
            at = np.repeat(np.asarray(keys, np.int64), [len(m) for m in marks])
            found = np.concatenate([np.zeros(0, np.int64), *marks])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found)], names)

    rows = docs.select("text_key", "body").mapInArrow(batches, "text_key bigint, mark bigint")
    marks = materialise(rows, "repeats-marks")
    again = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written first, like the grams: a frequent mark can then be split in the join.
    again = materialise(again.select("mark"), "repeats-marks-again")
    return marks.join(again, "mark", "left_semi").select("text_key").distinct()


def _one_of_each(docs: DataFrame) -> DataFrame:
    """Rows with equal row_id and text_key once; their bodies are only shuffled if there are any."""
    keys = ["row_id", "text_key"]
    again = materialise(
        docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys),
        "repeats-equal-rows",
    )
    if again.isEmpty():
        return docs
    one = docs.join(again, keys, "left_semi").groupBy(*keys).agg(F.any_value("body").alias("body"))
    return docs.join(again, keys, "left_anti").unionByName(one)


def _cut_contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes around the wanted anchors: bucket, ctx, copies, left, right."""
    places = wanted.groupBy("row_id", "text_key").agg(
        F.collect_list(F.struct("place", "gram", "around", "copies")).alias("places")
    )
    reach = length - GRAM
    names = ["bucket", "ctx", "copies", "left", "right"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                rows = [
                    (f["gram"], f["around"], f["copies"], f["place"], body)
                    for body, found in zip(*(c.to_pylist() for c in part.columns), strict=True)
                    for f in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
                        pa.array([b[max(0, p - reach) : p] for *_, p, b in rows], pa.binary()),
                        pa.array([b[p : p + length] for *_, p, b in rows], pa.binary()),
                    ],
                    names,
                )

    schema = "bucket bigint, ctx bigint, copies bigint, left binary, right binary"
    return (
        docs.join(places, ["row_id", "text_key"])
        .select("body", "places")
        .mapInArrow(batches, schema)
    )


def _scan_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """Extents of the contexts, bucket by bucket in sorted partitions."""
    names = ["bucket", "ctx", "back", "ahead"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns)))
        out: list[tuple[int, int, int, int]] = []
        for bucket, group in itertools.groupby(rows, key=lambda row: row[0]):
            # Repeated rows of one id bring a context twice.
            found = list({row[1]: row for row in group}.values())
            back, ahead = repeat_extents(
                [r[3] for r in found], [r[4] for r in found], [r[2] for r in found], length
            )
            out += [
                (bucket, row[1], b, a)
                for row, b, a in zip(found, back.tolist(), ahead.tolist(), strict=True)
                if a
            ]
            if len(out) > 10_000:
                yield _columns(out, names)
                out = []
        yield _columns(out, names)

    return (
        contexts.select("bucket", "ctx", "copies", "left", "right")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(batches, "bucket bigint, ctx bigint, back bigint, ahead bigint")
    )


def _columns(rows: list[tuple[int, ...]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names
    )


def _split(contexts: DataFrame, width: int, length: int) -> tuple[DataFrame, int]:
    """Halve the range of string starts that the contexts stand for.

    A context with `width` bytes at most on the left stands for the strings that start up to
    `width` bytes before its anchor. Each half has a longer core of bytes in common, which is the
    new bucket; `shift` is the way from the old anchor to the new one.
    """
    half = width // 2  # strings that start at 0..half before the anchor, and at half+1..width
    far = half + 1
    core = length - max(half, width - far)
    # A half may have one start fewer than the other; a core shorter by a byte only merges
    # buckets, and the strings themselves are compared in the scan.
    near_rows = contexts.selectExpr(
        "bucket", "ctx", "copies", "0 AS shift",
        f"substring(left, greatest(1, length(left) - {half - 1}), {half}) AS l",
        "right AS r",
    )
    far_rows = contexts.where(f"length(left) >= {far}").selectExpr(
        "bucket", "ctx", "copies", f"{far} AS shift",
        f"substring(left, 1, length(left) - {far}) AS l",
        f"substring(concat(substring(left, length(left) - {far - 1}, {far}), right), 1, {length}) AS r",
    )
    rows = (
        near_rows.unionAll(far_rows)
        .where(f"length(l) + length(r) >= {length}")
        .selectExpr(
            "bucket AS old_bucket", "ctx AS old_ctx", "copies", "shift", "l AS left", "r AS right",
            f"xxhash64(bucket, shift, substring(r, 1, {core})) AS bucket",
            "xxhash64(l, r, length(l)) AS ctx",
        )
    )
    return rows, max(half, width - far)


def repeated_extents(contexts: DataFrame, length: int, most: int) -> DataFrame:
    """(bucket, ctx, back, ahead) of the contexts that hold repeated strings.

    A bucket of more than `most` contexts (many texts share a passage but not what stands around
    it) is not given to one task: its range of string starts is halved until the contexts of each
    part are few, because they coincide or because their longer cores differ. With a range of one
    start the core is the string itself, so the splitting always ends.
    """
    width = length - GRAM
    found: list[DataFrame] = []
    trail: list[DataFrame] = []
    while True:
        crowded = materialise(
            contexts.groupBy("bucket").count().where(F.col("count") > most).select("bucket"),
            "repeats-crowded",
        )
        if width == 0 or crowded.isEmpty():
            extents = _scan_buckets(contexts, length)
            break
        extents = _scan_buckets(contexts.join(crowded, "bucket", "left_anti"), length)
        rows, width = _split(contexts.join(crowded, "bucket", "left_semi"), width, length)
        rows = materialise(rows, "repeats-split")
        found.append(extents)
        trail.append(rows.select("old_bucket", "old_ctx", "bucket", "ctx", "shift"))
        contexts = materialise(
            rows.groupBy("bucket", "ctx").agg(
                F.sum("copies").alias("copies"),
                F.first("left").alias("left"),
                F.first("right").alias("right"),
            ),
            "repeats-contexts",
        )
    while trail:
        extents = (
            trail.pop()
            .join(extents, ["bucket", "ctx"])
            .groupBy(F.col("old_bucket").alias("bucket"), F.col("old_ctx").alias("ctx"))
            .agg(
                F.max(F.col("back") + F.col("shift")).alias("back"),
                F.max(F.col("ahead") - F.col("shift")).alias("ahead"),
            )
            .unionAll(found.pop())
        )
    return extents


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 400,
    most: int = 20_000,
    words: int | None = None,
) -> DataFrame:
    """Every row of `docs`, with the bytes that belong to repeated strings taken out of its text.

    A byte goes if some string of `length` bytes that covers it also starts anywhere else in the
    table, the same text included; overlaps count and all strings are judged on the input. The
    result has the input's columns except the text, and `n_bytes`, `removed` (array of structs
    start, end: the maximal removed runs, in bytes) and `kept` (binary: what is left; cutting may
    split a character). A NULL text counts as empty, and so stays whole like every text shorter
    than `length`. Rows with equal texts lose all of it, equal ids included. Input columns called
    like a new one are replaced. `most`: contexts of a bucket that one task may sort.

    With `words` there is a column `shares_passage` besides, which takes nothing out: true for every
    row that has a passage of so many words in common with another row, however few bytes that is,
    and for none that has less than WORD_GRAM words in a row in common with any.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    if words is not None and words < WORD_GRAM:
        raise ValueError(f"words must be at least {WORD_GRAM}")
    new = {"n_bytes", "removed", "kept"} | (set() if words is None else {"shares_passage"})
    others = [c for c in docs.columns if c != text and c.lower() not in new]
    body, row_id, key, found, shares = (
        fresh_name(docs, n) for n in ("body", "row_id", "text_key", "spans", "shares")
    )
    bodies = (
        docs.withColumn(body, F.coalesce(F.col(text), F.lit("")).cast("binary"))
        .withColumn(key, F.xxhash64(body))
        .withColumn(row_id, F.xxhash64(doc_id))
    )
    plain = bodies.select(
        F.col(row_id).alias("row_id"), F.col(key).alias("text_key"), F.col(body).alias("body")
    )
    long_ones = plain.where(F.octet_length("body") >= length)
    places = materialise(_find_anchors(long_ones, length), "repeats-anchors")
    again = places.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written first: a frequent gram can then be split in the join, which the sums forbid.
    again = materialise(again.select("gram"), "repeats-again")
    places = materialise(places.join(again, "gram", "left_semi"), "repeats-places")
    distinct = places.groupBy("gram", "around").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("row_id", "text_key", "place")).alias("at"),
    )
    distinct = materialise(
        distinct.select("gram", "around", "copies", "at.*"), "repeats-distinct"
    )
    kinds = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = materialise(kinds, "repeats-kinds")
    split = materialise(distinct.join(kinds, "gram"), "repeats-kinded")
    wanted = split.where("kinds > 1").drop("kinds")
    contexts = materialise(
        _cut_contexts(_one_of_each(long_ones), wanted, length), "repeats-contexts"
    )
    extents = repeated_extents(contexts, length, most).select(
        F.col("bucket").alias("gram"), F.col("ctx").alias("around"), "back", "ahead"
    )
    # One context with several copies needs no suffix array: all of it is repeated.
    single = split.where("kinds = 1 AND copies > 1").select(
        "gram", "around", F.lit(length - GRAM).alias("back"), F.lit(length).alias("ahead")
    )
    spans = (
        places.join(extents.unionAll(single), ["gram", "around"])
        .select(
            "row_id",
            "text_key",
            (F.col("place") - F.col("back")).cast("int").alias("start"),
            (F.col("place") + F.col("ahead")).cast("int").alias("end"),
        )
        .distinct()  # rows that repeat with their id bring each span once
        .groupBy("row_id", "text_key")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    joined = bodies.select(*others, row_id, key, body).join(
        spans.select(F.col("row_id").alias(row_id), F.col("text_key").alias(key), F.col("spans").alias(found)),
        [row_id, key],
        "left",
    )
    verdict = {}
    if words is not None:
        verdict["shares_passage"] = BooleanType()
        # Keyed like the spans, so the texts are not dealt out once more.
        sharing = plain.select("row_id", "text_key").join(
            _sharing_texts(plain, words), "text_key", "left_semi"
        )
        joined = joined.join(
            sharing.distinct().select(
                F.col("row_id").alias(row_id), F.col("text_key").alias(key), F.lit(True).alias(shares)
            ),
            [row_id, key],
            "left",
        ).withColumn(shares, F.coalesce(shares, F.lit(False)))
    names = [*others, *verdict, "n_bytes", "removed", "kept"]
    run_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, runs, kept = [], [], []
            for data, places in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True
            ):
                gone = covered(len(data), [(s["start"], s["end"]) for s in places or ()])
                edges = [0, *(e for run in gone for e in run), len(data)]
                sizes.append(len(data))
                runs.append([{"start": a, "end": b} for a, b in gone])
                kept.append(
                    b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[2:],
                    pa.array(sizes, pa.int64()),
                    pa.array(runs, run_type),
                    pa.array(kept, pa.binary()),
                ],
                names,
            )

    run = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = with_fields(
        docs, others, **verdict, n_bytes=LongType(), removed=ArrayType(run), kept=BinaryType()
    )
    passed = [*others, shares] if verdict else others
    return joined.select(body, found, *passed).mapInArrow(cut, schema)
