"""Hard negatives by an inverted multi-index, with windows certified by the bounds of its cells."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellhours.sources.scratch import materialise

ROWS_PER_TASK = 4096  # indexed rows of a group, and questions that meet them there
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the two halves of a vector; cell (i, j) holds the rows nearest to both words.

    `radii` are the greatest distances of any row's half from its codeword, `sizes` the rows of
    each cell.
    """

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray

    def bounds(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each codeword of each half, what no row there can exceed in its half score."""
        out, at = [], 0
        for words, radii in zip(self.words, self.radii, strict=True):
            half = vector[at : at + words.shape[1]]
            at += words.shape[1]
            length = np.linalg.norm(half)
            slack = 1e-9 * (length * (np.linalg.norm(words, axis=1) + radii) + 1.0)
            out.append(words @ half + length * radii + slack)
        return out[0], out[1]


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All (first[i] + second[j], i, j), greatest sum first.

    The heap holds one cell for each i that was reached: its next j.
    """
    if not len(first) or not len(second):
        return
    by_first, by_second = (np.argsort(-x, kind="stable").tolist() for x in (first, second))
    u, v = first[by_first].tolist(), second[by_second].tolist()
    heap = [(-(u[0] + v[0]), 0, 0)]
    while heap:
        bound, a, b = heapq.heappop(heap)
        yield -bound, by_first[a], by_second[b]
        if b + 1 < len(v):
            heapq.heappush(heap, (-(u[a] + v[b + 1]), a, b + 1))
        if b == 0 and a + 1 < len(u):
            heapq.heappush(heap, (-(u[a + 1] + v[0]), a + 1, 0))


def cells_to_visit(
    index: MultiIndex, vector: np.ndarray, lowest: float, first_rows: int, threshold: float | None
) -> dict[int, list[int]]:
    """Cells {i: [j, ...]} of one round of a search for the best rows of at least `lowest`.

    The first round takes the best cells until they hold `first_rows` rows. The second, with the
    `threshold` that its finds have set, takes all others whose bound reaches it: what is in the
    rest scores less, so the window is certified.
    """
    out: dict[int, list[int]] = {}
    seen = 0
    for bound, i, j in multi_sequence(*index.bounds(vector)):
        if bound < (lowest if threshold is None else threshold):
            break
        size = int(index.sizes[i, j])
        if not size:
            continue
        opening = seen < first_rows
        seen += size
        if opening == (threshold is None):
            out.setdefault(i, []).append(j)
        elif threshold is None:
            break
    return out


def nearest_word(halves: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The codeword at the least distance from each row."""
    out = np.empty(len(halves), np.int64)
    own = (words * words).sum(axis=1)
    for at in range(0, len(halves), 4096):
        out[at : at + 4096] = np.argmin(own - 2.0 * (halves[at : at + 4096] @ words.T), axis=1)
    return out


def train_codebook(halves: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means from evenly spaced rows of the sample; a word without rows stays."""
    words = halves[np.linspace(0, len(halves) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        near = nearest_word(halves, words)
        sums = np.zeros_like(words)
        np.add.at(sums, near, halves)
        count = np.bincount(near, minlength=size)
        words[count > 0] = sums[count > 0] / count[count > 0, None]
    return words


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of an array<bigint> column as a matrix of doubles or, beyond 2**53, of integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy().reshape(len(column), width)
    safe = not flat.size or max(int(flat.max()), -int(flat.min())) < 1 << 53
    return flat.astype(np.float64) if safe else flat.astype(object)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles where these are exact."""
    width = left.shape[1]
    if left.dtype != object and right.dtype != object and left.size and right.size:
        if np.abs(left).max() * np.abs(right).max() * max(1, width) < 2.0**53:
            return left @ right.T
    return (_whole(left) @ _whole(right).T if width else np.zeros((len(left), len(right)))).astype(
        object
    )


def _whole(rows: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)


def build_index(
    points: DataFrame, width: int, rows_per_cell: int, most_words: int, most_sampled: int
) -> tuple[MultiIndex, DataFrame]:
    """The index of `points` (vec_id, label, v), and the points with their cell (i, j)."""
    total = points.count()
    words = 1 << max(0, round(math.log2(max(1.0, math.sqrt(total / rows_per_cell)))))
    words = min(words, most_words)
    share = math.ceil(min(1.0, most_sampled / max(1, total)) * 1_000_000)
    draw = F.pmod(F.xxhash64("vec_id", F.lit("codebook")), F.lit(1_000_000))
    sample = points.where(draw < share).orderBy(F.xxhash64("vec_id"), "vec_id").select("v")
    sampled = np.array([r.v for r in sample.collect()], np.float64).reshape(-1, width)
    half = (width + 1) // 2
    parts = (sampled[:, :half], sampled[:, half:])
    if not len(sampled):  # a small table of which the draw took nothing
        books = (np.zeros((1, half)), np.zeros((1, width - half)))
    else:
        books = tuple(train_codebook(p, min(words, len(p))) for p in parts)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = _matrix(part.column(2), width).astype(np.float64)
            cells, away = [], []
            for side, book in zip((rows[:, :half], rows[:, half:]), books, strict=True):
                near = nearest_word(side, book)
                cells.append(near)
                away.append(np.linalg.norm(side - book[near], axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns,
                    *(pa.array(c, pa.int32()) for c in cells),
                    *(pa.array(a, pa.float64()) for a in away),
                ],
                ["vec_id", "label", "v", "i", "j", "away_i", "away_j"],
            )

    placed = materialise(
        points.select("vec_id", "label", "v").mapInArrow(
            assign,
            "vec_id bigint, label int, v array<bigint>, i int, j int, away_i double, away_j double",
        ),
        "mine-placed",
    )
    shape = (len(books[0]), len(books[1]))
    radii = tuple(np.zeros(n) for n in shape)
    sizes = np.zeros(shape, np.int64)
    cells = placed.groupBy("i", "j").agg(
        F.count(F.lit(1)).alias("n"), F.max("away_i").alias("di"), F.max("away_j").alias("dj")
    )
    for cell in cells.collect():  # most_words ** 2 rows at most
        sizes[cell.i, cell.j] = cell.n
        radii[0][cell.i] = max(radii[0][cell.i], cell.di)
        radii[1][cell.j] = max(radii[1][cell.j], cell.dj)
    return MultiIndex(books, radii, sizes), placed.drop("away_i", "away_j")


ASK = "ask bigint, hi bigint, lo bigint, label int, v array<bigint>"


def _plan_visits(
    index: MultiIndex, asks: DataFrame, width: int, first_rows: int, second: bool
) -> DataFrame:
    """A row per question and codeword i of the first half, with the cells j to visit there.

    `asks` has the columns of ASK and, in the second round, the `threshold` of the first.
    """
    fields = [f.split(" ")[0] for f in ASK.split(", ")]
    names = [*fields, "i", "wanted"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = _matrix(part.column(4), width).astype(np.float64)
            lows = part.column(2).to_pylist()
            marks = part.column(5).to_pylist() if second else [None] * len(lows)
            at, codes, wanted = [], [], []
            for n, (vector, low, mark) in enumerate(zip(rows, lows, marks, strict=True)):
                for i, cells in cells_to_visit(index, vector, low, first_rows, mark).items():
                    at.append(n)
                    codes.append(i)
                    wanted.append(cells)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(k).take(taken) for k in range(len(fields))),
                    pa.array(codes, pa.int32()),
                    pa.array(wanted, pa.list_(pa.int32())),
                ],
                names,
            )

    columns = [*fields, *(["threshold"] if second else [])]
    return asks.select(*columns).mapInArrow(batches, f"{ASK}, i int, wanted array<int>")


def _first_rows(
    ask: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int
) -> np.ndarray:
    """Positions of the first k rows of each question, by score and then id."""
    order = np.lexsort((vec_id, -score, ask))
    sorted_ask = ask[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_ask[1:] != sorted_ask[:-1])))
    nth = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
    return order[nth < k]


def _score_visits(
    index: MultiIndex, placed: DataFrame, visits: DataFrame, width: int, k: int, same: bool
) -> DataFrame:
    """(ask, hi, vec_id, score): the first k rows that each question meets in each block.

    The rows of a codeword, and the questions that visit it, are cut into blocks; each pair of
    blocks is a group of its own, so that no group grows with the table or with a codeword.
    """
    blocks = [-(-int(n) // ROWS_PER_TASK) or 1 for n in index.sizes.sum(axis=1)]
    asked = dict(visits.groupBy("i").count().collect())  # one row per codeword
    turns = [-(-asked.get(i, 0) // ROWS_PER_TASK) or 1 for i in range(len(blocks))]
    n_blocks = f"element_at(array({', '.join(map(str, blocks))}), i + 1)"
    n_turns = f"element_at(array({', '.join(map(str, turns))}), i + 1)"
    visited = F.array(*[F.lit(i) for i in sorted(asked)]) if asked else F.array().cast("array<int>")
    rows = placed.where(F.array_contains(visited, F.col("i"))).selectExpr(
        "i", "j", "vec_id", "label", "v",
        f"CAST(pmod(xxhash64(vec_id), {n_blocks}) AS int) AS block",
        f"explode(sequence(0, {n_turns} - 1)) AS turn",
    )
    asks = visits.selectExpr(
        "i", "ask", "hi", "lo", "label", "v", "wanted",
        f"explode(sequence(0, {n_blocks} - 1)) AS block",
        f"CAST(pmod(xxhash64(ask, hi), {n_turns}) AS int) AS turn",
    )
    schema = "ask bigint, hi bigint, vec_id bigint, score bigint"
    kinds = [pa.int64()] * 4

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by([("j", "ascending"), ("vec_id", "ascending")])
            base = _matrix(left["v"], width)
            ids, labels, codes = (left[n].to_numpy() for n in ("vec_id", "label", "j"))
            # Questions about one vector share its scores.
            ask_rows = _matrix(right["v"], width)
            _, vector_of = np.unique(right["ask"].to_numpy(), return_inverse=True)
            leads = np.zeros(vector_of.max() + 1, np.int64)
            leads[vector_of] = np.arange(len(vector_of))
            low, high = (right[n].to_numpy() for n in ("lo", "hi"))
            mine = right["label"].to_numpy()
            wanted = right["wanted"].combine_chunks()
            want_cell = wanted.flatten().to_numpy()
            want_ask = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
            edges = np.flatnonzero(np.diff(codes, prepend=-1, append=-2))
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                who = want_ask[want_cell == codes[start]]
                if not len(who):
                    continue
                vectors, of = np.unique(vector_of[who], return_inverse=True)
                score = _scores(ask_rows[leads[vectors]], base[start:end])[of]
                fits = (mine[who][:, None] == labels[None, start:end]) == same
                fits &= (score >= low[who][:, None]) & (score <= high[who][:, None])
                at, col = np.nonzero(fits)
                value, row = score[at, col], col + start
                best = _first_rows(who[at], value, ids[row], k)
                out[0].append(who[at][best])
                out[1].append(row[best])
                out[2].append(value[best])
        if not sum(map(len, out[0])):
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], schema=_arrow(schema))
        who, row, value = (np.concatenate(x) for x in out)
        best = _first_rows(who, value, ids[row], k)
        who, row, value = who[best], row[best], value[best]
        columns = [
            right["ask"].to_numpy()[who], right["hi"].to_numpy()[who], ids[row],
            np.array([int(x) for x in value], np.int64),
        ]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_arrow(schema))

    keys = ["i", "block", "turn"]
    return rows.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(compare, schema)


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(f.split(" ")[0], pa.int64()) for f in schema.split(", ")])


def first_in_windows(
    index: MultiIndex, placed: DataFrame, asks: DataFrame, width: int, k: int, same: bool,
    first_rows: int = 2048,
) -> DataFrame:
    """(ask, hi, vec_id, score, rank): of each question the first k rows of its window.

    `asks` has the columns of ASK: rows of the same (or, without `same`, another) label with a
    score from `lo` to `hi` are wanted, best first and ties by id. Exact: a first round visits
    the cells of the greatest bounds; its k-th find is the threshold to which a second round
    visits all other cells. A question with fewer finds is searched to the end of its window.
    """
    by_rank = Window.partitionBy("ask", "hi").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)

    opening = materialise(_plan_visits(index, asks, width, first_rows, False), "mine-first-visits")
    first = best(_score_visits(index, placed, opening, width, k, same))
    first = materialise(first, "mine-first")
    marks = (
        first.where(F.col("rank") == k)
        .select(F.col("ask").alias("a"), F.col("hi").alias("h"), F.col("score").alias("mark"))
    )
    marked = asks.join(
        marks, (F.col("ask") == F.col("a")) & (F.col("hi") == F.col("h")), "left"
    ).withColumn("threshold", F.coalesce("mark", "lo"))
    rest = materialise(_plan_visits(index, marked, width, first_rows, True), "mine-rest-visits")
    second = _score_visits(index, placed, rest, width, k, same)
    return best(first.drop("rank").unionByName(second))


def mine_hard_negatives(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    rows_per_cell: int = 512,
    most_words: int = 1024,
    most_sampled: int = 16_384,
) -> DataFrame:
    """Hard negatives of every anchor (id divisible by `every`) and each of its positives.

    `vector` is array<bigint>, a score the integer inner product with the anchor. Positives are
    the first other rows of the anchor's label, negatives of a positive the first rows of another
    label with window[0] * positive score <= window[1] * score <= window[1] * positive score;
    greater scores first, ties by id. Returns anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score. Scores are exact as long as they fit 64 bits.

    The search is exact whatever the index is like; only its codebooks are trained on a sample of
    about `most_sampled` rows, of at most `most_words` words for a half. Rows with one vector and
    label are indexed up to the number that any window can take of them, the least ids, and
    anchors with one vector and label ask once, so that copies cost no more than other rows.

    No part is taken by rows with a NULL id, label or vector, a NULL component, or a vector of
    another length than most. Of several rows with one id the one with the least label and vector
    counts. Other columns are not read. A negative positive score has an empty window.
    """
    usable = rows.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("int").alias("label"),
        F.col(vector).cast("array<bigint>").alias("v"),
    ).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL)"
    )
    usual = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = usual.n if usual else 1
    one = Window.partitionBy("vec_id").orderBy("label", "v")
    usable = materialise(
        usable.where(F.size("v") == width)
        .withColumn("nth", F.row_number().over(one))
        .where("nth = 1")
        .drop("nth"),
        "mine-rows",
    )
    most = max(positives + 1, negatives)
    copies = Window.partitionBy("label", "v").orderBy("vec_id")
    points = (
        usable.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= most).drop("nth")
    )
    points = materialise(points, "mine-points")
    index, placed = build_index(points, width, rows_per_cell, most_words, most_sampled)
    anchors = usable.where(F.pmod("vec_id", F.lit(every)) == 0)
    classes = materialise(
        anchors.groupBy("label", "v").agg(F.min("vec_id").alias("ask")), "mine-classes"
    )
    members = anchors.join(classes, ["label", "v"]).select("ask", F.col("vec_id").alias("anchor_id"))
    members = materialise(members, "mine-members")
    wide = classes.selectExpr("ask", f"{HIGHEST} AS hi", f"{LOWEST + 1} - 1 AS lo", "label", "v")
    near = first_in_windows(index, placed, wide, width, positives + 1, True)
    of_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = (
        near.select("ask", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        .join(members, "ask")
        .where("positive_id <> anchor_id")
        .withColumn("nth", F.row_number().over(of_anchor))
        .where(F.col("nth") <= positives)
    )
    chosen = materialise(chosen.drop("nth"), "mine-positives")
    edge = f"CAST(ceil(CAST(hi AS decimal(20,0)) * {window[0]} / {window[1]}) AS bigint) AS lo"
    scores = chosen.where("positive_score >= 0").select("ask", F.col("positive_score").alias("hi"))
    narrow = (
        scores.distinct().join(classes, "ask").selectExpr("ask", "hi", edge, "label", "v")
    )
    narrow = materialise(narrow, "mine-windows")
    hard = first_in_windows(index, placed, narrow, width, negatives, False)
    return (
        chosen.join(hard.withColumnRenamed("hi", "positive_score"), ["ask", "positive_score"])
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )
