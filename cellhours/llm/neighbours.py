"""Approximate nearest neighbours over learned partitions of a neighbour graph."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellhours.sources.scratch import materialise

BLOCK = 4096  # rows of either side that a task compares at a time
BRANCH = 64  # partitions that one router tells apart at most
ROUTED = 65_536  # rows that a task sends through a router at a time


@dataclass(frozen=True)
class Router:
    """Softmax classifier from a unit vector to the partitions, and how many to search."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def order(self, units: np.ndarray) -> np.ndarray:
        """Partitions of each row, most probable first."""
        return np.argsort(-(units @ self.weights + self.bias), axis=1, kind="stable")


def parts_of(points: float) -> int:
    """A power of two of partitions with some 256 points each, as far as one router goes."""
    return min(BRANCH, max(4, 1 << int(math.log2(max(1, points / 256)))))


def nearest(units: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest of `others` for each row, unordered, in blocks."""
    k = min(k, len(others))
    out = np.empty((len(units), k), np.int64)
    for at in range(0, len(units), 1024):
        score = units[at : at + 1024] @ others.T
        out[at : at + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which is exact, with a greatest number from 0.5 to 1."""
    _, exponent = np.frexp(np.abs(rows).max(axis=1))
    return np.ldexp(rows, -exponent[:, None])


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row pair, term by term: equal pairs of vectors get equal results.

    One root of the product of both squares: parallel vectors of whole numbers get 1 exactly.
    """
    squares = (x * x).sum(axis=1) * (y * y).sum(axis=1)
    return (x * y).sum(axis=1) / np.sqrt(squares)


def best_rows(
    x: np.ndarray, y: np.ndarray, ids: np.ndarray, starts: np.ndarray, count: np.ndarray,
    asked: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, cosine): for each row of `y` the k first of the rows that `x` stands for.

    Point i of `x` has the ids[starts[i] : starts[i] + count[i]]. Whatever comes near the k-th
    greatest product (one more: the query's own point) is compared exactly, ties and all.
    """
    unit_x, unit_y = (z / np.sqrt((z * z).sum(axis=1))[:, None] for z in (x, y))
    score = unit_y @ unit_x.T
    take = min(k + 1, score.shape[1])
    kth = np.partition(score, score.shape[1] - take, axis=1)[:, score.shape[1] - take]
    at, point = np.nonzero(score >= kth[:, None] - 1e-9)
    exact = np.empty(len(at))
    for s in range(0, len(at), 1 << 16):  # a few megabytes at a time, however many tie
        some = slice(s, s + (1 << 16))
        exact[some] = exact_cosine(x[point[some]], y[at[some]])
    times = count[point]
    query = np.repeat(at, times)
    inside = np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times)
    row = ids[np.repeat(starts[point], times) + inside]
    value = np.repeat(exact, times)
    other = row != asked[query]
    query, row, value = query[other], row[other], value[other]
    order = np.lexsort((row, -value, query))
    query, row, value = query[order], row[order], value[order]
    nth = np.arange(len(query)) - np.searchsorted(query, query)
    first = nth < k
    return asked[query[first]], row[first], value[first]


def balanced_partition(
    units: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.05
) -> np.ndarray:
    """Cut a neighbour graph into `parts` (a power of two) parts of about equal size.

    Starts from halves along the main direction of each part, then moves nodes to the part where
    most of their neighbours are while that has room, so that few edges are cut.
    """
    label = np.zeros(len(units), np.int64)
    for _ in range(int(math.log2(parts))):
        split = np.zeros(len(units), np.int64)
        for p in np.unique(label):
            rows = np.flatnonzero(label == p)
            centred = units[rows] - units[rows].mean(axis=0)
            _, axes = np.linalg.eigh(centred.T @ centred)
            ranks = np.argsort(np.argsort(centred @ axes[:, -1], kind="stable"))
            split[rows] = ranks * 2 >= len(rows)
        label = 2 * label + split
    edges: list[list[int]] = [[] for _ in range(len(units))]
    for i, found in enumerate(graph.tolist()):
        for j in found:
            if j != i:
                edges[i].append(j)
                edges[j].append(i)
    room = math.ceil(slack * len(units) / parts)
    sizes = np.bincount(label, minlength=parts).tolist()
    labels = label.tolist()
    for _ in range(rounds):
        moved = 0
        for i, mine in enumerate(edges):
            here = labels[i]
            near = [0] * parts
            for j in mine:
                near[labels[j]] += 1
            best = max(range(parts), key=lambda p: (near[p], p == here))
            if best != here and near[best] > near[here] and sizes[best] < room:
                sizes[here] -= 1
                sizes[best] += 1
                labels[i] = best
                moved += 1
        if not moved:
            break
    return np.asarray(labels)


def train_softmax(
    units: np.ndarray, label: np.ndarray, parts: int, rounds: int = 300
) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by full-batch gradient steps with momentum."""
    weights = np.zeros((units.shape[1], parts))
    bias = np.zeros(parts)
    speed_w, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    truth = np.eye(parts)[label]
    for _ in range(rounds):
        score = units @ weights + bias
        score -= score.max(axis=1, keepdims=True)
        chance = np.exp(score)
        chance /= chance.sum(axis=1, keepdims=True)
        miss = (chance - truth) / len(units)
        speed_w = 0.9 * speed_w - 4.0 * (units.T @ miss + 1e-5 * weights)
        speed_b = 0.9 * speed_b - 4.0 * miss.sum(axis=0)
        weights, bias = weights + speed_w, bias + speed_b
    return weights, bias


def fit_router(sample: np.ndarray, parts: int, k: int, recall: float) -> Router:
    """Learn the partitions from sampled unit vectors and choose the number of probes.

    The graph and classifier see three quarters of the sample. The other quarter, as queries
    against all of it, tells how many partitions it takes to find `recall` of the true nearest.
    """
    cut = max(1, len(sample) * 3 // 4)
    train = sample[:cut]
    graph = nearest(train, train, min(12, len(train)))
    label = balanced_partition(train, graph, parts)
    weights, bias = train_softmax(train, label, parts)
    trial = Router(weights, bias, parts)
    held = np.arange(cut, len(sample))[:1024]
    if len(held) < 50:
        return trial  # too few to tell: search all partitions
    home = trial.order(sample)[:, 0]
    score = sample[held] @ sample.T
    score[np.arange(len(held)), held] = -2.0
    true = np.argpartition(-score, k, axis=1)[:, :k]
    place = np.argsort(trial.order(sample[held]), axis=1)
    needed = np.take_along_axis(place, home[true], axis=1).ravel()
    share = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    return Router(weights, bias, int(np.searchsorted(share, recall)) + 1)


def nearest_neighbours(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    most_sampled: int = 8192,
    recall: float = 0.965,
    partitions: int | None = None,
    most_rows: int = 16_384,
) -> DataFrame:
    """The k nearest rows by cosine of each row whose id is divisible by `every`.

    Returns query_id, rank (from 1), vec_id, score. All rows are indexed; only the router is
    fitted on a sample of at most about `most_sampled` distinct vectors, taken by hash. Where the
    partitions would hold more than `most_rows` points, each such one is cut again, by a router of
    its own that is fitted on a sample of it, level by level: the points that a query meets stay in
    proportion to what it probes and not to the table. `recall` is what all levels together aim at.
    Equal vectors are one point of the index, so a vector with very many copies costs as much as any
    other, and of each point the k + 1 smallest ids are candidates. Ties go to the smaller id,
    also between parallel vectors, of which no number is left out. A query whose partitions hold
    fewer than k candidates goes on to all others.

    Takes no part: a row whose vector is NULL, zero, holds a NULL or a non-finite number or has
    another length than most, and a row with a NULL id. Repeated rows count once; if an id has
    several vectors, all are candidates and the one with the least hash asks. Other columns are
    not read. With fewer than k candidates all are returned.
    """
    usable = (
        f"`{vec_id}` IS NOT NULL AND `{embedding}` IS NOT NULL AND size(`{embedding}`) > 0"
        f" AND forall(`{embedding}`, x -> x IS NOT NULL AND NOT isnan(x)"
        f" AND abs(x) < double('infinity')) AND exists(`{embedding}`, x -> x <> 0)"
    )
    rows = vectors.where(usable).select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("v"),
    )
    width = (
        rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    )
    rows = rows.where(F.size("v") == (width.width if width else 0)).withColumn(
        "point", F.xxhash64("v")
    )
    by_id = Window.partitionBy("point").orderBy("vec_id")
    points = (
        rows.distinct()
        .withColumn("nth", F.row_number().over(by_id))
        .where(F.col("nth") <= k + 1)  # of equal vectors no more can be among the k nearest
        .groupBy("point")
        .agg(F.any_value("v").alias("v"), F.collect_list("vec_id").alias("ids"))
    )
    points = materialise(points, "ann-points")
    total = points.count()
    parts = partitions or parts_of(total)
    levels, size = 0, total / parts  # levels beyond the first
    while size > most_rows:
        levels, size = levels + 1, size / parts_of(size)
    aim = recall ** (1 / (levels + 1))
    share = min(1.0, most_sampled / max(1, total))
    sampled = points.where(
        F.pmod(F.xxhash64("point", F.lit("sample")), F.lit(1_000_000)) < math.ceil(share * 1_000_000)
    )
    sample = np.array([r.v for r in sampled.select("point", "v").orderBy("point").collect()], float)
    if not len(sample):
        return rows.sparkSession.createDataFrame(
            [], "query_id bigint, rank int, vec_id bigint, score double"
        )
    units = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    router = fit_router(units, parts, k, aim)

    def route(probes: int):  # noqa: ANN202
        @F.pandas_udf("array<int>")
        def routed(v: pd.Series) -> pd.Series:
            x = np.stack([np.asarray(one, float) for one in v])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            return pd.Series(list(router.order(x)[:, :probes].astype(np.int32)))

        return routed("v")

    base = materialise(
        points.select("point", "v", "ids", route(1)[0].cast("bigint").alias("part")), "ann-base"
    )
    askers = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    askers = askers.groupBy("vec_id").agg(F.min("point").alias("point")).join(points, "point")
    askers = materialise(
        askers.select(F.col("vec_id").alias("query_id"), "v", route(parts).alias("order")),
        "ann-askers",
    )

    probed = F.explode(F.slice("order", 1, router.probes).cast("array<bigint>")).alias("part")
    asked = materialise(askers.select("query_id", "v", probed), "ann-asked")
    for _ in range(levels):
        base, asked = _split(base, asked, k, aim, most_rows, most_sampled)
    found = materialise(_search(base, asked, k), "ann-found")
    ids = points.select(F.explode("ids").alias("id")).distinct().limit(k + 1).count()
    if router.probes < parts or levels:
        # Questions whose partitions hold too few candidates go on to all others.
        enough = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n"))
        enough = enough.where(F.col("n") >= min(k, ids - 1))
        short = materialise(askers.join(enough, "query_id", "left_anti"), "ann-short")
        if not short.isEmpty():
            leaves = base.select("part", F.expr(f"part div {BRANCH**levels}").alias("top"))
            top = F.explode(F.col("order").cast("array<bigint>")).alias("top")
            rest = short.select("query_id", "v", top).join(leaves.distinct(), "top").drop("top")
            rest = rest.join(asked.select("query_id", "part"), ["query_id", "part"], "left_anti")
            found = found.unionByName(_search(base, materialise(rest, "ann-rest"), k))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _units(v: pd.Series) -> np.ndarray:
    rows = scaled(np.stack(v.to_list()).astype(float))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _split(
    base: DataFrame, asked: DataFrame, k: int, recall: float, most_rows: int, most_sampled: int
) -> tuple[DataFrame, DataFrame]:
    """One more level: partition p becomes BRANCH * p, or from there on one of its own partitions.

    A partition of more than `most_rows` points has a router fitted in a task of its own, on about
    `most_sampled` of its points at most. Points and questions go through it in blocks, so that
    no task holds a whole partition.
    """
    sizes = base.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_rows)
    sizes = materialise(sizes, "ann-large")
    near_share = f"pmod(xxhash64(point, 'sample'), 1000000) < ceil({most_sampled} * 1e6D / n)"
    sample = base.join(sizes, "part").where(near_share).select("part", "n", "point", "v")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("point")
        part, n = int(rows["part"].iloc[0]), int(rows["n"].iloc[0])
        router = fit_router(_units(rows["v"]), parts_of(n), k, recall)
        blocks = -(-n // ROUTED)
        return pd.DataFrame(
            [(part, blocks, router.weights.tobytes(), router.bias.tobytes(), router.probes)],
            columns=["part", "blocks", "weights", "bias", "probes"],
        )

    routers = sample.groupBy("part").applyInPandas(
        fit, "part bigint, blocks int, weights binary, bias binary, probes int"
    )
    routers = materialise(routers, "ann-routers")
    copies = routers.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))

    def descend(rows: DataFrame, spread: str, probes: int | None) -> DataFrame:
        """Each row in the partitions below its own: the `probes` most probable, None: the router's."""
        columns = rows.columns

        def send(some: pd.DataFrame, by: pd.DataFrame) -> pd.DataFrame:
            if some.empty:
                return some[columns]
            units, r = _units(some["v"]), by.iloc[0]
            weights = np.frombuffer(r["weights"]).reshape(units.shape[1], -1)
            router = Router(weights, np.frombuffer(r["bias"]), int(r["probes"]))
            below = router.order(units)[:, : probes or router.probes]
            out = some[columns].iloc[np.repeat(np.arange(len(some)), below.shape[1])]
            return out.assign(part=out["part"] * BRANCH + below.ravel())

        key = ["part", "block"]
        large = rows.join(routers.select("part", "blocks"), "part").withColumn(
            "block", F.expr(f"cast(pmod(xxhash64({spread}), blocks) AS int)")
        )
        sent = (
            large.select(*columns, "block")
            .groupBy(*key)
            .cogroup(copies.select(*key, "weights", "bias", "probes").groupBy(*key))
            .applyInPandas(send, rows.schema)
        )
        same = rows.join(routers, "part", "left_anti")
        same = same.withColumn("part", F.col("part") * F.lit(BRANCH)).select(*columns)
        return sent.unionByName(same)

    return (
        materialise(descend(base, "point", 1), "ann-base"),
        materialise(descend(asked, "query_id", None), "ann-asked"),
    )


def _search(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best rows of each block that a query meets, not itself.

    The rows of a partition, and the queries sent to it, are cut into blocks of about BLOCK, and
    every pair of blocks is one group: no partition is ever in one task as a whole.
    """

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("part").agg(F.expr(f"cast(ceil(count(1) / {BLOCK}) AS int) AS {name}"))

    sizes = materialise(blocks(base, "rows_in").join(blocks(asked, "queries_in"), "part"), "ann-sizes")
    left = base.join(sizes, "part").selectExpr(
        "*",
        "cast(pmod(xxhash64(point), rows_in) AS int) AS block",
        "explode(sequence(0, queries_in - 1)) AS turn",
    ).withColumnRenamed("v", "w")
    right = asked.join(sizes, "part").selectExpr(
        "*",
        "cast(pmod(xxhash64(query_id), queries_in) AS int) AS turn",
        "explode(sequence(0, rows_in - 1)) AS block",
    )

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if a.empty or b.empty:
            return pd.DataFrame(columns=columns).astype({"score": float})
        x, y = np.stack(a["w"].to_list()).astype(float), np.stack(b["v"].to_list()).astype(float)
        x, y = scaled(x), scaled(y)
        count = a["ids"].map(len).to_numpy()
        ids, starts = np.concatenate(a["ids"].to_list()), np.cumsum(count) - count
        asked = b["query_id"].to_numpy()
        best = [
            best_rows(x, y[at : at + 256], ids, starts, count, asked[at : at + 256], k)
            for at in range(0, len(y), 256)
        ]
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*best)), strict=True)))

    keys = ["part", "block", "turn"]
    found = (
        left.select(*keys, "ids", "w")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "query_id", "v").groupBy(*keys))
        .applyInPandas(compare, "query_id bigint, vec_id bigint, score double")
    )
    return found
