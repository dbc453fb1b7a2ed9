"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cellhours.llm.common import connected_components, fresh_name, with_fields
from cellhours.sources.scratch import materialise

BITS = 64
BLOCK_MEMBERS = 65_536  # members of a bucket that a task compares at a time
MOST_OUTER = 32_768  # comparing more takes longer than naming the balls


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 values (seed 42) of all word shingles, as a signed integer."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII space characters
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :].tolist() or [len(flat)]
    hashed = xxhash.xxh64_intdigest
    values = np.fromiter(
        (hashed(flat[s:e], 42) for s, e in zip(starts.tolist(), last, strict=False)),
        np.uint64,
        len(last),
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str, out: str, shingle: int) -> DataFrame:
    """`docs` without `text`, with the fingerprint of the whole text as BIGINT column `out`."""
    others = [c for c in docs.columns if c != text]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(0).cast(pa.binary()).to_pylist()
            marks = pa.array([fingerprint(t or b"", shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[1:], marks], [*others, out])

    schema = with_fields(docs, others, **{out: LongType()})
    return docs.select(text, *others).mapInArrow(batches, schema)


def variants(max_distance: int) -> list[tuple[int, int, int]]:
    """(wildcard bit, mask of its segment without it, lowest bit of the segment).

    With max_distance // 2 + 1 segments, two fingerprints within the distance have a segment that
    differs in one bit at most, so some one-wildcard variant of it is equal in both.
    """
    cuts = max_distance // 2 + 1
    edges = [round(i * BITS / cuts) for i in range(cuts + 1)]
    out = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        mask = ((1 << (high - low)) - 1) << low
        out += [(bit, mask & ~(1 << bit), low) for bit in range(low, high)]
    return out


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def link_fingerprints(
    marks: DataFrame, max_distance: int, most_outer: int = MOST_OUTER
) -> DataFrame:
    """(node, root) for the distinct BIGINT fingerprints `fp` that have a partner.

    Exact single linkage without listing all pairs of a dense group. Members of a bucket are
    those that share a variant. Two or three are compared with each other as they stand in their
    sums; the members of a larger bucket first with two of them, picked by hash. After the
    components of these links only pairs from different components can still matter: of a
    bucket that holds several, the members outside its main component (the outer ones) meet all,
    in blocks, and of what they find only a forest of the components is kept. A large group of
    near copies is one component by then, so it meets nobody. Where more than `most_outer` are
    outer (a large group whose members are far from each other), see `_ball_links`: its work grows
    with the members and not with their pairs.
    """
    def rule(bit: int, mask: int, low: int) -> Column:
        return F.struct(
            F.lit(bit).alias("bit"), F.lit(_signed(mask)).cast("bigint").alias("mask"),
            F.lit(low).alias("low"),
        )

    # A variant whose wildcard bit is the same in all its members only repeats the bucket of the
    # whole segment, so that one is kept instead of its variants.
    whole = {(low, mask | 1 << bit) for bit, mask, low in variants(max_distance)}
    rules = [rule(*v) for v in variants(max_distance)]
    rules += [rule(BITS + low, mask, low) for low, mask in sorted(whole)]
    side = f"if(r.bit < {BITS}, 1 + (shiftrightunsigned(fp, r.bit) & 1), 3)"
    keyed = marks.select("fp", F.explode(F.array(*rules)).alias("r")).selectExpr(
        "xxhash64(r.bit, shiftrightunsigned(fp & r.mask, r.low)) AS key", f"{side} AS side", "fp"
    )
    buckets = (
        keyed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_or("side").alias("sides"),
            F.min("fp").alias("a"),
            F.max("fp").alias("c"),
            F.bit_xor("fp").alias("x"),
            F.min_by("fp", F.xxhash64("fp")).alias("p"),
            F.max_by("fp", F.xxhash64("fp")).alias("q"),
        )
        .where("n > 1 AND sides = 3")
        .drop("sides")
    )
    keyed = keyed.drop("side")
    buckets = materialise(buckets, "simhash-buckets")
    near = f"bit_count(%s ^ %s) <= {max_distance}"
    # Up to three members are known from their least, greatest and XOR.
    small = buckets.where("n <= 3").withColumn("b", F.expr("if(n = 2, a, x ^ a ^ c)"))
    pairs = [
        small.where(f"{u} <> {v} AND {near % (u, v)}").selectExpr(f"{u} AS u", f"{v} AS v")
        for u, v in ("ab", "bc", "ac")
    ]
    members = materialise(
        # A merge join: the planner takes the exploded side for 64 times smaller than it is, and
        # would broadcast it.
        keyed.hint("merge").join(buckets.where("n > 3").select("key", "p", "q"), "key"),
        "simhash-members",
    )
    pairs += [
        members.where(near % ("fp", chief)).selectExpr("fp AS u", f"{chief} AS v")
        for chief in ("p", "q")
    ]
    first = reduce(DataFrame.unionAll, pairs)
    labels = connected_components(first, "simhash-first")
    placed = materialise(
        members.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
            "key", "fp", F.expr("fp = p AS chief"), F.coalesce("root", "fp").alias("comp")
        ),
        "simhash-placed",
    )
    # The main component of a bucket is that of its first chief.
    mixed = (
        placed.groupBy("key", "comp")
        .agg(F.count(F.lit(1)).alias("n"), F.max("chief").alias("main"))
        .groupBy("key")
        .agg(
            F.max_by("comp", "main").alias("main"),
            F.max_by("n", "main").alias("in_main"),
            F.sum("n").alias("n"),
        )
        .where("in_main < n")
        .select("key", "main", "n", F.expr("n - in_main AS outer"))
    )
    crowds = materialise(placed.join(mixed, "key").drop("chief"), "simhash-crowds")
    loose = crowds.where(F.col("outer") > most_outer) if max_distance % 2 == 0 else None
    second = _block_links(
        crowds if loose is None else crowds.where(F.col("outer") <= most_outer), max_distance
    )
    if loose is not None and not loose.isEmpty():
        second = second.unionAll(_ball_links(loose, max_distance // 2))
    joined = connected_components(second, "simhash-second")
    whole = labels.join(
        joined.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left"
    ).select("node", F.coalesce("top", "root").alias("root"))
    # Nodes without a first link that were joined by the second step are their own component.
    alone = joined.join(labels, "node", "left_anti")
    alone = alone.select("node", "root")
    return whole.unionAll(alone)


def _block_links(crowds: DataFrame, max_distance: int) -> DataFrame:
    """(u, v): components that near pairs of an outer and any member of a bucket join.

    A bucket is cut into blocks of members, each of which all its outer members visit; a task
    takes the blocks one after the other as they lie sorted in its partition.
    """
    blocks = f"(n + {BLOCK_MEMBERS - 1}) div {BLOCK_MEMBERS}"
    rows = crowds.selectExpr(
        "key",
        f"explode(if(comp <> main, sequence(0L, {blocks} - 1), "
        f"array(pmod(xxhash64(fp), {blocks})))) AS block",
        "fp", "comp", "main",
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((5, 0), np.int64)
        for part in parts:
            kept = np.concatenate((kept, [c.to_numpy() for c in part.columns]), axis=1)
            new = np.any(kept[:2, 1:] != kept[:2, :-1], axis=0)
            edges = [0, *(np.flatnonzero(new) + 1).tolist()]
            # The last block may go on in the next batch.
            yield _pair_batch(
                [kept[2:, s:e] for s, e in zip(edges[:-1], edges[1:], strict=True)], max_distance
            )
            kept = kept[:, edges[-1] :]
        yield _pair_batch([kept[2:]], max_distance)

    return (
        rows.repartition("key", "block")
        .sortWithinPartitions("key", "block")
        .mapInArrow(batches, "u bigint, v bigint")
    )


def _pair_batch(blocks: list[np.ndarray], max_distance: int) -> pa.RecordBatch:
    links = [pair for block in blocks for pair in block_forest(*block, max_distance)]
    columns = [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["u", "v"])


def block_forest(
    fp: np.ndarray, comp: np.ndarray, main: np.ndarray, max_distance: int
) -> list[tuple[int, int]]:
    """Links that join the components which any near pair of an outer and any row connects."""
    marks = fp.view(np.uint64) if fp.flags.c_contiguous else np.ascontiguousarray(fp).view(np.uint64)
    outer = np.flatnonzero(comp != main)
    top: dict[int, int] = {}
    out = []

    def root(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = top.get(up, up)
            x = up
        return x

    step = max(1, (1 << 20) // max(1, len(fp)))
    for at in range(0, len(outer), step):
        some = outer[at : at + step]
        near = np.bitwise_count(marks[some][:, None] ^ marks) <= max_distance
        near &= comp[some][:, None] != comp
        left, right = np.nonzero(near)
        pairs = np.stack((comp[some][left], comp[right]))
        for u, v in np.unique(pairs, axis=1).T.tolist():
            a, b = root(u), root(v)
            if a != b:
                top[a] = b
                out.append((u, v))
    return out


def _ball_links(members: DataFrame, radius: int) -> DataFrame:
    """(u, v): components with members within twice the radius of each other.

    Two values differ in at most 2r bits just if some value is within r bits of both. So each
    member names all values within r bits of it (2081 for r = 2), and members that name one value
    are linked. At most as many members as a ball has points can name it.
    """
    masks = [
        _signed(sum(1 << bit for bit in bits))
        for size in range(radius + 1)
        for bits in combinations(range(BITS), size)
    ]
    flips = members.sparkSession.createDataFrame([(masks,)], "flips array<bigint>")
    points = (
        members.select("fp", "comp")
        .distinct()
        .join(F.broadcast(flips))  # one row, as long as the ball
        .select("comp", F.expr("explode(transform(flips, m -> fp ^ m))").alias("point"))
    )
    named = points.groupBy("point").agg(F.collect_set("comp").alias("comps"))
    return (
        named.where("size(comps) > 1")
        .select(F.array_min("comps").alias("u"), F.explode("comps").alias("v"))
        .where("u <> v")
        .distinct()
    )


def simhash_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    max_distance: int = 4,
    root: str | None = None,
) -> DataFrame:
    """Every row of `docs` without its text, plus `fingerprint` and `component_id`.

    `fingerprint` is the SimHash of the whole text as 16 hex digits, `component_id` the smallest
    id reachable over links of at most `max_distance` differing bits. A NULL or blank text has
    fingerprint zero and links like any other. Rows with a NULL id get a component as the rest,
    but no component is named after them (it is NULL if it has no other rows). Repeated rows
    share their fingerprint. `root` names a further BIGINT column, one of the component's
    fingerprints that is the same in all its rows: components can have the same id or none. Columns
    of the input called like the new ones are replaced.
    """
    new = {"fingerprint", "component_id", *([root.lower()] if root else [])}
    kept = [c for c in docs.columns if c.lower() not in new]
    mark = fresh_name(docs, "fp")
    marked = materialise(fingerprints(docs.select(*kept), text, mark, shingle), "simhash-marks")
    classes = materialise(
        marked.groupBy(F.col(mark).alias("fp")).agg(F.min(doc_id).alias("least_id")),
        "simhash-classes",
    )
    roots = materialise(link_fingerprints(classes.select("fp"), max_distance), "simhash-roots")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    tops = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_mark = named.join(tops, "root").select(F.col("fp").alias(mark), "root", "component_id")
    if root:
        kept.append(root)
        of_mark = of_mark.withColumnRenamed("root", root)
    else:
        of_mark = of_mark.drop("root")
    return marked.join(of_mark, mark).select(
        *[c for c in kept if c != text],
        F.lower(F.lpad(F.hex(mark), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_component(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    max_distance: int = 4,
) -> DataFrame:
    """One row of each component stays: the one with the least id, then the least text hash.

    Rows without an id come after the others. Of several rows with the same id and text one stays.
    The texts are not shuffled for the components: only ids, hashes and fingerprints are, and then
    the rows that stay are looked up by id and text hash.
    """
    ids = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key")
    )
    marked = simhash_components(ids, shingle=shingle, max_distance=max_distance, root="root")
    rank = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_key", "n")
    chosen = (
        marked.groupBy("root", "doc_id", "text_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root")
        .agg(F.min(rank).alias("one"))
    )
    chosen = materialise(chosen.select("one.doc_id", "one.text_key", "one.n"), "simhash-chosen")
    key, wanted_id, wanted_key = (fresh_name(docs, n) for n in ("text_key", "w_id", "w_key"))
    keyed = docs.withColumn(key, F.xxhash64(text))

    def rows_of(keys: DataFrame) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias(wanted_id), F.col("text_key").alias(wanted_key))
        same = F.col(doc_id).eqNullSafe(F.col(wanted_id)) & (F.col(key) == F.col(wanted_key))
        return keyed.join(keys, same, "left_semi")

    kept = rows_of(chosen.where("n = 1")).select(*docs.columns)
    several = chosen.where("n > 1")
    if not several.isEmpty():  # rows with one id and text: one of them stays
        row = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
        kept = kept.unionByName(rows_of(several).groupBy(doc_id, key).agg(row).select("row.*"))
    return kept
