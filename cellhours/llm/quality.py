"""Quality rules: counts of whole texts, and robust outliers per language and source.

Everything is DataFrame and SQL expressions. Statistics of a text are computed in its own row;
the estimates are grouped sums over all rows, so no group is ever in one place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.llm.arrays import let
from cellhours.llm.common import fresh_name
from cellhours.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_capitals", "n_marks", "n_lines"]
DIMS = 6


@dataclass(frozen=True)
class OutlierRules:
    """Limits of the outlier test.

    `shrink`: the estimate of a source in a language has the weight 1 - shrink / rows beside that
    of the language, and none below so many rows (six dimensions need them); likewise a language
    beside all texts. `core`: share of a group that the determinant is minimised over. `steps`:
    most concentration steps. `tail`: probability beyond the limit under a normal law. `floors`:
    spread that is added to each transformed statistic; it keeps a statistic that is constant in
    most texts (no symbols, no repeats) from rejecting the first text that has a little of it.
    """

    shrink: float = 30.0
    core: float = 0.75
    steps: int = 5
    tail: float = 1e-9
    floors: tuple[float, ...] = (0.06, 0.06, 0.06, 0.06, 0.12, 0.12)


def words_of(text: Column) -> Column:
    """The matches of WORD; splitting at SPACE is twice as fast as extracting them."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def repeated_words(words: Column) -> Column:
    """Words that lie in windows of WINDOW words which occur twice or more in the array."""

    def windows(h: Column) -> Column:
        return F.when(
            F.size(h) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    def neighbour(s: Column, k: Column, value: Column) -> Column:
        return F.coalesce(F.get(s, k)["w"] == value, F.lit(False))

    def marked(marks: Column) -> Column:
        ordered = F.sort_array(
            F.transform(marks, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        )
        hits = let(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: neighbour(s, k - 1, x["w"]) | neighbour(s, k + 1, x["w"]),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return F.aggregate(
            hits,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, at: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), at - a["last"])).alias("n"), at.alias("last")
            ),
            lambda a: a["n"],
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(
        let(hashed, windows),
        lambda marks: F.when(
            F.size(F.array_distinct(marks)) == F.size(marks), F.lit(0)
        ).otherwise(marked(marks)),
    ).cast("bigint")


def with_statistics(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with the BIGINT columns BASE and MORE and the BOOLEAN `base_failed`."""
    body, words, lines = (fresh_name(docs, n) for n in ("body", "words", "lines"))
    kept = [c for c in docs.columns if c.lower() not in {*BASE, *MORE, "base_failed"}]
    cut = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(body)).select(
        "*",
        words_of(F.col(body)).alias(words),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)).alias(lines),
    )
    return cut.select(
        *kept,
        F.size(words).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col(words)).alias("n_repeat_words"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.regexp_count(body, F.lit("[.,!?;:]")).cast("bigint").alias("n_marks"),
        F.size(lines).cast("bigint").alias("n_lines"),
    ).withColumn(
        "base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    )


#: Transformed statistics x0..x5. Rates take a few typical words along, so that short texts vary
#: no more than long ones; roots and logarithms even out their spread.
TRANSFORMS = [
    "ln(1 + 20D * n_symbols / (n_words + 20))",
    "ln((word_chars + 100D) / (n_words + 20))",
    "sqrt((n_capitals + 2D) / (word_chars + 100))",
    "sqrt((n_marks + 3D) / (n_words + 20))",
    "sqrt(n_repeat_words / (n_words + 20D))",
    "sqrt(n_dup_lines / (n_lines + 10D))",
]


def with_vector(stats: DataFrame) -> DataFrame:
    return stats.select("*", *[F.expr(t).alias(f"x{i}") for i, t in enumerate(TRANSFORMS)])


def _chi_square_cdf(x: float, dims: int) -> float:
    """For an even number of dimensions."""
    half = x / 2
    return 1 - math.exp(-half) * math.fsum(
        half**k / math.factorial(k) for k in range(dims // 2)
    )


def chi_square_limit(tail: float, dims: int = DIMS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - _chi_square_cdf(mid, dims) > tail else (low, mid)
    return high


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(DIMS) for j in range(i + 1)]


def with_distance(rows: DataFrame, out: str) -> DataFrame:
    """Squared Mahalanobis distance of x0.. from centre m0.. by the Cholesky factor l00.. ."""
    for i in range(DIMS):
        less = " ".join(f"- l{i}{j} * z{j}" for j in range(i))
        rows = rows.withColumn(f"z{i}", F.expr(f"(x{i} - m{i} {less}) / l{i}{i}"))
    square = " + ".join(f"z{i} * z{i}" for i in range(DIMS))
    return rows.withColumn(out, F.expr(square)).drop(*[f"z{i}" for i in range(DIMS)])


def _cholesky(rows: DataFrame, keep: list[str]) -> DataFrame:
    """l00.. from the covariances c00.. ; the diagonal has been raised, so no root is of 0."""
    for i, j in _pairs():
        less = " ".join(f"- l{i}{k} * l{j}{k}" for k in range(j))
        formula = f"sqrt(c{i}{i} {less})" if i == j else f"(c{i}{j} {less}) / l{j}{j}"
        rows = rows.withColumn(f"l{i}{j}", F.expr(formula))
    return rows.select(
        *keep, *[f"m{i}" for i in range(DIMS)], *[f"l{i}{j}" for i, j in _pairs()]
    )


ALL = "a"  # the model of all texts; those of a language and of a source in it have other prefixes


def with_group(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """`rows` with their group: `lang` and `source` as text, and the names of their models."""
    as_text = [
        F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(n)
        for c, n in ((lang, "lang"), (source, "source"))
    ]
    return rows.select(*as_text, *[c for c in rows.columns if c not in {"lang", "source"}]).select(
        "*",
        F.concat(F.lit("l"), "lang").alias("of_lang"),
        F.concat(F.lit("s"), "lang", F.lit("\1"), "source").alias("of_source"),
    )


def _shrunk(params: DataFrame, above: DataFrame, rules: OutlierRules) -> DataFrame:
    """The estimates of `params` (model, parent, n) drawn towards those of their parents in `above`.

    Centre and covariance are those of the mixture of the two laws. The weight is continuous in the
    size of the model, so one row more never switches the estimate that judges a text.
    """
    names = [f"m{i}" for i in range(DIMS)] + [f"l{i}{j}" for i, j in _pairs()]
    upper = above.select(F.col("model").alias("parent"), *[F.col(c).alias(f"p{c}") for c in names])
    w = f"greatest(0D, 1 - {rules.shrink!r}D / n)"

    def covariance(i: int, j: int, prefix: str) -> str:
        return " + ".join(f"{prefix}l{i}{k} * {prefix}l{j}{k}" for k in range(j + 1))

    mixed = params.join(upper, "parent").select(
        "model",
        *[F.expr(f"{w} * m{i} + (1 - {w}) * pm{i}").alias(f"m{i}") for i in range(DIMS)],
        *[
            F.expr(
                f"{w} * ({covariance(i, j, '')}) + (1 - {w}) * ({covariance(i, j, 'p')})"
                f" + {w} * (1 - {w}) * (m{i} - pm{i}) * (m{j} - pm{j})"
            ).alias(f"c{i}{j}")
            for i, j in _pairs()
        ],
    )
    return _cholesky(mixed, ["model"])


def shrink_models(params: DataFrame, groups: DataFrame, rules: OutlierRules) -> DataFrame:
    """Centre and Cholesky factor of every group (of_source, of_lang, n), by its model name."""
    langs = groups.groupBy(F.col("of_lang").alias("model")).agg(F.sum("n").alias("n"))
    langs = langs.withColumn("parent", F.lit(ALL)).join(params, "model")
    of_lang = materialise(
        _shrunk(langs, params.where(F.col("model") == ALL), rules), "quality-langs"
    )
    sources = groups.selectExpr("of_source AS model", "of_lang AS parent", "n")
    return _shrunk(sources.join(params, "model"), of_lang, rules)


def _start(vectors: DataFrame, rules: OutlierRules) -> DataFrame:
    """Median centre and diagonal spread from the quartiles, read off histograms of 1/512."""
    cells = ", ".join(f"{i}, floor(x{i} * 512)" for i in range(DIMS))
    counts = (
        vectors.select("model", F.expr(f"stack({DIMS}, {cells}) AS (dim, cell)"))
        .groupBy("model", "dim", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = counts.selectExpr(
        "model", "dim", "cell",
        "sum(n) OVER (PARTITION BY model, dim ORDER BY cell) AS upto",
        "sum(n) OVER (PARTITION BY model, dim) AS total",
    )
    quartiles = running.groupBy("model", "dim").agg(
        *[
            F.expr(f"(min(CASE WHEN upto >= {q} * total THEN cell END) + 0.5D) / 512").alias(n)
            for q, n in ((0.25, "lower"), (0.5, "middle"), (0.75, "upper"))
        ]
    )
    wide = quartiles.groupBy("model").agg(
        *[F.max(F.expr(f"CASE WHEN dim = {i} THEN middle END")).alias(f"m{i}") for i in range(DIMS)],
        *[
            F.max(
                F.expr(
                    f"CASE WHEN dim = {i} THEN power((upper - lower) / 1.349, 2)"
                    f" + {rules.floors[i] ** 2!r}D END"
                )
            ).alias(f"c{i}{i}")
            for i in range(DIMS)
        ],
    )
    flat = wide.select(
        "*", *[F.lit(0.0).alias(f"c{i}{j}") for i, j in _pairs() if i != j]
    )
    return _cholesky(flat, ["model"])


def _concentrate(vectors: DataFrame, params: DataFrame, rules: OutlierRules) -> DataFrame:
    """One concentration step: mean and covariance of the rows nearest to the last centre.

    Rows are first summed per model and bin of distance; the nearest `core` of a model are then
    its first bins, whatever its size.
    """
    placed = with_distance(vectors.join(params, "model"), "d2").withColumn(
        "bin", F.expr("cast(least(4095, floor(256 * ln(1 + d2))) AS int)")
    )
    y = [f"(x{i} - m{i})" for i in range(DIMS)]
    # One key of both, so that the sums are dealt by bin and not, for the window, by model alone.
    sums = placed.groupBy(F.struct("model", "bin").alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.expr(y[i])).alias(f"s{i}") for i in range(DIMS)],
        *[F.sum(F.expr(f"{y[i]} * {y[j]}")).alias(f"q{i}{j}") for i, j in _pairs()],
    )
    near = sums.select("k.*", *[c for c in sums.columns if c != "k"]).selectExpr(
        "*",
        "sum(n) OVER (PARTITION BY model ORDER BY bin) AS upto",
        "sum(n) OVER (PARTITION BY model) AS total",
    ).where(f"upto - n < {rules.core} * total")
    totals = near.groupBy("model").agg(
        F.sum("n").alias("n"),
        *[F.sum(f"s{i}").alias(f"s{i}") for i in range(DIMS)],
        *[F.sum(f"q{i}{j}").alias(f"q{i}{j}") for i, j in _pairs()],
    )
    # Covariance of the nearest part of a normal law, brought back to that of the whole.
    limit = chi_square_limit(1 - rules.core)
    factor = rules.core / _chi_square_cdf(limit, DIMS + 2)
    ridge = {(i, i): f" + {rules.floors[i] ** 2!r}D" for i in range(DIMS)}
    moved = totals.join(params, "model").select(
        "model",
        *[F.expr(f"m{i} + s{i} / n").alias(f"m{i}") for i in range(DIMS)],
        *[
            F.expr(
                f"{factor!r}D * (q{i}{j} / n - s{i} * s{j} / n / n){ridge.get((i, j), '')}"
            ).alias(f"c{i}{j}")
            for i, j in _pairs()
        ],
    )
    return _cholesky(moved, ["model"])


def fit_outliers(vectors: DataFrame, rules: OutlierRules) -> DataFrame:
    """Minimum-covariance-determinant centre and Cholesky factor of each `model`.

    Deterministic start, then concentration steps, none of which raises a determinant but for
    the width of the bins; it stops when no determinant falls by a thousandth any more.
    """
    size = F.expr(" + ".join(f"ln(l{i}{i})" for i in range(DIMS)))
    params = materialise(_start(vectors, rules), "quality-params")
    for _ in range(rules.steps):
        moved = materialise(_concentrate(vectors, params, rules), "quality-params")
        fall = (
            params.select("model", size.alias("before"))
            .join(moved.select("model", size.alias("after")), "model")
            .agg(F.max(F.abs(F.col("before") - F.col("after"))))
            .first()[0]
        )
        params = moved
        if fall is None or fall < 1e-3:
            break
    return params


def _judged(
    stats: DataFrame, names: DataFrame, params: DataFrame, lang: str, source: str, limit: float
) -> DataFrame:
    """`stats` with `distance` and `kept`."""
    # The input's own columns travel in one struct: whatever they are called, none of the names
    # used here can clash with them.
    known = [*BASE, *MORE, "base_failed"]
    keyed = stats.select(
        F.struct(*stats.columns).alias("row"),
        F.coalesce(F.col(lang).cast("string"), F.lit("\0")).alias("in_lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("\0")).alias("in_source"),
        *known,
    )
    models = names.withColumnsRenamed(
        {"of_source": "model", "lang": "in_lang", "source": "in_source"}
    )
    models = models.select("in_lang", "in_source", "model").join(params, "model").drop("model")
    far = with_distance(with_vector(keyed).join(models, ["in_lang", "in_source"], "left"), "d2")
    return far.select(
        "row.*",
        F.sqrt("d2").alias("distance"),
        F.expr(f"NOT base_failed AND coalesce(d2 <= {limit!r}D, true)").alias("kept"),
    )


def quality_rules(
    docs: DataFrame,
    rules: OutlierRules | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    with_text: bool = True,
) -> DataFrame:
    """Every row of `docs` with BASE, MORE, `base_failed`, `distance` and `kept`.

    `kept` is false if the base rule fails or if the text's transformed statistics lie further
    from the centre of its language and source, by Mahalanobis distance, than the limit of
    `rules`. Only texts that pass the base rule shape the estimates. NULL texts have no words and
    fail; a NULL language or source is a group of its own. Every group has an estimate of its own,
    drawn towards that of its language, and that towards the one of all texts, the more the fewer
    rows it has. Repeated rows get equal verdicts.
    Input columns called like a new one are replaced. Without `with_text` the text is left out
    of the result, and texts are read once instead of twice.
    """
    rules = rules or OutlierRules()
    new = {*BASE, *MORE, "base_failed", "distance", "kept"}
    kept = docs.select(*[c for c in docs.columns if c.lower() not in new])
    stats = with_statistics(kept, text)
    if not with_text:
        stats = materialise(stats.drop(text), "quality-statistics")
    measured = stats.select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), *BASE, *MORE, "base_failed"
    )
    if with_text:
        measured = materialise(measured, "quality-statistics")
    passed = measured.where("NOT base_failed")
    vectors = materialise(
        with_group(with_vector(passed), "lang", "source").select(
            "lang", "source", "of_lang", "of_source", *[f"x{i}" for i in range(DIMS)]
        ),
        "quality-vectors",
    )
    names = materialise(
        vectors.groupBy("lang", "source", "of_lang", "of_source").agg(F.count(F.lit(1)).alias("n")),
        "quality-models",
    )
    levels = vectors.select(
        F.explode(F.array("of_source", "of_lang", F.lit(ALL))).alias("model"),
        *[f"x{i}" for i in range(DIMS)],
    )
    params = materialise(
        shrink_models(fit_outliers(levels, rules), names, rules), "quality-shrunk"
    )
    return _judged(stats, names, params, lang, source, chi_square_limit(rules.tail))
