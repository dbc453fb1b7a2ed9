"""Toxicity scores: gradient-boosted trees over dense text features, isotonic calibration."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cellhours.llm.common import with_fields
from cellhours.sources.scratch import materialise

FEATURES = (
    "hits", "hit_density", "distinct_hits", "weight_density", "stem_density", "near_you",
    "you_density", "capitals", "marks", "shouts", "obfuscated", "hidden_hits", "length",
)
STEM = 5  # letters of a stem
NEAR = 3  # words between a hit and a second person

_WORD = re.compile(r"[^\W\d_]+")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARK = re.compile(r"[.,;:?!]")
_OBFUSCATED = re.compile(r"[^\W\d_]+(?:[@$*0-9!|]+[^\W\d_]+)+")
_LEET = str.maketrans("@$01345!|7", "asoieasiit")
# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer eure "
    "tu te toi ton tes vous votre vos ti tú tus tuyo usted ustedes vosotros vuestro".split()
)


@dataclass(frozen=True)
class Lexicon:
    """Words and stems with their log-odds of toxic texts."""

    words: dict[str, float]
    stems: dict[str, float]


@dataclass(frozen=True)
class ToxicityModel:
    """What scoring needs; without trees every text gets `share`."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def text_features(text: str, lexicon: Lexicon) -> list[float]:
    """FEATURES of one whole text."""
    words = _WORD.findall(text.lower())
    size = len(words) + 10.0  # a few words along, so that one hit in three is not a certainty
    at = [i for i, w in enumerate(words) if w in lexicon.words]
    weights = [lexicon.words[words[i]] for i in at]
    stems = [lexicon.stems[s] for s in (w[:STEM] for w in words) if s in lexicon.stems]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON] if at else []
    near = 0
    if you:
        close = {i + d for i in you for d in range(-NEAR, NEAR + 1)}
        near = sum(i in close for i in at)
    disguised = _OBFUSCATED.findall(text)
    hidden = sum(w.lower().translate(_LEET) in lexicon.words for w in disguised)
    return [
        math.log1p(len(at)),
        len(at) / size,
        math.log1p(len({words[i] for i in at})),
        sum(weights) / size,
        sum(stems) / size,
        near / size,
        sum(w in SECOND_PERSON for w in words) / size,
        len(_CAPITAL.findall(text)) / (len(text) + 50.0),
        len(_MARK.findall(text)) / size,
        text.count("!") / size,
        len(disguised) / size,
        float(hidden),
        math.log1p(len(words)),
    ]


def with_features(docs: DataFrame, text: str, lexicon: Lexicon) -> DataFrame:
    """`docs` without `text`, plus one DOUBLE column per feature, prefixed by `f_`."""
    others = [c for c in docs.columns if c != text]
    names = [f"f_{f}" for f in FEATURES]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [text_features(t or "", lexicon) for t in part.column(0).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], [*others, *names])

    schema = with_fields(docs, others, **dict.fromkeys(names, DoubleType()))
    return docs.select(text, *others).mapInArrow(batches, schema)


def training_texts(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int
) -> DataFrame:
    """(id, body, y) of at most about `most` labelled texts, one of each group of near copies.

    Rows are picked by a hash of the id. Texts that share the three least hashes of their long
    words are taken for near copies: a group of them must not look like many witnesses for words
    that only they have.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(label).cast("double").alias("y"))
    )
    n = known.count()
    spread = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1_000_000))
    picked = known.where(spread < math.ceil(1_000_000 * min(1.0, most / max(1, n))))
    # At most about `most` rows of 16 bytes, whatever the tables hold.
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("body")).join(
        F.broadcast(picked), "id"
    )
    long_words = F.regexp_extract_all(F.lower("body"), F.lit(r"\p{L}{8,}"), F.lit(0))
    marks = F.sort_array(F.array_distinct(F.transform(long_words, lambda w: F.xxhash64(w))))
    least = F.slice(marks, 1, 3)
    group = F.when(F.size(least) == 3, F.xxhash64(least)).otherwise(F.xxhash64("body"))
    first = Window.partitionBy("group", "y").orderBy(F.xxhash64("id"), "id")
    rows = texts.withColumn("group", group).withColumn("nth", F.row_number().over(first))
    return materialise(rows.where("nth = 1").select("id", "body", "y"), "toxicity-texts")


def learn_lexicon(texts: DataFrame, most: int) -> Lexicon:
    """The words and stems with the strongest tie to toxic texts, at most `most` of each.

    Document counts in all training texts; a word needs three toxic texts and a share of toxic
    ones well above the average, judged by a log-odds ratio with half a count added.
    """
    total = texts.agg(F.count("*").alias("n"), F.sum("y").alias("t")).first()
    toxic, clean = float(total.t or 0), float((total.n or 0) - (total.t or 0))

    def strongest(items: DataFrame) -> dict[str, float]:
        counted = items.groupBy("item").agg(
            F.sum("y").alias("t"), (F.count("*") - F.sum("y")).alias("c")
        )
        odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
        error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
        rows = (
            counted.where((F.col("t") >= 3) & (F.col("t") >= 0.004 * toxic))
            .withColumn("odds", odds)
            .where((F.col("odds") > 2.0) & (F.col("odds") > 2.5 * error))
            .orderBy(F.desc(F.col("odds") * F.sqrt("t")), "item")
            .limit(most)
        )
        return {r.item: r.odds for r in rows.collect()}

    words = F.array_distinct(
        F.regexp_extract_all(F.lower("body"), F.lit(r"\p{L}+"), F.lit(0))
    )
    each = materialise(texts.select("y", words.alias("words")), "toxicity-words")
    stems = F.array_distinct(
        F.transform(
            F.filter("words", lambda w: F.char_length(w) >= STEM), lambda w: F.substring(w, 1, STEM)
        )
    )
    return Lexicon(
        strongest(each.select("y", F.explode("words").alias("item"))),
        strongest(each.select("y", F.explode(stems).alias("item"))),
    )


def _vectors(rows: DataFrame) -> DataFrame:
    names = [f"f_{f}" for f in FEATURES]
    return VectorAssembler(inputCols=names, outputCol="_features").transform(rows).drop(*names)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most_texts: int = 20_000,
    most_words: int = 200,
    trees: int = 30,
    depth: int = 3,
) -> ToxicityModel:
    """Lexicon, trees and calibration from the labelled texts.

    Fitted on at most about `most_texts` rows (documented bound, by hash of the id). A quarter
    of them, by hash, is kept from the trees and gives the isotonic calibration.
    """
    texts = training_texts(docs, labels, doc_id, text, label, most_texts)
    part = F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(4)) == 0
    lexicon = learn_lexicon(texts.where(~part), most_words)
    rows = materialise(
        _vectors(with_features(texts.withColumn("late", part), "body", lexicon)), "toxicity-rows"
    )
    sums = {
        r.late: (r.n, r.t)
        for r in rows.groupBy("late").agg(F.count("*").alias("n"), F.sum("y").alias("t")).collect()
    }
    n, toxic = sums.get(False, (0, 0.0))
    total = sum(x[0] for x in sums.values())
    share = sum(x[1] for x in sums.values()) / total if total else 0.0
    if not 0 < (toxic or 0) < n:
        return ToxicityModel(lexicon, None, None, share)
    fitted = GBTClassifier(
        featuresCol="_features", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=64,
        minInstancesPerNode=5, seed=7,
    ).fit(rows.where("NOT late").coalesce(4))
    late_n, late_toxic = sums.get(True, (0, 0.0))
    # With few rows held out the trees' own rows have to do.
    held = rows.where("late") if 10 <= (late_toxic or 0) < late_n else rows
    margins = fitted.transform(held).select(
        "y", vector_to_array("rawPrediction")[1].alias("_margin"), F.lit(1.0).alias("_weight")
    )
    calibration = IsotonicRegression(
        featuresCol="_margin", labelCol="y", predictionCol="_score", weightCol="_weight"
    ).fit(margins.coalesce(1))
    return ToxicityModel(lexicon, fitted, calibration, share)


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    text: str = "text",
    out: str = "score",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns `keep` of `docs` (all but the text by default) and a score from 0 to 1.

    Only the text enters a score. NULL and empty texts are scored like any text without words.
    Within a step of the calibration the trees' margin breaks ties by up to a thousandth, so the
    order of the scores is that of the trees. Repeated rows get equal scores. An input column
    called like `out` is replaced.
    """
    kept = [c for c in (keep or docs.columns) if c != text and c.lower() != out.lower()]
    if model.trees is None or model.calibration is None:
        return docs.select(*kept, F.lit(model.share).cast("double").alias(out))
    wrapped = docs.select(F.struct(*kept).alias("_row"), F.col(text).alias("_text"))
    rows = _vectors(with_features(wrapped, "_text", model.lexicon))
    scored = model.trees.transform(rows).withColumn("_margin", vector_to_array("rawPrediction")[1])
    scored = model.calibration.transform(scored)
    fine = 1 / (1 + F.exp(-F.col("_margin")))
    return scored.select(
        "_row.*", (0.999 * F.col("_score") + 0.001 * fine).cast("double").alias(out)
    )
