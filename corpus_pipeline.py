"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing and packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but
the last return the columns of the documents table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhours.llm.common import fresh_name, table
from cellhours.llm.mixing import mix_sources
from cellhours.llm.packing import pack_documents
from cellhours.llm.pii import find_pii, mask
from cellhours.llm.quality import quality_rules
from cellhours.llm.simhash import one_per_component
from cellhours.sources.scratch import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay as they are."""
    return quality_rules(docs).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies stays, see `one_per_component`."""
    return one_per_component(docs, shingle=4, max_distance=4)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets; n_chars follows the text."""
    spans = fresh_name(docs, "pii")
    found = find_pii(docs, out=spans)
    body = F.when(F.col("text").isNotNull(), mask(F.col("text"), F.col(spans)))
    masked = found.withColumn("text", body)
    if "n_chars" in docs.columns:
        masked = masked.withColumn(
            "n_chars",
            F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(
                F.char_length("text").cast(docs.schema["n_chars"].dataType)
            ),
        )
    return masked.select(*docs.columns)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, dealt to files in the order of the schedule and sorted in each."""
    mixed = mix_sources(docs, power=0.5)
    return (
        mixed.repartitionByRange("position").sortWithinPartitions("position").select(*docs.columns)
    )


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of 2048, one row per piece of a document, along the schedule of the mixing.

    The mixing wrote its rows in schedule order, which their file and place in it still tell.
    Documents that are no table of files have no order to follow.
    """
    order = [fresh_name(docs, "in_file"), fresh_name(docs, "in_row")]
    try:
        docs = docs.select(
            "*",
            F.col("_metadata.file_name").alias(order[0]),
            F.col("_metadata.row_index").alias(order[1]),
        )
    except AnalysisException:
        order = []
    return pack_documents(docs, file="word_bpe_49k.json", end_id=1, window=2048, order=order)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", drop_low_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_to_weights),
    ("packing", pack_windows),
]

#: Tokenizer ids, XXH64 fingerprints and the trained models are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
