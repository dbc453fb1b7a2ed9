"""The corpus operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellhours.llm.alignment import align_tokenizers
from cellhours.llm.common import table
from cellhours.llm.mixing import mix_sources
from cellhours.llm.negatives import mine_hard_negatives
from cellhours.llm.neighbours import nearest_neighbours
from cellhours.llm.packing import pack_documents
from cellhours.llm.pii import KINDS, find_pii, spans_text
from cellhours.llm.quality import BASE, quality_rules
from cellhours.llm.repeats import remove_repeats
from cellhours.llm.sharding import shard_records
from cellhours.llm.simhash import simhash_components
from cellhours.llm.tokens import token_counts
from cellhours.llm.toxicity import fit_toxicity, score_toxicity
from cellhours.llm.warc import archive_and_read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the best unigram segmentation of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, with_text=False)
    base = F.filter("pii", lambda x: x["base"])

    def count(k: int) -> Column:
        return F.size(F.filter(base, lambda x: x["k"] == k)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("pii")).alias("spans"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 by rendezvous hashing of the id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_records(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out third are never seen."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold != 1)
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs, shingle=4, max_distance=4)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, one row per piece."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, file="word_bpe_49k.json", end_id=1, window=2048)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the order of a Pfair schedule, sources weighted by the root of their size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_sources(docs, power=0.5)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the robust outlier test."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality_rules(docs, with_text=False)
    return judged.select("doc_id", *BASE, "base_failed", "kept")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 400 bytes that occur again.

    A passage of over 50 words may be shorter than that and stays; `shares_passage` tells of it.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, length=400, words=51).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("removed") > 0).alias("has_repeat"),
        "shares_passage",
    )


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups of every document by two tokenizers, and its links by how common they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives with a shared dictionary, and read back from them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return archive_and_read(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector; labels of every 7th are moved on by one first."""
    rows = table(spark, sf_dir, "embeddings").where(
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    moved = rows.selectExpr(
        "vec_id",
        "if(vec_id % 7 = 0, (label + 1) % 10, label) AS label",
        "transform(embedding, x -> floor(256 * CAST(x AS double))) AS vector",
    )
    return mine_hard_negatives(moved, every=100, positives=5, negatives=5, window=(80, 100))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after the other."""
    from corpus_pipeline import run  # the pipeline itself imports the operators

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_pii,
        op3_sharding,
        op4_toxicity,
        op5_simhash,
        op6_packing,
        op7_mixing,
        op8_quality,
        op9_repeats,
        op10_neighbours,
        op11_alignment,
        op12_warc,
        op13_negatives,
        pipeline,
    )
}
