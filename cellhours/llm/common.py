"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from cellhours.sources.scratch import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fields(df: DataFrame, columns: list[str], **new: DataType) -> StructType:
    """Schema of the named columns of `df` and of new ones."""
    added = [StructField(name, kind) for name, kind in new.items()]
    return StructType([*df.select(*columns).schema.fields, *added])


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of `df` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def number_rows(
    df: DataFrame, groups: list[str], order: list[str], out: str, block_rows: int = 200_000
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the order of `order`.

    `order[0]` is a BIGINT hash, so its top bits cut every group into blocks of about equal size;
    the order of the blocks is the order of the hash, and the numbers do not depend on how many
    blocks there are. A group of any size is numbered by many tasks: each block by itself, from
    the count of the blocks before it. The group columns must not be NULL.
    """
    bits = max(0, math.ceil(math.log2(max(1, df.count()) / block_rows)))
    block = fresh_name(df, "_block")
    first = fresh_name(df, "_first")
    tagged = df.withColumn(
        block, F.shiftright(order[0], 64 - bits) if bits else F.lit(0).cast("bigint")
    )
    before = (
        Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = (
        tagged.groupBy(*groups, block)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*groups, block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy(*groups, block).orderBy(*order)
    return (
        tagged.join(firsts, [*groups, block])
        .withColumn(out, F.col(first) + F.row_number().over(inside) - F.lit(1))
        .drop(block, first)
    )


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """Smallest reachable node of every node that has an edge: (node, root).

    `edges` has BIGINT columns u and v. Alternates the large-star and small-star steps until the
    edges are the stars of the components; every round is written to the shared folder.
    """
    stars = materialise(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        name,
    )
    print_of = _fingerprint(stars)
    while print_of[0]:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.expr("if(v = m, u, v) AS u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        stars = materialise(small, name)
        now = _fingerprint(stars)
        if now == print_of:
            break
        print_of = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
