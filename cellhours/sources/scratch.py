"""Where jobs put intermediate tables: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session.

    Only a local session without one gets a folder of its own; on a cluster a machine-local
    folder would be lost with its machine, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="cellhours-")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of one job."""
    return f"{checkpoint_root(spark)}/cellhours/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    A Parquet table survives lost executors, cuts the lineage and still prunes columns.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_missing(error: Exception) -> bool:
    return getattr(error, "getCondition", lambda: None)() in {
        "PATH_NOT_FOUND",
        "UNABLE_TO_INFER_SCHEMA",
    }
