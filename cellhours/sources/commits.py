"""A log of commits over plain Parquet, so that several jobs can append to one table.

Every append is a folder of its own, `commit_id=<id>`, and becomes part of the table by its entry
in the log: a file named by the next version, which only one writer can create. A writer that
comes second sees whose rows it did not know and tries again behind them. Readers take the
folders that the log names, so they never see half an append, nor one that was given up.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

LOG = "_commits"
COMMIT = "commit_id"


@dataclass(frozen=True)
class Entry:
    """One append: its folder, its rows, and the partition folders it wrote to."""

    version: int
    commit_id: str
    rows: int
    parts: tuple[str, ...]


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202 - objects of the JVM
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, where = _file_system(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where))


def remove(spark: SparkSession, path: str) -> None:
    system, where = _file_system(spark, path)
    system.delete(where, True)


def _local(spark: SparkSession, path: str) -> str | None:
    system, where = _file_system(spark, path)
    return where.toUri().getPath() if system.getUri().getScheme() == "file" else None


def log_entries(spark: SparkSession, path: str, after: int = 0) -> list[Entry]:
    """The entries behind version `after`, in order: one for every append to the table."""
    names = [n for n in children(spark, f"{path}/{LOG}") if n.endswith(".json")]
    files = [f"{path}/{LOG}/{n}" for n in names if int(n.removesuffix(".json")) > after]
    if not files:
        return []
    rows = spark.read.schema(
        "version bigint, commit_id string, rows bigint, parts array<string>"
    ).json(files)
    return [Entry(r.version, r.commit_id, r.rows, tuple(r.parts)) for r in rows.orderBy("version").collect()]


def publish(spark: SparkSession, path: str, entry: Entry) -> bool:
    """Create the log file of the entry's version; false if another writer has done so before."""
    name = f"{path}/{LOG}/{entry.version:020d}.json"
    draft = f"{path}/{LOG}/.{uuid.uuid4().hex}"
    text = json.dumps(asdict(entry))
    local = _local(spark, path)
    if local is not None:  # a hard link either appears with all its content or fails
        os.makedirs(f"{local}/{LOG}", exist_ok=True)
        with open(f"{local}/{LOG}/{os.path.basename(draft)}", "w") as out:
            out.write(text)
        try:
            os.link(out.name, f"{local}/{LOG}/{os.path.basename(name)}")
        except FileExistsError:
            return False
        finally:
            os.unlink(out.name)
        return True
    return rename_once(spark, draft, name, text)


def rename_once(spark: SparkSession, draft: str, name: str, text: str) -> bool:
    """Write `draft` and rename it to `name`, which a distributed file system does only once."""
    from py4j.protocol import Py4JJavaError

    system, source = _file_system(spark, draft)
    stream = system.create(source, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(source, hadoop.Path(name), options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        system.delete(source, False)
        return False
    return True


def stage(
    rows: DataFrame, path: str, partition: str, commit_id: str | None = None, **options: str
) -> tuple[str, tuple[str, ...]]:
    """Write rows where no reader looks yet; the commit's id and the partition folders it has.

    With the id of a commit that is not published yet, the rows are added to it.
    """
    commit_id = commit_id or uuid.uuid4().hex
    folder = f"{path}/{COMMIT}={commit_id}"
    rows.write.mode("append").options(**options).partitionBy(partition).parquet(folder)
    found = children(rows.sparkSession, folder)
    return commit_id, tuple(n.split("=", 1)[1] for n in found if n.startswith(f"{partition}="))


def read_commits(
    spark: SparkSession, path: str, entries: list[Entry], schema: StructType, partition: str,
    kind: str,
) -> DataFrame:
    """The rows of some commits, with the partition column of type `kind`."""
    if not entries:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(partition, F.lit(None).cast(kind))
    full = StructType([*schema.fields]).add(COMMIT, StringType()).add(partition, kind)
    folders = [f"{path}/{COMMIT}={e.commit_id}" for e in entries]
    return spark.read.schema(full).option("basePath", path).parquet(*folders).drop(COMMIT)
