"""Scratch tables in the shared folder, and the little that all operators need."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: ASCII blanks only, as a regular expression.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes that a partition of a small table may have.
FILE = 8 << 20

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder.setdefault(context.applicationId, tempfile.mkdtemp(prefix="nightledger-llm-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def in_few(df: DataFrame, size: int | None) -> DataFrame:
    """The rows, `size` bytes at most, in no more partitions than these bytes are worth, but one for each core; as they are without a size.

    A small table else costs as many tasks, and files, as shuffles have partitions.
    """
    return df if size is None else df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // FILE)))


def saved(df: DataFrame, name: str, size: int | None = None) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, lost executors cost nothing.

    A `size`, the bytes that the last stage takes at most, keeps it `in_few` files.
    """
    path = scratch_path(df.sparkSession, name)
    in_few(df, size).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that later ones have replaced."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Scratch tables by name, each dropped when what has been made of it is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def save(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, name)
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            dropped(self.spark, self.paths.pop(name))


def early_cleanup(spark: SparkSession) -> None:
    """Shuffle files go when their query ends, not when the driver next collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def whole_text(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_batches(spark: SparkSession, size: str = "16m") -> None:
    """Arrow batches of few bytes, so that long texts do not add up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)



def text_key(column: str = "text") -> Column:
    """With the doc_id, what tells rows apart that repeat a doc_id; rows that agree in both are alike to every operator."""
    return F.xxhash64(F.col(column).cast("string"))


def kept_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose doc_id and text_key are in `kept`; nulls match nulls."""
    wanted = kept.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & text_key().eqNullSafe(F.col("__key"))
    return docs.join(wanted, same, "left_semi")
