"""Cutting lineage in the shared folder of the cluster, and small column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word of every text measure: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in a local session without that setting, a temporary one."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wardflow-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once and read back from the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """As checkpointed(), in columns: for wide tables of which later steps read a few columns, or the folders of some values."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by or []).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsent(df: DataFrame) -> DataFrame:
    """df, to be joined by sorting: for tables that grow with the input.

    Below Spark's limit for broadcasts they would go through the driver, where they take several times the bytes that the limit
    counts, and stay until its next collection of garbage; of a chain of joins, many at once.
    """
    return df.hint("merge")


def sent_file(spark: SparkSession, path: str) -> str:
    """Sends a file of the driver to the executors; the name under which SparkFiles finds it there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def folded(text: Column) -> Column:
    """Text with A-Z, and nothing else, in lower case; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold_number(key: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo folds; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def first_by_hash(keys: DataFrame, rows: int) -> DataFrame:
    """key, label and n of the rows with the smallest hashes of their keys, `rows` of each label at most; n counts from 1.

    Rows whose hashes are beyond twice the share that is wanted of their label are dropped where they are read, so that only
    about 2 * rows of each label are sorted, however many it has.
    """
    sizes = keys.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    placed = F.xxhash64("key").cast("double") / 2.0**64 + 0.5
    some = keys.join(sizes, "label").filter(placed * F.col("size") <= 2 * rows)
    order = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key")
    return checkpointed(some.select("key", "label", F.row_number().over(order).alias("n")).filter(F.col("n") <= rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows_kept(docs: DataFrame, verdict: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that a verdict (doc_id, text_hash, kept; one row per row of docs) keeps, with all columns.

    Rows are told by key and text. The losers are removed by an anti join, so texts move only if Spark finds the losers
    too many to send to all executors. Rows that repeat a kept row's key and text are reduced to one, if there are any.
    """
    by_key = checkpointed(verdict.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")))
    losers = by_key.filter(~F.col("kept")).alias("b")
    again = by_key.filter(F.col("kept") & (F.col("n") > 1)).alias("b")
    same = F.col(f"a.{id_col}").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64(F.col(f"a.{text_col}")) == F.col("b.text_hash"))
    left = docs.alias("a").join(losers, same, "left_anti")
    if again.isEmpty():
        return left
    once = left.alias("a").join(again, same, "left_anti")
    repeated = left.alias("a").join(again, same, "left_semi")
    return once.unionByName(repeated.dropDuplicates([id_col, text_col]))
