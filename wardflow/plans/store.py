"""The warehouse's folders: loads add files, and one small pointer file tells which of them are current.

A table lies in ``<warehouse>/<table>/period=<month>/run=<load>``. The pointer names for each table and month the load that
wrote it last, so replacing the pointer publishes all tables of a load at once; readers that opened a table before keep the
files they have listed.
"""

from __future__ import annotations

import json
import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardflow.sources import footers

POINTER = "_current.json"


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system, so that any store Spark can write to will do."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, warehouse: str) -> dict[str, dict[str, dict]]:
    """{table: {month: {"run": load, "rows": count}}} of what is published; empty before the first load."""
    path, fs = _path(spark, f"{warehouse}/{POINTER}")
    if not fs.exists(path):
        return {}
    stream = fs.open(path)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


class ConcurrentLoad(RuntimeError):
    """Another load has published, or is publishing, months that this one has merged into."""


def switch(spark: SparkSession, warehouse: str, changes: dict[str, dict[str, dict]], seen: dict[str, dict[str, dict]] | None = None) -> None:
    """Publishes months of several tables in one step: the new pointer is written aside and renamed over the old one.

    ``seen`` is the pointer that the load started from. If a month of the changes is no longer what it was then, nothing is
    published, as the other load's rows would be lost. Loads of different months do not disturb each other. The file
    written aside can be made only once at a time, so no other load publishes between the comparison and the renaming.
    """
    aside, fs = _path(spark, f"{warehouse}/{POINTER}.next")
    fs.mkdirs(aside.getParent())
    try:
        out = fs.create(aside, False)
    except Exception as e:
        raise ConcurrentLoad(f"{aside} exists: another load is publishing, or stopped while it was; then remove the file") from e
    try:
        tables = current(spark, warehouse)
        lost = [(t, m) for t, months in changes.items() for m in months if seen is not None and tables.get(t, {}).get(m) != seen.get(t, {}).get(m)]
        if lost:
            raise ConcurrentLoad(f"published by another load since this one began: {lost[:5]}")
        for table, months in changes.items():
            tables[table] = {**tables.get(table, {}), **months}
        out.write(bytearray(json.dumps(tables, indent=1, sort_keys=True).encode()))
        out.close()
        rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(aside, _path(spark, f"{warehouse}/{POINTER}")[0], options)
    except BaseException:
        out.close()
        fs.delete(aside, False)
        raise


def summary(spark: SparkSession, warehouse: str) -> DataFrame:
    """table_name and row_count of what is published, from the pointer alone."""
    rows = [(name, sum(m["rows"] for m in months.values())) for name, months in sorted(current(spark, warehouse).items())]
    return spark.createDataFrame(rows, "table_name string, row_count long")


def months(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """period and row_count of the published months of a table, from the pointer alone."""
    rows = [(period, m["rows"]) for period, m in sorted(current(spark, warehouse).get(table, {}).items())]
    return spark.createDataFrame(rows, "period string, row_count long")


def vacuum(spark: SparkSession, warehouse: str, older_than: timedelta) -> list[str]:
    """Removes the files of replaced and failed runs that are older than that, so that no reader still holds them.

    Returns the folders removed. Published runs stay whatever their age.
    """
    limit = (time.time() - older_than.total_seconds()) * 1000
    tables, gone = current(spark, warehouse), []
    for table, held in tables.items():
        pattern, fs = _path(spark, f"{warehouse}/{table}/period=*/run=*")
        for status in fs.globStatus(pattern) or []:
            run, period = status.getPath().getName(), status.getPath().getParent().getName()
            published = held.get(period.removeprefix("period="), {}).get("run")
            if f"run={published}" != run and status.getModificationTime() < limit:
                fs.delete(status.getPath(), True)
                gone.append(f"{table}/{period}/{run}")
    return gone


def read(
    spark: SparkSession,
    warehouse: str,
    table: str,
    schema: T.StructType,
    months: list[str] | None = None,
    pointer: dict[str, dict[str, dict]] | None = None,
) -> DataFrame | None:
    """The published rows of a table, or of some of its months, as a pointer read before tells; None if it was never loaded."""
    held = (current(spark, warehouse) if pointer is None else pointer).get(table)
    if held is None:
        return None
    root = f"{warehouse}/{table}"
    wanted = [m for m in sorted(held) if held[m]["rows"] and (months is None or m in set(months))]
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/period={m}/run={held[m]['run']}" for m in wanted]
    with_run = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(with_run).option("basePath", root).parquet(*paths).select(*schema.names)


def write(rows: DataFrame, warehouse: str, table: str, run: str, months: list[str]) -> dict[str, dict]:
    """Writes a load's months beside the published ones and returns their entries for the pointer.

    ``months`` are those that the rows can have; how many each has is told by the footers of the files written. Repeating a
    load replaces what an earlier attempt of the same name has left.
    """
    if not months:
        return {}
    spark, root = rows.sparkSession, f"{warehouse}/{table}"
    folders = {m: f"{root}/period={m}/run={run}" for m in months}
    (
        rows.withColumn("run", F.lit(run))
        .hint("rebalance", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period", "run")
        .parquet(root)
    )
    made = [f for f in folders.values() if exists(spark, f)]
    found = {}
    if made:
        period = F.regexp_extract("path", "/period=([^/]*)/run=", 1)
        found = dict(footers.row_counts(spark, made).groupBy(period).agg(F.sum("row_count")).collect())
    return {m: {"run": run, "rows": found.get(m, 0)} for m in months}


def exists(spark: SparkSession, path: str) -> bool:
    made, fs = _path(spark, path)
    return fs.exists(made)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder, such as the staging folder of a finished load, if it is there."""
    made, fs = _path(spark, path)
    fs.delete(made, True)
