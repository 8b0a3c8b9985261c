"""Readers for landed files, and the writers around them."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wardflow.sources import footers

FILE, ROW = "_file", "_row"


def strict_cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Wanted columns in wanted types; a missing column becomes null, a bad value fails (ANSI cast).

    Text such as ``3.0``, as float columns leave it behind, is a whole number.
    """
    types = dict(df.dtypes)

    def wanted(f):
        if f.name not in types:
            return F.lit(None)
        if types[f.name] == "string" and isinstance(f.dataType, T.IntegralType):
            return F.regexp_replace(f.name, r"\.0*$", "")
        return F.col(f.name)

    extra = [c for c in (FILE, ROW) if c in types]
    return df.select(*[wanted(f).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


def union_layouts(spark: SparkSession, frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Bag union of frames of differing layouts; no frames give an empty table of the schema."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [strict_cast(f, schema) for f in frames])


def with_position(df: DataFrame) -> DataFrame:
    """Rows read from files with the file and the place in it that each comes from; streams have them too."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def read_files(spark: SparkSession, paths: list[str], with_order: bool = True, **options) -> DataFrame:
    """One scan over Parquet files or globs, with the file and row position unless that is not wanted."""
    df = spark.read.options(**options).parquet(*paths)
    return with_position(df) if with_order else df


def groups_of_one_layout(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files behind paths and globs in groups whose column types agree, for stores whose footers tasks cannot open.

    Files that disagree are split in half until they do not, in the order of their names.
    """

    def split(files: list[str]) -> list[list[str]]:
        try:
            spark.read.option("mergeSchema", "true").parquet(*files).schema
            return [files]
        except Exception as e:
            if len(files) == 1 or "MERGE_SCHEMA" not in str(e).upper() and "MERGING SCHEMA" not in str(e).upper():
                raise
        middle = len(files) // 2
        return split(files[:middle]) + split(files[middle:])

    files = sorted(spark.read.parquet(*paths).inputFiles())
    return split(files) if files else []


def read_consolidated(
    spark: SparkSession, layouts: list[list[str]], schema: T.StructType, with_order: bool = True
) -> DataFrame:
    """Files of several layouts as one typed table.

    Each entry of ``layouts`` is a list of paths or globs. Columns and their types may differ file by file; tasks read the
    footers, and the number of scans is the number of layouts that contradict each other, not of files.
    """
    frames = []
    for paths in filter(None, layouts):
        if footers.can_open(paths[0]):
            for files, held in footers.scans(spark, paths):
                rows = spark.read.schema(held).option("recursiveFileLookup", "true").parquet(*files)
                frames.append(with_position(rows) if with_order else rows)
        else:
            frames += [read_files(spark, g, with_order, mergeSchema="true") for g in groups_of_one_layout(spark, paths)]
    return union_layouts(spark, frames, schema)


def read_registry_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """Registry or domain list as CSV with header in Latin-1, read with a fixed schema by column name."""
    text = spark.read.csv(path, sep=sep, encoding="ISO-8859-1", header=True, inferSchema=False)
    return strict_cast(text, schema)


def read_registry_json(spark: SparkSession, path: str, schema: T.StructType, wrapper: str | None = None) -> DataFrame:
    """Registry as JSON: a list of records, or an object whose key ``wrapper`` holds that list."""
    if wrapper is None:
        return spark.read.schema(schema).json(path, multiLine=True)
    nested = T.StructType([T.StructField(wrapper, T.ArrayType(schema))])
    rows = spark.read.schema(nested).json(path, multiLine=True, mode="FAILFAST")
    return rows.select(F.inline(wrapper))


def json_wrapper(spark: SparkSession, path: str) -> str | None:
    """First key of a JSON registry, which wraps its records, or None for a bare list.

    Only the beginning of the text is looked at; further keys may follow the list.
    """
    head = spark.read.text(path, wholetext=True).select(F.substring("value", 1, 65536)).first()
    text = (head[0] if head else "").lstrip("\ufeff \t\r\n")
    if text.startswith("["):
        return None
    first = re.match(r'\{\s*"((?:[^"\\]|\\.)*)"\s*:\s*(\[\s*[{\]])?', text)
    if not first:
        raise ValueError(f"{path}: neither a list nor an object")
    if not first[2]:
        raise ValueError(f"{path}: key {first[1]!r} holds no list of records")
    return json.loads(f'"{first[1]}"')


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Stored table, or None when it was never written."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_inputs(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Consolidated tables by name; lists everything that is missing before failing."""
    tables = {name: read_table(spark, path) for name, path in paths.items()}
    missing = [paths[n] for n, t in tables.items() if t is None]
    if missing:
        raise FileNotFoundError(f"inputs not found: {missing}")
    return tables


def write_with_region(df: DataFrame, path: str, in_region: Column, region_path: str) -> tuple[int, int]:
    """The landed rows as they are, and a copy of the region's rows; returns how many of each.

    The copy is made from the files just written, so the input is computed once.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    landed = spark.read.schema(df.schema).parquet(path)
    landed.filter(in_region).write.mode("overwrite").option("compression", "snappy").parquet(region_path)
    return landed.count(), spark.read.schema(df.schema).parquet(region_path).count()


def write_rejects(rejects: DataFrame, path: str, run: str, table: str, column: str) -> None:
    """Rejected rows of one load as CSV, in a folder of its own, by the column that rejects them."""
    rejects.write.mode("overwrite").partitionBy(column).csv(f"{path}/{table}/run={run}", header=True)
