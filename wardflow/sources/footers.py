"""What the footers of Parquet files tell: layouts, rows and extremes, read by tasks without reading any rows.

Files are listed by Spark. Each task opens the footers of its files; layouts that many files share are reduced by Spark
before the driver sees them. Stores that Arrow cannot open are read by Spark instead, with the same results.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_type

#: Key under which Spark keeps its own schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: Files whose footers one task reads.
FILES_PER_TASK = 64
UNSIGNED = {pa.uint8(): T.ShortType(), pa.uint16(): T.IntegerType(), pa.uint32(): T.LongType(), pa.uint64(): T.DecimalType(20, 0)}


def located(uri: str) -> tuple[fs.FileSystem, str]:
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return fs.FileSystem.from_uri(uri)


def can_open(uri: str) -> bool:
    """Whether Arrow knows the file system of a path."""
    try:
        located(uri)
    except (pa.ArrowException, OSError):
        return False
    return True


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and length of the Parquet files behind paths and globs; only the listing is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter(~name.startswith("_") & ~name.startswith("."))


def layout(footer: pq.FileMetaData) -> T.StructType:
    """The columns of a file as Spark reads them."""
    kept = (footer.metadata or {}).get(SPARK_SCHEMA)
    if kept:
        return T.StructType.fromJson(json.loads(kept))
    old_times = {footer.schema.column(k).path for k in range(footer.num_columns) if footer.schema.column(k).physical_type == "INT96"}
    fields = []
    for f in footer.schema.to_arrow_schema():
        kind = UNSIGNED.get(f.type) or from_arrow_type(f.type)
        fields.append(T.StructField(f.name, T.TimestampType() if f.name in old_times else kind))
    return T.StructType(fields)


def _bare(schema: T.StructType) -> str:
    """A layout without what does not matter for reading: order, nullability and comments."""
    return json.dumps(sorted([f.name, f.dataType.simpleString()] for f in schema.fields))


def _extremes(footer: pq.FileMetaData, columns: list[str]) -> list[tuple[str, str | None, str | None, int | None, bool]]:
    """Per column its least and greatest value as text, its nulls, and whether they are exact: told by every row group."""
    place = {footer.schema.column(k).path: k for k in range(footer.num_columns)}
    made = []
    for name in columns:
        if name not in place:
            made.append((name, None, None, footer.num_rows, True))
            continue
        kind = footer.schema.column(place[name]).physical_type
        parts = [footer.row_group(g).column(place[name]) for g in range(footer.num_row_groups)]
        stats = [p.statistics for p in parts]
        # Ends of texts may be cut off, those of fractions hide NaN.
        sure = kind in ("INT32", "INT64", "BOOLEAN") and all(s is not None and s.has_null_count for s in stats)
        full = [s for s, p in zip(stats, parts) if s is not None and s.null_count < p.num_values]
        sure = sure and all(s.has_min_max for s in full)
        if not sure:
            made.append((name, None, None, None, False))
            continue
        ends = (str(min(s.min for s in full)), str(max(s.max for s in full))) if full else (None, None)
        made.append((name, *ends, sum(s.null_count for s in stats), True))
    return made


def footers(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """path, row_count, layout and ends (column_name, least, greatest, nulls, exact) of each file."""
    wanted = columns or []

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column(0).to_pylist():
                files, at = located(path)
                with files.open_input_file(at) as f:
                    footer = pq.read_metadata(f)
                ends = [dict(zip(("column_name", "least", "greatest", "nulls", "exact"), e)) for e in _extremes(footer, wanted)]
                made.append({"path": path, "row_count": footer.num_rows, "layout": _bare(layout(footer)), "ends": ends})
            if made:
                yield pa.RecordBatch.from_pylist(made, schema)

    end = [("column_name", pa.string()), ("least", pa.string()), ("greatest", pa.string()), ("nulls", pa.int64()), ("exact", pa.bool_())]
    schema = pa.schema([("path", pa.string()), ("row_count", pa.int64()), ("layout", pa.string()), ("ends", pa.list_(pa.struct(end)))])
    ddl = "path string, row_count long, layout string, ends array<struct<column_name:string,least:string,greatest:string,nulls:long,exact:boolean>>"
    files = listed(spark, paths)
    tasks = max(1, -(-files.count() // FILES_PER_TASK))
    return files.select("path").repartition(tasks, "path").mapInArrow(read, ddl)


# --- layouts ---------------------------------------------------------------------------------


def fields_of(layout_json: str) -> dict[str, str]:
    return dict(json.loads(layout_json))


def compatible(layouts: list[str]) -> list[tuple[set[str], dict[str, str]]]:
    """Layouts in as few groups as a greedy choice finds in which no column has two types, with the columns of each group.

    Layouts with most columns go first, so those that only lack columns join one that has them.
    """
    groups: list[tuple[set[str], dict[str, str]]] = []
    for one in sorted(layouts, key=lambda x: (-len(fields_of(x)), x)):
        fields = fields_of(one)
        for members, held in groups:
            if all(held.get(name, kind) == kind for name, kind in fields.items()):
                members.add(one)
                held.update(fields)
                break
        else:
            groups.append(({one}, dict(fields)))
    return groups


def scans(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Paths and schema of the scans that read all files: one for each group of layouts without contradictions.

    A folder whose files belong to one group is named as a whole. The schema is known, so Spark reads no footers for it.
    """
    found = footers(spark, paths).select("path", "layout").cache()
    try:
        layouts = [r[0] for r in found.select("layout").distinct().collect()]
        groups = compatible(layouts)
        number = {one: k for k, (members, _) in enumerate(groups) for one in members}
        if len(groups) == 1 and all("*" not in p for p in paths):
            placed = {0: list(paths)}
        else:
            group = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])[F.col("layout")] if number else F.lit(0)
            files = found.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), group.alias("g"))
            folders = files.groupBy("folder").agg(F.min("g").alias("g"), (F.min("g") < F.max("g")).alias("mixed"))
            of_mixed = files.join(folders.filter("mixed").select("folder"), "folder", "left_semi").select("path", "g")
            named = folders.filter(~F.col("mixed")).select(F.col("folder").alias("path"), "g").unionByName(of_mixed)
            placed = {}
            for path, g in named.orderBy("path").collect():
                placed.setdefault(g, []).append(path)
    finally:
        found.unpersist()
    return [(placed[k], T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in sorted(f.items())])) for k, (_, f) in enumerate(groups)]


# --- answers ---------------------------------------------------------------------------------


def row_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and row_count of each file."""
    if can_open(paths[0]):
        return footers(spark, paths).select("path", "row_count")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    return listed(spark, paths).join(counts, "path", "left").select("path", F.coalesce("n", F.lit(0)).alias("row_count"))


def table_shapes(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """table_name, row_count and column_count of stored tables, given by name and path."""
    made = []
    for name, path in tables.items():
        columns = len(spark.read.parquet(path).columns)
        rows = row_counts(spark, [path]).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
        made.append(rows.select(F.lit(name).alias("table_name"), "row_count", F.lit(columns).alias("column_count")))
    return reduce(DataFrame.unionByName, made)


def value_ranges(spark: SparkSession, path: str, name: str, columns: list[str]) -> DataFrame:
    """table_name, column_name, least and greatest value as text, nulls and rows of each column of a stored table.

    Whole numbers, dates and booleans are told by the footers; files in which a column's statistics are missing or need
    not be exact are read, those columns alone.
    """
    kinds = dict(spark.read.parquet(path).dtypes)

    if can_open(path):
        told = footers(spark, [path], columns).select("path", "row_count", F.inline("ends"))
        sure = told.filter("exact").select("column_name", "least", "greatest", "nulls", "row_count")
        unsure = told.filter(~F.col("exact")).select("path", "column_name").distinct().collect()
    else:
        unsure = [(path, c) for c in columns]
        sure = spark.createDataFrame([], "column_name string, least string, greatest string, nulls long, row_count long")
    parts = [sure]
    for column in sorted({c for _, c in unsure}):
        rows = spark.read.parquet(*sorted({p for p, c in unsure if c == column})).select(F.col(column).alias("v"))
        ends = rows.agg(F.min("v").cast("string").alias("least"), F.max("v").cast("string").alias("greatest"), F.count_if(F.col("v").isNull()).alias("nulls"), F.count("*").alias("row_count"))
        parts.append(ends.select(F.lit(column).alias("column_name"), "least", "greatest", "nulls", "row_count"))
    every = reduce(DataFrame.unionByName, parts)
    columns_of = [
        every.filter(F.col("column_name") == c).agg(
            F.min(F.col("least").cast(kinds[c])).cast("string").alias("min_value"),
            F.max(F.col("greatest").cast(kinds[c])).cast("string").alias("max_value"),
            F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_count"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        ).select(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), "min_value", "max_value", "null_count", "row_count")
        for c in columns
    ]
    return reduce(DataFrame.unionByName, columns_of)
