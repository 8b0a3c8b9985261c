"""Newly landed files, upserted once each."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from wardflow.plans.load import load
from wardflow.schemas import TableSpec
from wardflow.sources import landed


def ingest_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    spec: TableSpec,
    warehouse: str,
    checkpoint: str,
    consolidate: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a run that upserts every file not seen by earlier runs, then stops.

    Rows carry the file and row they come from, so the last one of a key is the last landed. Each batch is a load of its
    own name, so its rejects stay beside those of other batches, and a repeated batch replaces its own. Whether missing
    bed quantities become 0 depends on repeats within a batch, hence on how files are cut into batches.

    The checkpoint remembers files, replacing "skip what is already collected"; a batch that is
    repeated after a failure, or a month that is landed again late, upserts to the same rows.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    stream = f"{spec.name}-{zlib.crc32(checkpoint.encode()):08x}"

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        load(batch.sparkSession, {spec.name: consolidate(batch)}, warehouse, run=f"{stream}-{batch_id:08d}")

    return (
        landed.with_position(reader.parquet(path))
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
