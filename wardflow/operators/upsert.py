"""Insert-or-update by primary key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows with the batch laid over them.

    Rows of the batch replace the non-key columns of the stored row with the same key or are
    added; columns the batch does not bring keep the stored value.
    """
    new = batch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in batch.columns if c not in keys])
    joined = stored.join(new.withColumn("_in_batch", F.lit(True)), list(keys), "full_outer")

    def merged(c):
        if c in keys or c not in batch.columns:
            return F.col(c)
        return F.when(F.col("_in_batch"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) for c in stored.columns])
