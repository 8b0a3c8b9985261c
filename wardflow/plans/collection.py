"""Which expected months were landed, and how complete they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardflow.sources import footers


def period_ledger(expected: DataFrame, landed: DataFrame, in_region: Column) -> DataFrame:
    """Expected months with landed rows, rows of the region, and a status.

    A landed month whose region part is empty is marked, as it deserves a look.
    """
    counts = landed.groupBy("period").agg(
        F.count("*").alias("landed_rows"), F.count_if(in_region).alias("region_rows")
    )
    zero = F.lit(0).cast("long")
    rows = expected.select("period").join(counts, "period", "left").withColumns(
        {"landed_rows": F.coalesce("landed_rows", zero), "region_rows": F.coalesce("region_rows", zero)}
    )
    status = F.when(F.col("landed_rows") == 0, "missing").when(F.col("region_rows") == 0, "region empty")
    return rows.withColumn("status", status.otherwise("landed")).orderBy("period")


def collection_status(expected: DataFrame, landed: DataFrame, done: DataFrame, bad_row: Column) -> DataFrame:
    """Tally of expected months: already done, not available, landed with bad rows, landed well."""
    counts = landed.groupBy("period").agg(F.count_if(bad_row).alias("bad_rows"))
    known = done.select("period").distinct().withColumn("done", F.lit(True))
    status = (
        F.when(F.col("done"), "skipped")
        .when(F.col("bad_rows").isNull(), "unavailable")
        .when(F.col("bad_rows") > 0, "errors")
        .otherwise("ok")
    )
    return (
        expected.select("period")
        .join(known, "period", "left")
        .join(counts, "period", "left")
        .groupBy(status.alias("status"))
        .agg(F.count("*").alias("periods"))
    )


def landed_months(spark: SparkSession, expected: DataFrame, folder: str) -> DataFrame:
    """Expected months with the rows that landed in ``<folder>/period=<month>``, and a status; only footers are read."""
    period = F.regexp_extract("path", r"/period=(\d{6})/", 1)
    counts = footers.row_counts(spark, [folder]).groupBy(period.alias("period")).agg(F.sum("row_count").alias("landed_rows"))
    rows = expected.select("period").join(counts, "period", "left")
    status = F.when(F.col("landed_rows").isNull(), "missing").when(F.col("landed_rows") == 0, "empty").otherwise("landed")
    return rows.select("period", F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"), status.alias("status"))
