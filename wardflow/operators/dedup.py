"""One row per key, and profiles of repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardflow.functions.numbers import total


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the greatest ``order`` values per key (null lowest).

    The remaining columns break ties, so the result does not depend on row placement. Rows are sorted once, after their
    shuffle. Where a key may hold a large share of the rows, use :func:`keep_last_hot`.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *rest)])
    # A row without a better one before it: unlike a limit on ranks, it makes Spark sort only after the shuffle.
    better = df.withColumn("_better", F.lag(F.lit(True)).over(best_first))
    return better.filter(F.col("_better").isNull()).select(*df.columns)


def keep_last_hot(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As :func:`keep_last`, with repeated keys reduced before the shuffle at the price of a second sort."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("best"))
    return best.select(*keys, "best.*").select(*df.columns)


def latest_value(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Latest non-null value per key."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias(value))


def first_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Smallest value per key; a guard where the key is expected to be unique already."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def sum_repeats(df: DataFrame, keys: list[str], sums: list[str], firsts: list[str], order: str) -> DataFrame:
    """Drop exact copies, then add up the quantities of rows that still share a key.

    ``firsts`` keep their first non-null value in ``order``. Missing quantities turn into 0 only
    when some key of the batch really repeats; a batch without repeats passes through as it is.
    """
    merged = merged_repeats(df, keys, sums, firsts, order)
    repeats = merged.agg(F.coalesce(F.max("_rows") > 1, F.lit(False))).scalar()
    return with_quantities(merged, sums, repeats).select(*keys, *firsts, *sums)


def merged_repeats(df: DataFrame, keys: list[str], sums: list[str], firsts: list[str], order: str) -> DataFrame:
    """The sums of :func:`sum_repeats` before missing ones are filled, with ``_rows`` merged into each."""
    once = df.groupBy(*keys, *firsts, *sums).agg(F.min(order).alias("_order"))
    return once.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("_order", c))).alias(c) for c in firsts],
        *[F.sum(c).cast("int").alias(c) for c in sums],
    )


def with_quantities(merged: DataFrame, sums: list[str], repeats: Column) -> DataFrame:
    """Missing quantities as 0 where the batch has repeated keys."""
    return merged.withColumns({c: F.when(repeats, F.coalesce(F.col(c), F.lit(0))).otherwise(F.col(c)) for c in sums})


def row_digest(columns: list[str]) -> Column:
    """256 bits that tell rows apart: each value with its length, and a mark of its own for null."""
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and rows that repeat an earlier one; only digests of the rows are shuffled."""
    groups = df.groupBy(row_digest(df.columns).alias("row")).agg(F.count("*").alias("n"))
    return groups.agg(
        total("n").alias("row_count"),
        F.count("*").alias("distinct_rows"),
        total(F.col("n") - 1).alias("duplicate_rows"),
    )
