"""Mixing sources to target weights by weighted fair queueing.

Every source serves its documents in a shuffled order, each with a virtual finish time: the words its source has served
up to its end, divided by the source's target. All documents are then sorted by that time and the mix takes them until
the total budget is used up. A source whose target exceeds its size serves its documents a second time in the same order.

Running sums are taken in two steps, within ranges of the order and over the ranges, so a source or the mix is never
sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import WORD, checkpointed

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Percent of all words that the mix shall have, and the most passes over one source.
BUDGET_PERCENT, PASSES = 150, 2
#: Rows that one range of a running sum shall hold on average.
RANGE_ROWS = 50_000


def targets(sizes: DataFrame, weights=WEIGHTS, budget_percent: int = BUDGET_PERCENT, passes: int = PASSES) -> DataFrame:
    """source, source_size, docs, target: one row per source.

    The budget is shared by weight; a target stops at `passes` times its source's size and the excess is reshared among
    the others. That ends where the targets are min(cap, level * weight) with one level for all, which follows from the
    sources in the order of cap / weight. There are as many rows here as sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    named = sizes.select("source", "source_size", "docs", weight.cast("long").alias("weight"), (F.col("source_size") * passes).alias("cap"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(every) * (budget_percent / 100)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0))
    left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (budget - capped) / left
    fits = F.when(F.col("cap") >= level * F.col("weight"), level)
    levels = named.withColumn("own_level", fits).withColumn("rank", F.row_number().over(by_ratio))
    first = F.first("own_level", ignorenulls=True).over(
        Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levels.withColumn("level", first).select(
        "source",
        "source_size",
        "docs",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double"))).alias("target"),
    )


def running(rows: DataFrame, groups: list[str], bucket: Column, order: list, out: str) -> DataFrame:
    """rows with the running sum of `words` in the given order within groups; bucket numbers ranges of that order."""
    ranged = rows.withColumn("bucket", bucket)
    sums = ranged.groupBy(*groups, "bucket").agg(F.sum("words").alias("bucket_words"))
    before = Window.partitionBy(*groups).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*groups, "bucket", F.coalesce(F.sum("bucket_words").over(before), F.lit(0)).alias("bucket_start"))
    within = Window.partitionBy(*groups, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = [ranged[c].eqNullSafe(starts[c]) for c in (*groups, "bucket")]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    summed = ranged.withColumn("bucket_sum", F.sum("words").over(within))
    own = [summed[c] for c in rows.columns]
    return summed.join(starts, condition, "left").select(*own, (F.col("bucket_start") + F.col("bucket_sum")).alias(out))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    seed: str = "mix",
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of docs.

    A size is the number of words; a null text has none. The order within a source is that of md5(seed and key), then
    of key and size, so reruns agree however the rows are laid out; a null key hashes as the empty text. Rows that agree
    in all of these are interchangeable. Documents without words take no part and are never taken. A source of null
    names is a source like any other, last by name. An empty table gives an empty result.
    """
    sized = checkpointed(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("shuffled"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    by_source = checkpointed(targets(sizes, weights, budget_percent))
    total, count = by_source.agg(F.sum("source_size"), F.sum("docs")).first()
    budget, ranges = (total or 0) * (budget_percent / 100), max(64, (count or 0) * PASSES // RANGE_ROWS)
    digits = max(2, math.ceil(math.log(ranges, 16)))
    served = running(
        sized.filter(F.col("size") > 0).withColumnRenamed("size", "words"),
        ["source"],
        F.conv(F.substring("shuffled", 1, digits), 16, 10).cast("long"),
        ["shuffled", "doc_id", "words", "row"],
        "served",
    )
    known = by_source.select("source", "source_size", "target")
    targeted = served.alias("a").join(known.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "source_size", "target")
    finish = (F.col("served") + F.col("pass") * F.col("source_size")) / F.col("target")
    queue = targeted.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1)))).withColumn("finish", finish)
    queue = checkpointed(queue.select("row", "doc_id", "source", "shuffled", "pass", "words", "finish"))
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("shuffled"), F.col("doc_id"), F.col("words"), F.col("pass"), F.col("row")]
    mixed = running(queue, [], F.floor(F.col("finish") * ranges), order, "mixed")
    taken = mixed.filter(F.col("mixed") <= budget).groupBy("row").agg(F.sum("words").alias("taken"))
    return (
        sized.join(taken, "row", "left")
        .alias("a")
        .join(by_source.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left")
        .select("doc_id", "a.source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs that the mix takes, with all their columns, each as often as it is taken.

    Rows that agree in key, source and size get the smallest number of copies that the mix gives to one of them.
    """
    verdict = mix(docs, id_col, text_col, source_col, **how)
    key = verdict.groupBy("doc_id", "source", "size").agg(F.min("taken").alias("taken"))
    copies = checkpointed(key.filter("taken > 0").select("doc_id", "source", "size", (F.col("taken") / F.col("size")).cast("int").alias("copies")))
    a, b = docs.alias("a"), copies.alias("b")
    same = (
        F.col(f"a.{id_col}").eqNullSafe(F.col("b.doc_id"))
        & F.col(f"a.{source_col}").eqNullSafe(F.col("b.source"))
        & (F.coalesce(F.regexp_count(F.col(f"a.{text_col}"), F.lit(WORD)), F.lit(0)) == F.col("b.size"))
    )
    taken = a.join(b, same).select("a.*", F.explode(F.sequence(F.lit(1), F.col("b.copies"))).alias("_copy_of_the_mix"))
    return taken.drop("_copy_of_the_mix")
