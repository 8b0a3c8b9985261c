"""Summaries of fixed size that add up: distinct counts, quantiles and frequent values.

A summary is kept per small group, such as a facility and month, and merged to any coarser group or longer span without
reading rows again. Exact forms of the same measures are in :mod:`wardflow.operators.profile`; each summary here states the
error that it keeps to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

LG_K = 14
QUANTILE_K = 400
TRACKED = 8192


# --- distinct counts ------------------------------------------------------------------------


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error of an estimate, three standard deviations."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, keys: list[str], counted: str, lg_k: int = LG_K) -> DataFrame:
    """row_count and sketch of the distinct values of ``counted`` per group; missing keys form no group."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("row_count"), F.hll_sketch_agg(counted, lg_k).alias("sketch"))


def distinct_over(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """row_count and distinct_estimate per coarser group."""
    return sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate")
    )


# --- quantiles ------------------------------------------------------------------------------


def rank_error(k: int = QUANTILE_K) -> float:
    """Error of a quantile's rank as a share of all values, twice what nearly all estimates keep to."""
    return 2 * 2.296 / k**0.9021


def _kind(df: DataFrame, value: str) -> str:
    return "bigint" if isinstance(df.schema[value].dataType, T.IntegralType) else "double"


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = QUANTILE_K) -> DataFrame:
    """value_count and sketch of the values per group; missing keys form no group, missing values do not count."""
    kind = _kind(df, value)
    number = F.col(value).cast(kind)
    agg = getattr(F, f"kll_sketch_agg_{kind}")
    return df.dropna(subset=[*keys, value]).groupBy(*keys).agg(F.count("*").alias("value_count"), agg(number, k).alias("sketch"))


def quantiles_over(sketches: DataFrame, keys: list[str], probs, kind: str, k: int = QUANTILE_K) -> DataFrame:
    """value_count and q, the estimated quantiles, per coarser group; kind is bigint or double, as the sketches' values."""
    merge, quantile = (getattr(F, f"kll_{f}_{kind}") for f in ("merge_agg", "sketch_get_quantile"))
    merged = sketches.groupBy(*keys).agg(F.sum("value_count").alias("value_count"), merge("sketch", k).alias("sketch"))
    return merged.select(*keys, "value_count", F.array(*[quantile("sketch", F.lit(float(p))) for p in probs]).alias("q"))


# --- frequent values ------------------------------------------------------------------------


def frequency_error(rows: int, tracked: int = TRACKED) -> float:
    """A value that occurs more often than that among the rows is among the candidates."""
    return 3.5 / tracked * rows


def most_frequent(df: DataFrame, key: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """The n most frequent values with their exact counts, ties by value; missing values do not count.

    A sketch names candidates, ``tracked`` at most, and a second pass counts them without a shuffle of all values. No
    value is missed if the candidates' counts add up to all rows, or if the n-th count is above the sketch's error, for
    then no other value reaches it. Else the values have no clear leaders, and all are counted.
    """
    known, spark = df.filter(F.col(key).isNotNull()), df.sparkSession
    order = [F.desc("row_count"), F.asc(key)]
    named = known.agg(
        F.expr(f"transform(approx_top_k({key}, {tracked}, {tracked}), i -> i.item)").alias("items"), F.count("*").alias("rows")
    ).first()
    of_key = T.StructType([T.StructField(key, df.schema[key].dataType)])
    candidates = spark.createDataFrame([(x,) for x in named["items"] or []], of_key)
    counts = known.join(F.broadcast(candidates), key, "left_semi").groupBy(key).agg(F.count("*").alias("row_count"))
    held = counts.collect()
    nth = sorted((r["row_count"] for r in held), reverse=True)[n - 1 : n]
    if sum(r["row_count"] for r in held) == named["rows"] or nth and nth[0] > frequency_error(named["rows"], tracked):
        return spark.createDataFrame(held, counts.schema).orderBy(*order).limit(n)
    return known.groupBy(key).agg(F.count("*").alias("row_count")).orderBy(*order).limit(n)
