"""Profiles of one table: counts, shares, distributions and extremes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wardflow.functions.numbers import clipped, deviation, ratio, rounded, total

PERCENTS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- counting -------------------------------------------------------------------------------


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per value; a missing value is no group."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count")).orderBy(key)


def category_share(df: DataFrame, *columns: str) -> DataFrame:
    """Rows and percentage per value of each column, missing values included, from one pass over the table.

    The totals come from the counted groups, in a window over the values of one column.
    """
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in columns]
    counts = df.select(F.inline(F.array(*pairs))).groupBy("column_name", "category").agg(F.count("*").alias("row_count"))
    rows = F.sum("row_count").over(Window.partitionBy("column_name"))
    return counts.withColumn("pct", rounded(ratio("row_count", rows, 100), 4))


def distinct_share(df: DataFrame, key: str, counted: str) -> DataFrame:
    """Distinct values per group as a share of the distinct values overall (not of their sum)."""
    overall = df.agg(F.count_distinct(counted)).scalar()
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count_distinct(counted).alias("distinct_count"))
        .withColumn("pct", rounded(ratio("distinct_count", overall, 100), 4))
    )


def distinct_by_month(df: DataFrame, day: str, counted: str) -> DataFrame:
    return (
        df.filter(F.col(day).isNotNull())
        .groupBy(F.trunc(day, "MM").alias("month_start"))
        .agg(F.count_distinct(counted).alias("distinct_count"))
        .orderBy("month_start")
    )


def distinct_total(df: DataFrame, column: str, relative_error: float | None = None) -> DataFrame:
    """Number of distinct values; ``relative_error`` asks for the constant-memory estimate instead."""
    count = F.approx_count_distinct(column, relative_error) if relative_error else F.count_distinct(column)
    return df.agg(count.alias("distinct_count"))


def repeat_histogram(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur once, twice, and so on."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("repeats"))
        .groupBy("repeats")
        .agg(F.count("*").alias("key_count"))
        .orderBy("repeats")
    )


def most_frequent(df: DataFrame, key: str, n: int) -> DataFrame:
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), F.asc(key)).limit(n)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows; Spark keeps n rows per task and merges those. Order must break ties."""
    return df.orderBy(*order).limit(n)


# --- whole tables ---------------------------------------------------------------------------


def table_shape(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def null_profile(df: DataFrame, name: str) -> DataFrame:
    """Missing values per column with share and type, from one pass over the table."""
    fields = df.schema.fields
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in fields])
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("null_count"),
            rounded(ratio(f.name, "_rows", 100), 4).alias("null_pct"),
            F.col("_rows").alias("row_count"),
        )
        for f in fields
    ]
    return counts.select(F.inline(F.array(*rows))).orderBy(F.desc("null_pct"), F.asc("column_name"))


def value_range(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Smallest and largest value per column, as text."""
    ends = df.agg(*[f(c).cast("string").alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(f"min_{c}").alias("min_value"),
            F.col(f"max_{c}").alias("max_value"),
        )
        for c in columns
    ]
    return ends.select(F.inline(F.array(*rows)))


# --- distributions --------------------------------------------------------------------------
#
# Distributions start from one row per value and its count, which collapses before the shuffle where values repeat, hot
# groups included. Exact percentiles are found by rank: values are cut into ranges by a sketch of fixed size, the counts
# of the ranges are added up, and only the values of the ranges that hold a wanted rank are numbered, at most two ranges
# for each percentile. So no task holds all values, and most values are not sorted at all. For columns known to have few distinct values, such as days or ages, ``few_values`` does that in a single buffer.

RANGES = 64


def _is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _is_narrow(df: DataFrame, column: str) -> bool:
    """Whole numbers whose squares stay exact in sums over any number of rows."""
    return isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType))


def _number(df: DataFrame, column: str) -> Column:
    """The value as it is counted: whole numbers as long, all others as double, never cut off."""
    return F.col(column).cast("long" if _is_whole(df, column) else "double")


def value_counts(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    return (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, _number(df, value).alias("v")).agg(F.count("*").alias("n"))
    )


def weighted_percentiles(probs) -> Column:
    """Exact percentiles of ``v`` with weight ``n``, interpolated; holds one entry per distinct value."""
    return F.percentile("v", F.array(*[F.lit(float(p)) for p in probs]), F.col("n"))


def ranked_percentiles(counts: DataFrame, keys: list[str], probs, ranges: int = RANGES, few_groups: bool = False) -> DataFrame:
    """``keys`` and ``p``, the interpolated percentiles of ``v`` with weight ``n``, found by rank.

    More ``ranges`` make each smaller, for columns of very many distinct values. ``few_groups`` is for keys whose number a
    parameter bounds: their marks are broadcast, as a join by shuffle would put a group's values into one task.
    """
    small = F.broadcast if few_groups else (lambda df: df)
    cuts = F.approx_percentile("v", F.array(*[F.lit(k / ranges) for k in range(1, ranges)])).alias("cuts")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    on = reduce(lambda x, y: x & y, same, F.lit(True))
    marks = counts.groupBy(*keys).agg(cuts, F.sum("n").alias("total"))
    if keys:
        marked = counts.alias("a").join(small(marks).alias("b"), on).select(*[f"a.{k}" for k in keys], "v", "n", "total", "cuts")
    else:
        whole = marks.select(F.struct("total", "cuts")).scalar()
        marked = counts.select("v", "n", whole["total"].alias("total"), whole["cuts"].alias("cuts"))
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    ranged = marked.select(*keys, "v", "n", "total", below.alias("range"))
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*keys, "range").agg(F.sum("n").alias("m"), F.max("total").alias("total")).select(
        *keys, "range", "m", "total", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start")
    )
    places = [(F.col("total").cast("double") - 1) * float(q) for q in probs]
    wanted = [r for place in places for r in (F.floor(place), F.ceil(place))]
    holds = reduce(lambda x, y: x | y, [(F.col("start") <= r) & (r < F.col("start") + F.col("m")) for r in wanted])
    needed = starts.filter(holds).select(*keys, "range", "start")
    placed = ranged.alias("a").join(small(needed).alias("b"), on & (F.col("a.range") == F.col("b.range")))
    placed = placed.select(*[f"a.{k}" for k in keys], "a.range", "v", "n", "total", "start")
    upto = F.col("start") + F.sum("n").over(Window.partitionBy(*keys, "range").orderBy("v"))
    numbered = placed.withColumn("upto", upto).withColumn("first", F.col("upto") - F.col("n"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("upto")), F.col("v").cast("double")))

    ends, made = [], []
    for k, q in enumerate(probs):
        place = F.col("total").cast("double") - 1
        place = place * float(q)
        ends += [at(F.floor(place)).alias(f"lo{k}"), at(F.ceil(place)).alias(f"hi{k}"), F.max(place - F.floor(place)).alias(f"w{k}")]
        made.append(F.col(f"lo{k}") + (F.col(f"hi{k}") - F.col(f"lo{k}")) * F.col(f"w{k}"))
    return numbered.groupBy(*keys).agg(*ends).select(*keys, F.array(*made).alias("p"))


def percentiles_of(counts: DataFrame, keys: list[str], probs, few_values: bool, few_groups: bool = False) -> DataFrame:
    if few_values:
        return counts.groupBy(*keys).agg(weighted_percentiles(probs).alias("p"))
    return ranked_percentiles(counts, keys, probs, few_groups=few_groups)


def _moments() -> list[Column]:
    v = F.col("v").cast("decimal(10,0)")
    return [
        F.sum("n").alias("n_values"),
        F.sum(F.col("v") * F.col("n")).alias("sum_v"),
        F.sum((v * v * F.col("n")).cast("decimal(38,0)")).alias("squares"),
        F.min("v").alias("min_v"),
        F.max("v").alias("max_v"),
    ]


def _described(moments: DataFrame, percentiles: DataFrame, mean: Column, std: Column, probs) -> DataFrame:
    return moments.join(percentiles, "column_name", "left").select(
        "column_name",
        F.col("n_values").alias("value_count"),
        rounded(mean, 4).alias("mean"),
        rounded(std, 4).alias("std"),
        F.col("min_v").alias("min"),
        *[rounded(F.col("p")[i], 4).alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)],
        F.col("max_v").alias("max"),
    )


def describe(
    df: DataFrame, columns: list[str], probs=PERCENTS, approximate: bool = False, few_values: bool = False
) -> DataFrame:
    """Count, mean, sample deviation, extremes and percentiles of each column.

    Extremes are whole numbers if all columns are. ``approximate`` replaces the exact percentiles by sketches of fixed
    size; ``few_values`` is for columns with few distinct values.
    """
    narrow = all(_is_narrow(df, c) for c in columns)
    kind = "long" if all(_is_whole(df, c) for c in columns) else "double"
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("v")) for c in columns]
    long = df.select(F.inline(F.array(*pairs))).filter(F.col("v").isNotNull())
    counts = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    if approximate:
        sketch = F.approx_percentile("v", F.array(*[F.lit(float(p)) for p in probs]))
        percentiles = long.groupBy("column_name").agg(sketch.alias("p"))
    else:
        percentiles = percentiles_of(counts, ["column_name"], probs, few_values, few_groups=True)
    if narrow:
        moments = counts.groupBy("column_name").agg(*_moments())
        std = deviation("n_values", "sum_v", "squares", sample=True)
        return _described(moments, percentiles, ratio("sum_v", "n_values"), std, probs)
    v = F.col("v").cast("double")
    moments = long.groupBy("column_name").agg(
        F.count("v").alias("n_values"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min("v").alias("min_v"), F.max("v").alias("max_v")
    )
    return _described(moments, percentiles, F.col("mean"), F.col("std"), probs)


def central_tendency(df: DataFrame, column: str, few_values: bool = False) -> DataFrame:
    """Mean, median, smallest mode, sample deviation and coefficient of variation."""
    counts = value_counts(df, column, [])
    top = F.min(F.struct((-F.col("n")).alias("rank"), F.col("v"))).alias("top")
    if _is_narrow(df, column):
        measures = counts.agg(*_moments(), top)
        mean, sd = ratio("sum_v", "n_values"), deviation("n_values", "sum_v", "squares", sample=True)
    else:
        v = F.col(column).cast("double")
        ends = counts.agg(top).scalar()
        measures = df.agg(F.avg(v).alias("mean_v"), F.stddev_samp(v).alias("std_v")).withColumn("top", ends)
        mean, sd = F.col("mean_v"), F.col("std_v")
    median = percentiles_of(counts, [], [0.5], few_values).select(F.col("p")[0]).scalar()
    return measures.select(
        rounded(mean, 4).alias("mean"),
        rounded(median, 4).alias("median"),
        F.col("top.v").alias("mode"),
        rounded(sd, 4).alias("std"),
        rounded(ratio(sd, F.nullif(mean, F.lit(0.0)), 100), 4).alias("variation_pct"),
    )


def grouped_distribution(
    df: DataFrame, key: str, value: str, counted: str, probs, few_values: bool = False
) -> DataFrame:
    """Per group: distinct ``counted``, rows, sum, mean and percentiles of ``value``.

    Distinct counting and percentiles need different shuffles; each side comes out with one row
    per group and they are joined on it.
    """
    keyed = df.filter(F.col(key).isNotNull())
    distinct = keyed.groupBy(key).agg(F.count_distinct(counted).alias("distinct_count"))
    counts = keyed.groupBy(key, _number(df, value).alias("v")).agg(F.count("*").alias("n"))
    known = F.when(F.col("v").isNotNull(), F.col("n"))
    sums = [
        F.sum("n").alias("row_count"),
        total(F.col("v") * F.col("n")).alias("sum_v") if _is_whole(df, value) else F.coalesce(F.sum(F.col("v") * F.col("n")), F.lit(0.0)).alias("sum_v"),
        F.sum(known).alias("n_values"),
    ]
    if few_values:
        spread = counts.groupBy(key).agg(*sums, weighted_percentiles(probs).alias("p"))
    else:
        ranks = ranked_percentiles(counts.filter(F.col("v").isNotNull()), [key], probs)
        spread = counts.groupBy(key).agg(*sums).join(ranks, key, "left")
    return distinct.join(spread, key).select(
        key,
        "distinct_count",
        "row_count",
        "sum_v",
        rounded(ratio("sum_v", "n_values"), 4).alias("mean"),
        *[rounded(F.col("p")[i], 4).alias(f"p{round(p * 100):02d}") for i, p in enumerate(probs)],
    )


def histogram(df: DataFrame, column: str, bins: int, upper: int | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; null is left out.

    ``upper`` clips values first. Empty bins are not listed.
    """
    counts = value_counts(df, column, [])
    if upper is not None:
        counts = counts.withColumn("v", clipped("v", upper))
    ends = counts.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    lo, hi = ends["lo"].cast("double"), ends["hi"].cast("double")
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(F.lit(1.0))
    return (
        counts.select(
            F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).cast("int").alias("bin"),
            "n",
            lo.alias("lo"),
            width.alias("width"),
        )
        .groupBy("bin", "lo", "width")
        .agg(F.sum("n").alias("row_count"))
        .select(
            "bin",
            rounded(F.col("lo") + F.col("bin") * F.col("width"), 4).alias("bin_from"),
            rounded(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 4).alias("bin_to"),
            "row_count",
        )
        .orderBy("bin")
    )


def box_plot(
    df: DataFrame, column: str, cut: float | None = None, reach: float = 1.5, few_values: bool = False
) -> DataFrame:
    """Quartiles, whiskers (furthest value within ``reach`` IQR) and outliers.

    ``cut`` first drops the values above that percentile.
    """
    counts = value_counts(df, column, [])
    if cut is not None:
        counts = counts.filter(F.col("v") <= percentiles_of(counts, [], [cut], few_values).select(F.col("p")[0]).scalar())
    quartiles = percentiles_of(counts, [], [0.25, 0.5, 0.75], few_values).scalar()
    q1, q3 = quartiles[0], quartiles[2]
    low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    inside = F.col("v").between(low, high)
    return counts.agg(
        F.sum("n").alias("value_count"),
        rounded(F.first(quartiles[0]), 4).alias("q1"),
        rounded(F.first(quartiles[1]), 4).alias("median"),
        rounded(F.first(quartiles[2]), 4).alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).cast("long").alias("outliers"),
    )


# --- stays ----------------------------------------------------------------------------------


def computed_days(admit: str, discharge: str) -> Column:
    return F.datediff(F.col(discharge), F.col(admit))


def stay_consistency(df: DataFrame, admit: str, discharge: str, reported: str) -> DataFrame:
    """Reported days against days by dates; a missing side counts as unknown, not as different."""
    gap = F.col(reported) - computed_days(admit, discharge)
    verdict = F.when(gap == 0, "equal").when(gap != 0, "different").otherwise("unknown")
    return df.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("row_count"))


def stay_difference_histogram(df: DataFrame, admit: str, discharge: str, reported: str) -> DataFrame:
    gap = F.col(reported) - computed_days(admit, discharge)
    return group_counts(df.select(gap.alias("difference")), "difference")


# --- beds -----------------------------------------------------------------------------------


def bed_sums(df: DataFrame, keys: list[str], facility: str | None = None) -> DataFrame:
    """Beds per group, with the number of facilities when asked; missing keys form no group."""
    count = [F.count_distinct(facility).alias("facilities")] if facility else []
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(*count, total("beds_total").alias("beds_total"), total("beds_public").alias("beds_public"))
    )


def bed_totals(df: DataFrame) -> DataFrame:
    return df.agg(total("beds_total").alias("beds_total"), total("beds_public").alias("beds_public"))


def top_types_trend(df: DataFrame, n: int = 10) -> DataFrame:
    """Monthly beds of the n bed types with the most public beds.

    The list of types is one row per kept type, at most n.
    """
    best = top(bed_sums(df, ["bed_type"]), n, F.desc("beds_public"), F.asc("bed_type")).select("bed_type")
    return bed_sums(df, ["period", "bed_type"]).join(F.broadcast(best), "bed_type", "left_semi")
