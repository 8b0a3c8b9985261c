"""Data checks: reports as DataFrames, and guards that run one job and raise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardflow.functions import text as tx
from wardflow.schemas import TableSpec


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    """Fail without running a job when columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: columns {missing} are missing; present are {df.columns}")


def any_null(columns) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def invalid_periods(df: DataFrame, column: str) -> DataFrame:
    """Distinct raw values that are no ``yyyyMM`` month, with their row counts."""
    return (
        df.filter(tx.bad_period(column))
        .groupBy(F.col(column).alias("raw_period"))
        .agg(F.count("*").alias("row_count"))
    )


def require_periods(df: DataFrame, column: str, what: str) -> None:
    """Runs a job; fails with up to five distinct examples."""
    examples = [r.raw_period for r in invalid_periods(df, column).orderBy("raw_period").limit(5).collect()]
    if examples:
        raise ValueError(f"{what}: periods that are no yyyyMM month, for example {examples}")


def scope_report(df: DataFrame, condition: Column) -> DataFrame:
    """Row counts before and after a filter, in one pass."""
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(condition).alias("rows_after"),
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def null_key_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows lack a key, in total and per key column."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(any_null(keys)).alias("dropped_rows"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
    )


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def length_marks(limits: dict[str, int]) -> list[Column]:
    """Counts and smallest examples of too long values, as aggregates for one pass."""
    marks = []
    for c, limit in limits.items():
        long = F.length(c) > limit
        marks += [F.count_if(long).alias(f"n_{c}"), F.min(F.when(long, F.col(c))).alias(f"x_{c}")]
    return marks


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """One row per limited column: too long values and the smallest example, from a single pass."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(limit).alias("max_length"),
            F.col(f"n_{c}").alias("violations"),
            F.col(f"x_{c}").alias("example"),
        )
        for c, limit in limits.items()
    ]
    return df.agg(*length_marks(limits)).select(F.inline(F.array(*rows)))


def raise_for_lengths(found: dict, limits: dict[str, int], what: str) -> None:
    """Fails on the outcome of :func:`length_marks`, naming the column, the count and an example."""
    bad = [
        f"{what}.{c}: {found[f'n_{c}']} value(s) longer than {limit}, for example {found[f'x_{c}']!r}"
        for c, limit in limits.items()
        if found[f"n_{c}"]
    ]
    if bad:
        raise ValueError("; ".join(bad))


def require_lengths(df: DataFrame, limits: dict[str, int], what: str) -> None:
    """Runs a job; fails naming the column, the count and an example."""
    if limits:
        raise_for_lengths(df.agg(*length_marks(limits)).first().asDict(), limits, what)


def raw_marks(spec: TableSpec) -> list[Column]:
    """Row count, months that are no ``yyyyMM`` and numbers that are fractional or do not fit, as aggregates."""
    marks = [F.count("*").alias("rows_read")]
    for f in spec.fields_of("period"):
        bad = tx.bad_period(f.source)
        marks += [F.count_if(bad).alias(f"p_{f.source}"), F.min(F.when(bad, F.col(f.source).cast("string"))).alias(f"e_{f.source}")]
    return marks + [F.count_if(tx.bad_integer(f.source)).alias(f"n_{f.source}") for f in spec.fields_of("integer")]


def typed_marks(spec: TableSpec) -> list[Column]:
    """As :func:`raw_marks`, and rows without a complete key, from the columns that a checked cleaning gives."""
    marks = [F.count("*").alias("rows_read"), F.count_if(any_null(spec.key)).alias("null_keys")]
    for f in spec.fields_of("period"):
        bad = F.length(f.name) != 6
        marks += [F.count_if(bad).alias(f"p_{f.source}"), F.min(F.when(bad, F.col(f"_raw_{f.name}"))).alias(f"e_{f.source}")]
    return marks + [F.count_if(f"_bad_{f.name}").alias(f"n_{f.source}") for f in spec.fields_of("integer")]


def raise_for_raw(found: dict, spec: TableSpec) -> None:
    """Fails on the outcome of :func:`raw_marks` or :func:`typed_marks`."""
    for f in spec.fields_of("period"):
        if found[f"p_{f.source}"]:
            raise ValueError(
                f"{spec.name}: {found[f'p_{f.source}']} periods that are no yyyyMM month, for example {found[f'e_{f.source}']!r}"
            )
    bad = {f.source: found[f"n_{f.source}"] for f in spec.fields_of("integer") if found[f"n_{f.source}"]}
    if bad:
        raise ValueError(f"{spec.name}: values that are no whole 32-bit number: {bad}")


def require_table(raw: DataFrame, spec: TableSpec) -> None:
    """All guards on the raw rows of one table, from a single pass."""
    require_columns(raw, [f.source for f in spec.fields], spec.name)
    raise_for_raw(raw.agg(*raw_marks(spec)).first().asDict(), spec)


def split_orphans(df: DataFrame, column: str, domain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a code outside the domain is rejected, a missing code passes."""
    known = domain.select(column).distinct()
    rejected = df.join(known, column, "left_anti").filter(F.col(column).isNotNull()).select(*df.columns)
    marked = df.join(known.withColumn("_known", F.lit(True)), column, "left")
    accepted = marked.filter(F.col("_known") | F.col(column).isNull()).select(*df.columns)
    return accepted, rejected


def orphan_summary(rejected: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent rejected codes."""
    return (
        rejected.groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc(column))
        .limit(n)
    )


def date_inconsistencies(df: DataFrame, admit: str, discharge: str, days: str) -> DataFrame:
    """Rows discharged before admission and rows with negative days."""
    return df.agg(
        F.count_if(F.col(discharge) < F.col(admit)).alias("discharge_before_admit"),
        F.count_if(F.col(days) < 0).alias("negative_days"),
    )
