"""Shapes of physical plans that must not come back."""

import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry

CORPUS = {*entry.corpus.QUERIES, "pipeline"} if entry.corpus else set()
QUERIES = {k: v for k, v in entry.queries().items() if k not in CORPUS}
# Queries that write and read tables before they return.
EAGER = {
    "incremental_ingest", "load_report", "load_rejects", "ingest_drifting_files", "dedup_keep_last", "footer_ledger", "refreshed_occupancy",
    "view_occupancy_month", "view_length_of_stay_month", "view_admissions_month", "view_network_kpis", "warehouse_summary", "warehouse_months",
}
LAZY = sorted(set(QUERIES) - EAGER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_python(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text, bad


@pytest.mark.parametrize(
    "name", ["bed_capacity_monthly", "occupancy_bands", "length_of_stay", "facility_diagnosis", "daily_census"]
)
def test_no_window_over_everything(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Window.*\n[^\n]*Exchange SinglePartition", text)


@pytest.mark.parametrize("name", ["stay_base", "occupied_days_monthly", "admissions_per_bed"])
def test_claims_are_hash_aggregated(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for line in text.splitlines():
        assert not ("SortAggregate" in line and "claim_id" in line)


def test_scope_reaches_the_scan(spark, sf_dir, tmp_path):
    from wardflow import testbed as tb
    from wardflow.operators.beds import capacity_by_month

    tb.beds(spark, sf_dir).write.partitionBy("period").parquet(str(tmp_path / "bed"))
    beds = spark.read.schema(tb.beds(spark, sf_dir).schema).parquet(str(tmp_path / "bed"))
    text = plan(capacity_by_month(beds, tb.SCOPE))
    assert "PartitionFilters: [period" in text and "EqualTo(own_flag,1)" in text


def test_own_beds_are_read_for_the_scope_alone(spark, sf_dir, tmp_path):
    from dataclasses import replace

    from wardflow import testbed as tb
    from wardflow.plans.diagnosis import out_of_scope_share

    w = tb.warehouse(spark, sf_dir)
    w.beds.write.partitionBy("period").parquet(str(tmp_path / "bed"))
    beds = spark.read.schema(w.beds.schema).parquet(str(tmp_path / "bed"))
    assert "PartitionFilters: [period" in plan(out_of_scope_share(replace(w, beds=beds), tb.SETTINGS))


def test_shares_take_one_scan_of_the_claims(spark, tmp_path):
    from wardflow.operators.profile import category_share

    spark.createDataFrame([("a", "x"), ("b", None)], "p string, q string").write.parquet(str(tmp_path / "t"))
    assert plan(category_share(spark.read.parquet(str(tmp_path / "t")), "p", "q")).count("FileScan") == 1


def test_rows_are_not_sorted_before_their_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedup_max_sequence"](spark, sf_dir)).split("== Initial Plan ==")[-1]
    assert "SortAggregate" not in text and "WindowGroupLimit" not in text


def test_rows_made_of_a_small_table_do_not_stay_in_one_task(spark, tmp_path):
    from wardflow import testbed as tb

    rows = spark.range(5_000).selectExpr("id + 1 AS s_suppkey", "concat('S', id) AS s_name", "7L AS s_nationkey")
    rows.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    for made in (tb.raw_beds(spark, str(tmp_path)), tb.facilities(spark, str(tmp_path))):
        counts = made.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert len(counts) > 1 and max(counts) < 2 * tb.MADE_PER_TASK


def test_cleaning_is_not_repeated_for_missing_keys(spark, sf_dir):
    for name in ("clean_admissions", "clean_beds", "load_summary"):
        filters = [line for line in plan(QUERIES[name](spark, sf_dir)).splitlines() if "Filter" in line]
        assert filters and not any("transform(" in line for line in filters), name


def test_summary_makes_the_keys_of_a_claim_once(spark, sf_dir):
    text = plan(QUERIES["load_summary"](spark, sf_dir))
    assert "transform(" not in text  # interpreted for every row
    assert not any("ltrim(" in line for line in text.splitlines() if "Filter" in line)


def test_values_of_one_column_do_not_meet_in_one_task(spark):
    from wardflow.operators import profile

    df = spark.range(20_000).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(profile.ranked_percentiles(profile.value_counts(df.withColumn("c", F.lit("k")), "k", ["c"]), ["c"], [0.5], few_groups=True))
        whole = plan(profile.describe(df, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text
    assert whole.count("SortMergeJoin") == 1  # the moments of a column with its percentiles, one row each


def test_the_jvm_compiles_the_cleaning_of_a_load(spark, sf_dir, tmp_path, monkeypatch):
    from wardflow import testbed as tb
    from wardflow.plans import load

    claims = load.consolidate_admissions(tb.raw_admissions(tb.admissions(spark, sf_dir).limit(100)))
    seen, marked = [], load.marked
    monkeypatch.setattr(load, "marked", lambda rows, *rest: seen.append(rows) or marked(rows, *rest))
    load.load(spark, {"admission": claims}, str(tmp_path / "house"), dry_run=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        executed = seen[0].select("*")._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        parts = debug.codegenStringSeq(executed)
        sizes = [parts.apply(k)._3().maxMethodCodeSize() for k in range(parts.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) <= 8000  # beyond, the JVM interprets the method for every row
