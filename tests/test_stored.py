"""Sketches, stored months, views and the warehouse's pointer."""

from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_edges import BED as BED_DDL, SETTINGS, claim, claims
from wardflow import testbed as tb
from wardflow.operators import profile, sketches
from wardflow.plans import capacity, dashboard, refresh, store, views
from wardflow.plans.capacity import Warehouse
from wardflow.schemas import BED
from wardflow.sources import domains


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


# --- sketches --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A hundred thousand rows; a third have one value, and one group holds a third of all rows."""
    n = F.col("id")
    return spark.range(100_000).select(
        F.when(n % 3 == 0, 0).otherwise(n % 50).alias("g"),
        (n % 12).alias("m"),
        F.when(n % 3 == 1, -5).otherwise(F.abs(F.xxhash64(n)) % 40_000).alias("v"),
    )


def test_distinct_sketches_roll_up(skewed):
    parts = sketches.distinct_sketches(skewed, ["g", "m"], "v")
    exact = {r.g: (r.n, r.d) for r in skewed.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("v").alias("d")).collect()}
    got = {r.g: (r.row_count, r.distinct_estimate) for r in sketches.distinct_over(parts, ["g"]).collect()}
    assert set(got) == set(exact)
    for g, (n, d) in exact.items():
        assert got[g][0] == n and abs(got[g][1] - d) <= sketches.distinct_error() * d + 1
    whole = sketches.distinct_over(parts, []).first().distinct_estimate
    assert abs(whole - skewed.select("v").distinct().count()) <= sketches.distinct_error() * 40_000
    empty = sketches.distinct_sketches(skewed.limit(0), ["g"], "v")
    assert sketches.distinct_over(empty, ["g"]).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_quantile_sketches_keep_their_ranks(skewed, kind):
    df = skewed.withColumn("v", F.col("v").cast(kind)).unionByName(skewed.limit(5).withColumn("v", F.lit(None).cast(kind)))
    found = sketches.quantiles_over(sketches.quantile_sketches(df, ["g", "m"], "v"), ["g"], [0.1, 0.5, 0.95], kind)
    error = sketches.rank_error()
    for r in found.collect():
        values = [x.v for x in df.filter((F.col("g") == r.g) & F.col("v").isNotNull()).select("v").collect()] if r.g in (0, 1, 7) else None
        if values is None:
            continue
        assert r.value_count == len(values)
        for p, q in zip([0.1, 0.5, 0.95], r.q):
            assert sum(x < q for x in values) / len(values) <= p + error and sum(x <= q for x in values) / len(values) >= p - error


def by_count(df, key, n):
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), F.asc(key)).limit(n)


def test_frequent_values_with_and_without_leaders(spark, skewed):
    leaders = skewed.withColumn("v", F.when(F.col("g") < 5, F.col("g")).otherwise(F.col("v")))
    for df, n, tracked in ((leaders, 3, 64), (leaders, 2000, 64), (skewed, 10, 16), (skewed.filter("g = 1"), 4, 8192), (skewed.limit(0), 3, 64)):
        got = sketches.most_frequent(df, "v", n, tracked)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in by_count(df, "v", n).collect()]
    assert "Scan" not in plan(sketches.most_frequent(leaders, "v", 3, 64)).replace("LocalTableScan", "").replace("Scan ExistingRDD", "")


def test_percentiles_number_only_the_ranges_they_need(skewed):
    counts = profile.value_counts(skewed, "v", ["g"])
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    for ranges in (4, 64, 500):
        got = {r.g: r.p for r in profile.ranked_percentiles(counts, ["g"], probs, ranges).collect()}
        want = counts.groupBy("g").agg(profile.weighted_percentiles(probs).alias("p")).collect()
        assert all(got[r.g] == pytest.approx(r.p) for r in want)
    whole = profile.ranked_percentiles(profile.value_counts(skewed, "v", []), [], probs).first().p
    assert whole == pytest.approx(profile.value_counts(skewed, "v", []).agg(profile.weighted_percentiles(probs)).first()[0])


# --- stored months ---------------------------------------------------------------------------


def house(spark, beds, rows):
    names = spark.createDataFrame([], "facility_id string, period string, facility_name string")
    made = claims(spark, *[r[1:] for r in rows])
    periods = spark.createDataFrame([(r[1], r[0]) for r in rows], "claim_id string, period string")
    return Warehouse(
        spark.createDataFrame(beds, BED_DDL),
        made.join(periods, "claim_id") if len({r[1] for r in rows}) == len(rows) else placed_claims(spark, rows),
        names, domains.bed_types(spark), domains.specialty_bridge(spark), domains.domain(spark, "specialty"),
    )


def placed_claims(spark, rows):
    from tests.test_edges import CLAIM

    return spark.createDataFrame([(*r[1:], r[0]) for r in rows], CLAIM + ", period string")


def runs(spark, folder):
    return {m: e["run"] for m, e in store.current(spark, folder)["monthly"].items()}


def test_refresh_rewrites_only_reached_months(spark, tmp_path):
    beds = [("1", "01", f"2023{m:02d}", "1", 10, 8, 1) for m in range(1, 13)]
    old_rows = [
        ("202303", *claim("a", admit=date(2023, 3, 30), out=date(2023, 4, 2))),
        ("202306", *claim("a", admit=date(2023, 3, 30), billed=40)),
        ("202309", *claim("b", admit=date(2023, 9, 1), out=date(2023, 9, 5))),
    ]
    # The stay's winning row leaves for another facility, so the row of June wins; a stay of October is discharged before it.
    new_rows = [
        ("202303", *claim("a", admit=date(2023, 3, 30), out=date(2023, 4, 2), fac="2")),
        *old_rows[1:],
        ("202303", *claim("c", admit=date(2023, 10, 1), out=date(2023, 9, 30))),
    ]
    folder = str(tmp_path / "reports")
    old, new = house(spark, beds, old_rows), house(spark, beds, new_rows)
    assert refresh.refresh(spark, folder, old, SETTINGS, "first") == SETTINGS.scope.periods
    months = refresh.refresh(spark, folder, new, SETTINGS, "second", old, {"admission": ["202303"]})
    assert months == ["202303", "202304", "202305", "202309", "202310"]
    assert {m for m, r in runs(spark, folder).items() if r == "second"} == set(months)
    full = dashboard.with_discharges(new, SETTINGS)
    assert rows_of(refresh.stored(spark, folder, new, SETTINGS)) == rows_of(full)
    # Beds that leave the scope empty their month.
    gone = replace(new, beds=new.beds.filter("period <> '202312'"))
    assert refresh.refresh(spark, folder, gone, SETTINGS, "third", new, {"bed": ["202312"]}) == ["202312"]
    assert rows_of(refresh.stored(spark, folder, gone, SETTINGS)) == rows_of(dashboard.with_discharges(gone, SETTINGS))
    assert refresh.refresh(spark, folder, gone, SETTINGS, "fourth", gone, {}) == []


def test_views_read_the_files_of_their_month(spark, sf_dir, tmp_path):
    w, folder = tb.warehouse(spark, sf_dir), str(tmp_path / "reports")
    refresh.refresh(spark, folder, w, tb.SETTINGS, "only")
    names = views.register(spark, folder, w, tb.SETTINGS, "199805")
    month = spark.sql("SELECT * FROM vw_occupancy WHERE period = report_period")
    want = capacity.occupancy_bands(w, tb.SETTINGS).filter("period = '199805'")
    assert rows_of(month) == rows_of(want) and month.count() > 0
    text = plan(spark.sql("SELECT facility_id, occupancy_pct FROM vw_occupancy WHERE period = report_period"))
    assert "PartitionFilters: [isnotnull(period" in text and "(period#" in text
    views.set_period(spark, "199806")
    assert {r.period for r in spark.sql("SELECT period FROM vw_admissions WHERE period = report_period").collect()} == {"199806"}
    for name in names:
        assert spark.table(name).columns
    with pytest.raises(ValueError):
        views.set_period(spark, "1998'; --")


# --- the pointer -----------------------------------------------------------------------------


def beds_of(spark, period, n):
    rows = [(f"{k:07d}", "01", "1", period, k, k, 1) for k in range(n)]
    return spark.createDataFrame(rows, BED.schema)


def published(spark, folder, period, n, run, seen=None):
    entry = store.write(beds_of(spark, period, n), folder, "bed", run, [period])
    store.switch(spark, folder, {"bed": entry}, seen)


def test_loads_at_once_fail_instead_of_losing_rows(spark, tmp_path):
    folder = str(tmp_path)
    published(spark, folder, "202401", 3, "a")
    seen = store.current(spark, folder)
    published(spark, folder, "202402", 2, "b", seen)
    published(spark, folder, "202401", 4, "c", seen)
    with pytest.raises(store.ConcurrentLoad, match="another load"):
        published(spark, folder, "202401", 9, "d", seen)
    assert {m: e["run"] for m, e in store.current(spark, folder)["bed"].items()} == {"202401": "c", "202402": "b"}
    assert not (tmp_path / "_current.json.next").exists()
    (tmp_path / "_current.json.next").touch()
    with pytest.raises(store.ConcurrentLoad, match="remove the file"):
        published(spark, folder, "202403", 1, "e")


def test_counts_come_from_the_pointer_and_vacuum_removes_what_was_replaced(spark, tmp_path):
    folder = str(tmp_path)
    published(spark, folder, "202401", 3, "a")
    published(spark, folder, "202401", 5, "b")
    published(spark, folder, "202402", 2, "b2")
    assert [tuple(r) for r in store.summary(spark, folder).collect()] == [("bed", 7)]
    assert [tuple(r) for r in store.months(spark, folder, "bed").collect()] == [("202401", 5), ("202402", 2)]
    assert store.vacuum(spark, folder, timedelta(hours=1)) == []
    assert store.vacuum(spark, folder, timedelta(seconds=-5)) == ["bed/period=202401/run=a"]
    assert store.read(spark, folder, "bed", BED.schema).count() == 7
    assert store.vacuum(spark, folder, timedelta(seconds=-5)) == []
