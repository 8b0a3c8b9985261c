"""Literal edge cases, one tiny table each."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from wardflow.functions import numbers as nb, text as tx
from wardflow.operators import calendar as cal, checks, dedup, profile, stays as st
from wardflow.operators.upsert import upsert
from wardflow.plans import capacity, dashboard, diagnosis, load, stay_length
from wardflow.plans.capacity import Warehouse
from wardflow.schemas import ADMISSION
from wardflow.settings import Scope, Settings
from wardflow.sources import domains

SCOPE = Scope(date(2023, 1, 1), date(2023, 12, 31))
SETTINGS = Settings(scope=SCOPE)
CLAIM = (
    "claim_id string, facility_id string, specialty string, claim_kind string, admit_date date, "
    "discharge_date date, billed_days int, reported_days int"
)
BED = "facility_id string, bed_code string, period string, bed_type string, beds_total int, beds_public int, own_flag int"


def claims(spark, *rows):
    return spark.createDataFrame(list(rows), CLAIM)


def claim(cid="a", admit=date(2023, 3, 10), out=None, billed=None, reported=None, spec="01", kind="1", fac="1"):
    return (cid, fac, spec, kind, admit, out, billed, reported)


def base(spark, *rows):
    return st.stay_base(claims(spark, *rows), domains.specialty_bridge(spark), SCOPE)


def one(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize(
    "row, days",
    [
        (claim(out=date(2023, 3, 10)), 1),
        (claim(out=date(2023, 3, 5)), 1),
        (claim(billed=4, reported=9), 4),
        (claim(reported=9), 9),
        (claim(), 1),
        (claim(out=date(2023, 4, 1), billed=3), 22),
    ],
)
def test_stay_days(spark, row, days):
    assert one(base(spark, row), "stay_days") == [days]


def test_stay_base_drops_what_is_no_admission(spark):
    rows = base(
        spark, claim("a", kind="5"), claim("b", spec="02"), claim("c", spec=None), claim("d", admit=date(2024, 1, 1))
    )
    assert rows.count() == 0


def test_latest_discharge_wins_and_early_dates_survive(spark):
    rows = base(spark, claim("a", billed=99), claim("a", out=date(2023, 3, 12)), claim("b", admit=date(1899, 5, 1), billed=2))
    got = {r.claim_id: (r.discharge_date, r.stay_days, r.bed_type) for r in rows.collect()}
    assert got == {"a": (date(2023, 3, 12), 2, "1"), "b": (None, 2, "1")}


def months(spark, *rows):
    got = st.occupied_days_monthly(base(spark, *rows), SCOPE).collect()
    return {r.month_start.month: r.occupied_days for r in got}


def test_overlap_is_apportioned(spark):
    assert months(spark, claim(admit=date(2023, 1, 30), billed=5)) == {1: 2, 2: 3}
    assert months(spark, claim(admit=date(2023, 1, 31), billed=1)) == {1: 1}
    assert months(spark, claim(admit=date(2022, 12, 12), billed=30)) == {1: 10}
    assert months(spark, claim(admit=date(2022, 10, 1), billed=3)) == {}
    assert sum(months(spark, claim(admit=date(2022, 10, 1), billed=2147483647)).values()) == 365


def test_early_stay_fills_beds_but_is_no_admission(spark):
    rows = base(spark, claim(admit=date(2022, 12, 12), billed=30))
    assert st.admissions_monthly(rows, SCOPE).count() == 0
    got = st.monthly_activity(rows, SCOPE).collect()
    assert [(r.admissions, r.occupied_days, r.los_days) for r in got] == [(0, 10, None)]


def test_overlap_equals_range_join_and_census(spark):
    many = [claim(f"c{i}", date(2022, 11, 1 + i % 28), None, i % 70 + 1, None, "01" if i % 2 else "03", fac=str(i % 3)) for i in range(60)]
    stays = base(spark, *many)
    calendar = cal.month_calendar(spark, SCOPE.start, SCOPE.end)
    free = F.date_add("admit_date", F.col("stay_days"))
    joined = (
        stays.join(calendar, (F.col("admit_date") <= F.col("month_end")) & (free > F.col("month_start")))
        .groupBy("facility_id", "bed_type", "month_start")
        .agg(F.sum(F.datediff(F.least(free, F.date_add("month_end", 1)), F.greatest("admit_date", "month_start"))).alias("d"))
    )
    want = {tuple(r) for r in joined.collect()}
    occupied = st.occupied_days_monthly(stays, SCOPE).select("facility_id", "bed_type", "month_start", "occupied_days")
    census = st.patient_days(st.daily_census(stays, SCOPE))
    assert {tuple(r) for r in occupied.collect()} == want == {tuple(r) for r in census.collect()}


def test_days_over_an_unbounded_calendar_add_up_to_stays(spark):
    wide = Scope(date(2020, 1, 1), date(2030, 12, 31))
    stays = base(spark, *[claim(f"c{i}", date(2022, 1 + i % 12, 1 + i), None, i * 7 + 1) for i in range(20)])
    days = st.occupied_days_monthly(stays, wide).agg(F.sum("occupied_days")).first()[0]
    assert days == stays.agg(F.sum("stay_days")).first()[0]


def test_bands_on_the_unrounded_rate(spark):
    rows = spark.createDataFrame(
        [(69.999,), (70.0,), (74.999,), (75.0,), (85.0,), (85.001,), (None,)], "rate double"
    )
    got = one(rows.select(capacity.band(F.lit(5), F.lit(1), F.col("rate"), SETTINGS).alias("b")), "b")
    n = SETTINGS.labels
    assert got == [n.severe_idle, n.idle, n.idle, n.healthy, n.healthy, n.overload, n.overload]
    zero = spark.range(1).select(
        capacity.band(F.lit(0), F.lit(0), F.lit(None).cast("double"), SETTINGS).alias("a"),
        capacity.band(F.lit(None).cast("int"), F.lit(0), F.lit(0.0), SETTINGS).alias("b"),
    )
    assert tuple(zero.first()) == (n.no_public_beds, n.no_production)


def house(spark, beds, rows=()):
    return Warehouse(
        beds=spark.createDataFrame(beds, BED),
        admissions=claims(spark, *rows),
        facilities=spark.createDataFrame([], "facility_id string, period string, facility_name string"),
        bed_types=domains.bed_types(spark),
        bridge=domains.specialty_bridge(spark),
        specialties=domains.domain(spark, "specialty"),
    )


def year_of_beds(total, public, months=12, fac="1"):
    return [(fac, "03", f"2023{m:02d}", "1", total, public, 1) for m in range(1, months + 1)]


def patterns(spark, beds, rows=()):
    got = diagnosis.facility_diagnosis(house(spark, beds, rows), SETTINGS).collect()
    return [(r.pattern, r.gap_alert is not None) for r in got]


def test_diagnosis_branches(spark):
    n = SETTINGS.labels
    stay = [claim(admit=date(2023, 1, 1), billed=365)]
    assert patterns(spark, year_of_beds(1, 1, 11), stay) == [(n.short_series, False)]
    assert patterns(spark, year_of_beds(1, 1)) == [(n.no_production, False)]
    assert patterns(spark, year_of_beds(0, 0), stay) == [(n.inconsistent, False)]
    assert patterns(spark, year_of_beds(2, 0), stay) == [(n.no_public_beds_in_period, True)]
    assert patterns(spark, year_of_beds(1, 1), stay) == [(n.high_high, False)]
    assert patterns(spark, year_of_beds(2, 1), stay) == [(n.high_public_only, True)]
    assert patterns(spark, year_of_beds(5, 4), stay) == [(n.low_low, False)]


def test_own_flag_missing_counts_as_not_own(spark):
    beds = [("1", "03", "202301", "1", 5, 5, None), ("2", "03", "202301", "1", 5, 5, 0)]
    assert capacity.occupancy_bands(house(spark, beds), SETTINGS).count() == 0


def test_capacity_rows_survive_without_stays_and_names(spark):
    got = capacity.occupancy_bands(house(spark, year_of_beds(3, 2)), SETTINGS, ordered=True).collect()
    assert len(got) == 12 and {r.facility_name for r in got} == {"facility: 1"}
    assert [r.is_latest for r in got] == ["no"] * 11 + ["yes"]


def test_single_facility_has_no_z(spark):
    rows = [claim("a", date(2023, 1, 3), billed=4), claim("b", date(2023, 1, 5), billed=4)]
    w = house(spark, year_of_beds(3, 2, 1), rows)
    (r,) = stay_length.length_of_stay(w, SETTINGS).collect()
    assert (r.z, r.network_sd, r.status, r.admissions) == (None, 0.0, SETTINGS.labels.within, 2)


def test_scope_share_counts_unmapped_as_outside(spark):
    rows = [claim("a"), claim("b", spec=None), claim("c", spec="02"), claim("a", spec="02"), claim("d", kind="5")]
    (r,) = diagnosis.out_of_scope_share(house(spark, year_of_beds(3, 2), rows), SETTINGS).collect()
    assert (r.stays_inside, r.stays_outside, r.outside_pct) == (1, 3, 100.0)


def test_codes_periods_numbers_dates(spark):
    df = spark.createDataFrame([(" 12.0 ",), ("12345678",), ("  ",), ("\t 7　",)], "c string")
    assert one(df.select(tx.code("c", 7).alias("x")), "x") == ["0000012", "12345678", None, "0000007"]
    df = spark.createDataFrame([("2024-06",), ("202406",), (None,)], "c string")
    assert one(df.select(tx.period("c").alias("x")), "x") == ["202406", "202406", None]
    with pytest.raises(ValueError, match="20246"):
        checks.require_periods(spark.createDataFrame([("20246",), ("202406",)], "p string"), "p", "beds")
    df = spark.createDataFrame(
        [("12",), ("12.0",), (" 1e3 ",), ("n/d",), ("12d",), ("",), (None,), ("-4",), ("0000000007",)], "c string"
    )
    assert one(df.select(tx.integer("c").alias("x")), "x") == [12, 12, 1000, None, None, None, None, -4, 7]
    df = spark.createDataFrame([("1.5",), ("99999999999",), ("n/d",), (None,)], "c string")
    assert one(df.select(tx.bad_integer("c").alias("x")), "x") == [True, True, False, False]
    df = spark.createDataFrame([("20241301",), (None,), ("20240229",)], "c string")
    assert one(df.select(tx.day("c").alias("x")), "x") == [None, None, date(2024, 2, 29)]
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert one(df.select(tx.equals_flag("c", "a").alias("x")), "x") == [1, 0, None]


def test_clip_and_rounding(spark):
    df = spark.createDataFrame([(31,), (None,), (3,)], "v int")
    assert one(df.select(nb.clipped("v", 30).alias("x")), "x") == [30, None, 3]
    df = spark.createDataFrame([(2.675,), (1.005,), (-0.125,)], "v double")
    assert one(df.select(nb.rounded("v", 2).alias("x")), "x") == [2.68, 1.01, -0.13]


def test_lengths(spark):
    df = spark.createDataFrame([("abc",), ("a",)], "c string")
    with pytest.raises(ValueError, match="'abc'"):
        checks.require_lengths(df, {"c": 2}, "t")
    checks.require_lengths(df, {"c": 3}, "t")
    with pytest.raises(ValueError, match="missing"):
        checks.require_columns(df, ["c", "d"], "t")


def test_repeats(spark):
    schema = "k string, t string, q int, o int"
    rows = [("a", None, 2, 1), ("a", "x", 3, 2), ("a", None, 2, 5), ("b", "y", None, 1)]
    got = dedup.sum_repeats(spark.createDataFrame(rows, schema), ["k"], ["q"], ["t"], "o").orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", "x", 5), ("b", "y", 0)]
    alone = dedup.sum_repeats(spark.createDataFrame(rows[3:], schema), ["k"], ["q"], ["t"], "o").collect()
    assert [tuple(r) for r in alone] == [("b", "y", None)]


def test_greatest_sequence_is_text_order(spark):
    df = spark.createDataFrame([("a", "10", 1), ("a", "2", 2), ("a", None, 3)], "k string, seq string, v int")
    assert one(dedup.keep_last(df, ["k"], ["seq"]), "v") == [2]


def test_upsert_twice_is_upsert_once(spark):
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    batch = spark.createDataFrame([("b", None), ("c", 9)], "k string, v int")
    once = upsert(stored, batch, ["k"])
    assert {tuple(r) for r in once.collect()} == {("a", 1, "x"), ("b", None, "y"), ("c", 9, None)}
    assert {tuple(r) for r in upsert(once, batch, ["k"]).collect()} == {tuple(r) for r in once.collect()}
    assert {tuple(r) for r in upsert(stored, batch.select("k"), ["k"]).collect()} == {
        ("a", 1, "x"), ("b", 2, "y"), ("c", None, None)
    }


def test_orphans(spark):
    df = spark.createDataFrame([("01",), ("99",), (None,)], "specialty string")
    ok, bad = checks.split_orphans(df, "specialty", domains.domain(spark, "specialty"))
    assert set(one(ok, "specialty")) == {"01", None} and one(bad, "specialty") == ["99"]


def test_distributions(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "v int")
    (r,) = profile.describe(df, ["v"], (0.25,)).collect()
    assert (r.value_count, r.p25, r.min, r.max, r.mean) == (4, 1.75, 1, 10, 4.0)
    (a,) = profile.describe(df, ["v"], (0.25, 0.5), approximate=True).collect()
    assert (a.value_count, a.mean, a.std) == (r.value_count, r.mean, r.std)
    df = spark.createDataFrame([(2,), (1,), (2,), (1,)], "v int")
    assert profile.central_tendency(df, "v").first().mode == 1


def test_periods(spark):
    assert cal.expected_periods(spark, (2024, 1), (2026, 12)).count() == 36
    for first, last in (((2024, 13), (2025, 1)), ((2025, 1), (2024, 12))):
        with pytest.raises(ValueError):
            cal.expected_periods(spark, first, last)
    assert cal.month_calendar(spark, date(2024, 6, 1), date(2026, 5, 31)).count() == 24
    with pytest.raises(ValueError):
        Scope(date(2024, 2, 1), date(2024, 1, 1))


def test_hot_key_keeps_every_row(spark):
    """One stay and one facility with a third of all rows: nothing is dropped or counted twice."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("claim_id"),
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 7).cast("string")).alias("facility_id"),
        F.lit("01").alias("specialty"),
        F.lit("1").alias("claim_kind"),
        F.lit(date(2023, 5, 1)).alias("admit_date"),
        F.date_add(F.lit(date(2023, 5, 1)), (F.col("id") % 5).cast("int")).alias("discharge_date"),
        F.lit(1).alias("billed_days"),
        F.lit(1).alias("reported_days"),
    )
    stays = st.stay_base(rows, domains.specialty_bridge(spark), SCOPE)
    assert stays.count() == 20001
    assert one(stays.filter("claim_id = 'hot'"), "stay_days") == [4]


def test_reports_from_precomputed_months(spark):
    rows = [claim("a", date(2023, 1, 3), billed=4), claim("b", date(2023, 2, 5), billed=40)]
    w = house(spark, year_of_beds(3, 2), rows)
    months = capacity.monthly(w, SETTINGS)
    for report in (
        capacity.admissions_per_bed,
        capacity.occupancy_bands,
        stay_length.length_of_stay,
        stay_length.stay_means,
        diagnosis.facility_diagnosis,
    ):
        assert report(w, SETTINGS, rows=months).collect() == report(w, SETTINGS).collect()


def filtered_house(spark):
    """A staffed unit from June to August; one stay leaves on 30 June and enters on 1 July, one stays from June into July."""
    beds = spark.createDataFrame([("1", "01", p, "1", 10, 8, 1) for p in ("202306", "202307", "202308")], BED)
    rows = [
        claim("early", admit=date(2023, 7, 1), out=date(2023, 6, 30)),
        claim("long", admit=date(2023, 6, 29), out=date(2023, 7, 3)),
        claim("late", admit=date(2023, 8, 5), out=date(2023, 8, 9)),
    ]
    names = spark.createDataFrame([], "facility_id string, period string, facility_name string")
    return Warehouse(
        beds, claims(spark, *rows), names, domains.bed_types(spark), domains.specialty_bridge(spark), domains.domain(spark, "specialty")
    )


@pytest.mark.parametrize(
    "periods, discharges, days",
    [(["202306"], 1, 2), (["202307"], 1, 3), (["202306", "202307"], 2, 5), (["202306", "202308"], 2, 6), ([], 0, None), (None, 3, 9)],
)
def test_period_filter_sees_every_discharge(spark, periods, discharges, days):
    w, settings = dashboard.narrowed(filtered_house(spark), SETTINGS, periods=periods)
    kpis = dashboard.network_kpis(w, settings).first()
    matrix = dashboard.hospital_matrix(w, settings).collect()
    assert kpis.discharges == discharges
    assert [m.discharges for m in matrix] == ([discharges] if days else [])
    assert capacity.monthly(w, settings).agg(F.sum("occupied_days")).first()[0] == days


def test_period_filter_reaches_specialty_reports(spark):
    w, settings = dashboard.narrowed(filtered_house(spark), SETTINGS, periods=["202306", "202308"])
    codes = domains.literal_table(spark, [("01", "01")], ("bed_code", "specialty"))
    (row,) = dashboard.specialty_deviation(w, settings, codes).collect()
    assert (row.registered, row.attended) == (10 * 61, 6)
    assert one(dashboard.stay_by_specialty(w, settings), "stays") == [2]


def test_missing_texts_are_told_by_the_raw_value(spark):
    raw = [None, "", " ", "\t\xa0", "　\n", "a", " a ", "\xa0.0", "\x7f", "é"]
    df = spark.createDataFrame([(v,) for v in raw], "v string")
    assert one(df.select((tx.has_text("v") == tx.text("v").isNotNull()).alias("same")), "same") == [True] * len(raw)


def test_few_texts_are_trimmed_like_many(spark):
    raw = [None, "", " ", "\t\xa0", " \u3000\n ", "a", " a ", " \t a\xa0 ", "\xa0.0", "\x7f", " é "]
    df = spark.createDataFrame([(v,) for v in raw], "v string").select("v", tx.bare("v").alias("b"))
    df = df.select("v", tx.nearly_bare("b").alias("b"))
    found = df.select(tx.text_of_bare("b").alias("one"), tx.texts([F.col("v")])[0].alias("many"), tx.text("v").alias("text")).collect()
    assert all(r.one == r.many == r.text for r in found) and found[7].one == "a"


def test_summary_counts_each_complete_key_once(spark):
    rows = [("1", "2023-06", "1"), (" 1 ", "202306", "1.0"), ("1", "202306", "2"), ("\t", "202306", "1"), ("2", None, "1"), (None, None, None)]
    raw = spark.createDataFrame(rows, "N_AIH string, COMPETEN string, IDENT string")
    assert [tuple(r) for r in load.load_summary({"admission": (raw, ADMISSION)}).collect()] == [("admission", 2)]


def test_line_ends_are_no_part_of_numbers_and_dates(spark):
    df = spark.createDataFrame([("5\n.0", "20200101\n"), ("12.0", "20200229"), ("n/d", "20190229")], "n string, d string")
    assert [tuple(r) for r in df.select(tx.integer("n"), tx.day("d")).collect()] == [(None, None), (12, date(2020, 2, 29)), (None, None)]


@pytest.mark.parametrize("chosen", [None, (date(2023, 3, 1), date(2023, 5, 1))])
def test_reached_months_are_those_filled_and_those_of_the_end(spark, chosen):
    from dataclasses import replace

    scope = replace(SCOPE, chosen=chosen)
    stays = base(
        spark,
        claim("a", date(2023, 3, 30), date(2023, 5, 2)),
        claim("b", date(2023, 7, 1), None, billed=3),
        claim("c", date(2023, 9, 9), date(2023, 8, 1)),
        claim("d", date(2021, 1, 1), date(2021, 2, 1)),
        claim("e", date(2023, 12, 30), date(2024, 2, 1)),
    )
    ends = stays.filter(F.col("discharge_date").isNotNull()).select(F.trunc("discharge_date", "MM").alias("month_start"))
    wanted = {r[0] for r in st.stay_months(stays, scope).select("month_start").union(ends).collect()}
    got = one(st.reached_months(stays, scope), "month_start")
    assert set(got) == wanted and len(got) == len(wanted)


def test_texts_of_a_row_are_trimmed_as_single_ones(spark):
    values = ["", "  ", " a ", "\ta", "a\xa0 ", " \t ", "é", " é\u3000", "\x7f", " \x00 ", None, "a b", " \n a\u2003"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    both = df.select(tx.text("c").alias("x"), tx.texts([F.col("c"), F.lit(" z")]).alias("y")).collect()
    assert [r.y for r in both] == [[r.x, "z"] for r in both]
    assert [r.x for r in both][:8] == [None, None, "a", "a", "a", None, "é", "é"]


def test_numbers_that_get_lost_stop_a_load(spark, tmp_path):
    from wardflow.plans import load

    fields = "CNES string, CODLEITO string, TP_LEITO string, COMPETEN string, QT_EXIST string, QT_SUS string, own_flag int, _file string, _row long"
    for beds, month in ((" 1.5 ", "202401"), ("2147483648", "202401"), ("1", " 20241 ")):
        raw = spark.createDataFrame([("1", "1", "1", "202401", "n/d", "2.0", 1, "f", 0), ("1", "2", "1", month, beds, None, 1, "f", 1)], fields)
        with pytest.raises(ValueError, match="QT_EXIST': 1" if month == "202401" else "1 periods .* ' 20241 '"):
            load.load(spark, {"bed": raw}, str(tmp_path / "house"))
