"""Files in, warehouse out."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from wardflow import testbed as tb
from wardflow.catalog import cleaning
from wardflow.plans import load, store, transform
from wardflow.schemas import ADMISSION, BED, FACILITY, RAW_ADMISSION, RAW_BED, RAW_FACILITY
from wardflow.sources import domains, landed
from wardflow.streaming.ingest import ingest_new_files

REGISTRY = T.StructType([T.StructField("CNES", T.StringType()), T.StructField("LEITOS_SUS", T.LongType())])


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_registry_formats_agree(spark, tmp_path):
    records = [{"CNES": 12, "LEITOS_SUS": 3}, {"CNES": 7, "LEITOS_SUS": 0}]
    (tmp_path / "list.json").write_text(json.dumps(records))
    (tmp_path / "wrapped.json").write_text(json.dumps({"hospitais": records}))
    (tmp_path / "bad.json").write_text(json.dumps({"hospitais": 1}))
    (tmp_path / "r.csv").write_bytes("CNES;NOME;LEITOS_SUS\n12;São José;3\n7;x;0\n".encode("latin-1"))
    want = [("12", 3), ("7", 0)]
    for name in ("list.json", "wrapped.json"):
        path = str(tmp_path / name)
        assert rows_of(landed.read_registry_json(spark, path, REGISTRY, landed.json_wrapper(spark, path))) == want
    assert landed.json_wrapper(spark, str(tmp_path / "list.json")) is None
    with pytest.raises(ValueError):
        landed.json_wrapper(spark, str(tmp_path / "bad.json"))
    assert rows_of(landed.read_registry_csv(spark, str(tmp_path / "r.csv"), REGISTRY)) == want
    names = T.StructType([T.StructField("NOME", T.StringType())])
    assert ("São José",) in rows_of(landed.read_registry_csv(spark, str(tmp_path / "r.csv"), names))


def test_files_of_differing_columns(spark, tmp_path):
    a, b = str(tmp_path / "202401"), str(tmp_path / "202402")
    spark.createDataFrame([("1", "03")], "CNES string, CODLEITO string").write.parquet(a)
    spark.createDataFrame([(5, "2")], "QT_SUS int, CNES string").write.parquet(b)
    got = landed.read_consolidated(spark, [[str(tmp_path / "2024*")]], RAW_BED, with_order=True)
    assert sorted(r.CNES for r in got.collect()) == ["1", "2"]
    assert got.select("QT_SUS", "NAT_JUR").orderBy("QT_SUS").collect()[1] == (5, None)
    assert {landed.FILE, landed.ROW} <= set(got.columns)
    empty = landed.read_consolidated(spark, [], RAW_BED)
    assert empty.columns == RAW_BED.names and empty.count() == 0


def test_region_copy(spark, tmp_path):
    df = spark.createDataFrame([("261160", 1), ("1", 2)], "code string, v int")
    assert landed.write_with_region(df, str(tmp_path / "all"), F.col("code") == "261160", str(tmp_path / "region")) == (2, 1)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 2
    assert rows_of(spark.read.parquet(str(tmp_path / "region"))) == [("261160", 1)]


def raw_bed_rows(spark, *rows):
    schema = "COMPETEN string, CNES string, CPF_CNPJ string, CODUFMUN string, TP_LEITO string, CODLEITO string, CNPJ_MAN string, QT_EXIST bigint, QT_SUS bigint, NAT_JUR bigint"
    return spark.createDataFrame(list(rows), schema)


def placed(rows, name="f"):
    """Rows with a file and a place in it, as readers give them."""
    return rows.coalesce(1).withColumns({landed.FILE: F.lit(name), landed.ROW: F.monotonically_increasing_id()})


def bed_row(period="202401", cnes="12", kind="1", code="3", payer="10565000000192", total=5, public=4):
    return (period, cnes, "x", "261160", kind, code, payer, total, public, 1)


def loaded(spark, warehouse, *rows, **options):
    beds = load.consolidate_beds(placed(raw_bed_rows(spark, *rows)))
    return load.load(spark, {"bed": beds}, str(warehouse), **options)


def stored_beds(spark, warehouse):
    return store.read(spark, str(warehouse), "bed", BED.schema)


def test_load_upserts_only_touched_months(spark, tmp_path):
    report = loaded(spark, tmp_path, bed_row(), bed_row(kind="3"), bed_row(code="99"), bed_row("202402", payer=None))
    assert (report.accepted["bed"], report.rejected["bed"], report.stored["bed"]) == (2, 1, 2)
    rejects = spark.read.csv(f"{tmp_path}/_rejects/bed/run={report.run}", header=True)
    assert [(r.bed_code, r._reject) for r in rejects.collect()] == [("99", "bed_code")]
    flags = {r.period: r.own_flag for r in stored_beds(spark, tmp_path).collect()}
    assert flags == {"202401": 1, "202402": None}
    untouched = sorted(p.name for p in (tmp_path / "bed" / "period=202402").rglob("*.parquet"))
    again = [bed_row(public=1), bed_row(cnes="13")]
    for _ in range(2):
        report = loaded(spark, tmp_path, *again)
        assert report.stored["bed"] == 3
    got = {(r.facility_id, r.period): r.beds_public for r in stored_beds(spark, tmp_path).collect()}
    assert got == {("0000012", "202401"): 1, ("0000013", "202401"): 4, ("0000012", "202402"): 4}
    assert untouched == sorted(p.name for p in (tmp_path / "bed" / "period=202402").rglob("*.parquet"))


def test_every_row_is_accounted_for(spark, tmp_path):
    rows = [bed_row(), bed_row(), bed_row(total=7), bed_row(cnes=None), bed_row(code="99"), bed_row(code="98"), bed_row(code="99", cnes="3")]
    report = loaded(spark, tmp_path, *rows).tables["bed"]
    assert (report.read, report.null_keys, report.repeated, report.accepted) == (7, 1, 2, 1)
    assert report.rejected == {"bed_code": 3, "bed_type": 0} and report.top_rejects == {"bed_code": [("99", 2), ("98", 1)]}


def test_rejects_of_earlier_loads_stay(spark, tmp_path):
    loaded(spark, tmp_path, bed_row(code="99"), bed_row(), run="one")
    loaded(spark, tmp_path, bed_row(), run="two")
    loaded(spark, tmp_path, bed_row(code="99"), bed_row(), run="one")
    rejects = spark.read.csv(f"{tmp_path}/_rejects/bed", header=True)
    assert [r.run for r in rejects.collect()] == ["one"]


def test_last_row_needs_a_place(spark, tmp_path):
    registry = spark.createDataFrame([("202401", "261160", "R", "1", n, None, "M", 1, 1) for n in ("ZZZ old", "AAA new")], RAW_FACILITY)
    with pytest.raises(ValueError, match="position"):
        load.load(spark, {"facility": load.consolidate_facilities(registry)}, str(tmp_path))
    load.load(spark, {"facility": load.consolidate_facilities(placed(registry))}, str(tmp_path))
    assert store.read(spark, str(tmp_path), "facility", FACILITY.schema).first().facility_name == "AAA new"


def test_reader_between_two_publishes_sees_the_old_state(spark, tmp_path):
    loaded(spark, tmp_path, bed_row(public=1))
    before = stored_beds(spark, tmp_path)
    loaded(spark, tmp_path, bed_row(public=2))
    assert [r.beds_public for r in before.collect()] == [1] and [r.beds_public for r in stored_beds(spark, tmp_path).collect()] == [2]


def test_drifting_types_json_keys_and_fractions(spark, tmp_path):
    spark.createDataFrame([("1", 3)], "CNES string, QT_SUS int").write.parquet(str(tmp_path / "m" / "01"))
    spark.createDataFrame([(2, "4.0")], "CNES int, QT_SUS string").write.parquet(str(tmp_path / "m" / "02"))
    got = landed.read_consolidated(spark, [[str(tmp_path / "m" / "*")]], RAW_BED)
    assert sorted((r.CNES, r.QT_SUS) for r in got.collect()) == [("1", 3), ("2", 4)]
    (tmp_path / "k.json").write_text(json.dumps({"zeta": [{"CNES": "1", "LEITOS_SUS": 2}], "alpha": [1], "meta": {"n": 1}}))
    assert landed.json_wrapper(spark, str(tmp_path / "k.json")) == "zeta"
    assert rows_of(landed.read_registry_json(spark, str(tmp_path / "k.json"), REGISTRY, "zeta")) == [("1", 2)]


def test_transform_keeps_the_region_and_reports(spark, tmp_path):
    here, far = bed_row(), ("202401", "7", "x", "999999", "1", "3", None, 1, 1, 1)
    raw_bed_rows(spark, here, far).coalesce(1).write.parquet(str(tmp_path / "landed" / "01"))
    registry = spark.createDataFrame([("202401", None, " recife ", "12", "n", None, "M", 1, 1), ("202401", "1", "X", "13", "n", None, "M", 1, 1)], RAW_FACILITY)
    report = transform.transform(spark, str(tmp_path / "out"), beds=[[str(tmp_path / "landed" / "*")]], facilities=placed(registry))
    assert [(r.rows_before, r.rows_after) for r in report.values()] == [(2, 1), (2, 1)]
    tables = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in ("bed", "facility")}
    assert load.load(spark, tables, str(tmp_path / "house")).accepted == {"facility": 1, "bed": 1}
    with pytest.warns(UserWarning, match="region"):
        transform.transform(spark, str(tmp_path / "out2"), beds=[[str(tmp_path / "landed" / "*")]], region_code="000000")


def test_dry_run_and_failing_load_publish_nothing(spark, tmp_path):
    report = loaded(spark, tmp_path, bed_row(), dry_run=True)
    assert report.accepted["bed"] == 1 and report.stored["bed"] == 0
    with pytest.raises(ValueError, match="2024"):
        loaded(spark, tmp_path, bed_row("2024"))
    with pytest.raises(ValueError, match="longer"):
        loaded(spark, tmp_path, bed_row(cnes="123456789"))
    assert stored_beds(spark, tmp_path) is None
    with pytest.raises(FileNotFoundError):
        landed.read_inputs(spark, {"bed": f"{tmp_path}/nowhere"})


def test_full_load(spark, sf_dir, tmp_path):
    claims = load.consolidate_admissions(tb.raw_admissions(tb.admissions(spark, sf_dir)))
    facilities = load.consolidate_facilities(placed(cleaning._raw_facilities(spark, sf_dir)))
    report = load.load(spark, {"facility": facilities, "admission": claims}, str(tmp_path))
    assert report.accepted["admission"] == report.stored["admission"] == cleaning._clean_admissions(spark, sf_dir).count()
    assert report.stored["facility"] == tb.facilities(spark, sf_dir).count()


def test_stream_takes_each_file_once(spark, tmp_path):
    land, house, progress = (str(tmp_path / n) for n in ("land", "house", "progress"))

    def drop(month, *claim_ids):
        rows = [
            {"N_AIH": c, "ANO_CMPT": "2024", "MES_CMPT": str(month), "IDENT": "1", "CNES": "1", "DT_INTER": "20240105"}
            for c in claim_ids
        ]
        df = spark.createDataFrame([tuple(r.get(n) for n in RAW_ADMISSION.names) for r in rows], RAW_ADMISSION)
        df.coalesce(1).write.mode("append").parquet(f"{land}/{month}")

    def run():
        query = ingest_new_files(
            spark, land, RAW_ADMISSION, ADMISSION, house, progress, load.consolidate_admissions
        )
        query.awaitTermination()
        batches = [p for p in query.recentProgress if p.numInputRows > 0]
        return len(batches), store.read(spark, house, "admission", ADMISSION.schema).count()

    drop(1, "a", "b")
    assert run() == (1, 2)
    assert run() == (0, 2)
    drop(2, "a", "c")
    drop(1, "b", "d")
    assert run()[1] == 5


def test_domains_are_complete(spark):
    sizes = {c: domains.domain(spark, c).count() for c in domains.DOMAINS}
    assert sizes == {"bed_type": 7, "bed_code": 66, "specialty": 12, "claim_kind": 2}
