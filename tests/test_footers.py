"""What Parquet footers tell, against reading the rows."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from wardflow.sources import footers, landed

WANTED = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("w", T.DoubleType())])


@pytest.fixture(scope="module")
def drifting(tmp_path_factory):
    """A thousand files whose column v changes its type with every file; some lack a column."""
    root = tmp_path_factory.mktemp("drift")
    for k in range(1000):
        columns = {"id": pa.array([k, None], pa.int64()), "v": pa.array([k % 7] * 2, pa.int32()) if k % 2 else pa.array([f"{k % 7}"] * 2)}
        if k % 3 == 0:
            columns["w"] = pa.array([k / 2, None])
        folder = root / f"{k % 10:02d}"
        folder.mkdir(exist_ok=True)
        pq.write_table(pa.table(columns), folder / f"{k:04d}.parquet")
    (root / "00" / "_SUCCESS").touch()
    return str(root)


def jobs_of(spark, action):
    """Result of an action and the number of jobs that it ran."""
    group = "counted"
    spark.sparkContext.setJobGroup(group, group)
    try:
        made = action()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_alternating_types_give_two_scans(spark, drifting):
    (found, jobs) = jobs_of(spark, lambda: footers.scans(spark, [f"{drifting}/*"]))
    assert len(found) == 2 and sum(len(files) for files, _ in found) <= 1000
    assert jobs < 20
    assert sorted(dict((f.name, f.dataType.simpleString()) for f in s.fields)["v"] for _, s in found) == ["int", "string"]
    rows = landed.read_consolidated(spark, [[f"{drifting}/*"]], WANTED)
    assert rows.count() == 2000 and rows.agg(F.sum("id")).first()[0] == sum(range(1000))
    assert rows.agg(F.sum("w")).first()[0] == sum(k / 2 for k in range(0, 1000, 3))
    assert rows.agg(F.sum(F.col("v").cast("int"))).first()[0] == 2 * sum(k % 7 for k in range(1000))
    assert rows.select(landed.FILE).distinct().count() == 1000


def test_folders_of_one_layout_are_named_as_a_whole(spark, drifting):
    found = footers.scans(spark, [f"{drifting}/01", f"{drifting}/02", f"{drifting}/03"])
    assert sorted(len(files) for files, _ in found) == [1, 2]


def test_row_counts_need_no_rows(spark, drifting):
    counts = footers.row_counts(spark, [drifting])
    assert counts.count() == 1000 and counts.agg(F.sum("row_count")).first()[0] == 2000
    assert "Scan parquet" not in counts._jdf.queryExecution().executedPlan().toString()


def test_ranges_equal_rows(spark, tmp_path):
    from datetime import date

    rows = [(1, date(2024, 1, 5), "b", 1.5), (None, None, "a", float("nan")), (-7, date(1999, 12, 31), None, None)]
    df = spark.createDataFrame(rows, "n long, d date, t string, x double")
    df.repartition(2).write.parquet(str(tmp_path / "t"))
    got = {r.column_name: tuple(r)[2:] for r in footers.value_ranges(spark, str(tmp_path / "t"), "t", ["n", "d", "t", "x"]).collect()}
    assert got == {"n": ("-7", "1", 1, 3), "d": ("1999-12-31", "2024-01-05", 1, 3), "t": ("a", "b", 1, 3), "x": ("1.5", "NaN", 1, 3)}
    shape = footers.table_shapes(spark, {"t": str(tmp_path / "t")}).first()
    assert tuple(shape) == ("t", 3, 4)


def test_stores_that_arrow_cannot_open_are_read(spark, tmp_path, monkeypatch):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    spark.range(5).select(F.col("id").cast("string")).write.parquet(str(tmp_path / "u"))
    path = str(tmp_path / "t")
    told = footers.value_ranges(spark, path, "t", ["id"]).collect()
    assert footers.can_open("/x") and not footers.can_open("viewfs:///x")
    monkeypatch.setattr(footers, "can_open", lambda uri: False)
    assert footers.value_ranges(spark, path, "t", ["id"]).collect() == told
    assert footers.row_counts(spark, [path]).agg(F.sum("row_count")).first()[0] == 10
    one = T.StructType([T.StructField("id", T.LongType())])
    assert landed.read_consolidated(spark, [[path, str(tmp_path / "u")]], one).count() == 15


def test_unsigned_and_old_timestamps(spark, tmp_path):
    table = pa.table({"u": pa.array([1, 2**31], pa.uint32()), "t": pa.array([0, 1], pa.timestamp("ns"))})
    pq.write_table(table, tmp_path / "f.parquet", use_deprecated_int96_timestamps=True)
    ((_, schema),) = footers.scans(spark, [str(tmp_path)])
    assert {f.name: f.dataType for f in schema.fields} == {"u": T.LongType(), "t": T.TimestampType()}
    assert spark.read.schema(schema).parquet(str(tmp_path)).agg(F.max("u")).first()[0] == 2**31
