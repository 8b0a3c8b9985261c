"""The compression classifier: held-out accuracy and edge cases."""

import math
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from wardflow.llm import compression, queries
from wardflow.llm.shared import fold_number


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.op2_compression_classifier(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    by = {(r["quality"], r["predicted"]): r["count"] for r in found.filter("held_out").groupBy("quality", "predicted").count().collect()}
    assert by[1, 1] >= 0.98 * (by[1, 1] + by.get((1, 0), 0)) and by[0, 0] >= 0.9 * (by[0, 0] + by.get((0, 1), 0))


def test_folds(spark):
    for r in spark.range(50).select("id", fold_number(F.col("id"), 5).alias("f")).collect():
        assert r["f"] == zlib.crc32(str(r["id"]).encode()) % 5


def test_edges(spark, table):
    good = [(k, f"the house number {k} stands by the river and the road") for k in range(40)]
    bad = [(100 + k, f"BUY!! NOW!! {k}!! WIN!! CASH!!") for k in range(40)]
    labels = spark.createDataFrame([*[(k, 1) for k in range(40)], *[(100 + k, 0) for k in range(40)], (7, 1), (None, 1), (9999, 0), (5, None)], "doc_id long, quality int")
    model = compression.fit(table(good + bad, clash=True), labels)
    odd = table([(1, None), (2, ""), (None, good[3][1]), (4, bad[3][1]), (4, bad[3][1]), (5, good[1][1] * 4000)], clash=True)
    got = [(r["doc_id"], r["score"]) for r in compression.scored(odd, model).collect()]
    assert len(got) == 6 and all(0 <= s <= 1 for _, s in got)
    assert dict(got)[None] > 0.5 > dict(got)[4]
    assert compression.accepted(odd, model, 0.5).columns == odd.columns
    assert compression.scored(table([]), model).count() == 0
    nothing = compression.fit(table([]), labels)
    assert {r["score"] for r in compression.scored(odd, nothing).collect()} == {0.5}


def test_reruns_agree(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    assert queries.quality_model(docs, labels) == queries.quality_model(docs.repartition(5), labels.repartition(3))


def test_scores_by_the_library_itself(spark, sf_dir):
    """Every score from blocks compressed one by one with fresh compressors, and the logistic function of its weights."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = queries.quality_model(docs, labels)
    found = {r["doc_id"]: r["score"] for r in queries.op2_compression_classifier(spark, sf_dir).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect()[::7]:
        raw, sizes = (text or "").encode(), []
        for held in (model.good, model.bad):
            own = zstandard.ZstdCompressionDict(held)
            blocks = [raw[k : k + 1024] for k in range(0, len(raw), 1024)]
            made = [zstandard.ZstdCompressor(level=3, dict_data=own, write_content_size=False, write_dict_id=False).compress(b) for b in blocks]
            back = zstandard.ZstdDecompressor(dict_data=own)
            assert b"".join(back.decompress(m, max_output_size=1024) for m in made) == raw
            sizes.append(sum(map(len, made)))
        d, short = (sizes[1] - sizes[0]) / len(raw), len(raw) ** -0.5
        z = sum(w * x for w, x in zip(model.weights, (1, 20 * d, 10 * short, 200 * d * short)))
        assert found[doc_id] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


def test_sample_is_that_of_the_smallest_hashes(spark):
    from wardflow.llm.shared import first_by_hash

    keys = spark.range(30000).select(F.col("id").alias("key"), (F.col("id") % 100 == 0).cast("int").alias("label"))
    chosen = first_by_hash(keys, 400).collect()
    for label, count in ((0, 400), (1, 300)):
        best = [r[0] for r in keys.filter(F.col("label") == label).orderBy(F.xxhash64("key")).limit(400).collect()]
        assert [r["key"] for r in sorted(chosen, key=lambda r: r["n"]) if r["label"] == label] == best and len(best) == count
