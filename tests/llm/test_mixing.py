"""Mixing against SQL, and its edge cases."""

from pyspark.sql import functions as F

from tests.llm.conftest import rows
from tests.oracle import connect, difference
from wardflow.llm import mixing, queries


def test_oracle(spark, sf_dir):
    assert difference(connect(sf_dir), queries.op10_mix_wfq(spark, sf_dir), queries.ORACLES["op10_mix_wfq"]) is None


def test_targets_are_met(spark, sf_dir):
    found = queries.op10_mix_wfq(spark, sf_dir)
    total = found.agg(F.sum("size"), F.sum("taken")).first()
    assert 0 <= 1.5 * total[0] - total[1] < found.agg(F.max("size")).first()[0]
    assert found.filter("taken not in (0, size, 2 * size)").count() == 0


def test_ranges_change_nothing(table, monkeypatch):
    docs = table([(k, "w " * (k % 17), None, "ab"[k % 2]) for k in range(400)])
    want = rows(mixing.mix(docs), "doc_id", "taken")
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    assert rows(mixing.mix(docs.repartition(7)), "doc_id", "taken") == want


def test_edges(table):
    docs = table([(1, None, None, None), (2, "", None, "b"), (None, "a b", None, "a"), (3, "c d", None, "a"), (3, "c d", None, "a"), (4, "x " * 300000, None, "c")], clash=True)
    found = {(r["doc_id"], r["source"], r["size"]): (r["source_size"], r["taken"]) for r in mixing.mix(docs).collect()}
    assert found[1, None, 0] == (0, 0) and found[2, "b", 0] == (0, 0)
    assert found[4, "c", 300000][1] in (300000, 600000)
    assert mixing.mixed_documents(docs).columns == docs.columns
    for empty in (mixing.mix(table([])), mixing.mixed_documents(table([]))):
        assert empty.count() == 0
    assert mixing.mix(table([(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0


def test_documents_come_as_often_as_taken(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["taken"]}
    assert {r["doc_id"]: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()} == taken
