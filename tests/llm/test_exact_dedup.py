"""Exact de-duplication against SQL, and its edge cases."""

import hashlib

from pyspark.sql import functions as F

from tests.llm.conftest import rows
from tests.oracle import connect, difference
from wardflow.llm import exact_dedup, queries

CASES = [(1, "Ab"), (2, "aB"), (3, "Éb"), (4, "éb"), (5, None), (6, ""), (None, "ab"), (7, "x"), (7, "x"), (8, "long " * 20000), (9, "LONG " * 20000)]


def test_oracle(spark, sf_dir):
    assert difference(connect(sf_dir), queries.op7_exact_dedup(spark, sf_dir), queries.ORACLES["op7_exact_dedup"]) is None


def test_cases(table):
    found = exact_dedup.exact_groups(table(CASES, clash=True))
    sums = {t: hashlib.sha256(t.encode()).hexdigest() for t in ("ab", "Éb", "éb", "", "x", "long " * 20000)}
    want = [
        (1, 2, 3, False, sums["ab"]), (2, 2, 3, True, sums["ab"]), (None, 2, 3, False, sums["ab"]),
        (3, 3, 1, True, sums["Éb"]), (4, 4, 1, True, sums["éb"]), (5, 6, 2, False, sums[""]), (6, 6, 2, True, sums[""]),
        (7, 7, 2, True, sums["x"]), (7, 7, 2, False, sums["x"]), (8, 9, 2, False, sums["long " * 20000]), (9, 9, 2, True, sums["long " * 20000]),
    ]
    assert rows(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_split_changes_nothing(table):
    docs = table([(k, "hot" if k % 3 else f"t{k % 50}") for k in range(600)])
    with_split, without = (rows(exact_dedup.exact_groups(docs, share=s), "doc_id", "keep_id", "group_size", "kept") for s in (1000, 1))
    assert with_split == without
    assert exact_dedup.frequent(exact_dedup.digests(docs), 10).count() == 1


def test_rows_that_stay(table):
    left = exact_dedup.without_copies(table(CASES, clash=True))
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6, 7, 9]
    assert left.columns == table(CASES, clash=True).columns


def test_empty(table):
    assert exact_dedup.exact_groups(table([])).count() == 0
    assert exact_dedup.without_copies(table([])).count() == 0


def test_native(table):
    plan = exact_dedup.exact_groups(table(CASES)).filter(F.col("kept"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
