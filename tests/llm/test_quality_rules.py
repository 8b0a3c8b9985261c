"""Quality rules: measures against regular expressions, thresholds against labels, edge cases."""

import random
import re
from collections import Counter

from wardflow.llm import quality_rules, queries


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count = Counter(windows)
    again = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))


def test_measures():
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a b c d e", "a b c d e a b c d e", "x " * 50, "é é é\x0b\x1f\xa0 q\r\n"]
    texts += ["".join(rng.choice("ab  \n#|é\x0c") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += [" ".join(str(rng.randrange(9000)) for _ in range(20000)) + " 1 2 3 4 5 1 2 3 4 5"]
    for t in texts:
        assert quality_rules.text_measures(t)[:5] == brute_measures(t)


def test_query_on_labelled_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op1_quality_rules(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    share = {(r["quality"], r["kept"]): r["count"] for r in found.filter("not base_failed").groupBy("quality", "kept").count().collect()}
    assert share.get((1, False), 0) <= 0.01 * share[1, True]
    assert share.get((0, True), 0) <= 0.15 * share[0, False]


def test_thresholds_follow_their_group(table):
    plain = [(k, "one two three four five six seven eight nine ten eleven twelve"[: 60 + k % 5] + f" w{k}", "en", "a") for k in range(200)]
    marked = [(1000 + k, f"# {k} | one | two | three | four | five | six | seven | eight | nine", "en", "b") for k in range(200)]
    odd = [(5000, marked[0][1], "en", "a"), (5001, "# 7 | one | two | three | four | five | six | seven | eight | nine", "en", "rare")]
    found = {r["doc_id"]: r for r in quality_rules.judged(table(plain + marked + odd, clash=True)).collect()}
    assert found[1000]["kept"] and not found[5000]["kept"] and "symbols" in found[5000]["failed_rules"]
    assert (found[1000]["threshold_level"], found[5001]["threshold_level"]) == (0, 1)


def test_edges(table):
    found = quality_rules.judged(table([(1, None), (2, ""), (3, "a b"), (None, "x " * 100000), (4, "a b"), (4, "a b")]))
    assert [r["kept"] for r in found.collect()] == [False] * 6
    assert quality_rules.judged(table([])).count() == 0


def test_sketch_error(spark):
    from pyspark.sql import functions as F

    worst = spark.range(1, 200000).select(((F.col("id") - quality_rules.bucket(F.col("id"))) / F.col("id")).alias("e")).agg(F.max("e"), F.min("e")).first()
    assert 0 <= worst[1] and worst[0] < 0.02


def test_fences_come_from_the_sketch(table):
    """In groups of constant, spread and rare values the fence follows the values, and each rule can fire."""
    text = "one two three four five six seven eight nine ten"
    docs = [(k, f"{text} w{k}", "en", "a") for k in range(300)]
    docs += [(1000 + k, f"{text} w{k}" + " wow!" * (k % 20), "en", "b") for k in range(300)]
    docs += [(5000, f"{text} so!", "en", "a"), (5001, f"{text} so!", "en", "b"), (5002, f"{text}\nk l\nk l", "en", "a")]
    found = {r["doc_id"]: r["failed_rules"] for r in quality_rules.judged(table(docs)).collect()}
    assert found[0] == "" and "marks" in found[5000] and "marks" not in found[5001] and "dup_lines" in found[5002]


def test_many_repeated_lines_fail(spark):
    found = queries.op1_quality_rules(spark, "/root/testdata/sf0.1").filter("1000 * n_dup_lines > 300 * n_lines and not base_failed")
    assert found.count() > 5 and found.filter("kept").count() == 0
