"""Spelling variants against SQL and against comparing all words, and edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import rows
from tests.oracle import connect, difference
from wardflow.llm import queries, spelling

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def edits(word, letters):
    """Every text one edit away."""
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            yield word[:k] + word[k + 1 :]
            yield from (word[:k] + c + word[k + 1 :] for c in letters if c != word[k])


def brute(texts, every=None):
    """All words by trying every edit of every word."""
    lower = {c: c + 32 for c in range(65, 91)}
    n = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    letters = sorted(set("".join(n)))
    form, near = {}, {}
    for w in n:
        around = {x for x in edits(w, letters) if x in n and x != w}
        best = min(around, key=lambda x: (-n[x], x), default=None)
        near[w], form[w] = len(around), best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_oracle(spark, sf_dir):
    assert difference(connect(sf_dir), queries.op11_spelling(spark, sf_dir), queries.ORACLES["op11_spelling"]) is None


def test_query_by_all_edits(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in queries.documents(spark, sf_dir).select("doc_id", "text").collect()]
    assert rows(queries.op11_spelling(spark, sf_dir), *COLUMNS) == brute(texts, 199)


def made_texts():
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words = stems * 30
    for stem in stems:
        words += rng.sample(list(edits(stem, "abcé")), 12) * rng.choice([4, 5, 6])
    chain = ["kettle"] * 5 + ["kettles"] * 25 + ["nettles"] * 125 + ["nettlesx"] * 625
    ties = ["lanterna", "lanternb"] * 50 + ["lantern"] * 10
    return [(k, " ".join(words[k::40])) for k in range(40)] + [(40, " ".join(chain)), (41, "ABCDEF÷ÀÉÎ abcdef×àéî " * 5), (None, " ".join(ties))]


@pytest.mark.parametrize("cell_points", [spelling.CELL_POINTS, 20, 1])
def test_cells_change_nothing(table, cell_points):
    found = spelling.variants(table(made_texts(), clash=True), cell_points=cell_points)
    want = brute(made_texts())
    assert rows(found, *COLUMNS) == want
    by_word = {w[0]: w for w in want}
    assert by_word["kettle"][2] == "nettlesx" and by_word["lantern"][1] == "lanterna"


def test_edges(table):
    long = "ab" * 50000
    cases = [(1, None), (2, ""), (3, long), (4, f"{long} {long} {long} {long}c x{long}"), (5, "short five " * 9), (5, "short five " * 9), (6, "Ångström " * 5)]
    assert rows(spelling.variants(table(cases)), "word", "n") == [("Ångström".replace("Å", "Å"), 5)]
    again = [(k, f"{long} {long}c") for k in range(5)]
    assert rows(spelling.variants(table(again)), "n", "n_near") == [(5, 1), (5, 1)]
    assert spelling.variants(table([])).collect() == []


def test_tree_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 3, (400, spelling.LETTERS)) * (rng.random((400, spelling.LETTERS)) < 0.08)
    queries_ = points + np.eye(spelling.LETTERS, dtype=int)[rng.integers(0, spelling.LETTERS, 400)]
    tree = spelling.Tree(points, 8)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(400)) and len(tree.leaves) > 30
    own = tree.own(points)
    for difference, (up, down) in spelling.REACH.items():
        met = {(int(q), leaf) for leaf, which in tree.reached(queries_, up, down) for q in which}
        apart = points[None] - queries_[:, None]
        fits = (np.maximum(apart, 0).sum(2) <= up) & (np.maximum(-apart, 0).sum(2) <= down)
        assert all((int(q), int(own[p])) in met for q, p in zip(*np.nonzero(fits)))
        assert len(met) < 400 * len(tree.leaves) / 3


@pytest.mark.parametrize("a,b,near", [("abc", "abc", False), ("abc", "abd", True), ("abc", "acb", False), ("abc", "ab", True), ("ac", "abc", True), ("bc", "abd", False)])
def test_one_edit(a, b, near):
    assert spelling.one_edit(a, b) is spelling.one_edit(b, a) is near
