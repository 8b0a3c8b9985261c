"""The recurrent network: gradients, held-out accuracy, edge cases."""

import numpy as np

from pyspark.sql import functions as F

from wardflow.llm import language_id, queries


def test_gradients():
    net = language_id.fresh(["a", "b", "c"], hidden=4)
    net.table = [t.astype(np.float64) for t in net.table]
    rng = np.random.default_rng(0)
    blocks, wanted = rng.integers(0, 256, (9, 7)).astype(np.uint8), rng.integers(0, 3, 7)
    _, found = language_id.gradients(net, blocks, wanted)
    for p, g in zip(net.parameters, found):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        held, step = p[at], 1e-3
        p[at] = held + step
        up, _ = language_id.gradients(net, blocks, wanted)
        p[at] = held - step
        down, _ = language_id.gradients(net, blocks, wanted)
        p[at] = held
        assert abs(g[at] - (up - down) / (2 * step)) < 0.02 * abs(g[at]) + 1e-4


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op4_language_id(spark, sf_dir).join(queries.documents(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    right, every = found.filter("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert right >= 0.98 * every


def test_pooling_does_not_depend_on_company():
    net = language_id.fresh(["a", "b"])
    texts = [b"x" * n for n in (1, 63, 64, 65, 5000)] + [b"", "é".encode() * 300]
    together = language_id.pooled(net, texts)
    assert np.allclose(together, np.concatenate([language_id.pooled(net, [t]) for t in texts]), atol=1e-5)
    assert np.allclose(together[5], 0.5)


def test_edges(table):
    rows = [(k, "the and of with house", "en") for k in range(30)] + [(100 + k, "der und das mit haus", "de") for k in range(30)]
    docs = table([*rows, (None, "x", "en"), (7, None, "en"), (8, "abc", None)], clash=True)
    net = language_id.fit(docs, rows=20)
    assert net.labels == ["de", "en"]
    odd = table([(1, None), (2, ""), (3, "12 34 !?"), (None, "the and of"), (5, "und das " * 30000), (5, "und das " * 30000)], clash=True)
    found = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in language_id.predicted(odd, net).collect()))
    assert [f[1] for f in found] == ["en", "und", "und", "und", "de", "de"] and all(0 <= f[2] <= 1 for f in found)
    assert language_id.predicted(table([]), net).count() == 0
    assert language_id.predicted(odd, language_id.fit(table([]))).filter("lang_pred <> 'und'").count() == 0


def test_forward_pass_by_loops():
    """Every position and gate computed one by one, over blocks of a text, in both directions."""
    net = language_id.fresh(["a", "b", "c"], hidden=3, seed=5)
    raw = ("Grüße, world! " * 9).encode()[:100]

    def logistic(x):
        return 1 / (1 + np.exp(-x))

    def states(block, d):
        table, recurrent, h, out = net.table[d], net.recurrent[d], [0.0] * 3, {}
        for t in reversed(range(len(block))) if d else range(len(block)):
            g = [sum(recurrent[k][j] * h[j] for j in range(3)) for k in range(9)]
            x = [table[k][block[t]] for k in range(9)]
            z, r = [logistic(x[k] + g[k]) for k in range(3)], [logistic(x[3 + k] + g[3 + k]) for k in range(3)]
            n = [np.tanh(x[6 + k] + r[k] * g[6 + k]) for k in range(3)]
            h = [z[k] * h[k] + (1 - z[k]) * n[k] for k in range(3)]
            out[t] = h
        return out

    total = np.zeros(3)
    for block, used in zip(language_id.as_blocks(raw).tolist(), (64, 36)):
        ways = [states(block, d) for d in range(2)]
        for t in range(used):
            scores = [sum(w * s for w, s in zip(net.head[c], ways[0][t] + ways[1][t])) + net.bias[c][0] for c in range(3)]
            total += np.exp(scores) / np.exp(scores).sum()
    assert np.allclose(language_id.pooled(net, [raw])[0], total / total.sum(), atol=1e-4)


def test_letters(table):
    texts = ["²½①", "Ⅷ ٣", "12 _-!", "x", "日", "é", "́", "a1"]
    found = language_id.predicted(table(list(enumerate(texts))), language_id.fresh(["aa", "bb"])).collect()
    assert [r["lang_pred"] == "und" for r in sorted(found, key=lambda r: r["doc_id"])] == [True, True, True, False, False, False, True, False]
