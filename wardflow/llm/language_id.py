"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads blocks of bytes in both directions, labels every position, and the mean of a text's position
probabilities is the text's. It is trained here, in numpy, by backpropagation through time on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import first_by_hash

#: Label of texts that are null or have no letter.
UNDETERMINED = "und"
#: Hidden units of a direction, bytes of a block, blocks computed together.
HIDDEN, BLOCK, TOGETHER = 8, 64, 2048
#: Rows of each language learnt from, at most, and characters of each, unless fit() is told otherwise.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 480
EPOCHS, BATCH, RATE, SEED = 4, 128, 0.02, 11
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """Weights of both directions: input table (3H, 256), recurrence (3H, H); and of the labels: (C, 2H), (C, 1)."""

    labels: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    head: np.ndarray
    bias: np.ndarray

    @property
    def parameters(self) -> list[np.ndarray]:
        return [*self.table, *self.recurrent, self.head, self.bias]


def fresh(labels: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return Network(
        labels,
        [draw(3 * hidden, 256, scale=0.3) for _ in range(2)],
        [draw(3 * hidden, hidden, scale=0.5 / np.sqrt(hidden)) for _ in range(2)],
        draw(len(labels), 2 * hidden, scale=0.3),
        np.zeros((len(labels), 1), np.float32),
    )


def run_direction(table: np.ndarray, recurrent: np.ndarray, blocks: np.ndarray, backwards: bool, keep: bool):
    """Hidden states (T, H, B) of a gated recurrent unit over blocks (T, B); with keep, also what training needs."""
    steps, width = blocks.shape
    hidden = recurrent.shape[1]
    states = np.empty((steps, hidden, width), np.float32)
    h = np.zeros((hidden, width), np.float32)
    kept = []
    for t in range(steps - 1, -1, -1) if backwards else range(steps):
        x = np.take(table, blocks[t], axis=1)
        g = recurrent @ h
        gates = x[: 2 * hidden]
        gates += g[: 2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[:hidden], gates[hidden:]
        n = x[2 * hidden :]
        n += r * g[2 * hidden :]
        np.tanh(n, out=n)
        before, out = h, states[t]
        np.subtract(h, n, out=out)
        out *= z
        out += n
        h = out
        if keep:
            kept.append((t, before, z, r, n, g[2 * hidden :]))
    return states, kept


def position_probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """Label probabilities (T, C, B) from the states of both directions (T, 2H, B)."""
    scores = net.head @ states + net.bias
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def gradients(net: Network, blocks: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over positions and its gradients; blocks (T, B), one wanted label per block."""
    steps, width = blocks.shape
    hidden = net.recurrent[0].shape[1]
    runs = [run_direction(net.table[d], net.recurrent[d], blocks, bool(d), True) for d in range(2)]
    states = np.concatenate([runs[0][0], runs[1][0]], axis=1)
    error = position_probabilities(net, states)
    loss = -float(np.log(error[:, wanted, np.arange(width)] + 1e-9).mean())
    error[:, wanted, np.arange(width)] -= 1
    error /= steps * width
    d_head = np.einsum("tcb,thb->ch", error, states, optimize=True)
    d_bias = error.sum(axis=(0, 2))[:, None]
    d_states = net.head.T @ error
    d_tables, d_recurrent = [], []
    for d in range(2):
        recurrent, into = net.recurrent[d], d_states[:, d * hidden : (d + 1) * hidden]
        at_input = np.empty((3 * hidden, steps, width), np.float32)
        d_r = np.zeros_like(recurrent)
        carried = np.zeros((hidden, width), np.float32)
        for t, before, z, r, n, g_n in reversed(runs[d][1]):
            dh = into[t] + carried
            d_n = dh * (1 - z) * (1 - n * n)
            d_z = dh * (before - n) * z * (1 - z)
            d_reset = d_n * g_n * r * (1 - r)
            dg = np.concatenate([d_z, d_reset, d_n * r])
            at_input[:, t] = np.concatenate([d_z, d_reset, d_n])
            d_r += dg @ before.T
            carried = dh * z + recurrent.T @ dg
        flat, where = at_input.reshape(3 * hidden, -1), blocks.ravel()
        d_tables.append(np.stack([np.bincount(where, row, 256) for row in flat]).astype(np.float32))
        d_recurrent.append(d_r)
    return loss, [*d_tables, *d_recurrent, d_head, d_bias]


def as_blocks(raw: bytes, block: int = BLOCK) -> np.ndarray:
    """Bytes in rows of one block each, the last filled up with spaces."""
    padded = raw + b" " * (-len(raw) % block)
    return np.frombuffer(padded, np.uint8).reshape(-1, block)


def learn(texts: list[tuple[str, str]], seed: int = SEED) -> Network:
    """Trains on pairs of text and label with Adam; the result depends on nothing but the pairs."""
    labels = sorted({label for _, label in texts})
    net = fresh(labels, seed=seed)
    if len(labels) < 2:
        return net
    own = [(as_blocks(text.encode()), labels.index(label)) for text, label in texts if text]
    blocks = np.concatenate([b for b, _ in own])
    wanted = np.concatenate([np.full(len(b), k) for b, k in own])
    rng = np.random.default_rng(seed)
    mean, square = [[np.zeros_like(p) for p in net.parameters] for _ in range(2)]
    step, last = 0, EPOCHS * (-(-len(blocks) // BATCH))
    for _ in range(EPOCHS):
        order = rng.permutation(len(blocks))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _, found = gradients(net, np.ascontiguousarray(blocks[some].T), wanted[some])
            step += 1
            size = np.sqrt(sum(float((g * g).sum()) for g in found))
            rate = RATE * (1 - 0.9 * step / last)
            for p, g, m, v in zip(net.parameters, found, mean, square):
                g = g * min(1.0, 1.0 / (size + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean label probabilities (texts, C) over all bytes of each text; uniform for an empty one."""
    sums = np.zeros((len(texts), len(net.labels)))
    owner, parts, tail = [], [], []

    def flush() -> None:
        if parts:
            blocks = np.ascontiguousarray(np.concatenate(parts).T)
            used = np.concatenate(tail)
            states = np.concatenate([run_direction(net.table[d], net.recurrent[d], blocks, bool(d), False)[0] for d in range(2)], axis=1)
            found = position_probabilities(net, states)
            found *= np.arange(BLOCK)[:, None, None] < used[None, None, :]
            np.add.at(sums, np.concatenate(owner), found.sum(axis=0).T)
            owner.clear(), parts.clear(), tail.clear()

    held = 0
    for k, raw in enumerate(texts):
        if not raw:
            continue
        rows = as_blocks(raw)
        used = np.full(len(rows), BLOCK)
        used[-1] = len(raw) - BLOCK * (len(rows) - 1)
        for at in range(0, len(rows), TOGETHER):
            part = rows[at : at + TOGETHER]
            parts.append(part), tail.append(used[at : at + TOGETHER]), owner.append(np.full(len(part), k))
            held += len(part)
            if held >= TOGETHER:
                flush()
                held = 0
    flush()
    total = sums.sum(axis=1, keepdims=True)
    return np.where(total > 0, sums / np.maximum(total, 1e-30), 1 / max(1, len(net.labels)))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> Network:
    """Trains on at most `rows` rows of each language, those with the smallest hashes of their keys.

    Of each, `chars` characters at a place given by the hash are learnt from, which bounds the steps that gradients go back.
    Rows without key, language or text teach nothing. The keys are chosen first, from two narrow columns, and the texts
    of the chosen ones fetched then.
    """
    keys = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("key"), F.col(lang_col).alias("label"))
    chosen = first_by_hash(keys, rows).select("key", "label").distinct()
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    text = F.col("text")
    start = F.pmod(F.xxhash64("key"), F.greatest(F.length(text) - chars + 1, F.lit(1))) + 1
    taken = (
        own.join(F.broadcast(chosen), (F.col("doc_id") == F.col("key")) & (F.col("lang") == F.col("label")))
        .filter(F.length(text) > 0)
        .select("label", "key", F.substring(text, start.cast("int"), F.lit(chars)).alias("window"))
    )
    most = 2 * rows * max(1, chosen.select("label").distinct().count())
    found = taken.orderBy(F.xxhash64("key"), "key", "label", "window").limit(most).collect()
    return learn([(r["window"], r["label"]) for r in found])


def predicted(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row from its whole text; `und` and 0 for null texts and those without letter.

    Keys may be null or repeat; an empty table gives no rows. A network that has learnt no language answers `und`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            known = [bool(own.labels and t and LETTER.search(t)) for t in texts]
            shares = pooled(own, [t.encode() if k else b"" for t, k in zip(texts, known)])
            best = shares.argmax(axis=1) if own.labels else np.zeros(len(texts), int)
            names = [own.labels[b] if k else UNDETERMINED for b, k in zip(best, known)]
            score = [float(row[b]) if k else 0.0 for row, b, k in zip(shares, best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return rows.mapInArrow(predict, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
