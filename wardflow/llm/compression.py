"""A quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled text. A text is cut into blocks, each compressed
with either dictionary; the difference of the two sizes over the length of the text tells which it resembles. That
number is calibrated to a probability by logistic regression on labelled text that made no dictionary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import first_by_hash

#: Labelled rows of each class that are learnt from, at most, and characters of a text that go into a dictionary, unless
#: fit() is told otherwise.
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 8192
#: Bytes of a dictionary, and of the blocks that texts are cut into.
DICTIONARY_BYTES, BLOCK = 65536, 1024
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the texts themselves if they are too few to train one."""
    blocks = [t[at : at + BLOCK] for t in texts for at in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


@lru_cache(maxsize=4)
def compressor(held: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(held)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_dict_id=False)


def features(raw: bytes, good: bytes, bad: bytes) -> tuple[float, float]:
    """The normalised difference of compressed sizes, positive if good text helps more; and 1 / sqrt(length)."""
    if not raw:
        return 0.0, 1.0
    by_good, by_bad = compressor(good).compress, compressor(bad).compress
    a = b = 0
    for at in range(0, len(raw), BLOCK):
        block = raw[at : at + BLOCK]
        a += len(by_good(block))
        b += len(by_bad(block))
    return (b - a) / len(raw), 1 / math.sqrt(len(raw))


def inputs(difference: float, shortness: float) -> tuple[float, ...]:
    return 1.0, 20 * difference, 10 * shortness, 200 * difference * shortness


def calibrated(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.01) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(weights: tuple[float, ...], x: tuple[float, ...]) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x))))))


def joined_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """label, key, n and text of the labelled documents that are learnt from."""
    key = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).alias("label"))
    chosen = first_by_hash(key, rows)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = own.join(F.broadcast(chosen), F.col("doc_id") == F.col("key")).filter(F.length("text") > 0)
    return joined.select(F.col("label").cast("int").alias("label"), "key", "n", "text")


def measured(sample: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """label, difference and shortness of whole texts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py().encode(), good, bad) for t in batch.column(1)]
            columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["label", "difference", "shortness"])

    return sample.select("label", "text").mapInArrow(measure, "label int, difference double, shortness double")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> Model:
    """Learns from at most `rows` labelled documents of each class, those of the smallest hashes of their keys.

    labels holds keys and classes 1 and 0. Rows without key, class or text are not learnt from; a key labelled twice
    counts by its larger class. Every second document goes into a dictionary: of a long text `chars` characters, at a place
    given by its hash. The others, as whole texts that their tasks measure, calibrate the score; if a class has none, those of
    the dictionaries do. Without both classes every score is 0.5.
    """
    sample = joined_sample(docs, labels, id_col, text_col, label_col, rows)
    text, in_dictionary = F.col("text"), F.col("n") % 2 == 1
    start = F.pmod(F.xxhash64("key"), F.greatest(F.length(text) - chars + 1, F.lit(1))) + 1
    windows = sample.filter(in_dictionary).select("label", "key", F.substring(text, start.cast("int"), F.lit(chars)).alias("window"))
    found = windows.orderBy(F.xxhash64("key"), "key", "window").limit(2 * rows).collect()
    good, bad = ([r["window"].encode() for r in found if r["label"] == c] for c in (1, 0))
    if not good or not bad:
        return Model(b"\0" * 8, b"\0" * 8, (0.0,) * 4)
    good, bad = dictionary(good), dictionary(bad)
    held = measured(sample.filter(~in_dictionary), good, bad).limit(2 * rows).collect()
    if len({r["label"] for r in held}) < 2:
        held += measured(sample.filter(in_dictionary), good, bad).limit(2 * rows).collect()
    held = sorted(map(tuple, held))
    x = np.array([inputs(*f) for _, *f in held])
    return Model(good, bad, tuple(map(float, calibrated(x, np.array([float(y) for y, *_ in held])))))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score, the probability of class 1, of every row from its whole text; null counts as empty.

    An empty text has no difference and gets the score of that. Keys may be null or repeat; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = [probability(m.weights, inputs(*features((t.as_py() or "").encode(), m.good, m.bad))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is at least `least`, with all their columns, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([probability(m.weights, inputs(*features((t or "").encode(), m.good, m.bad))) for t in texts], dtype="float64")

    return docs.filter(score(F.col(text_col)) >= least)
