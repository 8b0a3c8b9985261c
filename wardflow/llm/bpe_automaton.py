"""Byte-level BPE as a deterministic automaton.

Compilation starts from one state that every byte leads back to, and applies one gadget per merge (a, b), in order: the
arcs labelled ``a`` are led to a copy of their target that lacks the arc ``b``, and wherever ``a`` could be read, ``ab``
can now be read, leading to where ``b`` led. In the end the automaton accepts exactly the token sequences that the
merges produce. A copy is kept as its difference: the label that arrives there, the merge that made it, and the arc it
lacks; so the automaton has one record per merge instead of one row of 50,000 arcs.

Encoding reads a word's bytes. The token arcs are spelled out as bytes on a trie, and the set of arcs that can be under
way after some bytes is one state of a deterministic byte automaton, made when first met (subset construction) and kept
in a table. Each transition yields the last token of the prefix read so far, which is unique; walking back over these
from the word's end gives its tokens. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

#: Byte automaton states, and encoded words, that one worker keeps: about 150 MB. Beyond, it drops the states, and the words
#: not met for long; results stay the same.
KEPT_STATES, KEPT_WORDS = 160_000, 300_000
#: Longer words are not kept.
KEPT_LENGTH = 64
#: Fixed pattern of the vocabulary that splits a text into words before merging.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Up to this character, all Unicode versions agree on letters, digits and spaces.
SETTLED = regex.compile(r"[^\x00-ԯ]")


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    """The compiled merges of one vocabulary."""

    def __init__(self, merges: list[tuple[str, str]], vocabulary: dict[str, int], added: dict[str, int] | None = None):
        to_byte = byte_characters()
        self.label = {i: bytes(to_byte[c] for c in token) for token, i in vocabulary.items()}
        self.added = added or {}
        self.label |= {i: text.encode() for text, i in self.added.items()}
        self.start = 1 << 31
        self._born = {vocabulary[c]: 0 for c in to_byte if c in vocabulary}
        self._parts: dict[int, tuple[int, int]] = {}
        self._lacks: dict[tuple[int, int], int] = {}
        for time, (a, b) in enumerate(merges, 1):
            self._gadget(time, vocabulary[a], vocabulary[b], vocabulary[a + b])
        self._children: list[dict[int, int]] = [{}]
        self._token_at: list[int] = [-1]
        for token in self._born:
            self._spell(token)
        self._split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self._words: dict[str, bytes] = {}
        self._older_words: dict[str, bytes] = {}
        self._start_over()

    def _gadget(self, time: int, a: int, b: int, ab: int) -> None:
        """Applies the merge (a, b) unless b can no longer follow a or ab is there already."""
        if ab in self._born or not self._can_read(a, time, b):
            return
        self._lacks[a, b] = time
        self._born[ab], self._parts[ab] = time, (a, b)

    def _can_read(self, state: int, time: int, token: int) -> bool:
        """Whether the state that label `state` leads to has an arc `token` before the gadget of `time`.

        A token made after the state's label was added where its left part could be read after the same gadget had made
        its copy; an older one came with the state that the label's right part led to, of which this state is a copy.
        """
        while True:
            if state == self.start:
                return True
            if self._lacks.get((state, token), time) < time:
                return False
            born = self._born[token]
            if born > self._born[state]:
                time, token = min(time, born + 1), self._parts[token][0]
            elif state in self._parts:
                time, state = min(time, self._born[state]), self._parts[state][1]
            else:
                return True

    def allows(self, last: int, token: int) -> bool:
        """The finished automaton's arc from the state after `last`; looked up once per pair."""
        known = self._reads.get(pair := last << 32 | token)
        if known is None:
            known = self._reads[pair] = self._can_read(last, 1 << 60, token)
        return known

    def _spell(self, token: int) -> None:
        node = 0
        for b in self.label[token]:
            child = self._children[node].get(b)
            if child is None:
                child = self._children[node][b] = len(self._children)
                self._children.append({})
                self._token_at.append(-1)
            node = child
        self._token_at[node] = token

    def _start_over(self) -> None:
        """Empties the tables that grow with the words met, but for the byte state that words begin in.

        A state is numbered by its set of arcs under way, each the label before it and its place on the trie in one
        number; the table leads from a state and a byte to the next state and the last token of the prefix, likewise.
        """
        first = (self.start << 32,)
        self._reads: dict[int, bool] = {}
        self._states = {first: 0}
        self._under_way = [first]
        self._table: dict[int, int] = {}

    def _step(self, state: int, byte: int) -> int:
        """Makes the transition of a byte state."""
        going, last = [], -1
        for arc in self._under_way[state]:
            before, node = arc >> 32, arc & 0xFFFFFFFF
            child = self._children[node].get(byte)
            if child is None:
                continue
            token = self._token_at[child]
            if token >= 0 and self.allows(before, token):
                last = token
            if self._children[child]:
                going.append(before << 32 | child)
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        subset = (*going, last << 32)
        full = len(self._under_way) >= KEPT_STATES  # also within a word, which may be long
        if full:
            self._start_over()
        to = self._states.get(subset)
        if to is None:
            to = self._states[subset] = len(self._under_way)
            self._under_way.append(subset)
        made = to << 32 | last
        if not full:
            self._table[state << 8 | byte] = made
        return made

    def word(self, word: str) -> bytes:
        """Ids of a pre-split word as little-endian unsigned 32-bit integers."""
        found = self._older_words.get(word)
        if found is None:
            label, state, last = self.label, 0, []
            raw = word.encode()
            for b in raw:
                arc = self._table.get(state << 8 | b)
                if arc is None:
                    arc = self._step(state, b)
                state = arc >> 32
                last.append(arc & 0xFFFFFFFF)
            ids, at = [], len(raw)
            while at:
                token = last[at - 1]
                ids.append(token)
                at -= len(label[token])
            ids.reverse()
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= KEPT_LENGTH:
            if 2 * len(self._words) >= KEPT_WORDS:
                self._older_words, self._words = self._words, {}
            self._words[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; texts of added tokens become those tokens."""
        if self._split_added is None:
            return self._plain(text)
        parts = self._split_added.split(text)
        return b"".join(
            struct.pack("<I", self.added[part]) if k % 2 else self._plain(part) for k, part in enumerate(parts)
        )

    def _plain(self, text: str) -> bytes:
        if SETTLED.search(text):
            words = [text[a:b] for _, (a, b) in pre_split().pre_tokenize_str(text)] if text else []
        else:
            words = SPLIT.findall(text)
        out, word = [], self.word
        for w in words:
            out.append(self._words.get(w) or word(w))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, joined; bytes that are no UTF-8 become the replacement character."""
        label = self.label
        return b"".join([label[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def pre_split():
    """The vocabulary's own splitter, for texts with characters on which Unicode versions differ."""
    return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


@lru_cache(maxsize=2)
def compiled(path: str) -> Automaton:
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in held["model"]["merges"]]
    added = {t["content"]: t["id"] for t in held["added_tokens"]}
    vocabulary = {t: i for t, i in held["model"]["vocab"].items() if t not in added}
    return Automaton(pairs, vocabulary, added)


def encoded(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and decoded text of every row; a null text counts as empty.

    vocabulary is a file on the driver, which Spark sends to the executors. Keys may be null or repeat; an empty table
    gives an empty result. Each worker compiles the merges once and keeps what it has met within fixed bounds.
    """
    name = _sent(docs.sparkSession, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(SparkFiles.get(name))
        for batch in batches:
            for part in _pieces(batch):
                ids = [automaton.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(map(automaton.decode, ids), pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids binary, decoded string")


def token_digest(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, without moving ids or texts out of the workers."""
    name = _sent(docs.sparkSession, vocabulary)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(SparkFiles.get(name))
        for batch in batches:
            counts, sums, decoded = [], [], []
            for text in batch.column(1):
                ids = automaton.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                sums.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(automaton.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _pieces(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices of a batch, so that the encoded copy of only a few texts is held at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _sent(spark: SparkSession, path: str) -> str:
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]
