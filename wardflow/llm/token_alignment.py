"""Alignment of two tokenizers' outputs over the same text, anchored at white space.

Each text is encoded whole by a byte-level vocabulary (A) and by a piece vocabulary (B). A byte offset at which tokens of
both end, and after which A's next token begins with the space mark, is an anchor; anchors are verified on the offsets
of the tokens themselves, so it does not matter whether either tokenizer lets tokens cross white space. Anchors cut the
text into windows of token ids. Which tokens of a window overlap depends on its ids alone, so its links are worked out
once per worker and looked up by the ids afterwards; so it is with every document. Groups end wherever tokens of both end.

The first pass stores per document its counts and its id pairs, and adds up the pairs of all documents. The second pass
needs the corpus-wide counts of a document's pairs: those of frequent pairs go to all executors, as many as a share of
all links can be; the pairs left over are joined by a shuffle.
"""

from __future__ import annotations

import gc
import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe_automaton import SETTLED, SPLIT, byte_characters
from .shared import checkpointed, sent_file, stored

#: Tokens of the windows that one worker remembers, about 20 MB; more would be slower, as they leave the caches of the
#: processor. Beyond, it forgets those not met for long. Results
#: stay the same.
KEPT_TOKENS = 400_000
#: Id pairs that one task adds up before it hands them on.
HELD_PAIRS = 500_000
#: Pairs with at least a link in so many are frequent; so at most that many pairs of 17 bytes are broadcast.
SHARE = 131_072
#: Texts that are encoded together.
BATCH = 128

DOCUMENT, PAIRS = 0, 1


class Sides:
    """Both tokenizers, and the bytes that each of their ids stands for."""

    def __init__(self, byte_level: str, pieces: str):
        with open(byte_level, encoding="utf-8") as f:
            held = json.load(f)
        to_byte = byte_characters()
        special = {t["id"]: t["content"].encode() for t in held["added_tokens"]}
        vocabulary = {bytes(to_byte[c] for c in t): i for t, i in held["model"]["vocab"].items() if i not in special}
        self._library = Tokenizer.from_file(byte_level)
        self._library.encode_special_tokens = True
        self._library.no_truncation()
        self._library.no_padding()
        # Ids in the order of their merges serve as ranks; then the faster encoder gives the same tokens.
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in held["model"]["merges"]]
        made = [held["model"]["vocab"][a + b] for a, b in merges]
        in_order = made == sorted(set(made)) and (not made or made[0] > max(held["model"]["vocab"][c] for c in to_byte))
        self._ranked = tiktoken.Encoding("a", pat_str=SPLIT.pattern, mergeable_ranks=vocabulary, special_tokens={}) if in_order else None
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = self._by_id({**{i: t for t, i in vocabulary.items()}, **special})
        self.b_bytes = [self._piece(i) for i in range(self._pieces.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self._a_spelled, self._b_spelled = (
            (sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(held), np.uint8))
            for held, sizes in ((self.a_bytes, self.a_sizes), (self.b_bytes, self.b_sizes))
        )
        self.a_spaced = np.array([t.startswith(b" ") for t in self.a_bytes])
        # Every id as it stands in the text of the groups: before another id of its side, at A's end, at B's end.
        self.ids = max(len(self.a_bytes), len(self.b_bytes))
        written = np.array([f"{i}{mark}".encode() for i in range(self.ids) for mark in ",|;"])
        self.written = written.astype(f"S{-(-written.itemsize // 8) * 8}").view(np.uint64).reshape(len(written), -1)

    @staticmethod
    def _by_id(labels: dict[int, bytes]) -> list[bytes]:
        return [labels.get(i, b"") for i in range(max(labels) + 1)]

    def _piece(self, i: int) -> bytes:
        piece = self._pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides per text; none where either does not give the text back."""
        none = np.zeros(0, np.uint32)
        for text in texts:
            spaced = " " + text
            if self._ranked is not None and not SETTLED.search(text):
                a = self._ranked.encode_ordinary(spaced)
            else:
                a = self._library.encode(spaced, add_special_tokens=False).ids
            a, b = np.frombuffer(array("I", a), np.uintc), self._pieces.encode(text, out_type="numpy")
            raw = np.frombuffer(spaced.encode(), np.uint8)
            same = text and self._spells(a, raw, *self._a_spelled) and self._spells(b, raw, *self._b_spelled)
            yield (a, b) if same else (none, none)

    @staticmethod
    def _spells(ids: np.ndarray, raw: np.ndarray, sizes: np.ndarray, starts: np.ndarray, spelled: np.ndarray) -> bool:
        """Whether the bytes of the ids, one after the other, are those of the text."""
        length = sizes[ids]
        ends = np.cumsum(length)
        if not len(ids) or ends[-1] != len(raw):
            return False
        return np.array_equal(spelled[np.arange(len(raw)) + np.repeat(starts[ids] - ends + length, length)], raw)


@lru_cache(maxsize=1)
def sides(byte_level: str, pieces: str) -> Sides:
    return Sides(byte_level, pieces)


@lru_cache(maxsize=1)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """The worker's aligner, which later tasks of the worker go on using."""
    return Aligner(sides(byte_level, pieces))


def overlaps(a: np.ndarray, b: np.ndarray, at: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens whose bytes overlap, as packed ids in the order of A, and where those of each A token begin.

    ``at`` is the token of B in which each token of A ends, ``same`` whether both end there.
    """
    first = np.concatenate([[0], at[:-1] + same[:-1]])
    times = at - first + 1
    begins = np.concatenate([[0], np.cumsum(times)])
    b_at = np.arange(begins[-1]) + np.repeat(first - begins[:-1], times)
    return np.repeat(a.astype(np.int64) << 32, times) | b[b_at], begins


class Aligner:
    """Aligns documents window by window and remembers the windows it has met.

    An alignment is a window's links, as packed id pairs. Windows of a document that are new are aligned together, on arrays
    over the document. Only if asked for: if after the documents ``tried`` most had a new window, further ones are not cut.
    """

    def __init__(self, both: Sides, kept: int = KEPT_TOKENS, tried: int | None = None):
        self._both, self._kept, self._held = both, kept, 0
        self._tried, self._met, self._answered = tried, 0, 0
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        # No id is as large as the mark that stands between the ids of both sides.
        self._kind = np.dtype("<u2" if both.ids < 1 << 16 else "<u4")

    def anchors(self, a: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The cuts of both sides (each anchor, the beginning and the end), and the tokens of A and B after each shared end."""
        at = np.searchsorted(ends_b, ends_a)
        return self._cut(a, at, ends_b[at] == ends_a)

    def _cut(self, a: np.ndarray, at: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        after_a, after_b = self._after(at, same)
        cut = self._both.a_spaced[a[after_a[:-1]]]
        cuts = [np.concatenate([[0], after[:-1][cut], after[-1:]]) for after in (after_a, after_b)]
        return *cuts, after_a, after_b

    @staticmethod
    def _after(at: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = np.flatnonzero(same)
        return shared + 1, at[shared] + 1

    def keys(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[bytes]:
        """The id tuples of the windows, as bytes: ids of A, a mark, ids of B."""
        ends = cuts_a[1:] + cuts_b[1:] + np.arange(1, len(cuts_a))
        marks = cuts_a[1:] + cuts_b[:-1] + np.arange(len(cuts_a) - 1)
        both = np.full(ends[-1], np.iinfo(self._kind).max, self._kind)
        both[np.arange(len(a)) + np.repeat(marks - cuts_a[1:], np.diff(cuts_a))] = a
        both[np.arange(len(b)) + np.repeat(marks + 1 - cuts_b[:-1], np.diff(cuts_b))] = b
        raw, ends = both.tobytes(), (ends * self._kind.itemsize).tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends)]

    def groups(self, a: np.ndarray, b: np.ndarray, after_a: np.ndarray, after_b: np.ndarray) -> bytes:
        """The text of the groups: ids of A and of B in order, each with the mark that follows it."""
        codes = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], after_b[:-1]]), np.diff(after_a, prepend=0))
        place_b = np.arange(len(b)) + np.repeat(after_a, np.diff(after_b, prepend=0))
        codes[place_a], codes[place_b] = 3 * a.astype(np.int64), 3 * b.astype(np.int64)
        codes[place_a[after_a - 1]] += 1
        codes[place_b[after_b - 1]] += 2
        written = self._both.written.take(codes, axis=0).view(np.uint8).ravel()
        return written[written != 0][:-1].tobytes()

    def document(self, a: np.ndarray, b: np.ndarray) -> tuple[int, int, str, np.ndarray, np.ndarray]:
        """Numbers of groups and links, digest of the groups, and the distinct id pairs with their numbers of links."""
        if not len(a):
            return 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = a.astype("<u4"), b.astype("<u4")
        ends_a, ends_b = np.cumsum(self._both.a_sizes[a]), np.cumsum(self._both.b_sizes[b])
        at = np.searchsorted(ends_b, ends_a)
        same = ends_b[at] == ends_a
        if self._tried is None or self._met < self._tried or 2 * self._answered >= self._met:
            cuts_a, cuts_b, after_a, after_b = self._cut(a, at, same)
            every = np.frombuffer(b"".join(self._looked_up(a, b, cuts_a, cuts_b, at, same)), np.int64)
        else:
            self._known, self._older = {}, {}
            after_a, after_b = self._after(at, same)
            every = overlaps(a, b, at, same)[0]
        digest = hashlib.sha256(self.groups(a, b, after_a, after_b)).hexdigest()
        pairs, times = np.unique(every, return_counts=True)
        return len(after_a), len(every), digest, pairs, times

    def _looked_up(
        self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, at: np.ndarray, same: np.ndarray
    ) -> list[bytes]:
        """Links of each window, by its ids; windows that are new are aligned together and remembered."""
        if 2 * self._held > self._kept:
            self._known, self._older, self._held = {}, self._known, 0
        known, keys = self._known, self.keys(a, b, cuts_a, cuts_b)
        met, new = list(map(known.get, keys)), None
        for k in [k for k, links in enumerate(met) if links is None]:
            links = known.get(keys[k])
            if links is None:
                links = self._older.get(keys[k])
                if links is None:
                    if new is None:
                        found, begins = overlaps(a, b, at, same)
                        new, edges = found.tobytes(), (8 * begins[cuts_a]).tolist()
                    links = new[edges[k] : edges[k + 1]]
                known[keys[k]] = links
                self._held += len(keys[k]) // self._kind.itemsize
            met[k] = links
        self._met += 1
        self._answered += new is None
        return met


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted pairs and their counts; like bytes of all numbers lie together and compress well."""
    planes = np.concatenate([np.diff(pairs, prepend=0), times]).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    numbers = np.ascontiguousarray(planes.T).view("<i8").ravel()
    half = len(numbers) // 2
    return np.cumsum(numbers[:half]), numbers[half:]


class Sums:
    """Counts of pairs, added up by sorting."""

    def __init__(self):
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = self._settled = 0

    def add(self, pairs: np.ndarray, times: np.ndarray) -> int:
        """Takes counts in; how many pairs are held."""
        self._parts.append((pairs, times))
        self._held += len(pairs)
        if self._held > 2 * self._settled + HELD_PAIRS:
            pairs, _ = self.total()
            self._held = self._settled = len(pairs)
        return self._held

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        pairs, times = (np.concatenate([p[k] for p in self._parts] or [np.zeros(0, np.int64)]) for k in (0, 1))
        pairs, where = np.unique(pairs, return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, where, times)
        self._parts = [(pairs, sums)]
        return pairs, sums


MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def document_pairs(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of kind DOCUMENT per input row: its key, number, counts, digest of groups and packed pairs; and rows of kind
    PAIRS with packed pairs added up over many documents. Computed once, the kinds in folders of their own."""
    names = [sent_file(docs.sparkSession, p) for p in (byte_level, pieces)]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = [SparkFiles.get(n) for n in names]
        both, windows, sums = sides(*paths), aligner(*paths), Sums()
        # What is remembered has no cycles; looking for some in it again and again would take a tenth of the time.
        gc.disable()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                made = []
                for a, b in both.encode([t or "" for t in part.column(2).to_pylist()]):
                    n_groups, n_links, digest, pairs, times = windows.document(a, b)
                    made.append((len(a), len(b), n_groups, n_links, digest, packed(pairs, times)))
                    held = sums.add(pairs, times)
                yield row_batch(part.column(0), part.column(1), made, DOCUMENT)
                if held > 4 * HELD_PAIRS:
                    yield pair_batch(sums)
                    sums = Sums()
        gc.enable()
        yield pair_batch(sums)

    def row_batch(rows, keys, made, kind):
        columns = list(zip(*made))
        measures = [pa.array(c, pa.int64()) for c in columns[:4]]
        kinds = pa.array([kind] * len(made), pa.int32())
        return pa.RecordBatch.from_arrays(
            [rows, keys, *measures, pa.array(columns[4], pa.string()), pa.array(columns[5], pa.binary()), kinds],
            ["row", "doc_id", *MEASURES, "groups_sha256", "pairs", "kind"],
        )

    def pair_batch(sums):
        return row_batch(pa.nulls(1, pa.int64()), pa.nulls(1, key_type), [(None, None, None, None, None, packed(*sums.total()))], PAIRS)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key_type = rows.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    kind = rows.schema["doc_id"].dataType.simpleString()
    measures = ", ".join(f"{m} long" for m in MEASURES)
    made = rows.mapInArrow(align, f"row long, doc_id {kind}, {measures}, groups_sha256 string, pairs binary, kind int")
    return stored(made, "alignment", by=["kind"])


def _spread(batches: Iterator[pa.RecordBatch], skip: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """(row, pair, times) of packed pairs, one small batch per input row, without those in the sorted array skip."""
    for batch in batches:
        for row, blob in zip(batch.column(0), batch.column(1)):
            pairs, times = unpacked(blob.as_py())
            if skip is not None and len(skip):
                left = skip[np.minimum(np.searchsorted(skip, pairs), len(skip) - 1)] != pairs
                pairs, times = pairs[left], times[left]
            if len(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row, len(pairs)), pa.array(pairs, pa.int64()), pa.array(times, pa.int64())], ["row", "pair", "times"]
                )


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n and best (whether n is the highest of the pair's B id) over the whole corpus."""
    parts = found.filter(F.col("kind") == PAIRS).select("row", "pairs").mapInArrow(_spread, "row long, pair long, times long")
    counts = checkpointed(parts.groupBy("pair").agg(F.sum("times").alias("n")))
    side_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    highest = counts.groupBy(side_b.alias("b")).agg(F.max("n").alias("top"))
    return checkpointed(
        counts.withColumn("b", side_b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    )


def alignment(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and those whose tokens do not give the text back, have no tokens: zeros and an empty digest. Keys
    may be null or repeat; each row counts by itself. An empty table gives an empty result; columns other than the two
    named are not read, whatever they are called.
    """
    spark = docs.sparkSession
    found = document_pairs(docs, byte_level, pieces, id_col, text_col)
    counts = pair_counts(found)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_frequent = F.col("n") * share >= total
    frequent = counts.filter(is_frequent).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("pair", "n", "best")))
    rows = found.filter(F.col("kind") == DOCUMENT)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = known.value
        for batch in batches:
            sums = []
            for blob in batch.column("pairs"):
                pairs, times = unpacked(blob.as_py())
                at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                at, times = at[hit], times[hit]
                sums.append((int(times[best[at]].sum()), int(times @ n[at])) if len(at) else (0, 0))
            kept = batch.drop_columns(["pairs"])
            for k, name in enumerate(("n_best", "count_sum")):
                kept = kept.append_column(name, pa.array([s[k] for s in sums], pa.int64()))
            yield kept

    columns = ["row", "doc_id", *MEASURES, "groups_sha256"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = ", ".join(f"{m} long" for m in (*MEASURES,))
    base = rows.select(*columns, "pairs").mapInArrow(
        weighed, f"row long, doc_id {kind}, {fields}, groups_sha256 string, n_best long, count_sum long"
    )
    left = rows.select("row", "pairs").mapInArrow(lambda b: _spread(b, known.value[0]), "row long, pair long, times long")
    rest = (
        left.join(counts.filter(~is_frequent), "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    return base.join(rest, "row", "left").select(
        "doc_id",
        *MEASURES,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
