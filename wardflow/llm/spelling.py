"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

A word is a point whose coordinates count its letters. One inserted letter raises one coordinate by 1, one deleted letter
lowers one, one replaced letter does both; so a word's near words lie within an L1 distance of 2. The search for a pair of
lengths is narrower still: among words of the same length at most 1 up and 1 down, among words one letter longer 1 up
and none down, among words one letter shorter the reverse. Both sums are kept apart while a tree is walked, and a box
that exceeds either is pruned. In a leaf, squared distances tell the points in reach: where no coordinate differs by more
than 1, they are L1 distances, and beyond that they are larger. What is left is verified letter by letter.

The points of each length are split into cells by the upper levels of a tree, which every task knows; its splits come
from a bounded sample of the vocabulary and decide only where a point lies. A query goes to every cell whose box it can
reach. A cell's task holds the cell's points in a tree of its own and streams the queries through it, adding up what each
query finds, so links are never gathered by word or cell.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, stored

#: Distinct words that one task adds up before it hands them on.
HELD_WORDS = 500_000
#: Words of the sample that places the cells, about 2 MB; the links found do not depend on it.
SAMPLE = 100_000
#: Points of a cell, and of a leaf of its tree.
CELL_POINTS, LEAF_POINTS = 8192, 128
#: Up to this length of words, squared distances are exact in single precision; up to the other, letters are compared in arrays.
SINGLE_PRECISION, IN_ARRAYS = 1000, 64
#: Queries that walk a tree together.
TOGETHER = 4096
#: Most tasks of the search.
MOST_TASKS = 100_000
#: Coordinates: a-z, the letters from U+00C0 to U+00FF, and six that all other characters share.
LETTERS = 96
POINT, QUERY = 0, 1
#: By the difference of lengths, target less query: how far the target's counts may be up and down in all.
REACH = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}


def damaged(word: str, key: str, every: int) -> str:
    """The word without one of its letters if `every` divides the crc32 of key:word, which also says which letter goes."""
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """word and n, its occurrences in all texts, of the runs of letters of Latin-1 with A-Z in lower case.

    Words below either bound are left out. With `every`, about one in so many distinct runs of a text is damaged first,
    which plants misspellings. A null key counts as an empty one.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                # Lower-casing bytes changes A-Z alone.
                found = Counter(runs.findall((text.as_py() or "").encode().lower().decode()))
                if every:
                    begun = zlib.crc32(f"{key.as_py() or ''}:".encode())
                    for run in [r for r in found if not zlib.crc32(r.encode(), begun) % every]:
                        word = damaged(run, key.as_py() or "", every)
                        held[word] += found.pop(run)
                held.update(found)
                if len(held) > HELD_WORDS:
                    yield counts(held)
                    held.clear()
        yield counts(held)

    def counts(held):
        kept = [(w, n) for w, n in held.items() if len(w) >= least_length]
        words, times = zip(*kept) if kept else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], ["word", "n"])

    parts = docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(counted, "word string, n long")
    return stored(parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count), "vocabulary")


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of letter counts per word."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    latin = np.where((codes >= 97) & (codes <= 122), codes - 97, np.where((codes >= 192) & (codes <= 255), codes - 166, 90 + codes % 6))
    at = np.repeat(np.arange(len(words)), sizes) * LETTERS + latin
    return np.bincount(at, minlength=len(words) * LETTERS).reshape(len(words), LETTERS).astype(np.int32)


def best_split(points: np.ndarray) -> tuple[int, int] | None:
    """Letter and count that cut the points most evenly: counts up to it, and above; None if all points are equal."""
    best, middle = None, len(points) / 2
    for letter in np.flatnonzero(points.min(0) != points.max(0)):
        column = points[:, letter]
        upto = np.cumsum(np.bincount(column))[:-1]
        upto = np.where((upto > 0) & (upto < len(points)), upto, len(points))
        at = int(np.argmin(np.abs(upto - middle)))
        off = abs(int(upto[at]) - middle)
        if best is None or off < best[0]:
            best = off, int(letter), at
    return best[1:] if best else None


class Tree:
    """A k-d tree whose leaves are numbered; nodes are (letter, count, left, right), leaves numbers."""

    def __init__(self, points: np.ndarray, leaf_points: float):
        self.leaves: list[np.ndarray] = []
        self._leaf_points = leaf_points
        self.root = self._built(points, np.arange(len(points)))

    def _built(self, points: np.ndarray, which: np.ndarray):
        """Depth stays near the logarithm of the points, as each split takes the most even of all letters."""
        split = best_split(points[which]) if len(which) > self._leaf_points else None
        if split is None:
            self.leaves.append(which)
            return len(self.leaves) - 1
        letter, count = split
        low = points[which, letter] <= count
        return letter, count, self._built(points, which[low]), self._built(points, which[~low])

    def reached(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the queries whose reach meets the leaf's box.

        A query carries how far the box lies above and below it. A split changes one letter's bounds, so only that letter's
        share of the sums is taken out and put back.
        """
        none = np.zeros(len(queries), np.int64)
        stack = [(self.root, np.arange(len(queries)), none, none, {})]
        while stack:
            node, which, above, below, box = stack.pop()
            if not isinstance(node, tuple):
                yield node, which
                continue
            letter, count, *sides = node
            low, high = box.get(letter, (0, None))
            q = queries[which, letter]
            other_above = above - np.maximum(low - q, 0)
            other_below = below - (np.maximum(q - high, 0) if high is not None else 0)
            for side, (new_low, new_high) in zip(sides, ((low, count), (count + 1, high))):
                a = other_above + np.maximum(new_low - q, 0)
                b = other_below + (np.maximum(q - new_high, 0) if new_high is not None else 0)
                kept = (a <= up) & (b <= down)
                if kept.any():
                    stack.append((side, which[kept], a[kept], b[kept], {**box, letter: (new_low, new_high)}))

    def own(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point lies in."""
        found = np.zeros(len(points), np.int64)
        for leaf, which in self.reached(points, 0, 0):
            found[which] = leaf
        return found


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes b of a; lengths differ by 1 at most."""
    if len(a) > len(b):
        a, b = b, a
    k, n = 0, len(a)
    while k < n and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1 :] if n < len(b) else k < n and a[k + 1 :] == b[k + 1 :]


def letters_of(words: list[str], size: int) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), size)


def edited(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row whether one edit makes b of a, as one_edit; b is as long as a or one letter longer."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(1) == 1
    ahead = np.cumprod(a == b[:, :size], 1, dtype=np.int8).sum(1)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], 1, dtype=np.int8).sum(1)
    return ahead + behind >= size


class Cell:
    """The points of one cell, words of one length, in a tree."""

    def __init__(self, words: list[str], counts: list[int]):
        points = letter_counts(words)
        self._tree = Tree(points, LEAF_POINTS)
        order = np.concatenate(self._tree.leaves)
        points = points[order]
        self.words, self.counts = [words[k] for k in order], [counts[k] for k in order]
        self._ends = np.cumsum([0, *map(len, self._tree.leaves)])
        self._size = len(words[0])
        self._kind = np.float32 if self._size <= SINGLE_PRECISION else np.float64
        self._used = np.flatnonzero(points.any(0))
        # One product gives a squared distance: the points carry -2 times their counts, their squares, and 1 for the query's.
        numbers = points[:, self._used].astype(self._kind)
        self._factors = np.hstack([-2 * numbers, (numbers**2).sum(1, keepdims=True), np.ones((len(words), 1), self._kind)]).T.copy()
        self._letters = letters_of(self.words, self._size) if self._size <= IN_ARRAYS else None
        self.rank = np.empty(len(words), np.int64)
        self.rank[sorted(range(len(words)), key=lambda k: (-self.counts[k], self.words[k]))] = np.arange(len(words))
        self.by_rank = np.argsort(self.rank)

    def near(self, queries: list[str], difference: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of queries and points: all near words among the cell's, which are longer than the queries by the difference."""
        up, down = REACH[difference]
        for at in range(0, len(queries), TOGETHER):
            part = queries[at : at + TOGETHER]
            counts = letter_counts(part)
            numbers = counts.astype(self._kind)
            factors = np.hstack([numbers[:, self._used], np.ones((len(part), 1), self._kind), (numbers**2).sum(1, keepdims=True)])
            letters = letters_of(part, self._size - difference) if self._letters is not None else None
            for leaf, which in self._tree.reached(counts, up, down):
                # A leaf of equal points may be large.
                for lo in range(self._ends[leaf], self._ends[leaf + 1], LEAF_POINTS):
                    apart = factors[which] @ self._factors[:, lo : min(lo + LEAF_POINTS, self._ends[leaf + 1])]
                    q, p = np.nonzero(apart == up + down)
                    q, p = which[q], p + lo
                    if len(q):
                        fits = self._verified(part, letters, q, p, difference)
                        yield q[fits] + at, p[fits]

    def _verified(self, queries: list[str], letters: np.ndarray | None, q: np.ndarray, p: np.ndarray, difference: int) -> np.ndarray:
        if letters is None:
            return np.array([one_edit(queries[i], self.words[k]) for i, k in zip(q.tolist(), p.tolist())], bool)
        asked, held = letters[q], self._letters[p]
        return edited(asked, held) if difference >= 0 else edited(held, asked)


def cells_of(words: DataFrame, cell_points: int = CELL_POINTS) -> dict[int, Tree]:
    """The upper tree of each length that has more than cell_points words; there are few such lengths.

    The sample takes the words whose hashes are below a share of all hashes, about SAMPLE of them however many there are.
    """
    lengths = words.groupBy(F.length("word").alias("size")).count()
    sizes = dict(lengths.filter(F.col("count") > cell_points).collect())
    if not sizes:
        return {}
    share = int(min(1.0, SAMPLE / sum(sizes.values())) * (1 << 30))
    chosen = words.filter(F.length("word").isin(list(sizes)) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share))
    sample: dict[int, list[str]] = {}
    for (word,) in chosen.select("word").collect():
        sample.setdefault(len(word), []).append(word)
    return {size: Tree(letter_counts(some), max(1.0, len(some) * cell_points / sizes[size])) for size, some in sample.items()}


def placed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """cell, role, word, n, difference: each word as a point of its cell, and as a query of every cell that it reaches."""
    upper = {size: tree for size, tree in trees.items()}
    for tree in upper.values():
        tree.leaves = [None] * len(tree.leaves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                words, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                counts, sizes = letter_counts(words), np.array([len(w) for w in words])
                found = []
                for size in np.unique(sizes).tolist():
                    which = np.flatnonzero(sizes == size)
                    own = upper[size].own(counts[which]) if size in upper else np.zeros(len(which), np.int64)
                    found.append((own + (size << 32), which, POINT, 0))
                    for difference, reach in REACH.items():
                        target = size + difference
                        if target not in upper:
                            found.append((np.full(len(which), target << 32), which, QUERY, difference))
                            continue
                        for leaf, some in upper[target].reached(counts[which], *reach):
                            found.append((np.full(len(some), leaf + (target << 32)), which[some], QUERY, difference))
                rows = np.concatenate([f[1] for f in found])
                roles, differences = (np.concatenate([np.full(len(f[1]), f[k], np.int32) for f in found]) for k in (2, 3))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([f[0] for f in found])),
                        pa.array(roles),
                        part.column(0).take(pa.array(rows)),
                        pa.array(n[rows]),
                        pa.array(differences),
                    ],
                    ["cell", "role", "word", "n", "difference"],
                )

    return words.select("word", "n").mapInArrow(place, "cell long, role int, word string, n long, difference int")


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n_near, best_n, best of each query of rows sorted by cell and role; a cell's points come before its queries."""
    cell, words, counts, tree = None, [], [], None
    for batch in batches:
        keys = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            part = batch.slice(i, j - i)
            if not part.num_rows:
                continue
            if part.column(0)[0].as_py() != cell:
                cell, words, counts, tree = part.column(0)[0].as_py(), [], [], None
            if part.column(1)[0].as_py() == POINT:
                words += part.column(2).to_pylist()
                counts += part.column(3).to_pylist()
                continue
            if not words:
                continue
            tree = tree or Cell(words, counts)
            asked, differences = part.column(2).to_pylist(), part.column(4).to_numpy()
            near, best = np.zeros(len(asked), np.int64), np.full(len(asked), len(words), np.int64)
            for difference in REACH:
                which = np.flatnonzero(differences == difference)
                for q, p in tree.near([asked[k] for k in which.tolist()], difference):
                    np.add.at(near, which[q], 1)
                    np.minimum.at(best, which[q], tree.rank[p])
            hit = np.flatnonzero(near)
            if len(hit):
                points = tree.by_rank[best[hit]].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(2).take(pa.array(hit)),
                        pa.array(near[hit]),
                        pa.array([tree.counts[p] for p in points], pa.int64()),
                        pa.array([tree.words[p] for p in points], pa.string()),
                    ],
                    ["word", "n_near", "best_n", "best"],
                )


def neighbours(words: DataFrame, cell_points: int = CELL_POINTS) -> DataFrame:
    """word, n_near, best_n and best, the near word of largest n (then the smallest), of every word that has near words."""
    trees = cells_of(words, cell_points)
    cells = sum(len(t.leaves) for t in trees.values())
    tasks = min(2 * cells + 2 * words.sparkSession.sparkContext.defaultParallelism, MOST_TASKS)
    rows = placed(words, trees).repartition(tasks, "cell").sortWithinPartitions("cell", "role")
    parts = rows.mapInArrow(searched, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")
    )


def followed(forms: DataFrame) -> DataFrame:
    """word and root, the end of the chain of forms that begins at each word.

    Each round doubles the steps taken. A form occurs several times as often as its word, so chains are short, and few
    words have the same form, as near words are few.
    """
    hops = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = hops.join(ahead, "root", "left")
        hops = checkpointed(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if hops.filter("moved").isEmpty():
            return hops.select("word", "root")
        hops = hops.drop("moved")


def variants(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell_points: int = CELL_POINTS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary.

    A word's form is its near word of largest n, of equal ones the smallest in code-point order, if that n is at least
    `ratio` times the word's; else null. Root is the word that following forms ends at. Null texts have no words; an empty
    table gives an empty result; rows may repeat, and then count again; columns other than the two named are not read.
    """
    words = vocabulary(docs, least_length, least_count, every, id_col, text_col)
    found = stored(words.join(neighbours(words, cell_points), "word", "left"), "neighbours")
    has_form = F.col("best_n") >= ratio * F.col("n")
    made = found.select(
        "word",
        F.when(has_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    roots = followed(made.filter(F.col("form").isNotNull()))
    return made.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
