"""Removal of repeated passages by hashing lines and the sentences in them.

A unit is a line; in normalised form it is lower-cased with single spaces. Digests are grouped over all documents and the
occurrence that ranks first, by key and place, is kept; later ones are removed whatever their length.

With `passage_words`, the sentences of a line are units as well, for passages that are repeated inside of longer lines: all
units of a text without a first occurrence go, and sentences of lines that are not themselves repeats go where consecutive
ones make up a passage of that many words, so that a sentence that texts share by chance stays. Original offsets are kept
throughout.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored

#: Code points that count as a word at least, for languages written without spaces.
WORD_CHARS = 5
DIGEST_BYTES = 16
#: What separates lines, and sentences: white space after the end of one.
LINES, SENTENCES = re.compile(r"\n"), re.compile(r"\n|(?<=[.!?])[^\S\n]+")


def units(text: str, between: re.Pattern = SENTENCES) -> Iterator[tuple[int, int, str]]:
    """Start, end and normalised form of the units of a text, without surrounding white space, empty ones left out."""
    at = 0
    for gap in [*between.finditer(text), None]:
        end = gap.start() if gap else len(text)
        piece = text[at:end]
        words = piece.lower().split()
        if words:
            start = at + len(piece) - len(piece.lstrip())
            yield start, start + len(piece.strip()), " ".join(words)
        at = gap.end() if gap else end


def line_sizes(text: str, found: list[tuple[int, int, str]]) -> list[int]:
    """How many of the units lie in each line that has any."""
    sizes, end = [], -1
    for start, _, _ in found:
        if start > end:
            sizes.append(0)
            end = text.find("\n", start)
            end = len(text) if end < 0 else end
        sizes[-1] += 1
    return sizes


def hashed(docs: DataFrame, id_col: str, text_col: str, between: re.Pattern) -> DataFrame:
    """row, doc_id, text_hash, unit, start, end, words, lines, of, digest of every unit, and of every line of several.

    `lines` is the number of units of a whole line, 0 for a sentence in a longer one; a line has the number of its first
    unit. `of` is the number of units of the text. Texts themselves stay in their tasks.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    names = ["row", "doc_id", "text_hash", "unit", "start", "end", "words", "lines", "of", "digest"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows_of, number, starts, ends, words, lines, of, digests = [], [], [], [], [], [], [], []
                for k, text in enumerate(some.column(3).to_pylist()):
                    found = list(units(text or "", between))
                    parts, n = [], 0
                    for size in line_sizes(text or "", found):
                        line = found[n : n + size]
                        parts += [(n + j, u, int(size == 1)) for j, u in enumerate(line)]
                        if size > 1:
                            parts.append((n, (line[0][0], line[-1][1], " ".join(u[2] for u in line)), size))
                        n += size
                    for n, (start, end, form), size in parts:
                        rows_of.append(k), number.append(n), starts.append(start), ends.append(end), lines.append(size), of.append(len(found))
                        words.append(max(form.count(" ") + 1, len(form) // WORD_CHARS))
                        digests.append(hashlib.blake2b(form.encode(), digest_size=DIGEST_BYTES).digest())
                own = [some.column(k).take(pa.array(rows_of, pa.int64())) for k in range(3)]
                numbers = [pa.array(c, pa.int32()) for c in (number, starts, ends, words, lines, of)]
                yield pa.RecordBatch.from_arrays([*own, *numbers, pa.array(digests, pa.binary())], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(split, f"row long, doc_id {kind}, text_hash long, unit int, start int, end int, words int, lines int, of int, digest binary")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage_words: int | None = None) -> DataFrame:
    """One row per removed unit: doc_id, unit, start, end, words, passage_words, keep_doc_id, keep_start, text_hash, row.

    The first occurrence is that of the smallest key, null keys last, then of the first row and place; rows that repeat
    a key are ranked by their order in the input, so a repeated row loses all. Offsets are code points. A unit has as many
    words as white space sets apart, or one per WORD_CHARS code points if that is more; passage_words is their sum over
    the run of repeated units, and the least that a run needs outside of repeated lines; without it, units are whole lines.
    Null and empty texts have no units; an empty table gives no rows. Counting a digest combines before the shuffle, and the join
    that finds the later occurrences can be split by Spark, so a line that is in a third of all texts is no bottleneck.
    """
    found = stored(hashed(docs, id_col, text_col, LINES if passage_words is None else SENTENCES), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "start")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("digest", "first")
    later = found.join(first, "digest").filter((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))
    in_text = Window.partitionBy("row").orderBy("unit", F.col("lines").desc())
    line_end = F.max(F.when(F.col("lines") > 0, F.col("unit") + F.col("lines"))).over(in_text)
    in_line = later.withColumn("whole", F.coalesce(F.col("unit") < line_end, F.lit(False))).filter(F.col("lines") <= 1)
    runs = in_line.withColumn("run", F.col("unit") - F.row_number().over(in_text))
    passage = F.sum("words").over(Window.partitionBy("row", "run"))
    all_units = F.count(F.lit(1)).over(Window.partitionBy("row")) == F.col("of")
    long_enough = F.lit(False) if passage_words is None else F.col("passage_words") >= passage_words
    return (
        runs.withColumns({"every": all_units, "passage_words": passage})
        .filter(F.col("whole") | F.col("every") | long_enough)
        .select(
            "doc_id", "unit", "start", "end", "words", "passage_words",
            F.col("first.doc_id").alias("keep_doc_id"), F.col("first.start").alias("keep_start"), "text_hash", "row",
        )
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage_words: int | None = None) -> DataFrame:
    """docs with the repeated passages cut from their texts, and `kept_spans`: the original offsets of what is left.

    Rows that repeat both key and text are cut alike, as the first of them. A text without repeats is left as it is.
    """
    cut = repeats(docs, id_col, text_col, passage_words)
    by_row = cut.groupBy("doc_id", "text_hash", "row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    by_text = by_row.groupBy("doc_id", "text_hash").agg(F.min_by("spans", "row").alias("spans")).alias("b")
    a = docs.alias("a")
    same = F.col(f"a.{id_col}").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64(F.col(f"a.{text_col}")) == F.col("b.text_hash"))
    text, spans = F.col(f"a.{text_col}"), F.coalesce("b.spans", F.array().cast("array<struct<start:int,end:int>>"))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda k: F.struct(
            F.when(k == 0, F.lit(0)).otherwise(F.element_at(spans, F.greatest(k, F.lit(1)))["end"]).alias("start"),
            F.when(k == F.size(spans), F.length(text)).otherwise(F.get(spans, k)["start"]).alias("end"),
        ),
    )
    kept = F.filter(gaps, lambda g: g["end"] > g["start"])
    left = F.array_join(F.transform(kept, lambda g: F.substring(text, g["start"] + 1, g["end"] - g["start"])), "")
    others = [F.when(F.size(spans) > 0, left).otherwise(text).alias(c) if c == text_col else F.col(f"a.{c}") for c in docs.columns]
    return a.join(by_text, same, "left").select(*others, F.coalesce(kept, F.array().cast("array<struct<start:int,end:int>>")).alias("kept_spans"))
