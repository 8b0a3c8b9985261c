"""Quality rules with adaptive thresholds.

Every document is measured once. The measures of all documents go into quantile sketches per language and source:
counts per logarithmic bucket with a relative error under two percent, which merge by addition, so the sketch of a
language is the sum of its sources' and the global one the sum of all. From its own sketch alone each group gets fences
per rule: a high percentile, and beyond it a multiple of its distance from the median, which is at least the width of the
sketch's bucket there. So a group in which nearly all documents measure the same has a fence next to that value, and one
of wide spread has a distant one. A document is judged by the fences of its own group.

A percentile is only as good as the documents beyond it. A group with fewer than LEAST_BEYOND of them uses the sketch of its
language for that rule, then the global one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import checkpointed

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a window in which repeats are looked for.
WINDOW = 5
#: Base rules: least words, and most percent of the words that lie in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Documents that a group needs beyond a rule's percentile for a fence of its own.
LEAST_BEYOND = 5
#: Bits of a measure that its bucket keeps.
BUCKET_BITS = 7
#: Rule: measure per thousand words, percentile, tenths of its distance from the median that are allowed beyond it, and
#: whether low values fail too. Word lengths are in hundredths of a code point.
RULES = {
    "symbols": ("1000 * n_symbols div n_words", 90, 40, False),
    "upper": ("1000 * n_upper div greatest(word_chars, 1)", 98, 30, False),
    "marks": ("1000 * n_marks div n_words", 98, 10, False),
    "word_length": ("100 * word_chars div n_words", 90, 60, True),
    "repeated": ("1000 * n_repeat_words div n_words", 98, 20, False),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 98, 10, False),
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more in the text, its first occurrence included."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    key, held = codes, len(number)
    windows = len(words) - window + 1
    for k in range(1, window):
        if held * len(number) >= 1 << 62:
            key, held = np.unique(key, return_inverse=True)[1], len(key)
        key = key[: len(words) - k] * len(number) + codes[k:]
        held *= len(number)
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    if not equal.any():
        return 0
    again = np.zeros(windows, bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    edges[at] += 1
    edges[at + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def text_measures(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines with a word, n_upper, n_marks."""
    if not text:
        return (0,) * 8
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space alone
    spaces = len(raw) - len(raw.translate(None, SPACE))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, UPPER)),
        raw.count(b"!") + raw.count(b"?"),
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_measures(t.as_py()) for t in batch.column(3)], np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(np.ascontiguousarray(found[:, k])) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["doc_id", "lang", "source", *MEASURES])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source"))
    return rows.mapInArrow(measure, kinds + "".join(f", {m} long" for m in MEASURES))


def bucket_width(value: Column) -> Column:
    cut = F.greatest(F.length(F.bin(value)) - BUCKET_BITS, F.lit(0))
    return F.pow(F.lit(2), cut).cast("long")


def bucket(value: Column) -> Column:
    """The lower end of a value's bucket: its leading bits."""
    width = bucket_width(value)
    return F.floor(value / width).cast("long") * width


def sketches(values: DataFrame) -> DataFrame:
    """level, lang, source, rule, bucket, n: the sketches of all groups, from the finest by merging."""
    fine = values.groupBy("lang", "source", "rule", bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    fine = checkpointed(fine)
    by_lang = fine.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    by_rule = by_lang.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    null = F.lit(None).cast("string")
    columns = ("level", "lang", "source", "rule", "bucket", "n")
    return (
        fine.withColumn("level", F.lit(0)).select(*columns)
        .unionByName(by_lang.withColumns({"level": F.lit(1), "source": null}).select(*columns))
        .unionByName(by_rule.withColumns({"level": F.lit(2), "lang": null, "source": null}).select(*columns))
    )


def fences(held: DataFrame, least_beyond: int = LEAST_BEYOND) -> DataFrame:
    """level, lang, source, rule, group_rows, low, high: the values between which a rule holds, where enough rows tell them."""
    group = ("level", "lang", "source", "rule")
    within = Window.partitionBy(*group)
    running = held.withColumns({"upto": F.sum("n").over(within.orderBy("bucket")), "group_rows": F.sum("n").over(within)})
    rule = F.create_map(
        *[x for name, (_, p, k, low) in RULES.items() for x in (F.lit(name), F.struct(F.lit(p).alias("p"), F.lit(k).alias("k"), F.lit(low).alias("low")))]
    )
    how = rule[F.col("rule")]

    def percentile(p: Column) -> Column:
        return F.min(F.when(100 * F.col("upto") >= p * F.col("group_rows"), F.col("bucket")))

    marks = running.groupBy(*group, "group_rows").agg(
        percentile(100 - how["p"]).alias("below"), percentile(F.lit(50)).alias("middle"), percentile(how["p"]).alias("above")
    )

    def reach(end: Column) -> Column:
        return F.floor(how["k"] * F.greatest(F.abs(end - F.col("middle")), bucket_width(end)) / 10).cast("long")

    below, above = F.col("below"), F.col("above")
    told = (F.col("level") == 2) | (F.col("group_rows") * (100 - how["p"]) >= 100 * least_beyond)
    return marks.filter(told).select(*group, "group_rows", F.when(how["low"], below - reach(below)).alias("low"), (above + reach(above)).alias("high"))


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_beyond: int = LEAST_BEYOND
) -> DataFrame:
    """One row per row of docs: doc_id, the measures, base_failed, kept, failed_rules, threshold_level.

    threshold_level is 0, 1 or 2 if the finest of a row's fences is that of language and source, language, or all; null for documents without words,
    which fail the base rules, as null texts do. Null languages and sources are groups like any other. Only documents
    that pass the base rules shape the thresholds. Rows that repeat are judged alike; an empty table gives no rows.
    """
    base = checkpointed(
        measured(docs, id_col, text_col, lang_col, source_col).withColumn(
            "base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
        )
    )
    value = {name: F.expr(f"case when n_words > 0 then {how[0]} end") for name, how in RULES.items()}
    values = base.filter(~F.col("base_failed")).select(
        "lang", "source", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), v.alias("value")) for r, v in value.items()])).alias("v")
    )
    limits = fences(sketches(values.select("lang", "source", "v.rule", "v.value")), least_beyond)
    wide = limits.groupBy("level", "lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r, F.struct("low", "high"))).alias(r) for r in RULES]
    )
    wide = checkpointed(wide)
    fine, lang = (wide.filter(F.col("level") == k).alias(f"l{k}") for k in range(2))
    every = wide.filter(F.col("level") == 2).select(F.struct("level", *RULES)).scalar()
    joined = (
        base.alias("d")
        .join(fine, F.col("d.lang").eqNullSafe(F.col("l0.lang")) & F.col("d.source").eqNullSafe(F.col("l0.source")), "left")
        .join(lang, F.col("d.lang").eqNullSafe(F.col("l1.lang")), "left")
    )
    level = F.coalesce("l0.level", "l1.level", every["level"])

    def fails(rule: str) -> Column:
        fence, v = F.coalesce(f"l0.{rule}", f"l1.{rule}", every[rule]), value[rule]
        return F.coalesce((v < fence["low"]) | (v > fence["high"]), v > fence["high"], F.lit(False))

    failed = F.concat_ws(",", *[F.when(fails(r), F.lit(r)) for r in RULES])
    return joined.select(
        "d.doc_id", *MEASURES, "base_failed", failed.alias("failed_rules"), F.when(F.col("n_words") > 0, level).alias("threshold_level")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
