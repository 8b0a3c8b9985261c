"""Exact de-duplication with a heavy-hitter split, in DataFrame functions only.

A Misra-Gries summary of the digests (Spark's frequent-items sketch, merged over all rows) names every digest that may
hold a large share of the rows. Those few are counted exactly, and their winners go to all executors, so the rows of
the largest groups never meet in one task. The remaining digests are grouped by an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import checkpointed, folded, rows_kept

#: Counters of one sketch: each digest with over a thousandth of the rows that a sketch has read is among its items.
TRACKED = 8192
#: Sketches over the rows, and most items that one names; so at most SKETCHES * ITEMS hashes of 8 bytes are broadcast.
SKETCHES, ITEMS = 64, 2400
#: Digests with at least a row in so many are split off; so at most that many winners of about 100 bytes are broadcast.
SHARE = 4096


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Key, digest, hash and number of each row, computed once; the row number tells repeated rows apart."""
    return checkpointed(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.unhex(F.sha2(folded(F.col(text_col)), 256)).alias("digest"),
            F.xxhash64(text_col).alias("text_hash"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def frequent(rows: DataFrame, share: int = SHARE) -> DataFrame:
    """digest, group_size and winner of the digests found frequent, counted exactly: `share` rows at most.

    The rows are summarised in SKETCHES parts. A digest with a thousandth of all rows has a thousandth of those of some
    part, so the union of what the parts name misses none. Sketches hold 64-bit hashes; if two digests share one, both
    are counted.
    """
    part = F.pmod(F.shiftright("row", 33), F.lit(SKETCHES))
    items = rows.groupBy(part.alias("part")).agg(F.expr(f"approx_top_k(xxhash64(digest), {ITEMS}, {TRACKED})").alias("items"))
    named = checkpointed(items.select(F.explode("items.item").alias("key")).distinct())
    counted = (
        rows.join(F.broadcast(named), F.xxhash64("digest") == named["key"], "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("winner"))
    )
    return checkpointed(counted.filter(F.col("group_size") * share >= F.lit(rows.count())))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    Equal are texts that are identical after lower-casing A-Z; null counts as the empty text. The row with the largest
    key stays, a null key comes last; of rows that repeat that key and text, exactly one stays. An empty table gives
    an empty result; columns other than the two named are not read, whatever they are called.
    """
    rows = digests(docs, id_col, text_col)
    heavy = frequent(rows, share)
    split = rows.join(F.broadcast(heavy), "digest", "left")
    named = split.filter(F.col("group_size").isNotNull())
    same = Window.partitionBy("digest")
    rest = (
        split.filter(F.col("group_size").isNull())
        .select("doc_id", "digest", "text_hash", "row")
        .withColumns({"group_size": F.count(F.lit(1)).over(same), "winner": F.max(F.struct("doc_id", "row")).over(same)})
    )
    columns = ("doc_id", "digest", "text_hash", "row", "group_size", "winner")
    return named.select(*columns).unionByName(rest.select(*columns)).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_hash",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    return rows_kept(docs, exact_groups(docs, id_col, text_col), id_col, text_col)
