"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 counts filter cells: every text key sets two cells of a bit table, and the cells set at least twice
stay, packed into 4 KB bitmaps. Pass 2 looks each key up: a key with a cell that nobody else set is certainly
unique, so its row passes straight through; only possibly repeated keys are shuffled and grouped.

The filter (``id_filter``) is the only broadcast and bounded in size. Beyond its bound it lets more unique rows
through to the grouping (a slower, equally exact run), never fewer copies.

Edge cases: null text is the empty text, so null, empty and blank texts are equal; of equal texts the one with
most code points stays, then the smallest id (null ids last); repeated rows (same id, same text) count each
in the group size and share one decision, and ``exact_dedup`` leaves one of them; an empty table gives
no rows; other columns, whatever their names, are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored
from quarry.llm.id_filter import both_cells, cells_for, flag, pack_bits

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def text_key(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text without ASCII white space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "").cast("binary"), 256)


def repeat_filter(keys: DataFrame) -> tuple[DataFrame, int]:
    """Pass 1 over ``keys`` (_key): bitmaps of the cells set at least twice, and the number of cells."""
    cells = cells_for(keys.count())
    twice = both_cells(keys, cells).groupBy("c").count().where("count >= 2")
    return pack_bits(twice), cells


def _winners(maybe: DataFrame) -> DataFrame:
    """Size and staying row of each group of equal keys. Written, so that the join back to the rows
    exchanges both sides and adaptive execution can split a hot key."""
    best = F.min(F.struct((-F.col("_len")).alias("n"), F.col("_id").isNull().alias("z"), F.col("_id").alias("id")))
    g = maybe.groupBy("_key").agg(F.count("*").alias("_size"), best.alias("_best"))
    return stored(g.select("_key", "_size", F.col("_best.id").alias("_keep"), (-F.col("_best.n")).alias("_keep_len")),
                  "exact-groups")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = stored(docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_key"),
                              F.char_length(text).alias("_len")), "exact-keys")
    bits, cells = repeat_filter(keys)
    rows = flag(keys, bits, cells)
    maybe = rows.where("_maybe")
    single = rows.where("NOT _maybe").select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_key").alias("text_sha256"))
    grouped = maybe.join(_winners(maybe), "_key").select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_len") == F.col("_keep_len"))).alias("kept"),
        F.col("_key").alias("text_sha256"))
    return single.union(grouped)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the later copies, same columns. Unique rows never leave their partition."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # internal names cannot clash with the caller's
    key = names[docs.columns.index(text_col)]
    rows = docs.toDF(*names).withColumns({
        "_id": F.col(names[docs.columns.index(id_col)]), "_key": text_key(F.col(key)),
        "_len": F.char_length(F.coalesce(F.col(key), F.lit("")))})
    keys = stored(rows.select("_id", "_key", "_len"), "exact-keys")
    bits, cells = repeat_filter(keys)
    winners = _winners(flag(keys, bits, cells).where("_maybe"))
    flagged = flag(rows, bits, cells)
    stays = (flagged.where("_maybe").join(winners, "_key")
             .where(F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_len") == F.col("_keep_len")))
             .dropDuplicates(["_id", "_key"]))
    return flagged.where("NOT _maybe").select(*names).union(stays.select(*names)).toDF(*docs.columns)
