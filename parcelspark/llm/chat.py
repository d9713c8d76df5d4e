"""Chat formatting: logged snapshots collapse into the longest conversation, then render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.session import stage

#: Marks around a turn in the rendered text.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_order() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(),
            F.col("text").asc_nulls_first()]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Each turn with its place ``at`` from 1 on and two rolling hashes of all turns up to it.

    A turn's own hashes depend on its place, role and text; the prefix takes their exclusive or, so
    that it rolls along a conversation in one ordered pass and no turns are gathered in a row.
    """
    order = Window.partitionBy("conv_id").orderBy(*_turn_order())
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    missing = F.concat(F.col("role").isNull().cast("string"), F.col("text").isNull().cast("string"))
    parts = ["at", "role", "text"]
    return (turns.withColumn("at", F.row_number().over(order))
            .withColumn("h1", F.bit_xor(F.xxhash64(F.lit(1), *parts, missing)).over(upto))
            .withColumn("h2", F.bit_xor(F.xxhash64(F.lit(2), missing, *reversed(parts))).over(upto)))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit("\n"),
                    F.coalesce(text, F.lit("")), F.lit(CLOSE + "\n"))


def collapse_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, status, keep_id, text)`` for each conversation of ``turns`` (conv_id,
    turn, role, text).

    Turns are ordered by turn (nulls last), then role and text; repeated rows are turns of their
    own, and null roles and texts differ from empty ones. A conversation whose turns all equal the
    first turns of a longer one is a ``prefix``; of conversations with equal turns the smallest
    conv_id is ``kept`` and the others are ``copy``. keep_id is the kept conversation that a copy
    equals, null for a prefix. Only kept ones have a text: their turns between marks. Rows with a
    null conv_id are one conversation. An empty table gives an empty result.

    Hashes of proper prefixes are reduced to distinct ones before the anti-join, so a first turn
    that very many conversations share counts once. A kept conversation is gathered into one row,
    which is its text; those that collapse never are.
    """
    turns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    hashed = prefix_hashes(turns)
    size = Window.partitionBy("conv_id")
    # The widths of a conversation come from the same ordered partition; texts aren't staged.
    spans = stage(hashed.select("conv_id", "at", "h1", "h2")
                  .withColumn("n", F.max("at").over(size)), "spans")
    full = spans.filter("at = n").select("conv_id", "n", "h1", "h2")
    proper = stage(spans.filter("at < n").groupBy("h1", "h2", "at").agg(F.lit(1).alias("one")),
                   "proper")
    groups = stage(full.groupBy("h1", "h2", "n").agg(F.min("conv_id").alias("keep_id")), "groups")
    longer = proper.select("h1", "h2", F.col("at").alias("n"))
    maximal = stage(groups.join(longer, ["h1", "h2", "n"], "left_anti"), "maximal")
    same = ["h1", "h2", "n"]
    found = full.join(maximal.withColumn("top", F.lit(True)), same, "left").select(
        "conv_id", F.col("n").cast("long").alias("n_turns"),
        F.when(F.col("top").isNull(), "prefix")
        .when(F.col("conv_id").eqNullSafe(F.col("keep_id")), "kept").otherwise("copy")
        .alias("status"), "keep_id")
    found = stage(found, "found")
    kept = found.filter("status = 'kept'").select(F.col("conv_id").alias("kept_id"))
    texts = (turns.join(kept, turns["conv_id"].eqNullSafe(kept["kept_id"]), "left_semi")
             .groupBy("conv_id").agg(F.collect_list(F.struct(
                 F.col("turn").isNull().alias("late"), "turn", "role", "text")).alias("rows"))
             .select(F.col("conv_id").alias("text_id"), F.array_join(F.transform(
                 F.array_sort("rows"), lambda r: render_turn(r["role"], r["text"])), "")
                 .alias("text")))
    return (found.join(texts, found["conv_id"].eqNullSafe(texts["text_id"])
                       & (found["status"] == "kept"), "left").drop("text_id"))
