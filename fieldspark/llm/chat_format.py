"""Chat formatting: collapse of cumulative snapshots, then rendering; DataFrame operations only.

Logs often hold a conversation many times, each time one turn longer. Every turn gets a hash of its
place, role and text; the xor of the first k of them is the rolling hash of the prefix of k turns
(places make it depend on order). A conversation whose whole hash is a proper prefix of a longer one
is dropped by an anti-join, and of equal ones the smallest conv_id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLE_OPEN, ROLE_CLOSE, TURN_CLOSE = "<|", "|>\n", "<|end|>\n"


def _turn_hash(seed: int) -> Column:
    """Of role and text; null differs from empty."""
    return F.xxhash64(F.lit(seed), F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, place (1, 2, ...), n_turns, h1, h2 of the prefix up to there.

    Turns are ordered by turn (null first), then role, then md5 of the text, as they are rendered; null role
    or text differs from empty. Two prefixes of one length are taken for equal if both 64-bit hashes agree.
    """
    hashed = turns.select("conv_id", "turn", *[_turn_hash(seed).alias(f"t{seed}") for seed in (1, 2)], "role", F.md5("text").alias("text_md5"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text_md5")
    placed = hashed.withColumn("place", F.row_number().over(order))
    rolling = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    return placed.select(
        "conv_id",
        "place",
        F.count(F.lit(1)).over(whole).alias("n_turns"),
        *[F.bit_xor(F.xxhash64("place", f"t{k}")).over(rolling).alias(f"h{k}") for k in (1, 2)],
    )


def single_turns(turns: DataFrame) -> DataFrame:
    """Turns without conv_id, each a conversation of one turn: h1, h2 as prefix_hashes gives, role, text, copies; equal ones are one row."""
    first = turns.where(F.col("conv_id").isNull()).select("role", "text", *[F.xxhash64(F.lit(1), _turn_hash(k)).alias(f"h{k}") for k in (1, 2)])
    return first.groupBy("h1", "h2").agg(F.min(F.struct("role", "text")).alias("said"), F.count(F.lit(1)).alias("copies")).select("h1", "h2", "said.role", "said.text", "copies")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, h1, h2, n_turns and copies (conversations equal to it, itself included) of those that prefix no longer one.

    conv_id is null where only turns without conv_id are equal to it.
    """
    from fieldspark.session import materialize

    prefixes = materialize(prefix_hashes(turns.where(F.col("conv_id").isNotNull())), "chat-prefixes")
    ends = prefixes.where(F.col("place") == F.col("n_turns")).select("place", "h1", "h2", "conv_id", F.lit(1).cast("long").alias("copies"))
    ends = ends.unionByName(single_turns(turns).select(F.lit(1).alias("place"), "h1", "h2", F.lit(None).cast("long").alias("conv_id"), "copies"))
    whole = ends.groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.sum("copies").alias("copies"))
    proper = prefixes.where(F.col("place") < F.col("n_turns")).select("place", "h1", "h2").distinct()
    return whole.join(proper, ["place", "h1", "h2"], "left_anti").select("conv_id", "copies", F.col("place").alias("n_turns"), "h1", "h2")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, copies, n_turns, n_chars, rendered of every maximal conversation.

    A turn renders as <|role|>, line feed, its text, <|end|>, line feed; null role: unknown, null text:
    empty. Every turn without conv_id is a conversation of its own. Repeated turns are turns. Turns of equal
    number are ordered by role, then a hash of the text, in hashes and rendering alike. Rows of a conversation
    meet to be rendered, as they end up in one string; nothing else is gathered by key. Empty table: no rows;
    other columns are ignored.
    """
    from fieldspark.session import materialize

    turns = turns.select("conv_id", "turn", "role", "text")
    winners = materialize(maximal_conversations(turns), "chat-maximal")
    named = winners.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").alias("winner"), "copies", "n_turns")
    kept = turns.join(named, F.col("conv_id") == F.col("winner"))
    line = F.concat(F.lit(ROLE_OPEN), F.coalesce("role", F.lit("unknown")), F.lit(ROLE_CLOSE), F.coalesce("text", F.lit("")), F.lit(TURN_CLOSE))
    said = F.struct("turn", "role", F.md5("text").alias("text_md5"), line.alias("line"))
    chats = kept.groupBy("conv_id").agg(F.first("copies").alias("copies"), F.first("n_turns").alias("n_turns"), F.sort_array(F.collect_list(said)).alias("said"))
    chats = chats.select("conv_id", "copies", "n_turns", F.array_join(F.col("said.line"), "").alias("rendered"))
    lone = winners.where(F.col("conv_id").isNull()).select("conv_id", "copies", "n_turns", "h1", "h2").join(single_turns(turns).drop("copies"), ["h1", "h2"])
    chats = chats.unionByName(lone.select("conv_id", "copies", "n_turns", line.alias("rendered")))
    return chats.select("conv_id", F.col("copies").cast("long").alias("copies"), F.col("n_turns").cast("long").alias("n_turns"), F.length("rendered").cast("long").alias("n_chars"), "rendered")
