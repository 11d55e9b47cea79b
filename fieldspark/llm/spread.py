"""Numbering and joining rows when one key may hold a large share of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.session import materialize

PART_ROWS = 50_000  # rows a task numbers, about
HEAVY = 1000  # a key is heavy if it holds over a thousandth of all rows, so there are fewer than this many


def ranked(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """rows (read twice) with `place`, 0, 1, ... within each key by order, and `n`, the rows of the key.

    Rows are range-sorted by key and order, numbered within their range, and the numbers of earlier
    ranges with the same key are added; so a key may hold any share of the rows. key must not be null;
    order should tell rows apart, or equal ones share a range.
    """
    parts = max(1, -(-rows.count() // PART_ROWS))
    dealt = rows.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = materialize(dealt.select("*", F.spark_partition_id().alias("rank_part"), index.alias("rank_index")), name)
    pieces = dealt.groupBy(F.col(key).alias("rank_key"), F.col("rank_part").alias("rank_piece")).agg(F.min("rank_index").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("rank_key")
    before = F.sum("rows").over(whole.orderBy("rank_piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("rank_key", "rank_piece", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    out = dealt.join(pieces, (F.col(key) == F.col("rank_key")) & (F.col("rank_part") == F.col("rank_piece")))
    return out.select(*rows.columns, (F.col("rank_index") + F.col("shift")).alias("place"), "n")


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], uses: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with table, which has each of keys once and in `uses` how many rows have it.

    Keys of more than total / HEAVY rows are fewer than HEAVY by the sum of uses, so they alone are
    broadcast and their rows stay where they are; all other keys are shuffled, none of them heavy.
    """
    limit = max(total // HEAVY, PART_ROWS // 10)
    heavy = table.where(F.col(uses) > limit).drop(uses)
    light = table.where(F.col(uses) <= limit).drop(uses)
    if not heavy.take(1):
        return rows.join(light, keys, how)
    few = F.broadcast(heavy)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(rest.join(light, keys, how))
