"""Exact dedup against a history held in minimal perfect hash shards.

The history is the set of distinct digests seen so far. It is cut into shards by the digest's first
bytes; each shard holds a minimal perfect hash (levels of bit arrays, a digest's slot being the rank
of the first level where its bit stands alone), and per slot the full digest and its locator: the
doc_id that wins and the number of rows. A lookup computes one slot and compares all 32 bytes, so a
digest that is not in the history can never pass for one that is. Digests outside the history are
grouped on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.session import materialize

SHARD_DIGESTS = 20_000  # digests a shard, about
SHARD_SCHEMA = "shard long, n long, levels array<int>, bits binary, digests binary, keep_id binary, keep_null binary, rows binary"
_GAMMA = 2.0


def digest(text: Column) -> Column:
    """sha256 of the text with A-Z lower-cased; null counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), 256)


def _mix(words: np.ndarray, level: int) -> np.ndarray:
    """A hash of each digest (rows of four uint64) for one level."""
    seed = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)
    h = words[:, 1] ^ words[:, 2] * seed ^ words[:, 3] >> np.uint64(7)
    h = (h ^ h >> np.uint64(32)) * seed
    return h ^ h >> np.uint64(29)


def build_mph(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, all levels' bits, slot of each digest) for distinct digests."""
    left, sizes, bits, slot, done = np.arange(len(words)), [], [], np.empty(len(words), np.int64), 0
    while len(left):
        size = max(64, int(_GAMMA * len(left)))
        at = (_mix(words[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        slot[left[mine]] = done + (np.cumsum(alone) - 1)[at[mine]]
        done += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~mine]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def lookup_mph(sizes: list[int], bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The slot each digest would have; -1 where no level has its bit."""
    rank = np.cumsum(bits) - 1
    slot, left, start = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = start + (_mix(words[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        slot[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    return slot


def _words(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def _shard(key, rows):
    sizes, bits, slot = build_mph(_words(rows["digest"]))
    order = np.argsort(slot)
    null = rows["keep_id"].isna().to_numpy()[order]
    return pd.DataFrame(
        {
            "shard": [key[0]],
            "n": [len(rows)],
            "levels": [sizes],
            "bits": [np.packbits(bits).tobytes()],
            "digests": [b"".join(rows["digest"].iloc[order])],
            "keep_id": [rows["keep_id"].fillna(0).to_numpy().astype("<i8")[order].tobytes()],
            "keep_null": [np.packbits(null).tobytes()],
            "rows": [rows["rows"].to_numpy().astype("<i8")[order].tobytes()],
        }
    )


def _shard_of(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(shards))


def group_digests(rows: DataFrame) -> DataFrame:
    """(digest binary, doc_id) -> one row a digest: keep_id (largest, null only if all are) and rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("rows"))


def build_history(groups: DataFrame, shards: int) -> DataFrame:
    """Minimal perfect hash shards over groups(digest, keep_id, rows) with distinct digests."""
    return groups.withColumn("shard", _shard_of(shards)).groupBy("shard").applyInPandas(_shard, SHARD_SCHEMA)


def _look_up(key, new, shard):
    """New digests of one shard, with the winner and rows of the history where they are in it."""
    out = pd.DataFrame({"digest": new["digest"], "keep_id": new["keep_id"].astype("Int64"), "rows": new["rows"]})
    out["old_keep"], out["old_rows"] = pd.array([pd.NA] * len(new), "Int64"), pd.array([pd.NA] * len(new), "Int64")
    if len(new) and len(shard):
        s = shard.iloc[0]
        n = int(s["n"])
        sizes = [int(x) for x in s["levels"]]
        bits = np.unpackbits(np.frombuffer(s["bits"], np.uint8))[: sum(sizes)].astype(bool)
        words, held = _words(new["digest"]), np.frombuffer(s["digests"], "<u8").reshape(-1, 4)
        slot = lookup_mph(sizes, bits, words)
        hit = np.flatnonzero((slot >= 0) & (held[slot] == words).all(axis=1))
        null = np.unpackbits(np.frombuffer(s["keep_null"], np.uint8))[:n].astype(bool)
        keep = pd.array(np.frombuffer(s["keep_id"], "<i8")[slot[hit]], "Int64")
        keep[null[slot[hit]]] = pd.NA
        out.loc[out.index[hit], "old_keep"] = keep
        out.loc[out.index[hit], "old_rows"] = np.frombuffer(s["rows"], "<i8")[slot[hit]]
    return out


_FOUND = "digest binary, keep_id long, rows long, old_keep long, old_rows long"


def against_history(new: DataFrame, history: DataFrame, shards: int) -> DataFrame:
    """groups(digest, keep_id, rows) with old_keep and old_rows of the history (null: not a member).

    A task gets one shard and the new digests that fall to it; digests are spread evenly and each
    comes once, whatever the number of its copies.
    """
    return new.withColumn("shard", _shard_of(shards)).groupBy("shard").cogroup(history.groupBy("shard")).applyInPandas(_look_up, _FOUND)


def equal_groups(rows: DataFrame) -> DataFrame:
    """rows(doc_id, in_history, text_sha256), read more than once -> text_sha256, keep_id, group_size."""
    narrow = rows.select("doc_id", "in_history", F.unhex("text_sha256").alias("digest"))
    old = materialize(group_digests(narrow.where("in_history")), "dedup-history-groups")
    new = materialize(group_digests(narrow.where(~F.col("in_history"))), "dedup-new-groups")
    shards = max(1, -(-max(old.count(), new.count()) // SHARD_DIGESTS))  # either side of a shard is bounded
    history = materialize(build_history(old, shards), "dedup-history")
    found = materialize(against_history(new, history, shards), "dedup-found")
    members = found.where(F.col("old_rows").isNotNull())
    nonmembers = found.where(F.col("old_rows").isNull()).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("rows").alias("rows"))
    # a member's history entry is replaced by one that holds both; the rest of the history stays as it is
    both = members.select("digest", F.greatest("keep_id", "old_keep").alias("keep_id"), (F.col("rows") + F.col("old_rows")).alias("rows"))
    rest = old.join(members.select("digest"), "digest", "left_anti")
    return both.unionByName(rest).unionByName(nonmembers).select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", F.col("rows").alias("group_size"))


def _digests(docs: DataFrame, is_history: Column | None) -> DataFrame:
    if is_history is None:
        middle = docs.agg(F.percentile_approx("doc_id", 0.5).alias("middle")).first()["middle"]
        is_history = F.col("doc_id") <= F.lit(middle)
    rows = docs.select("doc_id", F.coalesce(is_history, F.lit(False)).alias("in_history"), digest(F.col("text")).alias("text_sha256"))
    return materialize(rows, "dedup-digests")


def exact_dedup(docs: DataFrame, is_history: Column | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, keep_id, group_size, kept, text_sha256, one row per row of docs.

    is_history marks rows that were there before (default: the older half, doc_id up to about
    the median); their distinct digests form the minimal perfect hash, the others are looked up in it,
    and digests found in neither are grouped separately. The winner of equal texts is the largest
    doc_id over both; a null doc_id loses to any other and wins only where all are null. Repeated rows
    with the winner's doc_id and text are all marked kept. Null text counts as empty. Other columns are
    ignored. Empty table: no rows.
    """
    rows = _digests(docs, is_history)
    out = rows.join(equal_groups(rows), "text_sha256")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def dedup_documents(docs: DataFrame, is_history: Column | None = None) -> DataFrame:
    """docs without the rows that lose; of repeated rows that would all win (same doc_id and text) one stays.

    Texts move once, to the winner's digest and doc_id, so copies do not meet in one task.
    """
    names = docs.columns
    winners = equal_groups(_digests(docs, is_history)).select("text_sha256", "keep_id")
    rows = docs.select(F.struct(*names).alias("dedup_row"), F.col("doc_id").alias("dedup_id"), digest(F.col("text")).alias("dedup_sha256"))
    won = (F.col("dedup_sha256") == F.col("text_sha256")) & F.col("dedup_id").eqNullSafe(F.col("keep_id"))
    kept = rows.join(winners, won, "left_semi").dropDuplicates(["dedup_sha256", "dedup_id"])
    return kept.select(*[F.col(f"dedup_row.`{c}`").alias(c) for c in names])
