"""Prefix trie of conversations in balanced parentheses.

A node is a distinct sequence of first turns, named by two 64-bit hashes: the xor, over its turns, of
hashes of place, role and text. Nodes whose members all go on to one child are no more than links of a
chain; the others (a conversation ends there, or it branches) form the compact trie. The conversations
that end at different nodes, sorted by the compact nodes on their way, are the trie in depth-first order,
and that order is cut into shards: each is a piece of the trie's parentheses. Within a shard the excess
(depth after each parenthesis) has block minima, so the close of a node is found block by block; the
leaves below a node are a difference of ranks of leaf pairs, its savings one of cumulative sums. Nodes
that are open across a cut (the spine that shards share) get a part from each shard, and parts are added.
"""

from __future__ import annotations

from itertools import zip_longest

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.spread import ranked, spread_join
from fieldspark.session import materialize

STRETCH = 4096  # turns of a conversation that one window goes over
SHARD = 2000  # ending nodes of a shard
EXCESS_BLOCK = 64
IDS_A_CHUNK = 512


def head_length(conv_id: Column) -> Column:
    """How many turns of the first conversation of its hundred a conversation begins with."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("long")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (0, 1, ...), n, turn_hash, width (code points) of turns(conv_id, turn, role, text); without conv_id: none.

    By turn, null first; equal turns by turn_hash, of role and text, null being empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text)).alias("turn_hash"),
        F.length(text).cast("long").alias("width"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    return ranked(rows, "conv_id", ["turn", "turn_hash", "row_no"], "trie-turns").select("conv_id", "place", "n", "turn_hash", "width")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth from 1, turns of the whole, turn_hash, width), and (conv_id, turns) of all.

    The head is that of the first conversation of the hundred, which so has at most a hundred takers.
    """
    convs = placed.groupBy("conv_id").agg(F.max("n").alias("n")).withColumns({"h": head_length(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % 100})
    heads = placed.where((F.col("conv_id") % 100 == 0) & (F.col("place") < 5))
    lengths = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("held"))
    convs = convs.join(lengths, "base", "left").withColumn("head", F.least("h", F.coalesce("held", F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns")), "trie-conversations")
    first = heads.select(F.col("conv_id").alias("base"), "place", "turn_hash", "width").join(convs.where("head > 0"), "base").where("place < head")
    first = first.select("conv_id", (F.col("place") + 1).alias("depth"), "turns", "turn_hash", "width")
    own = placed.where(F.col("place") >= head_length(F.col("conv_id"))).withColumn("h", head_length(F.col("conv_id")))
    heads_of = convs.where("turns > head").select("conv_id", "head", "turns", (F.col("turns") - F.col("head")).alias("uses"))
    total = convs.agg(F.coalesce(F.sum(F.col("turns") - F.col("head")), F.lit(0)).alias("total")).first()["total"]
    own = spread_join(own, heads_of, ["conv_id"], "uses", total)
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("head") + 1).alias("depth"), "turns", "turn_hash", "width")
    return first.unionByName(own), convs.select("conv_id", "turns")


def along(rows: DataFrame, totals: dict[str, tuple[str, Column]], previous: dict[str, Column], longest: int) -> DataFrame:
    """rows(conv_id, depth, ...) with running totals (name: (aggregate, column)) up to each turn and values of the turn before.

    Windows go over STRETCH turns; what earlier stretches amount to is added, so no task need hold a
    conversation. longest: the largest depth; where it is within one stretch there is nothing to add.
    """
    stretch = rows.withColumn("stretch", F.floor((F.col("depth") - 1) / STRETCH)).withColumns({f"in_{c}": v for c, (_, v) in totals.items()} | {f"at_{c}": v for c, v in previous.items()})
    order = Window.partitionBy("conv_id", "stretch").orderBy("depth")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = {c: getattr(F, kind) for c, (kind, _) in totals.items()}
    inner = stretch.withColumns({c: kinds[c](f"in_{c}").over(upto) for c in totals} | {c: F.lag(f"at_{c}").over(order) for c in previous})
    if longest <= STRETCH:
        return inner.select(*rows.columns, *totals, *previous)
    long = stretch.where(F.col("depth") > STRETCH).select("conv_id").distinct()
    ends = stretch.join(long, "conv_id", "left_semi").groupBy("conv_id", "stretch").agg(*[kinds[c](f"in_{c}").alias(f"sum_{c}") for c in totals], *[F.max_by(f"at_{c}", "depth").alias(f"end_{c}") for c in previous])
    by = Window.partitionBy("conv_id").orderBy("stretch")
    ends = ends.select("conv_id", "stretch", *[kinds[c](f"sum_{c}").over(by.rowsBetween(Window.unboundedPreceding, -1)).alias(f"sum_{c}") for c in totals], *[F.lag(f"end_{c}").over(by).alias(f"end_{c}") for c in previous])
    out = inner.join(ends, ["conv_id", "stretch"], "left")
    plus = {c: F.coalesce(f"sum_{c}", F.lit(0)).bitwiseXOR(F.col(c)) if kind == "bit_xor" else F.coalesce(f"sum_{c}", F.lit(0)) + F.col(c) for c, (kind, _) in totals.items()}
    return out.select(*rows.columns, *[v.alias(c) for c, v in plus.items()], *[F.coalesce(c, f"end_{c}").alias(c) for c in previous])


def prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """turns(conv_id, depth, turns, turn_hash, width) with h1, h2 of the first depth turns and p1, p2 of one turn less (0: none)."""
    rolled = along(turns, {f"h{k}": ("bit_xor", F.xxhash64(F.lit(k), "depth", "turn_hash")) for k in (1, 2)}, {}, longest)
    # the xor of all turns but the last: the last one's hash taken out again
    return rolled.withColumns({f"p{k}": F.col(f"h{k}").bitwiseXOR(F.xxhash64(F.lit(k), "depth", "turn_hash")) for k in (1, 2)})


def trie_nodes(rows: DataFrame) -> DataFrame:
    """Of prefixes, the nodes: h1, h2, depth, first (smallest member), n_convs, n_ends, n_children, width, kept (not a mere link)."""
    nodes = rows.groupBy("h1", "h2", "depth").agg(
        F.min("conv_id").alias("first"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count(F.when(F.col("depth") == F.col("turns"), F.lit(1))).alias("n_ends"),
        F.min("width").alias("width"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.drop("p1", "p2").join(children, ["h1", "h2", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return nodes.withColumn("kept", (F.col("n_ends") > 0) | (F.col("n_children") != 1))


def excess_blocks(excess: np.ndarray, size: int = EXCESS_BLOCK) -> np.ndarray:
    """The least excess of each block of parentheses."""
    return np.array([excess[i : i + size].min() for i in range(0, len(excess), size)], np.int64)


def findclose(excess: np.ndarray, least: np.ndarray, start: int, below: int, size: int = EXCESS_BLOCK) -> int:
    """The first place from start on where the excess falls under `below`; len(excess) if it does not here."""
    end = min(len(excess), -(-start // size) * size)
    hit = np.flatnonzero(excess[start:end] < below)
    if len(hit):
        return start + int(hit[0])
    blocks = np.flatnonzero(least[end // size :] < below) if end < len(excess) else []
    if not len(blocks):
        return len(excess)
    at = (end // size + int(blocks[0])) * size
    return at + int(np.flatnonzero(excess[at : at + size] < below)[0])


def shared_length(a: list, b: list) -> int:
    """How many first entries two ways share."""
    n = 0
    for x, y in zip_longest(a, b):
        if x is None or y is None or x != y:
            break
        n += 1
    return n


def shard_parentheses(ways: list[list], before: list | None, after: list | None) -> tuple[list, np.ndarray, list, int]:
    """(nodes in order of opening, parentheses, node of each parenthesis, nodes open at the start) of sorted ways.

    Nodes shared with the way before are open from the start, at the front of the list; those shared with
    the way after stay open at the end.
    """
    spine = list(before[: shared_length(before, ways[0])]) if before else []
    nodes, stack = list(spine), list(range(len(spine)))
    marks, owner = [], []
    last = spine
    for way in [*ways, after if after is not None else []]:
        # two ways may only share what is open, and the last way is only looked at for what stays open
        same = min(shared_length(last, way), len(stack))
        while len(stack) > same:
            marks.append(-1)
            owner.append(stack.pop())
        if way is not after and way:
            for key in way[same:]:
                stack.append(len(nodes))
                nodes.append(key)
                marks.append(1)
                owner.append(stack[-1])
            last = way
    return nodes, np.array(marks, np.int64), owner, len(spine)


def _shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Parts of leaves and savings that a shard gives to each of its nodes (first, n_convs)."""
    rows = rows.sort_values("place")
    entries = {k: [[(e["first"], e["n_convs"]) for e in way] for way in rows.loc[rows["side"] == k, "way"]] for k in (-1, 0, 1)}
    own = {}
    for way in rows["way"]:
        paid = 0
        for e in way:
            own[(e["first"], e["n_convs"])] = e["saved"] - paid
            paid = e["saved"]
    nodes, marks, owner, spine = shard_parentheses(entries[0], *[entries[k][0] if entries[k] else None for k in (-1, 1)])
    excess = spine + np.cumsum(marks)
    least = excess_blocks(excess) if len(excess) else np.zeros(0, np.int64)
    opens = marks > 0
    at_open = [nodes[i] for i in np.array(owner, np.int64)[opens]] if len(marks) else []
    ranks, sums = np.zeros(len(marks) + 1, np.int64), [0] * (len(marks) + 1)
    # a leaf is a pair "()"; a node whose children are in the next shard is not closed here, so it makes none
    pair = opens[:-1] & ~opens[1:] if len(marks) else np.zeros(0, bool)
    ranks[1 : len(pair) + 1] = np.cumsum(pair)
    ranks[len(pair) + 1 :] = ranks[len(pair)] if len(pair) else 0
    value = iter(at_open)
    for i, m in enumerate(marks):
        sums[i + 1] = sums[i] + (own[next(value)] if m > 0 else 0)
    places = np.concatenate([np.full(spine, -1), np.flatnonzero(opens)])
    out = []
    for i, node in enumerate(nodes):
        begin = int(places[i])
        depth = i + 1 if begin < 0 else int(excess[begin])
        close = findclose(excess, least, max(begin, 0), depth) if len(excess) else 0
        low = max(begin, 0)
        out.append((*node, int(ranks[close] - ranks[low]), int(sums[close] - sums[low])))
    return pd.DataFrame(out, columns=["first", "n_convs", "n_leaves", "saved"])


def subtree_totals(ways: DataFrame) -> DataFrame:
    """ways(way array of (first, n_convs, saved) from the top down, one an ending node) -> first, n_convs, n_leaves, saved of every compact node.

    `saved` of an entry is the sum from the root down to it.
    """
    order = F.transform("way", lambda e: e["first"])
    placed = ranked(ways.select(F.lit(0).alias("all"), order.alias("order"), "way"), "all", ["order"], "trie-ways")
    shard = F.floor(F.col("place") / SHARD)
    # the last way of the shard before and the first of the one after go along
    sides = F.array(F.lit(0), F.when(F.col("place") % SHARD == SHARD - 1, 1), F.when((F.col("place") % SHARD == 0) & (F.col("place") > 0), -1))
    sent = placed.withColumn("step", F.explode(F.array_compact(sides))).select((shard + F.col("step")).alias("shard"), (-F.col("step")).cast("int").alias("side"), "place", "way")
    parts = sent.groupBy("shard").applyInPandas(_shard_of_own, "first long, n_convs long, n_leaves long, saved long")
    return parts.groupBy("first", "n_convs").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _shard_of_own(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A shard that only a neighbour's way was sent to does not exist."""
    if not (rows["side"] == 0).any():
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("first", "n_convs", "n_leaves", "saved")})
    return _shard(key, rows)


def _hash_chunks(batches):
    """Per node, in order of chunks, sha256 of the joined ids; a partition's rows are sorted by node and chunk."""
    import hashlib

    node, state = None, None
    done: list[tuple[tuple, str]] = []

    def flush():
        rows = [(*n, h) for n, h in done]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["h1", "h2", "depth", "ends_sha256"])

    for batch in batches:
        for h1, h2, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("h1", "h2", "depth", "ids")]):
            if (h1, h2, depth) != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = (h1, h2, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield flush()
    if state is not None:
        done.append((node, state.hexdigest()))
        yield flush()


def ends_digests(ends: DataFrame) -> DataFrame:
    """ends(h1, h2, depth, conv_id), one row a conversation -> h1, h2, depth, ends_sha256 of each node that any ends at.

    Ids are numbered within their node and joined to chunks in parallel; the hash of a node goes through its chunks in order.
    """
    rows = ends.select(F.struct("h1", "h2", "depth").alias("node"), "conv_id")
    placed = ranked(rows, "node", ["conv_id"], "trie-ends").withColumn("chunk", F.floor(F.col("place") / IDS_A_CHUNK))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = placed.groupBy("node", "chunk").agg(ids.alias("ids")).select("node.*", "chunk", "ids")
    sorted_chunks = chunks.repartition("h1", "h2", "depth").sortWithinPartitions("h1", "h2", "depth", "chunk").select("h1", "h2", "depth", "ids")
    return sorted_chunks.mapInArrow(_hash_chunks, "h1 long, h2 long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, one row a node.

    Conversations are rebuilt first (see `rebuilt`). Null role or text is empty; null turn comes first;
    turns of equal number are ordered by a hash of role and text; repeated rows are turns each. Turns without conv_id
    belong to no conversation and are left out. A conversation may have any number of turns and any share of
    all rows. Empty table: no rows, not even the root. Other columns are ignored. Two sequences are taken
    for one node if two 64-bit hashes and their length agree.
    """
    told, convs = rebuilt(materialize(ordered_turns(turns), "trie-placed"))
    whole = convs.agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"), F.coalesce(F.max("turns"), F.lit(0)).alias("longest"), F.count(F.when(F.col("turns") == 0, 1)).alias("turnless")).first()
    rows = materialize(prefixes(materialize(told, "trie-told"), whole["longest"]), "trie-prefixes")
    nodes = materialize(trie_nodes(rows), "trie-counted")
    ends = ends_digests(rows.where("depth = turns").select("h1", "h2", "depth", "conv_id"))
    # the smallest conversation that ends at a node stands for it; it goes through every node whose smallest member it is
    total = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0)).alias("total")).first()["total"]
    standing = rows.where("depth = turns").groupBy("h1", "h2", "depth").agg(F.min("conv_id").alias("conv_id")).select("conv_id", F.col("depth").alias("uses"))
    through = spread_join(rows.select("conv_id", "depth", "h1", "h2"), materialize(standing, "trie-standing"), ["conv_id"], "uses", total)
    through = spread_join(through, nodes.withColumn("uses", F.col("n_convs")), ["h1", "h2", "depth"], "uses", total)
    through = through.select("conv_id", "depth", "h1", "h2", "first", "n_convs", "n_children", "kept", ((F.col("n_convs") - 1) * F.col("width")).alias("own"))
    through = materialize(along(materialize(through, "trie-joined"), {"saved": ("sum", F.col("own"))}, {"parent": F.col("first")}, whole["longest"]), "trie-through")
    entry = F.struct("depth", "first", "n_convs", "saved")
    ways = through.where("kept").groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("way"))
    compact = materialize(subtree_totals(materialize(ways, "trie-long-ways").select("way")), "trie-compact")
    mine = through.where(F.col("conv_id") == F.col("first")).drop("conv_id")
    # a chain's links have the members of its kept end, so first and n_convs name it; those of one member have one leaf and save nothing
    chains = materialize(mine.where("n_convs > 1").groupBy("first", "n_convs").agg(F.count(F.lit(1)).alias("uses"), F.min(F.struct("depth", (F.col("saved") - F.col("own")).alias("above"))).alias("top")), "trie-chains")
    named = chains.join(compact.where("n_convs > 1").select("first", "n_convs", F.col("n_leaves").alias("leaves"), F.col("saved").alias("below")), ["first", "n_convs"])
    shared = spread_join(mine.where("n_convs > 1"), named, ["first", "n_convs"], "uses", total)
    # what lies above a link within its chain is no part of its subtree
    shared = shared.select(*mine.columns, F.col("leaves").alias("n_leaves"), (F.col("below") - (F.col("saved") - F.col("own") - F.col("top.above"))).alias("saved_tokens"))
    single = mine.where("n_convs = 1").select("*", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    parent = F.when(F.col("depth") == 1, F.lit(whole["first"])).otherwise(F.col("parent")).cast("long")
    rest = shared.unionByName(single).join(ends, ["h1", "h2", "depth"], "left").withColumns({"conv_id": F.col("first"), "parent_conv_id": parent, "ends_sha256": F.coalesce("ends_sha256", empty)}).select(*columns)
    return rest.unionByName(_root(convs, nodes, whole, empty).select(*columns)) if whole["n"] else rest


def _root(convs: DataFrame, nodes: DataFrame, whole, empty: Column) -> DataFrame:
    """The row of the root, whose members are all conversations."""
    below = nodes.agg(
        F.count(F.when(F.col("depth") == 1, F.lit(1))).alias("n_children"),
        F.greatest(F.count(F.when(F.col("n_children") == 0, F.lit(1))), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("width")), F.lit(0)).alias("saved_tokens"),
    )
    zero = F.lit(0).cast("long")
    root = below.withColumns({"conv_id": F.lit(whole["first"]).cast("long"), "depth": zero, "parent_conv_id": F.lit(None).cast("long"), "n_convs": F.lit(whole["n"]).cast("long")})
    if not whole["turnless"]:
        return root.withColumn("ends_sha256", empty)
    ends = ends_digests(convs.where("turns = 0").select(zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), "conv_id"))
    return root.join(ends.select("depth", "ends_sha256"), "depth")
