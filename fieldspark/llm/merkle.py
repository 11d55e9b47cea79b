"""Merkle manifest of a dataset with incremental witnesses.

A tree grows by appends only. Leaves of a source stand in order of doc_id; an aligned block of 16^3 of
them is appended by one task, leaf by leaf: each run of 16 that fills up completes a subtree and gives
every member the step (its place and its siblings) that its open witness was waiting for, and the
subtree's digest is in turn appended one level higher. A block's root is then an append to the next stage,
whose blocks are handled the same way, until each source has one node, its subroot; the subroots are
appended to the tree of the dataset. On the way down a node's witness is its steps within its block,
extended by the witness of the block's root, which all leaves of the block share.

Appending more documents touches the open block of each source and the new blocks, nothing else below.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.spread import ranked
from fieldspark.session import materialize

ARITY_BITS, STAGE_LEVELS = 4, 3
ARITY, BLOCK = 1 << ARITY_BITS, 1 << ARITY_BITS * STAGE_LEVELS
_WITNESS = "array<struct<at:int,siblings:binary>>"


def levels_of(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def join_digest(nodes: list[bytes]) -> bytes:
    """H of digests as hex text."""
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


class OpenTree:
    """A tree of fixed height that is appended to; witnesses grow as later siblings complete their runs."""

    def __init__(self, height: int):
        self.height, self.root = height, None
        self.open = [[] for _ in range(height)]  # the run of each level that still waits for members
        self.complete = [[] for _ in range(height)]  # full runs of each level, in order

    def append(self, node: bytes, level: int = 0) -> None:
        if level == self.height:
            self.root = node
            return
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.complete[level].append(run)
        self.append(join_digest(run), level + 1)

    def close(self) -> bytes:
        """No more nodes: runs that are not full are completed as they are, from the bottom."""
        for level in range(self.height):
            if self.open[level]:
                self._complete(level)
        return self.root

    def witness(self, i: int) -> list[tuple[int, list[bytes]]]:
        """(place in run, siblings) of leaf i for every level whose run is complete so far."""
        out = []
        for level in range(self.height):
            run, at = i >> ARITY_BITS * (level + 1), (i >> ARITY_BITS * level) % ARITY
            if run >= len(self.complete[level]):
                break
            members = self.complete[level][run]
            out.append((at, members[:at] + members[at + 1 :]))
        return out


def fold(node: bytes, witness: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a node and its witness lead to."""
    for at, siblings in witness:
        node = join_digest([*siblings[:at], node, *siblings[at:]])
    return node


def leaf_digest(columns: list[Column]) -> Column:
    """H of all values: `-` if null, else UTF-8 byte count, `:`, value."""
    said = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in said]), 256)


def document_leaves(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """tree, doc_id, digest, found, row_no of documents; found is the leaf of a row whose text is now `found` (null: unchanged)."""
    leaf = lambda text: F.unhex(leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]))
    # in code-point order of source, null first
    tree = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), "source"))
    now = F.lit(None).cast("binary") if found is None else F.when(found.isNotNull(), leaf(found))
    return docs.select(tree.alias("tree"), "doc_id", leaf(F.col("text")).alias("digest"), now.alias("found"), F.monotonically_increasing_id().alias("row_no"))


@dataclass
class Manifest:
    """stages[0]: leaves (tree, place, n, digest, doc_id, found); stages[k]: roots of the blocks of the stage below, up to one a tree."""

    stages: list[DataFrame]


def _digests(column) -> list[bytes]:
    return [x.hex().encode() for x in column]


def _grown(rows: pd.DataFrame) -> OpenTree:
    rows.sort_values("place", inplace=True, ignore_index=True)
    tree = OpenTree(min(STAGE_LEVELS, levels_of(int(rows["n"].max()))))
    for node in _digests(rows["digest"]):
        tree.append(node)
    tree.close()
    return tree


def _block_root(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    root = _grown(rows).root
    return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "n": [-(-int(rows["n"].max()) // BLOCK)], "digest": [bytes.fromhex(root.decode())]})


def _block() -> Column:
    return F.floor(F.col("place") / BLOCK)


def _append(stages: list[DataFrame], new: DataFrame) -> list[DataFrame]:
    """Stages after new(tree, place, n, digest, ...) are appended to the lowest; the largest n tells how many stages there are."""
    out, k = [], 0
    while True:
        old = stages[k] if k < len(stages) else None
        nodes = new if old is None else old.join(new.select("tree", "place"), ["tree", "place"], "left_anti").unionByName(new)
        nodes = nodes if old is None else materialize(nodes, f"merkle-{k}")
        out.append(nodes)
        largest = nodes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]
        if largest <= 1 and k + 1 >= len(stages):
            return out
        touched = nodes.withColumn("block", _block())
        if k + 1 < len(stages):  # blocks above which nothing is new keep their roots
            touched = touched.join(new.select("tree", _block().alias("block")).distinct(), ["tree", "block"], "left_semi")
        roots = touched.select("tree", "block", "place", "n", "digest").groupBy("tree", "block").applyInPandas(_block_root, "tree string, place long, n long, digest binary")
        new, k = materialize(roots, f"merkle-roots-{k}"), k + 1


def append_documents(manifest: Manifest | None, leaves: DataFrame) -> Manifest:
    """The manifest with the leaves of document_leaves appended; None: a new manifest.

    Within a source new doc_ids must come after all that are there, else ValueError; equal doc_ids of one
    append are ordered by leaf, and null comes first.
    """
    leaves = materialize(leaves, "merkle-leaves")
    if manifest is not None:
        held = manifest.stages[0].groupBy("tree").agg(F.max("doc_id").alias("last"), F.max("n").alias("held"))
        held = materialize(held, "merkle-held")
        begins = leaves.groupBy("tree").agg(F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("begins"))
        if begins.join(held, "tree").where("begins <= last").take(1):
            raise ValueError("documents can be appended only after those of their source")
    placed = ranked(leaves, "tree", ["doc_id", "digest", "row_no"], "merkle-sorted").drop("row_no")
    if manifest is not None:
        placed = placed.join(F.broadcast(held.select("tree", "held")) if held.count() <= 100_000 else held.select("tree", "held"), "tree", "left").withColumn("held", F.coalesce("held", F.lit(0)))
        placed = placed.withColumns({"place": F.col("place") + F.col("held"), "n": F.col("n") + F.col("held")}).drop("held")
    placed = materialize(placed.select("tree", "place", "n", "digest", "doc_id", "found"), "merkle-placed")
    return Manifest(_append(manifest.stages if manifest else [], placed))


def _steps(rows) -> list[tuple[int, list[bytes]]]:
    """A witness of a row of a DataFrame, siblings as hex text."""
    return [(s["at"], [x.hex().encode() for x in (s["siblings"][i : i + 32] for i in range(0, len(s["siblings"]), 32))]) for s in rows]


def _row_steps(witness) -> list[dict]:
    return [{"at": at, "siblings": bytes.fromhex(b"".join(siblings).decode())} for at, siblings in witness]


def _extend(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Witnesses of the nodes of a block: their steps in it, then the witness of its root."""
    tree, higher = _grown(nodes), list(above["witness"].iloc[0])
    return pd.DataFrame({"tree": nodes["tree"], "place": nodes["place"], "subroot": above["subroot"].iloc[0], "witness": [_row_steps(tree.witness(i)) + higher for i in range(len(nodes))]})


def _prove(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Of each leaf of a block, the hash of its whole witness and the root it leads to, from the leaf found now if there is one."""
    tree, higher = _grown(nodes), _steps(above["witness"].iloc[0])
    tail = b"".join(b"".join(siblings) for _, siblings in higher)
    leaves, proofs, roots = _digests(nodes["digest"]), [], []
    for i, found in enumerate(nodes["found"]):
        witness = tree.witness(i)
        proofs.append(hashlib.sha256(b"".join([*[x for _, siblings in witness for x in siblings], tail])).hexdigest())
        roots.append(fold(leaves[i] if found is None else found.hex().encode(), witness + higher).decode())
    return pd.DataFrame({"doc_id": nodes["doc_id"].astype("Int64"), "leaf": [x.decode() for x in leaves], "subroot": above["subroot"].iloc[0], "proof_sha256": proofs, "folded_root": roots})


def _below(nodes: DataFrame, above: DataFrame, function, schema: str) -> DataFrame:
    """function on each block of nodes and the one row of above that is its root."""
    blocks = nodes.withColumn("block", _block()).groupBy("tree", "block")
    return blocks.cogroup(above.select("tree", F.col("place").alias("block"), "subroot", "witness").groupBy("tree", "block")).applyInPandas(function, schema)


def _descend(stages: list[DataFrame], tops: DataFrame, lowest: int) -> DataFrame:
    """Witnesses of the nodes of stage `lowest`, from those of the tops (tree, place, subroot, witness)."""
    for k in range(len(stages) - 2, lowest - 1, -1):
        nodes = stages[k].select("tree", "place", "n", "digest")
        tops = materialize(_below(nodes, tops, _extend, f"tree string, place long, subroot string, witness {_WITNESS}"), f"merkle-witness-{k}")
    return tops


def witnessed_subroots(manifest: Manifest) -> tuple[str | None, DataFrame]:
    """Root of the dataset; tree, place (0), subroot and its witness up to the root."""
    subroots = manifest.stages[-1].select("tree", "digest")
    # the tree of all sources is put up anew: a new source may come before others
    nodes = ranked(subroots.select(F.lit("").alias("all"), "tree", "digest"), "all", ["tree"], "merkle-sources")
    nodes = materialize(nodes.select(F.lit("").alias("tree"), "place", "n", "digest", F.col("tree").alias("name")), "merkle-tops")
    stages = _append([], nodes)
    top = stages[-1].select(F.lower(F.hex("digest")).alias("root")).first()
    empty = stages[-1].select("tree", "place", F.lit("").alias("subroot"), F.array().cast(_WITNESS).alias("witness"))
    found = _descend(stages, empty, 0).select(F.col("place").alias("at"), "witness")
    named = nodes.join(found, F.col("place") == F.col("at")).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), F.lower(F.hex("digest")).alias("subroot"), "witness")
    return (top["root"] if top else None), materialize(named, "merkle-subroots")


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document of a manifest."""
    root, tops = witnessed_subroots(manifest)
    above = _descend(manifest.stages, tops, 1)
    leaves = manifest.stages[0]
    # where no source has more than one document, a leaf is its subroot and its block's root
    proofs = _below(leaves, above, _prove, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit(root).cast("string")
    return proofs.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def tampered_text() -> Column:
    """For one document in five (by crc32 of its doc_id) the text with A-Z lower-cased, else null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", upper, upper.lower()))


def merkle_manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """docs(doc_id, source, lang, n_chars, text) -> doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, one row a row.

    found: the text as found now, null where unchanged; a document whose text differs is not verified.
    Null values have a leaf of their own (`-`), apart from empty ones. Null source is a source, before all
    others; null doc_id comes before other ids. Repeated rows are leaves each, next to one another; rows that
    share a doc_id are ordered by leaf. A task holds one block of 16^3 leaves, whole texts never. Empty table:
    no rows. Other columns are ignored.
    """
    return prove(append_documents(None, document_leaves(docs, found)))
