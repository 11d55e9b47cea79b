"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

Texts become sets of hashed five-word windows (A-Z lower-cased; a text of one to four words is one
window). Equal sets form a class, and only classes are compared. A class's signature holds LEVELS
minima for each of TREES trees; the classes that share a prefix of a tree's minima are a node of that
tree's trie. A node is named by a hash of its prefix, so Spark's shuffle sorts the tries.

Matching starts at the longest prefix. Pairs met there, counted by their agreement, tell how many
pairs of each similarity there are and so which share of them a shorter prefix would meet: the prefix
is shortened to the first length that reaches the target recall, at the least to the length at which
pairs at the threshold itself reach it. At the shorter length only nodes that still hold classes of
different components are looked at, so a group of near copies is not compared again.

Within a node, signatures are compared whole, which drops pairs far below the threshold; what is left
links classes to candidate components. Component by component all pairs are verified on the full sets.
Windows are compared by HASH_BITS bits of a hash: two different windows of one comparison look equal
with probability 2**-HASH_BITS.

Nodes and components of any size are cut into blocks, and each pair of blocks is a group of its own:
no group holds more than two blocks. Pairs are counted where they are compared, never written out:
a block writes one link for each class that hangs on another, a pair of blocks one for each two
components that it joins. A large node whose classes are mostly near one another is not compared at
all: its classes are all linked to the first, which can only add candidates.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.words import mix, slices, texts_of, window_hashes, word_hashes, words_of
from fieldspark.session import materialize

WIDTH, THRESHOLD = 5, 0.8
TREES, LEVELS, RECALL = 24, 8, 0.9999
BLOCK = 256
HASH_BITS = 54  # of a window
BROADCAST_ROWS = 200_000


def matched_depth(threshold: float, recall: float = RECALL, trees: int = TREES, levels: int = LEVELS) -> int:
    """Levels of the prefix at which pairs of this similarity meet in some tree with this probability."""
    depth = levels
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shortened_depth(met: dict[int, int], hashes: int, depth: int, floor: int, threshold: float, recall: float = RECALL, trees: int = TREES) -> int:
    """The longest prefix, depth at most and floor at least, that reaches the recall on the pairs there are.

    met[k]: pairs met at depth, once for each tree, of which k of all hashes agree. The depth hashes by
    which they met say nothing about their similarity s, the others estimate it; a pair of similarity s
    is met in trees * s**depth trees on average, which turns meetings into numbers of pairs.
    """
    s = np.array([(k - depth) / (hashes - depth) for k in met])
    pairs = np.array(list(met.values()), float)[s >= threshold]
    s = s[s >= threshold]
    if not len(s):
        return floor
    pairs = pairs / s**depth
    while depth > floor and (pairs * (1 - s**depth) ** trees).sum() > (1 - recall) * pairs.sum():
        depth -= 1
    return depth


def least_agreement(threshold: float, hashes: int, miss: float = 1e-6) -> int:
    """Equal hashes that a pair at the threshold has all but surely: fewer have at most probability `miss`."""
    below, k = 0.0, 0
    while k < hashes:
        below += comb(hashes, k) * threshold**k * (1 - threshold) ** (hashes - k)
        if below > miss:
            return k
        k += 1
    return hashes


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct window hashes of all texts one after another, number of each text's); at most 1024 texts."""
    w = words_of(texts, lower=True)
    words = word_hashes(w)
    h, first = window_hashes(w, words, width)
    text = w.text_of_word()[first]
    counts = w.counts
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        sums = [np.bitwise_xor.reduce(mix(words[a:b] + np.arange(b - a, dtype=np.uint64))) for a, b in zip(w.first[short], w.first[short + 1])]
        whole = mix(np.array(sums, np.uint64) + counts[short].astype(np.uint64))
        h, text = np.r_[h, whole], np.r_[text, short]
    key = np.sort(text.astype(np.uint64) << np.uint64(HASH_BITS) | h >> np.uint64(64 - HASH_BITS))
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    n = np.bincount((key >> np.uint64(HASH_BITS)).astype(np.int64), minlength=len(texts))
    return key & np.uint64((1 << HASH_BITS) - 1), n


def set_digests(sets: np.ndarray, n: np.ndarray) -> list[bytes]:
    """16 bytes that depend on a set's members only."""
    out = np.zeros((len(n), 2), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        at = (np.cumsum(n) - n)[some]
        out[some, 0] = np.add.reduceat(mix(sets + np.uint64(0x51)), at)
        out[some, 1] = np.bitwise_xor.reduceat(mix(sets * np.uint64(0x2545F4914F6CDD1D) + np.uint64(7)), at) + n[some].astype(np.uint64)
    return [x.tobytes() for x in out]


def signatures(sets: np.ndarray, n: np.ndarray, hashes: int) -> np.ndarray:
    """16 bits of each minimum (texts x hashes); zeros for empty sets."""
    rng = np.random.Generator(np.random.PCG64(8))
    a, b = rng.integers(0, 1 << 32, hashes, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, hashes, np.uint32)
    out = np.zeros((len(n), hashes), "<u2")
    some = np.flatnonzero(n)
    if len(some):
        x = mix(sets).astype(np.uint32)
        at = (np.cumsum(n) - n)[some]
        v = np.empty_like(x)
        for k in range(hashes):
            np.multiply(x, a[k], out=v)
            v ^= b[k]
            low = np.minimum.reduceat(v, at)
            out[some, k] = (low * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16)
    return out


def _sketch(hashes: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, n = shingle_sets(texts_of(batch), width)
            sig = signatures(sets, n, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(set_digests(sets, n), pa.binary()), pa.array(n, pa.int64()), pa.array([s.tobytes() for s in sig], pa.binary())],
                ["doc_id", "text_hash", "class_key", "n_shingles", "signature"],
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Rows of a sorted partition, group by group, across batches."""
    held: dict[str, list] | None = None
    for batch in batches:
        cols = batch.to_pydict()
        of = list(zip(*[cols[k] for k in keys]))
        i = 0
        while i < len(of):
            j = i + 1
            while j < len(of) and of[j] == of[i]:
                j += 1
            part = {k: v[i:j] for k, v in cols.items()}
            if held is not None and tuple(held[k][0] for k in keys) == of[i]:
                for k in held:
                    held[k] += part[k]
            else:
                if held is not None:
                    yield held
                held = part
            i = j
    if held is not None:
        yield held


def _roots(linked: np.ndarray) -> np.ndarray:
    """First member of each member's component of a symmetric boolean matrix."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
                root[front] = i
    return root


def spanning_links(linked: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what the matrix joins: in one block, each member with the first of its component;
    between two blocks (whose own groups write those), the firsts of components that meet across them."""
    own = _roots(linked & (block[:, None] == block[None, :]))
    if (block == block[0]).all():
        return [(i, int(r)) for i, r in enumerate(own) if r != i]
    heads, place = np.unique(own, return_inverse=True)
    i, j = np.nonzero(linked & (block[:, None] != block[None, :]))
    met = np.zeros((len(heads), len(heads)), bool)
    met[place[i], place[j]] = True
    return [(int(heads[k]), int(heads[r])) for k, r in enumerate(_roots(met)) if r != k]


def _agreement(signature: list[bytes]) -> np.ndarray:
    sig = np.frombuffer(b"".join(signature), "<u2").reshape(len(signature), -1)
    same = np.zeros((len(sig), len(sig)), np.int16)
    for k in range(sig.shape[1]):
        same += sig[:, k, None] == sig[None, :, k]
    np.fill_diagonal(same, 0)
    return same


def _dense(least: int):
    """Whether at least half of a node's first block hangs together."""

    def run(batches):
        nodes, dense = [], []
        for g in _groups(batches, ["node"]):
            root = _roots(_agreement(g["signature"]) >= least)
            nodes.append(g["node"][0])
            dense.append(bool(2 * np.bincount(root).max() >= len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(dense, pa.bool_())], ["node", "dense"])

    return run


_CANDIDATES = "a binary, b binary, agreement int, pairs long"


def _candidates(least: int):
    """Links of each group, and for all groups of the task together the pairs of each agreement (a and b null)."""

    def run(batches):
        a, b, met = [], [], Counter()

        def flush(of=()):
            cols = [pa.array(a + [None] * len(of), pa.binary()), pa.array(b + [None] * len(of), pa.binary())]
            cols += [pa.array([None] * len(a) + [k for k, _ in of], pa.int32()), pa.array([None] * len(a) + [n for _, n in of], pa.int64())]
            return pa.RecordBatch.from_arrays(cols, ["a", "b", "agreement", "pairs"])

        for g in _groups(batches, ["node", "left_block", "right_block"]):
            same = _agreement(g["signature"])
            linked, block = same >= least, np.array(g["block"])
            counted = linked if g["left_block"][0] == g["right_block"][0] else linked & (block[:, None] != block[None, :])
            met.update(same[np.triu(counted)].tolist())
            for i, j in spanning_links(linked, block):
                a.append(g["class_key"][i])
                b.append(g["class_key"][j])
            if len(a) > 5000:
                yield flush()
                a, b = [], []
        yield flush(list(met.items()))

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of distinct, sorted arrays."""
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    if m <= 3:
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    value, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    column = np.cumsum(np.r_[False, column[1:] != column[:-1]]) if len(column) else column
    width = 4096
    edges = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else 0) + width + 1, width))
    total = np.zeros((m, m), np.float32)
    for k, (i, j) in enumerate(zip(edges, edges[1:])):
        if j > i:
            part = np.zeros((m, width), np.float32)
            part[row[i:j], column[i:j] - k * width] = 1
            total += part @ part.T
    return total.astype(np.int64)


def _verify(threshold: float):
    share = threshold / (1 + threshold)

    def run(batches):
        a, b, n = [], [], []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], ["a", "b", "n"])

        for g in _groups(batches, ["component", "left_block", "right_block"]):
            index = {k: i for i, k in reversed(list(enumerate(g["class_key"])))}  # repeated rows of a class count once
            keys, at = list(index), list(index.values())
            sets = [np.frombuffer(g["shingles"][i], "<u8") for i in at]
            block = np.array([g["block"][i] for i in at])
            size = np.array([len(s) for s in sets])
            inner = intersections(sets)
            linked = inner >= share * (size[:, None] + size[None, :]) - 1e-9
            np.fill_diagonal(linked, False)
            links = (linked if g["left_block"][0] == g["right_block"][0] else linked & (block[:, None] != block[None, :])).sum(axis=1)
            for i in np.flatnonzero(links):
                a.append(keys[i])
                b.append(None)
                n.append(int(links[i]))
            for i, j in spanning_links(linked, block):
                a.append(keys[i])
                b.append(keys[j])
                n.append(0)
            if len(a) > 5000:
                yield flush()
                a, b, n = [], [], []
        yield flush()

    return run


def _with_sets(width: int):
    def run(batches):
        for batch in slices(batches):
            sets, n = shingle_sets(texts_of(batch), width)
            ends = np.cumsum(n)
            fits = np.array([x == y for x, y in zip(set_digests(sets, n), batch.column(batch.schema.get_field_index("class_key")).to_pylist())], bool)
            out = pa.array([sets[e - k : e].astype("<u8").tobytes() for e, k in zip(ends, n)], pa.binary())
            names = ["component", "class_key", "blocks"]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in names] + [out]
            yield pa.RecordBatch.from_arrays(cols, [*names, "shingles"]).filter(pa.array(fits))

    return run


def _block():
    return F.pmod(F.xxhash64("class_key"), F.col("blocks")).cast("int")


def block_pairs(rows: DataFrame, key: str) -> DataFrame:
    """rows(key, class_key, blocks, ...) -> each row once for every pair of blocks that its own is in."""
    rows = rows.withColumn("block", _block()).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    return rows.withColumn("left_block", F.least("block", "other")).withColumn("right_block", F.greatest("block", "other")).drop("other", "blocks")


def _by_group(rows: DataFrame, key: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [key, "left_block", "right_block"]
    # within a group by class, so that the same class stands first wherever it is: links then repeat and are dropped
    return rows.repartition(n, *group).sortWithinPartitions(*group, "class_key")


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: a node keeps the link to its smallest neighbour below it; the
    others of them are linked to that one instead, where the links of many nodes coincide."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = edges.withColumn("low", F.min("b").over(Window.partitionBy("a")))
    return edges.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """edges(a, b) -> node, root (smallest node of its component), for nodes with an edge.

    Edges are contracted twice, for the same group met in several trees has as many stars. Labels go to neighbours and are then replaced by their own label, until none changes; each round is
    written to the shared folder. The rounds grow with the logarithm of the longest path.
    """
    edges = materialize(contracted(contracted(edges)), f"{name}-few")
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), f"{name}-0")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        step = labels.join(near, "node").select("node", "root", F.least("root", "m").alias("low"))
        far = labels.select(F.col("node").alias("low"), F.col("root").alias("lower"))
        new = materialize(step.join(far, "low").select("node", "root", F.least("low", "lower").alias("new")), name)
        labels = new.select("node", F.col("new").alias("root"))
        if new.where(F.col("new") != F.col("root")).isEmpty():
            return labels


def prefix_nodes(classes: DataFrame, depth: int) -> DataFrame:
    """classes(class_key, n, signature) -> node, class_key for each tree: the node at this depth."""
    tree, step = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))), 2 * LEVELS
    rows = classes.where("n > 0").select("class_key", "signature", tree.alias("tree"))
    return rows.select("class_key", F.xxhash64("tree", F.expr(f"substring(signature, tree * {step} + 1, {2 * depth})")).alias("node"))


def candidate_links(classes: DataFrame, depth: int, threshold: float, parts: DataFrame | None = None) -> DataFrame:
    """Links between classes that meet in some tree at this depth and agree enough, with the pairs met by agreement.

    parts(node, root): components known already; nodes within one of them are left out. Written.
    """
    least = least_agreement(threshold, TREES * LEVELS)
    nodes = prefix_nodes(classes, depth)
    count = [F.count(F.lit(1)).alias("m")]
    if parts is not None:
        known = parts.select(F.col("node").alias("class_key"), "root")
        nodes = nodes.join(known, "class_key", "left").withColumn("root", F.coalesce("root", "class_key"))
        count += [F.min("root").alias("r0"), F.max("root").alias("r1")]
    nodes = materialize(nodes, "jaccard-nodes")
    full = nodes.groupBy("node").agg(*count).where("m > 1" if parts is None else "m > 1 and r0 <> r1")
    members = nodes.join(full, "node").select("node", "class_key", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    members = materialize(members.join(classes.select("class_key", "signature"), "class_key"), "jaccard-members")
    small, large = members.where("blocks = 1"), members.where("blocks > 1")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = large.where(_block() == 0).select("node", "signature").repartition(n, "node").sortWithinPartitions("node")
    dense = materialize(first.mapInArrow(_dense(least), "node long, dense boolean").where("dense").select("node"), "jaccard-dense")
    pairs = small.unionByName(large.join(dense, "node", "left_anti"))
    near = _by_group(block_pairs(pairs, "node"), "node").select("node", "left_block", "right_block", "block", "class_key", "signature")
    met = near.mapInArrow(_candidates(least), _CANDIDATES)
    crowd = large.join(dense, "node").select("node", "class_key")
    heads = materialize(crowd.groupBy("node").agg(F.min("class_key").alias("b")), "jaccard-heads")
    stars = crowd.join(heads, "node").where("class_key <> b").select(F.col("class_key").alias("a"), "b").distinct()
    return materialize(met.unionByName(stars.withColumns({"agreement": F.lit(None).cast("int"), "pairs": F.lit(None).cast("long")})), "jaccard-links")


def candidate_components(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """node (a class), root: components of the candidate pairs, by prefixes shortened as the pairs met call for."""
    links = candidate_links(classes, LEVELS, threshold)
    met = {r["agreement"]: r["n"] for r in links.where("a is null").groupBy("agreement").agg(F.sum("pairs").alias("n")).collect()}  # a row an agreement
    edges = links.where("a is not null").select("a", "b").distinct()
    parts = connected_components(edges, "jaccard-candidates")
    depth = shortened_depth(met, TREES * LEVELS, LEVELS, matched_depth(threshold, recall), threshold, recall)
    if depth < LEVELS:
        more = candidate_links(classes, depth, threshold, parts).where("a is not null").select("a", "b").distinct()
        parts = connected_components(more.unionByName(parts.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))), "jaccard-candidates")
    return parts


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, recall: float = RECALL) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, class_id, class_size, n_links, group_id, kept, text_hash, group_key; one row per row.

    class_id: smallest doc_id of the texts with the same set (null only if all are null). n_links: other
    classes whose similarity to this one is at least the threshold. group_id: smallest class_id among the
    classes that links join, directly or through others; kept: the rows of doc_id group_id. Null and empty
    texts have no windows: they form one class without links. Equal rows share a class. Other columns are
    ignored; an empty table gives no rows. text_hash and group_key identify text and group where ids do not.
    """
    hashes = TREES * LEVELS
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    schema = "doc_id long, text_hash long, class_key binary, n_shingles long, signature binary"
    sketches = materialize(text.mapInArrow(_sketch(hashes, width), schema), "jaccard-sketches")
    classes = sketches.groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("rep"), F.count(F.lit(1)).alias("class_size"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
    )
    classes = materialize(classes.select("class_key", F.col("rep.doc_id").alias("class_id"), F.col("rep.text_hash").alias("rep_hash"), "class_size", "n", "signature"), "jaccard-classes")
    parts = candidate_components(classes, threshold, recall)

    # verification: the sets of the classes in components, block by block
    sizes = parts.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    need = parts.join(sizes, "root").select(F.col("root").alias("component"), F.col("node").alias("class_key"), "blocks")
    need = materialize(need.join(classes.select("class_key", "class_id", "rep_hash"), "class_key"), "jaccard-need")
    if need.count() <= BROADCAST_ROWS:
        need = F.broadcast(need)
    found = text.join(need, (text.text_hash == need.rep_hash) & text.doc_id.eqNullSafe(need.class_id)).select("component", "class_key", "blocks", "text")
    sets = found.mapInArrow(_with_sets(width), "component binary, class_key binary, blocks long, shingles binary")
    pairs = _by_group(block_pairs(sets, "component"), "component").select("component", "left_block", "right_block", "block", "class_key", "shingles")
    verified = materialize(pairs.mapInArrow(_verify(threshold), "a binary, b binary, n long"), "jaccard-verified")
    links = verified.where("b is null").groupBy(F.col("a").alias("class_key")).agg(F.sum("n").alias("n_links"))
    groups = connected_components(verified.where("b is not null"), "jaccard-groups").withColumnRenamed("node", "class_key")

    info = classes.select("class_key", "class_id", "class_size").join(links, "class_key", "left").join(groups, "class_key", "left")
    info = materialize(info.withColumn("root", F.coalesce("root", "class_key")), "jaccard-info")
    # written before it is joined, so that both sides are plain exchanges and a large group's rows can be split
    firsts = materialize(info.groupBy("root").agg(F.min("class_id").alias("group_id")), "jaccard-firsts")
    info = info.join(firsts, "root").select("class_key", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id", F.col("root").alias("group_key"))
    kept = F.col("doc_id").eqNullSafe(F.col("group_id"))
    rows = sketches.select("doc_id", "n_shingles", "class_key", "text_hash").join(info, "class_key")
    return rows.select("doc_id", "n_shingles", "class_id", "class_size", "n_links", "group_id", kept.alias("kept"), "text_hash", "group_key")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group; of repeated rows of that document one stays. Columns as before."""
    names = docs.columns
    stay = jaccard_join(docs.select("doc_id", "text"), **options).where("kept").groupBy("group_key").agg(F.first("doc_id").alias("stay_id"), F.min("text_hash").alias("stay_hash"))
    rows = docs.select(F.struct(*names).alias("jaccard_row"), F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_hash"))
    same = (F.col("row_hash") == F.col("stay_hash")) & F.col("row_id").eqNullSafe(F.col("stay_id"))
    kept = rows.join(stay, same, "left_semi").dropDuplicates(["row_hash", "row_id"])
    return kept.select(*[F.col(f"jaccard_row.`{c}`").alias(c) for c in names])
