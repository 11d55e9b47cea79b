"""WARC archives, the Merkle manifest and the prefix trie against brute force, with odd rows throughout."""

import gzip
import hashlib
import random
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import merkle, prefix_trie, spread, warc
from fieldspark.session import ensure_importable, shared_folder


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def folder(spark):
    return f"{shared_folder(ensure_importable(spark))}/test-{uuid.uuid4().hex}"


# WARC

BIG = "payload é " * 30
PAGES = [
    (5, "http://a/5", BIG, "x"),
    (3, "http://a/3", BIG, "x"),
    (9, None, BIG, "x"),
    (None, "http://a/none", BIG, "x"),
    (3, "http://a/3", BIG, "x"),
    (1, "http://a/1", "short", "x"),
    (2, "http://a/2", "short", "x"),
    (7, "http://a/\r\nX-Page-ID: 99", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n" * 5, "x"),
    (8, "http://a/8", None, "x"),
    (10, "http://a/10", "", "x"),
    (11, "http://a/11", "y" * 99, "x"),
    (12, "http://a/12", "y" * 99, "x"),
    (13, "http://a/13", "y" * 100, "x"),
    (14, "http://a/14", "y" * 100, "x"),
    (15, "http://a/15", "é" * 50, "x"),
    (-4, "http://a/-4", "é" * 50, "x"),
    (16, "http://a/16", "日本語 long " * 300_000, "x"),
    (None, None, "only ids are missing here " * 9, "x"),
    (None, None, "only ids are missing here " * 9, "x"),
]
PAGES += [(100 + i, f"http://b/{i}", "the page that a third of all share " * 4, "x") for i in range(12)]


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")


def expected_pages(rows):
    least = {}
    for page, _, html, _ in rows:
        if page is not None:
            least[html or ""] = min(page, least.get(html or "", page))
    out = []
    for page, _, html, _ in rows:
        data, first = (html or "").encode(), least.get(html or "")
        revisit = len(data) >= 100 and page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [spread.PART_ROWS, 10])
def test_pages_survive_their_archives(spark, monkeypatch, limit):
    monkeypatch.setattr(spread, "PART_ROWS", limit)  # with 10, the commonest payload is joined by broadcast
    got = warc.archive_pages(pages_frame(spark, PAGES).repartition(3), folder(spark))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_pages(PAGES)
    assert warc.archive_pages(pages_frame(spark, []), folder(spark)).count() == 0


def test_archives_are_warc_and_hold_each_payload_once(spark):
    at = folder(spark)
    warc.write_archives(warc.page_records(pages_frame(spark, PAGES)), at)
    files = spark.read.format("binaryFile").load(at).select("content").collect()
    blocks, ids = [], {}
    for f in files:
        for headers, block in warc.parse_archive(bytes(f.content)):
            assert {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"} <= set(headers)
            assert headers["warc-record-id"].startswith("<urn:uuid:")
            ids[headers["warc-record-id"]] = headers["warc-type"]
            if headers["warc-type"] == "revisit":
                assert headers["warc-profile"] == warc.PROFILE and block.endswith(b"\r\n\r\n") and "warc-refers-to" in headers
                if "warc-refers-to-target-uri" in headers:
                    assert headers["warc-refers-to-target-uri"].startswith("http://")
            else:
                blocks.append(block.partition(b"\r\n\r\n")[2])
    long = [b for b in blocks if len(b) >= 100]
    # of repeated rows each is a response: page 3 stands twice, and so do the two rows without any id
    assert len(long) - len(set(long)) == 2
    refs = {h["warc-refers-to"] for f in files for h, _ in warc.parse_archive(bytes(f.content)) if "warc-refers-to" in h}
    assert all(ids[r] == "response" for r in refs)


def test_archives_by_record_gzip_plain_and_damaged():
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Payload-Digest: sha256:%s\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    good = record % hashlib.sha256(b"hello").hexdigest().encode()
    for data in (good * 3, gzip.compress(good) * 3, gzip.compress(good * 3)):
        found = [warc.read_record(*r) for r in warc.parse_archive(data)]
        assert [(r[0], r[5], r[7]) for r in found] == [("resource", 5, b"hello")] * 3
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse_archive(good[:-6]))
    with pytest.raises(ValueError, match="damaged"):
        [warc.read_record(*r) for r in warc.parse_archive(good.replace(b"hello", b"hallo"))]


def test_older_archives_are_deduplicated_anew(spark):
    rows = [r for i, r in enumerate(PAGES) if r not in PAGES[:i]]
    first, second, third = folder(spark), folder(spark), folder(spark)
    warc.write_archives(warc.page_records(pages_frame(spark, rows)), first, least_bytes=1 << 40)  # nothing is a revisit
    assert warc.read_archives(spark, first).where("record_type = 'revisit'").count() == 0
    warc.deduplicate_archives(spark, first, second)
    warc.deduplicate_archives(spark, second, third)  # now with revisits in the source
    for at in (second, third):
        got = warc.resolve_revisits(warc.read_archives(spark, at)).drop("target_uri")
        assert sorted(map(tuple, got.collect()), key=repr) == expected_pages(rows)
    lone = folder(spark)
    records = warc.page_records(pages_frame(spark, rows)).withColumns({"record_type": F.lit("revisit"), "origin_id": F.lit(1).cast("long"), "origin_uri": F.lit(None).cast("string")})
    records.select(warc.record_text(F.lit("2020-01-01T00:00:00Z"))).write.option("lineSep", warc.RECORD_END).text(lone)
    with pytest.raises(ValueError, match="in none of the archives"):
        warc.deduplicate_archives(spark, lone, folder(spark))
    kept = warc.resolve_revisits(warc.read_archives(spark, lone)).collect()
    assert {(r.payload_bytes, r.payload_digest, r.refers_to) for r in kept} == {(len((r[2] or "").encode()), hashlib.sha256((r[2] or "").encode()).hexdigest(), None) for r in rows}


# Merkle manifest


def leaf(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
        out.append((run[: i % 16], run[i % 16 + 1 :]))
        i //= 16
    return out


def expected_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
        trees[s] = tree_levels([x[2] for x in sources[s]])
    top = tree_levels([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for at, s in enumerate(names):
        for i, (_, _, digest, r) in enumerate(sources[s]):
            way = siblings(trees[s], i) + siblings(top, at)
            now = leaf(r, lower(r[4])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else digest
            for left, right in way:
                now = H(*left, now, *right)
            out.append((r[0], digest, trees[s][-1][0], root, H(*[x for left, right in way for x in left + right]), now, now == root))
    return sorted(out, key=repr)


DOC = "doc_id long, source string, lang string, n_chars long, text string, place long"


def doc_frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], DOC)


def some_docs():
    rng = random.Random(3)
    rows = [(i, f"src{i % 3}", "en", i * 7, "Text " + "Ab " * rng.randrange(9) + str(i)) for i in range(400)]
    rows += [(1000 + i, None, None, None, None) for i in range(17)] + [(None, "src1", "en", 1, "A"), (None, "src1", "en", 1, "B")]
    rows += [rows[4]] * 20 + [(4, "src1", "de", 1, "Other"), (-5, "z", "en", None, ""), (2000, "\U0001f600", "en", 0, "Long " * 200_000), (2001, "￮", "en", 3, "É"), (2002, "", "", 0, "Empty name")]
    rows += [(3000 + i, f"lone{i}", "en", 1, "Alone") for i in range(20)]
    return rows


def test_manifest_against_whole_trees(spark, monkeypatch):
    monkeypatch.setattr(spread, "PART_ROWS", 60)
    rows = some_docs()
    got = merkle.merkle_manifest(doc_frame(spark, rows).repartition(4), merkle.tampered_text())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == expected_manifest(rows)
    assert {True, False} == {r[-1] for r in got}
    assert all(r[-1] for r in merkle.merkle_manifest(doc_frame(spark, rows)).collect())


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_small_manifests(spark, n):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(n)]
    assert sorted(map(tuple, merkle.merkle_manifest(doc_frame(spark, rows), merkle.tampered_text()).collect()), key=repr) == (expected_manifest(rows) if rows else [])


def test_appends_give_the_manifest_of_all(spark):
    """A source that passes one block in three appends, one that stays small, one that comes later."""
    rows = [(i, "big", "en", i, f"Doc {i}") for i in range(4500)] + [(i, "small", "en", i, f"Few {i}") for i in range(40)]
    rows += [(i, "alate", "en", i, f"Late {i}") for i in range(5000, 5003)]
    parts = [rows[:100] + rows[4500:4510], rows[100:4096] + rows[4510:4540], rows[4096:4500] + rows[4540:]]
    manifest = None
    for part in parts:
        manifest = merkle.append_documents(manifest, merkle.document_leaves(doc_frame(spark, part), merkle.tampered_text()))
    assert sorted(map(tuple, merkle.prove(manifest).collect()), key=repr) == expected_manifest(rows)
    with pytest.raises(ValueError, match="only after"):
        merkle.append_documents(manifest, merkle.document_leaves(doc_frame(spark, [(4499, "big", "en", 1, "again")])))


def test_witnesses_grow_with_later_siblings():
    tree, nodes = merkle.OpenTree(3), [H(str(i)).encode() for i in range(300)]
    lengths = []
    for n in nodes:
        tree.append(n)
        lengths.append(len(tree.witness(0)))
    assert [lengths.index(k) for k in (0, 1, 2)] == [0, 15, 255] and lengths[-1] == 2
    root = tree.close()
    for i in (0, 15, 16, 255, 256, 299):
        assert len(tree.witness(i)) == 3 and merkle.fold(nodes[i], tree.witness(i)) == root
        assert merkle.fold(b"0" * 64, tree.witness(i)) != root


# Prefix trie


def expected_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest(), role, text))
    told = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        told[c] = [t[3:] for t in sorted(convs.get(base, []))[:h]] + [t[3:] for t in sorted(turns)[h:]]
    if not told:
        return []
    members = defaultdict(list)
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, m in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(m) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, m in members.items():
        ends = sorted(c for c in m if len(told[c]) == len(path))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), children[path], leaves[path], saved[path], H(",".join(map(str, ends)))))
    return sorted(out, key=repr)


def some_turns(seed, n=150, words=2):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), *range(-30, 0), 100_000, 100_101, 1 << 40]:
        if rng.random() < 0.15:
            continue  # the first of a hundred may be absent too
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]) if rng.random() < 0.1 else ["user", "assistant"][t % 2], rng.choice(["é" * rng.randrange(1, words + 1), "", None, "yes"])))
    for c in range(500, 540):  # copies, and snapshots each a turn longer
        rows += [(c, t, "user", f"same {t}") for t in range(7)]
    for c in range(600, 640):
        rows += [(c, t, "user", f"log {t}") for t in range(c - 599)]
    rows += [(700 + k, t, "user", f"long {t if t < 60 or not k else -t}") for k in range(2) for t in range(90)]
    rows += [(800, None, "user", "no turn"), (800, None, "user", "no turn"), (800, 2, "b", "tie"), (800, 2, "a", "tie"), (None, 0, "user", "nobody's"), (801, 0, None, None), (801, 0, "", "")]
    rng.shuffle(rows)
    return rows


TURN = "conv_id long, turn long, role string, text string, depth string, first string"


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURN)


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_trie_against_brute_force(spark, monkeypatch, seed, small):
    if small:  # every stretch, shard, chunk and range is cut many times
        monkeypatch.setattr(prefix_trie, "STRETCH", 4)
        monkeypatch.setattr(prefix_trie, "SHARD", 3)
        monkeypatch.setattr(prefix_trie, "IDS_A_CHUNK", 4)
        monkeypatch.setattr(spread, "PART_ROWS", 100)
    rows = some_turns(seed)
    got = prefix_trie.prefix_trie(turn_frame(spark, rows).repartition(3))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_trie(rows)


def test_tries_without_turns_or_rows(spark):
    assert prefix_trie.prefix_trie(turn_frame(spark, [])).count() == 0
    only = [(c, 0, "user", "x") for c in range(1, 40) if zlib.crc32(str(c).encode()) % 6]  # their first turn is dropped, and conversation 0 is absent
    got = [tuple(r) for r in prefix_trie.prefix_trie(turn_frame(spark, only)).collect()]
    assert got == expected_trie(only) and len(got) == 1 and got[0][3] == len(only)


def test_close_is_found_over_blocks():
    rng = random.Random(1)
    for n in (1, 5, 63, 64, 65, 700):
        steps = np.array([rng.choice([1, -1]) for _ in range(n)])
        excess = 3 + np.cumsum(steps)
        least = prefix_trie.excess_blocks(excess, 8)
        for start in range(0, n, 3):
            for below in range(-5, 8):
                want = next((i for i in range(start, n) if excess[i] < below), n)
                assert prefix_trie.findclose(excess, least, start, below, 8) == want


def test_ranks_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(spread, "PART_ROWS", 10)
    rows = [("hot" if i % 3 else f"k{i % 5}", i * 37 % 101, i) for i in range(200)]
    got = spread.ranked(spark.createDataFrame(rows, "k string, v long, i long"), "k", ["v", "i"], "test-ranks").collect()
    groups = defaultdict(list)
    for k, v, i in sorted(rows):
        groups[k].append((v, i))
    assert sorted((r.k, r.place, r.v, r.i, r.n) for r in got) == sorted((k, p, *x, len(g)) for k, g in groups.items() for p, x in enumerate(g))
