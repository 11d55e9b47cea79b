"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Boundaries are found on arrays, without a regular expression. Each code point has a class; each class
is a transition function on a few states ("may a quote start a contraction here?"). Composition of
functions is associative, so all states come from a scan: functions are composed within stretches of
text side by side, the stretches' compositions are scanned one level up, and the states are filled in.
State and class of a code point and its neighbours then tell whether a slice starts there. Slices go
to pair merging through a cache; their offsets are kept, so ids can be traced to bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.words import ragged, slices, texts_of

# classes of code points
LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE1, QUOTE2 = range(7)
# states after a code point: may a quote start a contraction next; within one, letters still to come
FREE, BOUND, ONE_LEFT, TWO_LEFT, CLOSED = range(5)
STRETCH = 64


def _class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            points = np.frombuffer(m[0].encode("utf-32-le"), "<u4")
            table[points] = kind
    table[0x20] = SPACE
    return table


def _transitions() -> np.ndarray:
    """next state [class, state]. QUOTE1, QUOTE2: a quote that one or two fitting letters follow."""
    t = np.empty((7, 5), np.uint8)
    for state in range(5):
        for kind in range(7):
            if state == TWO_LEFT:
                t[kind, state] = ONE_LEFT
            elif state == ONE_LEFT:
                t[kind, state] = CLOSED
            elif kind in (LETTER, NUMBER, WHITE):
                t[kind, state] = FREE
            elif kind == SPACE:
                t[kind, state] = BOUND  # a quote after a space belongs to the space's slice
            elif kind == OTHER or state == BOUND:
                t[kind, state] = BOUND
            else:
                t[kind, state] = ONE_LEFT if kind == QUOTE1 else TWO_LEFT
    return t


CLASSES, NEXT = _class_table(), _transitions()
_NEXT_FLAT = NEXT.ravel()


def scan_states(kinds: np.ndarray, start: int = FREE, functions: np.ndarray | None = None) -> np.ndarray:
    """State before each element, by an associative scan of transition functions.

    functions (n x 5): the function of each element; else that of its class.
    """
    n, s = len(kinds) if functions is None else len(functions), NEXT.shape[1]
    if n <= STRETCH:
        out, state = np.empty(n, np.uint8), start
        for i in range(n):
            out[i] = state
            state = NEXT[kinds[i], state] if functions is None else functions[i, state]
        return out
    rows = -(-n // STRETCH)
    if functions is None:
        # padding never changes a state that is used
        grid = np.full(rows * STRETCH, LETTER, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, STRETCH).T)
        base = grid.astype(np.int16) * s
        f = np.broadcast_to(np.arange(s, dtype=np.int16)[:, None], (s, rows)).copy()
        for j in range(STRETCH):
            f = _NEXT_FLAT.take(base[j] + f)
        state = scan_states(np.zeros(0), start, np.ascontiguousarray(f.T)).astype(np.int16)
        out = np.empty((STRETCH, rows), np.uint8)
        for j in range(STRETCH):
            out[j] = state
            state = _NEXT_FLAT.take(base[j] + state)
        return out.T.ravel()[:n]
    whole = np.broadcast_to(np.arange(s, dtype=functions.dtype), (rows * STRETCH, s)).copy()
    whole[:n] = functions
    grid = whole.reshape(rows, STRETCH, s)
    f, r = np.broadcast_to(np.arange(s), (rows, s)).copy(), np.arange(rows)
    for j in range(STRETCH):
        f = grid[r[:, None], j, f]
    state = scan_states(np.zeros(0), start, f)
    out = np.empty((rows, STRETCH), np.uint8)
    for j in range(STRETCH):
        out[:, j] = state
        state = grid[r, j, state]
    return out.ravel()[:n]


def boundaries(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Places where slices start, for code points of texts one after another (each text starts one).

    Before each text stands a line feed of its own, so that texts do not touch: see slice_texts.
    """
    kinds = CLASSES[points]
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        after = np.r_[points, [0, 0]].astype(np.int64)
        a, b = after[quote + 1], after[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        kinds[quote[one]] = QUOTE1
        kinds[quote[two]] = QUOTE2
    before = scan_states(kinds)
    run = np.where(kinds >= OTHER, OTHER, kinds)  # quotes run on with other signs
    last = np.r_[WHITE, run[:-1]].astype(np.uint8)
    nxt = np.r_[run[1:], WHITE].astype(np.uint8)
    white = (run == SPACE) | (run == WHITE)
    last_white = (last == SPACE) | (last == WHITE)
    next_white = (nxt == SPACE) | (nxt == WHITE)
    ends_text = np.zeros(len(points), bool)
    ends_text[np.r_[text_starts[1:], len(points)] - 1] = True
    # a sign starts a slice after another kind, except after a space that joins it, and after a contraction
    sign = ~white & ((run != last) & (last != SPACE) | (before == CLOSED))
    quote_starts = (kinds >= QUOTE1) & (before != BOUND) & (before != ONE_LEFT) & (before != TWO_LEFT)
    sign |= quote_starts
    sign &= ~((before == ONE_LEFT) | (before == TWO_LEFT))
    # white space: the first of a run; and the last of a run of more, unless the text ends there
    start = sign | white & ~last_white | white & last_white & ~next_white & ~ends_text
    start[text_starts] = True
    return np.flatnonzero(start)


def slice_texts(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(all texts' bytes, byte places where slices start with the end last, number of slices of each text).

    Texts stand one after another with a line feed between, which ends any run and is dropped again.
    """
    joined = b"\n".join(texts) + b"\n"
    whole = joined.decode("utf-8")
    points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    raw = np.frombuffer(joined, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)  # byte of each code point
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first_byte = np.r_[0, np.cumsum(sizes + 1)]
    first = np.searchsorted(lead, first_byte)  # code point of each text's start, and of the end
    mark = first[1:] - 1  # the line feeds between
    # boundaries see the texts alone: the line feeds between are taken out of the neighbourhood rules
    starts = _boundaries_between(points, first[:-1], mark)
    at = np.r_[lead[starts], len(joined)]
    counts = np.diff(np.searchsorted(starts, first)) - 1  # without the mark's own slice
    return joined, at, counts


def _boundaries_between(points: np.ndarray, first: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """boundaries() of marked texts: each mark is a slice of its own and counts as the text's end."""
    firsts = np.unique(np.r_[first, mark])
    return boundaries(points, firsts)


class BytePairs:
    """Ids of slices by ranks, each distinct slice merged once."""

    def __init__(self, path: str, most: int = 300_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.most = most
        top = max(self.ranks.values()) + 1
        tokens = [b""] * top
        for t, i in self.ranks.items():
            tokens[i] = t
        self.token_n = np.fromiter(map(len, tokens), np.int64, top)
        self.token_at = np.cumsum(self.token_n) - self.token_n
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.clear()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.flat, self.start, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked neighbours until none is in the ranks."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 200:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == 1 << 60:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap and a linked list, for slices without any break."""
        import heapq

        ranks, n = self.ranks, len(piece)
        text, right, left, alive = [piece[i : i + 1] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or len(text[i]) + len(text[j]) != size:
                continue
            text[i] += text[j]
            alive[j] = False
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (r := ranks.get(text[a] + text[b])) is not None:
                    heapq.heappush(heap, (r, a, len(text[a]) + len(text[b])))
        return [ranks[text[i]] for i in range(n) if alive[i]]

    def _add(self, pieces: list[bytes]):
        ids = [self.merge(p) for p in pieces]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum()))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while self.held + len(n) > len(self.n):
            self.start, self.n = np.r_[self.start, np.zeros_like(self.start)], np.r_[self.n, np.zeros_like(self.n)]
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[self.held : self.held + len(n)] = self.used + np.cumsum(n) - n
        self.n[self.held : self.held + len(n)] = n
        self.known.update(zip(pieces, range(self.held, self.held + len(n))))
        self.held += len(n)
        self.used += len(flat)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each, byte offset in its text of each id)."""
        if self.held > self.most:
            self.clear()
        joined, at, counts = slice_texts(texts)
        places = at.tolist()
        pieces = [joined[a:b] for a, b in zip(places, places[1:])]
        get = self.known.get
        which = [get(p, -1) for p in pieces]
        if -1 in which:
            missing = list({p for p, i in zip(pieces, which) if i < 0})
            self._add(missing)
            which = [get(p) if i < 0 else i for p, i in zip(pieces, which)]
        # the marks between texts stand after each text's slices
        keep = np.ones(len(which), bool)
        keep[np.cumsum(counts + 1) - 1] = False
        which = np.array(which, np.int64)[keep]
        slice_at = at[:-1][keep]
        n = self.n[which]
        ids = self.flat[ragged(self.start[which], n)].astype("<u4")
        total = np.r_[0, np.cumsum(n)]
        ends = np.cumsum(counts)
        per_text = total[ends] - total[ends - counts]
        sizes = self.token_n[ids]
        before = np.cumsum(sizes) - sizes
        lead = np.repeat(before[total[:-1].clip(max=max(0, len(before) - 1))] if len(before) else np.zeros(0, np.int64), n)
        text_at = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)][:-1]
        offsets = np.repeat(slice_at, n) + before - lead - np.repeat(text_at, per_text)
        return ids, per_text, offsets

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.token_n[ids]
        return self.token_bytes[ragged(self.token_at[ids], n)].tobytes()


_PAIRS: dict[str, BytePairs] = {}


def byte_pairs(path: str) -> BytePairs:
    """One to a worker."""
    if path not in _PAIRS:
        _PAIRS[path] = BytePairs(path)
    return _PAIRS[path]


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, ids (little-endian uint32), offsets (of each id in the text's UTF-8).

    Null text counts as empty: no ids. Null doc_id stays null; equal rows give equal rows; other columns
    are ignored; an empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks_path)
        for batch in slices(batches, 256):
            ids, n, offsets = pairs.encode(texts_of(batch))
            ends = np.cumsum(n)
            cut = lambda x: pa.array([x[e - k : e].tobytes() for e, k in zip(ends, n)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), cut(ids), cut(offsets.astype("<u4"))], ["doc_id", "ids", "offsets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary, offsets binary")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """encoded(doc_id, ids) -> doc_id, decoded (bytes)."""

    def run(batches):
        pairs = byte_pairs(ranks_path)
        for batch in slices(batches, 256):
            texts = [pairs.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip_digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Encode, then decode the ids: doc_id, n_tokens, sha256 of the ids and of the decoded bytes. Cases as in encode_documents."""

    def run(batches):
        pairs = byte_pairs(ranks_path)
        for batch in slices(batches, 256):
            ids, n, _ = pairs.encode(texts_of(batch))
            parts = np.split(ids, np.cumsum(n)[:-1]) if len(n) else []
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([sha(x.tobytes()) for x in parts], pa.string()), pa.array([sha(pairs.decode(x)) for x in parts], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, DIGESTS)


def encode_checked(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Encode and decode: doc_id, n_tokens, ids (little-endian uint32), round_trip (whether decoding gives the text back)."""

    def run(batches):
        pairs = byte_pairs(ranks_path)
        for batch in slices(batches, 256):
            texts = texts_of(batch)
            ids, n, _ = pairs.encode(texts)
            parts = np.split(ids, np.cumsum(n)[:-1]) if len(n) else []
            same = [pairs.decode(x) == t for x, t in zip(parts, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in parts], pa.binary()), pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, round_trip boolean")
