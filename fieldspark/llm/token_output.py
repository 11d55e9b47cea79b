"""Token-ID / binary output: ids in context-mixed, range-coded, checksummed blocks.

File format: a folder of Parquet files, written and read by Spark, so any store that Spark reaches
will do. One row is a *segment* of whole documents in ascending doc_id order:

  part, segment        place in the order (part = range partition)
  n_docs, n_tokens     sizes
  doc_ids, doc_tokens  little-endian int64 ids (null ids: flagged in doc_null) and lengths
  block_len            ids in each block but the last
  block_bytes          little-endian uint32, bytes of each block
  block_crc            little-endian uint32, crc32 of each block's ids as little-endian uint32
  payload              the blocks' codes, one after another
  base_ids, base_freq  little-endian uint16 and uint32: the segment's ids and their frequencies

Every block starts from the segment's frequencies and empty tables, so blocks decode alone and a
damaged one is found by its crc. A segment's blocks are coded side by side, one block to a lane of
the numpy arrays.

The model of a block, per id: an order-2 table (hash of the last two ids) and an order-1 table (last
id) each predict one id and know how often they were right lately. Both confidences together choose
two adaptive probabilities, which mix the predictions into one interval: order-2 hit, order-1 hit,
or neither. In the last case the order-0 frequencies code the id; they are the segment's, so a block
need not learn them and no id is unknown. Ids are below 65536; a larger one is an error.
All model arithmetic is on integers, so every machine decodes alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.token_counts import PIECES, byte_letters
from fieldspark.llm.words import ragged, slices
from fieldspark.session import materialize

END_ID = 2
SLOTS = 1 << 10  # entries of a prediction table
FLAG_BITS, BITS = 12, 18  # of the hits' shares and of the order-0 frequencies' sum: 32 together at most
LANES, LEAST_BLOCK, SEGMENT_IDS = 2048, 2048, 1 << 22
IDS = 1 << 16  # ids are below

SEGMENT_SCHEMA = (
    "part int, segment int, n_docs long, n_tokens long, doc_ids binary, doc_null binary, doc_tokens binary, "
    "block_len long, block_bytes binary, block_crc binary, base_ids binary, base_freq binary, payload binary"
)
DOC_SCHEMA = "part int, segment int, position long, doc_id long, before long, n_tokens long, ids_crc32 long"


def base_frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids there are, their frequencies of 2**BITS): at least 1 each."""
    counts = np.bincount(ids)
    known = np.flatnonzero(counts)
    room = (1 << BITS) - len(known)
    freq = 1 + counts[known] * room // len(ids)
    freq[counts[known].argmax()] += (1 << BITS) - freq.sum()
    return known.astype("<u2"), freq.astype("<u4")


class _Model:
    """Predictions of `lanes` blocks, kept in step. Arrays hold order 1 and order 2 one after the other, so one call serves both."""

    def __init__(self, lanes: int, known: np.ndarray, freq: np.ndarray):
        self.lanes = lanes
        self.tables = np.zeros(2 * lanes * SLOTS, np.uint32)  # an entry: predicted id and two bits of confidence
        # entries of one slot stand together, as do the probabilities of one pair: common contexts are common in all lanes
        self.base = np.arange(2 * lanes, dtype=np.int64)
        # two probabilities of 16 bits for each pair of confidences: order-2 right; else order-1 right
        start = np.array([[[2000 + 15000 * (k >> 2)], [2000 + 12000 * (k & 3)]] for k in range(16)], np.int32)
        self.right = np.repeat(start, lanes, axis=2).ravel()
        self.last, self.last2 = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        self.m = np.empty(2 * lanes, np.int64)
        self.known, self.freq = known.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.r_[0, np.cumsum(freq, dtype=np.uint64)].astype(np.uint64)
        self.place = np.zeros(IDS, np.uint16)
        self.place[known] = np.arange(len(known))

    def slots(self, last: np.ndarray, last2: np.ndarray) -> np.ndarray:
        """Entries' places after these last ids (lanes, or steps x lanes), order 1 and order 2 side by side."""
        n, a = self.lanes, last * np.uint32(40503)
        out = np.empty((*last.shape[:-1], 2 * n), np.int64)
        out[..., :n] = a >> np.uint32(17)
        out[..., n:] = (a + last2 * np.uint32(60493)) >> np.uint32(18)
        out &= SLOTS - 1
        out *= 2 * n
        out += self.base
        return out

    def predict(self, at: np.ndarray | None = None):
        """at: slots of the last ids, if known already."""
        n = self.lanes
        self.at = self.slots(self.last, self.last2) if at is None else at
        self.entry = self.tables.take(self.at)
        self.guess, self.sure = self.entry >> np.uint32(2), self.entry & np.uint32(3)
        self.id1, self.id2 = self.guess[:n], self.guess[n:]
        pair = self.sure[n:] << np.uint32(2)
        pair |= self.sure[:n]
        np.multiply(pair, 2 * n, out=self.m[:n])
        self.m[n:] = self.m[:n]
        self.m += self.base
        self.q = self.right.take(self.m)
        share = self.q >> (16 - FLAG_BITS)
        self.w2 = share[:n]
        self.w1 = ((1 << FLAG_BITS) - 2) - self.w2
        self.w1 *= share[n:]
        self.w1 >>= FLAG_BITS
        self.w1 += 1  # so that neither has a share too

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray):
        """ids: uint32."""
        n = self.lanes
        step = np.concatenate((hit2, hit1)) * np.int32(64000)
        step += 512
        step -= self.q
        step >>= 5
        step[n:] *= ~hit2
        step += self.q
        self.right[self.m] = step
        both = np.concatenate((ids, ids))
        right = self.guess == both
        both <<= np.uint32(2)
        fresh = self.entry - np.uint32(2)
        np.copyto(fresh, both, where=self.sure < 2)
        self.entry += self.sure < 3
        np.copyto(fresh, self.entry, where=right)
        self.tables[self.at] = fresh
        self.last2, self.last = self.last, ids

    def by_slot(self) -> np.ndarray:
        """The place of the id at each place of 2**BITS."""
        return np.repeat(np.arange(len(self.known), dtype=np.uint16), self.freq.astype(np.int64))


_LOW32, _U32, _UBITS, _UBOTH = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(BITS), np.uint64(FLAG_BITS + BITS)
_SLAB = 32  # steps whose slots are found in one go


class _Range:
    """Carry-less range coder of 64 bits with words of 32, one to a lane.

    A step narrows each range by FLAG_BITS + BITS bits at most, then words go out where the range is
    within 32 bits; one that straddles two words is cut to the first.
    """

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)

    def narrow(self, r: np.ndarray, flag: np.ndarray, width: np.ndarray, start: np.ndarray, size: np.ndarray):
        """To the id's part (start, size of 2**BITS) of what was seen (flag >> BITS, width of 2**FLAG_BITS); r: range >> FLAG_BITS + BITS."""
        at = start * width
        at += flag
        at *= r
        self.low += at
        width *= size
        np.multiply(width, r, out=self.range)

    def full(self):
        """(lanes whose word is due, those words)."""
        go = (self.range <= _LOW32).nonzero()[0]
        low, width = self.low[go], self.range[go]
        width = np.where(low ^ (low + width) <= _LOW32, width, (~low + np.uint64(1)) & _LOW32)
        self.low[go] = low << _U32
        self.range[go] = width << _U32
        return go, low >> _U32


def _split(model: _Model, hit2: np.ndarray, hit1: np.ndarray, miss: np.ndarray, upto: np.ndarray):
    """(start, size) of 2**FLAG_BITS of what each lane saw; upto: what the hits have."""
    flag = model.w2 * hit1
    np.copyto(flag, upto, where=miss)
    width = (1 << FLAG_BITS) - upto
    np.copyto(width, model.w2, where=hit2)
    np.copyto(width, model.w1, where=hit1)
    return flag, width


def encode_blocks(ids: np.ndarray, lanes: int, base: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[int, list[bytes], np.ndarray]:
    """Code ids in `lanes` blocks; (block length, codes, crc32 of each block). base: base_frequencies(ids)."""
    n = -(-len(ids) // lanes)
    lanes = -(-len(ids) // n)
    known, freq = base or base_frequencies(ids)
    grid = np.full(lanes * n, known[0], np.uint32)
    grid[: len(ids)] = ids
    model, coder = _Model(lanes, known, freq), _Range(lanes)
    grid = np.ascontiguousarray(grid.reshape(lanes, n).T)
    # lanes side by side, as they fill up alike
    out, filled = np.zeros((n + 3, lanes), "<u4"), np.zeros(lanes, np.int64)
    before = np.zeros((n + 2, lanes), np.uint32)
    before[2:] = grid
    whole = np.uint64(1 << BITS)
    for step in range(n):
        now = grid[step]
        if step % _SLAB == 0:
            slots = model.slots(before[step + 1 : step + 1 + _SLAB][: n - step], before[step : step + _SLAB][: n - step])
            places = model.place[grid[step : step + _SLAB]]
            starts, sizes = model.start.take(places), model.freq.take(places)
        model.predict(slots[step % _SLAB])
        hit2 = now == model.id2
        hit1 = now == model.id1
        hit1 &= ~hit2
        hit = hit2 | hit1
        miss = ~hit
        start, size = starts[step % _SLAB], sizes[step % _SLAB]
        start *= miss
        np.copyto(size, whole, where=hit)
        flag, width = (x.astype(np.uint64) for x in _split(model, hit2, hit1, miss, model.w2 + model.w1))
        coder.narrow(coder.range >> _UBOTH, flag << _UBITS, width, start, size)
        go, words = coder.full()
        at = filled[go]
        out[at, go] = words
        filled[go] = at + 1
        model.learn(now, hit2, hit1)
    for k in (_U32, np.uint64(0)):
        out[filled, np.arange(lanes)] = coder.low >> k & _LOW32
        filled += 1
    out = np.ascontiguousarray(out[: filled.max()].T)
    codes = [out[i, : filled[i]].tobytes() for i in range(lanes)]
    data = ids.astype("<u4")
    crc = np.array([zlib.crc32(data[i * n : (i + 1) * n]) for i in range(lanes)], "<u4")
    return n, codes, crc


def decode_blocks(n_ids: int, block_len: int, sizes: np.ndarray, crc: np.ndarray, payload: bytes, base: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of all blocks; a block whose crc32 differs raises ValueError."""
    lanes = len(sizes)
    words = np.frombuffer(payload + b"\0" * 16, "<u4")
    first = np.r_[0, np.cumsum(sizes // 4)][:-1].astype(np.int64)
    at = first + 2
    model, coder = _Model(lanes, *base), _Range(lanes)
    by_slot = model.by_slot()
    code = words.take(first, mode="clip").astype(np.uint64) << _U32 | words.take(first + 1, mode="clip").astype(np.uint64)
    out = np.empty((block_len, lanes + 32), np.uint16)[:, :lanes]  # columns of 2**k bytes a row would share few cache lines
    whole = np.uint64(1 << BITS)
    for step in range(block_len):
        model.predict()
        r = coder.range >> _UBOTH
        value = code - coder.low
        value //= r
        np.minimum(value, np.uint64((1 << FLAG_BITS + BITS) - 1), out=value)
        flags = (value >> _UBITS).astype(np.int32)
        upto = model.w2 + model.w1
        hit2, miss = flags < model.w2, flags >= upto
        hit1 = ~(hit2 | miss)
        flag, width = (x.astype(np.uint64) for x in _split(model, hit2, hit1, miss, upto))
        flag <<= _UBITS
        value -= flag
        value //= width
        place = by_slot.take(value.view(np.int64))
        start, size, now = model.start.take(place), model.freq.take(place), model.known.take(place)
        start *= miss
        np.copyto(size, whole, where=~miss)
        np.copyto(now, model.id2, where=hit2)
        np.copyto(now, model.id1, where=hit1)
        coder.narrow(r, flag, width, start, size)
        go, _ = coder.full()
        code[go] = code[go] << _U32 | words.take(at[go], mode="clip").astype(np.uint64)
        at[go] += 1
        out[step] = now
        model.learn(now, hit2, hit1)
    ids = out.T.ravel()[:n_ids].astype("<u4")
    for i in range(lanes):
        if zlib.crc32(ids[i * block_len : (i + 1) * block_len]) != crc[i]:
            raise ValueError(f"block {i} is damaged: its checksum differs")
    return ids


_SPACED = regex.compile(" |" + PIECES.pattern)
_LATIN_END = "\u0250"
_CHUNK = 4096  # runs or pieces that go to the library in one call


class WordIds:
    """Ids of texts by the tokenizers library, each distinct piece of a word encoded once.

    The tokenizer drops white space and merges nothing across it, so a text's ids are those of its
    runs. Text is cut at space and \\x09-\\x0D; other white space is left to the normaliser. A run is
    normalised and cut into pieces as the library does it, and the library's model merges each distinct
    piece, many in one call: pieces end with a token that carries the suffix of a word's end.
    """

    def __init__(self, path: str, most: int = 700_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library, self.most = Tokenizer.from_file(path), most
        self.special_bytes = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.letters = str.maketrans(dict(enumerate(byte_letters())) | {10: "\n", 32: " "})
        self.library.model._resize_cache(0)  # pieces come once
        self.merger = Tokenizer(self.library.model)  # of pieces that are normalised, cut and in byte letters already
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        suffix = self.library.model.end_of_word_suffix
        self.is_last = np.zeros(self.library.get_vocab_size(), bool)
        self.is_last[[i for t, i in self.library.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.clear()
        self.clear_pieces()

    def clear(self):
        self.known: dict[bytes, int] = {}
        self.runs_ids = _Lists()

    def clear_pieces(self):
        self.pieces: dict[str, int] = {" ": 0}
        self.piece_ids = _Lists()
        self.piece_ids.add(np.zeros(0, np.int64), np.zeros(1, np.int64))

    def _whole(self, run: bytes) -> list[int]:
        return self.library.encode(run.decode("utf-8"), add_special_tokens=False).ids

    def _cut(self, runs: list[bytes]) -> list[str] | None:
        """Pieces of runs without special strings, in byte letters, with " " between runs; None if white space within runs blurs that."""
        text = b" ".join(runs).decode("utf-8")
        if text.isascii():  # the normaliser only lower-cases it
            items = _SPACED.findall(text.lower())
            return items if text.isprintable() else self._in_letters(items)
        if len(text.split()) != len(runs):
            return None
        text = self.library.normalizer.normalize_str(text)
        if max(text) < _LATIN_END:  # all know these as letters, digits or others
            items = _SPACED.findall(text)
            return self._in_letters(items) if items.count(" ") == len(runs) - 1 else None
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32)
        found = self.library.pre_tokenizer.pre_tokenize_str(text)
        if len(spaces) != len(runs) - 1:
            return None
        items = np.empty(len(found) + len(spaces), object)
        at = np.searchsorted(np.fromiter((span[0] for _, span in found), np.int64, len(found)), spaces) + np.arange(len(spaces))
        is_piece = np.ones(len(items), bool)
        is_piece[at] = False
        items[at] = " "
        items[is_piece] = [piece for piece, _ in found]
        return items.tolist()

    def _in_letters(self, items: list[str]) -> list[str]:
        """Byte letters; no piece has a line feed."""
        return "\n".join(items).encode("utf-8").decode("latin-1").translate(self.letters).split("\n")

    def _merge(self, pieces: list[str]):
        """Ids of new pieces into the store."""
        for i in range(0, len(pieces), _CHUNK):
            some = pieces[i : i + _CHUNK]
            ids = np.array(self.merger.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self.is_last[ids]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):  # no suffix tells where pieces end
                each = [[t.id for t in self.merger.model.tokenize(x)] for x in some]
                ids, ends = np.array([k for x in each for k in x], np.int64), np.cumsum([len(x) for x in each])
            first = self.piece_ids.add(ids, np.diff(ends, prepend=0))
            self.pieces.update(zip(some, range(first, first + len(some))))

    def _ids(self, runs: list[bytes]) -> list[list[int]]:
        items = self._cut(runs)
        if items is None:
            return [self._whole(r) for r in runs]
        which = np.fromiter(map(self.pieces.get, items, repeat(-1)), np.int64, len(items))
        new = np.flatnonzero(which < 0).tolist()
        if new:
            self._merge(list(dict.fromkeys(items[k] for k in new)))
            which[new] = [self.pieces[items[k]] for k in new]
        total, ids = np.r_[0, np.cumsum(self.piece_ids.n[which])], self.piece_ids.take(which).tolist()
        ends = [*total[np.flatnonzero(which == 0)].tolist(), len(ids)]
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _add(self, runs: list[bytes]) -> np.ndarray:
        """Places of new runs in the store. ASCII runs, others, and those with special strings or white space within go apart."""
        plain, others, odd = [], [], []
        for r in runs:
            (plain if r.isascii() else others).append(r)
        for some in (plain, others):
            joined = b" ".join(some)
            if any(mark in joined for mark in self.special_bytes):
                odd += [r for r in some if any(mark in r for mark in self.special_bytes)]
                some[:] = [r for r in some if not any(mark in r for mark in self.special_bytes)]
        if len(b" ".join(others).decode("utf-8").split()) != len(others):
            odd += [r for r in others if len(r.decode("utf-8").split()) != 1]
            others = [r for r in others if len(r.decode("utf-8").split()) == 1]
        latin, wide = [], []  # to U+023F, and beyond
        for r in others:
            (latin if max(r) <= 0xC8 else wide).append(r)
        chunks = [some[i : i + _CHUNK] for some in (plain, latin, wide) for i in range(0, len(some), _CHUNK)]
        for some, ids in chain(((c, self._ids(c)) for c in chunks), (([r], [self._whole(r)]) for r in odd)):
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            first = self.runs_ids.add(np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n)
            self.known.update(zip(some, range(first, first + len(some))))
        return np.fromiter(map(self.known.get, runs), np.int64, len(runs))

    def encode(self, texts: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if self.runs_ids.held > self.most:
            self.clear()
        if self.piece_ids.held > self.most:
            self.clear_pieces()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_binary())
        found = pc.ascii_split_whitespace(texts.cast(pa.large_string()))  # a text that begins or ends with white space has an empty run there
        n_runs = pc.list_value_length(found).to_numpy()
        coded = found.flatten().dictionary_encode()
        runs = coded.dictionary.cast(pa.large_binary()).to_pylist()
        which = np.fromiter(map(self.known.get, runs, repeat(-1)), np.int64, len(runs))
        new = np.flatnonzero(which < 0)
        if len(new):
            which[new] = self._add([runs[k] for k in new.tolist()])
        own, at = _Lists(), coded.indices.to_numpy()
        own.add(self.runs_ids.take(which), self.runs_ids.n[which])
        total, ends = np.r_[0, np.cumsum(own.n[at])], np.cumsum(n_runs)
        return own.take(at), total[ends] - total[ends - n_runs]


class _Lists:
    """Lists of ids, one after another in arrays that grow."""

    def __init__(self):
        self.flat, self.start, self.n = np.zeros(1 << 16, np.uint16), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = self.held = 0

    def add(self, ids: np.ndarray, n: np.ndarray) -> int:
        """The place of the first."""
        if len(ids) and ids.max() >= IDS:
            raise ValueError(f"id {ids.max()} does not fit: ids are below {IDS}")
        while self.used + len(ids) > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while self.held + len(n) > len(self.n):
            self.start, self.n = np.r_[self.start, np.zeros_like(self.start)], np.r_[self.n, np.zeros_like(self.n)]
        first, end = self.held, self.held + len(n)
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[first:end] = self.used + np.cumsum(n) - n
        self.n[first:end] = n
        self.held, self.used = end, self.used + len(ids)
        return first

    def take(self, which: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.start[which], self.n[which])]


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One to a worker: kept between tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def _segment(part: int, number: int, doc_ids: list, tokens: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint16)
    lanes = max(1, min(LANES, len(flat) // LEAST_BLOCK))
    base = base_frequencies(flat) if len(flat) else (np.zeros(0, "<u2"), np.zeros(0, "<u4"))
    block_len, codes, crc = encode_blocks(flat, lanes, base) if len(flat) else (0, [], np.zeros(0, "<u4"))
    null = np.array([d is None for d in doc_ids], np.uint8)
    row = {
        "part": part,
        "segment": number,
        "n_docs": len(doc_ids),
        "n_tokens": len(flat),
        "doc_ids": np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        "doc_null": np.packbits(null).tobytes(),
        "doc_tokens": np.array(tokens, "<i8").tobytes(),
        "block_len": block_len,
        "block_bytes": np.array([len(c) for c in codes], "<u4").tobytes(),
        "block_crc": crc.tobytes(),
        "base_ids": base[0].tobytes(),
        "base_freq": base[1].tobytes(),
        "payload": b"".join(codes),
    }
    types = {"part": pa.int32(), "segment": pa.int32(), "n_docs": pa.int64(), "n_tokens": pa.int64(), "block_len": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([v], types.get(k, pa.binary())) for k, v in row.items()], list(row))


def _write_part(path: str, end_id: int):
    if not 0 <= end_id < IDS:
        raise ValueError(f"id {end_id} does not fit: ids are below {IDS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        coder = word_ids(path)
        doc_ids, tokens, ids, held = [], [], [], 0
        for batch in slices(batches, 4096, 3 << 20):
            found, n = coder.encode(pc.fill_null(batch.column(1), ""))
            ends = np.cumsum(n)
            ids.append(np.insert(found, ends, end_id))
            doc_ids += batch.column(0).to_pylist()
            tokens += (n + 1).tolist()
            held += len(ids[-1])
            if held >= SEGMENT_IDS:
                yield _segment(part, number, doc_ids, tokens, ids)
                number += 1
                doc_ids, tokens, ids, held = [], [], [], 0
        if doc_ids:
            yield _segment(part, number, doc_ids, tokens, ids)

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, partitions: int | None = None) -> DataFrame:
    """Encode docs(doc_id, text) and write segments in ascending doc_id order; returns the files as a DataFrame.

    Null texts are empty (only the end id); a null doc_id sorts first; rows with equal doc_id are
    ordered by a hash of their text. Other columns are ignored. An empty table gives no segment.
    The range partitions bound a task's rows; memory is bound by SEGMENT_IDS ids (or one document).
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    return materialize(ordered.mapInArrow(_write_part(tokenizer_path, end_id), SEGMENT_SCHEMA), "token-files")


def segment_ids(row: dict) -> np.ndarray:
    """Ids of one segment, as little-endian uint32."""
    sizes = np.frombuffer(row["block_bytes"], "<u4").astype(np.int64)
    if not len(sizes):
        return np.zeros(0, "<u4")
    return decode_blocks(row["n_tokens"], row["block_len"], sizes, np.frombuffer(row["block_crc"], "<u4"), row["payload"], (np.frombuffer(row["base_ids"], "<u2"), np.frombuffer(row["base_freq"], "<u4")))


def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
            ids = memoryview(segment_ids(row)).cast("B")
            n = np.frombuffer(row["doc_tokens"], "<i8")
            ends = np.cumsum(n)
            null = np.unpackbits(np.frombuffer(row["doc_null"], np.uint8))[: len(n)].astype(bool)
            crc = [zlib.crc32(ids[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), row["part"], np.int32)),
                    pa.array(np.full(len(n), row["segment"], np.int32)),
                    pa.array(np.arange(len(n))),
                    pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null),
                    pa.array(ends - n),
                    pa.array(n),
                    pa.array(crc, pa.int64()),
                ],
                ["part", "segment", "position", "doc_id", "before", "n_tokens", "ids_crc32"],
            )


def read_token_files(files: DataFrame) -> DataFrame:
    """Decode token files: per document doc_id, start (ids before it in all files), n_tokens, ids_crc32.

    The running total is taken over segments (some 4 M ids each): within a part by a window on the
    part, across parts by one over the parts' sums, whose number is that of the range partitions.
    """
    from pyspark.sql import Window

    sums = files.select("part", "segment", "n_tokens")
    parts = sums.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    up_to = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select("part", (F.sum("n").over(up_to) - F.col("n")).alias("part_start"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sums.select("part", "segment", (F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("segment_start"))
    starts = starts.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("segment_start")).alias("base"))
    docs = files.mapInArrow(_read_docs, DOC_SCHEMA)
    return docs.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
