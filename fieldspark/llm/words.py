"""Words as every operator here counts them, and their hashes, on arrays of bytes.

A word is a run of bytes other than space and \\x09-\\x0D. The hash of a word (or of any slice) is a
polynomial of random 64-bit letters modulo 2**64, mixed at the end; it is taken from running sums, so
all words of a batch of texts are hashed at once. It does not depend on the process or machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words for Spark's and DuckDB's regular expressions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

IS_WHITE = np.zeros(256, bool)
IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_RANDOM = np.random.Generator(np.random.PCG64(20240117))
LETTER_HASH = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def column_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A column, or a field of a struct column by its path a.b."""
    name, _, rest = column.partition(".")
    found = batch.column(batch.schema.get_field_index(name))
    return pc.struct_field(found, rest) if rest else found


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column_of(batch, column).cast(pa.large_binary()).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every slice, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, most_bytes: int = 1 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Smaller batches: at most so many rows and bytes of text, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(column_of(batch, column)), 0).to_numpy(zero_copy_only=False)
        total, i = np.cumsum(sizes, dtype=np.int64), 0
        while i < len(sizes):
            done = int(total[i - 1]) if i else 0
            end = min(i + rows, max(i + 1, int(np.searchsorted(total, done + most_bytes, side="right"))))
            yield batch.slice(i, end - i)
            i = end


@dataclass
class Words:
    """Words of several texts. starts, ends: bytes in raw; first: each text's first word, and their number last."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    text_at: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Texts stand one after another in raw, a line feed after each."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        raw = TO_LOWER[raw]
    white = IS_WHITE[raw]
    edge = np.flatnonzero(np.diff(white, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    text_at = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)]
    return Words(raw, starts, ends, np.searchsorted(starts, text_at), text_at)


def running_hash(raw: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(raw))
    out = np.empty(len(raw) + 1, np.uint64)
    out[0] = 0
    np.cumsum(LETTER_HASH[raw] * up, out=out[1:])
    return out


def slice_hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of raw[start:end] for each slice, from running_hash(raw)."""
    _, down = _powers(len(running))
    return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    return slice_hashes(running_hash(words.raw), words.starts, words.ends)


def window_hashes(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of all windows of `width` words that lie in one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = mix(h + hashes[k : k + n])
    text = words.text_of_word()
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    return h[at], at
