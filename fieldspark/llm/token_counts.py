"""Token counts: a prefix dynamic programme over byte-pair tokens.

A split of a word into tokens is its encoding exactly if every two neighbours would also be encoded
as these two. So the last token of a prefix's encoding decides how it can go on: for each prefix the
programme finds the one last token that fits the encoding of what is before it, and keeps the count,
once for prefixes that end the word (the last token carries the end mark) and once for those that go
on. The counts at all prefixes of a run of text between spaces are stored, a byte a prefix; a text's
count, its cut at a budget and the count of any of its beginnings are look-ups in them and a running
sum, without encoding again.

The programme works on text as the tokenizer normalises it (NFC, lower case); stored counts are those
of the bytes as they stand.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fieldspark.llm.words import slices, texts_of

LIMIT = 2048
END = "</w>"
HEAD = 5
#: Marks and jamo, which may compose with what is before them.
JOINED = regex.compile(r"[\p{M}\u1160-\u11ff]")
#: In place of a count: no beginning ends here.
INSIDE = (1 << 31) - 1
#: Fixed value: the tokenizer's own pattern for words.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable ones stand for themselves, others follow from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else spare))
        spare += b not in plain
    return letters


class PrefixCounter:
    """Exact counts for a tokenizers .json of kind BPE with end-of-word marks."""

    def __init__(self, path: str, most: int = 900_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {tuple(m): i for i, m in enumerate(pairs)}
        self.made = {x + y: (i, x, y) for (x, y), i in self.rank.items()}
        self.in_order = len(self.made) == len(self.rank) and all(
            self.made.get(part, (-1,))[0] < i for i, *parts in self.made.values() for part in parts
        )
        self.alone: dict[str, bool] = {}
        self.heads: dict[str, tuple[tuple, tuple, tuple]] = {}
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.letters = byte_letters()
        self.kind: dict[str, int] = {}  # 1: goes on, 2: ends a word, 3: both
        for t in self.vocab:
            piece = t.removesuffix(END)
            self.kind[piece] = self.kind.get(piece, 0) | (1 if piece == t else 2)
        self.longest = max(map(len, self.kind))
        self.most = most
        self.fits: dict[tuple[str, str], bool] = {}
        self.fits_end: dict[tuple[str, str], bool] = {}
        self.arrays: dict[bytes, bytes | np.ndarray] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain merging, for single tokens and pairs only."""
        symbols = list(symbols)
        while len(symbols) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            symbols[i : i + 2] = ["".join(symbols[i : i + 2])]
        return symbols

    def encodes(self, left: str, right: str) -> bool:
        """Whether the letters of two tokens (left may be empty) are encoded as these two.

        Both are undone step by step, the later step first; where symbols that meet at the border would
        have merged before the next step, they are not. This needs merges that make each token in one
        way and after its parts, as training gives them; else all is merged.
        """
        alone = self.alone.get(right)
        if alone is None:
            alone = self.alone[right] = self.merge(symbols_of(right)) == [right]
        if not left or not alone:
            return alone
        if not self.in_order:
            return self.merge([*symbols_of(left), *symbols_of(right)]) == [left, right]
        rank, made, never = self.rank.get, self.made.get, (-1, "", "")
        until_left = until_right = 1 << 60
        while True:
            r = rank((left, right))
            if r is not None and r < until_left and r <= until_right:
                return False
            m_left, m_right = made(left, never), made(right, never)
            if m_left[0] > m_right[0]:
                until_left, left = m_left[0], m_left[2]
            elif m_right[0] >= 0:
                until_right, right = m_right[0], m_right[1]
            else:
                return True

    def fit(self, left: str, right: str) -> bool:
        """Whether left then right (left may be empty) is an encoding, right not ending the word."""
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        known = self.fits[left, right] = self.encodes(left, right)
        return known

    def fit_end(self, left: str, right: str) -> bool:
        """The same for a right that ends the word."""
        if len(self.fits_end) > 1_000_000:
            self.fits_end.clear()
        known = self.fits_end[left, right] = self.encodes(left, right + END)
        return known

    def word(self, letters: str) -> list[int]:
        """Counts of the first 1, 2, ... letters as whole words. Words with the same first letters share their programme."""
        state = ("",), (0,), ()
        if len(letters) > HEAD:
            head = letters[:HEAD]
            state = self.heads.get(head)
            if state is None:
                own = [""], [0], []
                self.programme(head, *own, True)
                if len(self.heads) > 100_000:
                    self.heads.clear()
                state = self.heads[head] = tuple(map(tuple, own))
        last, counts, ended = map(list, state)
        self.programme(letters, last, counts, ended, False)
        return ended

    def programme(self, letters: str, last: list, counts: list, ended: list, more: bool) -> None:
        """Goes on to all letters: last token and count of each prefix, and the count if it ends there; more: letters may follow."""
        kind, fits, fits_end, longest, n = self.kind.get, self.fits.get, self.fits_end.get, self.longest, len(letters)
        for i in range(len(last), n + 1):
            end, go = None, None if i < n or more else ""
            for j in range(i - longest if i > longest else 0, i):
                piece = letters[j:i]
                as_part = kind(piece)
                if as_part:
                    before = last[j]
                    if before is not None:
                        if as_part & 2 and end is None:
                            ok = fits_end((before, piece))
                            if self.fit_end(before, piece) if ok is None else ok:
                                end = counts[j] + 1
                                if go is not None:
                                    break
                        if as_part & 1 and go is None:
                            ok = fits((before, piece))
                            if self.fit(before, piece) if ok is None else ok:
                                go, n_go = piece, counts[j] + 1
                                if end is not None:
                                    break
            ended.append(end)
            last.append(go)  # None: no encoding ends here without the end mark
            counts.append(n_go if go else 0)

    def _letters(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece
        return "".join(map(self.letters.__getitem__, piece.encode("utf-8")))

    def prefixes(self, text: str) -> list[int]:
        """Counts of the first 0, 1, 2, ... characters of the normalised text; special strings stay one step."""
        out = [0]
        parts = self.special.splititer(text) if self.special else [text]
        n_special = len(self.special.findall(text)) if self.special else 0
        for k, part in enumerate(parts):
            out += self._plain_prefixes(part, out[-1])
            if k < n_special:
                out.append(out[-1] + 1)
        return out

    def _plain_prefixes(self, text: str, base: int) -> list[int]:
        text = normalise(text)
        out, at = [], 0
        for m in PIECES.finditer(text):
            out += [base] * (m.start() - at)
            piece = m[0]
            if piece.isascii() and piece.isalpha():
                steps = self.array(piece.encode())[1:]
            elif piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # shortened, it is a quote and letters
                quote = self.word("'")[-1]
                steps = [quote] + [quote + self.word(piece[1:k])[-1] for k in range(2, len(piece))] + [self.word(piece)[-1]]
            else:
                by_byte = self.word(self._letters(piece))
                steps = by_byte if piece.isascii() else [by_byte[e - 1] for e in ends_of(piece)]
            out += [base + s for s in steps] if base else steps
            base += steps[-1]
            at = m.end()
        return out + [base] * (len(text) - at)

    def by_byte(self, text: str) -> list[int]:
        """Counts of the first 0, 1, 2, ... bytes of the text as it stands; INSIDE where a letter or a special string would be cut."""
        plain = not any(x in text for x in self.specials)
        counts = [0, *self._plain_prefixes(text, 0)] if plain else self.prefixes(text)
        if plain and text.isascii():
            return counts
        if plain and len(counts) == len(text) + 1 and not JOINED.search(text):  # each letter stays one
            out = [INSIDE] * (len(text.encode()) + 1)
            out[0] = 0
            for e, n in zip(ends_of(text), counts[1:]):
                out[e] = n
            return out
        out, at = [0], 0
        special = self.special.findall(text) if self.special else []
        for k, part in enumerate(self.special.splititer(text) if self.special else [text]):
            starts = [i for i, c in enumerate(part) if i == 0 or not JOINED.match(c)]
            steps = [(len(normalise(part[i:j])), part[i:j]) for i, j in zip(starts, [*starts[1:], len(part)])]
            for n, piece in [*steps, *((1, x) for x in special[k : k + 1])]:
                at += n
                out += [INSIDE] * (len(piece.encode("utf-8")) - 1)
                out.append(counts[at])
        return out

    def array(self, run: bytes) -> bytes | np.ndarray:
        """Counts at the first 0, 1, 2, ... bytes of a run of text between spaces, stored for the next time.

        One byte a count in short runs, where the greatest byte stands for INSIDE.
        """
        found = self.arrays.get(run)
        if found is None:
            ascii_run = run.isascii()
            low = run.lower() if ascii_run and run.isalpha() else run
            if low != run:
                found = self.array(low)
            else:
                counts = [0, *self.word(run.decode())] if ascii_run and run.isalpha() else self.by_byte(run.decode("utf-8"))
                whole = ascii_run and INSIDE not in counts
                if len(run) < 80 and (whole or max(c for c in counts if c != INSIDE) < 255):
                    found = bytes(counts) if whole else bytes([255 if c == INSIDE else c for c in counts])
                else:
                    found = np.array(counts, np.int32)
            if len(run) < 80:
                if len(self.arrays) > self.most:
                    self.arrays.clear()
                self.arrays[run] = found
        return found

    def text(self, text: bytes, limit: int | None = None, at: Sequence[int] = ()) -> tuple[int, int, list[int]]:
        """(tokens of the whole text, bytes of the longest beginning within limit tokens, tokens of the first so many bytes).

        All three are looked up in the stored counts of the runs. A beginning that would cut a letter (with
        the marks on it) or a special string ends before it.
        """
        known, slow = self.arrays.get, self.array
        runs = text.replace(b"\n", b" ").replace(b"\t", b" ").split(b" ")
        arrays = [slow(r) if a is None else a for r, a in zip(runs, map(known, runs))]
        totals = [int(a[-1]) for a in arrays]
        total = sum(totals)
        over = limit is not None and total > limit
        inner = [n for n in at if n < len(text)]
        if not over and not inner:
            return total, len(text), [total] * len(at)
        sums = np.cumsum([0, *totals])
        starts = np.cumsum([0, *(len(r) + 1 for r in runs)])
        fit = len(text)
        if over:
            k = int(np.searchsorted(sums[1:], limit, side="right"))
            inside = int(np.flatnonzero(as_counts(arrays[k]) <= limit - sums[k])[-1])
            fit = int(starts[k]) + inside if inside or not k else int(starts[k]) - 1
        tokens = []
        for n in at:
            if n >= len(text):
                tokens.append(total)
            else:
                k = int(np.searchsorted(starts, n, side="right")) - 1
                counts = as_counts(arrays[k])[: n - int(starts[k]) + 1]
                tokens.append(int(sums[k] + counts[np.flatnonzero(counts != INSIDE)[-1]]))
        return total, fit, tokens


def as_counts(stored: bytes | np.ndarray) -> np.ndarray:
    """A run's stored counts as numbers."""
    if isinstance(stored, np.ndarray):
        return stored
    counts = np.frombuffer(stored, np.uint8).astype(np.int32)
    counts[counts == 255] = INSIDE
    return counts


def ends_of(text: str) -> list[int]:
    """Where each letter ends in UTF-8."""
    return list(accumulate(1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4 for c in text))


def symbols_of(token: str) -> list[str]:
    """A token's letters, the last with the end mark if the token has it."""
    piece = token.removesuffix(END)
    return [*piece] if piece == token else [*piece[:-1], piece[-1] + END]


def normalise(text: str) -> str:
    """NFC, then lower case letter by letter (so no final sigma)."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


_COUNTERS: dict[str, PrefixCounter] = {}


def prefix_counter(path: str) -> PrefixCounter:
    """One to a worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long, tokens_at array<long>"
#: Lengths of beginnings whose tokens are given, in bytes.
AT_BYTES = (256, 1024, 4096, 16384)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, at_bytes: Sequence[int] = AT_BYTES) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes (UTF-8), n_tokens, over_limit, fit_bytes, tokens_at, one row per row.

    fit_bytes: where the text can be cut to stay within limit tokens, also inside a run without spaces.
    tokens_at: tokens of the text's first at_bytes bytes (fewer where a letter would be cut; of the whole
    text where it is shorter). All come from the stored counts of the runs' beginnings.
    Null text counts as empty (0, 0, false, 0, zeros); null doc_id stays null; equal rows give equal rows;
    other columns are ignored; an empty table gives no rows. No shuffle; memory is bound by the store of
    counts (emptied at `most` runs) and the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(tokenizer_path)
        for batch in slices(batches):
            texts = texts_of(batch)
            n, fit, at = zip(*(counter.text(t, limit, at_bytes) for t in texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                    pa.array(fit, pa.int64()),
                    pa.array(at, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes", "tokens_at"],
            )

    from pyspark.sql import functions as F

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def prefix_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, counts: tokens of the first 0, 1, 2, ... normalised characters."""

    def run(batches):
        counter = prefix_counter(tokenizer_path)
        for batch in slices(batches, 64):
            counts = [counter.prefixes(t.decode("utf-8")) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "counts"])

    from pyspark.sql import functions as F

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, counts array<int>")
