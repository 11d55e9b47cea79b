"""Quality rules: fixed base rules, then a calibrated classifier on hashed n-grams.

The classifier is a logistic regression over hashed word unigrams and bigrams (with one more for "same
word again") and character 4-grams (of code points), each kind as shares of the text. It is fitted on a bounded sample of
labelled rows, calibrated on a part of the sample kept apart, and scores texts in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.words import IS_WHITE, ragged, running_hash, slice_hashes, slices, texts_of, window_hashes, word_hashes, words_of

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 32_000_000  # of each label
KEEP_AT = 0.5  # least calibrated probability of good quality
BUCKETS = 1 << 15  # of each kind of feature
GRAM_HASH = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)  # any odd numbers
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def base_features(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text.

    Lines and windows are compared by 64-bit hashes within a text.
    """
    w = words_of(texts)
    n, at = len(texts), w.text_at[:-1]
    per_text = lambda mask: np.add.reduceat(mask.astype(np.int64), at) if n else np.zeros(0, np.int64)
    running = running_hash(w.raw)
    out = {"n_words": w.counts}
    out["word_chars"] = per_text(((w.raw & 0xC0) != 0x80) & ~IS_WHITE[w.raw])
    out["n_symbols"] = per_text(IS_SYMBOL[w.raw])
    line_end = np.flatnonzero(w.raw == 10)
    line_at = np.r_[0, line_end + 1][:-1]
    has_word = np.searchsorted(w.starts, line_end) > np.searchsorted(w.starts, line_at)
    line_at, line_end = line_at[has_word], line_end[has_word]
    lines = slice_hashes(running, line_at, line_end)
    text = np.searchsorted(w.text_at, line_at, side="right") - 1
    order = np.lexsort((line_at, lines, text))
    again = (np.diff(text[order]) == 0) & (np.diff(lines[order]) == 0)
    out["n_dup_lines"] = np.bincount(text[order][1:][again], minlength=n)
    windows, first = window_hashes(w, slice_hashes(running, w.starts, w.ends), WINDOW)
    of = w.text_of_word()
    order = np.lexsort((windows, of[first]))
    same = (np.diff(of[first][order]) == 0) & (np.diff(windows[order]) == 0)
    repeated = first[order[np.r_[same, False] | np.r_[False, same]]] if len(order) else first
    covered = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(covered, repeated, 1)
    np.add.at(covered, repeated + WINDOW, -1)
    covered = np.cumsum(covered)[:-1] > 0
    out["n_repeat_words"] = np.bincount(of[covered], minlength=n)
    return out


def base_failed(f: dict[str, np.ndarray]) -> np.ndarray:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def code_points(raw: np.ndarray, text_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of joined UTF-8 texts, where each text's begin, and their number last)."""
    if not len(raw) or raw.max() < 0x80:
        return raw.astype(np.uint32), text_at
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    points = raw[lead].astype(np.uint32)
    long = np.flatnonzero(points >= 0xC0)
    first, at = points[long], lead[long]
    more = np.uint32(1) + (first >= 0xE0) + (first >= 0xF0)  # bytes that follow
    first &= np.uint32(0x3F) >> more
    for k in (1, 2, 3):
        on = np.flatnonzero(more >= k)
        first[on] = first[on] << np.uint32(6) | (raw[np.minimum(at[on] + k, len(raw) - 1)] & 0x3F)
    points[long] = first
    return points, np.searchsorted(lead, text_at)


def hashed_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, share) of n-grams, not yet summed: three kinds of BUCKETS, shares of a kind sum to 1."""
    w = words_of(texts)
    words = word_hashes(w)
    of = w.text_of_word()
    pairs, first = window_hashes(w, words, 2)
    same = words[first] == words[first + 1] if len(first) else np.zeros(0, bool)
    pairs = np.where(same, np.uint64(0), pairs)
    letters, letter_at = code_points(w.raw, w.text_at)
    n = max(0, len(letters) - 3)
    grams = sum(letters[k : k + n] * GRAM_HASH[k] for k in range(4)) >> np.uint32(17)
    sizes = np.maximum(np.diff(letter_at) - 3, 0)  # none reaches into the next text
    grams, gram_text = grams[ragged(letter_at[:-1], sizes)], np.repeat(np.arange(len(texts)), sizes)
    kinds = [(of, (words & np.uint64(BUCKETS - 1)).astype(np.int64)), (of[first], (pairs & np.uint64(BUCKETS - 1)).astype(np.int64)), (gram_text, grams.astype(np.int64))]
    text = np.concatenate([t for t, _ in kinds])
    bucket = np.concatenate([b + k * BUCKETS for k, (_, b) in enumerate(kinds)])
    share = np.concatenate([1.0 / np.maximum(np.bincount(t, minlength=len(texts)), 1)[t] for t, _ in kinds])
    return text, bucket, share


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, texts: list[bytes]) -> np.ndarray:
        text, bucket, share = hashed_features(texts)
        return np.bincount(text, self.weights[bucket] * share, len(texts)) + self.bias

    def probability(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(texts) + self.offset, -40, 40)))


def _platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, by Newton steps with smoothed targets."""
    pos, neg = good.sum(), (1 - good).sum()
    target = np.where(good > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, a = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -40, 40)))
        g = x.T @ (p - target) + 1e-3 * a
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        a = a - np.clip(np.linalg.solve(h, g), -1, 1)
    return (float(a[0]), float(a[1])) if a[0] > 0 else (1.0, 0.0)


def fit_quality(texts: list[bytes], good: np.ndarray, steps: int = 150, rate: float = 0.5, l2: float = 1e-6) -> QualityModel:
    """Fit on 3 of 4 rows, calibrate on the fourth. With one label only, every text gets that label."""
    if not len(good) or good.min() == good.max():
        return QualityModel(np.zeros(3 * BUCKETS), 0.0, 1.0, 0.0 if not len(good) else (3.0 if good[0] else -3.0))
    apart = np.arange(len(texts)) % 4 == 3
    parts = []
    for i in range(0, len(texts), 200):
        text, bucket, share = hashed_features(texts[i : i + 200])
        key, inverse = np.unique(text * (3 * BUCKETS) + bucket, return_inverse=True)
        value = np.bincount(inverse, share).astype(np.float32)
        parts.append(((key // (3 * BUCKETS) + i).astype(np.int32), (key % (3 * BUCKETS)).astype(np.int32), value))
    row, col, value = (np.concatenate(x) for x in zip(*parts))
    del parts
    train = ~apart[row]
    r, c, v = row[train], col[train], value[train]
    size = np.where(good > 0, 0.5 / good.sum(), 0.5 / (1 - good).sum()) * ~apart
    size = size / size.sum()
    w, b, m1, m2 = np.zeros(3 * BUCKETS), 0.0, np.zeros(3 * BUCKETS), np.zeros(3 * BUCKETS)
    for t in range(1, steps + 1):
        z = np.bincount(r, w[c] * v, len(texts)) + b
        e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - good) * size
        g = np.bincount(c, e[r] * v, len(w)) + l2 * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w = w - rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-7)
        b -= e.sum()
    z = np.bincount(row, w[col] * value, len(texts)) + b
    slope, offset = _platt(z[apart], good[apart])
    return QualityModel(w.astype(np.float32), b, slope, offset)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, rows: int, allowed=None) -> tuple[list[bytes], np.ndarray]:
    """Up to `rows` texts and SAMPLE_BYTES bytes of each label (0, 1), the first in order of a hash of doc_id.

    Both bounds hold whatever the texts, so the sample may go to the driver. Bytes shorten the number of texts,
    never a text; one of over a hundredth of SAMPLE_BYTES is passed over.
    """
    labels = labels.select("doc_id", F.col(column).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    if allowed is not None:
        labels = labels.where(allowed)
    pick = None
    for label in (0, 1):
        part = labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        pick = part if pick is None else pick.unionByName(part)
    sizes = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("size")).join(F.broadcast(pick), "doc_id").groupBy("doc_id", "label").agg(F.max("size").alias("size"))
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")  # over `rows` rows of a label at most
    fits = sizes.where(F.col("size") <= SAMPLE_BYTES // 100).withColumn("so_far", F.sum("size").over(order)).where(F.col("so_far") <= SAMPLE_BYTES)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(fits.select("doc_id", "label")), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # one text of a doc_id, whatever its copies
    got = texts.select(F.xxhash64("doc_id").alias("h"), "doc_id", "label", F.encode("text", "UTF-8").alias("text")).collect()
    got.sort(key=lambda x: (x["h"], x["doc_id"], x["label"], bytes(x["text"])))
    return [bytes(x["text"]) for x in got], np.array([x["label"] for x in got], np.float64)


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality double, kept boolean"


def _score(model: QualityModel, keep_at: float, carry: list[str], column: str = "text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column=column):
            texts = texts_of(batch, column)
            f = base_features(texts)
            failed, p = base_failed(f), model.probability(texts)
            new = [pa.array(f[k], pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            new += [pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep_at))]
            old = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays(old + new, carry + [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def score_quality(docs: DataFrame, model: QualityModel, keep_at: float = KEEP_AT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, the base features, base_failed, quality (probability), kept; one row per row.

    Null and empty texts have no words and fail. Null doc_id stays null, equal rows give equal rows,
    other columns are ignored, an empty table gives no rows. No shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(model, keep_at, ["doc_id"]), "doc_id long, " + SCHEMA)


def train_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    return fit_quality(*labelled_sample(docs, labels, "quality", sample_rows))


def filter_documents(docs: DataFrame, model: QualityModel, keep_at: float = KEEP_AT) -> DataFrame:
    """docs without the rows that the rules reject; columns as before."""
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("quality_row"))
    row_type = rows.schema["quality_row"].dataType.simpleString()
    scored = rows.mapInArrow(_score(model, keep_at, ["quality_row"], "quality_row.text"), f"quality_row {row_type}, " + SCHEMA)
    return scored.where("kept").select(*[F.col(f"quality_row.`{c}`").alias(c) for c in names])
