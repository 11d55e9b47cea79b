"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

The kernel of two words sums, over all subsequences of ORDER letters that both have, LAMBDA to the
power of the letters spanned in each; so an insult with letters put in, left out or drawn apart stays
near the plain one. A word's first letter is a mark of its own, so that beginnings count. Words are
mapped to their kernels with a few landmarks, whitened by the landmarks' own kernel matrix (Nyström),
and a linear support vector machine is trained in that space.

Labels are of documents, so the words of a labelled text are trained on as a bag: all words of a clean
text are clean; of a toxic text those are toxic that hold a letter run (of GRAMS letters, the mark counts)
far commoner in toxic texts, and once a first machine stands, also the words it takes for toxic, or the
one nearest to that where a toxic text has none. A text is judged by its worst word, by the number of
its toxic words and by their share; a logistic curve of these three, fitted on texts kept apart, gives
the probability.

Bounds of the fit, all on a sample of labelled texts that is bounded itself (SAMPLE_ROWS of a label):
LANDMARKS and PLAIN_LANDMARKS landmarks of at most LANDMARK letters, chosen among the MOST_RUNS
commonest letter runs; MOST_POSITIVE toxic words and twice MOST_NEGATIVE clean ones, the commonest and
a random part of the rest. Scoring has no bound: a word of over LONGEST letters is read in overlapping
parts of that length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.quality_rules import labelled_sample
from fieldspark.llm.words import slices, texts_of, word_hashes, words_of

ORDER, LAMBDA = 3, 0.8
NORM = 0.25  # kernels are divided by this power of both words' own; 0.5 would punish a long word that holds an insult
POWER = 2  # of the normalised kernel (a kernel again), which sets near words apart from far ones
LANDMARKS, PLAIN_LANDMARKS, LANDMARK, GRAMS = 28, 8, 12, (4, 5)
MOST_RUNS, MOST_POSITIVE, MOST_NEGATIVE = 400, 4000, 20_000
LEAST_ODDS, SEEN_AT_MOST = 2.0, 5  # logarithm; a text counts a letter run so often at most
LEAST_TEXTS, LEAST_SHARE = 5, 0.015  # toxic texts, and share of them, that hold a run
LEAST_UNIT = 0.3  # least distance from there to a word that is toxic in full
CLEAN_SHARE = 0.999  # of the clean words have less than the margin from which words count as toxic
SAMPLE_ROWS = 1500  # of each label
TOXIC_AT = 0.7
LONGEST = 24  # letters of a word that are read at once
KNOWN_WORDS = 700_000  # words a worker remembers
MARK = "^"
_NOT_LETTER = re.compile(r"[\W\d_]+")
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_]\W?\s+){3,}[^\W\d_]\W?(?!\S)")


def parts_of(word: str) -> list[str]:
    """The marked letters of a word, in overlapping parts if there are many."""
    x = MARK + (word if word.isalpha() else _NOT_LETTER.sub("", word))
    return [x] if len(x) <= LONGEST else [x[i : i + LONGEST] for i in range(0, len(x) - LONGEST // 2, LONGEST // 2)]


def _codes(words: list[str], width: int, pad: int) -> np.ndarray:
    """Code points, padded with a value of its own that equals none of the other side's."""
    joined = "".join(w.ljust(width, "\0") for w in words)
    out = np.frombuffer(joined.encode("utf-32-le"), "<u4").reshape(len(words), width).astype(np.int32)
    return np.where(out == 0, pad, out)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Subsequence kernels of rows of s with the rows of t in the same places.

    Row by row of s: what ends at each letter of t so far decays by LAMBDA with each row, and a product
    with the powers of LAMBDA carries it to the later letters of t.
    """
    n, width = t.shape
    lam = np.float32(LAMBDA)
    at = np.arange(width)
    carry = np.where(at[None, :] > at[:, None], lam ** np.maximum(at[None, :] - at[:, None] - 1, 0), 0).astype(np.float32)
    ended = [np.zeros((n, width), np.float32) for _ in range(ORDER - 1)]  # subsequences of 1, 2, ... letters before each letter of t
    total = np.zeros((n, width), np.float32)
    for i in range(s.shape[1]):
        hit = (s[:, i : i + 1] == t).astype(np.float32) * (lam * lam)
        new = [hit] + [hit * e for e in ended]
        total += new[-1]
        for e, x in zip(ended, new):
            e *= lam
            e += x @ carry
    return total.sum(axis=1)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each of 32 kinds of letters stands in each row; letters that share a kind only add."""
    n = len(codes)
    rows, cols = np.nonzero(codes >= 0)
    return np.bincount(rows * 32 + codes[rows, cols] % 32, minlength=32 * n).reshape(n, 32).astype(np.uint8)


def kernels(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernels of all words with all landmarks. Pairs without ORDER letters in common have 0 and are not looked at."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    t = _codes(landmarks, max(map(len, landmarks)), -2)
    in_t = _letter_counts(t)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for k in range(0, len(order), 1024):
        at = np.array(order[k : k + 1024])
        part = [words[i] for i in at]
        s = _codes(part, max(map(len, part)), -1)
        in_s = _letter_counts(s)
        common = np.zeros((len(at), len(landmarks)), np.uint8)
        for x in range(32):
            common += np.minimum(in_s[:, x, None], in_t[None, :, x])
        i, j = np.nonzero(common >= ORDER)
        for a in range(0, len(i), 4096):
            out[at[i[a : a + 4096]], j[a : a + 4096]] = kernel(s[i[a : a + 4096]], t[j[a : a + 4096]])
    return out


def own_kernels(words: list[str]) -> np.ndarray:
    """Kernel of each word with itself."""
    out = np.empty(len(words), np.float32)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for k in range(0, len(order), 4096):
        at = order[k : k + 4096]
        part = [words[i] for i in at]
        width = max(map(len, part))
        out[at] = kernel(_codes(part, width, -1), _codes(part, width, -2))
    return out


def self_kernels(words: list[str]) -> np.ndarray:
    """Kernels of all words with all of them."""
    return kernels(words, words)


def _utf8(texts: list[bytes | str]) -> list[bytes]:
    return [t.encode() if isinstance(t, str) else t for t in texts]


@dataclass
class ToxicityModel:
    landmarks: list[str]
    whiten: np.ndarray
    weights: np.ndarray
    bias: float
    level: tuple[float, float]  # margin that hardly a clean word has, and how far beyond it a word is toxic in full
    curve: np.ndarray  # of the three measures of a text, and a constant
    known: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(0, np.uint64), np.zeros(0, np.float32)))

    def __getstate__(self):
        return self.__dict__ | {"known": (np.zeros(0, np.uint64), np.zeros(0, np.float32))}

    def features(self, words: list[str]) -> np.ndarray:
        """Nyström features of marked words, at most LONGEST long."""
        unit = np.maximum(own_kernels(words), 1e-9)[:, None] ** NORM * own_kernels(self.landmarks)[None] ** NORM
        return (kernels(words, self.landmarks) / unit) ** POWER @ self.whiten

    def margins(self, words: list[str]) -> np.ndarray:
        """Of each word, in whatever writing: the largest of its parts'; the bias where there are not ORDER letters."""
        parts = [[x for piece in w.lower().split() for x in parts_of(piece) if len(x) >= ORDER] for w in words]
        distinct = sorted({x for of in parts for x in of})
        value = dict(zip(distinct, (self.features(distinct) @ self.weights + self.bias).tolist())) if distinct else {}
        return np.array([max([value[x] for x in of], default=self.bias) for of in parts], np.float32)

    def margins_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(margins of all words of all texts, number of each one's text); words spelled letter by letter count as one more."""
        w = words_of(texts, lower=True)
        hashes = word_hashes(w)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known[0], distinct), max(0, len(self.known[0]) - 1))
        missing = self.known[0][at] != distinct if len(self.known[0]) else np.ones(len(distinct), bool)
        raw = w.raw.tobytes()
        if missing.any():
            if len(self.known[0]) > KNOWN_WORDS:
                missing[:] = True
                self.known = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
            f = first[missing]
            new = self.margins([raw[a:b].decode("utf-8") for a, b in zip(w.starts[f].tolist(), w.ends[f].tolist())])
            keys = np.r_[self.known[0], distinct[missing]]
            order = np.argsort(keys, kind="stable")
            self.known = (keys[order], np.r_[self.known[1], new][order])
            at = np.searchsorted(self.known[0], distinct)
        margin, text = self.known[1][at][back] if len(distinct) else np.zeros(0, np.float32), w.text_of_word()
        chars = np.r_[0, np.cumsum((w.raw & 0xC0) != 0x80)]
        short = chars[w.ends] - chars[w.starts] <= 2
        edge = np.flatnonzero(np.diff(np.r_[False, short, False]))
        spelled, of = [], []
        for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
            if b - a >= 4:
                for m in _SPELLED.finditer(raw[w.starts[a] : w.ends[b - 1]].decode("utf-8").lower()):
                    spelled.append(_NOT_LETTER.sub("", m[0]))
                    of.append(text[a])
        if spelled:
            margin, text = np.r_[margin, self.margins(spelled)], np.r_[text, of]
        return margin, text

    def measures(self, texts: list[bytes]) -> np.ndarray:
        """Worst word, toxic words, their share, and 1 for each text."""
        margin, text = self.margins_of(texts)
        worst = np.full(len(texts), self.bias)
        np.maximum.at(worst, text, margin)
        toxic = np.bincount(text, np.clip((margin - self.level[0]) / self.level[1], 0, 1), len(texts))
        n = np.bincount(text, minlength=len(texts))
        return np.c_[np.clip((worst - self.level[0]) / self.level[1], -2, 2), np.log(toxic + 0.3), np.log((toxic + 0.1) / (n + 30)), np.ones(len(texts))]

    def probability(self, texts: list[bytes | str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.measures(_utf8(texts)) @ self.curve, -40, 40)))


def _grams(word: str) -> list[tuple[int, str]]:
    """(place, run) of the letter runs of a word."""
    return [(i, word[i : i + n]) for n in GRAMS for i in range(len(word) - n + 1)]


def _run(word: str, marked: dict[str, int]) -> str | None:
    """The stretch of a word that its commonest marked letter runs cover (those half as common as the first)."""
    found = sorted((i, i + len(g), marked[g]) for i, g in _grams(word) if g in marked)
    if not found:
        return None
    most = max(n for _, _, n in found)
    spans = [(i, end) for i, end, n in found if 2 * n >= most]
    first, last = spans[0]
    for i, end in spans[1:]:
        if i > last:
            break
        last = max(last, end)
    return word[first:last][:LANDMARK]


def _apart(words: list[str], most: int, near: float = 0.6) -> list[str]:
    """The first words of which none is near another in the kernel."""
    unit = np.sqrt(own_kernels(words))
    like = self_kernels(words) / unit[:, None] / unit[None]
    taken: list[int] = []
    for i in range(len(words)):
        if len(taken) < most and all(like[i, j] < near for j in taken):
            taken.append(i)
    return [words[i] for i in taken]


def _gapped(word: str, rng: np.random.Generator) -> str:
    """The word with a letter put in."""
    i = int(rng.integers(2, max(3, len(word))))
    return word[:i] + "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(26))] + word[i:]


def _squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the least squared hinge loss, by Newton steps on the vectors inside the margin."""
    z = np.c_[x, np.ones(len(x))]
    a = np.zeros(z.shape[1])
    keep = l2 * np.eye(len(a))
    for _ in range(30):
        inside = y * (z @ a) < 1
        zi, ci = z[inside], cost[inside]
        new = np.linalg.solve((zi * ci[:, None]).T @ zi + keep, (zi * ci[:, None]).T @ y[inside])
        if np.abs(new - a).max() < 1e-8:
            break
        a = 0.5 * a + 0.5 * new
    return a[:-1], float(a[-1])


def _quantile(x: np.ndarray, weight: np.ndarray, share: float) -> float:
    order = np.argsort(x, kind="stable")
    upto = weight[order].cumsum()
    return float(x[order][np.searchsorted(upto, share * upto[-1])])


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.02) -> np.ndarray:
    """Logistic curve by Newton steps that are halved until they help; targets smoothed."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(a):
        z = x @ a
        return (np.logaddexp(0, z) - target * z).sum() + l2 / 2 * a @ a

    a = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(a))
        step, now = np.linalg.solve(h, x.T @ (p - target) + l2 * a), loss(a)
        while loss(a - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        a = a - step
    return a


def fit_toxicity(texts: list[bytes | str], toxic: np.ndarray, seed: int = 5) -> ToxicityModel:
    """Fit on 3 of 4 texts, calibrate on the fourth. With one label only, every text gets that label."""
    nothing = ToxicityModel([MARK + "aaa"], np.zeros((1, 1), np.float32), np.zeros(1, np.float32), 0.0, (0.0, 1.0), np.zeros(4))
    if not len(toxic) or toxic.min() == toxic.max():
        nothing.curve[3] = 3.0 if len(toxic) and toxic[0] else -3.0
        return nothing
    texts = _utf8(texts)
    rng = np.random.Generator(np.random.PCG64(seed))
    first = sorted({t: i for i, t in reversed(list(enumerate(texts)))}.values())  # copies would count twice
    texts, toxic = [texts[i] for i in first], toxic[first]
    apart = np.arange(len(texts)) % 4 == 3
    bags = [Counter(x for w in t.decode("utf-8").lower().split() for x in parts_of(w) if len(x) >= ORDER) for t in texts]
    n = np.array([((1 - toxic) * ~apart).sum(), (toxic * ~apart).sum()])
    seen, inside = (Counter(), Counter()), Counter()
    for bag, y, held in zip(bags, toxic, apart):
        if not held:
            of: Counter = Counter()
            for w, c in bag.items():
                for g in {g for _, g in _grams(w)}:
                    of[g] += c
            seen[int(y)].update({g: min(c, SEEN_AT_MOST) for g, c in of.items()})
            if y:
                inside.update(of.keys())
    odds = {g: np.log((c + 0.5) / (n[1] + 1)) - np.log((seen[0][g] + 0.5) / (n[0] + 1)) for g, c in seen[1].items() if inside[g] >= max(LEAST_TEXTS, LEAST_SHARE * n[1])}
    marked = {g: seen[1][g] for g, x in odds.items() if x > LEAST_ODDS}
    runs, witnesses, clean = Counter(), Counter(), Counter()
    for bag, y, held in zip(bags, toxic, apart):
        if not held and y:
            for w, c in bag.items():
                if run := _run(w, marked):
                    runs[run] += min(c, SEEN_AT_MOST)
                    witnesses[w] += min(c, SEEN_AT_MOST)
        elif not held:
            clean.update(bag)
    if not runs:
        nothing.curve[3] = -3.0
        return nothing
    common = lambda c: sorted(c, key=lambda w: (-c[w], w))
    bad = _apart(common(runs)[:MOST_RUNS], LANDMARKS)
    landmarks = list(dict.fromkeys(bad + [w[:LANDMARK] for w in common(clean) if len(w) > 5][: 50 * PLAIN_LANDMARKS : 50]))
    unit = own_kernels(landmarks) ** NORM
    values, vectors = np.linalg.eigh((self_kernels(landmarks) / unit[:, None] / unit[None]) ** POWER)
    whiten = (vectors * (1 / np.sqrt(np.maximum(values, 1e-3)))).astype(np.float32)
    model = ToxicityModel(landmarks, whiten, np.zeros(len(landmarks), np.float32), 0.0, (0.0, 1.0), np.zeros(4))
    negatives = common(clean)
    negatives = negatives[:MOST_NEGATIVE] + [negatives[i] for i in rng.permutation(len(negatives))[:MOST_NEGATIVE] if i >= MOST_NEGATIVE]
    x_neg = model.features(negatives).astype(np.float64)
    often = np.sqrt([clean[w] for w in negatives])
    for again in (False, True):
        positives = common(witnesses)[:MOST_POSITIVE]
        x = np.r_[model.features(positives + [_gapped(w, rng)[:LONGEST] for w in positives]).astype(np.float64), x_neg]
        y = np.r_[np.ones(2 * len(positives)), -np.ones(len(negatives))]
        # a word counts as often as it was a witness, so that few common insults weigh as much as many rare ones
        weight = np.array([witnesses[w] for w in positives], float)
        cost_pos = np.r_[weight, 0.3 * weight] / (1.3 * weight.sum())
        cost_neg = often / often.sum()
        for _ in range(4):  # a text is bad by its worst words: the worst clean words get half of the clean weight
            u, b = _squared_hinge(x, y, np.r_[cost_pos, cost_neg])
            worst = np.argsort(-(x_neg @ u), kind="stable")[: max(50, len(negatives) // 100)]
            hard = np.zeros(len(negatives))
            hard[worst] = often[worst] / often[worst].sum()
            cost_neg = 0.5 * cost_neg + 0.5 * hard
        model.weights, model.bias = u.astype(np.float32), float(b)
        if not again:  # toxic texts without a marked run: the word that looks most toxic stands for them
            for bag, y_, held in zip(bags, toxic, apart):
                if y_ and not held and bag and not any(w in witnesses for w in bag):
                    words = sorted(bag)
                    witnesses[words[int((model.features(words) @ model.weights).argmax())]] += 1
    low = _quantile(x_neg @ u + b, np.array([clean[w] for w in negatives], float), CLEAN_SHARE)
    full = _quantile((x @ u + b)[: len(positives)], weight, 0.25)
    model.level = (low, max(full - low, LEAST_UNIT))
    held = np.flatnonzero(apart)
    model.curve = _logistic(model.measures([texts[i] for i in held]), toxic[held])
    return model


def _is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def train_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from labelled rows whose crc32(doc_id as text) mod 3 is not 1, at most sample_rows of each label."""
    allowed = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1
    return fit_toxicity(*labelled_sample(docs, labels, "toxic", sample_rows, allowed))


_MODELS: dict[str, ToxicityModel] = {}


def score_toxicity(docs: DataFrame, model: ToxicityModel, toxic_at: float = TOXIC_AT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, score, predicted; one row per row.

    Null and empty texts score as no words do; a score of just toxic_at is predicted toxic. Null doc_id
    stays null and is not held out; equal rows give equal rows; other columns are ignored; an empty
    table gives no rows. No shuffle.
    """
    name = f"{id(model)}-{zlib.crc32(model.weights.tobytes())}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # from the module, not from this pickled function: the worker keeps the word cache between tasks
        from fieldspark.llm import toxicity

        if name not in toxicity._MODELS:
            toxicity._MODELS.clear()
            toxicity._MODELS[name] = model
        held = toxicity._MODELS[name]
        for batch in slices(batches, 4096, 4 << 20):
            p = held.probability(texts_of(batch))
            out = pa.array([_is_held_out(d) for d in batch.column(0).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), out, pa.array(p, pa.float64()), pa.array((p >= toxic_at).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
