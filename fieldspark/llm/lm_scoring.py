"""LM scoring: a gated recurrent network over words, beside exact add-one unigrams of the corpus.

Counts of all training tokens are one aggregation over the corpus. The commonest VOCAB tokens are the
network's words; its output is factored into classes of CLASS words by frequency (probability of the
class, then of the word in it), and other words share one unknown word. The probability of an unknown
word in full is that of "unknown" times its add-one share among the tokens outside the vocabulary, so
the model is a proper distribution over all token strings it has counts for plus one for the rest.

Training: all training documents, dealt out to rounds and their trainers, each document to one; a trainer
takes TRAINER_TOKENS on average, so a corpus of u times as many gets 2 sqrt(u) rounds of sqrt(u) / 2 trainers.
A trainer runs truncated backpropagation through time in numpy from where the round before ended; weights,
moments of the descent and its clock are averaged over a round's trainers and go on to the next round.
Scoring: documents stand in lanes one after another; the state is carried through a document from its first
token to its last and cleared between documents.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.words import column_of, slices, texts_of
from fieldspark.session import materialize, shared_folder

END = b""  # the end token: no word is empty
CLASSES, CLASS = 64, 64
VOCAB = CLASSES * CLASS  # with the end token and the unknown word
INPUT, HIDDEN = 16, 24
TRAINER_TOKENS = 250_000  # of one trainer in one round, on average
FAN_IN = 16  # packed states that one task adds up
KNOWN_COUNTS = 65_536  # tokens whose counts every task holds; the others' are joined
STRETCH = 1024  # training documents are cut into stretches of so many tokens, which may go to several trainers
SPAN, LANES = 32, 64
RATE, SLOWING = 0.015, 1000.0  # the rate falls to a half after so many steps, to a third after twice as many
LOG10 = float(np.log(10.0))


def tokens_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased words, then one end token."""
    return [*text.lower().split(), END]


def coded_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct tokens, the place there of each token of all texts, number of tokens of each text), as tokens_of has them.

    Arrow cuts the words and numbers them, so what is done in Python is done once for a batch's distinct tokens.
    """
    found = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    n = pc.list_value_length(found).to_numpy()
    coded = pc.ascii_lower(found.flatten()).dictionary_encode()  # not the texts: of a slice, Arrow lower-cases the wrong bytes
    at, tokens = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary())
    end = pc.index(tokens, pa.scalar(END, pa.large_binary())).as_py()
    if end < 0:
        end, tokens = len(tokens), pa.concat_arrays([tokens, pa.array([END], pa.large_binary())])
    else:  # texts that begin or end with white space have empty words there
        keep = at != end
        total, ends = np.r_[0, np.cumsum(keep)], np.cumsum(n)
        at, n = at[keep], total[ends] - total[ends - n]
    return tokens, np.insert(at, np.cumsum(n), end), n + 1


def places(find, tokens: pa.Array, otherwise: int) -> np.ndarray:
    """What find (a dictionary's get) has for each token."""
    return np.fromiter(map(find, tokens.to_pylist(), repeat(otherwise)), np.int64, len(tokens))


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


# --- corpus counts -------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1 << 20, 16 << 20):
        batch = batch.filter(pa.array([not is_held_out(d) for d in batch.column(0).to_pylist()], pa.bool_()))
        if batch.num_rows:
            tokens, at, _ = coded_tokens(column_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([tokens.cast(pa.binary()), pa.array(np.bincount(at, minlength=len(tokens)))], ["token", "n"])


def token_counts(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> token (binary, empty: the end), c: all training tokens of all documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c"))


def commonest(counts: DataFrame, most: int = KNOWN_COUNTS) -> list[tuple[bytes, int]]:
    """At most so many of the commonest tokens, all those from some count on: a histogram of counts tells from which.

    So the driver gets a bounded table whatever the number of partitions. If the tokens of the highest
    step are too many by themselves, a share of them is taken by hash, half of the bound on average.
    """
    step = F.floor(F.log2("c") * 16)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()
    least, total = None, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["n"]
        if total > most:
            break
        least = r["least"]
    if not steps:
        return []
    wanted = F.col("c") >= least if least is not None else None
    if wanted is None:
        top = max(steps, key=lambda r: r["step"])
        wanted = (step == top["step"]) & (F.pmod(F.xxhash64("token"), F.lit(top["n"])) < most // 2)
    got = [(bytes(r["token"]), r["c"]) for r in counts.where(wanted).collect()]
    return sorted(got, key=lambda x: (-x[1], x[0]))


# --- the network ---------------------------------------------------------------------------------

#: name -> shape; all weights travel as one array in this order. Gates are reset, update, candidate; the last row of wx, wc and wo is the bias
SHAPES = {
    "embed": (VOCAB, INPUT),
    "wx": (3, INPUT + 1, HIDDEN),
    "uh": (3, HIDDEN, HIDDEN),
    "wc": (HIDDEN + 1, CLASSES),
    "wo": (CLASSES, HIDDEN + 1, CLASS),
}


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES]).astype(np.float32)


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at : at + n].reshape(shape)
        at += n
    return out


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    return views(np.array(flat, np.float32))


def start_weights(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights; the biases are the unigram's logarithms, so training starts from there."""
    rng = np.random.Generator(np.random.PCG64(7))
    w = {k: rng.normal(0, 0.1, shape).astype(np.float32) for k, shape in SHAPES.items()}
    full = (np.resize(counts, VOCAB) * (np.arange(VOCAB) < len(counts)) + 0.5).reshape(CLASSES, CLASS)
    w["wx"][:, -1] = 0
    w["wc"][-1] = np.log(full.sum(axis=1) / full.sum())
    w["wo"][:, -1] = np.log(full / full.sum(axis=1, keepdims=True))
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _exponentials(x: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials of x, their sums by row), x shifted in place: by one number, or by each row's where rows lie far apart."""
    x -= x.max(initial=-np.inf)
    e = np.exp(x, out=out)
    total = np.einsum("ij->i", e)
    if len(x) and total.min() < 1e-25:
        x -= x.max(axis=1, keepdims=True)
        e = np.exp(x, out=out)
        total = np.einsum("ij->i", e)
    return e, total


def _chosen(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithms of the softmax of each row at one column; x is shifted."""
    _, total = _exponentials(x)
    return x[np.arange(len(at)), at] - np.log(total)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)


def log_probabilities(w: dict[str, np.ndarray], hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logarithms of the targets' probabilities, a row of hidden for each."""
    order = np.argsort((target // CLASS).astype(np.uint8), kind="stable")
    hidden, kind, place = _with_one(hidden[order]), target[order] // CLASS, target[order] % CLASS
    logits = hidden @ w["wc"]
    sums = _chosen(logits, kind)
    at = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    for c, (a, b) in enumerate(zip(at[:-1], at[1:])):
        if b > a:
            np.matmul(hidden[a:b], w["wo"][c], out=logits[a:b])
    sums += _chosen(logits, place)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def lanes_of(docs: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, whether a document starts, document number) in lanes (steps x lanes, longest lane first), -1 where a lane is over."""
    sizes = np.array([len(d) for d in docs], np.int64)
    longest = max(1, int(sizes.max(initial=1)))
    k = max(1, min(most, len(docs), -(-2 * int(sizes.sum()) // longest)))  # more lanes would not be shorter, but empty
    load, lane = np.zeros(k, np.int64), [[] for _ in range(k)]
    for i in np.argsort(-sizes, kind="stable"):
        j = int(load.argmin())
        lane[j].append(int(i))
        load[j] += sizes[i]
    order = np.argsort(-load, kind="stable")
    steps = int(load.max()) if len(docs) else 0
    tokens, number = np.full((k, steps), -1, np.int32), np.full((k, steps), -1, np.int32)
    first = np.zeros((k, steps), bool)
    for row, j in enumerate(order):
        at = 0
        for i in lane[j]:
            tokens[row, at : at + sizes[i]] = docs[i]
            number[row, at : at + sizes[i]] = i
            first[row, at] = True
            at += int(sizes[i])
    return np.ascontiguousarray(tokens.T), np.ascontiguousarray(first.T), np.ascontiguousarray(number.T)


def score_documents(w: dict[str, np.ndarray], docs: list[np.ndarray], end: int, lanes: int = 512, held: int = 1 << 13) -> np.ndarray:
    """Sum of the natural log-probabilities of each document's tokens (each ends with the end token)."""
    out = np.zeros(len(docs))
    tokens, first, number = lanes_of(docs, lanes)
    if not tokens.size:
        return out
    gates = np.matmul(_with_one(w["embed"]), w["wx"])  # of each input word
    alive = (tokens >= 0).sum(axis=1).tolist()
    h = np.zeros((tokens.shape[1], HIDDEN), np.float32)
    last = np.full(tokens.shape[1], end)
    starts = first.any(axis=1).tolist()
    hs, ts, ds, n = [], [], [], 0

    def flush():
        nonlocal hs, ts, ds, n
        if n:
            out[:] += np.bincount(np.concatenate(ds), log_probabilities(w, np.concatenate(hs), np.concatenate(ts)), len(docs))
        hs, ts, ds, n = [], [], [], 0

    for step, k in enumerate(alive):
        now = tokens[step, :k]
        h, last = h[:k], last[:k]
        if starts[step]:
            new = first[step, :k]
            h = h * ~new[:, None]
            last = np.where(new, end, last)
        x = gates.take(last, axis=1)
        u = np.matmul(h, w["uh"])
        r, z = _sigmoid(np.add(x[:2], u[:2], out=x[:2]))
        cand = np.multiply(r, u[2], out=u[2])
        cand += x[2]
        np.tanh(cand, out=cand)
        h = h - cand
        h *= z
        h += cand
        hs.append(h)
        ts.append(now)
        ds.append(number[step, :k])
        last, n = now, n + k
        if n >= held:
            flush()
    flush()
    return out


def _softmax_loss(x: np.ndarray, at: np.ndarray, out: np.ndarray) -> float:
    """Summed loss of the chosen columns; out is the gradient of its mean, x is shifted."""
    rows, n = np.arange(len(at)), np.float32(len(at))
    _, total = _exponentials(x, out)
    out *= (1 / (total * n))[:, None]
    out[rows, at] -= 1 / n
    return float((np.log(total) - x[rows, at]).sum())


class Descent:
    """A network in training: its weights, their first and second moments, and the steps taken."""

    def __init__(self, flat: np.ndarray, first: np.ndarray | None = None, second: np.ndarray | None = None, steps: float = 0.0):
        self.flat = np.array(flat, np.float32)
        self.first = np.zeros_like(self.flat) if first is None else np.array(first, np.float32)
        self.second = np.zeros_like(self.flat) if second is None else np.array(second, np.float32)
        self.steps = steps

    def packed(self) -> np.ndarray:
        return np.concatenate([self.flat, self.first, self.second, [self.steps]]).astype(np.float32)

    @classmethod
    def unpacked(cls, x: np.ndarray) -> Descent:
        n = len(x) // 3
        return cls(x[:n], x[n : 2 * n], x[2 * n : 3 * n], float(x[-1]))


def train(w: dict[str, np.ndarray], docs: list[np.ndarray], end: int, rate: float = RATE) -> tuple[dict[str, np.ndarray], float]:
    """(weights, mean loss in nats) after one pass over the documents from new moments."""
    state = Descent(pack(w))
    loss = descend(state, docs, end, rate)
    return views(state.flat), loss


def descend(state: Descent, docs: list[np.ndarray], end: int, rate: float = RATE) -> float:
    """One pass of truncated backpropagation that moves state on: spans of SPAN steps, the network's state carried on; mean loss in nats.

    Only the recurrence goes step by step; what does not wait for it is taken for a whole span at once,
    in arrays that all spans share. Lanes that are over are left out of later spans.
    """
    all_tokens, all_first, _ = lanes_of(docs, LANES)
    flat, m, v2 = state.flat, state.first, state.second
    grad, spare = np.zeros_like(flat), np.zeros_like(flat)
    w, g = views(flat), views(grad)
    lanes = all_tokens.shape[1]
    alive = (all_tokens >= 0).sum(axis=1)
    full = min(SPAN, len(all_tokens)) * lanes
    new = lambda *shape: np.empty(shape, np.float32)
    e_all, hidden_all = np.ones((full, INPUT + 1), np.float32), np.ones((full, HIDDEN + 1), np.float32)
    x_all, u_all, du_all, rz_all, de_all = new(3, full, HIDDEN), new(3, full, HIDDEN), new(3, full, HIDDEN), new(2, full, HIDDEN), new(3, full, INPUT)
    before_all, cand_all, after_all, dn_all, dh_rows, back_all, part_all = (new(full, HIDDEN) for _ in range(7))
    logits_all, d_all = new(full, CLASS), new(full, CLASS)
    gap_all, across_all = new(lanes, HIDDEN), new(3, lanes, HIDDEN)
    h, loss, count, t = np.zeros((lanes, HIDDEN), np.float32), 0.0, 0, state.steps
    for begin in range(0, len(all_tokens), SPAN):
        lanes = int(alive[begin])
        tokens, first = all_tokens[begin : begin + SPAN, :lanes], all_first[begin : begin + SPAN, :lanes]
        keep = (~first).astype(np.float32)[:, :, None]
        before_it = all_tokens[begin - 1, :lanes] if begin else np.full(lanes, end, all_tokens.dtype)
        prior = np.concatenate([before_it[None], tokens[:-1]])
        prior[(prior < 0) | first] = end
        prior = prior.ravel().astype(np.uint16)
        kind = np.where(tokens < 0, CLASSES, tokens // CLASS).astype(np.uint8).ravel()
        places = (tokens % CLASS).astype(np.uint8).ravel()
        h, gap, across = h[:lanes], gap_all[:lanes], across_all[:, :lanes]
        steps = len(tokens)
        rows = steps * lanes
        e, x, u, du, rz, de = e_all[:rows], x_all[:, :rows], u_all[:, :rows], du_all[:, :rows], rz_all[:, :rows], de_all[:, :rows]
        before, cand, after, dn, dh_all = before_all[:rows], cand_all[:rows], after_all[:rows], dn_all[:rows], dh_rows[:rows]
        e[:, :INPUT] = w["embed"][prior]
        np.matmul(e, w["wx"], out=x)
        for s in range(steps):
            a, b = s * lanes, s * lanes + lanes
            h = np.multiply(h, keep[s], out=before[a:b])
            us = np.matmul(h, w["uh"], out=u[:, a:b])
            r, z = _sigmoid(np.add(x[:2, a:b], us[:2], out=rz[:, a:b]))
            c = np.multiply(r, us[2], out=cand[a:b])
            c += x[2, a:b]
            np.tanh(c, out=c)
            np.subtract(h, c, out=gap)
            np.multiply(gap, z, out=gap)
            h = np.add(c, gap, out=after[a:b])
        order = np.argsort(kind, kind="stable")  # by class, after which the places where a lane is over
        kind = kind[order]
        at = np.searchsorted(kind, np.arange(CLASSES + 1))
        n = int(at[-1])
        order, kind, at = order[:n], kind[:n], at.tolist()
        place = places[order]
        spans = [(c, a, b) for c, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
        hidden, logits, d, back, part = hidden_all[:n], logits_all[:n], d_all[:n], back_all[:n], part_all[:n]
        hidden[:, :HIDDEN] = after[order]
        loss += _softmax_loss(np.matmul(hidden, w["wc"], out=logits), kind, d)
        np.matmul(hidden.T, d, out=g["wc"])
        np.matmul(d, w["wc"][:-1].T, out=back)
        for c, a, b in spans:
            np.matmul(hidden[a:b], w["wo"][c], out=logits[a:b])
        loss += _softmax_loss(logits, place, d)
        g["wo"][:] = 0
        for c, a, b in spans:
            np.matmul(hidden[a:b].T, d[a:b], out=g["wo"][c])
            np.matmul(d[a:b], w["wo"][c, :-1].T, out=part[a:b])
        back += part
        dh_all[:] = 0
        dh_all[order] = back
        r, z = rz
        to_z, to_n, to_r = (before - cand) * z * (1 - z), (1 - z) * (1 - cand * cand), u[2] * r * (1 - r)
        dh = np.zeros((lanes, HIDDEN), np.float32)
        turned = np.ascontiguousarray(w["uh"].transpose(0, 2, 1))
        for i in range(steps - 1, -1, -1):
            a, b = i * lanes, i * lanes + lanes
            dh += dh_all[a:b]
            now = np.multiply(dh, to_n[a:b], out=dn[a:b])
            np.multiply(now, to_r[a:b], out=du[0, a:b])
            np.multiply(dh, to_z[a:b], out=du[1, a:b])
            np.multiply(now, r[a:b], out=du[2, a:b])
            np.matmul(du[:, a:b], turned, out=across)
            dh *= z[a:b]
            for one in across:
                dh += one
            dh *= keep[i]
        np.matmul(e.T, du[:2], out=g["wx"][:2])
        np.matmul(e.T, dn, out=g["wx"][2])
        np.matmul(before.T, du, out=g["uh"])
        np.matmul(du[:2], w["wx"][:2, :-1].transpose(0, 2, 1), out=de[:2])
        np.matmul(dn, w["wx"][2, :-1].T, out=de[2])
        de[0] += de[1]
        de[0] += de[2]
        same = np.argsort(prior, kind="stable")
        ordered = prior[same]
        starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
        g["embed"][:] = 0
        g["embed"][ordered[starts]] = np.add.reduceat(de[0][same], starts)
        norm = float(np.sqrt(grad @ grad))
        t += 1
        count += n
        step = np.float32(rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t) / (1 + t / SLOWING))
        # by the span's share of a full one, so a few last lanes do not move it far; 0.1: its square carries the 0.01 of v2
        grad *= np.float32(0.1 * n / full * min(1.0, 1.0 / max(norm, 1e-9)))
        m *= np.float32(0.9)
        m += grad
        grad *= grad
        v2 *= np.float32(0.99)
        v2 += grad
        np.sqrt(v2, out=spare)
        spare += np.float32(1e-6)
        np.divide(m, spare, out=spare)
        spare *= step
        flat -= spare
    state.steps = t
    return loss / max(1, count)


# --- Spark ---------------------------------------------------------------------------------------


class Vocabulary:
    """The network's words and the counts that every task holds. Bounded by VOCAB and KNOWN_COUNTS."""

    def __init__(self, common: list[tuple[bytes, int]], all_tokens: int, distinct: int):
        self.common = common
        self.all_tokens, self.distinct = all_tokens, distinct
        words = [END] + [t for t, _ in common if t != END][: VOCAB - 2]
        counts = dict(common)
        self.ids = {t: i for i, t in enumerate([END, None] + words[1:]) if t is not None}
        self.unknown = 1
        inside = sum(counts.get(t, 0) for t in self.ids)
        self.outside_tokens = all_tokens - inside
        self.outside_distinct = distinct - sum(t in counts for t in self.ids)
        self.counts = np.array([counts.get(END, 0), self.outside_tokens] + [counts.get(t, 0) for t in words[1:]], np.float64)


_SEQUENCES = "round int, trainer int, doc_id long, ids binary"


def _sequences(vocab: Vocabulary, trainers: int, rounds: int):
    """Training documents as ids of two bytes, each stretch dealt to a round and a trainer; equal rows of a task are spread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        find, unknown = vocab.ids.get, vocab.unknown
        for batch in slices(batches, 4096, 6 << 20):
            at_round, dealt, doc_ids, ids = [], [], [], []
            for d, key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts_of(batch)):
                if is_held_out(d):
                    continue
                whole = np.array([find(t, unknown) for t in tokens_of(text)], np.uint16)
                for begin in range(0, len(whole), STRETCH):
                    at = (key + seen[key] * 0x9E3779B97F4A7C15) % (1 << 64)
                    seen[key] += 1
                    at_round.append(at % rounds)
                    dealt.append((at >> 16) % trainers)
                    doc_ids.append(d)
                    ids.append(whole[begin : begin + STRETCH].tobytes())
            cols = [pa.array(at_round, pa.int32()), pa.array(dealt, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in _SEQUENCES.split(", ")])

    return run


def training_sequences(docs: DataFrame, vocab: Vocabulary, trainers: int, rounds: int = 2) -> DataFrame:
    """round, trainer, doc_id, ids: a row for each stretch of STRETCH tokens of a training document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("key", F.xxhash64("text", "doc_id")).mapInArrow(_sequences(vocab, trainers, rounds), _SEQUENCES)


_STATE = "trainer int, state binary, n long"


def _state_row(trainer: int, state: np.ndarray, n: int) -> pa.RecordBatch:
    cols = [pa.array([trainer], pa.int32()), pa.array([state.astype(np.float32).tobytes()], pa.binary()), pa.array([n], pa.int64())]
    return pa.RecordBatch.from_arrays(cols, ["trainer", "state", "n"])


def _trainer(state: Descent, end: int):
    """One trainer's turn; its task has its rows and no others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(-1 if d is None else d, i, t) for b in batches for t, d, i in zip(*(b.column(c).to_pylist() for c in ("trainer", "doc_id", "ids")))]
        if rows:
            rows.sort(key=lambda r: r[:2])
            own = Descent(state.flat, state.first, state.second, state.steps)
            descend(own, [np.frombuffer(i, np.uint16).astype(np.int32) for _, i, _ in rows], end)
            yield _state_row(rows[0][2], own.packed(), sum(len(i) // 2 for _, i, _ in rows))

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of a task's packed states, at most FAN_IN, by their tokens."""
    rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("trainer", "n", "state"))))
    if rows:
        n = sum(r[1] for r in rows)
        total = sum(np.frombuffer(r[2], np.float32).astype(np.float64) * r[1] for r in rows)
        yield _state_row(rows[0][0], total / max(1, n), n)


def plan_of(tokens: int) -> tuple[int, int]:
    """(rounds, trainers of each) for so many training tokens."""
    units = max(1, -(-tokens // TRAINER_TOKENS))
    rounds = max(2, math.ceil(2 * math.sqrt(units)))
    return rounds, -(-units // rounds)


def train_network(docs: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Weights after all rounds. A round reads its own files only and is one job: deal, train, and average packed states by FAN_IN.

    What goes to a task or the driver is a state (three numbers a weight), whatever the number of trainers.
    """
    spark = docs.sparkSession
    state = Descent(pack(start_weights(vocab.counts)))
    rounds, trainers = plan_of(vocab.all_tokens)
    at = f"{shared_folder(spark)}/lm-sequences-{uuid.uuid4().hex}"
    training_sequences(docs, vocab, trainers, rounds).repartitionById(rounds, "round").write.partitionBy("round").parquet(at)
    sequences = spark.read.schema(_SEQUENCES).parquet(at)
    for r in range(rounds):
        part = sequences.where(F.col("round") == r).select("trainer", "doc_id", "ids")
        means = part.repartitionById(trainers, "trainer").mapInArrow(_trainer(state, vocab.ids[END]), _STATE)
        left, share = trainers, 1
        while left > 1:
            left, share = -(-left // FAN_IN), share * FAN_IN
            means = means.repartitionById(left, F.floor(F.col("trainer") / share).cast("int")).mapInArrow(_mean, _STATE)
        for row in means.collect():  # one, or none in a round without documents
            state = Descent.unpacked(np.frombuffer(row["state"], np.float32))
    return state.flat


_PARTS = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, unknown long, rare array<binary>, rare_n array<int>"


def _score(vocab: Vocabulary, flat: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        weights = unpack(flat)
        log_c = np.log10(np.array([c for _, c in vocab.common], np.float64) + 1)
        place = {t: i for i, (t, _) in enumerate(vocab.common)}
        word = np.array([vocab.ids.get(t, vocab.unknown) for t, _ in vocab.common] + [vocab.unknown], np.int32)
        find, end = place.get, vocab.ids[END]
        log_all = float(np.log10(vocab.all_tokens + vocab.distinct + 1))
        for batch in slices(batches, 4096, 6 << 20):
            ids = batch.column(0).to_pylist()
            tokens, at, n = coded_tokens(column_of(batch, "text"))
            found = places(find, tokens, -1)
            kind = word[found]
            kind[pc.index(tokens, pa.scalar(END, pa.large_binary())).as_py()] = end
            logs, seen, outside = np.where(found >= 0, log_c[found] if len(log_c) else 0.0, 0.0), found >= 0, kind == vocab.unknown
            doc, ends = np.repeat(np.arange(len(ids)), n), np.cumsum(n)
            sequences = np.split(kind[at], ends[:-1])
            sums = lambda x: np.bincount(doc, x[at], len(ids))
            known, base = sums(seen).astype(np.int64), sums(logs) - n * log_all
            unknown, inside = sums(outside).astype(np.int64), sums(logs * outside)
            few = ~seen[at]
            pairs, times = np.unique(doc[few] * len(tokens) + at[few], return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(len(ids) + 1) * len(tokens)).astype(np.int32))
            rares = pa.ListArray.from_arrays(offsets, tokens.take(pa.array(pairs % len(tokens))).cast(pa.binary()))
            rare_n = pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))
            scores = score_documents(weights, sequences, end) / LOG10
            share = float(np.log10(vocab.outside_tokens + vocab.outside_distinct + 1))
            model = scores + inside - unknown * share
            cols = [
                pa.array(np.arange(row, row + len(ids))), batch.column(0), pa.array([is_held_out(d) for d in ids], pa.bool_()), pa.array(n, pa.int64()), pa.array(known),
                pa.array(base), pa.array(model), pa.array(unknown), rares, rare_n,
            ]
            row += len(ids)
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in _PARTS.split(", ")])

    return run


def lm_scores(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per row.

    Null and empty texts have the end token only. A null doc_id is not held out and stays null. Equal
    rows are scored each, with equal results. Other columns are ignored; an empty table gives no rows.
    Counts of the KNOWN_COUNTS commonest tokens are sent to all tasks (a bounded table); those of all
    others are joined, each document's rare words once with their number.
    """
    counts = materialize(token_counts(docs), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    common = commonest(counts)
    vocab = Vocabulary(common, int(total["n"]), int(total["v"]))
    flat = train_network(docs, vocab)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = materialize(rows.mapInArrow(_score(vocab, flat), _PARTS), "lm-parts")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.rare_n").alias("n"))
    found = rare.join(counts, "token")
    added = found.groupBy("row").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    out = parts.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "model").join(added, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(vocab.all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"),
    )
