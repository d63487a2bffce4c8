"""Toxicity: a bidirectional GRU with attention pooling, trained in numpy.

Input of a step: the embedding of a word (lower-cased, without punctuation at its ends) and
the mean of the embeddings of its character trigrams. Words have an embedding of their own
if the training sample ties them to a label (a two-proportion z of 3 or more); it starts out
along that z, so that training need not find the words among thousands by chance. Two GRUs read a window of 32 words, one from each end; attention over
their joint states pools the window, and a logistic unit scores it. Windows overlap
and cover the whole text; a document's score is that of its most toxic window.

Training sees documents, not windows: in each epoch the currently highest window of a
document (at first: the one with the largest sum of z) carries its label; a negative
document also gives one other window. The loss
turns from cross entropy to the generalised one of Zhang and Sabuncu (q = 0.7), which
gives little weight to labels that the model keeps contradicting, so flipped labels are
not learned by heart. The sample is bounded: the first ``POSITIVES`` and ``NEGATIVES``
labelled rows by md5 of their key, with texts of at most ``MOST_CHARS`` characters. The fit is a
function of that sample only (fixed seed), runs on the driver and is sent to the tasks.

Scoring runs over batches of windows in the tasks. A word's part in both GRUs' gates does
not depend on its neighbours, so it is computed once for each distinct word and looked up.

Edge cases: null or empty texts get the score of an empty window; without labelled rows of
both classes the score is the share of positive rows (0 without any); equal rows stay
separate rows; further columns pass through ``score_documents``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, python_ready, relieved, text_bytes

STEPS, STRIDE = 32, 24  # words of a window, and from one window to the next
WORDS, LEAST_Z, LEAST_DOCS = 512, 3.0, 3  # words with an embedding of their own
TRIGRAMS = 1024  # buckets of character trigrams, a power of 2
WIDTH, HIDDEN = 8, 8  # of each embedding, of each direction
POSITIVES, NEGATIVES, MOST_CHARS = 700, 1000, 20_000
EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY = 12, 300, 64, 0.01, 0.1
ROBUST_FROM, Q = 0.25, 0.7  # part of the training after which the loss is the robust one
REJECT_AT = 0.7
SEED = 7
CACHE = 60_000
BLOCK = 1024  # windows scored at once
EDGES = b".,;:!?#*$%&|\"'()<>[]{}-_=+~`/\\"


def bare(word: bytes) -> bytes:
    return word.lower().strip(EDGES)


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of <word>> for all words in a row, and how many each word has."""
    text = np.frombuffer(b"".join([b"<" + w + b">>" for w in words]), np.uint8).astype(np.uint32)
    counts = np.array([len(w) + 1 for w in words], np.int64)
    code = text[:-2] | text[1:-1] << np.uint32(8) | text[2:] << np.uint32(16)
    last = np.cumsum(counts + 2) - 2  # the two trigrams that begin at a word's last two bytes run into the next
    whole = np.ones(len(text), bool)
    whole[last] = whole[last + 1] = False
    return (code[whole[:-2]] * np.uint32(2654435761)) >> np.uint32(32 - (TRIGRAMS.bit_length() - 1)), counts


def window_starts(n: int) -> list[int]:
    """Starts of overlapping windows over n words; the last one ends with the text."""
    return [0] if n <= STEPS else [*range(0, n - STEPS, STRIDE), n - STEPS]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Parameters, by name, and the vocabulary. ``gates`` maps a bare word to its input of both GRUs."""

    def __init__(self, vocabulary: list[bytes], z: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}
        d, h = 2 * WIDTH, HIDDEN
        draw = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.p = {"words": draw(len(vocabulary) + 1, WIDTH) * 0.1, "chars": draw(TRIGRAMS, WIDTH) * 0.3,
                  "attention": draw(2 * h), "out": draw(2 * h), "bias": np.zeros(1, np.float32)}
        self.p["words"][1:] += np.clip(z, -8, 8)[:, None].astype(np.float32) / 8 * draw(WIDTH) * 2
        self.p["words"][0] = 0  # words without an embedding
        for side in "fb":
            self.p |= {f"in_{side}": draw(d, 3 * h), f"state_{side}": draw(h, 3 * h),
                       f"gate_{side}": np.zeros(3 * h, np.float32)}

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """len(words) x 2 WIDTH."""
        if not words:
            return np.zeros((0, 2 * WIDTH), np.float32)
        own = self.p["words"][[self.vocabulary.get(w, 0) for w in words]]
        buckets, counts = trigrams(words)
        sums = np.add.reduceat(self.p["chars"].take(buckets, 0), np.cumsum(counts) - counts)
        return np.concatenate([own, sums / counts[:, None].astype(np.float32)], 1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Both directions' input to the gates: n x (z, r, n of the forward GRU; of the backward one)."""
        return np.concatenate([x @ self.p[f"in_{s}"] + self.p[f"gate_{s}"] for s in "fb"], -1)


def gru(x: np.ndarray, mask: np.ndarray | None, state: np.ndarray, keep: list | None = None) -> np.ndarray:
    """x: steps x batch x 3h. Returns the states, steps x batch x h. keep collects what the way back needs."""
    h = state.shape[0]
    now = np.zeros((x.shape[1], h), np.float32)
    out = np.empty((x.shape[0], x.shape[1], h), np.float32)
    for t in range(x.shape[0]):
        own = now @ state
        zr = 1 / (1 + np.exp(-(x[t, :, :2 * h] + own[:, :2 * h])))
        z, r = zr[:, :h], zr[:, h:]
        n = np.tanh(x[t, :, 2 * h:] + r * own[:, 2 * h:])
        if keep is not None:
            keep.append((now, own[:, 2 * h:], z, r, n))
        after = n + z * (now - n)
        now = after if mask is None else np.where(mask[t][:, None], after, now)
        out[t] = now
    return out


def gru_back(d_out: np.ndarray, mask: np.ndarray, state: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of x and of state, given those of the states."""
    h = state.shape[0]
    d_x, d_state = np.zeros((*d_out.shape[:2], 3 * h), np.float32), np.zeros_like(state)
    d_now = np.zeros(d_out.shape[1:], np.float32)
    for t in reversed(range(d_out.shape[0])):
        d = d_now + d_out[t]
        before, own_n, z, r, n = keep[t]
        live = mask[t][:, None]
        d_after = np.where(live, d, 0)
        d_n = d_after * (1 - z) * (1 - n * n)
        d_z = d_after * (before - n) * z * (1 - z)
        d_r = d_n * own_n * r * (1 - r)
        d_own = np.concatenate([d_z, d_r, d_n * r], 1)
        d_x[t] = np.concatenate([d_z, d_r, d_n], 1)
        d_state += before.T @ d_own
        d_now = np.where(live, d_after * z + d_own @ state.T, d)
    return d_x, d_state


def pooled(p: dict, states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, attention weights (steps x batch) and pooled states of steps x batch x 2h."""
    e = states @ p["attention"]
    if mask is not None:
        e = np.where(mask, e, -1e9)
    a = np.exp(e - e.max(0))
    if mask is not None:
        a = a * mask
    a = a / np.maximum(a.sum(0), 1e-9)
    c = np.einsum("tb,tbh->bh", a, states)
    return c @ p["out"] + p["bias"], a, c


def split_gates(gates: np.ndarray) -> list[np.ndarray]:
    """Six tables of n x h; those of z and r are halved, as sigmoid(x) = (1 + tanh(x / 2)) / 2."""
    h = HIDDEN
    return [np.ascontiguousarray(gates[:, k * h:(k + 1) * h]) * np.float32(1 if k % 3 == 2 else 0.5) for k in range(6)]


def window_logits(model: Model, tables: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    """ids: windows x steps, rows of the gate tables; negative where there is no word (only at the end).

    The same as ``gru`` and ``pooled``, with contiguous operands.
    """
    h, half, p = HIDDEN, np.float32(0.5), model.p
    state = {s: [np.ascontiguousarray(p[f"state_{s}"][:, k * h:(k + 1) * h]) * np.float32(1 if k == 2 else 0.5)
                 for k in range(3)] for s in "fb"}
    at_h = {"f": slice(0, h), "b": slice(h, 2 * h)}
    out = np.empty(len(ids), np.float32)
    for at in range(0, len(ids), BLOCK):
        part = np.ascontiguousarray(ids[at:at + BLOCK].T)
        mask = part >= 0
        full = mask.all()
        part = part if full else np.maximum(part, 0)
        states = np.empty((STEPS, part.shape[1], 2 * h), np.float32)
        for side, first in (("f", 0), ("b", 3)):
            uz, ur, un = state[side]
            now = np.zeros((part.shape[1], h), np.float32)
            for t in range(STEPS) if side == "f" else reversed(range(STEPS)):
                z = np.tanh(tables[first].take(part[t], 0) + now @ uz)
                r = np.tanh(tables[first + 1].take(part[t], 0) + now @ ur)
                n = np.tanh(tables[first + 2].take(part[t], 0) + (half * r + half) * (now @ un))
                after = n + (half * z + half) * (now - n)
                now = after if full else np.where(mask[t][:, None], after, now)
                states[t, :, at_h[side]] = now
        out[at:at + BLOCK] = pooled(p, states, None if full else mask)[0]
    return out


def cut(numbers: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Windows over texts of so many words each, as windows x steps of numbers (-1: none), and the text of each."""
    starts, owner, short, at = [], [], [], 0
    for k, n in enumerate(counts):
        own = window_starts(n)
        starts += [at + s for s in own]
        owner += [k] * len(own)
        if n < STEPS:
            short.append((len(owner) - 1, n))
        at += n
    padded = np.concatenate([numbers, np.full(STEPS, -1, np.int32)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, STEPS)[starts]
    for w, n in short:
        windows[w, n:] = -1
    return windows, np.array(owner)


def label_z(bares: list[list[bytes]], y: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Words that go with a label, and their z: the difference of the shares of positive and negative texts."""
    positive, negative = Counter(), Counter()
    for words, label in zip(bares, y):
        (positive if label else negative).update(set(words))
    p, n = y.sum(), len(y) - y.sum()
    found = []
    for w, k in (positive + negative).items():
        if w and k >= LEAST_DOCS:
            share = k / len(y)
            z = (positive[w] / p - negative[w] / n) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / p + 1 / n))
            if abs(z) >= LEAST_Z:
                found.append((-abs(z), w, z))
    found = sorted(found)[:WORDS]
    return [w for _, w, _ in found], np.array([z for _, _, z in found])


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Model | float:
    """A model, or the constant score if the sample does not hold both classes."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    bares = [[bare(w) for w in t.split()] for t in texts]
    words, z = label_z(bares, y)
    model = Model(words, z, seed)
    rng = np.random.default_rng(seed)
    known = sorted({w for ws in bares for w in ws}) or [b""]
    numbers = {w: k for k, w in enumerate(known)}
    flat = np.array([numbers[w] for ws in bares for w in ws], np.int32)
    windows, owner = cut(flat, [len(ws) for ws in bares])
    own = np.array([model.vocabulary.get(w, 0) for w in known])
    heat = np.concatenate([[0.0], z])[own]
    first = np.searchsorted(owner, np.arange(len(texts)))
    count = np.bincount(owner, minlength=len(texts))
    weight = np.sqrt(np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))).astype(np.float32)
    batches = -(-int(len(y) + (y == 0).sum()) // BATCH)
    epochs = max(epochs, -(-LEAST_STEPS // batches))  # a small sample is gone over more often
    p, moments, step = model.p, {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}, 0
    for epoch in range(epochs):
        if epoch == 0:
            level = np.where(windows >= 0, heat[np.maximum(windows, 0)], 0).sum(1)
        else:
            level = window_logits(model, split_gates(model.gates(model.inputs(known))), windows)
        top = np.lexsort((level, owner))[first + count - 1]
        other = (first + rng.integers(0, count))[y == 0]
        chosen = np.concatenate([top, other])
        goal, w = np.concatenate([y, y[y == 0]]), np.concatenate([weight, weight[y == 0]])
        shuffled = rng.permutation(len(chosen))
        for at in range(0, len(chosen), BATCH):
            pick = shuffled[at:at + BATCH]
            step += 1
            g = gradients(model, windows[chosen[pick]], goal[pick], w[pick], known, own, robust=epoch >= ROBUST_FROM * epochs)
            for k, d in g.items():
                m, v = moments[k]
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                p[k] -= RATE * ((m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7) + DECAY * p[k])
            p["words"][0] = 0
    return model


def gradients(model: Model, ids: np.ndarray, y: np.ndarray, weight: np.ndarray, known: list[bytes], own: np.ndarray,
              robust: bool) -> dict[str, np.ndarray]:
    """Of the mean weighted loss over windows (batch x steps of numbers into known)."""
    p, h3 = model.p, 3 * HIDDEN
    used, local = np.unique(np.maximum(ids, 0), return_inverse=True)
    local = local.reshape(ids.shape)
    x = model.inputs([known[k] for k in used])
    gates, part, mask = model.gates(x), local.T, (ids >= 0).T
    keep_f, keep_b = [], []
    f = gru(gates[part][..., :h3], mask, p["state_f"], keep_f)
    b = gru(gates[part][::-1, :, h3:], mask[::-1], p["state_b"], keep_b)[::-1]
    states = np.concatenate([f, b], 2)
    logit, a, c = pooled(p, states, mask)
    score = sigmoid(logit)
    d_logit = (score - y) * weight / len(y)
    if robust:
        d_logit = d_logit * np.maximum(np.where(y == 1, score, 1 - score), 1e-3) ** Q
    d_logit = d_logit.astype(np.float32)
    g = {"out": c.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_c = d_logit[:, None] * p["out"]
    d_a = np.einsum("bh,tbh->tb", d_c, states)
    d_e = a * (d_a - (a * d_a).sum(0))
    g["attention"] = np.einsum("tb,tbh->h", d_e, states)
    d_states = a[..., None] * d_c + d_e[..., None] * p["attention"]
    d_f, g["state_f"] = gru_back(d_states[..., :HIDDEN], mask, p["state_f"], keep_f)
    d_b, g["state_b"] = gru_back(d_states[::-1, :, HIDDEN:], mask[::-1], p["state_b"], keep_b)
    d_gates = np.zeros_like(gates)
    np.add.at(d_gates, part.ravel(), np.concatenate([d_f, d_b[::-1]], 2).reshape(-1, 2 * h3))
    d_x = np.zeros_like(x)
    for s, d in (("f", d_gates[:, :h3]), ("b", d_gates[:, h3:])):
        g[f"in_{s}"], g[f"gate_{s}"] = x.T @ d, d.sum(0)
        d_x += d @ p[f"in_{s}"].T
    g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
    np.add.at(g["words"], own[used], d_x[:, :WIDTH])
    buckets, sizes = trigrams([known[k] for k in used])
    np.add.at(g["chars"], buckets, np.repeat(d_x[:, WIDTH:] / sizes[:, None].astype(np.float32), sizes, axis=0))
    return g


class Scorer:
    """Scores texts with tables of the gates of words met so far, forgotten when they are full."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.tables = [np.zeros((1, HIDDEN), np.float32)] * 6

    def number(self, words: list[bytes]) -> np.ndarray:
        got = list(map(self.rows.get, words))
        if None in got:
            new = list(dict.fromkeys(w for w, k in zip(words, got) if k is None))
            at = len(self.rows)
            more = split_gates(self.model.gates(self.model.inputs([bare(w) for w in new])))
            if at + len(new) > len(self.tables[0]):
                room = max(2 * len(self.tables[0]), at + len(new)) - at
                self.tables = [np.concatenate([t[:at], np.zeros((room, HIDDEN), np.float32)]) for t in self.tables]
            for t, m in zip(self.tables, more):
                t[at:at + len(new)] = m
            self.rows.update(zip(new, range(at, at + len(new))))
            got = map(self.rows.get, words)
        return np.fromiter(got, np.int32, len(words))

    def score(self, texts: list[bytes]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= 1 << 19:
                size += len(texts[end])
                end += 1
            if len(self.rows) > CACHE:
                self.clear()
            words = [t.lower().split() for t in texts[at:end]]
            windows, owner = cut(self.number([w for ws in words for w in ws]), [len(ws) for ws in words])
            np.maximum.at(best, owner + at, window_logits(self.model, self.tables, windows))
            at = end
        return sigmoid(best)


def _score(sent, text_at: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scorer = None if isinstance(model, float) else Scorer(model)
        for b in batches:
            score = np.full(b.num_rows, model) if scorer is None else scorer.score(text_bytes(b.column(text_at)))
            yield appended(b, {name: pa.array(score, pa.float64())})

    return relieved(run)


def held_out(key: str = "doc_id") -> Column:
    """The third of all rows that is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model | float:
    """Fits on a bounded sample of labelled rows that are not held out."""
    spark = docs.sparkSession
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic", F.md5(
        F.col("doc_id").cast("string").cast("binary")).alias("_order"))
    chosen = [r for label, most in ((1, positives), (0, negatives))
              for r in usable.where(F.col("toxic") == label).orderBy("_order", "doc_id").limit(most).collect()]
    if not chosen:
        return 0.0
    ids = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in chosen],
                                T.StructType([T.StructField("_id", labels.schema["doc_id"].dataType), T.StructField("_toxic", T.IntegerType())]))
    texts = docs.where(F.length("text") <= MOST_CHARS).select("doc_id", "text").join(
        F.broadcast(ids), F.col("doc_id") == F.col("_id"))  # at most positives + negatives rows
    # One text an id, the least one, so that repeated ids do not add to the sample.
    rows = sorted(tuple(r) for r in texts.groupBy("doc_id", "_toxic").agg(F.min("text").alias("text")).select(
        "doc_id", "text", "_toxic").collect())
    return fit([t.encode() for _, t, _ in rows], [x for _, _, x in rows])


def score_documents(docs: DataFrame, model: Model | float, text: str = "text", score: str = "_score") -> DataFrame:
    """docs with ``score`` (0 to 1), a name that docs does not have."""
    if score.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {score}")
    python_ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(_score(sent, docs.columns.index(text), score), schema)
