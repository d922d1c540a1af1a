"""Operator 3: toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its own embedding (for words of the training vocabulary) plus the
mean embedding of its hashed byte n-grams, so unseen spellings of a stem are met as
well. Windows of ``WINDOW`` words, each overlapping the next by half, are read by a
gated recurrent network in both directions; attention pools the states to one
probability. Every window of every document is scored; a document's score is its
worst window's.

The network is trained in numpy on a bounded sample of labelled documents: of each
class at most ``SAMPLE_PER_CLASS``, those with the smallest hash of ``doc_id``; an id that is
labelled both ways is left out, and of several texts of an id the one with the smallest hash
is taken, so training is the same in every run. Labels
are of documents, so training is multiple-instance: a toxic document contributes the
windows that score highest so far (at first those with the most telling words and
n-grams), a clean one its worst and some random windows. A fifth of the sample is held out
to choose the threshold.

Defined cases: a null, empty or wordless text has no windows, a null score and is
not toxic; with no labels of both classes nothing is toxic (score zero); a very long text is
scored in all its windows; of windows that score alike the first is the worst; repeated rows are each
scored; an empty table has no result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.sample import sample_texts, smallest_hashes
from strataframe.llm.text import Words, column, remap, runs, tokenize
from strataframe.plans.runtime import pick

WINDOW, STRIDE = 16, 8
SAMPLE_PER_CLASS = 1500
MIN_DOCS = 5
DIM, HIDDEN, ATTEND = 16, 12, 8
GRAM_BITS = 15
GRAMS = (3, 4, 5)
ROUNDS, EPOCHS, BATCH = 3, 4, 256
OUTER = " \t.,;:!?\"'()[]{}<>|*#$%&/\\-_=+~^`"


class Net(NamedTuple):
    vocabulary: dict[str, int]  # word -> row of ``word``; row 0 is for all others
    word: np.ndarray
    gram: np.ndarray
    wx: np.ndarray  # 2 x DIM x 3 HIDDEN: input weights of update, reset and candidate, a direction each
    wh: np.ndarray  # 2 x HIDDEN x 3 HIDDEN
    b: np.ndarray  # 2 x 3 HIDDEN
    att: np.ndarray  # 2 HIDDEN x ATTEND
    query: np.ndarray  # ATTEND
    out: np.ndarray  # 2 HIDDEN + 1, the last is the bias
    threshold: float


def _words(texts: pa.Array) -> Words:
    w = tokenize(texts)
    return remap(w, [x.strip(OUTER) for x in w.words])


def byte_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the framed words and the number a word has; a frame is one byte at either end."""
    raw = [w.encode() for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 2
    data = np.frombuffer(b"\x02" + b"\x03\x02".join(raw) + b"\x03", np.uint8).astype(np.uint32)
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(raw)), size)
    room = end[word] - np.arange(len(data))
    out, owner = [], []
    for n in GRAMS:
        h = np.full(max(0, len(data) - n + 1), n, np.uint32)
        for i in range(n):
            h = (h ^ data[i : len(data) - n + 1 + i]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(13)
        fit = np.flatnonzero(room[: len(h)] >= n)
        out.append((h[fit] * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS))
        owner.append(word[fit])
    owner_all = np.concatenate(owner)
    order = np.argsort(owner_all, kind="stable")
    return np.concatenate(out)[order].astype(np.int64), np.bincount(owner_all, minlength=len(raw))


def windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of all windows and the text of each. The last window of a text ends with it."""
    n = np.diff(offsets)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(n)), count)
    i = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    length = np.minimum(n[doc], WINDOW)
    return offsets[:-1][doc] + np.minimum(i * STRIDE, n[doc] - length), length, doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def inputs(net: Net, words: list[str]) -> np.ndarray:
    """The network's input for each word."""
    x = net.word[np.fromiter((net.vocabulary.get(w, 0) for w in words), np.int64, len(words))].copy()
    for a in range(0, len(words), 1 << 15):
        g, n = byte_grams(words[a : a + (1 << 15)])
        x[a : a + (1 << 15)] += np.add.reduceat(net.gram[g], np.cumsum(n) - n, axis=0) / n[:, None]
    return x


def score_windows(net: Net, words: list[str], ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each window's probability. Arrays run (features, windows), so that every operation is on contiguous rows."""
    x = inputs(net, words)
    proj = [np.ascontiguousarray((x @ net.wx[d] + net.b[d]).T) for d in (0, 1)]
    out = np.empty(len(start), np.float32)
    h3, h2 = 3 * HIDDEN, 2 * HIDDEN
    order = np.argsort(-length, kind="stable")
    for a in range(0, len(order), 8192):
        w = order[a : a + 8192]
        n, most = length[w], int(length[w[0]])
        even = n[-1] == most
        at = [ids[np.minimum(start[w] + t, start[w] + n - 1)] for t in range(most)]
        states = np.empty((most, h2, len(w)), np.float32)
        for d in (0, 1):
            h, u = np.zeros((HIDDEN, len(w)), np.float32), net.wh[d].T
            for t in range(most) if d == 0 else range(most - 1, -1, -1):
                p, r = proj[d].take(at[t], axis=1), u @ h
                gate = _sigmoid(p[:h2] + r[:h2])
                z = gate[:HIDDEN]
                cand = np.tanh(p[h2:h3] + gate[HIDDEN:] * r[h2:])
                new = cand + z * (h - cand)
                h = new if even else np.where(t < n, new, h)
                states[t, d * HIDDEN : (d + 1) * HIDDEN] = h
        e = np.stack([net.query @ np.tanh(net.att.T @ states[t]) for t in range(most)])
        if not even:
            e = np.where(np.arange(most)[:, None] < n, e, -np.inf)
        e = np.exp(e - e.max(0))
        e /= e.sum(0)
        pooled = sum(states[t] * e[t] for t in range(most))
        out[w] = _sigmoid(net.out[:-1] @ pooled + net.out[-1])
    return out


def _new(vocabulary: dict[str, int]) -> Net:
    rng = np.random.default_rng(11)
    f = lambda s, *shape: rng.normal(0, s, shape).astype(np.float32)
    return Net(
        vocabulary, f(0.1, len(vocabulary) + 1, DIM), f(0.3, 1 << GRAM_BITS, DIM), f(0.3, 2, DIM, 3 * HIDDEN), f(0.3, 2, HIDDEN, 3 * HIDDEN),
        np.zeros((2, 3 * HIDDEN), np.float32), f(0.3, 2 * HIDDEN, ATTEND), f(0.3, ATTEND), f(0.3, 2 * HIDDEN + 1), 0.5,
    )


PARTS = ("word", "gram", "wx", "wh", "b", "att", "query", "out")


def gradients(net: Net, word_rows: np.ndarray, grams: list[np.ndarray], at: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients of one batch. at: (T, B) positions in ``word_rows``; mask: (T, B); y: (B,)."""
    size = np.array([len(g) for g in grams])
    flat, ends = np.concatenate(grams), np.cumsum(size)
    x = net.word[word_rows] + np.add.reduceat(net.gram[flat], ends - size, axis=0) / size[:, None]
    t_max, b = at.shape
    keep: list[list] = [[], []]
    states = np.zeros((t_max, b, 2 * HIDDEN), np.float32)
    for d in (0, 1):
        h = np.zeros((b, HIDDEN), np.float32)
        proj = x @ net.wx[d] + net.b[d]
        for t in range(t_max) if d == 0 else range(t_max - 1, -1, -1):
            p, r = proj[at[t]], h @ net.wh[d]
            gate = _sigmoid(p[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])
            z, rs = gate[:, :HIDDEN], gate[:, HIDDEN:]
            cand = np.tanh(p[:, 2 * HIDDEN :] + rs * r[:, 2 * HIDDEN :])
            m = mask[t][:, None]
            new = m * (cand + z * (h - cand)) + (1 - m) * h
            keep[d].append((t, h, z, rs, cand, r[:, 2 * HIDDEN :], m))
            h = new
            states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
    a = np.tanh(states @ net.att)
    e = np.where(mask > 0, a @ net.query, -1e9)
    alpha = np.exp(e - e.max(0))
    alpha /= alpha.sum(0)
    pooled = np.einsum("tb,tbh->bh", alpha, states)
    prob = _sigmoid(pooled @ net.out[:-1] + net.out[-1])
    loss = float(-np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7)))
    g = {k: np.zeros_like(getattr(net, k)) for k in PARTS if k not in ("word", "gram")}
    dlogit = ((prob - y) / b).astype(np.float32)
    g["out"][:-1], g["out"][-1] = dlogit @ pooled, dlogit.sum()
    dpool = dlogit[:, None] * net.out[:-1]
    dstates = alpha[:, :, None] * dpool
    dalpha = np.einsum("bh,tbh->tb", dpool, states)
    de = alpha * (dalpha - (alpha * dalpha).sum(0))
    g["query"] = np.einsum("tb,tbk->k", de, a)
    da = de[:, :, None] * net.query * (1 - a * a)
    g["att"] = np.einsum("tbh,tbk->hk", states, da)
    dstates += da @ net.att.T
    dx = np.zeros_like(x)
    for d in (0, 1):
        flow: list[tuple] = []
        dh = np.zeros((b, HIDDEN), np.float32)
        for t, h, z, rs, cand, rc, m in reversed(keep[d]):
            dh = dh + dstates[t, :, d * HIDDEN : (d + 1) * HIDDEN]
            dn = m * dh
            dcand = dn * (1 - z) * (1 - cand * cand)
            dz = dn * (h - cand) * z * (1 - z)
            dr = dcand * rc * rs * (1 - rs)
            dp = np.concatenate([dz, dr, dcand], 1)
            drec = np.concatenate([dz, dr, dcand * rs], 1)
            g["wh"][d] += h.T @ drec
            flow.append((at[t], dp))
            dh = (1 - m) * dh + dn * z + drec @ net.wh[d].T
        dproj = _row_sums(np.concatenate([v for _, v in flow]), np.concatenate([i for i, _ in flow]))[0]  # every row of x is met
        g["wx"][d], g["b"][d] = x.T @ dproj, dproj.sum(0)
        dx += dproj @ net.wx[d].T
    g["x"], g["flat"], g["size"] = dx, flat, size
    return loss, g


class _Adam:
    """Adam; rows of embeddings that a batch doesn't touch stay as they are."""

    def __init__(self, net: Net, rate: float = 0.01):
        self.m = {k: np.zeros_like(getattr(net, k)) for k in PARTS}
        self.v = {k: np.zeros_like(getattr(net, k)) for k in PARTS}
        self.rate, self.t = rate, 0

    def step(self, net: Net, name: str, grad: np.ndarray, rows=...) -> None:
        p, m, v = getattr(net, name), self.m[name], self.v[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
        lr = self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        p[rows] -= lr * m[rows] / (np.sqrt(v[rows]) + 1e-6) + 1e-4 * self.rate * p[rows]


def _row_sums(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    distinct, first = np.unique(rows[order], return_index=True)
    return np.add.reduceat(values[order], first, axis=0), distinct


def fit(texts: list[str], labels: list[int]) -> Net | None:
    """The network of a labelled sample, or None without both classes."""
    y = np.array(labels)
    if len(set(labels)) < 2:
        return None
    w = _words(pa.array(texts, pa.string()))
    rng = np.random.default_rng(5)
    n_docs = len(texts)
    held = rng.permutation(n_docs) % 5 == 0
    if not ((y[held] == 1).any() and (y[held] == 0).any() and (y[~held] == 1).any() and (y[~held] == 0).any()):
        held[:] = False
    doc = np.repeat(np.arange(n_docs), np.diff(w.offsets))
    grams, size = byte_grams(w.words) if w.words else (np.array([], np.int64), np.array([], np.int64))
    gram_of = np.split(grams, np.cumsum(size)[:-1])
    key = np.unique(doc * max(1, len(w.words)) + w.ids)
    pair_doc, pair_word = key // max(1, len(w.words)), key % max(1, len(w.words))
    df = np.bincount(pair_word[~held[pair_doc]], minlength=len(w.words))
    vocabulary = {w.words[i]: k + 1 for k, i in enumerate(np.flatnonzero(df >= MIN_DOCS))}
    net, adam = _new(vocabulary), None
    adam = _Adam(net)
    row_of = np.fromiter((vocabulary.get(x, 0) for x in w.words), np.int64, len(w.words))
    start, length, win_doc = windows(w.offsets)
    if not len(start):
        return None
    # the first guess: how much more often toxic documents hold a word or n-gram
    pos, neg = (y == 1) & ~held, (y == 0) & ~held
    odds = lambda a, b: np.where(a >= 2, np.log((a + 0.1) / pos.sum()) - np.log((b + 0.5) / neg.sum()), 0)
    count = lambda of: np.bincount(pair_word[of[pair_doc]], minlength=len(w.words))
    by_word = odds(count(pos), count(neg))
    gram_df = np.zeros((2, 1 << GRAM_BITS))
    for i in np.flatnonzero(~held):
        mine = pair_word[np.searchsorted(pair_doc, i) : np.searchsorted(pair_doc, i, "right")]
        if len(mine):
            holds = np.zeros(1 << GRAM_BITS, bool)
            holds[np.concatenate([gram_of[j] for j in mine])] = True
            gram_df[y[i]] += holds
    by_gram = odds(gram_df[1], gram_df[0])
    telling = np.maximum(by_word, np.maximum.reduceat(by_gram[grams], np.cumsum(size) - size))[w.ids]
    inside = np.minimum(start[:, None] + np.arange(WINDOW), (start + length - 1)[:, None])
    belief = telling[inside].max(1)
    first, last = np.searchsorted(win_doc, np.arange(n_docs)), np.searchsorted(win_doc, np.arange(n_docs), "right")
    for r in range(ROUNDS):
        chosen, target = [], []
        for i in np.flatnonzero(~held & (last > first)):
            mine = np.arange(first[i], last[i])
            top = mine[np.argsort(-belief[mine], kind="stable")]
            if y[i]:
                bar = 0.5 * belief[top[0]] if r == 0 else max(0.5, 0.9 * belief[top[0]])
                take = [top[0], *top[1:4][belief[top[1:4]] >= bar]]
            else:
                take = [*top[:2], *rng.choice(mine, min(3, len(mine)), replace=False)]
            chosen += take
            target += [y[i]] * len(take)
        chosen, target = np.array(chosen), np.array(target)
        for _ in range(EPOCHS):
            order = rng.permutation(len(chosen))
            for a in range(0, len(order), BATCH):
                c = chosen[order[a : a + BATCH]]
                at = w.ids[inside[c]].T
                mask = (np.arange(WINDOW)[:, None] < length[c]).astype(np.float32)
                used, place = np.unique(at, return_inverse=True)
                rows = np.where(rng.random(len(used)) < 0.3, 0, row_of[used])  # words dropped at random, so that n-grams learn too
                _, g = gradients(net, rows, [gram_of[i] for i in used], place.reshape(at.shape), mask, target[order[a : a + BATCH]])
                adam.t += 1
                adam.step(net, "gram", *_row_sums(np.repeat(g["x"] / g["size"][:, None], g["size"], axis=0), g["flat"]))
                adam.step(net, "word", *_row_sums(g["x"], rows))
                for k in PARTS[2:]:
                    adam.step(net, k, g[k])
        belief = score_windows(net, w.words, w.ids, start, length)
    best = np.zeros(n_docs)
    np.maximum.at(best, win_doc, belief)
    return net._replace(threshold=_threshold(best[held], y[held]) if held.any() else 0.5)


def _threshold(score: np.ndarray, y: np.ndarray) -> float:
    """Of the cuts with the best F1 on held-out documents, the middle of the widest gap, in log-odds."""
    order = np.argsort(-score)
    s, tp = score[order], np.cumsum(y[order])
    f1 = 2 * tp / (np.arange(1, len(s) + 1) + y.sum())
    logit = np.log(np.clip(s, 1e-6, 1 - 1e-6) / (1 - np.clip(s, 1e-6, 1 - 1e-6)))
    nxt = np.r_[logit[1:], logit[-1] - 1]
    i = max(np.flatnonzero(f1 >= f1.max() - 1e-12), key=lambda k: logit[k] - nxt[k])
    return float(_sigmoid((logit[i] + nxt[i]) / 2))


def train(docs: DataFrame, labels: DataFrame) -> Net | None:
    """Fits on the bounded sample, which is all that reaches the driver."""
    marked = pick(labels, doc_id="bigint", toxic="int")
    ids = smallest_hashes(marked, "toxic", SAMPLE_PER_CLASS)
    mine = marked.dropna().join(F.broadcast(ids.select("doc_id").distinct()), "doc_id").groupBy("doc_id")  # bounded by the sample
    agreed = mine.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).filter("toxic = other").select("doc_id", "toxic")
    rows = sample_texts(docs, agreed, "toxic", False).orderBy("doc_id").collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def toxicity(docs: DataFrame, net: Net | None) -> DataFrame:
    """``(doc_id, score, n_windows, worst_word, toxic)`` for every row; ``worst_word`` is the number of the worst window's first word."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for b in runs(whole, "text"):
                w = _words(column(b, "text"))
                start, length, doc = windows(w.offsets)
                p = score_windows(m, w.words, w.ids, start, length) if m and len(start) else np.zeros(len(start))
                n = np.bincount(doc, minlength=b.num_rows)
                worst = np.lexsort((start, -p, doc))[np.cumsum(n)[n > 0] - n[n > 0]] if len(start) else np.array([], int)
                score, word = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
                score[n > 0], word[n > 0] = p[worst], start[worst] - w.offsets[:-1][n > 0]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(b, "doc_id"),
                        pa.array(score.round(5), mask=n == 0),
                        pa.array(n.astype(np.int64)),
                        pa.array(word, mask=n == 0),
                        pa.array((score >= m.threshold) & (n > 0) if m else np.zeros(b.num_rows, bool)),
                    ],
                    names=["doc_id", "score", "n_windows", "worst_word", "toxic"],
                )

    return pick(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, score double, n_windows bigint, worst_word bigint, toxic boolean")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity(docs, train(docs, labels))
