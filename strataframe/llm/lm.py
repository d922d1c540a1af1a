"""Operator 4: document scores by masked pseudo-likelihood.

A bidirectional window network predicts every word from the two before and the two
after it, itself left out: the four neighbours' position-specific embeddings are added,
squashed, and fed to a two-level softmax (class, then word within the class). A document's
score is the sum of its words' conditional log-probabilities.

The vocabulary comes from exact counts over all documents: every word that makes up
at least ``WORD_SHARE`` of all words has an id of its own. Classes are runs of words by
frequency; one of words of share p holds about 1 / sqrt(p) of them, which keeps the
expected number of outputs a word smallest. The network predicts the hashed bucket of a
rarer word; the word's probability is the bucket's times the word's share of the bucket's
counts, joined from the counts of all words, so the probabilities of all words sum to one.

Texts are read once: each run of texts is written as the indices of its words into its own
list of words, and counts, training and scoring read that table. Training is numpy gradient
descent (Adagrad) over all documents in ``ROUNDS`` rounds of parallel local passes: each
partition starts from the common weights and passes over its documents, every word of every
``ROUNDS``-th stretch of ``STRETCH`` words being a target, so each word of the corpus is a
target in exactly one round; the partitions' weights are averaged by their numbers of
targets, in a tree of ``FAN_IN`` at a time. Nothing is sampled or capped, and what is
gathered (word counts, weights a partition) grows with the input.

Defined cases: a null, empty or wordless text has no tokens, a log-probability of
zero and no mean; a very long text forms a run of its own and is scored whole; equal
counts are ordered by word; repeated rows are each scored; an empty table trains nothing
and scores nothing; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.text import column, runs, segment_sum
from strataframe.plans.runtime import discard, materialize, pick

WORD_SHARE = 1e-5
SPECIAL = 64  # class 0: the id 0 stands outside a document, the others are buckets of rare words
LEAST_MEMBERS = 8
HIDDEN = 32
REACH = 2
ROUNDS = 2
RATE = (0.4, 0.2)
STRETCH = 256
BATCH = 32  # stretches
BLOCK = 1 << 15
FAN_IN = 64
PLAIN = {"parquet.enable.dictionary": "false"}  # no two runs are alike
OUTER = " \t.,;:!?\"'()[]{}<>|*#$%&/\\-_=+~^`"


class Net(NamedTuple):
    context: np.ndarray  # words x (2 * REACH * HIDDEN): a word's embedding for each place beside a target
    bias: np.ndarray  # HIDDEN
    classes: np.ndarray  # classes x (HIDDEN + 1), the last is the bias
    members: np.ndarray  # words x (HIDDEN + 1)
    cuts: np.ndarray  # class c has the words cuts[c] to cuts[c + 1]

    @property
    def class_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.cuts) - 1, dtype=np.int16 if len(self.cuts) < 1 << 15 else np.int32), np.diff(self.cuts))


def initial(counts: list[int], total: int) -> Net:
    """Small random weights, and biases that give the words' frequencies: ``counts`` of the vocabulary, most frequent first."""
    rng = np.random.default_rng(7)
    size = SPECIAL + len(counts)
    n = np.full(size, 0.5)
    n[SPECIAL:] += counts
    n[1:SPECIAL] += max(0, total - sum(counts)) / (SPECIAL - 1)
    cuts = [0, SPECIAL]
    while cuts[-1] < size:
        cuts.append(min(size, cuts[-1] + max(LEAST_MEMBERS, round(math.sqrt(n.sum() / n[cuts[-1]])))))
    mass = np.add.reduceat(n, cuts[:-1])
    f = np.float32
    classes, members = rng.normal(0, 0.1, (len(mass), HIDDEN + 1)).astype(f), rng.normal(0, 0.1, (size, HIDDEN + 1)).astype(f)
    classes[:, -1], members[:, -1] = np.log(mass / mass.sum()), np.log(n / np.repeat(mass, np.diff(cuts)))
    return Net(rng.normal(0, 0.1, (size, 2 * REACH * HIDDEN)).astype(f), np.zeros(HIDDEN, f), classes, members, np.array(cuts))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-cased words between white space without their outer signs, as ``Words``, but the distinct ones stay in Arrow: most are rare, and a Python string each costs more than the rest."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    bare = pc.utf8_trim(coded.dictionary, characters=OUTER).dictionary_encode()
    to, words = bare.indices.to_numpy(zero_copy_only=False).astype(np.int32), bare.dictionary
    nothing = pc.index(words, "").as_py()
    if nothing >= 0:
        to = np.where(to == nothing, -1, to - (to > nothing))
        words = pa.concat_arrays([words[:nothing], words[nothing + 1 :]])
    ids, offsets = to[coded.indices.to_numpy(zero_copy_only=False)], split.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    if nothing >= 0:
        keep = ids >= 0
        ids, offsets = ids[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
    return offsets, ids, words


def _bucket(word: str) -> int:
    return 1 + zlib.crc32(word.encode()) % (SPECIAL - 1)


def vocabulary_ids(words: pa.Array, own: pa.Array) -> np.ndarray:
    """The id of each word: its own, or its bucket's (as of ``_bucket``, from the bytes in Arrow's buffer)."""
    at = pc.index_in(words, value_set=own)
    out = pc.fill_null(at, 0).to_numpy(zero_copy_only=False) + np.int32(SPECIAL)
    rare = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
    if len(rare):
        _, ends, raw = words.take(pa.array(rare)).cast(pa.large_string()).buffers()
        ends, raw = np.frombuffer(ends, np.int64, len(rare) + 1).tolist(), memoryview(raw)
        out[rare] = [1 + zlib.crc32(raw[a:b]) % (SPECIAL - 1) for a, b in zip(ends, ends[1:])]
    return out


def padded(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids with ``REACH`` zeros before, between and after the texts, and the places of the words."""
    n = np.diff(ends, prepend=0)
    at = np.arange(len(ids)) + REACH * (1 + np.repeat(np.arange(len(n)), n))
    out = np.zeros(len(ids) + REACH * (len(n) + 1), np.int32)
    out[at] = ids
    return out, at


def stretches(ids: np.ndarray) -> np.ndarray:
    """The padded ids as stretches of ``STRETCH`` places, each with its ``REACH`` neighbours on either side."""
    k = max(1, -(-(len(ids) - 2 * REACH) // STRETCH))
    room = np.zeros(k * STRETCH + 2 * REACH, np.int32)
    room[: len(ids)] = ids
    return np.lib.stride_tricks.as_strided(room, (k, STRETCH + 2 * REACH), (STRETCH * room.itemsize, room.itemsize))


PLACES = [*range(-REACH, 0), *range(1, REACH + 1)]
ONES = np.ones(1 << 16, np.float32)


def hidden(net: Net, near: np.ndarray) -> np.ndarray:
    """The states of the stretches' places, and a one for the bias."""
    s, k = near.shape[0], near.shape[1] - 2 * REACH
    h = np.empty((s, k, HIDDEN + 1), np.float32 if net.context.dtype == np.float32 else np.float64)
    h[..., -1] = 1
    for a in range(0, s, 4):  # a few at a time stay in the cache
        g = net.context.take(near[a : a + 4], axis=0)
        z = g[:, REACH + PLACES[0] : REACH + PLACES[0] + k, :HIDDEN] + net.bias
        for i, p in enumerate(PLACES[1:], 1):
            z += g[:, REACH + p : REACH + p + k, i * HIDDEN : (i + 1) * HIDDEN]
        np.tanh(z, out=h[a : a + 4, :, :-1])
    return h


def _small(weights: np.ndarray) -> bool:
    """Whether no state can give an output whose exponential overflows."""
    return float((np.abs(weights) @ ONES[: weights.shape[1]]).max()) < 60


def _sums(x: np.ndarray) -> np.ndarray:
    """Of each row."""
    return x @ (ONES[: x.shape[1]] if x.shape[1] <= len(ONES) else np.ones(x.shape[1], np.float32))


def _loss_gradients(h: np.ndarray, weights: np.ndarray, small: bool, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the summed loss of a softmax: by state (not its one), and by weights. The numerators are left undivided, as states are narrower than they are."""
    x = h @ weights.T
    if not small:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    total = _sums(x)
    x[np.arange(len(x)), target] -= total
    part = (1 / total)[:, None]
    dh = x @ np.ascontiguousarray(weights[:, :-1])
    dh *= part
    return dh, x.T @ (h * part)


def _log_softmax(h: np.ndarray, weights: np.ndarray, small: bool, target: np.ndarray) -> np.ndarray:
    """log-probability of each row's target."""
    x = h @ weights.T
    if not small:
        x -= x.max(1, keepdims=True)
    own = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    return own - np.log(_sums(x))


def _targets(net: Net, class_of: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    """The words among the stretches' places, by class: where, which of the class's words, which class, and of each class that occurs, where its words begin and end here, and its cuts."""
    word = near[:, REACH:-REACH].ravel()
    take = np.flatnonzero(word)
    take = take[np.argsort(class_of[word[take]], kind="stable")]
    word = word[take]
    klass = class_of[word]
    edges = np.searchsorted(klass, np.arange(len(net.cuts)))
    there = np.flatnonzero(np.diff(edges))
    return take, word - net.cuts[klass], klass, np.stack([edges[there], edges[there + 1], net.cuts[there], net.cuts[there + 1]], 1).tolist()


def log_probabilities(net: Net, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the words at ``at``, all that ``ids`` has, each given its neighbours."""
    class_of, small = net.class_of, (_small(net.classes), _small(net.members))
    every = stretches(ids)
    out = np.zeros(every.shape[0] * STRETCH, np.float32)
    for a in range(0, len(every), 4 * BATCH):  # wider than in training, where the width tells
        near = every[a : a + 4 * BATCH]
        take, word, klass, classes = _targets(net, class_of, near)
        h = hidden(net, near).reshape(-1, HIDDEN + 1).take(take, axis=0)
        got = np.empty(len(word), np.float32)
        for i in range(0, len(word), 2048):
            got[i : i + 2048] = _log_softmax(h[i : i + 2048], net.classes, small[0], klass[i : i + 2048])
        for i, j, first, last in classes:
            got[i:j] += _log_softmax(h[i:j], net.members[first:last], small[1], word[i:j])
        out[a * STRETCH + take] = got
    return out[at - REACH]


def _row_sums(g: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``g[order]`` over the segments that begin at ``first``, by segment size, and the segments in that order: those of one size lie side by side and are added in one call."""
    size = np.diff(np.r_[first, len(order)])
    by = np.argsort(size, kind="stable")
    n = size[by]
    begin = np.cumsum(n) - n
    rows = g[order[np.repeat(first[by] - begin, n) + np.arange(len(order))]]
    out = np.empty((len(first), g.shape[1]), g.dtype)
    sizes, at = np.unique(n, return_index=True)
    for k, i, j in zip(sizes.tolist(), at.tolist(), [*at[1:].tolist(), len(n)]):
        a = int(begin[i])
        mine = rows[a : a + k * (j - i)]
        if k == 1:
            out[i:j] = mine
        elif j - i == 1:
            out[i] = ONES[:k] @ mine if k <= len(ONES) else mine.sum(0)
        else:
            np.add.reduce(mine.reshape(j - i, k, -1), axis=1, out=out[i:j])
    return out, by


class Trainer:
    """Adagrad on the summed loss of batches of ``BATCH`` stretches."""

    def __init__(self, net: Net, rate: float):
        self.net = Net(*[x.copy() for x in net])
        self.seen = [np.ones_like(x) for x in net[:4]]
        self.class_of = net.class_of
        self.rate, self.targets = rate, 0

    def _step(self, part: int, grad: np.ndarray, where: np.ndarray | None = None) -> None:
        acc, par = self.seen[part], self.net[part]
        for a in range(0, len(grad), 512):  # what is worked on stays in the cache
            g = grad[a : a + 512]
            rows = slice(a, a + 512) if where is None else where[a : a + 512]
            total = g * g
            total += acc[rows]
            acc[rows] = total
            np.sqrt(total, out=total)
            np.divide(g, total, out=total)
            total *= self.rate
            par[rows] -= total

    def gradients(self, near: np.ndarray) -> tuple[int, list]:
        """The number of targets, and the gradient of each part; that of ``context`` with the rows it is of."""
        net, (s, k) = self.net, (near.shape[0], near.shape[1] - 2 * REACH)
        take, word, klass, classes = _targets(net, self.class_of, near)
        n = len(word)
        h = hidden(net, near).reshape(-1, HIDDEN + 1).take(take, axis=0)
        small = _small(net.classes), _small(net.members)
        dh, d_classes, d_members = np.empty((n, HIDDEN), h.dtype), np.zeros_like(net.classes), np.zeros_like(net.members)
        for i in range(0, n, 2048):
            dh[i : i + 2048], d = _loss_gradients(h[i : i + 2048], net.classes, small[0], klass[i : i + 2048])
            d_classes += d
        for i, j, first, last in classes:
            d, d_members[first:last] = _loss_gradients(h[i:j], net.members[first:last], small[1], word[i:j])
            dh[i:j] += d
        dz = h[:, :-1] * h[:, :-1]
        np.subtract(1, dz, out=dz)
        dz *= dh
        # a neighbour's gradient is made of those of the targets around it, which stand side by side: the window of 2 * REACH + 1 of them that begins with the target REACH after it
        width = k + 4 * REACH
        placed = np.zeros((s * width, HIDDEN), h.dtype)
        placed[take + take // k * (4 * REACH) + 2 * REACH] = dz
        around = np.lib.stride_tricks.as_strided(placed, (s * width - 2 * REACH, (2 * REACH + 1) * HIDDEN), (placed.strides[0], placed.strides[1]))
        flat = near.ravel()
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        window = order + order // (k + 2 * REACH) * (2 * REACH)
        sums, by = _row_sums(around, window, first)
        context = np.empty((len(sums), 2 * REACH * HIDDEN), sums.dtype)
        for i, p in enumerate(PLACES):
            context[:, i * HIDDEN : (i + 1) * HIDDEN] = sums[:, (REACH - p) * HIDDEN : (REACH - p + 1) * HIDDEN]
        return n, [(context, flat[first[by]]), dz.sum(0), d_classes, d_members]

    def batch(self, near: np.ndarray) -> None:
        n, (context, *rest) = self.gradients(near)
        for part, grad in enumerate(rest, 1):
            self._step(part, grad)
        self._step(0, *context)
        self.targets += n

    def round(self, ids: np.ndarray, r: int) -> None:
        """All words of every ``ROUNDS``-th stretch from ``r`` on: over all rounds each word is a target once. A batch takes its stretches from all over the run, so that it mixes documents."""
        mine = stretches(ids)[r::ROUNDS]
        k = -(-len(mine) // BATCH)
        for i in range(k):
            self.batch(np.ascontiguousarray(mine[i::k]))


def pack(net: Net) -> np.ndarray:
    return np.concatenate([x.ravel() for x in net[:4]])


def unpack(flat: np.ndarray, like: Net) -> Net:
    out, at = [], 0
    for x in like[:4]:
        out.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
        at += x.size
    return Net(*out, like.cuts)


RUNS = "run bigint, words array<string>, counts array<bigint>, doc_ids array<bigint>, ends array<bigint>, ids binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for whole in batches:
        for b in runs(whole, "text"):
            offsets, ids, words = _words(column(b, "text"))
            counts = np.bincount(ids, minlength=len(words)).astype(np.int64)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            raw = ids.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), one(words), one(pa.array(counts)), one(column(b, "doc_id")), one(pa.array(offsets[1:])), pa.array([raw], pa.binary())],
                names=[f.split(" ")[0] for f in RUNS.split(", ")],
            )
            number += 1


def encode(docs: DataFrame) -> DataFrame:
    """All texts as runs of word indices, written once to the shared folder."""
    return materialize(pick(docs, doc_id="bigint", text="string").mapInArrow(_encode, RUNS), "runs", **PLAIN)


class Run(NamedTuple):
    known: np.ndarray  # the vocabulary's id of each of the run's words
    ids: np.ndarray  # of each place, the number of its word in the run's list
    ends: np.ndarray

    def padded(self) -> tuple[np.ndarray, np.ndarray]:
        return padded(self.known[self.ids], self.ends)


CODED = "run bigint, doc_ids array<bigint>, ends array<bigint>, ids binary, known binary"


def code(encoded: DataFrame, own: list[str]) -> DataFrame:
    """The runs with the vocabulary's ids in place of their words, written once for the training rounds and the scoring."""
    shared = encoded.sparkSession.sparkContext.broadcast(pa.array(own, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = pa.array([vocabulary_ids(w.values.cast(pa.string()), shared.value).tobytes() for w in b["words"]], pa.binary())
            yield pa.RecordBatch.from_arrays([b["run"], b["doc_ids"], b["ends"], b["ids"], known], names=["run", "doc_ids", "ends", "ids", "known"])

    return materialize(encoded.select("run", "doc_ids", "ends", "ids", "words").mapInArrow(run, CODED), "coded", **PLAIN)


def _runs(table) -> Iterator[Run]:
    """The runs of a batch or table, one by one."""
    known, ends, ids = (table[c] for c in ("known", "ends", "ids"))
    for i in range(table.num_rows):
        own = np.frombuffer(known[i].as_py(), np.int32)
        yield Run(own, np.frombuffer(ids[i].as_py(), np.uint16 if len(own) <= 1 << 16 else np.uint32).astype(np.int64), np.array(ends[i].as_py(), np.int64))


def vocabulary(encoded: DataFrame) -> tuple[list[tuple[str, int]], int, DataFrame]:
    """The words of at least ``WORD_SHARE``, most frequent first, with their counts over all documents; the number of all words; the counts of all words."""
    each = encoded.selectExpr("inline(arrays_zip(words, counts))").toDF("word", "n")
    words = materialize(each.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    own = words.filter(F.col("n") >= WORD_SHARE * total).orderBy(F.desc("n"), "word").collect()  # at most 1 / WORD_SHARE
    return [(r["word"], r["n"]) for r in own], total, words


def rare_words(words: DataFrame, total: int) -> DataFrame:
    """``(word, log_share)``: the logarithm of each rarer word's share of its bucket's counts."""
    bucket = F.crc32(F.encode("word", "utf-8")) % (SPECIAL - 1)
    rare = words.filter(F.col("n") < WORD_SHARE * total).withColumn("bucket", bucket)
    sums = rare.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    of = F.create_map(*[F.lit(x) for r in sums for x in (r["bucket"], r["n"])])[F.col("bucket")] if sums else F.lit(1)
    return rare.select("word", F.log(F.col("n") / of).alias("log_share"))


def _mean(key, table):
    """The average of the weight blocks of one node of the tree, by targets; in order of part, so that sums do not vary."""
    t = table.sort_by("part")
    n = t["n"].to_numpy()
    total = sum(np.frombuffer(w.as_py(), np.float32).astype(np.float64) * k for w, k in zip(t["weights"], n)) / max(1, n.sum())
    return pa.table({"block": t["block"][:1], "part": [t["part"][0].as_py() // FAN_IN], "n": [int(n.sum())], "weights": [total.astype(np.float32).tobytes()]})


SCHEMA = "block int, part bigint, n bigint, weights binary"


def train(coded: DataFrame, net: Net) -> Net:
    """The network after ``ROUNDS`` rounds over all runs."""
    spark, texts = coded.sparkSession, coded.select("known", "ends", "ids")
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast(net)

        def local(batches: Iterator[pa.RecordBatch], r: int = r, shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trainer = Trainer(shared.value, RATE[r])
            for b in batches:
                for run in _runs(b):
                    trainer.round(run.padded()[0], r)
            flat = pack(trainer.net)
            blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)] if trainer.targets else []
            k, part = len(blocks), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k), pa.int32()), pa.array([part] * k, pa.int64()), pa.array([trainer.targets] * k, pa.int64()), pa.array(blocks, pa.binary())],
                names=["block", "part", "n", "weights"],
            )

        state, parts = texts.mapInArrow(local, SCHEMA), texts.rdd.getNumPartitions()
        while True:
            state = state.groupBy("block", F.expr(f"part div {FAN_IN}")).applyInArrow(_mean, SCHEMA)
            parts = -(-parts // FAN_IN)
            if parts <= 1:
                break
        got = sorted(state.collect(), key=lambda x: x["block"])
        if got:
            net = unpack(np.concatenate([np.frombuffer(x["weights"], np.float32) for x in got]), net)
    return net


def rare_shares(encoded: DataFrame, rare: DataFrame) -> DataFrame:
    """``(run, i, log_share)`` of the words of each run that have no id of their own: one row a distinct word, not one a document."""
    each = encoded.select("run", F.posexplode("words").alias("i", "word"))
    return each.join(rare, "word").select("run", "i", F.col("log_share").cast("float"))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, log_prob, mean_log_prob)`` for every row, by a network trained on all of them."""
    encoded = encode(docs)
    own, total, words = vocabulary(encoded)
    shares = materialize(rare_shares(encoded, rare_words(words, total)), "shares")
    coded = code(encoded, [w for w, _ in own])
    discard(words)
    discard(encoded)
    net = initial([n for _, n in own], total)
    shared = docs.sparkSession.sparkContext.broadcast(train(coded, net) if own else net)

    def score(texts: pa.Table, rare: pa.Table) -> pa.Table:
        run = next(_runs(texts))
        share = np.zeros(len(run.known))
        share[rare["i"].to_numpy()] = rare["log_share"].to_numpy()
        offsets = np.r_[0, run.ends]
        sums = segment_sum(log_probabilities(shared.value, *run.padded()) + share[run.ids], offsets)
        n = np.diff(offsets)
        mean = pa.array((sums / np.maximum(1, n)).round(6), mask=n == 0)
        return pa.table({"doc_id": pa.array(texts["doc_ids"][0].as_py(), pa.int64()), "n_tokens": n, "log_prob": sums.round(3), "mean_log_prob": mean})

    scores = coded.groupBy("run").cogroup(shares.groupBy("run")).applyInArrow(score, "doc_id bigint, n_tokens bigint, log_prob double, mean_log_prob double")
    out = materialize(scores, "scores")
    for table in (coded, shares):
        discard(table)
    return out


def op4_lm_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(spark.read.parquet(f"{sf_dir}/documents.parquet"))
