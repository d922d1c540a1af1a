"""Operator 9: the languages of a document, by multilingual mixture inference.

A language's model is the distribution of its byte trigrams (each word lower-cased,
stripped of outer punctuation and framed by markers), fitted on a bounded sample of
labelled documents (``SAMPLE_PER_LANGUAGE`` ids a language, those with the smallest hash of
``doc_id``; of several texts of an id the one with the smallest hash). A document is a mixture: each word comes from one language, with the
likelihood of its trigrams, or from an "unknown" source that holds all trigrams
equally likely. Expectation-maximisation estimates the proportions. The first language is
the likeliest; others are added one at a time, the best first, as long as the
log-likelihood gains more than ``PENALTY`` times the logarithm of the number of
words; no share is too small. A document is kept if known
languages make up at least ``KEEP_SHARE`` of it.

Defined cases: a null, empty or wordless text has no languages, no shares and is
not kept; without any labelled row every document is unknown. Equal likelihoods
go to the language that is first by name. A very long text is inferred whole, in one run
of its own. Repeated rows are each scored. Extra
columns are ignored by the query and carried by the stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.sample import sample_texts, smallest_hashes
from strataframe.llm.text import column, remap, runs, tokenize
from strataframe.plans.runtime import pick

SAMPLE_PER_LANGUAGE = 2000
BITS = 16
PENALTY = 4.0
KEEP_SHARE = 0.5
ITERATIONS = 12
OUTER = " \t.,;:!?\"'()[]{}<>|*#$%&/\\-_=+~^`0123456789"


class Model(NamedTuple):
    languages: list[str]
    #: log-probability of each hashed trigram, a row a language
    table: np.ndarray


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of the framed words, and how many each word has."""
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"\x02" + b"\x03\x02".join(raw) + b"\x03", np.uint8).astype(np.uint32)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    h = (data[:-2] * np.uint32(0x9E3779B1)) ^ (data[1:-1] * np.uint32(0x85EBCA6B)) ^ (data[2:] * np.uint32(0xC2B2AE35))
    h = (h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)
    # a framed word of k bytes has k trigrams; those over the seam of two words are left out
    start = np.cumsum(size + 2) - (size + 2)
    inside = np.ones(len(h), bool)
    seam = start[1:]
    inside[seam - 1] = False
    inside[seam - 2] = False
    return h[inside], size


def _words(texts: pa.Array):
    w = tokenize(texts)
    return remap(w, [x.strip(OUTER) for x in w.words])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in runs(whole, "text"):
            langs = np.array(column(b, "lang").to_pylist(), object)
            for lang in sorted(set(langs.tolist())):
                w = _words(column(b, "text").filter(pa.array(langs == lang)))
                if not w.words:
                    continue
                times = np.bincount(w.ids, minlength=len(w.words))
                grams, size = _trigrams(w.words)
                n = np.bincount(grams, np.repeat(times, size), minlength=1 << BITS)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at].astype(np.int64))], names=["lang", "gram", "n"])


def fit(docs: DataFrame) -> Model:
    """Trigram models from the bounded sample; counted on the executors, at most languages x 2^BITS sums reach the driver."""
    ids = smallest_hashes(pick(docs, doc_id="bigint", lang="string"), "lang", SAMPLE_PER_LANGUAGE)
    sample = sample_texts(docs, ids, "lang", True)
    rows = sample.select("lang", "text").mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique().tolist())
    counts = np.full((len(languages), 1 << BITS), 0.05)
    for i, lang in enumerate(languages):
        mine = rows[rows["lang"] == lang]
        counts[i, mine["gram"].to_numpy()] += mine["n"].to_numpy()
    return Model(languages, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32))


def _per_doc(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows from each start to the next; no segment is empty."""
    return np.add.reduceat(values, starts, axis=0, dtype=np.float64)


def _mixture(like: np.ndarray, support: np.ndarray, doc: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of every document over its supported sources: the proportions, and the sum of log mixture likelihoods."""
    pi = support / support.sum(1, keepdims=True)
    for _ in range(ITERATIONS):
        r = like * pi.astype(np.float32)[doc]
        r /= r.sum(1, keepdims=True)
        pi = _per_doc(r, starts) / n[:, None]
    return pi, _per_doc(np.log((like * pi.astype(np.float32)[doc]).sum(1)), starts)


def infer(texts: pa.Array, model: Model) -> tuple[list[list[int]], list[list[float]], np.ndarray, np.ndarray]:
    """Per text: languages by falling share, their shares, the unknown share, the log-likelihood.

    The log-likelihood is concave in the proportions, so a source whose mean ratio of
    likelihood to the current mixture is at most one cannot raise it. That test,
    which is exact, settles most documents without any iteration.
    """
    w = _words(texts)
    n_docs, k = len(w.offsets) - 1, len(model.languages)
    languages: list[list[int]] = [[] for _ in range(n_docs)]
    shares: list[list[float]] = [[] for _ in range(n_docs)]
    unknown, total = np.ones(n_docs), np.zeros(n_docs)
    some = np.flatnonzero(np.diff(w.offsets))
    if not len(some):
        return languages, shares, unknown, total
    grams, size = _trigrams(w.words)
    first_gram = np.cumsum(size) - size
    # a word's log-likelihood a source, the unknown one last
    by_word = np.stack([*[np.add.reduceat(model.table[i][grams], first_gram) for i in range(k)], -BITS * np.log(2) * size], 1).astype(np.float32)
    starts, n = w.offsets[some], np.diff(w.offsets)[some]
    bar = PENALTY * np.log(n + 1.0)
    # the first language: the likeliest when each word may also be unknown
    best = np.stack([_per_doc(np.maximum(by_word[:, j], by_word[:, k])[w.ids], starts) for j in range(k)], 1) if k else np.zeros((len(some), 0))
    none = _per_doc(by_word[:, k][w.ids], starts)
    lead = best.argmax(1) if k else np.zeros(len(some), int)
    got = best.max(1) - none > bar if k else np.zeros(len(some), bool)
    chosen = np.zeros((len(some), k + 1), bool)
    chosen[:, k] = True
    chosen[np.flatnonzero(got), lead[got]] = True
    pi = np.zeros((len(some), k + 1))
    pi[np.arange(len(some)), np.where(got, lead, k)] = 1
    base = np.where(got, lead, k)
    doc = np.repeat(np.arange(len(some)), n)
    top = by_word[w.ids, base[doc]]
    value = _per_doc(top, starts)
    ratio = np.stack([_per_doc(np.exp(np.minimum(by_word[:, j][w.ids] - top, 60)), starts) for j in range(k + 1)], 1)
    active = np.flatnonzero((ratio > n[:, None] * (1 + 1e-4)).any(1))
    if len(active):
        mine = np.repeat(np.isin(np.arange(len(some)), active), n)
        sub = by_word[w.ids[mine]]
        peak = sub.max(1, keepdims=True)
        like, offset = np.exp(np.maximum(sub - peak, -60)), _per_doc(peak[:, 0], np.r_[0, np.cumsum(n[active])[:-1]])
        doc = np.repeat(np.arange(len(active)), n[active])
        start = np.r_[0, np.cumsum(n[active])[:-1]]
        p, v = _mixture(like, chosen[active].astype(float), doc, start, n[active])
        pi[active], value[active] = p, v + offset
        while len(active):
            mix = (like * pi[active].astype(np.float32)[doc]).sum(1, keepdims=True)
            slope = _per_doc(like / mix, start) / n[active][:, None] > 1 + 1e-4
            gain, at, gain_pi = value[active].copy(), np.full(len(active), -1), np.zeros((len(active), k + 1))
            for j in range(k):
                able = slope[:, j] & ~chosen[active, j]
                if not able.any():
                    continue
                t = np.flatnonzero(able)
                rows = able[doc]
                s_doc, s_start = np.repeat(np.arange(len(t)), n[active][t]), np.r_[0, np.cumsum(n[active][t])[:-1]]
                support = chosen[active[t]].astype(float)
                support[:, j] = 1
                p, v = _mixture(like[rows], support, s_doc, s_start, n[active][t])
                v += offset[t]
                up = v > gain[t]
                gain[t[up]], at[t[up]], gain_pi[t[up]] = v[up], j, p[up]
            won = (at >= 0) & (gain - value[active] > bar[active])
            keep = won[doc]
            d = active[won]
            chosen[d, at[won]] = True
            value[d], pi[d] = gain[won], gain_pi[won]
            like, offset, active = like[keep], offset[won], d
            doc = np.repeat(np.arange(len(active)), n[active])
            start = np.r_[0, np.cumsum(n[active])[:-1]] if len(active) else np.array([], int)
    share = np.where(chosen[:, :k], pi[:, :k], 0)
    for row, i in enumerate(some):
        mine = np.flatnonzero(chosen[row, :k])
        mine = sorted(mine.tolist(), key=lambda j: (-round(share[row, j], 6), j)) if len(mine) > 1 else mine.tolist()
        languages[i], shares[i] = mine, [round(float(share[row, j]), 6) for j in mine]
    unknown[some], total[some] = 1 - share.sum(1), value
    return languages, shares, unknown, total


def language_mixtures(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``(doc_id, languages, shares, unknown, log_likelihood, keep)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for b in runs(whole, "text"):
                langs, shares, unknown, ll = infer(column(b, "text"), m)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(b, "doc_id"),
                        pa.array([[m.languages[j] for j in x] for x in langs], pa.list_(pa.string())),
                        pa.array(shares, pa.list_(pa.float64())),
                        pa.array(unknown.round(6)),
                        pa.array(ll.round(3)),
                        pa.array(unknown <= 1 - KEEP_SHARE),
                    ],
                    names=["doc_id", "languages", "shares", "unknown", "log_likelihood", "keep"],
                )

    return pick(docs, doc_id="bigint", text="string").mapInArrow(
        score, "doc_id bigint, languages array<string>, shares array<double>, unknown double, log_likelihood double, keep boolean"
    )


def keep_known(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` made up of known languages, decided row by row in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    names = docs.columns
    at = names.index("text") if "text" in names else [c.lower() for c in names].index("text")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in runs(whole, f"__c{at}"):
                _, _, unknown, _ = infer(b.column(at).cast(pa.string()), shared.value)
                yield b.filter(pa.array(unknown <= 1 - KEEP_SHARE))

    flat = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    return flat.mapInArrow(select, flat.schema).toDF(*names)


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixtures(spark.read.parquet(f"{sf_dir}/documents.parquet"))
