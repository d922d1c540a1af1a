"""Each operator against brute force, a round trip or held-out labels, and its defined edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataframe.llm import bpe, chat, decontaminate, html, langid, lm, quality, shards, simhash, toxicity
from strataframe.llm import text as tx

WORDS = {
    "en": "the river ran over old stones and we walked along its bank until evening came with rain".split(),
    "de": "der alte fluss lief über die steine und wir gingen am ufer entlang bis der abend kam".split(),
    "fr": "la vieille rivière coulait sur les pierres et nous marchions près de sa rive avant le soir".split(),
}
DOCS = "doc_id bigint, text string, lang string, source string"


def prose(rng, lang="en", n=60, extra=()):
    own = WORDS[lang] + [f"{lang}{i}" for i in range(40)] + list(extra)
    return " ".join(rng.choice(own) for _ in range(n))


def odd_rows(spark, rows):
    """The rows, with null, empty, blank, repeated and very long ones, and extra columns whose names clash in another case."""
    more = [(None, "a b c d e f", "en", "s"), (901, None, "en", "s"), (902, "", "en", None), (903, " \n\t ", None, "s"), (904, "longword " * 30_000, None, "s"), (904, "longword " * 30_000, None, "s")]
    df = spark.createDataFrame(rows + more, DOCS)
    return df.select("*", F.lit("x").alias("TEXT"), F.lit(5).alias("Doc_Id"), F.lit("y").alias("extra")), rows + more


def empty(spark):
    return spark.createDataFrame([], DOCS)


def near_rows(rng):
    rows = [(i, prose(rng, n=80), "en", "s") for i in range(30)]
    for i in range(10):
        w = rows[i][1].split()
        w[3] = "changed"
        rows.append((100 + i, " ".join(w), "en", "s"))
    return rows + [(200 + i, rows[0][1], "en", "s") for i in range(5)]


def brute_groups(rows):
    """Groups of row numbers by all pairs of rows."""
    fps = {}
    for r, (i, t, *_) in enumerate(rows):
        if i is not None:
            n, fp = simhash.fingerprints(pa.array([t], pa.string()))
            if n[0]:
                fps[r] = fp.view(np.uint32)[0]
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            d = np.bitwise_count(fps[a] ^ fps[b])
            if a < b and d.sum() <= simhash.MAX_DISTANCE and d.min() <= simhash.RADIUS:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for r in fps:
        groups.setdefault(find(r), []).append(r)
    return groups.values()


def brute_duplicates(rows):
    return {(rows[r][0], min(rows[x][0] for x in g)) for g in brute_groups(rows) for r in g if rows[r][0] > min(rows[x][0] for x in g)}


def sql_rows(sql, **tables):
    import duckdb

    with duckdb.connect() as c:
        for name, df in tables.items():
            c.register(name, df.toArrow())
        return sorted(c.sql(sql).fetchall(), key=str)


def test_simhash_matches_all_pairs(spark):
    df, rows = odd_rows(spark, near_rows(random.Random(1)))
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_duplicates(rows)
    assert {200, 201, 202, 203, 204} <= {i for i, _ in got}
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    ids = [r[0] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r[0] for r in rows if r[0] is not None} - {i for i, _ in got}) and ids.count(None) == 1
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.deduplicate(empty(spark)).count() == 0


def test_simhash_repeated_ids(spark):
    rng = random.Random(13)
    a, b, c = (prose(rng, n=80, extra=[f"{x}{i}" for i in range(200)]) for x in "xyz")
    rows = [(3, a, "en", "s"), (4, b, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (6, c, "en", "s"), (6, c, "en", "s"), (6, "", "en", "s")]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in simhash.near_duplicates(df).collect())
    assert got == [(5, 3), (5, 4)] == sql_rows(simhash.SQL, documents=df)
    assert sorted((r.doc_id, r.text) for r in simhash.deduplicate(df).collect()) == sorted([(3, a), (4, b), (6, c), (6, "")])


def test_simhash_collisions_over_batches():
    key = np.array([1, 1, 2, 3, 3, 3, 4, 5, 5], np.int64)
    rep = np.arange(9, dtype=np.int64)
    for cut in range(1, 9):
        parts = [pa.RecordBatch.from_arrays([pa.array(key[i : i + cut]), pa.array(rep[i : i + cut])], names=["key", "rep"]) for i in range(0, 9, cut)]
        assert [x for b in simhash._collisions(iter(parts)) for x in b.column(0).to_pylist()] == [[0, 1], [3, 4, 5], [7, 8]]


def brute_shards(rows, target):
    import hashlib

    code = lambda s: -1 if s is None else int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    pts = [((len((t or "").encode())), i if i is not None else -1, code(lang), code(src)) for i, t, lang, src in rows]
    whole = [max(p[d] for p in pts) - min(p[d] for p in pts) for d in range(4)]
    out = {}

    def split(node, mine):
        width = [(max(pts[k][d] for k in mine) - min(pts[k][d] for k in mine)) / whole[d] if whole[d] else 0 for d in range(4)]
        if sum(pts[k][0] for k in mine) <= target or max(width) == 0:
            out.update({k: node for k in mine})
            return
        d = width.index(max(width))
        values, run, total = sorted({pts[k][d] for k in mine}), 0, sum(pts[k][0] for k in mine)
        for v in values:
            run += sum(pts[k][0] for k in mine if pts[k][d] == v)
            if 2 * run >= total:
                break
        cut = v - 1 if v == values[-1] else v
        split(2 * node, [k for k in mine if pts[k][d] <= cut])
        split(2 * node + 1, [k for k in mine if pts[k][d] > cut])

    split(1, list(range(len(rows))))
    return sorted((rows[k][0] if rows[k][0] is not None else -1, out[k]) for k in out)


def test_shards_match_recursion(spark):
    rng = random.Random(2)
    df, rows = odd_rows(spark, [(i, prose(rng, n=rng.randrange(5, 200)), rng.choice(["en", "de", None]), f"s{i % 4}") for i in range(60)])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.shard) for r in shards.shard(df, 30_000).collect())
    assert got == brute_shards(rows, 30_000)
    assert shards.shard(empty(spark)).count() == 0


def toxic_rows(rng, n):
    bad = ["vilescum", "hatefilth", "trashgoblin"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 2
        w = prose(rng, n=rng.randrange(10, 80)).split()
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows(random.Random(3), 300)
    df, _ = odd_rows(spark, rows)
    net = toxicity.train(df, spark.createDataFrame(labels[:200], "doc_id bigint, toxic int"))
    got = toxicity.toxicity(df, net).collect()
    by = {r.doc_id: r for r in got}
    assert np.mean([by[i].toxic == bool(y) for i, y in labels[200:]]) >= 0.9
    assert len(got) == 306 and by[901].score is None and by[902].n_windows == 0 and by[903].toxic is False
    assert by[904].n_windows == 1 + -(-(30_000 - toxicity.WINDOW) // toxicity.STRIDE)
    none = toxicity.train(df, spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int"))
    assert none is None and toxicity.toxicity(df, None).filter("toxic").count() == 0
    assert toxicity.toxicity(empty(spark), net).count() == 0


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    net = toxicity._new({"a": 1, "b": 2})
    net = net._replace(**{k: getattr(net, k).astype(np.float64) for k in toxicity.PARTS})
    at, mask = rng.integers(0, 3, (5, 4)), np.ones((5, 4))
    mask[3:, 1] = 0
    y, rows, grams = np.array([0, 1, 1, 0]), np.array([0, 1, 2]), [np.array([5, 6]), np.array([7]), np.array([8, 9, 5])]
    f = lambda: toxicity.gradients(net, rows, grams, at, mask, y)
    _, g = f()
    for k in toxicity.PARTS[2:]:
        p = getattr(net, k)
        i = tuple(rng.integers(0, s) for s in p.shape)
        old, eps = p[i], 1e-3
        p[i] = old + eps
        up = f()[0]
        p[i] = old - eps
        down = f()[0]
        p[i] = old
        assert (up - down) / (2 * eps) == pytest.approx(g[k][i], rel=1e-2, abs=2e-6), k


def test_toxicity_windows_match_a_plain_loop():
    rng = np.random.default_rng(4)
    words = ["aa", "bb", "river", "größe", "x"]
    net = toxicity._new({"aa": 1, "river": 2})
    net = net._replace(**{k: (getattr(net, k) + rng.normal(0, 0.3, getattr(net, k).shape)).astype(np.float32) for k in toxicity.PARTS if k != "gram"})
    offsets = np.array([0, 3, 3, 50, 51])
    ids = rng.integers(0, len(words), 51).astype(np.int32)
    start, length, doc = toxicity.windows(offsets)
    assert sorted({int(i) for s, n in zip(start, length) for i in range(s, s + n)}) == list(range(51)) and set(doc.tolist()) == {0, 2, 3}
    x, hid = toxicity.inputs(net, words).astype(float), toxicity.HIDDEN
    sig = lambda v: 1 / (1 + np.exp(-v))
    want = []
    for s, n in zip(start, length):
        states = np.zeros((n, 2 * hid))
        for d in (0, 1):
            h = np.zeros(hid)
            for t in range(n) if d == 0 else reversed(range(n)):
                p, r = x[ids[s + t]] @ net.wx[d] + net.b[d], h @ net.wh[d]
                z, rs = sig(p[:hid] + r[:hid]), sig(p[hid : 2 * hid] + r[hid : 2 * hid])
                h = (1 - z) * np.tanh(p[2 * hid :] + rs * r[2 * hid :]) + z * h
                states[t, d * hid : (d + 1) * hid] = h
        e = np.exp(np.tanh(states @ net.att) @ net.query)
        want.append(sig((e / e.sum()) @ states @ net.out[:-1] + net.out[-1]))
    assert toxicity.score_windows(net, words, ids, start, length) == pytest.approx(want, abs=1e-5)


def test_lm_scores(spark):
    rng = random.Random(4)
    phrase = [("alpha beta gamma delta " * 20).strip() for _ in range(60)]
    rows = [(i, p, "en", "s") for i, p in enumerate(phrase)]
    jumbled = phrase[0].split()
    rng.shuffle(jumbled)
    df, _ = odd_rows(spark, [*rows, (500, " ".join(jumbled), "en", "s")])
    by = {r.doc_id: r for r in lm.pseudo_likelihood(df).collect()}
    assert by[3].mean_log_prob > by[500].mean_log_prob  # words in their usual places are likelier
    assert by[901].n_tokens == 0 and by[901].log_prob == 0 and by[902].mean_log_prob is None and by[904].n_tokens == 30_000
    assert lm.pseudo_likelihood(empty(spark)).count() == 0


def test_lm_tells_rare_words_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(5000)), "en", "s")], DOCS)
    assert len(lm.vocabulary(lm.encode(df))[0]) == 5000  # every word over the share has an id
    monkeypatch.setattr(lm, "WORD_SHARE", 0.01)
    bucket: dict[int, list[str]] = {}
    for i in range(500):
        bucket.setdefault(lm._bucket(f"w{i}"), []).append(f"w{i}")
    a, b, *_ = next(x for x in bucket.values() if len(x) > 1)
    rows = [(i, "common " * 50, "en", "s") for i in range(20)] + [(50, a, "en", "s"), (51, a, "en", "s"), (52, a, "en", "s"), (53, b, "en", "s"), (None, f"{a} {a}", "en", "s")]
    by = {r.doc_id: r for r in lm.pseudo_likelihood(spark.createDataFrame(rows, DOCS)).collect()}
    assert by[50].log_prob == by[51].log_prob and by[50].log_prob - by[53].log_prob == pytest.approx(np.log(5), abs=2e-3)


def test_lm_words_stay_in_arrow():
    texts = [None, "", " \n\t ", "The (the) THE, «the» -- !!! ß\u00a0Straße\u2003x", "...", "Ünder under. 'under' \x1fy", "x " * 5 + "-"]
    for some in (texts, ["a b", "b"], ["--"], []):
        offsets, ids, words = lm._words(pa.array(["left out", *some], pa.string())[1:])
        want = tx.tokenize(pa.array(some, pa.string()))
        want = tx.remap(want, [x.strip(lm.OUTER) for x in want.words])
        assert isinstance(words, pa.Array) and words.to_pylist() == want.words
        assert ids.tolist() == want.ids.tolist() and offsets.tolist() == want.offsets.tolist()
    known = pa.array(["the", "ß"])
    for words in (["ß", "rare", "the", "größe", "", "\U0001f600"], ["the"], []):
        for own in (known, known[:0]):
            index = {x: lm.SPECIAL + i for i, x in enumerate(own.to_pylist())}
            assert lm.vocabulary_ids(pa.array(["left out", *words])[1:], own).tolist() == [index.get(x) or lm._bucket(x) for x in words]


def test_lm_shares_need_no_python(spark):
    encoded = lm.encode(spark.createDataFrame([(1, "a b b c c c", "en", "s"), (2, "c b d", "en", "s")], DOCS))
    rare = spark.createDataFrame([("a", -1.0), ("d", -2.0)], "word string, log_share double")
    shares = lm.rare_shares(encoded, rare)
    words = {(r.run, i): x for r in encoded.collect() for i, x in enumerate(r.words)}
    assert sorted((words[r.run, r.i], r.log_share) for r in shares.collect()) == [("a", -1.0), ("d", -2.0)]
    assert "Arrow" not in shares._jdf.queryExecution().executedPlan().toString()


def test_lm_row_sums():
    rng = np.random.default_rng(5)
    g, order = rng.normal(size=(300, 6)), rng.permutation(300)[:280]
    first = np.array([0, 1, 2, 5, 8, 11, 12, 60, 62, 64, 66, 200])
    sums, by = lm._row_sums(g, order, first)
    want = [g[order[a:b]].sum(0) for a, b in zip(first, [*first[1:], 280])]
    assert sorted(by.tolist()) == list(range(len(first))) and sums == pytest.approx(np.array(want)[by])


def lm_run(rng, texts, size=200):
    ids = np.array([i for n in texts for i in rng.integers(1, lm.SPECIAL + size, n)], np.int32)
    return lm.padded(ids, np.cumsum(texts))


def test_lm_trains_on_every_word():
    ids, at = lm_run(np.random.default_rng(1), [1, 2, 0, 700, 3, 5000, 1])
    trainer, seen = lm.Trainer(lm.initial([1] * 200, 300), lm.RATE[0]), []
    trainer.batch = lambda near: seen.extend(near[:, lm.REACH : -lm.REACH].ravel().tolist())
    for r in range(lm.ROUNDS):
        trainer.round(np.arange(len(ids), dtype=np.int32), r)  # the places themselves as ids
    assert sorted(i for i in seen if i in set(at.tolist())) == at.tolist()  # each once


def lm_brute(net, ids, place):
    """The log-probability of one word, by the plain formulas in double precision."""
    h = net.bias.astype(float).copy()
    for i, p in enumerate(lm.PLACES):
        h += net.context[ids[place + p], i * lm.HIDDEN : (i + 1) * lm.HIDDEN]
    h = np.r_[np.tanh(h), 1]
    c = int(np.searchsorted(net.cuts, ids[place], "right")) - 1
    one, two = net.classes @ h, net.members[net.cuts[c] : net.cuts[c + 1]] @ h
    return one[c] - np.log(np.exp(one).sum()) + two[ids[place] - net.cuts[c]] - np.log(np.exp(two).sum())


def test_lm_matches_plain_formulas():
    ids, at = lm_run(np.random.default_rng(2), [3, 0, 900, 1])
    net = lm.initial(sorted(range(1, 201), reverse=True), 30_000)
    trainer = lm.Trainer(net, 0.4)
    for r in range(lm.ROUNDS):
        trainer.round(ids, r)
    for n in (net, trainer.net, trainer.net._replace(members=trainer.net.members * 90)):  # the last needs the guard against overflow
        assert lm.log_probabilities(n, ids, at) == pytest.approx([lm_brute(n, ids, i) for i in at], abs=2e-3, rel=1e-4)


def test_lm_gradients():
    ids, at = lm_run(np.random.default_rng(3), [5, 30])
    net = lm.Net(*[x.astype(np.float64) for x in lm.initial(list(range(200, 0, -1)), 25_000)[:4]], lm.initial(list(range(200, 0, -1)), 25_000).cuts)
    trainer = lm.Trainer(net, 0.4)
    _, ((context, rows), *rest) = trainer.gradients(lm.stretches(ids))
    full = np.zeros_like(net.context)
    full[rows] = context
    loss = lambda: -sum(lm_brute(trainer.net, ids, i) for i in at)
    word = int(ids[at[7]])
    for part, grad, where in [(0, full, (word, 5)), (0, full, (word, 70)), (1, rest[0], (3,)), (2, rest[1], (1, 4)), (2, rest[1], (0, lm.HIDDEN)), (3, rest[2], (word, 2))]:
        p, eps = trainer.net[part], 1e-5
        old = p[where]
        p[where] = old + eps
        up = loss()
        p[where] = old - eps
        down = loss()
        p[where] = old
        assert (up - down) / (2 * eps) == pytest.approx(grad[where], rel=1e-3, abs=1e-5)


def test_lm_is_a_distribution():
    net = lm.initial([5, 3, 1], 20)
    ids = np.array([0, 0, 65, 66, 65, 66, 0, 0], np.int32)
    total = 0.0
    for w in range(1, len(net.members)):
        ids[4] = w
        total += np.exp(lm.log_probabilities(net, ids, np.arange(2, 6))[2])
    nothing = np.exp(lm_brute(net, np.r_[ids[:4], 0, ids[5:]], 4))  # the place outside a document, which no word takes
    assert total + nothing == pytest.approx(1, abs=1e-3)


CHAT = "conv_id bigint, turn bigint, role string, text string"


def test_chat(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", None), (1, 2, "assistant", None),
        (2, 0, "user", "q"), (2, 1, "user", "q"),
        (3, 0, "user", "q"), (4, None, "user", "q"), (5, 0, None, "q"), (6, 0, "user", "a"), (6, 0, "user", "b"),
        (None, 0, "user", "x"),
    ]
    df = spark.createDataFrame(rows, CHAT).select("*", F.lit("x").alias("TEXT"), F.lit(1).alias("TURN"))
    got = chat.format_chats(df).orderBy("conv_id", "segment").collect()
    one = [(r.role, r.text, r.loss) for r in got if r.conv_id == 1]
    assert one == [
        ("system", "<|system|>\n", False), ("system", "s", False), ("system", "<|end|>\n", False), ("user", "<|user|>\n", False), ("user", "q", False), ("user", "<|end|>\n", False),
        ("assistant", "<|assistant|>\n", False), ("assistant", "", True), ("assistant", "<|end|>\n", True),
    ]
    errors = {r.conv_id: r.error for r in got if r.error}
    assert errors == {2: "turn 1: user after user", 3: "ends in user", 4: "no turn number", 5: "turn 0: no role after start", 6: "repeated turn 0"}
    assert chat.format_chats(spark.createDataFrame([], CHAT)).count() == 0


def test_quality(spark):
    rng = random.Random(5)
    good = [(i, prose(rng, n=80), "en", "s") for i in range(80)]
    bad = [(100 + i, "#@!$ %^&* {}<> " * 20, "en", "s") for i in range(10)] + [(120 + i, "same same same same same same same same same same same same", "en", "s") for i in range(5)]
    df, rows = odd_rows(spark, good + bad)
    got = quality.quality_scores(df).collect()
    kept = {r.doc_id for r in got if r.keep}
    assert len(got) == len(rows) and set(range(80)) <= kept and not kept & {r[0] for r in bad}
    stage = quality.keep_good(df)
    assert stage.columns == df.columns and sorted(str(r[0]) for r in stage.collect()) == sorted(str(r.doc_id) for r in got if r.keep)
    assert quality.quality_scores(empty(spark)).count() == 0 and quality.keep_good(empty(spark)).count() == 0


def test_quality_weighs_votes(spark):
    rng = random.Random(12)
    good = [(i, "\n".join(prose(rng, n=20) for _ in range(6)), "en", "s") for i in range(200)]
    marked = [(300 + i, " ".join(w + "*" * 5 for w in prose(rng, n=60).split()), "en", "s") for i in range(12)]
    lone = [(400, "\n".join(["a line stands here again"] * 5 + [prose(rng, n=200), prose(rng, n=200)]), "en", "s")]  # few characters, but most lines repeat
    got = {r.doc_id: r for r in quality.quality_scores(spark.createDataFrame(good + marked + lone, DOCS)).collect()}
    bad = lambda r: [k for k in quality.RULES if r[k] == 0]
    assert bad(got[400]) == ["lines"] and got[400].keep  # one bad vote, outvoted by many good ones
    assert all(len(bad(got[i[0]])) >= 2 and not got[i[0]].keep for i in marked) and all(got[i[0]].keep for i in good)


def test_quality_estimate_against_plain_bayes():
    patterns = [((1, 1, 1), 900), ((0, 0, 1), 40), ((1, 1, 0), 30), ((None, 0, 0), 6), ((None, None, None), 5)]
    prior, right, q = quality.estimate(patterns)
    (a, w), (b, v) = quality.PRIOR_GOOD, quality.PRIOR_BAD
    p = {x: 0.1 if x.count(0) >= quality.AGREE else 0.9 for x, _ in patterns}
    rows = [x for x, n in patterns for _ in range(n)]  # row by row, without counting patterns
    for _ in range(quality.ROUNDS):
        share = (sum(p[x] for x in rows) + 0.5) / (len(rows) + 1)
        rates = []
        for r in range(3):
            own = [x for x in rows if x[r] is not None]
            rates.append(((sum(p[x] for x in own if x[r]) + a) / (sum(p[x] for x in own) + a + w), (sum(1 - p[x] for x in own if not x[r]) + b) / (sum(1 - p[x] for x in own) + b + v)))
        for x in p:
            good = share * np.prod([rates[r][0] if x[r] else 1 - rates[r][0] for r in range(3) if x[r] is not None])
            bad = (1 - share) * np.prod([1 - rates[r][1] if x[r] else rates[r][1] for r in range(3) if x[r] is not None])
            p[x] = good / (good + bad)
    assert prior == pytest.approx(share) and q == pytest.approx(p) and [x for y in right for x in y] == pytest.approx([x for y in rates for x in y])
    assert q[(0, 0, 1)] < 0.5 < q[(1, 1, 0)] and q[(None, None, None)] == pytest.approx(prior, abs=1e-3)
    assert quality.estimate([]) == (0.5, [], {})


def test_decontamination(spark):
    import regex

    rng = random.Random(6)
    item = " ".join(f"Frage{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item), (2, "Short Größe item"), (3, None), (4, ""), (5, "short größe item")], "item_id bigint, text string").select("*", F.lit("q").alias("TEXT"))
    upper = item.upper().replace(" ", ", ")
    rows = [(1, prose(rng) + " " + upper + "! " + prose(rng), "en", "s"), (2, "x short, größe -- ITEM y", "en", "s"), (3, " ".join(item.split()[5:17]), "en", "s"), (4, " ".join(item.split()[4:20]), "en", "s"), (5, prose(rng), "en", "s")]
    df, _ = odd_rows(spark, rows)
    got = {(r.doc_id, r.item_id, r.start, r.end) for r in decontaminate.contaminated_spans(df, bench).collect()}
    text = {i: t for i, t, *_ in rows}
    assert {(d, i) for d, i, *_ in got} == {(1, 1), (2, 2), (2, 5), (4, 1)}
    for d, i, a, z in got:
        words = regex.findall(r"[\p{L}\p{N}]+", text[d][a:z].lower())
        want = item.lower().split() if i == 1 else ["short", "größe", "item"]
        assert words == want or words == want[4:20]
    left = decontaminate.keep_clean(df, bench)
    assert left.columns == df.columns and {r[0] for r in left.collect()} == {3, 5, None, 901, 902, 903, 904}
    assert decontaminate.contaminated_spans(empty(spark), bench).count() == 0 and decontaminate.contaminated_spans(df, bench.limit(0)).count() == 0


def test_decontamination_by_parts(spark, monkeypatch):
    rng = random.Random(10)
    words = [f"{rng.choice('abcxyz')}{rng.randrange(999)}q" for _ in range(60)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[20:50])), (3, "other short item"), (4, None)], "item_id bigint, text string")
    df, _ = odd_rows(spark, [(1, "before " + " ".join(words) + " after", "en", "s"), (2, " ".join(words[10:40]) + " other short item", "en", "s"), (3, prose(rng), "en", "s")])
    find = lambda: sorted(tuple(r) for r in decontaminate.contaminated_spans(df, bench).collect())
    whole, parts = find(), len(list(decontaminate._parts(bench)))
    monkeypatch.setattr(decontaminate, "PATTERN_BYTES", 20)
    assert parts == 1 and len(list(decontaminate._parts(bench))) == 3
    assert find() == whole and len(whole) == 5
    assert {r[0] for r in decontaminate.keep_clean(df, bench).collect()} == {3, None, 901, 902, 903, 904}


def brute_spans(items, text):
    """Spans by comparing every run of words of the text with every run of every item."""
    import regex

    split = lambda s: [(m.group().lower(), *m.span()) for m in regex.finditer(r"[\p{L}\p{N}]+", s or "")]
    words, covered = split(text), {}
    for item, other in items:
        own = [w for w, *_ in split(other)]
        n = min(decontaminate.GRAM, len(own))
        if n < decontaminate.LEAST_WORDS:
            continue
        runs = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        covered.setdefault(item, set()).update((i, i + n - 1) for i in range(len(words) - n + 1) if tuple(w for w, *_ in words[i : i + n]) in runs)
    out = []
    for item, hits in covered.items():
        merged = []
        for a, z in sorted(hits):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(z, merged[-1][1])
            else:
                merged.append([a, z])
        out += [(item, words[a][1], words[z][2]) for a, z in merged]
    return sorted(out, key=str)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(14)
    some = lambda n, k=6: " ".join(rng.choice("abcdefghijkl"[:k]) for _ in range(n))  # few words, so that parts of items repeat and overlap
    items = [(i % 9 if i % 5 else None, some(rng.randrange(0, 60), rng.randrange(1, 12))) for i in range(40)]
    part = decontaminate.Benchmark()
    for item, text in items:
        part.add(item, decontaminate.normalise(pa.array([text]))[0].as_py())
    found = 0
    for _ in range(150):
        text = ", ".join([some(rng.randrange(0, 30), 12), *[items[rng.randrange(40)][1][a : a + rng.randrange(80)] for a in [rng.randrange(40)]], some(rng.randrange(0, 30))])
        got = sorted(decontaminate.spans(part, decontaminate.normalise(pa.array([text]))[0].as_py(), text), key=str)
        assert got == brute_spans(items, text)
        found += len(got)
    assert found > 50


def test_decontamination_null_ids_and_short_items(spark):
    rng = random.Random(15)
    leak = " ".join(f"Item{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"{prose(rng)} {leak} {prose(rng)}", "en", "s"), (2, "yes, the river ran", "en", "s"), (None, leak, "en", "s")], DOCS)
    bench = spark.createDataFrame([(None, leak), (7, "yes"), (8, "River ran")], "item_id bigint, text string")
    got = sorted(map(str, (tuple(r) for r in decontaminate.contaminated_spans(docs, bench).collect())))
    assert got == sorted(map(str, sql_rows(decontaminate.SQL, documents=docs, benchmark=bench))) and len(got) >= 3
    assert decontaminate.keep_clean(docs, bench).count() == 0


def test_html(spark):
    body = " ".join(["A long sentence of real content stands here."] * 6)
    page = f"<html><head><title>t</title><script>var x = 1;</script></head><body><ul><li><a href='#'>Home</a></li><li><a href='#'>About</a></li></ul><p>{body}</p><p>{body}<br>{body}</p><div><a href='#'>Imprint</a> <a href='#'>Terms</a></div></body>"
    pages = [(1, page), (2, None), (3, ""), (4, "plain text"), (5, "<p>unclosed <b>tag"), (6, page), (7, "<p>x</p>" * 20_000)]
    df = spark.createDataFrame(pages, "page_id bigint, html string").select("*", F.lit("z").alias("HTML"))
    by = {r.page_id: r for r in html.extract_pages(df).collect()}
    assert by[1].text == "\n".join([body] * 3) == by[6].text and by[1].n_content_lines == 3
    assert by[2].text is None and by[3].text == "" and by[4].text == "plain text" and "unclosed" in by[5].text and by[7].n_lines == 20_000
    assert html.extract_pages(spark.createDataFrame([], "page_id bigint, html string")).count() == 0


@pytest.mark.parametrize(
    "tag", ["<a href='/x'>Top", "<a name=x>", "<div><a href='/x'>Top</div>", "<a href='/x'><a href='/y'>Top</a>", "<form><select><option>One<option>Two</form>", "<select><option>One", "<noscript><img src=x>", "<div><noscript>No</div><noscript>x</noscript>", "<template>"]
)
def test_html_unclosed(tag):
    body = " ".join(["A long sentence of real content stands here."] * 6)
    lines = html.lines_of(f"<body>{tag}<p>{body}</p><div>{body}</div></body>")
    assert [(t, linked) for t, _, linked in lines if t.endswith(body)] == [(body, 0)] * 2


def test_html_head_and_endless_markup():
    import time

    assert html.lines_of("<head><title>T</title>hidden</head><body><p>shown</p></body>") == [("shown", 7, 0)]
    assert [x for x, *_ in html.lines_of("<head><title>T</title><p>never closed</p>")] == ["never closed"]
    assert [x for x, *_ in html.lines_of("<p>shown</p><script>var hidden = 1;")] == ["shown"]
    assert [x for x, *_ in html.lines_of("<p>one</p>2 &lt; 3 <b")] == ["one", "2 < 3 <b"]
    for piece in ("<a ", "<a/", '<a x="', "<a b=", "<!--", "</", "<?x ", "<div>", "<a href=x>"):
        began = time.time()
        html.extract(piece * ((1 << 20) // len(piece)))
        assert time.time() - began < 15, piece  # a megabyte; each takes far less than this unless the time is quadratic


def test_html_against_built_pages():
    """Pages built from known lines, and the ratios by plain loops."""
    rng = random.Random(16)
    for _ in range(30):
        want, page = [], "<html><head><title>none</title></head><body>"
        for _ in range(rng.randrange(1, 12)):
            text, linked = prose(rng, n=rng.randrange(1, 40)), rng.random() < 0.3
            tag = rng.choice(["p", "div", "li", "h2"])
            inner = f"<a href='/x'>{text}</a>" if linked else f"<b>{text}</b>" if rng.random() < 0.3 else text
            page += f"<{tag}>{inner}</{tag}>"
            want.append((text, len(text) if linked else 0))
        lines = html.lines_of(page + "</body></html>")
        assert [(x, n) for x, _, n in lines] == want
        ratio = [np.log1p(len(x) / max(1, k)) for x, k, _ in lines]
        weight = lambda d: np.exp(-0.5 * (d / html.SIGMA) ** 2) if abs(d) <= np.ceil(3 * html.SIGMA) else 0.0
        smooth = [sum(weight(i - j) * v for j, v in enumerate(ratio)) / sum(weight(i - j) for j in range(len(ratio))) for i in range(len(ratio))]
        assert html.smooth(np.array(ratio)) == pytest.approx(smooth)
        cut = (min(smooth) + max(smooth)) / 2
        for _ in range(50):
            low, high = [x for x in smooth if x < cut], [x for x in smooth if x >= cut]
            if not low or not high:
                break
            cut = (np.mean(low) + np.mean(high)) / 2
        if max(smooth) - min(smooth) > 1e-9:
            text, n, k = html.extract(page)
            kept = [x for (x, _, linked), v in zip(lines, smooth) if v >= cut - 1e-9 and linked <= 0.5 * len(x)]
            assert n == len(lines) and text == "\n".join(kept) and k == len(kept)


def test_language_mixture_held_out_and_plain_em(spark):
    rng = random.Random(17)
    draw = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    train = spark.createDataFrame([(i, draw(lang, 60), lang, "s") for i, lang in enumerate([*WORDS] * 10)], DOCS)
    model = langid.fit(train)
    for lang in WORDS:  # texts that were not in the sample
        texts = [draw(lang, 25) for _ in range(20)]
        assert all(x == [model.languages.index(lang)] for x in langid.infer(pa.array(texts), model)[0])
    k = len(model.languages)
    for _ in range(10):
        a, b = rng.sample([*WORDS], 2)
        text = draw(a, 40) + " " + draw(b, rng.randrange(20, 60))
        languages, shares, unknown, _ = (x[0] for x in langid.infer(pa.array([text]), model))
        like = []
        for w in text.lower().split():  # word by word
            grams, size = langid._trigrams([w.strip(langid.OUTER)])
            like.append([np.exp(sum(model.table[j][g] for g in grams)) for j in range(k)] + [2.0 ** (-langid.BITS * int(size[0]))])
        sources = [*languages, k]
        p = {j: 1 / len(sources) for j in sources}
        for _ in range(langid.ITERATIONS):
            parts = [[p[j] * x[j] for j in sources] for x in like]
            p = {j: float(np.mean([x[i] / sum(x) for x in parts])) for i, j in enumerate(sources)}
        assert sorted(languages) == sorted(model.languages.index(x) for x in (a, b))
        assert [p[j] for j in languages] == pytest.approx(shares, abs=2e-3) and p[k] == pytest.approx(unknown, abs=2e-3)


def test_samples_are_exact_and_the_same(spark):
    from strataframe.llm import sample

    rows = [(i % 700, "ab"[i % 10 == 0]) for i in range(3000)] + [(5, "a")] * 4000 + [(None, "a"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string")
    hashes = {r[0]: r[1] for r in df.select("doc_id", F.xxhash64("doc_id")).distinct().collect()}
    for k in (3, 40, 2000):
        got = {(r.lang, r.doc_id) for r in sample.smallest_hashes(df, "lang", k).collect()}
        want = {(lang, i) for lang in "ab" for i in sorted({i for i, x in rows if x == lang and i is not None}, key=lambda i: (hashes[i], i))[:k]}
        assert got == want
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (3, 1), (4, 1), (4, 1)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame([(1, "x", None, None), (2, "y", None, None), (2, "z", None, None), (3, "w", None, None), (4, None, None, None)], DOCS)
    seen = []
    from unittest import mock

    with mock.patch.object(toxicity, "fit", lambda texts, y: seen.append((texts, y))):
        for _ in range(2):
            toxicity.train(docs.repartition(5), labels.repartition(3))
    assert seen[0] == seen[1] and seen[0][1] == [0, 1] and seen[0][0][0] == "x" and seen[0][0][1] in "yz"


def test_language_mixture(spark):
    rng = random.Random(7)
    train = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(80)), lang, "s") for i, lang in enumerate([*WORDS] * 20)]
    mixed = " ".join(rng.choice(WORDS["de"]) for _ in range(60)) + " " + " ".join(rng.choice(WORDS["fr"]) for _ in range(60))
    df, _ = odd_rows(spark, [*train, (500, mixed, None, "s"), (501, "0x9f zzqqkk 7781 xkcdqq wvvx " * 10, None, "s")])
    by = {r.doc_id: r for r in langid.language_mixtures(df).collect()}
    assert all(by[i].languages == [lang] and by[i].keep for i, _, lang, _ in train)
    assert sorted(by[500].languages) == ["de", "fr"] and sum(by[500].shares) == pytest.approx(1, abs=0.1)
    assert by[501].keep is False and by[901].languages == [] and by[903].keep is False
    assert langid.language_mixtures(empty(spark)).count() == 0
    kept = {r[0] for r in langid.keep_known(df).collect()}
    assert {i for i, *_ in train} | {500} <= kept and 501 not in kept and 901 not in kept


def test_language_of_a_small_share():
    rng = random.Random(11)
    train = {lang: " ".join(rng.choice(own) for _ in range(4000)) for lang, own in WORDS.items()}
    counts = np.full((len(train), 1 << langid.BITS), 0.05)
    for i, text in enumerate(train.values()):
        np.add.at(counts[i], langid._trigrams(text.split())[0], 1)
    model = langid.Model([*train], np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32))
    passage = " ".join(rng.choice(WORDS["fr"]) for _ in range(200))
    for n in (2_000, 20_000):  # 9 % and 1 % of the words
        text = " ".join(rng.choice(WORDS["en"]) for _ in range(n)) + " " + passage
        languages, shares, *_ = langid.infer(pa.array([text]), model)
        assert languages == [[0, 2]] and shares[0][1] == pytest.approx(200 / (n + 200), rel=0.3)


def test_bpe_round_trip(spark):
    enc = bpe.encoding(bpe.read_ranks())
    rng = random.Random(8)
    long = " ".join(rng.choice(["word", "größe", "12a", "x7", "  \n", "日本", "🙂", "can't"]) for _ in range(30_000))
    assert bpe.encode(enc, long).tolist() == enc.encode_ordinary(long)
    blank = "a" + " " * 70_000 + "b"
    assert bpe.decode(enc, bpe.encode(enc, blank).tolist()) == blank.encode()
    df, rows = odd_rows(spark, [(1, long, "en", "s"), (2, "<|endoftext|> x", "en", "s"), (3, "é", "fr", "s")])
    got = bpe.encode_documents(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, *_ in rows:
        if i is not None and t is not None:
            assert by[i].round_trip and by[i].n_tokens == len(by[i].tokens) and enc.decode_bytes(by[i].tokens) == t.encode()
    assert by[901].tokens is None and by[901].round_trip is None and by[902].tokens == []
    assert bpe.encode_documents(empty(spark)).count() == 0


def brute_bpe(ranks, text):
    """Pairs of lowest rank are merged first, in each piece of the pattern."""
    import regex

    out = []
    for piece in regex.findall(bpe.PATTERN, text):
        parts = [bytes([b]) for b in piece.encode()]
        while True:
            best = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))) if len(parts) > 1 else (1 << 60, 0)
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += [ranks[p] for p in parts]
    return out


def test_bpe_against_merges_by_rank(monkeypatch):
    import base64

    raw = bpe.read_ranks()
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
    enc = bpe.encoding(raw)
    rng = random.Random(18)
    bits = ["word", "größe", "12a", "x7y", "  ", " \n", "日本語", "🙂", "can't", "!!", "\t", "AB", "é", "1234", "'ll"]
    monkeypatch.setattr(bpe, "PIECE_CHARS", 30)
    for _ in range(200):
        text = "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(60)))
        want = brute_bpe(ranks, text)
        got = [i for p, whole in bpe.pieces(text, 30) for i in (enc._encode_single_piece(p) if whole else enc.encode_ordinary(p))]
        assert got == want == bpe.encode(enc, text).tolist()
    for blank in ("a" + " " * 100 + "b", " " * 90, "a" + "\n" * 77, " " * 40 + "\n" * 40 + "x"):
        assert [i for p, whole in bpe.pieces(blank, 30) for i in (enc._encode_single_piece(p) if whole else enc.encode_ordinary(p))] == brute_bpe(ranks, blank)


def test_runs_cover_all_rows():
    b = pa.RecordBatch.from_arrays([pa.array([None, "", "x" * 50, "y", "z" * 9])], names=["text"])
    assert [r for part in tx.runs(b, "text", 10) for r in part.column(0).to_pylist()] == b.column(0).to_pylist()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    rows = [(i, prose(rng, lang, 90, [f"{lang}word{rng.randrange(9999)}x" for _ in range(60)]), lang, "s") for i, lang in enumerate([*WORDS] * 14)]
    leak = " ".join(f"Item{i}" for i in range(20))
    rows += [(50, rows[0][1], rows[0][2], "s"), (51, rows[1][1] + " " + leak, rows[1][2], "s"), (52, "#@!$ %^&* {}<> " * 20, "en", "s"), (53, None, "en", "s")]
    d = spark.createDataFrame(rows, DOCS).withColumn("n_chars", F.length("text").cast("bigint"))
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not got.keys() & {50, 51, 52, 53} and len(got) >= 36 and all(r.round_trip for r in got.values())
    odd = tmp_path / "odd"
    long = " ".join(f"{rows[0][1]} {i}x" for i in range(900))
    more = [(60, "", "en", "s"), (61, None, None, None), (None, prose(rng, "de", 90, ["nurhier"]), "de", "s"), (62, long, "en", "s"), (63, rows[3][1], "en", "s"), (63, rows[3][1], "en", "s"), (3, prose(rng, "en", 90, ["elsewhere"]), "en", "s")]
    wide = spark.createDataFrame(rows + more, DOCS).withColumn("n_chars", F.length("text").cast("bigint")).select("*", F.lit(1).alias("extra"))
    wide.write.parquet(str(odd / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(str(odd / "benchmark.parquet"))
    docs = spark.read.parquet(str(odd / "documents.parquet")).withColumnRenamed("extra", "TEXT_")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(odd))
        assert kept.columns == docs.columns, name
        before, docs = docs.count(), kept
        assert kept.count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(odd)).collect()
    assert [r.doc_id for r in last].count(3) == 2 and [r.doc_id for r in last].count(63) == 0 and {None, 62} <= {r.doc_id for r in last} and not {60, 61} & {r.doc_id for r in last}
    nothing = tmp_path / "none"
    d.limit(0).write.parquet(str(nothing / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(nothing / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(nothing)).count() == 0
