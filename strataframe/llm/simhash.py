"""Operator 1: near-duplicate groups by SimHash and meet-in-the-middle ball hashing.

A document's features are its distinct words (lower case, outer punctuation
removed). Its fingerprint has ``BLOCKS`` independent 32-bit SimHashes, 256 bits
in all. Two documents are near duplicates when some block differs in at most
``RADIUS`` bits and the whole fingerprint in at most ``MAX_DISTANCE`` bits.

The search is exact for that definition: every block emits all variants within
half the radius (itself and its 32 one-bit flips), variants are shuffled, and two
blocks within the radius meet on at least one variant. Equal fingerprints are
collapsed first. Colliding sets are deduplicated and verified against the whole
fingerprint; a large colliding set is verified by breadth-first search, which
gives the same connected groups as comparing all its pairs. There is no cap.

Defined cases: a null, empty or wordless text is never a duplicate; rows with a
null ``doc_id`` take no part (a stage keeps them); rows are grouped by their texts,
so different texts of one ``doc_id`` can be in different groups and join none of them;
of a group the row with the smallest ``doc_id`` stays (then the smallest text hash, then
any one of rows that repeat it). A very long text counts whole. Extra columns are ignored
by the query and carried by the stage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.text import column, remap, runs, tokenize
from strataframe.operators.graph import connected_components
from strataframe.plans.runtime import broadcast_if_small, discard, materialize, pick

BLOCKS = 8
RADIUS = 2
MAX_DISTANCE = 40
OUTER = " \t.,;:!?\"'()[]{}<>|*#$%&/\\-_=+~^`"
LANES = [f"f{i}" for i in range(BLOCKS // 2)]

_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]

FP_SCHEMA = "doc_id bigint, text_hash bigint, n_words bigint, " + ", ".join(f"{c} bigint" for c in LANES)


def _bits(words: list[str]) -> np.ndarray:
    """The 256 SHA-256 bits of each word, each spread to a byte, eight of them in a 64-bit lane: lanes of up to 255 words can be added without a carry."""
    raw = b"".join([hashlib.sha256(w.encode()).digest() for w in words])
    return _SPREAD[np.frombuffer(raw, np.uint8)].reshape(-1, 32)


def fingerprints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct-word counts and fingerprints (n x 4 big-endian 64-bit lanes)."""
    w = tokenize(texts)
    w = remap(w, [x.strip(OUTER) for x in w.words])
    n = len(w.offsets) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(w.offsets))
    pairs = np.sort(doc * max(1, len(w.words)) + w.ids)
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    ids = (pairs % max(1, len(w.words))).astype(np.int64)
    count = np.bincount(pairs // max(1, len(w.words)), minlength=n)
    ends = np.cumsum(count)
    bits = _bits(w.words)
    out = np.zeros((n, 32), np.uint8)
    for i in np.flatnonzero(count):
        mine = ids[ends[i] - count[i] : ends[i]]
        total = np.zeros(256, np.int64)
        for a in range(0, len(mine), 255):
            total += bits[mine[a : a + 255]].sum(0).view(np.uint8)
        out[i] = np.packbits(total * 2 > count[i])
    return count, out.view(">u8").astype(np.uint64).view(np.int64).reshape(n, 4)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in runs(whole, "text"):
            count, fp = fingerprints(column(b, "text"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(count.astype(np.int64)), *[pa.array(fp[:, i]) for i in range(4)]],
                names=["doc_id", "text_hash", "n_words", *LANES],
            )


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """One row per document row with an id: ``doc_id``, a hash of its text, its number of distinct words and the fingerprint."""
    d = pick(docs, doc_id="bigint", text="string").filter("doc_id is not null")
    return d.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_fingerprint_batches, FP_SCHEMA)


def _verify_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of sorted (set, member, fingerprint) rows: those that connect what pairs within ``MAX_DISTANCE`` connect."""
    held: list[np.ndarray] = []

    def emit(rows: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
        cut = len(rows) if last else int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        return rows[:cut], rows[cut:]

    def out(rows: np.ndarray) -> pa.RecordBatch:
        src, dst = [], []
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else np.array([], int)
        for a, z in zip(starts, np.r_[starts[1:], len(rows)]):
            ids, fp = rows[a:z, 1], rows[a:z, 2:].view(np.uint64)
            left = np.arange(len(ids))
            while len(left):  # breadth-first: each visited member meets only those not yet reached
                queue, left = [left[0]], left[1:]
                while queue and len(left):
                    x = queue.pop()
                    near = np.bitwise_count(fp[left] ^ fp[x]).sum(1, dtype=np.int64) <= MAX_DISTANCE
                    hit = left[near]
                    src += [ids[x]] * len(hit)
                    dst += ids[hit].tolist()
                    queue += hit.tolist()
                    left = left[~near]
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    for b in batches:
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(np.int64))
        done, rest = emit(np.vstack(held), False)
        held = [rest]
        if len(done):
            yield out(done)
    if held and len(held[0]):
        yield out(held[0])


#: Variants that one task emits, or sorts, at most on average; a row of them takes some 30 bytes.
TASK_VARIANTS = 4 << 20


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each key that has several, of rows sorted by key and member."""
    key, rep = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def sets(key: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.r_[start, len(key)])
        take = np.repeat(size > 1, size)
        ends = np.r_[0, np.cumsum(size[size > 1])].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(rep[take]))], names=["s"])

    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        k, r = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        parts.append((k, r))
        if len(k) and k[-1] != parts[0][0][0]:  # the last key may go on in the next batch
            key, rep = (np.concatenate(x) for x in zip(*parts))
            cut = int(np.searchsorted(key, key[-1]))
            yield sets(key[:cut], rep[:cut])
            parts = [(key[cut:], rep[cut:])]
    if parts:
        yield sets(*(np.concatenate(x) for x in zip(*parts)))


def near_duplicate_edges(reps: DataFrame) -> DataFrame:
    """``(src, dst)`` between representatives (``rep`` and its fingerprint), connecting exactly the near-duplicate groups."""
    spark = reps.sparkSession
    emitted = reps.count() * BLOCKS * 33
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-emitted // TASK_VARIANTS))
    blocks = F.array(*[F.shiftrightunsigned(F.col(LANES[b // 2]), 32 * (1 - b % 2)).bitwiseAND(0xFFFFFFFF) for b in range(BLOCKS)])
    # the few bytes a fingerprint are spread before they become hundreds of variants
    variants = reps.repartition(tasks, "rep").select("rep", F.posexplode(blocks).alias("b", "v")).select(
        F.explode(
            F.expr("transform(sequence(-1, 31), k -> shiftleft(cast(b as bigint), 32) | if(k < 0, v, v ^ shiftleft(1L, k)))")
        ).alias("key"),
        "rep",
    )
    sets = variants.repartition(tasks, "key").sortWithinPartitions("key", "rep").mapInArrow(_collisions, "s array<bigint>").distinct()
    sets = materialize(sets, "collisions")
    fp = [F.col(f"x.{c}") for c in LANES]
    distance = sum(F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in LANES)
    two = (
        sets.filter("size(s) = 2")
        .select(F.col("s")[0].alias("src"), F.col("s")[1].alias("dst"))
        .join(reps.alias("x"), F.col("src") == F.col("x.rep"))
        .join(reps.alias("y"), F.col("dst") == F.col("y.rep"))
        .filter(distance <= MAX_DISTANCE)
        .select("src", "dst")
    )
    more = (
        sets.filter("size(s) > 2")
        .select(F.xxhash64("s").alias("set"), F.explode("s").alias("member"))
        .join(reps.alias("x"), F.col("member") == F.col("x.rep"))
        .select("set", "member", *fp)
        .repartition("set")
        .sortWithinPartitions("set", "member")
        .mapInArrow(_verify_sets, "src bigint, dst bigint")
    )
    return two.union(more).distinct()


class Groups(NamedTuple):
    rows: DataFrame  #: (doc_id, text_hash, keep_id, keep_hash) of each row whose group has another row, and of those that repeat a kept one
    scratch: list[DataFrame]  #: what ``rows`` reads


def duplicate_groups(docs: DataFrame) -> Groups:
    """Every row that has a duplicate, with the ``doc_id`` and text hash of its group's row that stays."""
    fps = materialize(fingerprint_table(docs), "fingerprints")
    usable = fps.filter("n_words > 0")
    first = F.struct("doc_id", "text_hash")
    byfp = usable.groupBy(*LANES).agg(F.min(first).alias("m"), F.count("*").alias("n"))
    # a number of its own for each fingerprint, as a doc_id may have several
    reps = materialize(byfp.select(F.monotonically_increasing_id().alias("rep"), *LANES, "m", "n"), "reps")
    edges = materialize(near_duplicate_edges(reps.select("rep", *LANES)).filter("src <> dst").distinct(), "edges")
    linked = materialize(connected_components(edges).select(F.col("node").alias("rep"), "component"), "components")
    grouped = reps.join(linked, "rep", "left").filter("component is not null or n > 1").withColumn("component", F.coalesce("component", "rep"))
    kept = grouped.groupBy("component").agg(F.min("m").alias("k"))
    mine = grouped.join(kept, "component").select(*LANES, "k")
    rows = usable.join(mine, LANES).select("doc_id", "text_hash", F.col("k.doc_id").alias("keep_id"), F.col("k.text_hash").alias("keep_hash"))
    return Groups(rows, [fps, reps, edges, linked])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, duplicate_of)``: each document with a text that is a near duplicate of a text of a smaller id, and the smallest id of that group."""
    found = duplicate_groups(docs)
    out = materialize(found.rows.filter("doc_id <> keep_id").select("doc_id", F.col("keep_id").alias("duplicate_of")).distinct(), "duplicates")
    for table in found.scratch:
        discard(table)
    return out


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: one row of each group stays, with all its columns."""
    found = duplicate_groups(docs)
    is_kept = (F.col("doc_id") == F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash"))
    counts = found.rows.groupBy("doc_id", "text_hash").agg(F.bool_and(is_kept).alias("stays"), F.count("*").alias("n"))
    touched = materialize(counts.filter("not stays or n > 1"), "touched")  # what goes, and what stays once
    for table in found.scratch:
        discard(table)
    names = docs.columns
    flat = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    key = F.col(f"__c{_position(names, 'doc_id')}").try_cast("bigint")
    text = F.xxhash64(F.col(f"__c{_position(names, 'text')}").try_cast("string"))
    mark = broadcast_if_small(touched.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h"), F.col("stays").alias("__stays")), 25)
    marked = flat.join(mark, (key == F.col("__id")) & (text == F.col("__h")), "left")
    once = touched.filter("stays").isEmpty()
    kept = marked.filter("__stays is null").drop("__id", "__h", "__stays")
    if once:
        return kept.toDF(*names)
    return kept.union(marked.filter("__stays").dropDuplicates(["__id", "__h"]).drop("__id", "__h", "__stays")).toDF(*names)


def _position(names: list[str], name: str) -> int:
    exact = [i for i, c in enumerate(names) if c == name]
    return (exact or [i for i, c in enumerate(names) if c.lower() == name.lower()])[0]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs of distinct fingerprints by brute force, then reachability; rows, not ids, are grouped.
SQL = f"""
with recursive docs as (select row_number() over () as r, doc_id, text from documents where doc_id is not null
), words as (
  select distinct r as doc_id, trim(w, {"' ' || chr(9) || '" + OUTER.strip().replace("'", "''") + "'"}) as w
  from (select r, unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r]+')) as w from docs)
), hashed as (select doc_id, sha256(w) as m from words where w <> ''
), nibbles as (
  select doc_id, i, strpos('0123456789abcdef', substr(m, i + 1, 1)) - 1 as v, 1 as one
  from hashed, (select unnest(range(0, 64)) as i)
), votes as (
  select doc_id, i, count(*) as n, sum(v >> 3) as s3, sum((v >> 2) & 1) as s2, sum((v >> 1) & 1) as s1, sum(v & 1) as s0
  from nibbles group by doc_id, i
), digits as (
  select doc_id, i, (case when 2 * s3 > n then 8 else 0 end) + (case when 2 * s2 > n then 4 else 0 end)
    + (case when 2 * s1 > n then 2 else 0 end) + (case when 2 * s0 > n then 1 else 0 end) as v from votes
), blocks as (
  select doc_id, i // 8 as b, sum(v * cast(power(16, 7 - i % 8) as bigint))::bigint as x from digits group by doc_id, i // 8
), fp as (select doc_id, list(x order by b) as f from blocks group by doc_id
), reps as (select f, min(doc_id) as rep from fp group by f
), near as (
  select x.rep as a, y.rep as c from reps x join reps y on x.rep < y.rep
  where {" + ".join(f"bit_count(xor(x.f[{b}], y.f[{b}]))::int" for b in range(1, 9))} <= {MAX_DISTANCE}
    and least({", ".join(f"bit_count(xor(x.f[{b}], y.f[{b}]))::int" for b in range(1, 9))}) <= {RADIUS}
), edges as (
  select a, c from near union select c, a from near
  union select fp.doc_id, rep from fp join reps using (f) where rep <> fp.doc_id
  union select rep, fp.doc_id from fp join reps using (f) where rep <> fp.doc_id
), reach as (
  select a as node, a as seen from edges
  union select reach.node, edges.c from reach join edges on reach.seen = edges.a
)
select distinct own.doc_id, least_id as duplicate_of
from (select node, min(doc_id) as least_id from reach join docs on docs.r = reach.seen group by node) g join docs own on own.r = g.node where own.doc_id > least_id
"""
