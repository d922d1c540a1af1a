"""Operator 7: benchmark decontamination with one Aho-Corasick automaton.

Text and benchmark items are normalised alike: every run of other characters
than letters and digits becomes one space, then lower case. A passage is a run of at least
``GRAM`` words that stands in an item (of an item of fewer words, the whole item). The
automaton holds runs of ``ANCHOR`` words of each item, one at every
``GRAM - ANCHOR + 1``-th word, so every passage holds one of them, and a whole short item.
Each text is scanned once; from a hit the passage is followed word by word to both sides,
and the positions of its words are mapped back to character offsets of the original.
Overlapping or adjoining passages of one item are one span. That is the same as searching
all runs of ``GRAM`` words, at a tenth of the memory.

The anchors are sent to the executors up to ``PATTERN_BYTES``, of which an automaton takes
some 45 times as much memory; it is built once a Python worker. A larger benchmark is read
and searched in parts of that size, one scan each. All anchors of an item are in one part
(an item over that size has its own), so the parts do not change the spans, and the driver
holds one part at a time.

Defined cases: null, empty or wordless texts and items match nothing; items of under
``LEAST_WORDS`` words name no passage and match nothing; rows of one ``item_id``, null
included, are one item; equal items each report their own span; repeated document rows each
report their spans; a very long text is scanned whole; an empty table gives an empty result.
Extra columns are ignored by the query and carried by the stage, which drops every document
that has a span.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from strataframe.llm.text import column, runs
from strataframe.plans.runtime import pick

GRAM = 13
ANCHOR = 8
LEAST_WORDS = 2
PATTERN_BYTES = 8 << 20
WORD = r"[\p{L}\p{N}]+"
SCHEMA = "doc_id bigint, item_id bigint, start bigint, end bigint"


def normalise(texts: pa.Array) -> pa.Array:
    """Words joined and framed by single spaces; positions of words are those of the original."""
    plain = pc.replace_substring_regex(pc.fill_null(texts, ""), r"[^\p{L}\p{N}]+", " ")
    return pc.binary_join_element_wise("", pc.utf8_trim(pc.utf8_lower(plain), " "), "", " ")


class Benchmark:
    """Items as words, and their framed anchors with (item, word) of each place. The automaton is built where it is first used and not sent."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.words: list[list[str]] = []
        self.anchors: dict[str, list[tuple[int, int]]] = {}
        self.bytes = 0
        self.known: dict[str, str] = {}  # one string object a word

    def add(self, item: int | None, normal: str) -> None:
        words = [self.known.setdefault(w, w) for w in normal.split()]
        if len(words) < LEAST_WORDS:
            return
        whole = len(words) < GRAM
        for i in (0,) if whole else range(0, len(words) - ANCHOR + 1, GRAM - ANCHOR + 1):
            p = f" {' '.join(words if whole else words[i : i + ANCHOR])} "
            if p not in self.anchors:
                self.bytes += len(p.encode())
            self.anchors.setdefault(p, []).append((len(self.ids), i))
        self.ids.append(item)
        self.words.append(words)

    def __getstate__(self):
        return {"ids": self.ids, "words": self.words, "anchors": self.anchors}

    def automaton(self):
        if "_automaton" not in self.__dict__:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for p, places in self.anchors.items():
                self._automaton.add_word(p, (places, p.count(" ") - 1))
            self._automaton.make_automaton()
        return self._automaton

    def passages(self, normal: str) -> Iterator[tuple[int | None, int, int]]:
        """``(item, first word, last word)`` of each passage in a normalised text, in the order of their anchors."""
        hits = [(end, *value) for end, value in self.automaton().iter(normal)] if self.anchors else []
        if not hits:
            return
        text = normal.split()
        ends = np.cumsum([len(w) + 1 for w in text]).tolist()  # position of the space after each word
        done: dict[tuple[int, int], int] = {}  # (item, shift) -> last word seen to
        for end, places, n in hits:
            last = bisect_right(ends, end) - 1
            for item, at in places:
                words, shift = self.words[item], last - n + 1 - at
                if last <= done.get((item, shift), -1):
                    continue
                a, z = last - n + 1, last
                if len(words) >= GRAM:
                    while a > 0 and a - shift > 0 and text[a - 1] == words[a - 1 - shift]:
                        a -= 1
                    while z + 1 < len(text) and z + 1 - shift < len(words) and text[z + 1] == words[z + 1 - shift]:
                        z += 1
                done[item, shift] = z
                if z - a + 1 >= min(GRAM, len(words)):
                    yield self.ids[item], a, z


def spans(benchmark: Benchmark, normal: str, original: str) -> list[tuple[int | None, int, int]]:
    """``(item, start, end)`` in characters of the original, of one text."""
    import regex

    found: dict[int | None, list[list[int]]] = {}
    for item, a, z in benchmark.passages(normal):
        found.setdefault(item, []).append([a, z])
    if not found:
        return []
    at, out = [m.span() for m in regex.finditer(WORD, original)], []
    for item, runs_of in found.items():
        merged: list[list[int]] = []
        for a, z in sorted(runs_of):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], z)
            else:
                merged.append([a, z])
        out += [(item, at[a][0], at[z][1]) for a, z in merged]
    return out


def _parts(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The benchmark in parts of about ``PATTERN_BYTES`` of anchors; at least one."""
    rows = ((r[0], r[1]) for r in pick(benchmark, item_id="bigint", text="string").filter("text is not null").orderBy("item_id").toLocalIterator())
    part, some = Benchmark(), False
    for item, mine in groupby(rows, key=lambda r: r[0]):
        if part.bytes >= PATTERN_BYTES:
            yield part
            part, some = Benchmark(), True
        for normal in normalise(pa.array([t for _, t in mine], pa.string())).to_pylist():
            part.add(item, normal)
    if part.ids or not some:
        yield part


def contaminated_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, start, end)``: half-open character offsets of each benchmark passage in each text."""
    d = pick(docs, doc_id="bigint", text="string").filter("text is not null")

    def scan(part):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in runs(whole, "text"):
                    out: list[tuple] = []
                    text, ids = column(b, "text"), column(b, "doc_id")
                    for i, normal in enumerate(normalise(text).to_pylist()):
                        if next(part.value.passages(normal), None):
                            out += [(ids[i].as_py(), *s) for s in spans(part.value, normal, text[i].as_py())]
                    cols = list(zip(*out)) or [[], [], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "item_id", "start", "end"])

        return run

    parts = [docs.sparkSession.sparkContext.broadcast(p) for p in _parts(benchmark)]
    return reduce(DataFrame.union, [d.mapInArrow(scan(p), SCHEMA) for p in parts])


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage stands, in one pass over each part's texts."""
    names = docs.columns
    at = names.index("text") if "text" in names else [c.lower() for c in names].index("text")
    flat = docs.toDF(*[f"__c{i}" for i in range(len(names))])

    def select(part):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in runs(whole, f"__c{at}"):
                    clean = [next(part.value.passages(t), None) is None for t in normalise(b.column(at).cast(pa.string())).to_pylist()]
                    yield b.filter(pa.array(clean, pa.bool_()))

        return run

    for p in [docs.sparkSession.sparkContext.broadcast(p) for p in _parts(benchmark)]:
        flat = flat.mapInArrow(select(p), flat.schema)
    return flat.toDF(*names)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Words with their offsets, all runs of GRAM words (whole short items), hits by equality, then islands of overlapping or adjoining hits.
SQL = rf"""
with tok as (
  select 'd' as kind, doc_id as id, row_number() over () as r, text,
    regexp_extract_all(text, '[\p{{L}}\p{{N}}]+') as w, regexp_split_to_array(text, '[\p{{L}}\p{{N}}]+') as s from documents where text is not null
  union all
  select 'b', item_id, row_number() over (), text, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+'), regexp_split_to_array(text, '[\p{{L}}\p{{N}}]+') from benchmark where text is not null
), item as (
  select distinct id as item_id, least(len(w), {GRAM}) as n, lower(array_to_string(w[i + 1 : i + least(len(w), {GRAM})], ' ')) as g
  from (select *, unnest(range(0, greatest(1, len(w) - {GRAM} + 1))) as i from tok where kind = 'b' and len(w) >= {LEAST_WORDS})
), sizes as (select distinct n from item
), doc as (
  select id, r, i, n, lower(array_to_string(w[i + 1 : i + n], ' ')) as g
  from (select id, r, w, n, unnest(range(0, greatest(0, len(w) - n + 1))) as i from tok, sizes where kind = 'd')
), hit as (select id, r, item_id, i as a, i + item.n - 1 as z from doc join item on doc.n = item.n and doc.g = item.g
), mark as (
  select *, max(z) over (partition by r, item_id order by a, z rows between unbounded preceding and 1 preceding) as before from hit
), island as (
  select *, sum(case when before is null or a > before + 1 then 1 else 0 end) over (partition by r, item_id order by a, z rows unbounded preceding) as k from mark
), span as (select id, r, item_id, min(a) as a, max(z) as z from island group by id, r, item_id, k
), place as (
  select span.*, w, s from span join tok on tok.r = span.r and tok.kind = 'd'
)
select id as doc_id, item_id,
  (list_sum(list_transform(s[1 : a + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1 : a], lambda x: length(x))), 0))::bigint as start,
  (list_sum(list_transform(s[1 : z + 1], lambda x: length(x))) + list_sum(list_transform(w[1 : z + 1], lambda x: length(x))))::bigint as "end"
from place
"""
