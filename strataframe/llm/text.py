"""Arrow-side text helpers shared by the operators that run in Python workers."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows of one Arrow batch are worked on in runs of about this many bytes of text, so memory follows this bound and not the batch; a single longer text forms its own run.
CHUNK_BYTES = 4 << 20


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column of that exact name, by position, as extra columns may repeat it in another case."""
    return batch.column(batch.schema.names.index(name))


def runs(batch: pa.RecordBatch, name: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` that cover all its rows, each of about ``limit`` bytes in ``name``."""
    size = pc.fill_null(pc.binary_length(column(batch, name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(at)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


class Words(NamedTuple):
    """Words of a run of texts: those of text i are ``ids[offsets[i]:offsets[i + 1]]``, indices into ``words``."""

    offsets: np.ndarray
    ids: np.ndarray
    words: list[str]


def tokenize(texts: pa.Array) -> Words:
    """Lower-cased words between white space; null and blank texts have none."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    words = coded.dictionary.to_pylist()
    if "" in words:
        keep = ids != words.index("")
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        ids = ids[keep]
    return Words(offsets, ids, words)


def remap(w: Words, new: list[str]) -> Words:
    """Rewrite each distinct word (``new[i]`` for ``w.words[i]``); words that became empty are dropped."""
    index: dict[str, int] = {}
    to = np.fromiter((index.setdefault(x, len(index)) if x else -1 for x in new), np.int32, len(new))
    ids = to[w.ids] if len(w.ids) else w.ids
    keep = ids >= 0
    offsets = np.concatenate([[0], np.cumsum(keep)])[w.offsets]
    return Words(offsets, ids[keep], list(index))


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the segments; empty ones give zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def empty_like(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
