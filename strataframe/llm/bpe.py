"""Operator 10: byte-level BPE encoding and decoding with a local rank file.

The ranks are read once on the driver and sent to the executors. A text of more
than ``PIECE_CHARS`` characters is first cut at safe boundaries, places where no
token can span because the pre-splitting pattern always ends a piece there:
before white space that follows another character, and between a letter and a
digit. The ids are those of encoding the whole text. Decoding joins the raw bytes
of the tokens, so it is exact also where a token ends inside a character.

Defined cases: a null text has null ids, zero tokens and bytes and a null round
trip; an empty text has no ids. Strings that look like special tokens are
ordinary text. Repeated rows are each encoded. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strataframe.llm.text import column, runs
from strataframe.plans.runtime import pick

RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE = r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"
PIECE_CHARS = 20_000
SCHEMA = "doc_id bigint, tokens array<int>, n_tokens bigint, n_bytes bigint, round_trip boolean"


def read_ranks(path: str = RANK_FILE) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> list[tuple[str, bool]]:
    """``text`` cut at safe boundaries into parts of about ``size`` characters, each with whether it is one unsplit piece.

    A stretch without a boundary stays whole. White space of more than ``size``
    characters would exhaust the pattern's backtracking, so it is cut out as what
    the pattern makes of it: one piece, without its last character if a word follows.
    """
    import regex

    if len(text) <= size:
        return [(text, False)]
    out: list[tuple[str, bool]] = []
    safe, blank = regex.compile(SAFE), regex.compile(r"\s{%d,}" % size)

    def plain(a: int, z: int) -> None:
        while a < z:
            m = safe.search(text, a + size, z) if a + size < z else None
            end = m.start() if m else z
            out.append((text[a:end], False))
            a = end

    at = 0
    for m in blank.finditer(text):
        end = m.end() - (m.end() < len(text))
        plain(at, m.start())
        out.append((text[m.start() : end], True))
        at = end
    plain(at, len(text))
    return out


def encode(enc, text: str) -> np.ndarray:
    parts = [
        np.array(enc._encode_single_piece(p), np.int32) if whole else enc.encode_to_numpy(p, disallowed_special=()).astype(np.int32)
        for p, whole in pieces(text)
    ]
    return np.concatenate(parts) if len(parts) != 1 else parts[0]


def decode(enc, ids) -> bytes:
    return enc.decode_bytes(ids)


def encode_documents(docs: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """``(doc_id, tokens, n_tokens, n_bytes, round_trip)`` for every row; the last says that decoding gave the text's bytes."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value)
        for whole in batches:
            for b in runs(whole, "text", 4 << 20):
                ids, good, sizes = [], [], []
                for t in column(b, "text").to_pylist():
                    if t is None:
                        ids.append(None)
                        good.append(None)
                        sizes.append(0)
                        continue
                    x = encode(enc, t)
                    raw = t.encode()
                    ids.append(x)
                    good.append(decode(enc, x.tolist()) == raw)
                    sizes.append(len(raw))
                count = np.array([0 if x is None else len(x) for x in ids], np.int64)
                flat = np.concatenate([x for x in ids if x is not None] or [np.array([], np.int32)])
                tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(flat), mask=pa.array([x is None for x in ids]))
                yield pa.RecordBatch.from_arrays(
                    [column(b, "doc_id"), tokens, pa.array(count), pa.array(sizes, pa.int64()), pa.array(good, pa.bool_())],
                    names=["doc_id", "tokens", "n_tokens", "n_bytes", "round_trip"],
                )

    return pick(docs, doc_id="bigint", text="string").mapInArrow(run, SCHEMA)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
