"""Fuzzy keys, stems and compound parts (operators T9-T11, T22): text rules the JVM has no expression for.

Each is an Arrow function with a cache a batch, so repeated words cost one evaluation.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from strataframe.functions.text import _col

VOWELS = "aeiouyäöü"


def _regions(w: str) -> tuple[int, int]:
    """Starts of the regions R1 and R2 of the published German stemmer."""

    def after(start: int) -> int:
        for i in range(start + 1, len(w)):
            if w[i] not in VOWELS and w[i - 1] in VOWELS:
                return i + 1
        return len(w)

    r1 = after(0)
    return max(r1, 3), after(r1)


def _first(w: str, endings: tuple[str, ...]) -> str:
    return next((e for e in sorted(endings, key=len, reverse=True) if w.endswith(e)), "")


@lru_cache(maxsize=100_000)
def stem_german(word: str) -> str:
    """The published Snowball rules for German."""
    w = word.lower().replace("ß", "ss")
    w = "".join(c.upper() if c in "uy" and 0 < i < len(w) - 1 and w[i - 1] in VOWELS and w[i + 1] in VOWELS else c for i, c in enumerate(w))
    r1, r2 = _regions(w)
    inside = lambda e, r: bool(e) and len(w) - len(e) >= r
    e = _first(w, ("em", "ern", "er", "e", "en", "es", "s"))
    if inside(e, r1):
        if e != "s":
            w = w[: -len(e)]
            if e in ("e", "en", "es") and w.endswith("niss"):
                w = w[:-1]
        elif w[-2:-1] and w[-2] in "bdfghklmnrt":
            w = w[:-1]
    e = _first(w, ("en", "er", "est", "st"))
    if inside(e, r1) and (e != "st" or len(w) >= 6 and w[-3] in "bdfghklmnt"):
        w = w[: -len(e)]
    e = _first(w, ("end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"))
    if inside(e, r2):
        if e in ("ig", "ik", "isch"):
            if w[-len(e) - 1 : -len(e)] != "e":
                w = w[: -len(e)]
        else:
            w = w[: -len(e)]
            if e in ("end", "ung") and w.endswith("ig") and len(w) - 2 >= r2 and w[-3:-2] != "e":
                w = w[:-2]
            elif e in ("lich", "heit") and w.endswith(("er", "en")) and len(w) - 2 >= r1:
                w = w[:-2]
            elif e == "keit":
                x = _first(w, ("lich", "ig"))
                if x and len(w) - len(x) >= r2:
                    w = w[: -len(x)]
    return w.lower().translate(str.maketrans("äöü", "aou"))


@F.arrow_udf(ArrayType(StringType()))
def _stems(words: pa.Array) -> pa.Array:
    return pa.array([None if ws is None else [stem_german(w) for w in ws if w is not None] for ws in words.to_pylist()], pa.list_(pa.string()))


def stems(words: Column | str) -> Column:
    """T10 over an array of words; the German rules serve every language."""
    return _stems(_col(words))


@lru_cache(maxsize=100_000)
def split_compound(word: str, vocabulary: frozenset[str]) -> tuple[str, ...]:
    """The word cut into the fewest vocabulary words, with a linking ``s`` or ``n`` allowed between; the word itself if there is no cut."""
    best: list[tuple[str, ...] | None] = [()] + [None] * len(word)
    for i in range(1, len(word) + 1):
        for j in range(max(0, i - 30), i):
            if best[j] is not None and word[j:i] in vocabulary and (best[i] is None or len(best[j]) + 1 < len(best[i])):
                best[i] = (*best[j], word[j:i])
        if best[i] is None and word[i - 1] in "sn" and best[i - 1] and i < len(word):
            best[i] = best[i - 1]
    return best[-1] or (word,)


def compound_parts(word: Column | str, vocabulary: list[str]) -> Column:
    """T11 as a column; an explicit vocabulary stands in for the statistical model, which is not available offline."""
    known = frozenset(vocabulary)

    @F.arrow_udf(ArrayType(StringType()))
    def run(words: pa.Array) -> pa.Array:
        return pa.array([None if w is None else list(split_compound(w.lower(), known)) for w in words.to_pylist()], pa.list_(pa.string()))

    return run(_col(word))


def fuzzy_key(text: Column | str, keys: list[str], exceptions: list[str] = ()) -> Column:
    """The first stretch that equals a key up to a fifth of its length in edits (keys under five characters exactly), on word bounds and in any case; null if none, or if the text holds an exception."""

    @F.arrow_udf(StringType())
    def run(texts: pa.Array) -> pa.Array:
        import regex

        rules = [regex.compile(rf"(?b)\b(?:{regex.escape(k)}){{e<={len(k) // 5 if len(k) >= 5 else 0}}}\b", regex.IGNORECASE) for k in keys]

        def find(t: str | None) -> str | None:
            if t is None or any(x in t for x in exceptions):
                return None
            return next((m.group() for m in (r.search(t) for r in rules) if m), None)

        return pa.array([find(t) for t in texts.to_pylist()], pa.string())

    return run(_col(text))


def match_across_lines(lines: Column, pattern: str) -> Column:
    """The first match of a pattern in lines joined by blanks: ``struct(text, first, last)`` with the numbers of the lines it touches, or null. ``lines`` is an ordered array of strings."""
    whole = F.concat_ws(" ", lines)
    text = F.regexp_extract(whole, pattern, 0)
    at = F.instr(whole, text) - 1
    ends = F.transform(lines, lambda _, i: F.length(F.concat_ws(" ", F.slice(lines, 1, i + 1))))
    line_of = lambda p: F.size(F.filter(ends, lambda e: e <= p))
    return F.when(text != "", F.struct(text.alias("text"), line_of(at).alias("first"), line_of(at + F.length(text) - 1).alias("last")))
