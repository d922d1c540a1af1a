"""Text normalisation, keyword and vocabulary expressions (operators T1-T8, T12-T21, F9, F12).

Every function takes and returns a ``Column`` and stays inside Catalyst; a null
text gives null unless stated otherwise.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

WORD = r"(?U)\b\w+\b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quote(words: list[str]) -> str:
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


def parse_text(c: Column | str) -> Column:
    """Letters, digits and underscores only, lower case; null becomes empty."""
    return F.lower(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)[^\w]", ""))


def remove_scale(c: Column | str) -> Column:
    """Map scales such as ``1:100`` or ``M. 1:50``."""
    return F.regexp_replace(_col(c), r"(?iU)(?:\bM\.?\s?|(?<!\w))1\s?:\s?\d+", "")


def remove_parenthesised(c: Column | str) -> Column:
    """The shortest bracketed stretches."""
    return F.regexp_replace(_col(c), r"\([^)]*\)", "")


def normalize_spaces(c: Column | str) -> Column:
    """T4: one blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def match_keyword(c: Column | str, keywords: list[str], prefix: bool = False, suffix: bool = False, any_case: bool = False, digit: bool = False) -> Column:
    """T5: the first word that holds a keyword (begins with it, ends with it, is followed by a number), or null."""
    if not keywords:
        return F.lit(None).cast("string")
    head, tail = "" if prefix else r"\w*", "" if suffix else r"\w*"
    number = r"(?:\ ?\d+)" if digit else ""
    body = "|".join(_quote([k]) + number for k in keywords)
    return F.nullif(F.regexp_extract(_col(c), f"({'?iuU' if any_case else '?U'})\\b{head}(?:{body}){tail}\\b", 0), F.lit(""))


def remove_keywords(c: Column | str, keywords: list[str] | None) -> Column:
    """Drop keywords that no word character precedes and no letter follows, in any case."""
    if not keywords:
        return _col(c)
    return F.regexp_replace(_col(c), rf"(?iuU)(?<!\w)(?:{_quote(keywords)})(?=\W|\d|$)", "")


def clean_name(c: Column | str, keywords: list[str] | None = None) -> Column:
    """A name without keywords, scales, brackets and separators; empty becomes null."""
    x = remove_parenthesised(remove_scale(remove_keywords(c, keywords)))
    return F.nullif(normalize_spaces(F.regexp_replace(x, r"[:._]", " ")), F.lit(""))


def name_fits(c: Column | str, max_name: int | None = None, max_word: int | None = None) -> Column:
    """name length and lengths of its letter runs within the limits."""
    x, ok = _col(c), F.lit(True)
    if max_name is not None:
        ok = ok & (F.length(x) <= max_name)
    if max_word is not None:
        ok = ok & F.forall(F.regexp_extract_all(F.lower(x), F.lit("[a-z]+"), F.lit(0)), lambda w: F.length(w) <= max_word)
    return ok


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; each bit of one integer is a column of the table."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for y in b:
        u = s & places.get(y, 0)
        s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def ratio(a: str | None, b: str | None) -> float | None:
    """T8 for two Python strings."""
    if a is None or b is None:
        return None
    return 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


@F.arrow_udf(DoubleType())
def _ratios(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([ratio(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """``2 * LCS / (len(a) + len(b))`` of two strings; 1 when both are empty, null when one is null.

    Runs in Arrow batches: an integer's bits hold a row of the table, which no JVM expression matches in speed.
    """
    return _ratios(_col(a), _col(b))


def replace_in_order(c: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after another."""
    x = _col(c)
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def fix_repeated_depth(c: Column | str) -> Column:
    """``1.48 8 m u.T.`` becomes ``1.48 m u.T.``; the whole text becomes the corrected match."""
    hit = r"(?U)\b(\d+\.\d+)\s*\d*\s*(m\s+u\.T\.)"
    return F.when(F.regexp_like(_col(c), F.lit(hit)), F.concat_ws(" ", F.regexp_extract(_col(c), hit, 1), F.regexp_extract(_col(c), hit, 2))).otherwise(_col(c))


def tokenize(c: Column | str) -> Column:
    """Words of letters, digits and underscores."""
    return F.regexp_extract_all(_col(c), F.lit(WORD), F.lit(0))


def ordered_coverage(tokens: Column, pattern: list[str]) -> Column:
    """Share of the pattern's words met in the tokens in order; a word that is not met is passed over."""

    def step(acc: Column, w: Column) -> Column:
        at = F.array_position(F.slice(tokens, acc["pos"] + 1, F.greatest(F.size(tokens) - acc["pos"], F.lit(0))), w)
        return F.when(at > 0, F.struct((acc["pos"] + at.cast("int")).alias("pos"), (acc["hits"] + 1).alias("hits"))).otherwise(acc)

    start = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("hits"))
    return F.aggregate(F.array(*[F.lit(w) for w in pattern]), start, step, lambda a: a["hits"] / F.lit(float(len(pattern) or 1)))


def map_class(c: Column | str, names: list[str], default: str) -> Column:
    """A class string mapped to one of ``names`` without regard to case, blanks and hyphens."""
    key = lambda s: re.sub(r"[\s_-]+", "", s).lower()
    table = F.create_map(*[F.lit(x) for n in names for x in (key(n), n)])
    return F.coalesce(F.get(F.array(table[F.lower(F.regexp_replace(_col(c), r"[\s_-]+", ""))]), F.lit(0)), F.lit(default))


def is_layer_identifier(c: Column | str) -> Column:
    """A short first word such as ``2a)``."""
    first = F.split(F.trim(_col(c)), r"\s+")[0]
    return F.regexp_like(first, F.lit(r"^[0-9a-z-]+\)")) & (F.length(first) < 7)


def tag_min_depth(c: Column | str, tag: str = "Sp.") -> Column:
    """The smallest number of a text that holds the tag, else null."""
    numbers = F.regexp_extract_all(F.replace(_col(c), F.lit(","), F.lit(".")), F.lit(r"\d+(?:\.\d+)?"), F.lit(0))
    return F.when(F.contains(_col(c), F.lit(tag)), F.array_min(F.transform(numbers, lambda n: n.try_cast("double"))))


def is_header(c: Column | str, share: float = 0.7) -> Column:
    """More than that share of the letters are capitals."""
    letters = F.regexp_replace(_col(c), r"[^\p{L}]", "")
    return F.coalesce(F.try_divide(F.length(F.regexp_replace(letters, r"[^\p{Lu}]", "")), F.length(letters)), F.lit(0.0)) > share


#: Frequent function words a language; the language model of the original library is not available offline.
STOP_WORDS = {
    "de": "der die das und ist nicht ein eine mit von auf für den dem im zu sich auch".split(),
    "en": "the and of to in is that it for with as was on are this be by".split(),
    "fr": "le la les et des un une est dans pour que qui sur avec pas au du".split(),
    "it": "il lo gli e di che un una per con non sono del della nel è".split(),
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable is bound, where a repeated expression would be evaluated at each use."""
    return F.transform(F.array(value), body)[0]


def _among(words: list[str]):
    return lambda w: w.isin(words)


def detect_language(c: Column | str, supported: list[str], default: str = "de", windows: int = 5, words: int = 10) -> Column:
    """The majority over word windows of the language whose function words are met most.

    Words stand between blanks. A text is cut into as many equal bins as it has full windows, at most ``windows`` and at
    least one, and the first ``words`` words of each bin vote; the windows do not overlap. A
    window without any function word votes for no language, which comes first among equals; ties of
    languages go to the first by name. No language or an unsupported one gives the default.
    """
    names = sorted(STOP_WORDS)

    def best(part: Column) -> Column:
        part = F.transform(part, lambda w: F.lower(F.regexp_replace(w, r"[\d\p{Punct}]", "")))
        hits = lambda p: F.array(*[F.struct(F.size(F.filter(p, _among(STOP_WORDS[s]))).alias("n"), F.lit(-i).alias("i"), F.lit(s).alias("lang")) for i, s in enumerate(names)])
        return _let(part, lambda p: _let(F.array_max(hits(p)), lambda h: F.when(h["n"] > 0, h["lang"]).otherwise("")))

    def majority(votes: Column) -> Column:
        tally = F.array(*[F.struct(F.size(F.filter(votes, _among([s]))).alias("n"), F.lit(-i).alias("i"), F.lit(s).alias("lang")) for i, s in enumerate(["", *names])])
        return F.array_max(tally)["lang"]

    def vote(toks: Column) -> Column:
        k = F.least(F.lit(windows), F.greatest(F.floor(F.size(toks) / words), F.lit(1)).cast("int"))
        bins = F.floor(F.size(toks) / k).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), k - 1), lambda i: best(F.slice(toks, i * bins + 1, words))), majority)

    found = _let(F.split(F.trim(F.regexp_replace(_col(c), " +", " ")), " "), vote)
    return supported_language(found, supported, default)


def supported_language(c: Column | str, supported: list[str], default: str = "de") -> Column:
    """T20's last step: an unsupported or missing code becomes the default."""
    return F.when(_col(c).isin(supported), _col(c)).otherwise(F.lit(default))


def single_number(c: Column | str) -> Column:
    """The only number of a text as a double; null when there is none, ``raise_if_several`` is left to the caller."""
    found = F.regexp_extract_all(_col(c), F.lit(r"\d+(?:\.\d+)?"), F.lit(0))
    return F.when(F.size(found) == 1, found[0].try_cast("double"))


def number_count(c: Column | str) -> Column:
    return F.size(F.regexp_extract_all(_col(c), F.lit(r"\d+(?:\.\d+)?"), F.lit(0)))


def vocabulary_hits(tokens: Column, vocabulary: list[str]) -> Column:
    """the distinct vocabulary words among the tokens, sorted."""
    return F.array_sort(F.array_intersect(tokens, F.array(*[F.lit(v) for v in vocabulary]) if vocabulary else F.array().cast("array<string>")))


def is_description(tokens: Column, including: list[str], excluding: list[str] = ()) -> Column:
    """some including word is met and no excluding one."""
    some = lambda v: F.arrays_overlap(tokens, F.array(*[F.lit(x) for x in v])) if v else F.lit(False)
    return F.coalesce(some(list(including)) & ~some(list(excluding)), F.lit(False))
