"""Dates, depths, elevations, coordinates and intervals out of text (operators D1-D10, F10, F11, F22, P9).

Expressions only. Numbers that do not parse give null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataframe.functions.text import _col, fix_repeated_depth

DATE = r"\d{1,2}\s*\.\s*\d{1,2}\s*\.\s*(?:\d{4}|\d{2})(?!\d)"


def date_text(c: Column | str) -> Column:
    """The first stretch that looks like a date, or null."""
    return F.nullif(F.regexp_extract(_col(c), rf"(?<!\d)({DATE})", 1), F.lit(""))


def parse_date(c: Column | str, as_of: str = "2025-01-01") -> Column:
    """The first date candidate; an impossible one gives null, one after ``as_of`` is moved a century back."""
    x = F.regexp_replace(date_text(c), r"\s", "")
    d = F.when(F.regexp_like(x, F.lit(r"\.\d{4}$")), F.try_to_date(x, "d.M.yyyy")).otherwise(F.try_to_date(x, "d.M.yy"))
    return F.when(d > F.lit(as_of).cast("date"), F.add_months(d, -1200)).otherwise(d)


def _first_number(text: Column, patterns: list[str], limit: float | None = None) -> Column:
    """The first pattern's number that parses and is within the limit."""
    tried = []
    for p in patterns:
        v = F.nullif(F.regexp_extract(text, p, 1), F.lit("")).try_cast("double")
        tried.append(v if limit is None else F.when(v <= limit, v))
    return F.coalesce(*tried)


def parse_depth(c: Column | str, max_depth: float = 200.0) -> Column:
    """A depth below ground: ``5.13 m u.T.`` first, else any decimal number; larger ones are passed over."""
    below = r"([0-9.]+)\s*m\s*u[.]t"
    return _first_number(F.lower(fix_repeated_depth(c)), [below + "[.]", below, r"(\d+[.]\d+)"], max_depth)


def parse_elevation(c: Column | str) -> Column:
    """D3: metres above sea level: with its unit first, then any number of three digits and one or two decimals, then ``430 m``."""
    x = F.replace(F.replace(F.lower(_col(c)), F.lit(", "), F.lit(",")), F.lit(". "), F.lit("."))
    number = r"(\d+(?:[.]\d+)?)\s*m\s*u"
    return _first_number(x, [number + r"[.]m[.]", number + "r.", r"(\d{3,}[.]\d{1,2})(?!\d)", r"(\d{3,})\s*m"])


def valid_elevation(c: Column | str) -> Column:
    """over sea level."""
    return (F.col(c) if isinstance(c, str) else c) > 0


def infer_depth(depth: Column, elevation: Column, terrain: Column) -> Column:
    """A missing depth from the terrain's and the water's elevation."""
    return F.coalesce(depth, F.round(terrain - elevation, 2))


def infer_elevation(depth: Column, elevation: Column, terrain: Column) -> Column:
    return F.coalesce(elevation, F.round(terrain - depth, 2))


def parse_coordinates(c: Column | str) -> Column:
    """``struct(east, north, srs)`` of the first coordinate pair with a valid range, or null.

    Thousands may be parted by dots, apostrophes or blanks; a stray 1 between both
    numbers (a misread slash) is skipped; the larger number is the easting.
    """
    x = _col(c)
    whole = r"([12])[.' ]?(\d{3})[.' ]?(\d{3})(?:[.](\d{1,2})(?!\d))?"
    short = r"(\d{3})[.' ]?(\d{3})(?:[.](\d{1,2})(?!\d))?"

    def pair(first: str, second: str, glue: str) -> Column:
        p = rf"(?<![\d.]){first}{glue}{second}(?!\d)"
        seven = first == whole
        n = 4 if seven else 3
        get = lambda i: F.regexp_extract(x, p, i)

        def number(o: int) -> Column:
            digits = F.concat(*[get(o + i) for i in range(n - 1)])
            decimals = get(o + n - 1)
            return F.concat(digits, F.when(decimals != "", F.concat(F.lit("."), decimals)).otherwise(F.lit(""))).try_cast("double")

        return F.when(F.regexp_like(x, F.lit(p)), F.struct(number(1).alias("a"), number(1 + n).alias("b")))

    glue = r"[^\d]{1,6}"
    v = F.coalesce(pair(whole, whole, glue), pair(short, short, glue), pair(whole, whole, "1"), pair(whole, whole, ""))
    east, north = F.greatest(v["a"], v["b"]), F.least(v["a"], v["b"])
    srs = F.when((east > 1e6) & (east < 1e7), F.lit("LV95")).when(east < 1e6, F.lit("LV03"))
    return F.when(srs.isNotNull(), F.struct(east.alias("east"), north.alias("north"), srs.alias("srs")))


def valid_coordinates(east: Column, north: Column) -> Column:
    """inside the national validity box of either reference frame, bounds excluded."""
    new = (east > 2324800) & (east < 2847500) & (north > 1074000) & (north < 1302000)
    old = (east > 324800) & (east < 847500) & (north > 74000) & (north < 302000)
    return F.coalesce(new | old, F.lit(False))


def depth_entry(c: Column | str) -> Column:
    """``struct(value, has_decimal)`` of a word that is a number with an optional unit, else null."""
    p = r"^-?[.]?(\d+(?:[.,]\d+)?)\s?[müMN\].]*$"
    digits = F.regexp_extract(_col(c), p, 1)
    value = F.abs(F.replace(digits, F.lit(","), F.lit(".")).try_cast("double"))
    return F.when(digits != "", F.struct(value.alias("value"), F.regexp_like(digits, F.lit("[.,]")).alias("has_decimal")))


NUMBER = r"-?[0-9]+(?:[.,][0-9]+)?"
UNIT = r"(?:\s*[müMN]+(?![\p{IsLatin}]))?"


def parse_interval(c: Column | str, anchored: bool = False, open_words: tuple[str, ...] = ("ab", "dès", "from")) -> Column:
    """``struct(start, end, rest)``: ``5 - 7.1 m text``, else open ended ``ab 4 m``; the rest is the text after a match at the start, else the whole text."""
    return interval_of(plain_spaces(c), anchored, open_words)


def plain_spaces(c: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def interval_of(x: Column, anchored: bool = False, open_words: tuple[str, ...] = ("ab", "dès", "from")) -> Column:
    """D10 of a text with ``plain_spaces``; a column, as each of its patterns reads it."""
    closed = rf"({NUMBER}){UNIT}[\s-]+({NUMBER}){UNIT}[\s.:;,]*"
    if anchored:
        closed = "^" + closed
    opened = rf"(?i)\b(?:{'|'.join(open_words)})\s*({NUMBER}){UNIT}"
    num = lambda p, i: F.replace(F.nullif(F.regexp_extract(x, p, i), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    at_start = F.regexp_like(x, F.lit("^(?:" + closed.lstrip("^") + ")"))
    rest = F.when(at_start, F.regexp_replace(x, "^(?:" + closed.lstrip("^") + ")", "")).otherwise(x)
    full = F.struct(F.abs(num(closed, 1)).alias("start"), F.abs(num(closed, 2)).alias("end"), rest.alias("rest"))
    half = F.struct(num(opened, 1).alias("start"), F.lit(None).cast("double").alias("end"), x.alias("rest"))
    return F.when(F.regexp_like(x, F.lit(closed)), full).when(F.regexp_like(x, F.lit(opened)), half)


def same_interval(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """equal bounds, none of them null."""
    return F.coalesce((a0 == b0) & (a1 == b1), F.lit(False))
