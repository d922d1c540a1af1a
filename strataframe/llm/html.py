"""Operator 8: main content of HTML pages by text-to-tag ratios.

The standard library's streaming parser turns a page into lines: a block-level tag
or a line feed in text starts a new one. A line's ratio is its text length over its
number of tags (at least one). The logarithms of the ratios are smoothed with a
Gaussian of ``SIGMA`` lines and split by two-means threshold clustering; lines of the
upper cluster whose own text is not a list of links are the content.

Defined cases: a null page has null text; an empty or text-free page has empty
text; a page whose ratios are all alike is content as a whole; scripts, styles and
the head are no text. Only ``<a href>`` is a link. A link or silent element ends with
its own end tag or that of the block around it, a link also with the next ``<a>``; of
those that never get their own end tag, a link ends with its line and a silent element
is read as text (but for scripts and styles, which reach to the end of the page). What follows
the last ``>`` of a page is text, so markup without an end is not searched again and again and
a very long page takes time in proportion to its length. Ratios that are equal to the threshold
are content. Repeated rows are each extracted; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strataframe.llm.text import column, runs
from strataframe.plans.runtime import pick

SIGMA = 1.0
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(["br", "hr"])
#: Elements that an opening tag of the same group ends.
IMPLIED = {t: g for g in (frozenset(["li"]), frozenset(["dt", "dd"]), frozenset(["option"]), frozenset(["tr"]), frozenset(["td", "th"])) for t in g}
SILENT = frozenset("head script style title noscript template textarea select".split())
SCHEMA = "page_id bigint, text string, n_lines bigint, n_content_lines bigint"


class _Events(HTMLParser):
    """The parser's events, and which opening tags of links and silent elements have their own end tag."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, bool]] = []
        self.open: dict[str, list[int]] = {}
        self.closed: set[int] = set()

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.open["a"] = [len(self.events)]  # ends the one before
        elif tag in SILENT:
            self.open.setdefault(tag, []).append(len(self.events))
        self.events.append(("start", tag, tag == "a" and any(k == "href" for k, _ in attrs)))

    def handle_startendtag(self, tag, attrs):
        self.events.append(("both", tag, False))

    def handle_endtag(self, tag):
        if self.open.get(tag):
            self.closed.add(self.open[tag].pop())
        self.events.append(("end", tag, False))

    def handle_data(self, data):
        self.events.append(("data", data, False))


class _Lines:
    """Collects (text, tags, linked text length) a line from parser events."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.blocks: list[str] = []
        self.count: dict[str, int] = {}
        self.silent: list[tuple[str, int]] = []  # open silent elements and the number of blocks around each
        self.link: tuple[int, bool] | None = None  # the number of blocks around the open link, and whether its end tag comes

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.linked))
        if text or self.parts:
            self.parts, self.tags, self.linked = [], 0, 0
            if self.link and not self.link[1]:
                self.link = None

    def pop(self) -> None:
        self.count[self.blocks.pop()] -= 1
        depth = len(self.blocks)
        while self.silent and self.silent[-1][1] > depth:
            self.silent.pop()
        if self.link and self.link[0] > depth:
            self.link = None

    def start(self, tag: str, href: bool, closed: bool) -> None:
        if tag in BLOCKS:
            self.end_line()
            if self.silent and self.silent[-1][0] == "select" and tag not in ("option", "hr"):
                self.silent.pop()  # a select holds no other block
        self.tags += 1
        if tag in SILENT:
            if closed:
                self.silent.append((tag, len(self.blocks)))
        elif tag == "a":
            self.link = (len(self.blocks), closed) if href else None
        elif tag in BLOCKS and tag not in VOID:
            if self.blocks and self.blocks[-1] == "p":
                self.pop()
            if self.blocks and self.blocks[-1] in IMPLIED.get(tag, ()):
                self.pop()
            self.blocks.append(tag)
            self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        self.tags += 1
        if tag in SILENT:
            if any(t == tag for t, _ in self.silent):
                while self.silent.pop()[0] != tag:
                    pass
        elif tag == "a":
            self.link = None
        elif tag in BLOCKS:
            self.end_line()
            if self.count.get(tag):
                while self.blocks[-1] != tag:
                    self.pop()
                self.pop()

    def data(self, data: str) -> None:
        if self.silent:
            return
        first, *more = data.split("\n")
        for piece, fresh in ((first, False), *((p, True) for p in more)):
            if fresh:
                self.end_line()
            if piece:
                self.parts.append(piece)
                self.linked += len(piece) if self.link else 0


def lines_of(html: str) -> list[tuple[str, int, int]]:
    p = _Events()
    end = html.rfind(">") + 1
    p.feed(html[:end])
    raw = p.cdata_elem  # an open script or style
    if raw is None:
        p.close()
        if end < len(html):
            p.handle_data(unescape(html[end:]))
    out = _Lines()
    for i, (kind, what, href) in enumerate(p.events):
        if kind == "data":
            out.data(what)
        elif kind == "start":
            out.start(what, href, i in p.closed)
        elif kind == "end":
            out.end(what)
        else:
            if what in BLOCKS:
                out.end_line()
            out.tags += 1
    out.end_line()
    return out.lines


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel's weights inside are scaled to one."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(x, kernel)[reach : reach + len(x)] / np.convolve(np.ones(len(x)), kernel)[reach : reach + len(x)]


def threshold(x: np.ndarray) -> float:
    """The one-dimensional two-means threshold: halfway between the means of both sides, from the middle of the range on."""
    t = (x.min() + x.max()) / 2
    for _ in range(50):
        low, high = x[x < t], x[x >= t]
        if not len(low) or not len(high):
            break
        new = (low.mean() + high.mean()) / 2
        if abs(new - t) < 1e-9:
            break
        t = new
    return t


def extract(html: str) -> tuple[str, int, int]:
    """Content text, number of lines, number of content lines."""
    lines = lines_of(html)
    if not lines:
        return "", 0, 0
    ratio = np.log1p(np.array([len(t) / max(1, tags) for t, tags, _ in lines]))
    s = smooth(ratio)
    at = threshold(s) if s.max() - s.min() > 1e-9 else -np.inf
    kept = [t for (t, _, linked), v in zip(lines, s) if v >= at and linked <= 0.5 * len(t)]
    return "\n".join(kept), len(lines), len(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, text, n_lines, n_content_lines)`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in runs(whole, "html", 4 << 20):
                out = [(None, 0, 0) if h is None else extract(h) for h in column(b, "html").to_pylist()]
                text, n, k = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [column(b, "page_id"), pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(k, pa.int64())],
                    names=["page_id", "text", "n_lines", "n_content_lines"],
                )

    return pick(pages, page_id="bigint", html="string").mapInArrow(run, SCHEMA)


def op8_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
