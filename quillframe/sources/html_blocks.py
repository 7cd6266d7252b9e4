"""Web pages as block tables: block-level elements with their locators, list depth and marks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li td th caption pre blockquote dt dd figcaption".split())
CONTAINER = frozenset("article main section nav header footer aside div ul ol table tbody tr form body".split())
UNSEEN = frozenset("script style title template noscript".split())

SCHEMA = "document long, ordinal long, locator string, element string, container string, depth int, raw_text string, n_links int, n_bold int"


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.path: list[tuple[str, int]] = []
        self.counts: list[Counter] = [Counter()]
        self.unseen = 0
        self._begin("")

    def _begin(self, element: str) -> None:
        self.element, self.text, self.links, self.bold = element, [], 0, 0

    def _end(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            name = self.element or "text"
            self.counts[-1][name] += 1
            locator = "/".join([*(f"{n}[{k}]" for n, k in self.path), f"{name}[{self.counts[-1][name]}]"])
            container = self.path[-1][0] if self.path else "body"
            depth = sum(n in ("ul", "ol") for n, _ in self.path)
            self.rows.append((len(self.rows) + 1, locator, name, container, depth, text, self.links, self.bold))
        self._begin("")

    def handle_starttag(self, tag, attrs):
        if tag in UNSEEN:
            self.unseen += 1
        elif tag in BLOCK:
            self._end()
            self.element = tag
        elif tag in CONTAINER:
            self._end()
            if tag != "body":
                self.counts[-1][tag] += 1
                self.path.append((tag, self.counts[-1][tag]))
                self.counts.append(Counter())
        elif tag == "a":
            self.links += 1
        elif tag in ("b", "strong"):
            self.bold += 1
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        if tag in UNSEEN:
            self.unseen = max(0, self.unseen - 1)
        elif tag in BLOCK:
            self._end()
        elif tag in CONTAINER:
            self._end()
            names = [n for n, _ in self.path]
            if tag in names:
                keep = len(names) - 1 - names[::-1].index(tag)
                del self.path[keep:], self.counts[keep + 1 :]

    def handle_data(self, data):
        if not self.unseen:
            self.text.append(data)


def read_page(source: str) -> list[tuple]:
    """(ordinal, locator, element, container, depth, text, links, bold) of each block of a page."""
    reader = _Reader()
    reader.feed(source)
    reader.close()
    reader._end()
    return reader.rows


def html_blocks(pages: DataFrame, document: str = "page_id", html: str = "html") -> DataFrame:
    """The blocks of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [(d, *row) for d, h in zip(batch[document], batch[html]) if h is not None for row in read_page(h)]
            yield pd.DataFrame(rows, columns=names)

    return pages.select(document, html).mapInPandas(run, SCHEMA)
