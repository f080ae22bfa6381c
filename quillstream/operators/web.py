"""Main content of HTML pages, for sources that still have their markup."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content of their own, and elements that never close.
DROPPED = frozenset(("script", "style", "noscript", "svg", "iframe", "canvas", "nav", "footer", "template"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
CONTENT_CLASSES = ("content", "article", "main", "portlet")


class _Reader(HTMLParser):
    """Text nodes with the element they prefer: 3 for main, 2 for article, 1 for a division of a content class, 0 for the rest."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []
        self.texts: list[tuple[int, str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            return
        rank, gone = self.stack[-1][1:] if self.stack else (0, False)
        names = " ".join((v or "").lower() for a, v in attrs if a in ("class", "id"))
        own = 3 if tag == "main" else 2 if tag == "article" else 1 if tag == "div" and any(c in names for c in CONTENT_CLASSES) else 0
        self.stack.append((tag, max(rank, own), gone or tag in DROPPED))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                return

    def handle_data(self, data: str) -> None:
        rank, gone = self.stack[-1][1:] if self.stack else (0, False)
        if not gone and (plain := " ".join(data.split())):
            self.texts.append((rank, plain))


def main_text(html: str | None) -> str | None:
    """The text nodes of the best container, one a line; null for null, empty where nothing is left."""
    if html is None:
        return None
    reader = _Reader()
    reader.feed(html)
    reader.close()
    best = max((r for r, _ in reader.texts), default=0)
    return "\n".join(t for r, t in reader.texts if r >= best)


def html_main_text(html: Column) -> Column:
    """main_text for a column."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    return extract(html)
