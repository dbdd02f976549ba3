"""HTML tables and lists as rows.

A page is parsed once, in Arrow batches; each page gives its own rows and no
page meets another, so there is no shuffle before the pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_SCHEMA = "page_id bigint, table_no int, row_no int, col_no int, is_header boolean, text string"
ITEM_SCHEMA = "page_id bigint, item_no int, text string"


class _Collector(HTMLParser):
    """Text of every element of some tags, with the count of its row and table."""

    def __init__(self, tags: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.tags, self.found = tags, []
        self.table = self.row = self.col = -1
        self.open: list[str] | None = None
        self.kind = ""

    def close_open(self):
        if self.open is not None:
            self.found.append((self.table, self.row, self.col, self.kind, "".join(self.open).strip()))
            self.open = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.close_open()
            self.table, self.row, self.col = self.table + 1, -1, -1
        elif tag == "tr":
            self.close_open()
            self.row, self.col = self.row + 1, -1
        elif tag in self.tags:
            self.close_open()
            self.col += 1
            self.open, self.kind = [], tag

    def handle_endtag(self, tag):
        if tag in self.tags or tag in ("tr", "table", "ul", "ol"):
            self.close_open()

    def handle_data(self, data):
        if self.open is not None:
            self.open.append(data)


def _collect(html: str, tags: tuple[str, ...]) -> list:
    reader = _Collector(tags)
    reader.feed(html or "")
    reader.close()
    reader.close_open()
    return reader.found


def table_cells(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per ``th``/``td`` cell of every table of every page."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (page, t, r, c, kind == "th", text)
                for page, html in zip(pdf["page_id"], pdf["html"])
                for t, r, c, kind, text in _collect(html, ("th", "td"))
                if t >= 0
            ]
            yield pd.DataFrame(rows, columns=["page_id", "table_no", "row_no", "col_no", "is_header", "text"])

    slim = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    return slim.mapInPandas(cells, CELL_SCHEMA)


def table_rows(cells: DataFrame, table_no: int, columns: list[str]) -> DataFrame:
    """Body rows of the n-th table, one column per cell position."""
    wide = (
        cells.filter((F.col("table_no") == table_no) & ~F.col("is_header"))
        .groupBy("page_id", "row_no")
        .pivot("col_no", list(range(len(columns))))
        .agg(F.first("text"))
    )
    return wide.select("page_id", "row_no", *[F.col(str(i)).alias(c) for i, c in enumerate(columns)])


def list_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per list item of every page, in page order."""

    def items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (page, i, found[4])
                for page, html in zip(pdf["page_id"], pdf["html"])
                for i, found in enumerate(_collect(html, ("li",)))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "item_no", "text"])

    slim = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    return slim.mapInPandas(items, ITEM_SCHEMA)
