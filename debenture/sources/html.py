"""Result tables and links in web pages, by regular expressions in the JVM; `parsed_rows` takes Python's parser for markup that
those don't suit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from debenture.operators.register import filename_of_url

_LINK = r"""(?is)<a\b[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_LINK_TEXT = r"""(?is)<a\b[^>]*?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a>"""
_NEXT = r"""(?is)<a\b[^>]*?(?:rel\s*=\s*["']?next|class\s*=\s*["'][^"']*\bnext\b)[^>]*>"""


def link(markup) -> Column:
    """The first link's target, whatever its quotes; empty if there is none."""
    return F.concat(*[F.regexp_extract(markup, _LINK, i) for i in (1, 2, 3)])


def next_page(markup) -> Column:
    """The target of the link to the next page of results (rel or class `next`); null on the last page."""
    target = link(F.regexp_extract(markup, _NEXT, 0))
    return F.when(target != "", target)


def visible(markup: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(markup, "(?s)<[^>]*>", ""), r"^\s+|\s+$", ""))


def cell_text(cell: Column) -> Column:
    """The first span's text if there is a span, else the cell's."""
    span = F.regexp_extract(cell, r"(?is)<span\b[^>]*>(.*?)</span>", 1)
    return visible(F.when(F.regexp_like(cell, F.lit(r"(?i)<span\b")), span).otherwise(cell))


def first_links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, url, filename): the first link of each page that has one."""
    url = link(html)
    out = pages.select(key, url.alias("url"), visible(F.regexp_extract(html, _LINK_TEXT, 1)).alias("label")).filter("url <> ''")
    return out.select(key, "url", filename_of_url(F.col("url"), F.col("label")).alias("filename"))


def result_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row, issuer_name, doc_type, date, url, filename) of table rows that hold a link; rows of fewer than three cells
    have only the link. What isn't there is empty."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)).alias("row", "r"))
    rows = rows.withColumn("cells", F.regexp_extract_all("r", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1)).filter(link("r") != "")
    cell = lambda i: F.when(F.size("cells") >= 3, cell_text(F.get("cells", F.lit(i)))).otherwise("")
    url = link("r")
    return rows.select(key, "row", cell(0).alias("issuer_name"), cell(1).alias("doc_type"), cell(2).alias("date"), url.alias("url"), filename_of_url(url, visible(F.regexp_extract("r", _LINK_TEXT, 1))).alias("filename"))


def parsed_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row, cells, url) of table rows by html.parser, in Arrow batches."""
    import pandas as pd

    def run(frames):
        from html.parser import HTMLParser

        class Rows(HTMLParser):
            def __init__(self):
                super().__init__()
                self.rows, self.cell, self.row = [], None, None

            def handle_starttag(self, tag, attrs):
                if tag == "tr":
                    self.row = {"cells": [], "url": None}
                elif self.row is not None and tag in ("td", "th"):
                    self.cell = []
                elif self.row is not None and tag == "a" and self.row["url"] is None:
                    self.row["url"] = dict(attrs).get("href")

            def handle_data(self, data):
                if self.cell is not None:
                    self.cell.append(data)

            def handle_endtag(self, tag):
                if tag in ("td", "th") and self.cell is not None:
                    self.row["cells"].append("".join(self.cell).strip())
                    self.cell = None
                elif tag == "tr" and self.row is not None:
                    self.rows.append(self.row)
                    self.row = None

        for frame in frames:
            out = []
            for k, page in zip(frame.iloc[:, 0], frame.iloc[:, 1], strict=True):
                parser = Rows()
                parser.feed(page or "")
                out += [(k, i, r["cells"], r["url"]) for i, r in enumerate(parser.rows)]
            yield pd.DataFrame(out, columns=[key, "row", "cells", "url"])

    d = pages.select(key, html)
    return d.mapInPandas(run, f"`{key}` {d.schema[0].dataType.simpleString()}, row long, cells array<string>, url string")
