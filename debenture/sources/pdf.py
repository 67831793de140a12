"""PDF to text in three tiers: the text layer, a reader of the layout where that is thin, OCR where it still is. The readers are optional
libraries, loaded in the tasks; each tier runs only over what the one before left, as Python isn't short-circuited in a plan."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debenture.functions.text import clean_text

#: A page with fewer characters on average is thin.
CHARS_PER_PAGE = 100
SCHEMA = "path string, page_count int, text string"


def text_layer(content: bytes) -> tuple[int, str]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        return doc.page_count, "".join(page.get_text() for page in doc)


def layout(content: bytes) -> tuple[int, str]:
    import fitz
    import pymupdf4llm

    with fitz.open(stream=content, filetype="pdf") as doc:
        return doc.page_count, pymupdf4llm.to_markdown(doc)


def optical(content: bytes) -> tuple[int, str]:
    import pytesseract
    from pdf2image import convert_from_bytes

    images = convert_from_bytes(content)
    return len(images), "".join(pytesseract.image_to_string(i) for i in images)


def _tier(files: DataFrame, read: Callable[[bytes], tuple[int, str]]) -> DataFrame:
    def run(frames):
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    n, text = read(bytes(content))
                except Exception:  # a file that can't be read has no text
                    n, text = None, None
                out.append((path, n, text))
            yield pd.DataFrame(out, columns=["path", "page_count", "text"]).astype({"page_count": "Int32"})

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def document_text(files: DataFrame, readers: list[Callable] | None = None, chars_per_page: int = CHARS_PER_PAGE) -> DataFrame:
    """(path, page_count, text) of binary files; text is cleaned, empty where no reader found any. A reader's text stands while the
    next ones find none; the last reader's text stands however thin. Each tier's result is persisted, as what follows it and
    the output both need it, and no reader should see a file twice."""
    readers = readers or [text_layer, layout, optical]
    left, before, out = files, None, None
    for i, read in enumerate(readers):
        got = _tier(left, read).withColumn("text", clean_text(F.col("text")))
        if before is not None:
            had = before.select("path", F.col("page_count").alias("had_pages"), F.col("text").alias("had"))
            better = F.coalesce(F.col("text") != "", F.lit(False))
            got = got.join(had, "path").select("path", F.coalesce("page_count", "had_pages").alias("page_count"), F.when(better, F.col("text")).otherwise(F.col("had")).alias("text"))
        got = got.persist(StorageLevel.DISK_ONLY)
        good = F.coalesce((F.col("text") != "") & (F.length("text") >= chars_per_page * F.col("page_count")), F.lit(False))
        last = i + 1 == len(readers)
        part = got if last else got.filter(good)
        out = part if out is None else out.unionByName(part)
        before = got.filter(~good)
        left = files.join(before.select("path"), "path", "left_semi")
    return out
