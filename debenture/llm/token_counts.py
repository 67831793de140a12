"""Token counts by field and section: each document is encoded once, and its tokens are attributed by their offsets.

A document is rendered as its header fields, one to a line, an empty line and the text; what a reader of the corpus pays for.
Spans of fields and of the text's lines meet the tokens' character spans by a sorted interval join. Rule for tokens that cross a
boundary: a token belongs to the span that holds its first character; one that begins in no span (the glue between fields)
belongs to the next span that it reaches, or to none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encoder import default_vocabulary, encoded, encoder


def rendered(fields: list[str], text: str) -> Column:
    """name: value lines, an empty line, the text; null fields and texts are empty."""
    parts = [F.concat(F.lit(f"{f}: "), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")), F.lit("\n")) for f in fields]
    return F.concat(*parts, F.lit("\n"), F.coalesce(F.col(f"`{text}`"), F.lit("")))


def attributed(begins: np.ndarray, length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per token, which of the sorted, disjoint spans it counts for; -1: none. A token ends where the next begins."""
    stop = np.append(begins[1:], length)
    at = np.searchsorted(ends, begins, "right")
    inside = at < len(ends)
    near = np.minimum(at, max(0, len(ends) - 1))
    hit = inside & (starts[near] < np.maximum(stop, begins + 1)) if len(ends) else np.zeros(len(begins), bool)
    return np.where(hit, at, -1)


def token_counts(docs: DataFrame, fields: tuple[str, ...] = ("lang", "source"), text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, field_tokens, text_tokens, glue_tokens, n_crossing, line_tokens), a row per row of docs.
    field_tokens: array, per field, of the tokens of its value; line_tokens: per line of the text (its line break counts for the line
    it ends); n_crossing: tokens whose characters lie in two spans or more. The parts sum up to n_tokens.

    Null fields and texts are empty: no tokens of their own. Very long texts are encoded whole. Repeated rows get equal values, an
    empty table no rows; other columns don't matter."""
    path = vocabulary or default_vocabulary()
    k = len(fields)
    names = [len(f) + 2 for f in fields]
    kept = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), rendered(list(fields), text).alias("whole"), *[F.coalesce(F.length(F.col(f"`{f}`").cast("string")), F.lit(0)).alias(f"__f{i}") for i, f in enumerate(fields)])

    def run(batches):
        for batch in batches:
            sizes = [batch.column(2 + i).to_pylist() for i in range(k)]
            rows = []
            for a, b, ids, first, data, offsets in encoded(batch.column(1), path):
                every = encoder(path).begins(ids, first, data, offsets)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                breaks = chars[np.flatnonzero(data == 10) + 1]
                where = chars[offsets]
                cuts_of = np.searchsorted(breaks, where, "right")
                for i in range(b - a):
                    begins, length, spans, p = every[first[i] : first[i + 1]], int(where[i + 1] - where[i]), [], 0
                    for j in range(k):
                        n = sizes[j][a + i]
                        spans.append((p + names[j], p + names[j] + n))
                        p += names[j] + n + 1
                    body = p + 1
                    cuts = breaks[cuts_of[i] : cuts_of[i + 1]] - where[i]
                    cuts = cuts[cuts > body]
                    starts = np.concatenate([np.array([x for x, _ in spans] + [body], np.int64), cuts])
                    ends = np.concatenate([np.array([x for _, x in spans], np.int64), cuts, [length]])
                    real = ends > starts
                    place = attributed(begins, length, starts[real], ends[real])
                    counts = np.zeros(len(starts), np.int64)
                    counts[real] = np.bincount(place[place >= 0], minlength=int(real.sum()))
                    stop = np.append(begins[1:], length)
                    inner = np.searchsorted(ends[real], begins, "right") != np.searchsorted(ends[real], np.maximum(stop - 1, begins), "right")
                    rows.append((len(begins), counts[:k].tolist(), int(counts[k:].sum()), int((place < 0).sum()), int(inner.sum()), counts[k:].tolist()))
            if rows:
                c = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, t) for x, t in zip(c, kinds, strict=True)]], names=["doc_id", "n_tokens", "field_tokens", "text_tokens", "glue_tokens", "n_crossing", "line_tokens"])

    return kept.mapInArrow(run, f"doc_id {kept.schema[0].dataType.simpleString()}, n_tokens long, field_tokens array<long>, text_tokens long, glue_tokens long, n_crossing long, line_tokens array<long>")
