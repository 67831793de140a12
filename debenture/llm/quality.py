"""Quality rules and a calibrated classifier of hashed word and character n-grams.

Documents are scored in Arrow batches: whole texts, by numpy over the batch's bytes. The model is a logistic regression whose
features are the shares of a text's words, word pairs, and runs of 3 and 5 bytes in hashed bins; it is fitted on a bounded
sample of labelled rows, its scores turned into probabilities (Platt) on rows held out, and compared with a fixed threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, shingles, slices, utf8

#: Labelled rows that a model is fitted and calibrated on at most: those of least hash. What else is labelled isn't used.
SAMPLE_ROWS = 2000
BINS = 1 << 14
THRESHOLD = 0.5

_KINDS = 4
_NEWLINE = np.uint8(10)
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_HEAD = np.ones(256, np.int64)
_HEAD[0x80:0xC0] = 0


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(_KINDS * BINS, np.float32))
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (score + self.bias) + self.shift, -50, 50)))


def _bins(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: its bins and where each row's begin."""
    h = w.hash()
    out = [((h >> np.uint64(50)).astype(np.int32) & (BINS - 1), w.first)]
    two, first = shingles(h, w.first, 2)
    out.append((((two >> np.uint64(50)).astype(np.int32) & (BINS - 1)) + BINS, first))
    for kind, k in ((2, 3), (3, 5)):
        data = w.data.astype(np.uint32)
        n = max(0, len(data) - k + 1)
        roll = np.zeros(n, np.uint32)
        for j in range(k):
            roll *= np.uint32(0x01000193)
            roll ^= data[j : j + n]
        roll *= np.uint32(0x9E3779B1)
        # a row has the runs that begin in it; the few that reach into the next row go to none
        lengths = np.diff(w.offsets)
        ends = w.offsets[1:]
        keep = np.ones(n, bool)
        for j in range(1, k):
            at = ends - j
            at = at[(at >= w.offsets[:-1]) & (at < n)]
            keep[at] = False
        bins = (roll[keep] >> np.uint32(18)).astype(np.int32) + kind * BINS
        out.append((bins, np.concatenate([[0], np.cumsum(np.maximum(lengths - k + 1, 0))])))
    return out


def _means(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
    return (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)


def scores(w: Words, model: Model) -> np.ndarray:
    return sum(_means(model.weights[bins], first) for bins, first in _bins(w))


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def _repeated(h: np.ndarray, first: np.ndarray, k: int = 3) -> np.ndarray:
    """Words per row that lie in a run of k words found twice or more in the row."""
    n, rows = len(h), len(first) - 1
    if n < k:
        return np.zeros(rows, np.int64)
    row = np.repeat(np.arange(rows), np.diff(first))
    roll = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        roll = mix(roll + h[j : n - k + 1 + j])
    valid = row[: n - k + 1] == row[k - 1 :]
    at = np.flatnonzero(valid)
    key = mix(roll[at] ^ (row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(n + 1, np.int32)
    hit = at[order[twice]]
    for j in range(k):
        covered[hit + j] = 1
    return _sums(covered[:n], first)


def _repeated_lines(w: Words) -> np.ndarray:
    """Lines per row that hold a word and equal an earlier line of the row."""
    rows = len(w.offsets) - 1
    breaks = np.flatnonzero(w.data == _NEWLINE)
    row_of = np.searchsorted(w.offsets, breaks, "right") - 1
    filled = np.flatnonzero(np.diff(w.offsets) > 0)
    start = np.sort(np.concatenate([w.offsets[filled], breaks + 1]))
    end = np.sort(np.concatenate([w.offsets[filled + 1], breaks]))
    row = np.sort(np.concatenate([filled, row_of]))
    words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    keep = words > 0
    start, end, row = start[keep], end[keep], row[keep]
    key = mix(w.hash(start=start, end=end) ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    s = key[order]
    again = np.concatenate([[False], s[1:] == s[:-1]]) if len(s) else np.zeros(0, bool)
    return np.bincount(row[order[again]], minlength=rows).astype(np.int64)


_BASE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def judged(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, columns: list[str] | None = None) -> DataFrame:
    """`columns` of docs (default all) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    probability and kept.

    Null or empty text: no words, so base_failed. Very long texts are counted whole, in a step of their own. Repeated rows get
    equal values. An empty table gives no rows. Columns named like the new ones, in whatever case, are replaced."""
    new = [x.split()[0] for x in _BASE_SCHEMA.split(", ")]
    names = [c for c in (columns or docs.columns) if c.lower() not in new]
    drop = len(names)
    kept = docs.select(*[F.col(f"`{c}`") for c in names], *([] if text in names else [F.col(f"`{text}`")]))
    at = names.index(text) if text in names else drop
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:drop]] + [_BASE_SCHEMA])

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            parts = []
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                n_words = np.diff(w.first)
                heads = np.concatenate([[0], np.cumsum(_HEAD[w.data])])
                repeat = _repeated(w.hash(), w.first)
                failed = (n_words < 50) | (100 * repeat > 50 * n_words)
                p = model.probability(scores(w, model))
                parts.append((n_words, _sums(heads[w.end] - heads[w.start], w.first), _sums(_SYMBOL[w.data], w.offsets), _repeated_lines(w), repeat, failed, p, ~failed & (p >= threshold)))
            if parts:
                cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(drop)] + [pa.array(c) for c in cols], names=[*names, *new])

    return kept.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", text: str = "text", sample_rows: int = SAMPLE_ROWS, steps: int = 300) -> Model:
    """Fits and calibrates on at most `sample_rows` labelled rows: those whose ids have the least hash, one row per id. A
    fifth of them, by hash, isn't fitted but calibrates. Without labels of both values the model keeps everything."""
    ids = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("__y"))
    ids = ids.withColumn("__h", F.xxhash64(F.lit("quality"), doc_id)).orderBy("__h", doc_id).limit(sample_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text")).join(F.broadcast(ids), F.col("__id") == F.col(doc_id))

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            at, value, out = [], [], batch.num_rows
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                kinds = _bins(w)
                for i in range(b - a):
                    n, v = [], []
                    for bins, first in kinds:
                        own = bins[first[i] : first[i + 1]]
                        u, c = np.unique(own, return_counts=True)
                        n.append(u.astype(np.int32))
                        v.append((c / max(1, len(own))).astype(np.float32))
                    at.append(np.concatenate(n))
                    value.append(np.concatenate(v))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([x.tobytes() for x in at], pa.binary()), pa.array([x.tobytes() for x in value], pa.binary())], names=["h", "y", "at", "value"])

    def train(batches):
        got = sorted((r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True)), key=lambda r: (r[0], r[2], r[3]))
        m = _train([(np.frombuffer(at, np.int32), np.frombuffer(value, np.float32), y) for _, y, at, value in got], steps)
        yield pa.RecordBatch.from_arrays([pa.array([m.weights.tobytes()], pa.binary()), *[pa.array([float(x)]) for x in (m.bias, m.slope, m.shift)]], names=["weights", "bias", "slope", "shift"])

    # the sample is bounded, so one task can hold it; only the weights go to the driver
    got = rows.select("__text", "__h", "__y").mapInArrow(run, "h long, y int, at binary, value binary").repartition(1)
    r = got.mapInArrow(train, "weights binary, bias double, slope double, shift double").first()
    return Model(np.frombuffer(r[0], np.float32), r[1], r[2], r[3]) if r else Model(bias=50.0)


def _train(rows: list, steps: int) -> Model:
    y = np.array([r[2] for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return Model(bias=50.0)
    sizes = np.array([len(r[0]) for r in rows])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    at = np.concatenate([r[0] for r in rows]).astype(np.int32)
    value = np.concatenate([r[1] for r in rows])
    held = np.arange(len(rows)) % 5 == 4
    # the classes weigh alike; features go by their root mean square, so rare bins count as well
    scale = 1 / np.sqrt(np.bincount(at, value * value, _KINDS * BINS) / len(rows) + 1e-7)
    value *= scale[at].astype(np.float32)
    share = y.mean()
    weight = np.where(held, 0, np.where(y > 0, 0.5 / share, 0.5 / (1 - share)))
    weight /= weight.sum()
    w, bias, m, v = np.zeros(_KINDS * BINS), 0.0, np.zeros(_KINDS * BINS + 1), np.zeros(_KINDS * BINS + 1)
    # once in the order of the rows, once in that of the bins: both sums are over neighbours
    full, first = np.flatnonzero(sizes), (np.cumsum(sizes) - sizes)[sizes > 0]
    order = np.argsort(at, kind="stable")
    by_bin, row_by_bin = value[order], row[order]
    bins, begin = np.unique(at[order], return_index=True)

    def scores_of(w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        if len(full):
            out[full] = np.add.reduceat(value * w.astype(np.float32)[at], first)
        return out

    for t in range(1, steps + 1):
        z = scores_of(w) + bias
        g = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        grad = np.append(1e-5 * w, g.sum())
        if len(bins):
            grad[bins] += np.add.reduceat(by_bin * g.astype(np.float32)[row_by_bin], begin)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    z = scores_of(w) + bias
    zs, ys = (z[held], y[held]) if len(set(y[held].tolist())) > 1 else (z, y)
    # Platt with smoothed targets
    hi, lo = (ys.sum() + 1) / (ys.sum() + 2), 1 / (len(ys) - ys.sum() + 2)
    goal = np.where(ys > 0, hi, lo)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * zs + b, -50, 50)))
        d, h = p - goal, np.maximum(p * (1 - p), 1e-9)
        g1, g2 = (d * zs).sum() + 1e-3 * (a - 1), d.sum()
        h11, h12, h22 = (h * zs * zs).sum() + 1e-3, (h * zs).sum(), h.sum() + 1e-6
        det = h11 * h22 - h12 * h12
        da, db = (h22 * g1 - h12 * g2) / det, (h11 * g2 - h12 * g1) / det
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return Model((w * scale).astype(np.float32), float(bias), float(max(a, 1e-3)), float(b))
