"""What several training-data operators share: cut lineage, words of Arrow text columns, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debenture.working import bucketed, discard, saved, shared_dir, working

__all__ = ["WORD", "SLICE_BYTES", "Words", "bucketed", "components", "discard", "fresh", "keys_of", "mix", "saved", "shared_dir", "shingles", "signed", "slices", "utf8", "working"]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a numpy step looks at together; a longer text is a step of its own.
SLICE_BYTES = 1 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keys_of(df: DataFrame, *skip: str) -> list:
    """Two hashes over all columns, 128 bits together: rows that share an id but differ are told apart."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in skip]
    return [F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)]


# --- words of an Arrow column ---------------------------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if size <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """(first, last) row of consecutive rows with about `most` bytes; a longer row is alone."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


class Words:
    """Words of some rows: start and end (bytes), hash, and `first`: the words of row i are first[i]:first[i+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        gap = _SPACE[data]
        before, after = np.empty(n, bool), np.empty(n, bool)
        if n:
            before[0] = after[-1] = True
            before[1:], after[:-1] = gap[:-1], gap[1:]
            inner = offsets[(offsets > 0) & (offsets < n)]
            before[inner] = True
            after[inner - 1] = True
        solid = ~gap
        self.start = np.flatnonzero(solid & before)
        self.end = np.flatnonzero(solid & after) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hash(self, data: np.ndarray | None = None, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        data = self.data if data is None else data
        start, end = self.start if start is None else start, self.end if end is None else end
        n = len(data)
        if not n:
            return np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * _power("up", _BASE, n), out=sums[1:])
        return mix((sums[end] - sums[start]) * _power("down", _INVERSE, n + 1)[start] + (end - start).astype(np.uint64))


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of each row and where each row's begin; a row of 1 to k-1 words has one: all its words."""
    counts = np.diff(first)
    n = len(h)
    if n >= k:
        roll = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            roll = roll * _BASE + h[j : n - k + 1 + j]
        keep = np.ones(n - k + 1, bool)
        for j in range(1, k):
            bad = first[1:] - j
            bad = bad[(bad >= first[:-1]) & (bad < len(keep))]
            keep[bad] = False
        out = mix(roll[keep])
    else:
        out = np.zeros(0, np.uint64)
    many = np.maximum(counts - k + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            own[has] = own[has] * _BASE + h[first[short[has]] + j]
        own = mix(own + counts[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = np.concatenate([[0], np.cumsum(many)])[short]
        out = np.insert(out, at, own)
        many[short] = 1
    return out, np.concatenate([[0], np.cumsum(many)])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- components -----------------------------------------------------------------------------------------------------


def components(edges: DataFrame, name: str, rounds: int = 40) -> DataFrame:
    """(node, root) of the connected components of edges (a, b); root is the component's least node. Nodes without edges
    aren't returned. Alternates large and small star steps until each node has one parent, then doubles the pointers to parents until
    all lead to roots: the edges stay linear in number, no component is gathered in one task but by its counts, and only
    counts go to the driver. Null ends join nothing; repeated edges and edges to oneself don't matter."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = saved(links, f"{name}-edges")
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: greater neighbours of a node go to the least of its neighbourhood
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its lesser neighbours go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        before, links = links, saved(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), f"{name}-star")
        discard(before)
        # whether each node has one parent, and whether parents have one: told by sums per node, ahead of any shuffle
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("parents"), F.lit(0).alias("children")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("parents"), F.lit(1).alias("children")))
        ends = ends.groupBy("node").agg(F.sum("parents").alias("parents"), F.max("children").alias("children"))
        most, deep = ends.agg(F.max("parents"), F.bool_or((F.col("parents") > 0) & (F.col("children") > 0))).first()
        if not most or most == 1:
            break
    else:
        raise RuntimeError(f"no components after {rounds} rounds")
    while deep:
        up = links.select(F.col("a").alias("parent"), F.col("b").alias("next"))
        before, links = links, saved(links.select("a", "b").join(up, F.col("b") == F.col("parent"), "left").select("a", F.coalesce("next", "b").alias("b"), F.col("next").isNotNull().alias("far")), f"{name}-up")
        discard(before)
        deep = not links.filter("far").isEmpty()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
