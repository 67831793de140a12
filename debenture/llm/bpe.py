"""Byte-level BPE as a monoid: texts are encoded in halves and joined again, ids are decoded in blocks and strung together.

What encodes a stretch of text is an element: the matches of the pre-tokenizer's pattern in it, each with its ids. Two neighbours are
joined by looking again only at a window around their boundary, which grows until nothing outside can change:

* matches. Where a match begins, only what follows matters, so two scans that begin a match at the same place agree from there on.
  The pattern never looks further than two characters beyond a match's end; what the left element has up to there stands. From
  the first match that doesn't, the text is scanned again until a match begins where one of the right element begins.
* merges within a match. Ids are the encoding of their bytes if, and only if, each two neighbours among them are the encoding of
  their joined bytes: the first merge across a boundary would be seen in that pair alone as well. So a window of ids around the
  boundary is merged anew, wider on the side where its edge doesn't fit, until both edges fit.

Both are exact, so any way of halving gives the ids of the whole text (tests/llm hold them against the public library).
"""

from __future__ import annotations

import base64
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a text, and bytes of a match, that are encoded at once; what is longer is halved.
LEAF_CHARS, LEAF_BYTES = 8192, 64
#: Matches and neighbours whose result a worker remembers; then it starts anew.
MEMORY = 400_000
#: Bytes of ids that leave a worker in one batch, unless a row alone has more.
BATCH_BYTES = 4 << 20
#: Characters beyond a match's end that the pattern looks at, at most: 're needs two behind the '.
_AHEAD = 2
_kept: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Bpe:
    """Ranks and pattern, with what a worker remembers of short matches."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.pattern = regex.compile(pattern)
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.bytes[i] = token
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.longest = max(map(len, self.ranks))
        # each two ids whose bytes together are a token's
        self.merged = {(self.ranks[t[:k]], self.ranks[t[k:]]): i for t, i in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks}
        key = np.fromiter(((a << 32) | b for a, b in self.merged), np.int64, len(self.merged))
        rank = np.fromiter(self.merged.values(), np.int64, len(self.merged))
        order = np.argsort(key)
        self.pair_key, self.pair_rank = key[order], rank[order]
        self.matches: dict[str, bytes] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    # --- merges within a match ---

    def merge(self, ids: list[int]) -> list[int]:
        """The two neighbours of least rank, the leftmost of them, become one, until none can."""
        if len(ids) > 4 * LEAF_BYTES:
            return self._merge_many(ids)
        ids, get, none = list(ids), self.merged.get, 1 << 60
        rank = [get(p, none) for p in zip(ids, ids[1:])]  # noqa: B905
        while rank:
            least = min(rank)
            if least == none:
                break
            i = rank.index(least)
            ids[i : i + 2] = [least]
            del rank[i]
            if i:
                rank[i - 1] = get((ids[i - 1], least), none)
            if i < len(rank):
                rank[i] = get((least, ids[i + 1]), none)
        return ids

    def _rank_of(self, ids: np.ndarray) -> np.ndarray:
        key = (ids[:-1] << 32) | ids[1:]
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], 1 << 60)

    def _merge_many(self, ids: list[int]) -> list[int]:
        """As merge, all pairs of the least rank in one step; where that makes a pair of still lower rank, only the leftmost."""
        ids = np.array(ids, np.int64)
        while len(ids) > 1:
            rank = self._rank_of(ids)
            least = int(rank.min())
            if least == 1 << 60:
                break
            at = np.flatnonzero(rank == least)
            # of pairs that overlap, every other from the left
            fresh = np.concatenate([[True], np.diff(at) > 1])
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]

            def taken(at):
                out = ids.copy()
                out[at] = least
                return np.delete(out, at + 1)

            new = taken(at)
            if len(at) > 1 and len(new) > 1 and int(self._rank_of(new).min()) < least:
                new = taken(at[:1])
            ids = new
        return ids.tolist()

    def _fit(self, a: int, b: int) -> bool:
        """Whether a and b, as neighbours, are the encoding of their bytes."""
        out = self.fits.get((a, b))
        if out is None:
            if len(self.fits) > MEMORY:
                self.fits.clear()
            out = self.fits[a, b] = self.merge([self.single[x] for x in self.bytes[a] + self.bytes[b]]) == [a, b]
        return out

    def join_ids(self, a: list[int], b: list[int]) -> list[int]:
        """The ids of the bytes of a, then b, both encodings of bytes of one match."""
        if not a or not b or self._fit(a[-1], b[0]):
            return [*a, *b]
        left, right = min(2, len(a)), min(2, len(b))
        while True:
            window = b"".join(self.bytes[i] for i in a[len(a) - left :] + b[:right])
            ids = self.merge([self.single[x] for x in window])
            wider_left = left < len(a) and not self._fit(a[len(a) - left - 1], ids[0])
            wider_right = right < len(b) and not self._fit(ids[-1], b[right])
            if not wider_left and not wider_right:
                return a[: len(a) - left] + ids + b[right:]
            left = min(len(a), 2 * left) if wider_left else left
            right = min(len(b), 2 * right) if wider_right else right

    def _match_ids(self, data: bytes, seen: dict[bytes, list[int]]) -> list[int]:
        """seen: halves of this match so far; those of a run of one character are few."""
        out = seen.get(data)
        if out is None:
            if len(data) <= LEAF_BYTES:
                out = self.merge([self.single[x] for x in data])
            else:
                half = len(data) // 2
                out = self.join_ids(self._match_ids(data[:half], seen), self._match_ids(data[half:], seen))
            seen[data] = out
        return out

    def _code(self, match: str) -> bytes:
        """The ids of one match, as bytes."""
        data = match.encode()
        if len(data) <= self.longest and data in self.ranks:
            ids = [self.ranks[data]]
        else:
            ids = self._match_ids(data, {})
        out = np.array(ids, "<u4").tobytes()
        if len(data) <= LEAF_BYTES:
            if len(self.matches) > MEMORY:
                self.matches.clear()
            self.matches[match] = out
        return out

    # --- elements: lists of blocks (where each match begins, its ids) ---

    def _leaf(self, text: str, low: int, high: int) -> list:
        found = self.pattern.findall(text, low, high)
        known, codes = self.matches.get, []
        for m in found:
            codes.append(known(m) or self._code(m))
        return [([*accumulate(map(len, found), initial=low)][:-1], codes)] if found else []

    def join(self, text: str, a: list, b: list, middle: int, high: int) -> list:
        """The element of a's text and b's, that meet at `middle`; b's ends at `high`."""
        if not a or not b:
            return a or b
        a, b = list(a), list(b)
        # what a's matches have up to two characters before its end stands
        at, end = middle, middle
        while a:
            starts, codes = a.pop()
            keep = len(starts)
            while keep and end > middle - _AHEAD:
                keep -= 1
                at = end = starts[keep]
            if keep:
                a.append((starts[:keep], codes[:keep]))
                break
        begins, new = [], []
        k = i = 0
        while k < len(b):
            starts = b[k][0]
            while i < len(starts) and starts[i] < at:
                i += 1
            if i == len(starts):
                k, i = k + 1, 0
            elif starts[i] == at:
                break
            else:
                m = self.pattern.match(text, at, high).group()
                begins.append(at)
                new.append(self.matches.get(m) or self._code(m))
                at += len(m)
        while k == len(b) and at < high:
            m = self.pattern.match(text, at, high).group()
            begins.append(at)
            new.append(self.matches.get(m) or self._code(m))
            at += len(m)
        rest = [(b[k][0][i:], b[k][1][i:]), *b[k + 1 :]] if k < len(b) else []
        out = a + ([(begins, new)] if begins else []) + rest
        # only the blocks at the edges are ever looked into again
        return out[:1] + [x if len(x[0]) == 1 else (x[0][:1], [b"".join(x[1])]) for x in out[1:-1]] + out[1:][-1:]

    def element(self, text: str, low: int, high: int) -> list:
        if high - low <= LEAF_CHARS:
            return self._leaf(text, low, high)
        middle = (low + high) // 2
        return self.join(text, self.element(text, low, middle), self.element(text, middle, high), middle, high)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        return b"".join(code for _, codes in self.element(text, 0, len(text)) for code in codes)

    def decode(self, ids: bytes) -> bytes:
        """Halves of the ids decoded and strung together; any halving gives the same."""
        if len(ids) <= 4 * LEAF_CHARS:
            return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def bpe(path: str, pattern: str) -> Bpe:
    """One per worker process and vocabulary."""
    if (path, pattern) not in _kept:
        _kept[path, pattern] = Bpe(path, pattern)
    return _kept[path, pattern]


def _mapped(df: DataFrame, column: str, name: str, work) -> DataFrame:
    """df with a binary column `name`: work() gives a function from a value of `column` (null: empty) to bytes; replaces a column
    of that name. Rows go on in batches of bounded size."""
    names = [c for c in df.columns if c.lower() != name.lower()]
    d = df.select(*[F.col(f"`{c}`") for c in names], *([] if column in names else [F.col(f"`{column}`")]))
    at, keep = d.columns.index(column), len(names)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:keep]] + [f"`{name}` binary"])

    def run(batches):
        one = work()
        for batch in batches:
            done, out, size = 0, [], 0
            for i in range(batch.num_rows):
                out.append(one(batch.column(at)[i].as_py()))
                size += len(out[-1])
                if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(done, len(out))
                    yield pa.RecordBatch.from_arrays([*part.columns[:keep], pa.array(out, pa.binary())], names=[*names, name])
                    done, out, size = i + 1, [], 0

    return d.mapInArrow(run, schema)


def encode_texts(docs: DataFrame, text: str = "text", ids: str = "ids", columns: list[str] | None = None, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """`columns` of docs (default all) with `ids`: the ids of each whole text as little-endian unsigned 32-bit integers in binary.

    Null and empty texts have no ids. Texts of any length are encoded whole, in halves. Repeated rows get equal ids, an empty table
    no rows. A column named like `ids` is replaced, others are carried along whatever their names; a null in them doesn't matter."""
    path, rule = vocabulary or default_vocabulary(), pattern or default_pattern()
    d = docs if columns is None else docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text])])

    def work():
        b = bpe(path, rule)
        return lambda x: b.encode(x) if x else b""

    out = _mapped(d, text, ids, work)
    return out if columns is None else out.select(*[F.col(f"`{c}`") for c in columns if c.lower() != ids.lower()], F.col(f"`{ids}`"))


def decode_ids(encoded: DataFrame, ids: str = "ids", data: str = "data", vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """encoded with `data`: the bytes that each row's `ids` stand for; null or no ids: none. An id that isn't in the vocabulary stops
    the query. A column named like `data` is replaced."""
    path, rule = vocabulary or default_vocabulary(), pattern or default_pattern()

    def work():
        b = bpe(path, rule)
        return lambda x: b.decode(x) if x else b""

    return _mapped(encoded, ids, data, work)
