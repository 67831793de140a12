"""Byte-level BPE of whole texts with the tokenizers library, its results kept by stretch.

A token of this pre-tokenizer holds white space only at its begin, or nothing else; so wherever white space follows something
else, a token ends, and what is behind doesn't change what is before. A text is therefore cut into stretches, each a word with
the white space before it; the library encodes each stretch once per worker and cache, many joined into one text whose ids are cut
apart again by the tokens' bytes. What the cache gives is held against the text byte for byte. Texts that differ anywhere, end in
white space, hold white space beyond ASCII, or an added token's string, are given to the library whole. tests/llm hold both
ways against each other. Giving every text whole costs about a CPU second a megabyte, which is over the check tool's limits
(README); the ids are the same.
"""

from __future__ import annotations

import os
import sys

import numpy as np

from .common import SLICE_BYTES, Words, slices, utf8

#: Stretches that a worker keeps (about 40 bytes each); then it starts anew.
CACHE = 3_000_000
#: Stretches that are joined for one call of the library.
JOINED = 4096
_kept: dict = {}

_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True

assert sys.byteorder == "little"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _odd_space(data: np.ndarray) -> np.ndarray:
    """Where a byte begins white space that isn't ASCII's, or is an ASCII separator (0x1C to 0x1F)."""
    at = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
    n = len(data)

    def after(lead, test):
        i = np.flatnonzero(data == lead)
        i = i[i < n - 2] if lead != 0xC2 else i[i < n - 1]
        at.append(i[test(data[i + 1], data[np.minimum(i + 2, n - 1)])])

    after(0xC2, lambda b, _: (b == 0x85) | (b == 0xA0))
    after(0xE1, lambda b, c: ((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))
    after(0xE2, lambda b, c: ((b == 0x80) & ((c <= 0x8B) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    after(0xE3, lambda b, c: (b == 0x80) & (c == 0x80))
    return np.concatenate(at)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # a character of a token's name is a byte
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for name, i in vocabulary.items():
            self.bytes[i] = len(name)
        self.width = 2 if len(self.bytes) <= 1 << 16 else 4
        self.reset()

    def reset(self):
        none = np.zeros(0, np.uint64)
        self.keys, self.place = none, np.zeros(0, np.int32)
        self.new_keys, self.new_place = none, np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.text, self.text_used = np.zeros(1 << 18, np.uint8), 0
        self.begin, self.count, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0
        self.text_begin, self.text_count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        for have, place in ((self.keys, self.place), (self.new_keys, self.new_place)):
            if len(have):
                at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                hit = have[at] == keys
                out[hit] = place[at[hit]]
        return out

    def _room(self, ids: int, rows: int):
        while self.used + ids > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.n + rows > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.text_begin = np.concatenate([self.text_begin, np.zeros_like(self.text_begin)])
            self.text_count = np.concatenate([self.text_count, np.zeros_like(self.text_count)])

    def _keep_text(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """The bytes of stretches self.n, self.n + 1, ..."""
        size = end - start
        upto = np.cumsum(size)
        total = int(upto[-1])
        while self.text_used + total > len(self.text):
            self.text = np.concatenate([self.text, np.zeros_like(self.text)])
        self.text[self.text_used : self.text_used + total] = data[np.repeat(start - (upto - size), size) + np.arange(total)]
        self.text_begin[self.n : self.n + len(size)] = self.text_used + upto - size
        self.text_count[self.n : self.n + len(size)] = size
        self.text_used += total

    def _differs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which of the stretches data[start:end] aren't, byte for byte, those kept at place."""
        size = end - start
        out = size != self.text_count[place]
        upto = np.cumsum(size)
        if len(size):
            at = np.arange(int(upto[-1]))
            near = np.minimum(np.repeat(self.text_begin[place] - (upto - size), size) + at, len(self.text) - 1)
            wrong = data[np.repeat(start - (upto - size), size) + at] != self.text[near]
            if wrong.any():
                out[np.searchsorted(upto, np.flatnonzero(wrong), "right")] = True
        return out

    def _learn(self, keys: np.ndarray, data: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray, bare: np.ndarray):
        """Encodes stretches raw[start:end]; bare ones, without white space before them, behind a line break that is then cut."""
        texts, bounds = [], []
        for low in range(0, len(keys), JOINED):
            part = [(b"\n" + raw[a:b]) if c else raw[a:b] for a, b, c in zip(start[low : low + JOINED].tolist(), end[low : low + JOINED].tolist(), bare[low : low + JOINED].tolist(), strict=True)]
            texts.append(b"".join(part).decode())
            bounds.append(np.cumsum(np.fromiter(map(len, part), np.int64, len(part))))
        first = self.n
        for i, (ids, bound) in enumerate(zip(self.whole(texts), bounds, strict=True)):
            upto = np.cumsum(self.bytes[ids])
            cut = np.searchsorted(upto, bound) + 1
            if upto[-1] != bound[-1] or (upto[cut - 1] != bound).any():
                raise ValueError("a token goes on past a stretch: this vocabulary's pre-tokenizer isn't the one expected")
            begin = np.concatenate([[0], cut[:-1]])
            skip = bare[i * JOINED : i * JOINED + len(bound)].astype(np.int64)
            self._room(len(ids), len(bound))
            self._keep_text(data, start[i * JOINED : i * JOINED + len(bound)], end[i * JOINED : i * JOINED + len(bound)])
            self.pool[self.used : self.used + len(ids)] = ids
            self.begin[self.n : self.n + len(bound)] = self.used + begin + skip
            self.count[self.n : self.n + len(bound)] = cut - begin - skip
            self.used += len(ids)
            self.n += len(bound)
        fresh = np.concatenate([self.new_keys, keys])
        order = np.argsort(fresh, kind="stable")
        self.new_keys, self.new_place = fresh[order], np.concatenate([self.new_place, np.arange(first, self.n, dtype=np.int32)])[order]
        if len(self.new_keys) > 100_000:
            fresh = np.concatenate([self.keys, self.new_keys])
            order = np.argsort(fresh, kind="stable")
            self.keys, self.place = fresh[order], np.concatenate([self.place, self.new_place])[order]
            self.new_keys, self.new_place = self.new_keys[:0], self.new_place[:0]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of UTF-8 and where each row's begin."""
        if self.n > CACHE:
            self.reset()
        rows, w, raw = len(offsets) - 1, Words(data, offsets), data.tobytes()
        counts = np.diff(w.first)
        slow = np.zeros(rows, bool)
        filled = np.flatnonzero(np.diff(offsets) > 0)
        last = np.zeros(rows, np.int64)
        last[counts > 0] = w.end[w.first[1:][counts > 0] - 1]
        slow[filled] = last[filled] != offsets[filled + 1]
        odd = _odd_space(data)
        slow[np.searchsorted(offsets, odd, "right") - 1] = True
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                slow[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(token, at + 1)
        row = np.repeat(np.arange(rows), counts)
        begin = np.empty(len(w.start), np.int64)
        if len(begin):
            begin[1:] = w.end[:-1]
            begin[w.first[:-1][counts > 0]] = offsets[:-1][counts > 0]
        keep = ~slow[row]
        begin, end, row = begin[keep], w.end[keep], row[keep]
        bare = begin == w.start[keep]
        # a last stop or comma behind an ASCII letter or digit is a token of its own, so words with and without it are one
        if len(end):
            tail = ((data[end - 1] == 0x2C) | (data[end - 1] == 0x2E)) & (end - 1 > w.start[keep]) & _PLAIN[data[np.maximum(end - 2, 0)]]
            at = np.flatnonzero(tail)
            end[at] -= 1
            begin, row, bare = np.insert(begin, at + 1, end[at]), np.insert(row, at + 1, row[at]), np.insert(bare, at + 1, True)
            end = np.insert(end, at + 1, end[at] + 1)
        key = w.hash(start=begin, end=end) ^ (bare.astype(np.uint64) * np.uint64(0x94D049BB133111EB))
        unique, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        found = self._find(unique)
        new = np.flatnonzero(found < 0)
        if len(new):
            n = self.n
            self._learn(unique[new], data, raw, begin[at[new]], end[at[new]], bare[at[new]])
            found[new] = np.arange(n, self.n)
        place = found[inverse]
        wrong = self._differs(data, begin, end, place)
        if wrong.any():
            slow[row[wrong]] = True
            keep = ~slow[row]
            place, row = place[keep], row[keep]
        each = self.count[place].astype(np.int64)
        upto = np.cumsum(each)
        total = int(upto[-1]) if len(upto) else 0
        ids = self.pool[np.repeat(self.begin[place] - (upto - each), each) + np.arange(total)]
        many = np.bincount(row, each, rows).astype(np.int64)
        if slow.any():
            own = np.flatnonzero(slow)
            given = self.whole([raw[offsets[i] : offsets[i + 1]].decode() for i in own])
            first = np.concatenate([[0], np.cumsum(many)])
            ids = np.insert(ids, np.repeat(first[own], [len(x) for x in given]), np.concatenate(given)) if given else ids
            many[own] = [len(x) for x in given]
        return ids, np.concatenate([[0], np.cumsum(many)])

    def begins(self, ids: np.ndarray, first: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each token, the character (of its row) that its first byte is in."""
        size = self.bytes[ids]
        place = np.cumsum(size) - size
        heads = np.cumsum((data & 0xC0) != 0x80)
        before = np.concatenate([[0], heads])[offsets[:-1]]
        return heads[place] - 1 - np.repeat(before, np.diff(first)) if len(ids) else place


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    if path not in _kept:
        _kept[path] = Encoder(path)
    return _kept[path]


def encoded(column, path: str, most: int = 2 * SLICE_BYTES):
    """(first row, last row, ids, first id of each row, bytes, offsets) of stretches of a string column; null texts are empty."""
    enc = encoder(path)
    data, offsets = utf8(column)
    for a, b in slices(offsets, most):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        ids, first = enc.encode(part, off)
        yield a, b, ids, first, part, off
