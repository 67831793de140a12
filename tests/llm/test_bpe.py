"""Byte-level BPE by halves against the public library, with leaves of any size."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from debenture.llm import bpe


@pytest.fixture(scope="module")
def library():
    import tiktoken

    b = bpe.Bpe(bpe.default_vocabulary(), bpe.default_pattern())
    return b, tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=b.ranks, special_tokens={})


def same(library, text):
    b, own = library
    ids = b.encode(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == own.encode_ordinary(text), repr(text[:100])
    assert b.decode(ids) == text.encode()


@pytest.mark.parametrize("chars,size", [(1, 1), (2, 3), (5, 4), (64, 16), (8192, 64)])
def test_any_halving_gives_the_library_s_ids(library, monkeypatch, chars, size):
    monkeypatch.setattr(bpe, "LEAF_CHARS", chars)
    monkeypatch.setattr(bpe, "LEAF_BYTES", size)
    library[0].matches.clear()
    rng = random.Random(chars)
    for _ in range(250):
        same(library, "".join(rng.choice("ab'srtvelmdD  \n\t\r 12é漢\U0001f600x'llre!?,.; 　\x1c") for _ in range(rng.randint(0, 60))))
        same(library, "".join(rng.choice(["the", " and", "in", "'re", "'l", "l", "    ", "\n\n", " ", "aaaa", "===", " tokenization", "été"]) for _ in range(rng.randint(0, 40))))
    for _ in range(60):
        same(library, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(0, 300))))
    for c in "a =\n-é":
        for n in (1, 2, 63, 64, 65, 500, 3001):
            same(library, c * n)


def test_merges_in_one_step_are_the_single_ones(library):
    b, rng = library[0], random.Random(2)
    for n in (2, 3, 9, 200, 255):
        for letters in ("a", "ab", "the ", "abcdefghijklmnopqrstuvwxyz"):
            ids = [b.single[ord(rng.choice(letters))] for _ in range(n)]
            assert b._merge_many(ids) == b.merge(ids)


def test_long_texts(library):
    rng = random.Random(3)
    same(library, "a" * 100_000 + " " * 50_000 + "\n")
    same(library, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)))
    same(library, " ".join(rng.choice(["café", "it's", "2024", "x" * 90, "\n\n"]) for _ in range(250_000)))


def test_tables(spark, library):
    rows = [(1, "it's a test", "a"), (2, None, None), (3, "", "b"), (1, "it's a test", "a"), (None, "  x  ", None), (4, "y" * 9000 + " end", "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, at string").withColumns({"IDS": F.lit(1), "data": F.lit("mine"), "part": F.lit(None).cast("int")})
    out = bpe.decode_ids(bpe.encode_texts(d))
    assert out.columns == ["doc_id", "text", "at", "part", "ids", "data"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r["data"]) == (r["text"] or "").encode()
        assert list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])) == library[1].encode_ordinary(r["text"] or "")
    assert bpe.encode_texts(d, columns=["doc_id"]).columns == ["doc_id", "ids"] and bpe.decode_ids(bpe.encode_texts(d.limit(0))).count() == 0
