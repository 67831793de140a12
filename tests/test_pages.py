"""Chains of pages against a reader who turns them one by one."""

import random

import pytest

from debenture.operators import pages


def turned(rows):
    following = {}
    for p, n in rows:
        if p is not None:
            following.setdefault(p, []).append(n)
    following = {p: min([n for n in ns if n is not None], default=None) for p, ns in following.items()}

    def read(p):
        out = []
        while p in following and p not in out:
            out.append(p)
            p = following[p]
        return out

    led_to = {n for p, n in following.items() if n != p and n in following}
    chains = {p: read(p) for p in following if p not in led_to}
    met = {p for c in chains.values() for p in c}
    for p in following:
        if p not in met and p == min(read(p)):
            chains[p] = read(p)
    return sorted((c, p, i) for c, ps in chains.items() for i, p in enumerate(ps))


@pytest.mark.parametrize("seed", [1, 2])
def test_chains(spark, seed):
    rng = random.Random(seed)
    rows = [(i, i + 1) for i in range(37)]  # 37 isn't there
    rows += [(100 + i, 100 + (i + 1) % 9) for i in range(9)]  # round and round
    rows += [(200, 201), (201, 202), (202, 203), (203, 201), (210, 202)]  # back into the chain, two begins
    rows += [(300, 300), (301, None), (302, 999), (303, 300)]
    rows += [(400 + i, 400 + rng.randrange(40)) for i in range(40)]
    rows += [(5, 6), (5, 2), (None, 3), (100, 101)]
    rng.shuffle(rows)
    d = spark.createDataFrame(rows, "page long, next long")
    want = turned(rows)
    assert sorted(tuple(r) for r in pages.page_chains(d).collect()) == want
    assert sorted(tuple(r) for r in pages.page_chains(d, most=3).collect()) == [x for x in want if x[2] < 3]


def test_no_pages(spark):
    assert pages.page_chains(spark.createDataFrame([], "page long, next long")).count() == 0
    assert [tuple(r) for r in pages.page_chains(spark.createDataFrame([("a", "b"), ("b", None)], "p string, n string"), "p", "n").orderBy("position").collect()] == [("a", "a", 0), ("a", "b", 1)]
