"""Centroid clustering against Lloyd's rounds over every row in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from debenture.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components, k, rounds, scale=1024):
    kept = [(i, tuple(math.floor(scale * float(np.float32(x))) for x in v)) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in starts] or sorted({v for _, v in kept})[:k]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == c]
            if own:
                centroids[c] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    got = [(i, *reversed(near(v))) for i, v in kept]
    inertia = {}
    for _, c, d in got:
        inertia[c] = inertia.get(c, 0) + d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in got), key=str)


def run(spark, rows, **kw):
    d = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in clusters.clustered(d, **kw).collect()), key=str)


def vectors(rng, n, components):
    return [[rng.gauss(0, 0.3) for _ in range(components)] for _ in range(n)]


def test_against_every_row(spark, monkeypatch):
    rng = random.Random(4)
    base = vectors(rng, 40, 6)
    rows = [*enumerate(base)] + [(100 + i, base[i % 3]) for i in range(60)]  # copies
    rows += [(7, base[7]), (7, base[7]), (8, base[9]), (None, base[1]), (None, base[11])]  # repeated rows and ids, no ids
    rows += [(200, None), (201, []), (202, base[0][:5]), (203, [*base[0], 1.0]), (204, [None, *base[0][1:]]), (205, [math.nan, *base[0][1:]]), (206, [-math.inf, *base[0][1:]])]
    want = brute(rows, 6, 5, 10)
    assert len({r[1] for r in want}) == 5 and run(spark, rows, components=6, k=5) == want
    # no row is common, every row is
    for most in (0, 10**9):
        monkeypatch.setattr(clusters, "MOST_COMMON", most)
        assert run(spark, rows, components=6, k=5) == want


def test_ties_few_rows_and_large_values(spark):
    same = [(i, [0.5, 0.25]) for i in range(9)]
    got = run(spark, same, components=2, k=3)  # equal centroids: the smaller number
    assert got == brute(same, 2, 3, 10) and {r[1] for r in got} == {0}
    two = [(1, [0.0, 0.0]), (2, [3.0, 4.0])]
    assert run(spark, two, components=2, k=8) == brute(two, 2, 8, 10)
    wide = [(i, [10_000.0 * (i % 3), -70_000.0 + i]) for i in range(12)]
    assert run(spark, wide, components=2, k=3) == brute(wide, 2, 3, 10)
    assert run(spark, [(None, [0.1, 0.2]), (None, [0.1, -0.2])], components=2) == brute([(None, [0.1, 0.2]), (None, [0.1, -0.2])], 2, 8, 10)
    with pytest.raises(Exception, match="a component beyond"):
        run(spark, [(1, [0.0, 200_000.0])], components=2)


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, v int, N string, Cluster string")
    assert clusters.clustered(none).count() == 0 and run(spark, [(1, None), (2, [1.0])]) == []
    some = spark.createDataFrame([(1, [0.5] * 64, 5, "x", "mine"), (2, None, 6, None, None)], none.schema)
    got = clusters.clustered(some).collect()
    assert [(r["vec_id"], r["v"], r["N"], r["cluster"], r["distance"]) for r in got] == [(1, 5, "x", 0, 0)]
