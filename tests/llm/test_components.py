import random

import pytest

from debenture.llm.common import components


def roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return sorted((x, find(x)) for x in list(parent))


def shuffled_path(rng, first, n):
    nodes = list(range(first, first + n))
    rng.shuffle(nodes)
    return list(zip(nodes, nodes[1:]))


RNG = random.Random(5)
CASES = {
    "paths, stars and pairs": shuffled_path(RNG, -40, 90) + [(1000 + i, 1000) for i in range(300)] + [(2000, i) for i in range(2001, 2300)] + [(3001, 3000)] * 3,
    "a path in order": [(i, i + 1) for i in range(70)],
    "random": [(RNG.randrange(400), RNG.randrange(400)) for _ in range(330)],
    "loops, repeats and nulls": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (5, None)],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_components_against_union_find(spark, case):
    got = components(spark.createDataFrame(CASES[case], "a long, b long"), "test").collect()
    assert sorted(map(tuple, got)) == roots(CASES[case])
