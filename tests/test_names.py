"""Names against a table of aliases: by hand, and against every pair."""

import random

from pyspark.sql import functions as F

from debenture.functions import extract
from debenture.operators import names


def subsequence(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        now = [0]
        for j, b in enumerate(y, 1):
            now.append(row[j - 1] + 1 if a == b else max(row[j], now[-1]))
        row = now
    return row[-1]


def like(x, y):
    return round(200 * subsequence(x, y) / max(len(x) + len(y), 1))


def ratio(a, b):
    k, m = set(a.split()), set(b.split())
    common, x, y = sorted(k & m), sorted(k - m), sorted(m - k)
    if common and (not x or not y):
        return 100
    c, one, two = " ".join(common), " ".join(common + x), " ".join(common + y)
    return max(like(c, one), like(c, two), like(one, two)) if common else like(one, two)


def test_by_hand(spark):
    aliases = spark.createDataFrame([("bnp", "BNP Paribas"), ("bnp paribas sa", "BNP Paribas"), ("deutsche bank ag", "Deutsche Bank"), ("db", "Deutsche Bank"), ("db", "A"), (None, "x"), ("bank", "Bank")], "alias string, standard string")
    d = spark.createDataFrame([("bnp",), ("deutche bank ag",), ("db",), ("paribas bnp fortis",), ("unknown",), (None,), ("",), ("bnp",)], "name string")
    got = {r["name"]: (r["standard"], r["score"]) for r in names.standardised(d, aliases).collect()}
    # "bank" and "bnp" are all of an alias's words; of equal scores the last standard
    assert got == {"bnp": ("BNP Paribas", 100.0), "deutche bank ag": ("Bank", 100.0), "db": ("Deutsche Bank", 100.0), "paribas bnp fortis": ("BNP Paribas", 100.0)}
    without = aliases.filter("alias not in ('bank', 'bnp')")
    # deutche bank ag: 15 letters of 15 and 16 in one order; bnp paribas are 11 letters of these and of the 14 with sa
    assert {r["name"]: r["score"] for r in names.standardised(d, without).collect()} == {"deutche bank ag": 97.0, "db": 100.0, "bnp": 100.0, "paribas bnp fortis": 88.0}
    assert names.standardised(d.limit(0), aliases).count() == 0 == names.standardised(d, aliases.limit(0)).count()


def test_against_every_pair(spark):
    rng = random.Random(7)
    words = ["bank", "of", "credit", "union", "first", "national", "trust", "deutsche", "santander", "holding"]

    def some():
        w = rng.sample(words, rng.randint(1, 4))
        return " ".join(x if rng.random() < 0.7 else x[: rng.randint(1, len(x))] for x in w)

    n, a = {some() for _ in range(120)}, {some(): f"s{i % 9}" for i in range(60)}
    want = {}
    for x in n:
        found = [(100.0, a[x])] if x in a else [(float(r), s) for y, s in a.items() if set(x.split()) & set(y.split()) and (r := ratio(x, y)) >= 85]
        if found:
            want[x] = max(found)
    got = names.standardised(spark.createDataFrame([(x,) for x in n], "name string"), spark.createDataFrame([*a.items()], "alias string, standard string")).collect()
    assert {r["name"]: (r["score"], r["standard"]) for r in got} == want and len(want) > 40


def test_common_subsequence_of_any_length(spark):
    rng = random.Random(9)
    pairs = [("".join(rng.choice("abc") for _ in range(i)), "".join(rng.choice("abé") for _ in range(j))) for i, j in ((0, 0), (0, 5), (1, 1), (61, 70), (62, 62), (62, 90), (63, 63), (63, 80), (130, 64), (20, 11))]
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, x string, y string")
    got = d.select("i", extract.common_subsequence(F.col("x"), F.col("y")).alias("n")).collect()
    assert {r["i"]: r["n"] for r in got} == {i: subsequence(*p) for i, p in enumerate(pairs)}
