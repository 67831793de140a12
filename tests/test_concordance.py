import random
import re

from debenture.operators.concordance import concordance, positions


def test_against_brute_force(spark):
    rng = random.Random(3)
    some = ["Bank", "of", "America", "BNP", "Paribas", "the", "bank", "Bank"]
    texts = ["".join(rng.choice(some) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(rng.randrange(0, 60))) for _ in range(40)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "BNP Paribas"), (7, texts[7]), (8, "Bank of Bank of Bank"), (90, None), (91, "")]
    names = ["Bank of America", "BNP Paribas", "Bank", "Bank Bank", "Bank of Bank", "nowhere", "", "--", None, "Bank", "BNP-Paribas"]
    split = lambda s: re.findall(r"\w+", s or "")
    want = set()
    for i, t in set(docs):
        for x in set(names):
            w, v = split(t), split(x)
            at = [k for k in range(len(w) - len(v) + 1) if v and w[k : k + len(v)] == v]
            if at:
                want.add((i, x, len(at), at[0]))
    d = spark.createDataFrame([(*r, "clash", "clash") for r in docs], "doc_id long, text string, word string, name string")
    got = concordance(positions(d), spark.createDataFrame([(x, 1) for x in names], "name string, word long")).collect()
    assert {(r["doc_id"], r["name"], r["n"], r["first"]) for r in got} == want and len(got) == len(want)


def test_empty(spark):
    docs, names = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([("a",)], "name string")
    assert concordance(positions(docs.limit(0)), names).count() == concordance(positions(docs), names.limit(0)).count() == 0
