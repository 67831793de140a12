"""The audit of filters against every order applied to every row."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from debenture.llm import audit

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        mark = lambda at, i=i: i is not None and any(r[0] == i and r[at] == 1 for r in labels)
        rows.append((lang or "", fails, mark(1), mark(2)))
    out = []
    for part in {r[0] for r in rows}:
        own, taken = [r for r in rows if r[0] == part], {}
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                taken[f] = taken.get(f, 0) + len(gone)
                out.append([part, "".join(order), step, f, len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)])
        for row in out:
            if row[0] == part:
                row.append(taken[row[3]])
    return sorted(map(tuple, out))


def run(spark, docs, labels):
    d = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("x") for c in ("id", "part", "digest", "bits", "n", "quality", "Toxic", "first", "c")})
    return sorted(tuple(r[c] for c in COLUMNS) for r in audit.audit(d, spark.createDataFrame(labels, LABELS)).collect())


def test_against_every_order(spark, monkeypatch):
    rng, docs = random.Random(5), []
    for i in range(90):
        n, few = rng.choice([0, 20, 99, 100, 130]), rng.random() < 0.4
        w = [rng.choice(["aa", "Bb", "c"]) + str(rng.randint(0, 40 if few else 5000)) for _ in range(n)]
        w = [x.upper() if rng.random() < 0.3 else x for x in w] if rng.random() < 0.4 else w
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(w) + (" 100%" if rng.random() < 0.3 else ""), rng.choice(["en", "de", None, ""])))
    docs += [(i, docs[rng.randrange(60)][1], "fr") for i in range(90, 120)]  # copies in another part
    docs += [(5, docs[5][1], "en"), (5, docs[5][1], "en"), (5, "other", "en"), (None, docs[3][1], "de"), (None, None, None), (200, None, "en"), (201, "", "de"), (202, "ÉÉ #", "en"), (203, " \n", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 130, 2), 5, 5, 201]] + [(None, 1, 1)]
    want = brute(docs, labels)
    assert run(spark, docs, labels) == want and len(want) == 600 * 4
    monkeypatch.setattr(audit, "_PARTS", 1)
    assert run(spark, docs, labels) == want
    assert run(spark, docs, []) == brute(docs, [])


def test_many_parts_long_texts_and_empty_tables(spark):
    docs = [(i, "w" * (i % 7), f"p{i % 50}") for i in range(100)] + [(500, " ".join(f"w{i}" for i in range(300_000)), "long"), (501, "Ab " * 400_000, "long")]
    assert run(spark, docs, [(500, 1, 1)]) == brute(docs, [(500, 1, 1)])
    assert run(spark, [], [(1, 1, 1)]) == []
