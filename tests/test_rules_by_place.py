"""The one-pass prefilter, places of matches and the join of banks and roles by place."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from debenture.functions import anchors, extract, text
from debenture.functions import patterns as P
from debenture.operators import mentions

RULES = [*P.BANKS, *P.BANK_ROLES, *P.ISSUE_DATE, *P.MATURITY_DATE, *P.COUPON_RATE, *P.COUPON_TYPES, *P.ISSUE_SIZE, *P.AMOUNT_PHRASES, P.PROGRAMME]


@pytest.mark.parametrize("rule", sorted(set(RULES)))
def test_every_match_holds_an_anchor(rule):
    @settings(max_examples=25, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(re.compile(rule, re.IGNORECASE | re.ASCII), fullmatch=True))
    def holds(match):
        assert any(w in match.lower() for w in anchors._all()[rule]), match

    assert anchors._all()[rule]
    holds()


def test_anchors_overlap_and_rules_find_the_same(spark):
    texts = ["JPMorgan Chase and msgs, lending; Bank of AmericaN, NatWest Markets", "the Dealer-Managers and Joint Lead Managers: UBS, RBC", "", "Nothing here", "fc123_20240102_ x"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    hits = {r[0]: set(r[1]) for r in d.select("i", anchors.found(F.col("t"))).collect()}
    every = {w for ws in anchors._all().values() for w in ws}
    assert hits == {i: {w for w in every if w in t.lower()} for i, t in enumerate(texts)}
    for rules in (P.BANKS, P.BANK_ROLES):
        both = d.select(extract.all_matches(F.col("t"), rules).alias("a"), extract.all_matches(F.col("t"), rules, anchors.found(F.col("t"))).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in both) and any(r["a"] for r in both)


def test_places(spark):
    d = spark.createDataFrame([("xUBS, UBS and ubs; HSBC UBS",), ("",), ("UBSHSBC",), ("HSBC",)], "t string")
    got = [[(x["at"], x["value"]) for x in r[0]] for r in d.select(mentions.places(F.col("t"), mentions.NAMES)).collect()]
    assert got == [[(7, "UBS"), (20, "HSBC"), (25, "UBS")], [], [], [(1, "HSBC")]]


def test_spans_are_the_sections(spark):
    t = "Intro. Plan of distribution here. Joint lead managers: UBS. Stabilisation may occur. Listing on the exchange. Managers again"
    d = spark.createDataFrame([(t,), ("none",), ("x Listing Distribution",)], "t string")
    for name in ("distribution", "management", "stabilisation"):
        span = text.section_span(F.col("t"), name, "listing", strict=True)
        rows = d.select("t", span.alias("s"), text.find_section(F.col("t"), name, "listing", strict=True).alias("f")).collect()
        assert [r["t"][r["s"]["low"] - 1 : r["s"]["high"] - 1].strip() if r["s"] else None for r in rows] == [r["f"] for r in rows]


def test_roles_by_place(spark):
    far = " and so on" * 60
    rows = [
        (1, f"Placement of the notes. HSBC is here.{far} The Dealer HSBC sold."),  # near at the second place only
        (2, f"UBS {far}, {far} Manager"),
        (3, "Managers: Barclays. Listing: Barclays, Paying Agent"),  # the second place is behind the section
        (3, "Managers: Barclays. Listing: Barclays, Paying Agent"),
        (4, None),
        (5, ""),
    ]
    got = mentions.bank_roles_by_place(spark.createDataFrame(rows, "doc_id long, t string")).collect()
    near = len("The Dealer ") - len("The Dealer")
    # document 2's section begins behind its bank
    assert sorted((r["doc_id"], r["section"], r["bank"], r["role"], r["n"], r["distance"]) for r in got) == [(1, "distribution", "HSBC", "dealer", 1, near), (3, "management", "Barclays", "managers", 1, 2)]
    # stretches of any size give the same
    before, mentions.STRETCH = mentions.STRETCH, 120
    try:
        assert sorted(map(str, mentions.bank_roles_by_place(spark.createDataFrame(rows, "doc_id long, t string")).collect())) == sorted(map(str, got))
    finally:
        mentions.STRETCH = before
