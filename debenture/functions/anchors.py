"""Which rules can match a text at all: letters that a rule's every match holds, all looked for in one pass.

The anchors of all rules are one automaton, a trie written as a regular expression, that is tried at each character of the text
in lower case behind a lookahead, so that anchors may overlap. No anchor begins with another one. Rules none of whose anchors
are there aren't run. The texts that rules are given may lack white space beside symbols or have other date separators than
the text that was looked through; neither makes an anchor.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import let

#: Of a family of rules, letters of which one at least is in each match of a rule that has them in its pattern.
STEMS = {
    "roles": ["runner", "manager", "arranger", "dealer", "coordinator", "advisor", "agent", "bank", "trustee", "registrar", "underwriter", "purchaser"],
    "issue": ["date", "issu", "fc\\d+"],
    "maturity": ["matur", "redemption", "due"],
    "rate": ["%"],
    "kind": ["fixed", "floating", "zero", "step", "inflation", "index", "variable", "structured", "range", "discount", "premium"],
    "size": ["amount", "size", "denominated"],
    "phrase": ["%", "amount", "size", "issu"],
    "programme": ["programme"],
}
#: What stands in the text for a stem that is written otherwise in the rule or made by its normal form.
_WRITTEN = {"fc\\d+": ["fc"], "%": ["%", "cent"]}
_RULES = {"roles": P.BANK_ROLES, "issue": P.ISSUE_DATE, "maturity": P.MATURITY_DATE, "rate": P.COUPON_RATE, "kind": P.COUPON_TYPES, "size": P.ISSUE_SIZE, "phrase": P.AMOUNT_PHRASES, "programme": [P.PROGRAMME]}


def of_name(pattern: str) -> list[str]:
    """The longest run of letters in the pattern of a name, without what may be left out."""
    must = re.sub(r"\(\?:[^()]*\)\?|\[[^\]]*\]|\\[a-zA-Z.][*+?]?|[^A-Za-z]", " ", pattern)
    return [max(must.split(), key=len).lower()]


@cache
def _all() -> dict[str, tuple[str, ...]]:
    """Of each rule its anchors; an anchor that begins with another one is replaced by that one."""
    out = {p: of_name(p) for p in P.BANKS}
    for family, rules in _RULES.items():
        for p in rules:
            out[p] = [w for s in STEMS[family] if s in p.lower() for w in _WRITTEN.get(s, [s])]
    every = sorted({w for ws in out.values() for w in ws})
    head = lambda w: min((v for v in every if w.startswith(v)), key=len)
    return {p: tuple(dict.fromkeys(map(head, ws))) for p, ws in out.items()}


def _trie(words: list[str]) -> str:
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})

    def written(node: dict) -> str:
        parts = [re.escape(c) + written(n) for c, n in sorted(node.items())]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})" if parts else ""

    return written(tree)


def found(text: Column, rules: list[str] | None = None) -> Column:
    """The anchors in text, once each; with rules only theirs, which are few and looked for one by one."""
    if rules is not None:
        words = sorted({w for p in rules for w in _all().get(p, ())})
        return let(F.lower(text), lambda low: F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)))
    words = sorted({w for ws in _all().values() for w in ws})
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?=({_trie(words)}))"), 1))


def within(text: Column, hits: Column | None, body, rules: list[str] | None = None) -> Column:
    """body(hits), with the text's own where none are given, of these rules or all."""
    return body(hits) if hits is not None else let(found(text, rules), body)


def may_match(hits: Column, pattern: str) -> Column:
    """Whether a rule has an anchor among hits; one that isn't known always may."""
    words = _all().get(pattern, ())
    if not words:
        return F.lit(True)
    return F.array_contains(hits, words[0]) if len(words) == 1 else F.arrays_overlap(hits, F.array(*[F.lit(w) for w in words]))
