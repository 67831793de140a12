"""Text: cleaning, sections and contexts as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

#: White space as Python's str has it; Java's \s has less.
SPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def ci(pattern: str) -> str:
    return f"(?i){pattern}"


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def let(value: Column, body) -> Column:
    """body(value), value evaluated once: lambdas don't share subexpressions otherwise."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_text(c: Column, strict: bool = False) -> Column:
    """White space to single spaces, then what isn't ASCII goes (strict: stays), trimmed; null is empty."""

    def cleaned(x: Column) -> Column:
        t = F.regexp_replace(x, SPACE + "+", " ")
        return t if strict else F.regexp_replace(t, r"[^\x{00}-\x{7F}]+", "")

    # printable ASCII without two spaces in a row stays as it is
    return F.trim(let(F.coalesce(c, F.lit("")), lambda x: F.when(F.regexp_like(x, F.lit("[^!-~] |[^ -~]")), cleaned(x)).otherwise(x)))


def first_of(text: Column, patterns: list[str]) -> Column:
    """Place (from 1) of the first match of the first pattern that has one; else null."""
    return F.coalesce(*[F.nullif(F.regexp_instr(text, F.lit(p)), F.lit(0)) for p in patterns])


def section_span(text: Column, marker: str, end: str | None = None, strict: bool = False) -> Column:
    """struct of low (from 1) and high (behind the last character) of the section that `marker` begins, up to the first `end` behind
    it; null where there is none. Markers of distribution and of managers stand for lists of headings, others for themselves.
    strict: `management` is a heading too, either spelling of stabilisation."""
    low, key = F.lower(text), marker.lower()
    if any(x in key for x in ("distribution", "subscription", "placement", "sale")):
        start = first_of(low, P.DISTRIBUTION)
    elif any(x in key for x in ("manager", "book", "lead", "underwriter")) or strict and key == "management":
        start = first_of(low, P.MANAGEMENT)
    elif strict and key.startswith("stabili"):
        start = first_of(low, [r"stabili[sz]ation"])
    else:
        start = F.nullif(F.instr(low, key), F.lit(0))
    behind = F.length(text) + 1

    def cut(s: Column) -> Column:
        stop = behind if end is None else let(F.position(F.lit(end.lower()), low, s + len(marker)), lambda at: F.when(at > 0, at).otherwise(behind))
        return F.when(s.isNotNull(), F.struct(s.alias("low"), stop.alias("high")))

    return let(start, cut)


def find_section(text: Column, marker: str, end: str | None = None, strict: bool = False) -> Column:
    """The text of section_span, trimmed; null where there is none or nothing in it."""
    return let(section_span(text, marker, end, strict), lambda x: empty_to_null(F.trim(F.substring(text, x["low"], x["high"] - x["low"]))))


def document_sections(text: Column, strict: bool = False) -> Column:
    """map of distribution, management, stabilisation; without those that aren't there."""
    found = F.create_map(
        F.lit("distribution"), find_section(text, "distribution", "stabilization", strict),
        F.lit("management"), find_section(text, "managers", "stabilization", strict),
        F.lit("stabilisation"), find_section(text, "stabilization", "listing", strict),
    )
    return F.map_filter(found, lambda _, v: v.isNotNull())


def bank_sections(text: Column, strict: bool = False) -> Column:
    """array of (section, text) that banks are looked for in: to the end of the text; the whole text if none begins."""
    one = lambda name, t: F.when(t.isNotNull(), F.struct(F.lit(name).alias("section"), t.alias("text")))
    end = "listing" if strict else None
    found = F.array_compact(F.array(*[one(s, find_section(text, s, end, strict)) for s in ("distribution", "management", "stabilisation")]))
    whole = F.array(F.struct(F.lit("full_text").alias("section"), text.alias("text")))
    return F.when(text == "", F.array().cast("array<struct<section:string,text:string>>")).otherwise(let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(whole)))


def text_around(text: Column, target: Column, window: int, low: Column | None = None) -> Column:
    """Up to `window` characters on both sides of the first place of target, without regard to case; else empty. low: text in lower
    case, where it is at hand."""

    def cut(at: Column) -> Column:
        begin = F.greatest(at - window, F.lit(1))
        return F.when((at > 0) & (target != ""), F.substring(text, begin, at + F.length(target) + window - begin)).otherwise(F.lit(""))

    return let(F.position(F.lower(target), F.lower(text) if low is None else low), cut)


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def strip_company_suffix(name: Column) -> Column:
    """Without the first suffix of the list that it ends in."""
    out = F
    for s in P.COMPANY_SUFFIXES:
        out = out.when(F.endswith(name, F.lit(s)), F.substring(name, F.lit(1), F.length(name) - len(s)))
    return out.otherwise(name)
