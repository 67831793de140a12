"""Banks and roles by their places: an interval join of matches, in place of contexts searched pair by pair.

A text is looked through once for names and once for roles, whatever sections it has; each match is a row with its place. Matches meet
by stretches of the text that they lie in, so a long document's matches come together in many tasks, and a pair counts where
both lie in one section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debenture.functions import patterns as P
from debenture.functions.extract import clean_bank_name, is_valid_bank_name
from debenture.functions.text import let, section_span

#: Characters of a stretch in which matches meet; the window and any name or role are shorter.
STRETCH = 512
SECTIONS = ("distribution", "management", "stabilisation")
#: A name or role of the lists as a word of its own, the longest at a place; a name in capitals only in capitals.
NAMES = r"\b(?:" + "|".join(p if p.isupper() else f"(?i:{p})" for p in sorted(dict.fromkeys(P.BANKS), key=lambda p: (-len(p), p))) + r")\b"
ROLES = r"(?i)\b(?:" + "|".join(sorted(dict.fromkeys(P.BANK_ROLES), key=lambda p: (-len(p), p))) + r")\b"


def places(text: Column, pattern: str) -> Column:
    """array of (at, value) of the pattern's matches from left to right; at counts characters from 1. What is between the matches,
    and they themselves, say where each begins."""
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0), lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("value")))
    kind = "array<struct<at:int,value:string>>"

    def step(acc: Column, x: Column) -> Column:
        at = acc["next"] + x["gap"]
        here = F.array(F.struct(at.alias("at"), x["value"].alias("value")))
        return F.struct((at + F.length(x["value"])).alias("next"), F.concat(acc["out"], here).alias("out"))

    start = F.struct(F.lit(1).alias("next"), F.array().cast(kind).alias("out"))
    return F.aggregate(F.filter(parts, lambda x: x["value"].isNotNull()), start, step, lambda acc: acc["out"])


def section_spans(text: Column) -> Column:
    """array of (section, low, high): the strict sections that banks are looked for in, the whole text if none begins."""
    span = lambda name: let(section_span(text, name, "listing", strict=True), lambda x: F.when(x.isNotNull(), F.struct(F.lit(name).alias("section"), x["low"].alias("low"), x["high"].alias("high"))))
    whole = F.array(F.struct(F.lit("full_text").alias("section"), F.lit(1).alias("low"), (F.length(text) + 1).alias("high")))
    return let(F.array_compact(F.array(*map(span, SECTIONS))), lambda x: F.when(F.size(x) > 0, x).otherwise(whole))


def bank_roles_by_place(docs: DataFrame, doc_id: str = "doc_id", text: str = "t", window: int = 100) -> DataFrame:
    """(doc_id, section, bank, role, n, distance): how often a bank's name and a role stand in one section with no more than `window`
    characters between a name's begin or end and the role's far end, and how many characters are between them at least. Banks
    without a role near them have a row with a null role and distance, n counts their places.

    Null and empty texts give no rows. Rows with one doc_id are told apart by their text, equal rows are one. Names of the list only,
    as words of their own; the longest at a place."""
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("text <> ''")
    d = d.withColumn("row_at", F.xxhash64("doc_id", "text"))
    stretch = lambda c: F.floor(c / STRETCH)
    names = F.transform(places(F.col("text"), NAMES), lambda x: F.struct(x["at"].alias("low"), (x["at"] + F.length(x["value"])).alias("high"), clean_bank_name(x["value"]).alias("bank")))
    bank = d.select("doc_id", "row_at", section_spans(F.col("text")).alias("sections"), F.filter(names, lambda x: is_valid_bank_name(x["bank"])).alias("b")).filter(F.size("b") > 0).distinct()
    bank = bank.select("doc_id", "row_at", "sections", F.explode("b").alias("b")).select("doc_id", "row_at", "b.*", F.explode("sections").alias("s")).filter("low >= s.low and high <= s.high")
    role = d.select("row_at", places(F.col("text"), ROLES).alias("r")).filter(F.size("r") > 0).distinct().withColumn("r", F.explode("r"))
    role = role.select("row_at", F.trim(F.lower("r.value")).alias("role"), F.col("r.at").alias("role_low"), (F.col("r.at") + F.length("r.value")).alias("role_high")).withColumn("stretch", stretch(F.col("role_low")))
    head = stretch(F.greatest(F.col("low") - window, F.lit(1)))
    seen = bank.select("doc_id", "row_at", "bank", "low", "high", "s", head.alias("head"), F.explode(F.sequence(head, stretch(F.col("high") + window))).alias("at"))
    near = (F.col("role_low") >= F.greatest(F.col("low") - window, F.col("s.low"))) & (F.col("role_high") <= F.least(F.col("high") + window, F.col("s.high")))
    gap = F.greatest(F.col("role_low") - F.col("high"), F.col("low") - F.col("role_high"), F.lit(0))
    met = seen.join(role.withColumnRenamed("row_at", "text_at"), (F.col("row_at") == F.col("text_at")) & (F.col("at") == F.col("stretch")) & near, "left")
    # a place without a role is counted in its first stretch
    n = F.when(F.col("role").isNull(), F.count_if(F.col("at") == F.col("head"))).otherwise(F.count("*"))
    out = met.groupBy("doc_id", F.col("s.section").alias("section"), "bank", "role").agg(n.alias("n"), F.min(F.when(F.col("role").isNotNull(), gap)).alias("distance"))
    # a bank has no more rows here than there are roles
    return out.withColumn("roles", F.count("role").over(Window.partitionBy("doc_id", "section", "bank"))).filter("role is not null or roles = 0").drop("roles")
