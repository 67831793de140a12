"""Names against a table of aliases of any size: equal ones by a join, like ones by an index of their words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debenture.functions.extract import name_words, token_set_ratio


def standardised(names: DataFrame, aliases: DataFrame, name: str = "name", alias: str = "alias", standard: str = "standard", threshold: int = 85) -> DataFrame:
    """(name, standard, score), a row per name that is an alias (100) or, by the likeness of their words, like one that shares a word
    with it; of several the most alike, then the last standard. Names below the threshold, null or without a word have none.

    Names and aliases meet in an index of words. What they have in common is summed up before anything is compared: a pair whose
    common words and lengths can't reach the threshold isn't. A word that many names and many aliases have brings all of those
    together, as sums; it costs no comparison. Repeated names and aliases are one."""
    n = names.select(F.col(f"`{name}`").alias("name")).filter("name is not null").distinct()
    a = aliases.select(F.col(f"`{alias}`").alias("alias"), F.col(f"`{standard}`").alias("standard")).filter("alias is not null").groupBy("alias").agg(F.max("standard").alias("standard"))
    equal = n.join(a, F.col("name") == F.col("alias")).select("name", "standard", F.lit(100.0).alias("score"))
    rest = n.join(equal.select("name"), "name", "left_anti")

    def index(d: DataFrame, c: str) -> DataFrame:
        w = d.select(c, name_words(F.col(c)).alias("words"))
        return w.select(c, F.size("words").alias(f"{c}_words"), F.length(F.array_join("words", " ")).alias(f"{c}_length"), F.explode("words").alias("word"))

    met = index(rest, "name").join(index(a.select("alias"), "alias"), "word").groupBy("name", "alias", "name_words", "name_length", "alias_words", "alias_length").agg(F.count("*").alias("k"), (F.sum(F.length("word")) + F.count("*") - 1).alias("common"))
    share = lambda x, both: F.bround(200 * x / both, 0) >= threshold
    inside = F.col("k") == F.least("name_words", "alias_words")
    mostly = share(F.col("common"), F.col("common") + F.least("name_length", "alias_length"))
    alike = share(F.least("name_length", "alias_length"), F.col("name_length") + F.col("alias_length"))
    near = met.filter(inside | mostly | alike).select("name", "alias").withColumn("score", token_set_ratio(F.col("name"), F.col("alias"))).filter(F.col("score") >= threshold)
    best = near.join(a, "alias").groupBy("name").agg(F.max(F.struct("score", "standard")).alias("best"))
    return equal.unionByName(best.select("name", "best.standard", "best.score"))
