"""Pages of results in the order in which a reader would turn them: list ranking over next-links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debenture.working import saved, working


def _doubled(jump: DataFrame) -> DataFrame:
    """Links over twice as many pages."""
    return saved(jump.select("page", F.col("next").alias("half")).join(jump.select(F.col("page").alias("half"), "next"), "half").select("page", "next"), "pages-jumps")


def _ranked(heads: DataFrame, links: DataFrame) -> DataFrame:
    """(chain, page, position) of all pages reached from heads(page), each at the first place where it is met."""
    known, step, jump = saved(heads.select(F.col("page").alias("chain"), "page", F.lit(0).cast("long").alias("position")), "pages-known"), 1, links
    many = known.count()
    while many:
        further = known.join(jump, "page").select("chain", F.col("next").alias("page"), (F.col("position") + step).alias("position"))
        known = saved(known.unionByName(further).groupBy("chain", "page").agg(F.min("position").alias("position")), "pages-known")
        before, many = many, known.count()
        # positions up to the step are known, so a round that meets no new page ends every chain
        if many == before:
            break
        jump, step = _doubled(jump), 2 * step
    return known


def page_chains(pages: DataFrame, page: str = "page", following: str = "next", most: int | None = None) -> DataFrame:
    """(chain, page, position) of pages(page, next): a chain begins at a page that no other one leads to and goes on by the links to
    the next page until there is none, a page comes that the chain has already (its first place counts), a page comes that
    isn't in the table, or it has `most` pages. Pages that lead round without such a begin are a chain that begins at the least of
    them. A page that several chains come to is in each.

    Rows without page are left out; of several links of a page the least counts; repeated rows are one. The rounds are the logarithm
    of the longest chain."""
    spark = pages.sparkSession
    with working(spark) as keep:
        d = saved(pages.select(F.col(f"`{page}`").alias("page"), F.col(f"`{following}`").alias("next")).filter("page is not null").groupBy("page").agg(F.min("next").alias("next")), "pages-all")
        links = saved(d.filter("next is not null").join(d.select(F.col("page").alias("next")), "next", "left_semi").select("page", "next"), "pages-links")
        led_to = links.filter("page <> next").select(F.col("next").alias("page")).distinct()
        out = _ranked(d.select("page").join(led_to, "page", "left_anti"), links)
        # what no chain has met goes round; each of it learns the least page of its round
        least = saved(links.join(out.select("page").distinct(), "page", "left_anti").select("page", F.least("page", "next").alias("least")), "pages-round")
        if not least.isEmpty():
            jump = links
            while True:
                there = least.select(F.col("page").alias("next"), F.col("least").alias("other"))
                told = least.join(jump, "page").join(there, "next").select("page", F.least("least", "other").alias("least"))
                told = saved(told, "pages-round")
                if told.join(least.withColumnRenamed("least", "was"), "page").filter("least < was").isEmpty():
                    break
                least, jump = told, _doubled(jump)
            out = out.unionByName(_ranked(least.filter("page = least").select("page"), links))
        out = keep(saved(out if most is None else out.filter(F.col("position") < most), "pages-chains"))
    return out
