"""Companies: filter, progress, lookup, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debenture.functions import patterns as P


def eligible(rows: DataFrame, name: str = "name", country: str = "country", countries: list[str] | None = None) -> DataFrame:
    """(name, country, status) of rows with a name whose country is, to the letter, in the list (by default the EU's)."""
    return rows.filter(F.col(name).isNotNull() & F.col(country).isin(countries or P.EU_COUNTRIES)).select(F.col(name).alias("name"), F.col(country).alias("country"), F.lit("Active").alias("status"))


def unprocessed(companies: DataFrame, processed: DataFrame) -> DataFrame:
    """companies whose name isn't among processed(name); Spark broadcasts the list while it is small."""
    return companies.join(processed.select("name").distinct(), "name", "left_anti")


def downloaded(documents: DataFrame, done: DataFrame) -> DataFrame:
    """documents whose doc_id is among done(doc_id)."""
    return documents.join(done.select("doc_id").distinct(), "doc_id", "left_semi")


def lookup(companies: DataFrame, names: DataFrame, order: str = "seq") -> DataFrame:
    """For each of names(wanted) the first company, by `order`, of that name without regard to case; nulls where none is."""
    w = Window.partitionBy("wanted").orderBy(order)
    both = names.join(companies, F.lower("wanted") == F.lower("name"), "left")
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def type_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("company", "doc_type").agg(F.count("*").alias("n"), F.max("date").alias("last_updated"))


def stats(documents: DataFrame) -> DataFrame:
    """(company, total_documents, last_updated, document_types: map of type to count): counts first, so that a company's map
    is gathered from a row per type."""
    one = F.struct("doc_type", "n")
    return type_counts(documents).groupBy("company").agg(F.sum("n").alias("total_documents"), F.max("last_updated").alias("last_updated"), F.map_from_entries(F.sort_array(F.collect_list(one))).alias("document_types"))


def first_per_company(documents: DataFrame, n: int = 5, order: str = "seq") -> DataFrame:
    """The first n documents of each company, with their rank; a task sends on n of a company at most."""
    return documents.withColumn("rank", F.row_number().over(Window.partitionBy("company").orderBy(order))).filter(F.col("rank") <= n)


def first_n(companies: DataFrame, n: int, order: str = "seq", first: dict | None = None) -> DataFrame:
    """The first n companies by `order`; the values of `first` stand in place of the first one's."""
    out = companies.orderBy(order).limit(n)
    if not first:
        return out
    # n rows are left, so this window is as small
    out = out.withColumn("low", F.min(order).over(Window.partitionBy()))
    same = F.col(order) == F.col("low")
    return out.select(*[F.when(same, F.lit(first[c])).otherwise(F.col(c)).alias(c) if c in first else F.col(c) for c in companies.columns])


def with_fallback(companies: DataFrame, register: DataFrame, default: str = "default") -> DataFrame:
    """Each company's register rows; where it has none, the rows of `default` in its own name."""
    known = register.select("company").distinct().withColumnRenamed("company", "__known")
    c = companies.join(known, F.col("name") == F.col("__known"), "left").withColumn("key", F.coalesce("__known", F.lit(default)))
    r = register.withColumnRenamed("company", "key")
    out = c.join(r, "key")
    return out.withColumn("issuer", F.when(F.col("key") == default, F.col("name")).otherwise(F.col("issuer"))).drop("__known")
