"""Where names stand in texts, by a positional index: its rows depend on the texts alone, and any number of names is asked of it at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters and digits; what is between words doesn't matter.
WORD = r"[\p{L}\p{N}]+"


def words(text):
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def positions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_at, place, word): the index, a row per word; place counts from 0. Null and empty texts have none. row_at tells rows
    of one doc_id apart by their text; equal rows are one. Written as a table it serves many lists of names."""
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("row_at", F.xxhash64("doc_id", "text"))
    return d.dropDuplicates(["doc_id", "row_at"]).select("doc_id", "row_at", F.posexplode(words(F.col("text"))).alias("place", "word"))


def concordance(index: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """(doc_id, row_at, name, n, first): how often the words of a name follow each other in a row of the index, and the first place.
    Places may overlap; case counts. Names without a word, or null, have no rows; repeated names are one.

    Each word of a name asks for its own postings; where all of them tell the same beginning the name stands. A row of the index
    comes out once for each name that has its word and at each place in it."""
    n = names.select(F.col(f"`{name}`").alias("name")).filter("name is not null").distinct().withColumn("w", words(F.col("name")))
    asked = n.select("name", F.size("w").alias("size"), F.posexplode("w").alias("i", "word"))
    # only words that names have are moved
    met = index.join(asked, "word").withColumn("begin", F.col("place") - F.col("i"))
    whole = met.groupBy("doc_id", "row_at", "name", "size", "begin").agg(F.count("*").alias("k")).filter("k = size")
    return whole.groupBy("doc_id", "row_at", "name").agg(F.count("*").alias("n"), F.min("begin").alias("first"))
