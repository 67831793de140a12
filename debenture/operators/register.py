"""Register rows: file names, organised paths, identity, duplicates, caches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debenture.functions import patterns as P
from debenture.functions.text import contains_any, empty_to_null


def filename_of_path(path: Column) -> Column:
    """The last part of a path, without a last slash; null if there is none."""
    return empty_to_null(F.regexp_extract(path, r"([^/]+)/*$", 1))


def filename_of_url(url: Column, link_text: Column | None = None) -> Column:
    """The last part of the url's path; the link's text where it has no path."""
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    name = F.coalesce(filename_of_path(path), F.lit(""))
    return name if link_text is None else F.when(path == "", F.trim(link_text)).otherwise(name)


def filename_of_header(header: Column) -> Column:
    return empty_to_null(F.regexp_extract(header, 'filename="?([^"]+)"?', 1))


def download_name(header: Column, url: Column, doc_id: Column) -> Column:
    """From the header, else the url, else made of the id or the url's hash; with .pdf unless it is a pdf, docx or zip."""
    made = F.concat(F.lit(P.DEFAULT_FILE), F.coalesce(empty_to_null(doc_id), F.md5(url)), F.lit(".pdf"))
    name = F.coalesce(filename_of_header(header), empty_to_null(filename_of_url(url)), made)
    return F.when(F.regexp_like(name, F.lit(r"(?i)\.(pdf|docx|zip)$")), name).otherwise(F.concat(name, F.lit(".pdf")))


def organised_path(company: Column, doc_type: Column, date: Column, sha256: Column, today: Column | None = None) -> Column:
    """company/type_date_hash.pdf: the company without what folders can't hold, 100 characters; the type's words joined by _,
    30; the date's digits as they stand, 8, or today's; the hash's first 8."""
    today = F.date_format(F.current_date(), "yyyyMMdd") if today is None else today
    folder = F.substring(F.regexp_replace(F.coalesce(empty_to_null(company), F.lit("UnknownCompany")), r'[\\/:*?"<>|]', "_"), 1, 100)
    kind = F.regexp_replace(F.coalesce(empty_to_null(doc_type), F.lit("UnknownType")), r"\W+", "_")
    kind = F.substring(F.regexp_replace(kind, "^_+|_+$", ""), 1, 30)
    digits = F.coalesce(empty_to_null(F.substring(F.regexp_replace(F.coalesce(date, F.lit("")), "[^0-9]", ""), 1, 8)), today)
    return F.concat(folder, F.lit("/"), kind, F.lit("_"), digits, F.lit("_"), F.substring(sha256, 1, 8), F.lit(".pdf"))


def output_name(company: Column) -> Column:
    return F.concat(F.replace(company, F.lit("/"), F.lit("_")), F.lit(".json"))


def joined_md5(*parts: Column) -> Column:
    """md5 of the parts joined by _; a null part reads None."""
    return F.md5(F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]))


def is_final_terms(filename: Column) -> Column:
    return contains_any(F.lower(filename), P.FINAL_TERMS)


def is_recognised(filename: Column) -> Column:
    return contains_any(F.lower(filename), P.RECOGNISED)


def first_by_content(files: DataFrame, content: Column, order: list[str]) -> DataFrame:
    """files with sha256, kept_path (path of the first file of that content) and is_duplicate. The first is found by a
    minimum with partial sums, not by ordering a group, and joined back."""
    d = files.withColumn("sha256", F.sha2(content.cast("binary"), 256))
    head = d.groupBy("sha256").agg(F.min(F.struct(*order, "path")).alias("head"))
    out = d.join(head, "sha256")
    return out.withColumns({"kept_path": F.col("head.path"), "is_duplicate": F.struct(*order, "path") != F.col("head")}).drop("head")


def first_by_url(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row, the first, of each company and url; rows without url go."""
    w = Window.partitionBy("company", "url").orderBy(*order)
    return rows.filter("url is not null and url <> ''").withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def path_collisions(files: DataFrame) -> DataFrame:
    """(path, n, n_contents, verdict): the same content under a path is one file, other content fails."""
    g = files.groupBy("path").agg(F.count("*").alias("n"), F.countDistinct("sha256").alias("n_contents"))
    return g.withColumn("verdict", F.when(F.col("n_contents") > 1, "fail").when(F.col("n") > 1, "reuse").otherwise("new"))


def cached(documents: DataFrame, index: DataFrame, files: DataFrame) -> DataFrame:
    """documents with cache_path, where the index has the id and the file is there, and cache_hit."""
    out = documents.join(index.select("doc_id", "cache_path"), "doc_id", "left")
    there = files.select(F.col("path").alias("__path")).distinct()
    out = out.join(there, F.col("cache_path") == F.col("__path"), "left")
    hit = F.col("__path").isNotNull()
    return out.withColumns({"cache_path": F.when(hit, F.col("cache_path")), "cache_hit": hit}).drop("__path")


def new_cache_entries(documents: DataFrame, index: DataFrame) -> DataFrame:
    return documents.join(index.select("doc_id"), "doc_id", "left_anti")


def has_required(columns: list[str]) -> Column:
    """Whether none of the columns is null or empty."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c).cast("string"), F.lit("")) != "" for c in columns])


def with_required(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.filter(has_required(columns))


def dry_run(files: DataFrame, identity: list[str], bad: Column) -> DataFrame:
    """(total_files, organized_files, skipped_files, error_files): bad files fail; of the others with one identity one is moved."""
    head = files.groupBy(*identity).agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return head.agg(total(F.col("good") + F.col("bad")).alias("total_files"), F.count_if(F.col("good") > 0).alias("organized_files"), total(F.greatest(F.col("good") - 1, F.lit(0))).alias("skipped_files"), total("bad").alias("error_files"))


def against_index(files: DataFrame, content: Column, order: list[str], index: DataFrame, there: DataFrame) -> DataFrame:
    """files with sha256, kept_path and is_duplicate, looked up in an index(sha256, path): the indexed path stands while its file is
    there(path); an entry whose file is gone is forgotten, and the first of the files takes its place."""
    out = first_by_content(files, content, order)
    known = index.join(there.select("path").distinct(), "path", "left_semi").select("sha256", F.col("path").alias("indexed"))
    out = out.join(known, "sha256", "left").withColumn("kept_path", F.coalesce("indexed", "kept_path"))
    return out.withColumn("is_duplicate", F.col("path") != F.col("kept_path")).drop("indexed")
