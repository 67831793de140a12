"""Extraction records: all rules over a table of texts, and what is made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debenture.functions import anchors
from debenture.functions import extract as E
from debenture.functions import text as T
from debenture.operators.register import filename_of_path

#: Other rules over the cleaned text, by name: text column -> column; they come as extra columns of `extracted`.
EXTRACTORS: dict = {}

CONSOLIDATED = ["company_name", "issuer_name", "issue_date", "maturity_date", "issue_size", "currency", "coupon_rate", "bank_standard_name", "bank_role", "bank_raw_name", "bank_confidence", "pdf_path", "validation_flags"]


def register_extractor(name: str, rule) -> None:
    EXTRACTORS[name] = rule


def extracted(docs: DataFrame, text: str = "text", path: str = "file_path", strict: bool = False, clean=T.clean_text) -> DataFrame:
    """`clean` (text, strict) may be replaced by a cleaner of one's own. docs without their text, with filename, metadata, sections, extracted_banks, bank_info and validation_flags. A text
    that is empty once cleaned has only the flag text_extraction_failed; one whose dates can't be read has only
    `processing_error: no such group`."""
    d = docs.withColumn("t", clean(F.col(text), strict)).withColumn("filename", filename_of_path(F.col(path)))
    # one pass over the text says which rules can match at all
    t, hits = F.col("t"), F.col("hits")
    d = d.withColumn("hits", anchors.found(t))
    d = d.withColumns({"d": E.dates(t, strict, hits), "m": E.currency(t, strict, hits), "c": E.coupon(t, strict, hits), "sections": T.document_sections(t, strict), "bank_info": E.banks(t, strict, hits)})
    flags = E.validation_flags(F.size("bank_info"), F.col("d.issue_date"), F.col("d.maturity_date"), F.col("m.currency"), F.col("m.issue_size"), F.col("c.coupon_rate"), F.col("c.coupon_type"), F.size("sections"), F.col("filename"))
    empty, failed = F.col("t") == "", F.col("d.failed")
    good = ~empty & ~failed
    metadata = F.struct("d.issue_date", "d.maturity_date", "m.issue_size", "m.currency", "c.coupon_rate", "c.coupon_type")
    more = [F.when(good, rule(F.col("t"))).alias(name) for name, rule in EXTRACTORS.items()]
    return d.select(
        *[f"`{c}`" for c in docs.columns if c != text],
        "filename",
        F.when(good, metadata).alias("metadata"),
        F.when(good, F.col("sections")).alias("sections"),
        F.when(good, F.transform("bank_info", lambda b: b["bank"])).alias("extracted_banks"),
        F.when(good, F.col("bank_info")).alias("bank_info"),
        F.when(empty, F.array(F.lit("text_extraction_failed"))).when(failed, F.array(F.lit("processing_error: no such group"))).otherwise(flags).alias("validation_flags"),
        *more,
    )


def bank_rows(records: DataFrame) -> DataFrame:
    """A row per document and bank, column bank for extracted_banks; documents without banks have none. With an inner explode Spark
    puts its own filter on the array's size below the rules, where all of them are written out and run once more for each use."""
    others = [f"`{c}`" for c in records.columns if c != "extracted_banks"]
    return records.select(*others, F.explode_outer("extracted_banks").alias("bank")).filter(F.col("bank").isNotNull())


def consolidated(records: DataFrame) -> DataFrame:
    """A row per document, bank and role, columns in the order of the sheet; documents without banks keep one row."""
    r = records.withColumn("b", F.explode_outer("bank_info")).withColumn("role", F.explode_outer("b.roles"))
    return r.select(
        F.col("company").alias("company_name"), F.col("company").alias("issuer_name"), "metadata.issue_date", "metadata.maturity_date", "metadata.issue_size", "metadata.currency", "metadata.coupon_rate",
        F.col("b.bank").alias("bank_standard_name"), F.col("role").alias("bank_role"), F.col("b.raw").alias("bank_raw_name"),
        F.col("b.confidence").alias("bank_confidence"), F.col("file_path").alias("pdf_path"), F.array_join("validation_flags", "; ").alias("validation_flags"),
    )


def typed(records: DataFrame) -> DataFrame:
    """Dates as DATE, size and rate as DECIMAL(38,6)."""
    return records.select("doc_id", F.col("metadata.issue_date").try_cast("date").alias("issue_date"), F.col("metadata.maturity_date").try_cast("date").alias("maturity_date"), F.col("metadata.issue_size").try_cast("double").cast("decimal(38,6)").alias("issue_size"), "metadata.currency", F.col("metadata.coupon_rate").try_cast("decimal(38,6)").alias("coupon_rate"), "metadata.coupon_type")
