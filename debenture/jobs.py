"""Whole runs, for spark-submit: `extract` reads a folder of PDF files, `run` goes from a workbook of companies to their records.

    spark-submit -m debenture.jobs extract --pdf-dir DIR --out DIR [--use-ocr]
    spark-submit -m debenture.jobs run --companies-file XLSX --pdf-dir DIR --output-dir DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debenture.operators import companies as C
from debenture.operators import records as R
from debenture.operators import register as G
from debenture.sources import files, pdf, whole_files
from debenture.streaming import ledger


def records_of(spark: SparkSession, pdf_dir: str, readers: list | None = None) -> DataFrame:
    """The record of each PDF file of final terms below the folder; its company is the folder that it lies in. With at least as
    many partitions as files allow, as a record costs milliseconds a page."""
    read = files.pdf_files(spark, pdf_dir).filter(G.is_final_terms(G.filename_of_path(F.col("path"))))
    texts = pdf.document_text(read, readers).withColumnsRenamed({"path": "file_path"})
    docs = texts.withColumn("company", F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1)).withColumn("doc_id", F.xxhash64("file_path"))
    return R.extracted(docs.select("doc_id", "company", "file_path", "text"))


def process(spark: SparkSession, companies: DataFrame, processed_path: str, records: DataFrame, out: str, run: int | None = None) -> DataFrame:
    """Companies that are eligible and not yet processed: their records as a JSON file each, one consolidated JSON and sheet, the
    statistics by company in a ledger, and the list of processed names with theirs added, last. A run that was killed and comes again
    with its number `run` counts once; without a number it is a new one. Returns (companies_attempted, companies_succeeded, documents, errors)."""
    # what is asked for is written first, as the list that it comes from changes below
    C.unprocessed(C.eligible(companies), files.read_names(spark, processed_path)).select("name").distinct().write.mode("overwrite").parquet(f"{out}/wanted")
    wanted = spark.read.parquet(f"{out}/wanted")
    own = records.join(wanted, F.col("company") == F.col("name"), "left_semi").persist()
    whole_files.write_companies(own, f"{out}/companies", order=["file_path"])
    files.write_consolidated(R.consolidated(own), f"{out}/consolidated")
    log = ledger.statistics(spark, f"{out}/statistics")
    documents = own.select("company", F.lit("Final Terms").alias("doc_type"), F.current_date().alias("date"))
    ledger.add_documents(log, log.next() if run is None else run, documents)
    # the list is read while it is written, so its new names go beside it first
    files.read_names(spark, processed_path).unionByName(wanted).distinct().write.mode("overwrite").parquet(f"{out}/processed_next")
    files.write_names(spark.read.parquet(f"{out}/processed_next"), processed_path)
    bad = F.exists("validation_flags", lambda f: (f == "text_extraction_failed") | F.startswith(f, F.lit("processing_error")))
    done = own.agg(F.countDistinct(F.when(~bad, F.col("company"))).alias("companies_succeeded"), F.count("*").alias("documents"), F.count_if(bad).alias("errors"))
    return wanted.agg(F.count("*").alias("companies_attempted")).join(done)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="debenture")
    jobs = p.add_subparsers(dest="job", required=True)
    e = jobs.add_parser("extract", help="records of a folder of PDF files")
    e.add_argument("--pdf-dir", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--use-ocr", action="store_true")
    r = jobs.add_parser("run", help="from a workbook of companies to their records")
    r.add_argument("--companies-file", required=True)
    r.add_argument("--pdf-dir", required=True)
    r.add_argument("--output-dir", required=True)
    r.add_argument("--sheet", default="Upstream")
    r.add_argument("--use-ocr", action="store_true")
    r.add_argument("--run", type=int, help="number of the run; a killed one is repeated under its own")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("debenture").getOrCreate()
    readers = [pdf.text_layer, pdf.layout] + ([pdf.optical] if args.use_ocr else [])
    if args.job == "extract":
        records_of(spark, args.pdf_dir, readers).write.mode("overwrite").json(args.out)
        return
    sheet = files.read_sheet(spark, args.companies_file, args.sheet)
    process(spark, sheet, f"{args.output_dir}/processed", records_of(spark, args.pdf_dir, readers), args.output_dir, args.run).show()


if __name__ == "__main__":
    main()
