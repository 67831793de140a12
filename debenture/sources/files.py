"""Files in and out: lists of names, state, PDF folders, workbooks, records."""

from __future__ import annotations

import json
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

STATS_SCHEMA = "company string, total_documents bigint, last_updated date, document_types map<string,bigint>"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_names(spark: SparkSession, path: str, keep_blank: bool = False, column: str = "name") -> DataFrame:
    """Trimmed, distinct lines; a missing file has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{column} string")
    names = spark.read.text(path).select(F.trim("value").alias(column)).distinct()
    return names if keep_blank else names.filter(F.col(column) != "")


def write_names(names: DataFrame, path: str, column: str = "name") -> None:
    """Distinct names in order, one file."""
    names.select(F.col(column).alias("value")).distinct().orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Company statistics as JSON lines; a missing file or a broken line has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], STATS_SCHEMA)
    return spark.read.schema(STATS_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """Company statistics as JSON lines, in place of what was there."""
    stats.select("company", "total_documents", "last_updated", "document_types").write.mode("overwrite").json(path)


HASH_SCHEMA = "sha256 string, path string"


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    """The index of contents; a missing file or a broken line has none."""
    if not exists(spark, path):
        return spark.createDataFrame([], HASH_SCHEMA)
    return spark.read.schema(HASH_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def write_hashes(files: DataFrame, path: str) -> None:
    """The index of files(sha256, kept_path): each content once, in place of what was there."""
    files.groupBy("sha256").agg(F.min("kept_path").alias("path")).write.mode("overwrite").json(path)


def bootstrap(spark: SparkSession, folder: str) -> None:
    """Empty state where there is none."""
    for name, schema in (("processed", "name string"), ("downloaded", "doc_id string"), ("stats", STATS_SCHEMA)):
        if not exists(spark, f"{folder}/{name}"):
            spark.createDataFrame([], schema).write.json(f"{folder}/{name}")


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """path, modificationTime, length, content of all .pdf files below."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(path)


def pdf_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Named files and those found below folders, .pdf in any case, once each, in order."""
    out = None
    for p in paths:
        one = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).select("path")
        out = one if out is None else out.unionByName(one)
    return out.filter(F.endswith(F.lower("path"), F.lit(".pdf"))).distinct().orderBy("path")


def write_consolidated(rows: DataFrame, path: str) -> None:
    """The records as JSON, and as a sheet (CSV with header) with columns in their order."""
    rows.write.mode("overwrite").json(f"{path}/json")
    rows.write.mode("overwrite").option("header", "true").csv(f"{path}/sheet")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def sheet_rows(path, sheet: str, skip: int):
    """Rows (lists of text or None) of a workbook's sheet, by the standard library; path: a local one or an open file."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        ids = {s.get("name"): s.get(f"{{{_NS['r']}}}id") for s in book.iter(f"{{{_NS['m']}}}sheet")}
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = links[ids[sheet]]
        for row in ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}")).iter(f"{{{_NS['m']}}}row"):
            if int(row.get("r", 0)) <= skip:
                continue
            out: list = []
            for c in row:
                at = 0
                for ch in re.match("[A-Z]+", c.get("r", "A"))[0]:
                    at = at * 26 + ord(ch) - 64
                v = c.find("m:v", _NS)
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
                out += [None] * (at - 1 - len(out)) + [shared[int(text)] if c.get("t") == "s" and text is not None else text]
            yield out


def read_sheet(spark: SparkSession, path: str, sheet: str = "Upstream", skip: int = 4) -> DataFrame:
    """(seq, name, country) of the sheet of a workbook that lies anywhere Spark can read."""

    def run(frames):
        import io

        import pandas as pd

        for frame in frames:
            rows = [(i, r[0], r[2] or "") for content in frame["content"] for i, r in enumerate(row + [None] * 3 for row in sheet_rows(io.BytesIO(content), sheet, skip))]
            yield pd.DataFrame(rows, columns=["seq", "name", "country"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "seq bigint, name string, country string")


class CompanySheet(DataSource):
    """format("company_sheet"): name (first column) and country (third) of the sheet of a workbook on a local path that all machines see
    (read_sheet takes any other); options path, sheet, skip (rows
    before the data: three headings and a header)."""

    @classmethod
    def name(cls):
        return "company_sheet"

    def schema(self):
        return "seq bigint, name string, country string"

    def reader(self, schema):
        options = dict(self.options)

        class Reader(DataSourceReader):
            def partitions(self):
                return [InputPartition(options["path"])]

            def read(self, partition):
                for i, row in enumerate(sheet_rows(partition.value, options.get("sheet", "Upstream"), int(options.get("skip", 4)))):
                    row = row + [None] * 3
                    yield i, row[0], row[2] or ""

        return Reader()


class RegisterSearch(DataSource):
    """format("register_search"): what a search of the register shows, from a fixture instead of a browser: option `fixture` is JSON
    text of {company: [{issuer_name, doc_type, date, url}, ...]}, `companies` JSON text of the names asked for (default: all), `page_size`
    rows of a page, `max_pages` pages of a company. A partition is a company's page; pages end with the rows. A company that the
    fixture doesn't have finds nothing."""

    @classmethod
    def name(cls):
        return "register_search"

    def schema(self):
        return "company string, page int, row int, issuer_name string, doc_type string, date string, url string"

    def reader(self, schema):
        options = dict(self.options)
        fixture = json.loads(options["fixture"])
        size, most = int(options.get("page_size", 100)), int(options.get("max_pages", 1 << 30))

        class Reader(DataSourceReader):
            def partitions(self):
                names = json.loads(options["companies"]) if "companies" in options else list(fixture)
                pages = [(c, p) for c in names for p in range(min(most, -(-len(fixture.get(c, [])) // size)))]
                return [InputPartition(x) for x in pages] or [InputPartition(None)]

            def read(self, partition):
                if partition.value is not None:
                    company, page = partition.value
                    for i, r in enumerate(fixture[company][page * size : (page + 1) * size]):
                        yield company, page, i, r.get("issuer_name"), r.get("doc_type"), r.get("date"), r.get("url")

        return Reader()
