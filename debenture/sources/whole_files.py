"""Files that are swapped whole: a reader sees the file before or the file after, never half of one.

Tasks write beside the files, each attempt under a name of its own; as the job commits, what the tasks that count have written takes the
place of what was there. A failed job leaves all as it was. Any file system that pyarrow opens will do, as long as driver and
executors share it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]] = field(default_factory=list)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, kind: str):
        self.path, self.kind, self.beside = path.rstrip("/"), kind, f"{path.rstrip('/')}/_beside-{uuid.uuid4().hex}"
        system, at = _opened(self.beside)
        system.create_dir(at, recursive=True)

    def write(self, iterator):
        system, at = _opened(self.beside)
        out, name, files = None, None, []
        try:
            for row in iterator:
                if row["file"] != name:
                    if out is not None:
                        out.write(b"\n]}\n" if self.kind == "company" else b"")
                        out.close()
                    name = row["file"]
                    files.append((f"{uuid.uuid4().hex}.part", name))
                    out = system.open_output_stream(f"{at}/{files[-1][0]}")
                    if self.kind == "company":
                        out.write(f'{{"company": {row["head"]}, "documents": [\n'.encode())
                elif self.kind == "company":
                    out.write(b",\n")
                out.write((row["body"] + ("" if self.kind == "company" else "\n")).encode())
            if out is not None:
                out.write(b"\n]}\n" if self.kind == "company" else b"")
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages):
        system, beside = _opened(self.beside)
        _, folder = _opened(self.path)
        names = [name for m in messages if m is not None for _, name in m.files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("rows of one file in two tasks: deal rows out by file and sort them by it within the tasks")
        for m in messages:
            for part, name in m.files if m is not None else []:
                system.move(f"{beside}/{part}", f"{folder}/{name}")
        system.delete_dir(beside)

    def abort(self, messages):
        system, beside = _opened(self.beside)
        system.delete_dir(beside)


class WholeFiles(DataSource):
    """format("whole_files"): rows (file, head, body) with all rows of a file together in one task, below the option path. kind
    `lines`: a line per row; `company`: {"company": head, "documents": [body, ...]}."""

    @classmethod
    def name(cls):
        return "whole_files"

    def schema(self):
        return "file string, head string, body string"

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], self.options.get("kind", "lines"))


def write_whole(rows: DataFrame, path: str, kind: str = "lines", order: list | None = None) -> None:
    """rows(file, head, body) as files below path. A file's rows pass through one task as a stream, in order; names that differ
    only by a / are one file, with _ for it. Files that no row names stay as they are."""
    rows.sparkSession.dataSource.register(WholeFiles)
    order = order or []
    d = rows.withColumn("file", F.replace("file", F.lit("/"), F.lit("_"))).repartition("file").sortWithinPartitions("file", *order)
    d.select("file", "head", "body").write.format("whole_files").option("path", path).option("kind", kind).mode("append").save()


def write_list(values: DataFrame, path: str, name: str, column: str = "name") -> None:
    """Distinct values in order, a line each, as the one file path/name. Nulls are left out."""
    d = values.select(F.col(column).cast("string").alias("body")).filter("body is not null").distinct()
    write_whole(d.select(F.lit(name).alias("file"), F.lit(None).cast("string").alias("head"), "body"), path, "lines", ["body"])


def write_companies(records: DataFrame, path: str, company: Column | None = None, name: str = "company", order: list | None = None) -> None:
    """path/NAME.json per company that has records: {"company": ..., "documents": [...]}. company: a struct that is the same in all
    of a company's records (by default just its name); the documents are the other columns. Records of a null name are left out."""
    head = F.to_json(company if company is not None else F.struct(F.col(f"`{name}`").alias("name")))
    rest = [F.col(f"`{c}`") for c in records.columns if c != name]
    d = records.filter(F.col(f"`{name}`").isNotNull()).select(F.concat(F.col(f"`{name}`"), F.lit(".json")).alias("file"), head.alias("head"), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("body"), *[F.col(f"`{c}`").alias(f"by_{i}") for i, c in enumerate(order or [])])
    write_whole(d, path, "company", [*[f"by_{i}" for i, _ in enumerate(order or [])], "body"])
