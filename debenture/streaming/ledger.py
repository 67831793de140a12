"""State over runs that counts each batch once: statistics by company, contents seen before.

A batch is a folder of its own, which counts once Spark has set the mark that its write is complete. A batch that was killed is written
anew, one that is complete is left as it is. From time to time all batches are merged into a snapshot; it takes the place of its
batches as its own mark is set, so a reader sees either the one or the others. Nothing is held in a stream's memory, and what
isn't needed any more goes only after the next snapshot, as readers may still be at it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debenture.streaming.jobs import running_counts
from debenture.working import saved, working

#: The filter over contents: bits of a block (a bitmap of Spark's own size), contents to a block and bits that each sets. Of contents that
#: aren't there, about one in a hundred is asked for in vain; the filter takes some 11 bits a content.
BITS, BLOCK, PROBES = 32768, 3000, 4
#: Contents to a file of the index, at most about; it lies in 16 folders by the hash's first digit, in 256 by two where these would be more than a file each.
FILE = 4_000_000


class Ledger:
    """Rows of batches below path, merged by `merge`, whose result must have the same columns and not depend on how often parts of
    it were merged before. Batches have numbers that ascend, as foreachBatch gives them; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], every: int = 50):
        self.spark, self.path, self.schema, self.merge, self.every = spark, path.rstrip("/"), schema, merge, every

    def _at(self, kind: str, n: int | str) -> str:
        return f"{self.path}/{kind}-{n}"

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the folders of a kind whose write is complete, in order."""
        glob = self.spark._jvm.org.apache.hadoop.fs.Path(self._at(kind, "*/_SUCCESS"))
        found = glob.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(glob)
        return sorted(int(f.getPath().getParent().getName().rpartition("-")[2]) for f in found or [])

    def _through(self) -> int:
        return max(self._complete("snapshot"), default=-1)

    def batches(self) -> list[int]:
        """Complete batches that aren't in the snapshot."""
        through = self._through()
        return [n for n in self._complete("batch") if n > through]

    def has(self, n: int) -> bool:
        return n <= self._through() or n in self._complete("batch")

    def add(self, n: int, rows: DataFrame) -> bool:
        """Whether the batch is new; one that is here already changes nothing."""
        if self.has(n):
            return False
        self.merge(rows).write.mode("overwrite").parquet(self._at("batch", n))
        if len(self.batches()) >= self.every:
            self.compact()
        return True

    def next(self) -> int:
        """The number behind all that have come."""
        return max(self._complete("batch") + [self._through()]) + 1

    def rows(self) -> DataFrame:
        """All batches merged, as of now."""
        through = self._through()
        parts = ([self._snapshot(through)] if through >= 0 else []) + self._read([n for n in self._complete("batch") if n > through])
        return self.merge(reduce(DataFrame.unionByName, parts)) if parts else self.spark.createDataFrame([], self.schema)

    def _read(self, batches: list[int]) -> list[DataFrame]:
        return [self.spark.read.schema(self.schema).parquet(*[self._at("batch", n) for n in batches])] if batches else []

    def _snapshot(self, n: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._at("snapshot", n))

    def _write_snapshot(self, n: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self._at("snapshot", n))

    def compact(self) -> None:
        """Merges all batches into a snapshot; then the snapshot before the last one and the batches in it go."""
        done = self.batches()
        if not done:
            return
        before = self._complete("snapshot")
        self._write_snapshot(done[-1], self.rows())
        if before:
            self._remove([self._at(kind, n) for kind in ("snapshot", "filter") for n in before[:-1]] + [self._at("batch", n) for n in self._complete("batch") if n <= before[-1]])

    def drop(self) -> None:
        """All of it goes."""
        self._remove([self.path])

    def _remove(self, paths: list[str]) -> None:
        for p in paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def statistics(spark: SparkSession, path: str, every: int = 50) -> Ledger:
    """Documents and last date by company and type; add takes what `running_counts` gives."""

    def merge(d: DataFrame) -> DataFrame:
        return d.groupBy("company", "doc_type").agg(F.sum("n").alias("n"), F.max("last_updated").alias("last_updated"))

    return Ledger(spark, path, "company string, doc_type string, n bigint, last_updated date", merge, every)


def add_documents(log: Ledger, n: int, documents: DataFrame) -> bool:
    """Counts batch n of documents(company, doc_type, date) in a ledger of `statistics`. Null companies and types count as values."""
    return log.add(n, running_counts(documents))


def by_company(log: Ledger) -> DataFrame:
    """(company, total_documents, last_updated, document_types), as `write_stats` takes it; documents without type aren't in the map."""
    types = F.map_from_entries(F.collect_list(F.when(F.col("doc_type").isNotNull(), F.struct("doc_type", "n"))))
    return log.rows().groupBy("company").agg(F.sum("n").alias("total_documents"), F.max("last_updated").alias("last_updated"), types.alias("document_types"))


class Contents(Ledger):
    """Each content with the first batch that had it, and the least of its paths there: the index, with a Bloom filter beside each
    snapshot. What is asked of the index goes through the filter first, so contents that are new seldom read it; those
    that pass read only the folders that their hashes begin with. A filter whose write was killed is done without."""

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        def merge(d: DataFrame) -> DataFrame:
            return d.groupBy("sha256").agg(F.min(F.struct("batch", "path")).alias("first")).select("sha256", "first.batch", "first.path")

        super().__init__(spark, path, "sha256 string, batch bigint, path string", merge, every)

    def _index(self, n: int) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, folder string").parquet(self._at("snapshot", n))

    def _snapshot(self, n: int) -> DataFrame:
        return self._index(n).drop("folder")

    def _write_snapshot(self, n: int, rows: DataFrame) -> None:
        with working(self.spark):
            rows = saved(rows, "contents")
            many = rows.count()
            digits = 1 if many <= 16 * FILE else 2
            files = F.pmod(F.xxhash64("sha256"), F.lit(1 + many // (16**digits * FILE)))
            laid = rows.withColumn("folder", F.substring("sha256", 1, digits)).repartition(F.col("folder"), files)
            laid.write.mode("overwrite").partitionBy("folder").parquet(self._at("snapshot", n))
            blocks = 1 + many // BLOCK
            bits = rows.select(_block(blocks).alias("block"), F.explode(F.array(*_probes())).alias("bit"))
            made = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
            made.withColumns({"blocks": F.lit(blocks), "digits": F.lit(digits)}).write.mode("overwrite").parquet(self._at("filter", n))

    def _filter(self, n: int) -> DataFrame | None:
        return self.spark.read.schema("block bigint, bits binary, blocks int, digits int").parquet(self._at("filter", n)) if n in self._complete("filter") else None

    def passing(self, keys: DataFrame) -> DataFrame:
        """Those of keys(sha256, ...) that the filter of the last snapshot can't rule out: all that are in it, few of the others."""
        n = self._through()
        kept = self._filter(n)
        if n < 0 or kept is None:
            return keys if n >= 0 else keys.limit(0)
        one = kept.select("blocks").first()
        if one is None:
            return keys.limit(0)
        byte = lambda p: F.conv(F.hex(F.substring(F.col("bits"), F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        there = [F.getbit(byte(p), (p % 8).cast("int")) == 1 for p in _probes()]
        asked = keys.withColumn("block", _block(one["blocks"])).join(kept.select("block", "bits"), "block")
        return asked.filter(reduce(Column.__and__, there)).select(keys.columns)

    def known(self, keys: DataFrame) -> DataFrame:
        """(sha256) of those of keys(sha256, ...) that a batch has had. Within a block of `working`, as it writes what passes."""
        n = self._through()
        found = [keys.select("sha256").join(d, "sha256", "left_semi") for d in self._read(self.batches())]
        if n >= 0:
            asked = saved(self.passing(keys.select("sha256")), "contents-asked")
            index, kept = self._index(n), self._filter(n)
            one = kept.select("digits").first() if kept is not None else None
            if one is not None:
                # 256 at most
                folders = [r["f"] for r in asked.select(F.substring("sha256", 1, one["digits"]).alias("f")).distinct().collect()]
                index = index.filter(F.col("folder").isin(folders))
            found.append(asked.join(index.select("sha256"), "sha256", "left_semi"))
        return reduce(DataFrame.unionByName, found).distinct() if found else keys.select("sha256").limit(0)

    def of_batch(self, n: int) -> DataFrame:
        """Rows of the index whose first batch is n; the index is read only where that batch's own folder has gone."""
        own = self._read([n]) if n in self._complete("batch") else []
        return (own[0] if own else self.rows()).filter(F.col("batch") == n)


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("sha256"), F.lit(blocks).cast("bigint"))


def _probes() -> list[Column]:
    return [F.pmod(F.xxhash64("sha256", F.lit(i)), F.lit(BITS).cast("bigint")) for i in range(PROBES)]


def contents(spark: SparkSession, path: str, every: int = 50) -> Contents:
    return Contents(spark, path, every)


def new_files(log: Contents, n: int, files: DataFrame, content: str = "content") -> DataFrame:
    """(sha256, batch, path) of contents that come in batch n of files(path, content) and in none before; for a batch that comes again, what
    it gave then. Null contents have none."""
    if not log.has(n):
        sha = files.select(F.sha2(F.col(f"`{content}`").cast("binary"), 256).alias("sha256"), F.lit(n).cast("bigint").alias("batch"), "path").filter("sha256 is not null")
        with working(log.spark):
            sha = saved(log.merge(sha), "contents-new")
            log.add(n, sha.join(log.known(sha), "sha256", "left_anti"))
    return log.of_batch(n)
