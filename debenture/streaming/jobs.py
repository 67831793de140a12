"""The batch behaviours that go on over runs, as Structured Streaming: contents seen once, statistics kept up, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from debenture.operators import records


def new_contents(files: DataFrame, content: str = "content", event_time: str | None = None, late: str = "7 days") -> DataFrame:
    """files whose content hasn't come before. With event_time, hashes are forgotten `late` after it, so that state is bounded."""
    out = files.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))
    return out.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["sha256"]) if event_time else out.dropDuplicates(["sha256"])


def running_counts(documents: DataFrame) -> DataFrame:
    """Documents and last date by company and type, for output mode update or complete."""
    return documents.groupBy("company", "doc_type").agg(F.count("*").alias("n"), F.max("date").alias("last_updated"))


def windowed_counts(log: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return log.withWatermark("ts", late).groupBy(F.window("ts", every), "kind").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "kind", "n")


def extract_stream(documents: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Records of arriving documents, appended as Parquet; the checkpoint is the list of what has been processed. A batch
    that runs twice writes into its own folder twice, so nothing doubles."""

    def write(batch: DataFrame, n: int) -> None:
        records.extracted(batch).write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
