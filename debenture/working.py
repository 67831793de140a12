"""Tables that a job writes on its way, in the folder that driver and executors share: lineage is cut there, lost executors cost no
stage above."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: What `saved` has written in the innermost `working` block of this thread; outside of one nobody keeps a list.
_files: ContextVar[list[str] | None] = ContextVar("files", default=None)
#: Spark then removes the shuffle files of a query as it ends; what is saved here is never read from them again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local Spark takes a temporary one; a
    cluster is refused, as its machines don't see each other's folders."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="debenture-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


@contextmanager
def _cleaning(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: executors may go, no stage above runs twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with _cleaning(spark):
        df.write.parquet(path)
    files = _files.get()
    if files is not None:
        files.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Removes the folders of what `saved` returned; nothing that is still to run may read them."""
    for df in frames:
        _remove(df.sparkSession, df.saved_at)
        files = _files.get()
        if files is not None and df.saved_at in files:
            files.remove(df.saved_at)


@contextmanager
def working(spark: SparkSession):
    """As the block ends, well or not, the folders go that `saved` has written within it and in the same thread, but for those of
    the tables that the block gives to the function it gets (which returns its argument): these belong to what is around it.
    Other threads' files, and those from before, aren't touched."""
    files, kept, outer = [], [], _files.get()
    token = _files.set(files)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.saved_at)
        return df

    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _files.reset(token)
        for path in files:
            if path not in kept:
                _remove(spark, path)
            elif outer is not None:
                outer.append(path)


@contextmanager
def bucketed(df: DataFrame, name: str, key: str):
    """df as a table in the shared folder, in buckets by key, within the block; then the table goes, its files too."""
    spark = df.sparkSession
    name = f"debenture_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with _cleaning(spark):
        df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
        _remove(spark, path)
