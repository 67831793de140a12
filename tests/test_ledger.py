import datetime as dt

import pytest
from pyspark.sql import functions as F

from debenture.streaming import ledger
from debenture.working import working

DAY = dt.date(2024, 5, 1)
SCHEMA = "company string, doc_type string, date date"


def day(n):
    return DAY + dt.timedelta(days=n)


BATCHES = [
    [("a", "final", day(0)), ("a", "final", day(3)), ("b", None, day(1)), (None, "base", None)],
    [("a", "base", day(1)), ("b", "final", day(2))],
    [],
    [("a", "final", day(2)), ("c", "final", day(9))],
    [("c", "base", day(4))],
]
WANT = [
    (None, 1, None, {"base": 1}),
    ("a", 4, day(3), {"final": 3, "base": 1}),
    ("b", 2, day(2), {"final": 1}),
    ("c", 2, day(9), {"final": 1, "base": 1}),
]


def state(log):
    return sorted(map(tuple, ledger.by_company(log).collect()), key=lambda r: (r[0] is not None, r[0] or ""))


@pytest.mark.parametrize("every", [2, 50])
def test_each_batch_counts_once(spark, tmp_path, every):
    log = ledger.statistics(spark, f"file://{tmp_path}/stats", every)
    assert state(log) == []
    for n, rows in enumerate(BATCHES):
        docs = spark.createDataFrame(rows, SCHEMA)
        assert ledger.add_documents(log, n, docs)
        assert not ledger.add_documents(log, n, docs)
    assert not ledger.add_documents(log, 0, spark.createDataFrame([("z", "z", DAY)], SCHEMA))
    assert state(log) == WANT
    log.compact()
    assert log.batches() == [] and state(log) == WANT


def test_killed_batch_and_killed_snapshot(spark, tmp_path):
    log = ledger.statistics(spark, f"file://{tmp_path}/stats")
    for n, rows in enumerate(BATCHES[:2]):
        ledger.add_documents(log, n, spark.createDataFrame(rows, SCHEMA))
    before = state(log)
    # what a killed write leaves: files, but no mark
    for name in ("batch-2", "snapshot-1"):
        spark.createDataFrame([("a", "final", 1000, DAY)], log.schema).write.parquet(f"file://{tmp_path}/stats/{name}")
        (tmp_path / "stats" / name / "_SUCCESS").unlink()
    assert state(log) == before and log.batches() == [0, 1]
    log.compact()
    assert state(log) == before
    for n, rows in list(enumerate(BATCHES))[2:]:
        assert ledger.add_documents(log, n, spark.createDataFrame(rows, SCHEMA))
    assert state(log) == WANT


def test_contents_over_runs(spark, tmp_path):
    path = f"file://{tmp_path}/seen"
    runs = [[("b", "x"), ("a", "x"), ("c", "y"), ("n", None)], [("d", "y"), ("e", "z"), ("f", "z")], [("g", "x"), ("h", "z")]]
    want = [["a", "c"], ["e"], []]
    for again in range(2):
        for n, rows in enumerate(runs):
            # another run opens the ledger anew
            log = ledger.contents(spark, path, every=2)
            got = ledger.new_files(log, n, spark.createDataFrame(rows, "path string, content string"))
            assert sorted(r["path"] for r in got.collect()) == want[n], (again, n)


def keys(spark, low, high):
    return spark.range(low, high).select(F.sha2(F.col("id").cast("string"), 256).alias("sha256"))


def test_filter_before_the_index(spark, tmp_path):
    log = ledger.contents(spark, f"file://{tmp_path}/seen", every=50)
    assert log.passing(keys(spark, 0, 5)).count() == 0
    old = spark.range(20_000).select(F.concat(F.lit("p"), "id").alias("path"), F.col("id").cast("string").alias("content"))
    assert ledger.new_files(log, 0, old).count() == 20_000
    log.compact()
    # none that is there is ruled out, few of the others aren't
    assert log.passing(keys(spark, 0, 20_000)).count() == 20_000
    assert log.passing(keys(spark, 20_000, 60_000)).count() < 1200
    # open batches are asked too
    ledger.new_files(log, 1, spark.createDataFrame([("q", "60000"), ("r", "7")], "path string, content string"))
    with working(spark):
        got = {r["sha256"] for r in log.known(keys(spark, 19_990, 60_001)).collect()}
    want = {r["sha256"] for r in keys(spark, 19_990, 20_000).collect() + keys(spark, 60_000, 60_001).collect()}
    assert got == want
    assert [r["path"] for r in log.of_batch(1).collect()] == ["q"]


def test_killed_filter(spark, tmp_path):
    log = ledger.contents(spark, f"file://{tmp_path}/seen", every=1)
    row = lambda *rows: spark.createDataFrame(rows, "path string, content string")
    ledger.new_files(log, 0, row(("a", "x"), ("b", "y")))
    (tmp_path / "seen/filter-0/_SUCCESS").unlink()
    assert [r["path"] for r in ledger.new_files(log, 1, row(("c", "x"), ("d", "z"))).collect()] == ["d"]
    assert [r["path"] for r in ledger.new_files(log, 2, row(("e", "z"), ("f", "w"))).collect()] == ["f"]
    # the first snapshots are gone, the state isn't
    assert not (tmp_path / "seen/snapshot-0").exists()
    assert sorted((r["path"], r["batch"]) for r in log.rows().collect()) == [("a", 0), ("b", 0), ("d", 1), ("f", 2)]
    assert [r["path"] for r in ledger.new_files(log, 0, row(("z", "new"))).collect()] != ["z"]


def test_stream_into_ledger(spark, tmp_path):
    source, log = tmp_path / "in", ledger.statistics(spark, f"file://{tmp_path}/stats", every=2)
    for rows in BATCHES:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        stream.writeStream.foreachBatch(lambda d, n: ledger.add_documents(log, n, d) and None).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert state(log) == WANT
