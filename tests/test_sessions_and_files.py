"""Sessions by pointer doubling, the first errors by two phases, files that are swapped whole."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from debenture.operators import metrics
from debenture.sources import whole_files

LOG = "company string, seq long, ts timestamp"


def folded(rows, seconds, requests):
    out = []
    for company in {r[0] for r in rows}:
        session = start = count = None
        for c, seq, ts in sorted([r for r in rows if r[0] == company and r[2] is not None], key=lambda r: (r[2], r[1])):
            at = int(ts.timestamp())
            renew = session is not None and (at - start > seconds or count >= requests)
            if session is None or renew:
                session, start, count = (0 if session is None else session + 1), at, 0
            out.append((c, seq, session, count, at - start, renew))
            count += 1
    return sorted(out, key=str)


@pytest.mark.parametrize("seconds,requests", [(10, 3), (3600, 100), (5, 1), (60, 1000)])
def test_sessions_are_the_fold_s(spark, seconds, requests):
    rng, rows = random.Random(seconds), []
    begin = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    for company, n, gap in (("a", 150, 3), ("b", 40, 30), (None, 20, 9), ("", 5, 5), ("one", 1, 1), ("same", 12, 0)):
        at = 0
        for i in range(n):
            at += rng.randint(0, 2 * gap)
            rows.append((company, i, begin + dt.timedelta(seconds=at)))
    rows += [("a", 9999, None), ("late", 1, None)]
    rng.shuffle(rows)
    got = metrics.session_marks(spark.createDataFrame(rows, LOG), seconds, requests).collect()
    assert sorted((tuple(r) for r in got), key=str) == folded(rows, seconds, requests)


def test_no_requests(spark):
    assert metrics.session_marks(spark.createDataFrame([], LOG)).count() == 0


def test_first_errors_are_cut_before_they_are_moved(spark):
    log = spark.range(1000).select(F.col("id").alias("seq"), F.lit("error").alias("kind"), F.when(F.col("id") % 2 == 0, "search").otherwise("download").alias("component"), F.col("id").cast("string").alias("message"))
    top = metrics.error_top(log, strict=True)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["component"], r["rank"], r["message"], r["more"]) for r in top.collect()) == [(c, i + 1, str(2 * i + odd), 495) for c, odd in (("download", 1), ("search", 0)) for i in range(5)]


def contents(path):
    return {n: open(os.path.join(path, n)).read() for n in os.listdir(path) if not n.startswith(".")}


def test_companies(spark, tmp_path):
    path = str(tmp_path)
    rows = [("A/B plc", 2, "y", None), ("A/B plc", 1, "x", 0.5), ("C", 3, 'q"ü\n', None), (None, 4, "z", None)]
    d = spark.createDataFrame(rows, "company string, doc_id long, title string, size double")
    whole_files.write_companies(d, path, F.struct(F.col("company").alias("name"), F.lit("DE").alias("country")), order=["doc_id"])
    got = {n: json.loads(t) for n, t in contents(path).items()}
    assert got == {
        "A_B plc.json": {"company": {"name": "A/B plc", "country": "DE"}, "documents": [{"doc_id": 1, "title": "x", "size": 0.5}, {"doc_id": 2, "title": "y", "size": None}]},
        "C.json": {"company": {"name": "C", "country": "DE"}, "documents": [{"doc_id": 3, "title": 'q"ü\n', "size": None}]},
    }
    # another run replaces the companies that it has
    whole_files.write_companies(d.filter("company = 'C'").withColumn("title", F.lit("new")), path)
    again = {n: json.loads(t) for n, t in contents(path).items()}
    assert again["A_B plc.json"] == got["A_B plc.json"] and again["C.json"]["documents"] == [{"doc_id": 3, "title": "new", "size": None}]
    whole_files.write_companies(d.limit(0), path)
    assert len(contents(path)) == 2


def test_a_failed_task_leaves_the_old_files(spark, tmp_path):
    path = str(tmp_path)
    names = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("ü",)], "name string")
    whole_files.write_list(names, path, "done.txt")
    assert contents(path) == {"done.txt": "a\nb\nü\n"}
    bad = names.withColumn("name", F.when(F.col("name") == "ü", F.raise_error(F.lit("no more"))).otherwise(F.col("name")))
    rows = bad.select(F.lit("done.txt").alias("file"), F.lit(None).cast("string").alias("head"), F.concat(F.lit("x"), "name").alias("body")).filter("body is not null")
    with pytest.raises(Exception, match="no more"):
        whole_files.write_whole(rows, path)
    assert contents(path) == {"done.txt": "a\nb\nü\n"}
    # rows of one file in two tasks are refused, and nothing changes
    spark.dataSource.register(whole_files.WholeFiles)
    two = names.select(F.lit("done.txt").alias("file"), F.lit(None).cast("string").alias("head"), F.lit("x").alias("body")).repartition(3)
    with pytest.raises(Exception, match="two tasks"):
        two.write.format("whole_files").option("path", path).mode("append").save()
    assert contents(path) == {"done.txt": "a\nb\nü\n"}
