"""The pipeline's stages over the smallest tables: each keeps what it should of what it was given."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from debenture.llm import decontam, jaccard, mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, docs
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, given, SF)
        assert out.columns == columns or i == 4 and out.columns == [*columns, "shard", "slot"]
        out.write.parquet(str(tmp_path / name))
        given = spark.read.parquet(str(tmp_path / name))
        kept.append([tuple(r) for r in given.select(columns).collect()])
    table = {r["doc_id"]: tuple(r) for r in docs.collect()}
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in quality.judged(docs, model).filter("kept").collect()}
    assert {r[0] for r in kept[0]} == good and len(kept[0]) == len(good) < len(table)
    first = spark.read.parquet(str(tmp_path / "quality"))
    assert sorted(r[0] for r in kept[1]) == sorted({r["class_id"] for r in jaccard.near_duplicates(first).collect()})
    second = spark.read.parquet(str(tmp_path / "near_duplicates"))
    bad = {r["doc_id"] for r in decontam.leaks(second, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r[0] for r in kept[2]} == {r[0] for r in kept[1]} - bad
    third = spark.read.parquet(str(tmp_path / "decontamination"))
    times = Counter({r["doc_id"]: r["passes"] for r in mixing.mix_sources(third).collect()})
    assert Counter(r[0] for r in kept[3]) == +times and max(times.values()) <= 3
    assert Counter(kept[4]) == Counter(kept[3]) and all(table[r[0]] == r for r in kept[4])
    sizes = [r["count"] for r in given.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and given.groupBy("shard").agg((F.max("slot") + 1 - F.count("*")).alias("d")).filter("d <> 0").count() == 0
