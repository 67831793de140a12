"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix. DataFrame functions only.

Rows lie in logical partitions (by a hash, so that a task that runs again sees the same). How many rows partition p sends to
shard s in a uniform permutation follows the multivariate hypergeometric law; the matrix of these counts is drawn exactly
from the row counts alone. Then each partition permutes its rows and deals them out by its row of the matrix, and each shard
permutes what it got.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, keys_of, saved

#: Rows that a logical partition, and a part of a shard, hold on average: what a task orders at once.
PART_ROWS = 8192
#: Logical partitions at most, as the driver draws their matrix; beyond, each holds more rows.
MOST_PARTS = 16384
#: Copies of one row that a task makes at a time.
COPIES = 1 << 16


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of `draws` drawn from good + bad without putting back are good. Inversion from the mode outward: exact up to
    the rounding of doubles, in steps in the order of the standard deviation."""
    from math import exp, lgamma

    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    p = exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    u = rng.random() - p
    down, up, pd, pu = mode, mode, p, p
    while u > 0 and (down > low or up < high):
        if down > low:
            pd *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= pd
            if u <= 0:
                return down
        if up < high:
            pu *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= pu
            if u <= 0:
                return up
    return mode


def matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows per partition and shard. Shards hold n // shards rows, and one more in the first n % shards of a drawn order."""
    rng, n = random.Random(seed), sum(counts)
    more = rng.sample(range(shards), n % shards)
    room = [n // shards + (s in more) for s in range(shards)]
    out = []
    for c in counts:
        left, row, total = c, [], sum(room)
        for s in range(shards):
            total -= room[s]
            x = hypergeometric(rng, room[s], total, left)
            row.append(x)
            left -= x
        room = [a - b for a, b in zip(room, row, strict=True)]
        out.append(row)
    return out


def shard(docs: DataFrame, shards: int = 8, seed: int = 7) -> DataFrame:
    """docs with `shard` (0 to shards - 1, row counts at most one apart) and `slot` (gapless from 0 in each shard).

    Nulls, empty and very long texts are rows like any other. Repeated rows are dealt out each for itself. An empty table gives no
    rows. Columns named shard or slot are replaced, others may have any names. The result hangs on the rows and the seed alone."""
    d = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")])
    key, key2 = fresh(d, "key", "key2")
    hashes = keys_of(d)
    d = d.withColumns({key: hashes[0], key2: hashes[1]})
    slim = saved(d.select(F.col(key).alias("key"), F.col(key2).alias("key2")).groupBy("key", "key2").count(), "shard-keys")
    placed = saved(places(slim, shards, seed), "shard-places")
    # equal rows stand for each other: one of them is read, as often as it was placed
    if slim.filter("count > 1").limit(1).count():
        d = d.dropDuplicates([key, key2])
    discard(slim)
    placed = placed.select(F.col("key").alias(key), F.col("key2").alias(key2), "shard", "slot")
    return d.join(placed, [key, key2]).drop(key, key2)


def places(slim: DataFrame, shards: int, seed: int) -> DataFrame:
    """(key, key2, shard, slot), a row per row that slim(key, key2, count) stands for. No texts are moved."""
    spark = slim.sparkSession
    n = slim.agg(F.sum("count")).first()[0] or 0
    # a row that is there very often is first cut into ranges, which are dealt out, so that no task makes all of its copies
    ranges = slim.select("key", "key2", "count", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(COPIES).cast("long"))).alias("from"))
    if slim.filter(F.col("count") > COPIES).limit(1).count():
        ranges = ranges.repartition("key", "key2", "from")
    rows = ranges.select("key", "key2", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + COPIES, F.col("count")) - 1)).alias("nth"))
    draw = lambda x: F.xxhash64(F.lit(seed), F.lit(x), "key", "key2", "nth")
    parts = min(MOST_PARTS, max(8, -(-n // PART_ROWS)))
    rows = rows.withColumn("part", F.pmod(draw("part"), F.lit(parts)).cast("int"))
    found = {r[0]: r[1] for r in rows.groupBy("part").count().collect()}
    counts = [found.get(p, 0) for p in range(parts)]
    m = matrix(counts, shards, seed)
    # a row per partition: where the rows for each shard begin in the partition's own permutation
    steps = [(p, [(sum(m[p][:s]), s) for s in range(shards) if m[p][s]]) for p in range(parts) if counts[p]]
    steps = spark.createDataFrame(steps, "part int, steps array<struct<low: long, s: int>>")
    pieces = max(1, -(-n // (shards * PART_ROWS)))
    local = Window.partitionBy("part").orderBy(draw("local"), "key", "key2", "nth")
    rows = rows.withColumn("r", (F.row_number().over(local) - 1).cast("long")).join(steps, "part")
    rows = rows.select("key", "key2", "nth", F.element_at(F.filter("steps", lambda x: x["low"] <= F.col("r")), -1)["s"].alias("shard"), draw("again").alias("draw"))
    # the shard's own permutation goes by parts of the range of a second draw
    at = F.floor(F.shiftrightunsigned("draw", 11).cast("double") / float(2**53) * pieces)
    rows = saved(rows.withColumn("piece", F.least(at, F.lit(pieces - 1)).cast("int")), "shard-dealt")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("shard", "piece").count().select("shard", "piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inner = Window.partitionBy("shard", "piece").orderBy("draw", "key", "key2", "nth")
    out = rows.withColumn("r", F.row_number().over(inner) - 1).join(sizes, ["shard", "piece"])
    return out.select("key", "key2", "shard", (F.col("before") + F.col("r")).cast("long").alias("slot"))
