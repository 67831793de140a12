"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

Each source's documents, in an order drawn by a hash, form a line of words, cut into blocks of equally many. Slot i of the mix
goes to the source whose share of all blocks holds the i-th van der Corput point; the k-th slot of a source takes its k-th
block, around and around its line, up to the words that its target allows. So a document is taken as often as the line passes it, three times at
most, and any stretch of the mix holds the sources by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, keys_of, saved

#: Words of a source's blocks, where its target holds at least MIN_BLOCKS of them; else its blocks are smaller.
BLOCK_WORDS, MIN_BLOCKS = 1024, 64
#: Documents that a bucket of a source's line holds on average: what a task orders at once.
BUCKET_ROWS = 2048


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """sizes(source, source_size), a row per source, to (source, source_size, target). Weights go around the sources by code
    point, null last. A target stops at `most` times its size; the excess is reshared by weight: target = min(cap, level *
    weight), where level is the one that spends all, found by running sums in order of cap / weight. The windows see a row
    per source, never documents."""
    n = len(weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % n + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy()
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    t = t.withColumns(
        {
            "whole": F.sum("source_size").over(everything) * share,
            "capped": F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "free": F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    # the first source that its cap doesn't stop sets the level
    t = t.withColumn("level", (F.col("whole") - F.col("capped")) / F.col("free"))
    t = t.withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("fits"), F.struct((F.col("cap") / F.col("weight")).alias("at"), F.col("level").alias("level")))).over(everything)["level"]
    return t.select("source", "source_size", F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def van_der_corput(i: Column) -> Column:
    """The bits of i (52 at most, as a double has) behind the point, in reverse."""
    return F.conv(F.reverse(F.lpad(F.bin(i), 52, "0")), 2, 10).cast("double") / float(2**52)


def _passes(docs: DataFrame, source: str, text: str, doc_id: str, weights: tuple[float, ...], block_words: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The line, a row per document, and its stretches (source, bucket, nth, slot, place, words, first): what each slot takes of a
    document, and whether it takes its first word."""
    draw = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null"))))
    keys = keys_of(docs)
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"), keys[0].alias("row_key"), keys[1].alias("row_key2"), draw.alias("draw"))
    d = saved(d, "mix-line")
    n = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    rows = n.agg(F.sum("rows")).first()[0] or 0
    digits = 1
    while 16**digits * BUCKET_ROWS < rows and digits < 7:
        digits += 1
    goal = targets(n.select("source", "source_size"), weights)
    slots = saved(schedule(goal, block_words), "mix-slots")
    # where each document begins in its source's line: sums of buckets of the draw, then within the bucket
    d = d.withColumn("bucket", F.substring("draw", 1, digits))
    per = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    line = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("words").over(line), F.lit(0)))
    g = goal.select(F.col("source").alias("s"), "source_size", "target")
    per = per.join(g, F.col("source").eqNullSafe(F.col("s"))).select("s", F.col("bucket").alias("b"), "before", "source_size", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "size", "row_key", "row_key2")
    d = d.withColumns({"nth": F.row_number().over(inside), "off": F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    d = d.join(per, d["source"].eqNullSafe(per["s"]) & (d["bucket"] == per["b"])).withColumn("begin", F.col("before") + F.col("off"))
    d = saved(d.select("doc_id", "row_key", "row_key2", "source", "size", "source_size", "target", "bucket", "nth", "begin"), "mix-begin")
    # the blocks that a document lies in, at each way around the line
    ways = F.ceil(F.round("target") / F.col("source_size")).cast("long")
    block = block_of(F.round("target").cast("long"), block_words)
    e = d.filter("size > 0 and round(target) > 0").select("source", "bucket", "nth", "begin", "size", "source_size", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), ways - 1)).alias("way"))
    e = e.withColumn("from", F.col("way") * F.col("source_size") + F.col("begin"))
    e = e.withColumn("k", F.explode(F.sequence(F.floor(F.col("from") / F.col("block")), F.floor((F.col("from") + F.col("size") - 1) / F.col("block")))))
    t = slots.select(F.col("source").alias("s"), F.col("k").alias("kk"), F.col("words"), "slot")
    e = e.join(t, e["source"].eqNullSafe(t["s"]) & (e["k"] == t["kk"]))
    low = F.greatest(F.col("from"), F.col("k") * F.col("block"))
    high = F.least(F.col("from") + F.col("size"), F.col("k") * F.col("block") + F.col("words"))
    e = e.select("source", "bucket", "nth", "slot", (low - F.col("k") * F.col("block")).alias("place"), (high - low).cast("long").alias("words"), (low == F.col("from")).alias("first"))
    return d, e.filter("words > 0")


def mix_sources(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", weights: tuple[float, ...] = (5.0, 2.0, 1.0), block_words: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """(doc_id, row_key, row_key2, source, size, source_size, target, taken, passes, first_slot), a row per document: `taken` are the
    words that the mix takes of it, repeats counted, `passes` how often it takes the document's first word, first_slot the
    slot of the mix that does so first; the row keys hash all columns.

    Null text: size 0, never taken. Null source: a source of its own, last. Null doc_id: drawn like any value; ties and
    repeated rows lie next to each other in the line. An empty table gives no rows; other columns don't matter, whatever
    their names. The order hangs on `seed` and the rows alone, so reruns agree."""
    d, e = _passes(docs, source, text, doc_id, weights, block_words, seed)
    e = e.groupBy("source", "bucket", "nth").agg(F.sum("words").alias("taken"), F.count_if("first").alias("passes"), F.min(F.when(F.col("first"), F.col("slot"))).alias("first_slot"))
    e = e.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.col("nth").alias("m"), "taken", "passes", "first_slot")
    out = d.join(e, d["source"].eqNullSafe(e["s"]) & (d["bucket"] == e["b"]) & (d["nth"] == e["m"]), "left")
    return out.select("doc_id", "row_key", "row_key2", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("passes", F.lit(0)).cast("long").alias("passes"), "first_slot")


def mixed(docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", weights: tuple[float, ...] = (5.0, 2.0, 1.0), block_words: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """docs as the mix holds them: each as often as it passes the document's first word, some never; partitions, and the rows in
    them, in the order of the slots. Nulls, ties, repeated rows and empty tables as in mix_sources; columns may have any names."""
    d, e = _passes(docs, source, text, doc_id, weights, block_words, seed)
    e = e.filter("first").select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.col("nth").alias("m"), "slot", "place")
    plan = d.join(e, d["source"].eqNullSafe(e["s"]) & (d["bucket"] == e["b"]) & (d["nth"] == e["m"]))
    key, key2, slot, place = fresh(docs, "key", "key2", "slot", "place")
    plan = saved(plan.select(F.col("row_key").alias(key), F.col("row_key2").alias(key2), F.col("slot").alias(slot), F.col("place").alias(place)), "mix-plan")
    hashes = keys_of(docs)
    own = docs.withColumns({key: hashes[0], key2: hashes[1]})
    # equal rows have one key and can stand for each other
    if d.groupBy("row_key", "row_key2").count().filter("count > 1").limit(1).count():
        own = own.dropDuplicates([key, key2])
    out = own.join(plan, [key, key2]).repartitionByRange(slot, place).sortWithinPartitions(slot, place)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def block_of(words: Column, block_words: int = BLOCK_WORDS) -> Column:
    """Words of a source's blocks, from the words of its target: each source has MIN_BLOCKS blocks or more."""
    return F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(words / MIN_BLOCKS))).cast("long")


def schedule(goal: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, k, words), the mix in order, from goal(source, source_size, target). Slot i goes to the source whose span of
    the cumulative numbers of blocks holds the i-th point, and takes its k-th block; the last block ends with the target. The
    points give a source a few slots more or less than it has blocks: slots without a block go, in order, to the blocks without
    a slot."""
    spark = goal.sparkSession
    g = goal.filter("target > 0").withColumn("quota", F.round("target").cast("long")).filter("quota > 0").withColumn("block", block_of(F.col("quota"), block_words))
    g = g.withColumn("need", F.ceil(F.col("quota") / F.col("block")).cast("long"))
    # these windows see a row per source
    line = Window.orderBy(F.col("source").asc_nulls_last())
    upto = F.sum("need").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum("need").over(Window.partitionBy())
    g = g.withColumns({"nr": F.row_number().over(line), "low": (upto - F.col("need")) / whole, "high": upto / whole})
    g = saved(g.select("source", "quota", "block", "need", "nr", "low", "high"), "mix-sources")
    slots = spark.range(g.agg(F.sum("need")).first()[0] or 0).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("point"))
    # cells of the unit interval, so that points and shares meet by equality
    cells = 4096
    cell = F.least(F.floor(F.col("point") * cells), F.lit(cells - 1))
    cover = g.select("source", "quota", "block", "need", "nr", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))).alias("cell"))
    hit = slots.withColumn("cell", cell).join(cover, "cell").filter("point >= low and point < high")
    # rank of a slot within its source: by stretches of slots, so that no task orders a whole source
    hit = hit.select("nr", "slot", F.floor(F.col("slot") / 65536).alias("stretch"))
    per = hit.groupBy("nr", "stretch").agg(F.count("*").alias("n"))
    per = per.select("nr", "stretch", F.coalesce(F.sum("n").over(Window.partitionBy("nr").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    hit = hit.withColumn("r", F.row_number().over(Window.partitionBy("nr", "stretch").orderBy("slot"))).join(per, ["nr", "stretch"])
    hit = saved(hit.select("nr", "slot", (F.col("before") + F.col("r") - 1).alias("k")), "mix-hits")
    own = hit.join(g, "nr")
    # a few for each source: the discrepancy of the points grows with the logarithm of their number
    free = own.filter("k >= need").select("slot", F.row_number().over(Window.orderBy("slot")).alias("i"))
    had = hit.groupBy(F.col("nr").alias("h")).agg(F.count("*").alias("had"))
    left = g.join(had, g["nr"] == had["h"], "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < need")
    left = left.select("nr", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("k"))
    late = left.withColumn("i", F.row_number().over(Window.orderBy("nr", "k"))).join(free, "i").select("nr", "slot", "k")
    out = own.filter("k < need").select("nr", "slot", "k").unionByName(late).join(g, "nr")
    return out.select("slot", "source", "k", F.least(F.col("block"), F.col("quota") - F.col("k") * F.col("block")).alias("words"))
