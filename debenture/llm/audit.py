"""What each of five filters removes, in each order of them, by part of the corpus: a packed bitmap index.

Rows become six bits: which filters they fail, and their labels. A task packs its rows, by part, into one bitset for each filter and
label; for each subset of the filters, what is left is the part AND NOT the subset's union, counted by popcount, whole and within
the labels. Counts of tasks are summed. Since a row's removal at a step depends on the set of filters before it alone, the 32
subsets give all 120 orders.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations
from math import factorial
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

FILTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"
#: Parts whose sums a task keeps at a time; then it sends them out.
_PARTS = 4096


def failures(text: Column) -> dict[str, Column]:
    """Of filters A to D, whether a text (not null) fails: under 100 words; fewer than 80 distinct words in 100; more than 10 capitals
    A-Z in 100 code points; one of #$%&*| in it."""
    words = F.array_remove(F.split(text, _SPACE), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": F.regexp_like(text, F.lit("[#$%&*|]")),
    }


def subset_counts(rows: DataFrame, bits: int = len(FILTERS)) -> DataFrame:
    """rows(part, fails, quality, toxic, n): n rows of a part that fail the filters of the bits of `fails`, with quality and toxic
    labels. Gives (part, subset, left, good, toxic): how many of the part no filter of `subset` removes, how many of them have each label."""
    subsets = 1 << bits

    def counted(fails: np.ndarray, quality: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """subsets x 3 counts of these rows, by their packed bits."""
        filters = [np.packbits((fails >> f) & 1 == 1) for f in range(bits)]
        every = np.packbits(np.ones(len(fails), bool))
        labels = (every, np.packbits(quality), np.packbits(toxic))
        union, out = [np.zeros_like(every)], np.zeros((subsets, 3), np.int64)
        for s in range(1, subsets):
            low = (s & -s).bit_length() - 1
            union.append(union[s & (s - 1)] | filters[low])
        for s in range(subsets):
            kept = every & ~union[s]
            out[s] = [int(np.bitwise_count(kept & label).sum()) for label in labels]
        return out

    def run(batches):
        sums: dict[str, np.ndarray] = {}

        def out():
            names = list(sums)
            table = np.concatenate([sums[x] for x in names])
            columns = [pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(names)), subsets))), pa.array(np.tile(np.arange(subsets, dtype=np.int32), len(names)))]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array(table[:, i]) for i in range(3)]], names=["part", "subset", "left", "good", "toxic"])

        for batch in batches:
            part, n = batch.column(0).dictionary_encode(), batch.column(4).to_numpy()
            code = part.indices.to_numpy()
            fails, quality, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            # rows of a part that stand for equally many
            order = np.lexsort((n, code))
            edge = np.flatnonzero(np.concatenate([[True], (np.diff(code[order]) != 0) | (np.diff(n[order]) != 0)])) if len(order) else []
            for a, b in zip(edge, [*edge[1:], len(order)], strict=True):
                own = order[a:b]
                name = part.dictionary[int(code[own[0]])].as_py()
                add = counted(fails[own], quality[own], toxic[own]) * int(n[own[0]])
                sums[name] = sums[name] + add if name in sums else add
            if len(sums) > _PARTS:
                yield out()
                sums.clear()
        if sums:
            yield out()

    got = rows.select("part", F.col("fails").cast("int"), F.col("quality").cast("boolean"), F.col("toxic").cast("boolean"), F.col("n").cast("long")).mapInArrow(run, "part string, subset int, left long, good long, toxic long")
    return got.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("left", "good", "toxic")])


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Per part, order of the filters and step: filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley
    (the filter's removed over all orders).

    Null texts are empty, null parts the empty string, and so one with it. E is failed by a text that a row with a smaller id has as
    well (texts are told apart by their SHA-256); a row without id neither fails it nor makes others fail it. Rows repeated with
    their id count each, and none is smaller than the other. A row is good or toxic if any label of its id says so; labels
    without id count for none. Very long texts are looked at whole. Without rows there are no parts; without labels nothing good or
    toxic is lost. Other columns don't matter."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    d = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), body.alias("body"))
    fails = failures(F.col("body"))
    bits = sum((F.when(fails[x], F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate("ABCD")), F.lit(0))
    # no text goes on from here, and each is read once; rows that are alike in all that counts are one with their number
    d = d.select("id", "part", F.unhex(F.sha2("body", 256)).alias("digest"), bits.alias("bits")).groupBy("id", "digest", "part", "bits").agg(F.count("*").alias("n"))
    d = saved(d, "audit")
    first = d.filter("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    flag = lambda c: F.coalesce(F.max(F.col(f"`{c}`") == 1), F.lit(False))
    marks = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{quality}`").alias("quality"), F.col(f"`{toxic}`").alias("toxic")).filter("id is not null").groupBy("id").agg(flag("quality").alias("quality"), flag("toxic").alias("toxic"))
    # by its id and text a row finds whether it is the first of its text: no text's rows come together in one task
    d = d.join(first, ["id", "digest"], "left").join(marks, "id", "left")
    again = F.col("id").isNotNull() & F.col("first").isNull()
    rows = d.select("part", (F.col("bits") + F.when(again, 16).otherwise(0)).alias("fails"), F.coalesce("quality", F.lit(False)).alias("quality"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    counts = subset_counts(rows).groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", F.struct("left", "good", "toxic")))).alias("c"))

    # 32 entries a part from here on, 600 rows a part come out
    whole = (1 << len(FILTERS)) - 1
    of = lambda subset, what: F.element_at("c", subset)[what]
    removed = lambda subset, bit, what: of(subset, what) - of(subset.bitwiseOR(bit), what)

    def over_all_orders(i: int) -> Column:
        """A set of k filters stands before filter i in k! (4 - k)! of the orders."""
        rest = [j for j in range(len(FILTERS)) if j != i]
        sets = [c for k in range(len(FILTERS)) for c in combinations(rest, k)]
        return reduce(add, [removed(F.lit(sum(1 << j for j in c)), F.lit(1 << i), "left") * (factorial(len(c)) * factorial(len(rest) - len(c))) for c in sets])

    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    out = counts.withColumn("shapley", F.array(*[over_all_orders(i) for i in range(len(FILTERS))]))
    out = out.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    out = out.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    place = F.instr(F.lit(FILTERS), F.col("filter"))
    bit = F.call_function("shiftleft", F.lit(1), place - 1)
    before = reduce(add, [F.when(F.instr("filter_order", x) < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)])
    out = out.withColumns({"place": place, "bit": bit, "before": before})
    gone = removed(F.col("before"), F.col("bit"), "left")
    return out.select(
        "part",
        "filter_order",
        "step",
        "filter",
        of(F.col("before").bitwiseOR(F.col("bit")), "left").alias("kept"),
        gone.alias("removed"),
        (removed(F.lit(0), F.col("bit"), "left") - gone).alias("redundant"),
        removed(F.lit(whole).bitwiseXOR(F.col("bit")), F.col("bit"), "left").alias("unique_fails"),
        removed(F.col("before"), F.col("bit"), "good").alias("good_lost"),
        removed(F.col("before"), F.col("bit"), "toxic").alias("toxic_lost"),
        F.element_at("shapley", F.col("place")).alias("shapley"),
    )
