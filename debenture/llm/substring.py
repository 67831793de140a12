"""Repeated passages across documents: exact word runs wherever they stand, paragraphs by MinHash banding.

Exact: of every 9 20-word hashes in a row the least is chosen (winnowing), so a run of 28 words that stands in two rows has a
chosen hash there whatever surrounds it. Where what is found so begins, ends or changes its rows, all 20-word hashes are looked
up again: repeated passages are known to the word at both ends.

Near: a paragraph is a line of 10 words or more. Paragraphs are banded whole by MinHash of their five-word shingles, neighbours
in a band are joined into candidate groups, groups are verified exactly (Jaccard of the paragraphs) and their links clustered
by components. Of each passage and cluster the first place stays, the others are to be removed.
"""

from __future__ import annotations

from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, components, mix, saved, shingles, signed, slices, utf8
from .jaccard import SHINGLE, THRESHOLD, _text_hash, minima, verified

GRAM, REACH = 20, 9
#: Words of the shortest paragraph.
PARAGRAPH = 10
ROWS, RECALL = 3, 0.99


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, target: float = RECALL) -> int:
    """The least number of bands of `rows` minima with which a pair at the threshold meets with the target recall."""
    n = 1
    while 1 - (1 - threshold**rows) ** n < target:
        n += 1
    return n


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` values in a row."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def _most(x: np.ndarray, width: int) -> np.ndarray:
    return ~_least(~x, width)


def _grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the GRAM words from each word on, row of each word); what isn't in one row is to be left out."""
    h, row = w.hash(), np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    if len(h) < GRAM:
        return np.zeros(0, np.uint64), row
    out, have, left, power = None, 0, GRAM, 1
    base = 0x9E3779B97F4A7C15
    while left:
        if left & power:
            n = len(w.start) - have - power + 1
            out = h[:n] if out is None else out[:n] * np.uint64(pow(base, power, 1 << 64)) + h[have : have + n]
            have, left = have + power, left - power
        h = h[: len(h) - power] * np.uint64(pow(base, power, 1 << 64)) + h[power:] if left else h
        power *= 2
    return mix(out), row


def chosen(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place of the first word in the whole, hash) of the winnowed runs, once per row and hash."""
    g, row = _grams(w)
    span = REACH + GRAM - 1
    if len(row) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = _least(g, REACH)
    low[row[: len(low)] != row[span - 1 :]] = 0
    edge = np.zeros(REACH - 1, np.uint64)
    at = np.flatnonzero(_most(np.concatenate([edge, low, edge]), REACH) == g)
    _, once = np.unique(mix(g[at] ^ (row[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))), return_index=True)
    at = at[np.sort(once)]
    return row[at], at, g[at]


def _paragraphs(w: Words) -> tuple[np.ndarray, Words]:
    """(row of each paragraph, words whose rows are the paragraphs): lines with a word."""
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    line = np.concatenate([[0], np.cumsum(w.data == 10)])[w.start]
    begin = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (line[1:] != line[:-1])])) if len(row) else np.zeros(0, np.int64)
    p = copy(w)
    p.first = np.append(begin, len(row)).astype(np.int64)
    return row[begin], p


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("row_at"), F.col(f"`{text}`").alias("text"))


def _chosen(rows: DataFrame) -> DataFrame:
    """(row_at, place, gram) of the winnowed runs."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row, at, g = chosen(w)
                if len(at):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + a)), pa.array((at - w.first[row]).astype(np.int32)), pa.array(signed(g))], names=["row_at", "place", "gram"])

    return rows.select("row_at", "text").mapInArrow(run, "row_at long, place int, gram long")


def _around(rows: DataFrame) -> DataFrame:
    """(doc_id, row_at, text, at: array of from, to) to (doc_id, row_at, place, gram): all runs that begin at these places."""
    kept = rows.select("doc_id", "row_at", "text", F.col("at.low").alias("low"), F.col("at.high").alias("high"))

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            many = np.concatenate([[0], np.cumsum(batch.column(3).value_lengths().to_numpy(zero_copy_only=False))])
            low, high = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                g, row = _grams(w)
                own = np.repeat(np.arange(b - a), np.diff(many[a : b + 1]))
                change = np.zeros(len(row) + 1, np.int64)
                np.add.at(change, np.maximum(low[many[a] : many[b]], 0) + w.first[own], 1)
                np.add.at(change, np.minimum(high[many[a] : many[b]] + 1 + w.first[own], w.first[own + 1]), -1)
                want = np.flatnonzero(np.cumsum(change)[: len(g)] > 0)
                want = want[row[want] == row[want + GRAM - 1]]
                if len(want):
                    take = pa.array(row[want] + a)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array((want - w.first[row[want]]).astype(np.int32)), pa.array(signed(g[want]))], names=["doc_id", "row_at", "place", "gram"])

    return kept.mapInArrow(run, f"doc_id {kept.schema[0].dataType.simpleString()}, row_at long, place int, gram long")


def _long(w: Words) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words by paragraph, numbers of the paragraphs that count, row of each, text hash of each): once per row and text."""
    row, p = _paragraphs(w)
    some = np.flatnonzero(np.diff(p.first) >= PARAGRAPH)
    own = _text_hash(p)[some]
    _, once = np.unique(mix(own ^ (row[some].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))), return_index=True)
    once.sort()
    return p, some[once], row[some[once]], own[once]


def _banded(rows: DataFrame, bands: int) -> DataFrame:
    """(band, cls) of the paragraphs, equal ones of a slice once."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                p, some, _, own = _long(w)
                if not len(some):
                    continue
                own, once = np.unique(own, return_index=True)
                m = minima(*shingles(p.hash(), p.first, SHINGLE), bands * ROWS)[:, some[once]]
                keys = np.zeros((len(once), bands), np.uint64)
                for t in range(bands):
                    k = np.full(len(once), t + 1, np.uint64)
                    for j in range(t * ROWS, (t + 1) * ROWS):
                        k = mix(k ^ (m[j].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
                    keys[:, t] = k
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys.reshape(-1))), pa.array(np.repeat(signed(own), bands))], names=["band", "cls"])

    return rows.select("text").mapInArrow(run, "band long, cls long")


def _places(rows: DataFrame) -> DataFrame:
    """(doc_id, row_at, place, n, cls) of the paragraphs."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                p, some, row, own = _long(w)
                if len(some):
                    take = pa.array(row + a)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array((p.first[some] - w.first[row]).astype(np.int32)), pa.array(np.diff(p.first)[some].astype(np.int32)), pa.array(signed(own))], names=["doc_id", "row_at", "place", "n", "cls"])

    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, row_at long, place int, n int, cls long")


def _sets(rows: DataFrame) -> DataFrame:
    """(text, wanted: array of place, n, cls, root) to (cls, root, n, shingles)."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            wanted = batch.column(1).to_pylist()
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                s, first = shingles(w.hash(), w.first, SHINGLE)
                out = [(x["cls"], x["root"], np.unique(s[first[i] + x["place"] : first[i] + x["place"] + x["n"] - SHINGLE + 1])) for i in range(b - a) for x in wanted[a + i]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([len(x[2]) for x in out], pa.int64()), pa.array([x[2].tobytes() for x in out], pa.binary())], names=["cls", "root", "n", "shingles"])

    return rows.select("text", "wanted").mapInArrow(run, "cls long, root long, n long, shingles binary")


def exact_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row_at, place, n, cluster, removed, kept): word runs of 20 or more that stand in another row as well, to the
    word. Runs of 28 words or more are all found, shorter ones where they happen to hold a winnowed hash."""
    rows = _rows(docs, text, doc_id)
    same, row = Window.partitionBy("gram"), Window.partitionBy("row_at").orderBy("place")
    twice = F.min("row_at").over(same) != F.max("row_at").over(same)
    # what follows in all rows of a hash at one distance needs no look between: only where rows leave or join may an end be
    who = F.struct(F.bit_xor("row_at").over(same).alias("rows"), F.count("*").over(same).alias("many"), F.sum("place").over(same).alias("places"))
    hits = saved(_chosen(rows).withColumn("who", who).withColumn("twice", twice).filter("twice").drop("twice", "gram"), "substring-hits")
    step = lambda x, y: (y["place"] - x["place"] <= REACH) & (x["who"]["rows"] == y["who"]["rows"]) & (x["who"]["many"] == y["who"]["many"]) & (y["who"]["places"] - x["who"]["places"] == x["who"]["many"] * (y["place"] - x["place"]))
    me = F.struct("place", "who")
    before, behind = F.lag(me).over(row), F.lead(me).over(row)
    hits = hits.withColumns({"me": me, "before": before, "behind": behind})
    hits = hits.withColumn("low", F.col("place") - F.when(F.coalesce(step(F.col("before"), F.col("me")), F.lit(False)), 0).otherwise(REACH - 1))
    hits = hits.withColumn("high", F.col("place") + F.when(F.coalesce(step(F.col("me"), F.col("behind")), F.lit(False)), 0).otherwise(REACH - 1))
    at = hits.groupBy(F.col("row_at").alias("in_row")).agg(F.collect_list(F.struct("low", "high")).alias("at"))
    runs = _around(rows.join(at, F.col("row_at") == F.col("in_row")).dropDuplicates(["row_at"]))
    runs = runs.withColumn("head", F.min(F.struct("doc_id", "row_at", "place")).over(same)).withColumn("twice", twice).filter("twice")
    runs = runs.withColumn("removed", F.col("row_at") != F.col("head.row_at")).withColumn("way", F.col("place") - F.col("head.place"))
    # runs that overlap, with the same first place, are one passage
    last = F.lag(F.struct("place", F.col("head.row_at").alias("of"), "way")).over(row)
    runs = runs.withColumn("last", last).withColumn("fresh", ~F.coalesce((F.col("place") - F.col("last.place") <= REACH) & (F.col("last.of") == F.col("head.row_at")) & (F.col("last.way") == F.col("way")), F.lit(False)))
    runs = runs.withColumn("part", F.count_if("fresh").over(row))
    out = runs.groupBy("row_at", "part").agg(F.first("doc_id").alias("doc_id"), F.min("place").alias("place"), (F.max("place") - F.min("place") + GRAM).cast("int").alias("n"), F.min(F.struct("place", "gram"))["gram"].alias("cluster"), F.first("removed").alias("removed"), F.first("head.doc_id").alias("kept"))
    return saved(out.select("doc_id", "row_at", "place", "n", "cluster", "removed", "kept"), "substring-exact")


def near_paragraphs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row_at, place, n, cluster, removed, kept): paragraphs that stand in another row as well, alike or with a
    Jaccard similarity at the threshold or above."""
    bands = bands_for(threshold)
    rows = _rows(docs, text, doc_id)
    near = Window.partitionBy("band").orderBy("cls")
    edges = _banded(rows, bands).withColumn("before", F.lag("cls").over(near)).filter("before <> cls")
    groups = saved(components(edges.select(F.col("cls").alias("a"), F.col("before").alias("b")), "substring-candidates"), "substring-groups")
    at = saved(_places(rows), "substring-paragraphs")
    # a common paragraph is one row before it meets its group
    first = at.groupBy("cls").agg(F.min(F.struct("row_at", "place", "n")).alias("f")).join(groups, F.col("cls") == F.col("node"))
    wanted = first.groupBy(F.col("f.row_at").alias("in_row")).agg(F.collect_list(F.struct(F.col("f.place").alias("place"), F.col("f.n").alias("n"), "cls", "root")).alias("wanted"))
    one = rows.select("row_at", "text").join(wanted, F.col("row_at") == F.col("in_row"))
    found = saved(verified(_sets(one).dropDuplicates(["cls"]), threshold), "substring-links")
    roots = saved(components(found.select(F.col("cls").alias("a"), F.col("to").alias("b")), "substring-classes"), "substring-roots")
    # clusters with two places or more: paragraphs found twice, and paragraphs with a link
    twice = at.groupBy("cls").agg(F.min("row_at").alias("l"), F.max("row_at").alias("h")).filter("l <> h")
    known = twice.select("cls").unionByName(roots.select(F.col("node").alias("cls"))).distinct()
    # written, so that Spark can split the places of a common paragraph as they meet it
    known = saved(known.join(roots, known["cls"] == roots["node"], "left").select("cls", F.coalesce("root", "cls").alias("cluster")), "substring-known")
    hits = saved(at.join(known, "cls").select("doc_id", "row_at", "place", "n", "cluster").distinct(), "substring-lines")
    heads = hits.groupBy("cluster").agg(F.min(F.struct("doc_id", "row_at", "place")).alias("head"), F.min("row_at").alias("l"), F.max("row_at").alias("h")).filter("l <> h")
    out = hits.join(heads, "cluster")
    return out.select("doc_id", "row_at", "place", "n", "cluster", (~F.struct("doc_id", "row_at", "place").eqNullSafe(F.col("head"))).alias("removed"), F.col("head.doc_id").alias("kept"))


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_blocks, n_removed, removed_words, kept_docs, places, lengths, removed, classes), a row per row of docs that
    holds a passage which stands in another row as well: a run of words, alike and to its ends (28 words or more for sure, 20 to
    27 by chance), or a paragraph (a line of 10 words or more), alike or with a Jaccard similarity at the threshold or above.
    places, lengths: first word and number of words of each passage; classes: the same for passages that begin alike, and for
    the paragraphs of a cluster; removed: whether it stands at an earlier place too (least doc_id, then row, then place);
    removed_words: words under removed passages; kept_docs: the doc_ids of the first places.

    Null, empty and short texts (under 10 words) have no passages. What is found again in its own row counts once, at its first
    place. Repeated rows (equal id and text) are one row; equal texts of other ids are repeats. Null doc_ids come first.
    Empty tables give no rows; other columns don't matter."""
    spans = exact_passages(docs, text, doc_id).unionByName(near_paragraphs(docs, text, doc_id, threshold))
    one = F.struct("place", "n", "cluster", "removed", "kept")
    out = spans.groupBy("row_at").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(one)).alias("b"))
    out = out.withColumn("gone", F.filter("b", lambda x: x["removed"]))
    words = F.aggregate(
        "gone",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("words")),
        lambda a, x: F.struct(F.greatest(a["end"], x["place"] + x["n"]).alias("end"), (a["words"] + F.greatest(F.lit(0), x["place"] + x["n"] - F.greatest(a["end"], x["place"]))).alias("words")),
        lambda a: a["words"],
    )
    return out.select(
        "doc_id",
        F.size("b").cast("long").alias("n_blocks"),
        F.size("gone").cast("long").alias("n_removed"),
        words.cast("long").alias("removed_words"),
        F.sort_array(F.array_distinct("gone.kept")).alias("kept_docs"),
        F.col("b.place").alias("places"),
        F.col("b.n").alias("lengths"),
        F.col("b.removed").alias("removed"),
        F.col("b.cluster").alias("classes"),
    )
