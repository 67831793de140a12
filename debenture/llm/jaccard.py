"""Near-duplicate join on word shingles: an LSH forest of MinHash signatures, then exact verification.

Every text has one label in each of `trees` tries: `depth` bytes, each from one minimum, behind the trie's number in one long, so
that labels in order are the trie in order and a node is the range of labels with one prefix. Matching begins with whole labels.
Texts that share a node are joined into candidate groups by stars, not by pairs, and a group is verified exactly, block against
block: a task holds two blocks and returns, per text, its number of links and one link to its part of the block, never the
pairs. From the similarities of the links found, each weighed by the chance to be found at this depth, follows how many were
missed; as long as that is more than the target recall allows, the prefixes are shortened by one byte. Then groups are met by
others at the shorter prefixes, and only those that have grown are verified anew. Equal texts are one class throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bucketed, components, discard, fresh, mix, saved, shingles, signed, slices, utf8, working

SHINGLE, THRESHOLD, TREES, DEPTH, RECALL = 5, 0.8, 24, 7, 0.999
#: Where no link was found, prefixes are shortened until links at the threshold would be found with this chance.
SURE = 0.99
#: Texts and shingles of a block of a candidate group, on average.
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 1 << 20


def recall(similarity, trees: int, depth: int):
    """The chance that texts of this similarity share a prefix of `depth` minima in one of the tries."""
    return 1 - (1 - similarity**depth) ** trees


def minima(h: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """count x rows least values of as many hash functions; rows without shingles get 0."""
    rows = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((count, len(first) - 1), np.uint32)
    if not len(rows):
        return out
    step, at = 1 << 15, 0
    starts = first[rows]
    ends = first[rows + 1]
    out[:, rows] = np.uint32(0xFFFFFFFF)
    # pieces of 32768 shingles stay in cache through all functions
    for low in range(int(starts[0]), int(ends[-1]), step):
        high = min(low + step, int(ends[-1]))
        a = int(np.searchsorted(ends, low, "right"))
        b = int(np.searchsorted(starts, high, "left"))
        cut = np.maximum(starts[a:b], low) - low
        x = (h[low:high] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        stride = (h[low:high] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        y, z = np.empty_like(x), np.empty_like(x)
        own = rows[a:b]
        for i in range(count):
            x += stride
            np.right_shift(x, np.uint32(15), out=y)
            np.bitwise_xor(x, y, out=y)
            np.multiply(y, np.uint32(0x2C1B3C6D), out=y)
            np.right_shift(y, np.uint32(13), out=z)
            np.bitwise_xor(y, z, out=y)
            out[i, own] = np.minimum(out[i, own], np.minimum.reduceat(y, cut))
    return out


def _text_hash(w: Words) -> np.ndarray:
    """A hash of each row's words in order; 0 where there are none."""
    h = w.hash()
    n = np.diff(w.first)
    place = (np.arange(len(h)) - np.repeat(w.first[:-1], n)).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + mix(place + np.uint64(0xA0761D6478BD642F))))])
    out = mix((sums[w.first[1:]] - sums[w.first[:-1]]) + n.astype(np.uint64))
    return np.where(n > 0, np.maximum(out, 1), 0).astype(np.uint64)


def labels(m: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """rows x trees labels from trees * depth minima of each row: the trie's number, then a byte of each minimum."""
    low = (m & np.uint32(0xFF)).astype(np.int64).reshape(trees, depth, -1)
    out = np.repeat(np.arange(trees, dtype=np.int64)[:, None], low.shape[2], 1)
    for j in range(7):
        out = (out << 8) | (low[:, j] if j < depth else 0)
    return out.T


def _signed(docs: DataFrame, text: str, doc_id: str, trees: int, depth: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                s, first = shingles(w.hash(), w.first, SHINGLE)
                own = np.ascontiguousarray(labels(minima(s, first, trees * depth), trees, depth))
                column = pa.ListArray.from_arrays(pa.array(np.arange(0, own.size + 1, trees, dtype=np.int32)), pa.array(own.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(signed(_text_hash(w))), pa.array(np.diff(first)), column], names=["doc_id", "cls", "n", "labels"])

    kept = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return kept.mapInArrow(run, f"doc_id {kept.schema[0].dataType.simpleString()}, cls long, n long, labels array<long>")


def _sets(rows: DataFrame) -> DataFrame:
    """(doc_id, text, cls, part) to (cls, part, shingles): distinct shingles as sorted bytes, where the text is the class's."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            want = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                s, first = shingles(w.hash(), w.first, SHINGLE)
                is_it = np.flatnonzero(signed(_text_hash(w)) == want[a:b])
                sets = [np.unique(s[first[i] : first[i + 1]]) for i in is_it]
                take = pa.array(is_it + a)
                yield pa.RecordBatch.from_arrays([batch.column(1).take(take), batch.column(2).take(take), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["cls", "root", "n", "shingles"])

    return rows.select("text", "cls", "root").mapInArrow(run, "cls long, root long, n long, shingles binary")


def linked(cls: np.ndarray, side: np.ndarray, sets: list[np.ndarray], threshold: float, chances: tuple = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: links to others (of the other side, where there are two), the least text that links lead to, and, for each of
    `chances`, how many more such links there should be if each was found with that chance, a function of its similarity."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    everything = np.concatenate(sets)
    row = np.repeat(np.arange(n), sizes)
    order = np.argsort(everything, kind="stable")
    s = everything[order]
    fresh = np.concatenate([[True], s[1:] != s[:-1]])
    code = np.cumsum(fresh) - 1
    often = np.bincount(code) > 1
    new = np.cumsum(often) - 1
    keep = often[code]
    code, row = new[code[keep]], row[order[keep]]
    width = int(new[-1]) + 1 if len(new) else 0
    two = side.max() != side.min()
    left = np.flatnonzero(side == side.min()) if two else np.arange(n)
    right = np.flatnonzero(side == side.max()) if two else left
    inter = np.zeros((len(left), len(right)), np.float32)
    slab = max(256, (1 << 23) // max(1, n))
    edges = np.searchsorted(code, np.arange(0, width + slab, slab))
    for k in range(len(edges) - 1):
        a, b = edges[k], edges[k + 1]
        if a == b:
            continue
        m = np.zeros((n, min(slab, width - k * slab)), np.float32)
        m[row[a:b], code[a:b] - k * slab] = 1
        inter += m[left] @ m[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - inter.astype(np.float64)
    similarity = inter / np.maximum(union, 1)
    link = similarity >= threshold
    if not two:
        np.fill_diagonal(link, False)
    links, least, missed = np.zeros(n, np.int64), cls.copy(), np.zeros((n, len(chances)))
    links[left] += link.sum(1)
    if two:
        links[right] += link.sum(0)
    l, r = np.nonzero(link)
    alike = similarity[l, r]
    l, r = left[l], right[r]
    for k, chance in enumerate(chances):
        more = 1 / chance(alike) - 1
        missed[:, k] += np.bincount(l, more, n)
        if two:
            missed[:, k] += np.bincount(r, more, n)
    while len(l):
        before = least.copy()
        np.minimum.at(least, l, before[r])
        np.minimum.at(least, r, before[l])
        # a pointer jump: to the least of one's least
        index = np.searchsorted(cls_sorted := np.sort(cls), least)
        least = np.minimum(least, least[np.argsort(cls, kind="stable")[index]])
        if (least == before).all():
            break
        del cls_sorted
    return links, least, missed


def verified(sets: DataFrame, threshold: float = THRESHOLD, chances: tuple = ()) -> DataFrame:
    """(cls, root, n, shingles) to (cls, links, to, missed): blocks of a group (root) against each other, each pair of blocks once.
    missed: a number for each of `chances`, as `linked` has it."""
    size = sets.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    d = sets.join(size, "root").withColumn("c", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    d = d.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    d = d.select("root", F.least("c", "x").alias("i"), F.greatest("c", "x").alias("j"), "c", "cls", "shingles")
    d = d.withColumn("at", F.xxhash64("root", "i", "j")).repartition("at").sortWithinPartitions("at", "root", "i", "j", "cls")

    def group(key, rows):
        c = np.array([r[0] for r in rows])
        if len(rows) < 2 or (key[2] != key[3] and len(set(c.tolist())) < 2):
            return None
        cls = np.array([r[1] for r in rows], np.int64)
        links, least, missed = linked(cls, c, [np.frombuffer(r[2], np.uint64) for r in rows], threshold, chances)
        some = links > 0
        return cls[some], links[some], least[some], missed[some]

    def run(batches):
        key, rows = None, []

        def out(found):
            missed = pa.ListArray.from_arrays(pa.array(np.arange(len(found[0]) + 1, dtype=np.int32) * len(chances), pa.int32()), pa.array(found[3].reshape(-1)))
            return pa.RecordBatch.from_arrays([*[pa.array(x) for x in found[:3]], missed], names=["cls", "links", "to", "missed"])

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("at", "root", "i", "j", "c", "cls", "shingles")]
            for r in zip(*cols, strict=True):
                if r[:4] != key:
                    if rows and (found := group(key, rows)) is not None:
                        yield out(found)
                    key, rows = r[:4], []
                rows.append(r[4:])
        if rows and (found := group(key, rows)) is not None:
            yield out(found)

    return d.mapInArrow(run, "cls long, links long, to long, missed array<double>")


def matched(classes: DataFrame, drop: int, groups: DataFrame | None) -> DataFrame:
    """(a, b), written: candidate links of classes(cls, labels) at the nodes of the tries that are `drop` bytes above the leaves, of each
    text to the least one at its node. With groups(cls, root), what has met before is one: links are between roots, and only nodes
    in which different groups meet have any."""
    own = classes.select(F.col("cls").alias("of"), "labels") if groups is None else classes.select("cls", "labels").join(groups.select("cls", "root"), "cls", "left").select(F.coalesce("root", "cls").alias("of"), "labels")
    nodes = own.select("of", F.explode("labels").alias("label")).select("of", F.shiftright("label", 8 * drop).alias("node"))
    stars = nodes.groupBy("node").agg(F.min("of").alias("low"), F.max("of").alias("high")).filter("low <> high")
    return saved(nodes.join(stars.select("node", "low"), "node").filter("of <> low").select(F.col("of").alias("a"), F.col("low").alias("b")).distinct(), "jaccard-met")


def grown(groups: DataFrame | None, met: DataFrame) -> DataFrame:
    """(cls, root, new), written: groups after their roots, and texts that were in none, have met by met(a, b); new says which are not
    what they were."""
    merged = components(met, "jaccard-candidates").select("node", F.col("root").alias("to"))
    if groups is None:
        return saved(merged.select(F.col("node").alias("cls"), F.col("to").alias("root"), F.lit(True).alias("new")), "jaccard-groups")
    moved = groups.select("cls", "root").join(merged, F.col("root") == F.col("node"), "left").select("cls", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("new"))
    alone = merged.join(groups.select("cls"), F.col("node") == F.col("cls"), "left_anti").select(F.col("node").alias("cls"), F.col("to").alias("root"), F.lit(True).alias("new"))
    return saved(moved.unionByName(alone), "jaccard-groups")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = RECALL, id_hash: str | None = None) -> DataFrame:
    """(doc_id, class_id, copy_id, n_copies, n_links), a row per row of docs. copy_id: least doc_id with the same words in the
    same order, n_copies: rows with them; n_links: other such texts with a Jaccard similarity of their sets of shingles (five
    words; a shorter text is one shingle) at the threshold or above; class_id: least doc_id of the component of these links.

    Null, empty or blank texts aren't compared: class and copy are the row itself. Null doc_id: its row takes part, a class of
    nothing but such rows has a null id. Repeated rows and equal texts are copies. Texts are hashed to 64 bits. An empty table
    gives no rows; other columns don't matter. Prefixes (`depth` bytes at most, 7 is the most) are shortened until, by the
    links found, the share of all links that was found is at the target. id_hash: a column of docs with xxhash64 of the id."""
    s = saved(_signed(docs, text, doc_id, trees, depth), "jaccard-signed")
    tries = saved(s.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"), F.first("labels").alias("labels")), "jaccard-tries")
    classes = tries.drop("labels")
    texts = docs.select(F.col(f"`{id_hash}`").alias("at") if id_hash else F.xxhash64(f"`{doc_id}`").alias("at"), F.col(f"`{text}`").alias("text"))
    chances = tuple(lambda x, d=d: recall(x, trees, d) for d in range(1, depth + 1))
    groups = found = None
    for d in range(depth, 0, -1):
        with working(docs.sparkSession) as keep:
            met = matched(tries, 7 - d, groups)
            # groups that nothing has joined stay as they were verified
            if found is None or not met.isEmpty():
                last = (groups, found)
                groups = keep(grown(groups, met))
                # ids by hash, so that null is a value and a table in buckets needn't be moved; what isn't the class's text falls out in _sets
                lead = classes.join(groups.filter("new").select("cls", "root"), "cls").select("cls", "root", F.xxhash64("copy_id").alias("lead"))
                sets = saved(_sets(texts.join(lead, F.col("at") == F.col("lead"))).dropDuplicates(["cls"]), "jaccard-sets")
                now = verified(sets, threshold, chances)
                if last[1] is not None:
                    now = now.unionByName(last[1].join(groups.filter("new").select("cls"), "cls", "left_anti"))
                found = keep(saved(now, "jaccard-links"))
                discard(*[x for x in last if x is not None])
        links, missed = found.agg(F.sum("links"), F.sum(F.get("missed", F.lit(d - 1)))).first()
        # where nothing was found there is nothing to go by but the chance of the least similar links
        if (links / (links + missed) if links else recall(threshold, trees, d)) >= (target if links else SURE):
            break
    links = found.groupBy("cls").agg(F.sum("links").alias("n_links"))
    with working(docs.sparkSession) as keep:
        roots = components(found.select(F.col("cls").alias("a"), F.col("to").alias("b")), "jaccard-classes").select(F.col("node").alias("cls"), "root")
        classes = classes.join(links, "cls", "left").join(roots, "cls", "left").select("cls", "copy_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "cls").alias("root"))
        classes = keep(saved(classes, "jaccard-table"))
    discard(found, groups, tries)
    heads = classes.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    classes = classes.join(heads, "root").drop("root")
    out = s.select("doc_id", "cls", "n").join(classes, "cls", "left")
    plain = F.col("n") == 0
    return out.select(
        "doc_id",
        F.when(plain, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(plain, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(plain, F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """docs with one row of each class: that of least doc_id, one of them where its row is repeated. Rows without words and rows
    whose class has a null id are classes of their own and stay, equal ones once. Columns may have any names."""
    # the texts are moved once, into buckets by id, and read from there for the candidates and for what stays
    spark = docs.sparkSession
    id_hash, own_text, kept_id, many = fresh(docs, "id_hash", "own_text", "kept_id", "many")
    dealt = docs.withColumn(id_hash, F.xxhash64(f"`{doc_id}`")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), id_hash)
    with bucketed(dealt, "jaccard_docs", id_hash) as own:
        c = near_duplicates(own, text, doc_id, id_hash=id_hash, **settings).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy(F.xxhash64("doc_id").alias(kept_id)).agg(F.count("*").alias(many))
        c = saved(c, "jaccard-kept")
        out = own.join(c.select(kept_id), F.col(id_hash) == F.col(kept_id), "left_semi")
        # only ids that stand on several rows of one class need the text moved once more
        if c.filter(F.col(many) > 1).limit(1).count():
            out = out.withColumn(own_text, F.xxhash64(f"`{text}`")).dropDuplicates([id_hash, own_text])
        out = saved(out.select(*[F.col(f"`{x}`") for x in docs.columns]), "jaccard-one")
    discard(c)
    return out
