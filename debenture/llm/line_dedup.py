"""Near-duplicate lines by a segment-partition edit join. DataFrame functions only.

How many edits two lines may be apart grows with the shorter one's length. Distinct lines of a range of lengths have that many
segments of one length and one more, the first half of them counted from the line's begin, the others from its end; two lines within so
many edits share one of them, at a place that the segment's number narrows down, whatever their lengths. So each line looks up
substrings of itself among the segments of lines of its range, or of the next lesser one where that is within reach. Lines that meet others are compared by their character counts and by a bound from their ends, which rules most of them out, and the rest are verified by edit
distance, bit-parallel in a band of 2 * edits + 1 diagonals over what is left between their common prefix and suffix. Linked
lines are clustered by components; of each cluster the first line in the corpus stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucketed, components, discard, fresh, saved

#: (characters, edits): lines of so many characters or more may be so many edits apart, counted by the shorter line. One edit in
#: fewer than eight characters joins what says different things; such lines are duplicates of equal ones only.
EDITS = ((8, 1), (20, 2), (60, 3), (120, 4))
#: Lines with one segment in common that one task compares another line with at most; more are dealt out over several.
HOT = 256

Steps = tuple[tuple[int, int], ...]


def edits_of(n: int, steps: Steps = EDITS) -> int:
    return max([e for least, e in steps if n >= least], default=0)


def allowed(n: Column, steps: Steps = EDITS) -> Column:
    """edits_of as a column."""
    return reduce(lambda acc, x: F.when(n >= x[0], x[1]).otherwise(acc), sorted(steps), F.lit(0))


def lookups(edits: int) -> list[tuple[int, int, int, int]]:
    """(segment, ends, along, shift) of the substrings that a line looks up. Of two lines within so many edits, one segment of the shorter is
    untouched and has exactly as many edits before it as its number, so at most the rest behind it: the first half is looked for
    that far from its place counted from the begin, the second from its place counted from the end (ends: 1). along: segments from there."""
    out = []
    for i in range(edits + 1):
        behind = edits - i
        ends, along = (0, i) if i <= behind else (1, -behind - 1)
        out += [(i, ends, along, shift) for shift in range(-min(i, behind), min(i, behind) + 1)]
    return out


def least_of(n: Column, steps: Steps = EDITS) -> Column:
    """The least length of the range that lines of n characters belong to: ranges are 4 times the edits wide and end where the edits change."""
    return reduce(lambda acc, x: F.when(n >= x[0], n - (n - x[0]) % (4 * x[1])).otherwise(acc), sorted(steps), F.lit(0))


def keyed(lines: DataFrame, probe: bool, steps: Steps = EDITS) -> DataFrame:
    """(key, id, kind) of lines(id, line, n): the keys under which a line can be found, or those that it looks up: in its own range of
    lengths, and in a lesser one whose longest lines are within their edits of it. kind: 4 times the segment's number, 2 where it is
    looked for at its own place, and 1 where the line itself can be found under the key."""
    n, m, most = F.col("n"), F.col("m"), max(e for _, e in steps)
    # four bytes a character, so that a substring needn't count characters from the line's begin
    d = lines.filter(n >= min(least for least, _ in steps)).select("id", "n", F.encode("line", "UTF-32").alias("wide"))
    if probe:
        # a range is met at the greatest length of it
        ranges = F.when(n - least_of(n, steps) >= most, F.array(n)).otherwise(F.array(*[n - less for less in range(most + 1)]))
        d = d.select("*", F.explode(ranges).alias("m")).filter((m == n) | ((n - m <= allowed(m, steps)) & (least_of(m, steps) != least_of(m + 1, steps))))
    else:
        d = d.withColumn("m", n)
    entry = lambda x: F.struct(*[F.lit(v).alias(c) for c, v in zip(("i", "ends", "along", "shift"), x, strict=True)])
    every = F.array().cast("array<struct<i: int, ends: int, along: int, shift: int>>")
    for least, e in sorted(steps):
        every = F.when(m >= least, F.array(*[entry(x) for x in lookups(e) if probe or x[3] == 0])).otherwise(every)
    d = d.select("id", "n", "m", "wide", least_of(m, steps).alias("least"), allowed(m, steps).alias("edits"), F.explode(every).alias("e"))
    d = d.select("id", "n", "m", "wide", "least", F.expr("int(least div (edits + 1))").alias("size"), "e.*")
    d = d.withColumn("at", F.expr("ends * n + along * size + 1 + shift")).filter("at >= 1 and at + size - 1 <= n")
    return d.select(F.xxhash64("least", "i", F.expr("substring(wide, 4 * at - 3, 4 * size)")).alias("key"), "id", F.expr("i * 4 + int(shift = 0) * 2 + int(shift = 0 and m = n)").alias("kind"))


#: Frequent characters that are counted in lines that meet.
LETTERS = "etaoinshrdlcumwfgypbvkz ,.EIAT"


def letter_counts(line: Column) -> Column:
    """How often the line holds each of LETTERS. An edit changes two of the numbers at most, by one."""
    return F.array(*[F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))) for c in LETTERS])


def odd_bits(counts: Column) -> Column:
    """A bit for each of the counts that is odd: lines within k edits differ in 2 k of them at most."""
    return F.aggregate(counts, F.lit(0), lambda acc, x: acc * 2 + x % 2)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def common_prefix(a: Column, b: Column) -> Column:
    """Its length: by halving steps from 2^20, each a comparison of the next stretch of both."""
    steps = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])

    def prefix(s: Column) -> Column:
        fits = lambda n, x: (n + x <= s["most"]) & (F.substring(s["a"], n + 1, x) == F.substring(s["b"], n + 1, x))
        return F.aggregate(steps, F.lit(0), lambda n, x: F.when(fits(n, x), n + x).otherwise(n))

    return _let(F.struct(a.alias("a"), b.alias("b"), F.least(F.length(a), F.length(b)).alias("most")), prefix)


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of a and b if it is `edits` at most, else more than that. One long holds a column of the band: bit k is
    row j - edits + k; the vertical differences move down one row with each character of b."""
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")

    # what a lambda uses again and again is bound by _let, as it would be worked out each time
    def distance(given: Column) -> Column:
        x, y, m, n = (given[c] for c in "xymn")

        def step(s: Column, j: Column) -> Column:
            def with_character(c: Column) -> Column:
                match = F.lit(0).cast("long")
                for k in range(width):
                    at = j - edits + k
                    match = match.bitwiseOR(F.when((at >= 0) & (at < m) & (F.get(x, at) == c), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
                return match

            def with_match(pm: Column) -> Column:
                vp, vn = s["vp"], s["vn"]
                diagonal = ((pm.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(F.lit(full))

                def with_diagonal(d: Column) -> Column:
                    hp = vn.bitwiseOR(d.bitwiseOR(vp).bitwiseXOR(F.lit(full)))
                    hn = d.bitwiseAND(vp)
                    down = F.shiftright(d, 1)
                    in_body = j < m - edits
                    change = F.when(in_body, one(d.bitwiseAND(F.lit(top)) == 0)).otherwise(one(hp.bitwiseAND(s["last"]) != 0) - one(hn.bitwiseAND(s["last"]) != 0))
                    return F.struct(
                        hn.bitwiseOR(down.bitwiseOR(hp).bitwiseXOR(F.lit(full))).bitwiseAND(F.lit(full)).alias("vp"),
                        down.bitwiseAND(hp).alias("vn"),
                        (s["d"] + change).alias("d"),
                        F.when(in_body, s["last"]).otherwise(F.shiftright(s["last"], 1)).alias("last"),
                    )

                return _let(diagonal, with_diagonal)

            return _let(_let(F.get(y, j), with_character), with_match)

        begin = F.struct(
            F.lit(full ^ ((1 << edits) - 1)).cast("long").alias("vp"),
            F.lit(0).cast("long").alias("vn"),
            # the first row that is followed is row min(edits, m)
            F.least(m, F.lit(edits)).cast("long").alias("d"),
            F.when(m >= edits, F.lit(top >> 1)).otherwise(F.element_at(F.array(*[F.lit(max(1, top >> 1 >> (edits - r))) for r in range(edits + 1)]), (F.least(m, F.lit(edits)) + 1).cast("int"))).cast("long").alias("last"),
        )
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.when(F.abs(m - n) > edits, F.lit(edits + 1)).when((m == 0) | (n == 0), F.greatest(m, n)).otherwise(F.aggregate(places, begin, step, lambda s: s["d"])).cast("long")

    return _let(F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"), F.length(a).alias("m"), F.length(b).alias("n")), distance)


def line_distance(a: Column, b: Column, edits: int, most: Column | None = None) -> Column:
    """banded_distance without the common prefix and suffix; more than `edits` at once where a bound says that it is over `most`."""
    cut = lambda x, q: F.substring(x, F.lit(1), F.length(x) - q)

    def behind(s: Column) -> Column:
        return _let(F.struct(F.substring(s["a"], s["p"] + 1, F.length(s["a"])).alias("u"), F.substring(s["b"], s["p"] + 1, F.length(s["b"])).alias("v"), s["most"].alias("most")), before)

    def before(t: Column) -> Column:
        return _let(common_prefix(F.reverse(t["u"]), F.reverse(t["v"])), lambda q: _let(F.struct(cut(t["u"], q).alias("u"), cut(t["v"], q).alias("v"), t["most"].alias("most")), rest))

    def rest(t: Column) -> Column:
        return F.when(at_least(t["u"], t["v"]) > t["most"], F.lit(edits + 1).cast("long")).otherwise(banded_distance(t["u"], t["v"], edits))

    return _let(F.struct(a.alias("a"), b.alias("b"), common_prefix(a, b).alias("p"), (F.lit(edits) if most is None else most).alias("most")), behind)


def at_least(u: Column, v: Column, ends: int = 40) -> Column:
    """A lower bound of the edit distance: where an alignment has e edits in the first characters of u, as many characters of v are
    within 2 e edits of them; the same holds for the last ones, and both count where they don't overlap."""
    far = 16
    half = lambda x, y: _let(F.levenshtein(x, y, far), lambda d: F.ceil(F.when(d < 0, far + 1).otherwise(d) / 2))
    first, last = half(F.left(u, F.lit(ends)), F.left(v, F.lit(ends))), half(F.right(u, F.lit(ends)), F.right(v, F.lit(ends)))
    return F.when((F.length(u) >= 2 * ends) & (F.length(v) >= 2 * ends), first + last).otherwise(F.greatest(first, last))


def lines_of(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, row_at, n, line): lines with a word; n counts from 0 over all lines."""
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(f"`{doc_id}`", f"`{text}`").alias("row_at"), F.posexplode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("n", "line"))
    return d.filter(F.regexp_like("line", F.lit(r"[^\x20\x09-\x0D]")))


def near_lines(distinct: DataFrame, steps: Steps = EDITS) -> DataFrame:
    """(a, b, edits) of distinct(id, line): pairs of lines within the edits that their lengths allow, a < b."""
    lines = distinct.select("id", "line", F.length("line").alias("n"))
    index = keyed(lines, False, steps).groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("many"))
    # a row per line and key that another line has as well; the index has each key once, so its side fits a hash table
    met = keyed(lines, True, steps).join(index.hint("shuffle_hash"), "key").filter("not (low = id and high = id)")
    met = saved(met.select("key", "id", "kind", "low", "many"), "lines-met")
    ids = met.select("id").unionByName(met.filter("many = 1").select(F.col("low").alias("id"))).distinct()
    # the few ids are the hash table, so that the distinct lines needn't be sorted
    texts = distinct.join(ids.hint("shuffle_hash"), "id", "left_semi").withColumns({"n": F.length("line"), "counts": letter_counts(F.col("line"))})
    texts = saved(texts.withColumns({"odd": odd_bits(F.col("counts")), "most": allowed(F.col("n"), steps)}), "lines-texts")
    facts = ("id", "line", "n", "counts", "odd", "most")
    one = texts.select(*facts)
    two = texts.select(*[F.col(c).alias(f"{c}2") for c in facts])
    most = F.least("most", "most2")
    apart = reduce(lambda x, y: x + y, [F.abs(F.get("counts", F.lit(i)) - F.get("counts2", F.lit(i))) for i in range(len(LETTERS))])
    distance = line_distance(F.col("line"), F.col("line2"), max(e for _, e in steps), most)
    may = (F.col("id") != F.col("id2")) & (F.abs(F.col("n") - F.col("n2")) <= most) & (F.bit_count(F.col("odd").bitwiseXOR(F.col("odd2"))) <= 2 * most) & (apart <= 2 * most)
    ends = [F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")]
    alone = met.filter("many = 1").select("id", F.col("low").alias("id2")).distinct().join(one.drop("line"), "id").join(two.drop("line2"), "id2").filter(may)
    # lines that share a segment with many: those that can be found are dealt out, those that look for them go to all, and what
    # comes out of the join are links, not pairs that met
    many = met.filter("many > 1").withColumn("deals", F.ceil(F.col("many") / HOT).cast("int")).join(one, "id")
    held = many.filter("kind % 2 = 1").select(F.col("key").alias("key2"), F.pmod(F.xxhash64("id"), F.col("deals")).cast("int").alias("deal2"), *[F.col(c).alias(f"{c}2") for c in facts])
    looking = many.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).select("key", "deal", "kind", *facts)
    linked = looking.join(held, (F.col("key") == F.col("key2")) & (F.col("deal") == F.col("deal2")) & may & _first_meeting(steps) & (distance <= most))
    pairs = saved(alone.select(*ends).unionByName(linked.select(*ends)).distinct(), "lines-pairs")
    side = lambda name, line, most: texts.select(F.col("id").alias(name), F.col("line").alias(line), F.col("most").alias(most))
    both = pairs.join(side("a", "line", "most"), "a").join(side("b", "line2", "most2"), "b")
    near = both.select("a", "b", distance.alias("edits"), most.alias("most"))
    near = saved(near.filter("edits <= most").select("a", "b", "edits"), "lines-near")
    discard(met, texts, pairs)
    return near


def _first_meeting(steps: Steps) -> Column:
    """Whether a line and another, line2, that it has looked up by kind aren't compared under another key anyway: two lines found
    under a key of both are compared by the one of lesser id, and lines that have a segment at its own place meet there, at the first of
    them."""
    kind, edits = F.col("kind"), F.col("most2")
    size = (least_of(F.col("n2"), steps) / (edits + 1)).cast("int")
    again = (kind % 2 == 1) & (F.col("id") > F.col("id2"))
    for j in range(max(e for _, e in steps) + 1):
        place = lambda n: F.when(F.lit(2 * j) <= edits, size * j).otherwise(n - size * (edits - j + 1)) + 1  # noqa: E731, B023
        earlier = (F.lit(j) <= edits) & ((kind % 4 < 2) | (F.lit(4 * j) < kind - kind % 4))
        again |= earlier & (F.substring("line", place(F.col("n")), size) == F.substring("line2", place(F.col("n2")), size))
    return ~again


def line_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", steps: Steps = EDITS) -> DataFrame:
    """(doc_id, row_at, n, cls, n_links, exact, kept), a row per line with a word: cls is its cluster of equal and near lines,
    n_links the number of other texts within the edits, `exact` says that an equal line stands earlier in the corpus (least
    doc_id, row, n), `kept` that none of its cluster does.

    Null and empty texts and blank lines give no rows. Lines of fewer characters than the first step are near only to equal ones. Repeated rows count
    as rows of their own, in no fixed order. Null doc_ids come first. Lines are hashed to 64 bits. Other columns don't matter."""
    lines = lines_of(docs, text, doc_id).withColumn("id", F.xxhash64("line"))
    # in buckets by id, so that the texts of the few lines that meet others are found without moving all of them once more
    with bucketed(lines.groupBy("id").agg(F.first("line").alias("line")), "lines_distinct", "id") as distinct:
        near = near_lines(distinct, steps)
    roots = components(near.select("a", "b"), "lines-classes")
    links = near.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    roots = saved(roots.join(links, "node"), "lines-roots")
    at = lines.select("doc_id", "row_at", "n", "id")
    at = at.join(roots, at["id"] == roots["node"], "left").select("doc_id", "row_at", "n", "id", F.coalesce("root", "id").alias("cls"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    at = saved(at, "lines-at")
    discard(near, roots)
    place = F.struct("doc_id", "row_at", "n")
    own = at.groupBy("id").agg(F.min(place).alias("own"), F.count("*").alias("many"), F.first("cls").alias("c"), F.first("n_links").alias("near"))
    # most lines are there once and near to none: these are neither exact nor gone
    own = saved(own.filter("many > 1 or near > 0"), "lines-own")
    heads = own.filter("near > 0").groupBy("c").agg(F.min("own").alias("head"))
    facts = own.filter("near > 0").join(heads, "c").select(F.col("id").alias("i"), "own", "head")
    facts = facts.unionByName(own.filter("near = 0").select(F.col("id").alias("i"), "own", F.col("own").alias("head")))
    out = at.join(facts, at["id"] == facts["i"], "left")
    first = F.coalesce(place == F.col("head"), F.lit(True))
    return out.select("doc_id", "row_at", "n", "cls", "n_links", F.coalesce(place != F.col("own"), F.lit(False)).alias("exact"), first.alias("kept"))


def per_document(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """(doc_id, row_at, n_lines, n_exact, n_near, n_links, dropped), a row per row of docs that has a line: dropped lists the
    numbers of the lines that go, exact or near."""
    c = line_classes(docs, text, doc_id, **settings)
    return c.groupBy("doc_id", "row_at").agg(
        F.count("*").alias("n_lines"),
        F.count_if("exact").alias("n_exact"),
        F.count_if(~F.col("kept") & ~F.col("exact")).alias("n_near"),
        F.sum("n_links").alias("n_links"),
        F.sort_array(F.collect_list(F.when(~F.col("kept"), F.col("n")))).alias("dropped"),
    )


def without_duplicate_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """docs whose text has lost the lines that `per_document` drops; what has none stays as it is: null, empty and blank texts
    too. Rows of equal id and text are given the same lines to lose. Columns may have any names."""
    at, row, lost = fresh(docs, "at", "row", "lost")
    gone = per_document(docs, text, doc_id, **settings).filter(F.size("dropped") > 0).select(F.col("row_at").alias(at), F.col("dropped").alias(lost)).dropDuplicates([at])
    out = docs.withColumn(row, F.xxhash64(f"`{doc_id}`", f"`{text}`")).join(gone, F.col(row) == F.col(at), "left")
    rest = F.filter(F.transform(F.split(F.col(f"`{text}`"), "\n", -1), lambda x, i: F.when(~F.array_contains(lost, i), x)), lambda x: x.isNotNull())
    return out.withColumn(text, F.when(F.col(lost).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(rest, "\n"))).select(*[F.col(f"`{c}`") for c in docs.columns])
