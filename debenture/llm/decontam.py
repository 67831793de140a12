"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows of template words are
hash-joined, and the values that an alignment puts into the slots must be consistent.

An item leaks into a document if enough of the item's windows are found in it, in alignments that together map each value of the
item's slots to one value. So a question asked again with other numbers and names is found as well; `n_changed` tells how many slots
differ.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, fresh, mix, saved, signed, slices, utf8

WINDOW, THRESHOLD = 5, 0.8
#: Windows with fewer plain words than this say too little.
PLAIN = 2
#: The benchmark's windows go to the tasks as a filter only if they are at most so many (8 bytes each).
FILTER_WINDOWS = 2_000_000

NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion "
    "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig hundert tausend millionen milliarden "
    "deux trois quatre cinq six sept huit neuf dix onze douze vingt trente quarante cinquante cent mille millions milliards "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce veinte treinta cuarenta cincuenta cien mil millón millones"
).split()
UNITS = (
    "% percent mm cm m km inch inches foot feet yard yards mile miles mg g kg t gram grams kilogram kilograms ounce ounces pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars cent cents euro euros c f degree degrees kb mb gb tb v w kw a hz kph mph "
    "prozent meter gramm kilogramm tonnen sekunden minuten stunde stunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren grad "
    "mètre mètres gramme grammes kilogramme kilogrammes tonne tonnes seconde secondes heure heures jour jours semaine semaines mois an ans année années degré degrés "
    "metro metros gramo gramos kilogramo kilogramos litro litros segundo segundos minuto minutos hora horas día días semana semanas mes meses año años grado grados dólar dólares"
).split()
#: Behind these, adjectives between or not, German has its nouns, which begin with a capital and aren't names.
DETERMINERS = (
    "der die das den dem des ein eine einen einem einer eines kein keine keinen keinem keiner keines mein meine meinen meinem meiner meines "
    "dein deine deinen deinem deiner sein seine seinen seinem seiner seines ihr ihre ihren ihrem ihrer ihres unser unsere unseren unserem unserer "
    "diese dieser dieses diesen diesem jede jeder jedes jeden jedem im zum zur beim vom ins"
).split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STRIP = np.zeros(256, bool)
_STRIP[[ord(c) for c in "!\"'()*,-.:;<>?[]_`{|}~"]] = True
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
#: Hashes that stand for the placeholders.
NUM, UNIT, NAME = (np.uint64(x) for x in (0x1111111111111111, 0x2222222222222222, 0x3333333333333333))


def _hashes(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(words))
    return np.unique(Words(data, offsets).hash())


_UNITS, _NUMBERS, _DETERMINERS = _hashes(UNITS), _hashes(NUMBER_WORDS), _hashes(DETERMINERS)


def _nouns(big: np.ndarray, first: np.ndarray, small: np.ndarray, determiner: np.ndarray) -> np.ndarray:
    """Capitals in a sentence behind a determiner, with two small words between at most."""
    out, behind = np.zeros(len(big), bool), determiner
    for _ in range(3):
        behind = np.concatenate([[False], behind[:-1]]) & ~first
        out |= behind
        behind &= small
    return out & big


def template(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(template hash, value hash, plain, opening) of each word. Opening: a plain word with a capital that begins a sentence,
    which may be a name as well."""
    data = _LOWER[w.data]
    # capitals of two bytes: U+00C0 to U+00DE
    at = np.flatnonzero(w.data[:-1] == 0xC3) if len(w.data) else np.zeros(0, int)
    at = at[(w.data[at + 1] >= 0x80) & (w.data[at + 1] <= 0x9E) & (w.data[at + 1] != 0x97)]
    big = np.zeros(len(data) + 1, bool)
    big[:-1] = (w.data >= 65) & (w.data <= 90)
    big[at] = True
    data[at + 1] += 0x20
    start, end = w.start.copy(), w.end.copy()
    for _ in range(8):
        i = np.flatnonzero(end - start > 1)
        lead = i[_STRIP[data[start[i]]]]
        start[lead] += 1
        j = np.flatnonzero(end - start > 1)
        trail = j[_STRIP[data[end[j] - 1]]]
        end[trail] -= 1
        if not len(lead) and not len(trail):
            break
    h = w.hash(data, start, end)
    sums = lambda x: np.concatenate([[0], np.cumsum(x[w.data])])
    digits, letters = sums(_DIGIT), sums(_LETTER)
    n = len(h)
    # a sentence begins with the text, behind a line break and behind a stop
    first = np.zeros(n, bool)
    if n:
        first[w.first[:-1][np.diff(w.first) > 0]] = True
        breaks = np.concatenate([[0], np.cumsum(w.data == 10)])
        first[1:] |= (breaks[w.start[1:]] > breaks[w.end[:-1] - 1]) | _STOP[w.data[w.end[:-1] - 1]]
    many = digits[end] - digits[start]
    number = (many > 0) & (((letters[end] - letters[start]) == 0) | (_DIGIT[data[start]] == 1)) if n else np.zeros(0, bool)
    number |= np.isin(h, _NUMBERS)
    unit = np.isin(h, _UNITS) & ~number
    if n:
        unit[1:] &= number[:-1]
        unit[0] = False
    capital = big[start] & ~number & ~unit
    small = ~big[start] & ~number & (letters[end] > letters[start])
    name = capital & ~first & ~_nouns(capital, first, small, np.isin(h, _DETERMINERS))
    t = np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, h)))
    return t, h, ~(number | unit | name), capital & first


def _windows(w: Words, every: bool, k: int = WINDOW, whole: bool = False):
    """(place of the first word, row, hash, hash with openings as plain words, places read as slots) of windows of k words with
    enough plain words; `whole`: only of rows of just k words. A window with openings is there once more with all of them as
    names, with `every` once for each choice of them: so any reading of the one side meets one of the other's."""
    t, value, plain, opening = template(w)
    n = len(t)
    if n < k:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, k), bool), value
    factor = np.array([pow(0x9E3779B97F4A7C15, k - 1 - j, 1 << 64) for j in range(k)], np.uint64)
    roll = np.full(n - k + 1, WINDOW - k, np.uint64)
    for j in range(k):
        roll += t[j : n - k + 1 + j] * factor[j]
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    told = np.concatenate([[0], np.cumsum(plain)])
    good = (row[: n - k + 1] == row[k - 1 :]) & (told[k:] - told[:-k] >= PLAIN)
    if whole:
        good &= np.diff(w.first)[row[: n - k + 1]] == k
    at = np.flatnonzero(good)
    words = at[:, None] + np.arange(k)
    slot = ~plain[words]
    out = [(at, mix(roll[at]), mix(roll[at]), slot)]
    opens = opening[words]
    shift = (NAME - t) * opening
    choices = [np.array([m >> j & 1 for j in range(k)], bool) for m in range(1, 1 << k)] if every else [np.ones(k, bool)]
    for choice in choices:
        read = opens & choice
        some = np.flatnonzero((read.sum(1) == choice.sum() if every else read.any(1)) & ((~slot & ~read).sum(1) >= PLAIN))
        if len(some):
            h = roll[at[some]] + (shift[words[some]] * read[some] * factor).sum(1, dtype=np.uint64)
            out.append((at[some], mix(h), mix(roll[at[some]]), slot[some] | read[some]))
    at, h, own, slot = (np.concatenate(x) for x in zip(*out, strict=True))
    return at, row[at], h, own, slot, value


def windows(rows: DataFrame, key: str, text: str, only: np.ndarray | None = None, sizes: tuple[int, ...] | None = None) -> DataFrame:
    """(key, row_at, place, window, own, slots, size): slots has the value hash of each placeholder in the window and 0 for plain
    words; own is the window's hash with sentence-first words plain, the same for all its readings. `only`: sorted window
    hashes; others are left out. sizes: the windows of so many words, of documents; None: of items, that is WINDOW words or, of
    shorter ones, all, in all readings, not only the two with all sentence-first words plain or names."""
    bits = None
    if only is not None:
        bits = np.zeros(1 << 20, bool)
        bits[(only >> np.uint64(44)).astype(np.int64)] = True
    kept = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{key}`", f"`{text}`").alias("row_at"))

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for k in sizes or range(PLAIN, WINDOW + 1):
                    at, row, h, own, slot, value = _windows(w, sizes is None, k, sizes is None and k < WINDOW)
                    if only is not None and len(h):
                        hit = np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)])
                        near = np.minimum(np.searchsorted(only, h[hit]), max(0, len(only) - 1))
                        hit = hit[only[near] == h[hit]] if len(only) else hit[:0]
                        at, row, h, own, slot = at[hit], row[hit], h[hit], own[hit], slot[hit]
                    if not len(at):
                        continue
                    slots = np.where(slot, value[at[:, None] + np.arange(k)], np.uint64(0))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, slots.size + 1, k, dtype=np.int32)), pa.array(signed(np.ascontiguousarray(slots).reshape(-1))))
                    take = pa.array(row + a)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array(at - w.first[row]), pa.array(signed(h)), pa.array(signed(own)), lists, pa.array(np.full(len(at), k, np.int32))], names=["key", "row_at", "place", "window", "own", "slots", "size"])

    return kept.mapInArrow(run, f"key {kept.schema[0].dataType.simpleString()}, row_at long, place long, window long, own long, slots array<long>, size int")


def most_told(pairs: str, every: Column) -> Column:
    """Of the distinct pairs (item_slots, slots) those whose value is told most often for its slot, by `every`; the least of equals."""
    often = lambda p: F.size(F.filter(every, lambda x: x == p))
    beats = lambda q, p: (q["item_slots"] == p["item_slots"]) & (q["slots"] != p["slots"]) & ((often(q) > often(p)) | ((often(q) == often(p)) & (q["slots"] < p["slots"])))
    chosen = F.filter(pairs, lambda p: ~F.exists(pairs, lambda q: beats(q, p)))
    return F.when(F.size(pairs) == F.size(F.array_distinct(F.col(pairs)["item_slots"])), F.col(pairs)).otherwise(chosen)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row_at, item_id, n_windows, n_found, coverage, n_slots, n_changed), a row per row of docs and item that leaks into it.

    An item's windows are its distinct windows of five template words of which two are plain; a shorter item is one window. Items
    of null, empty or blank text, of one word, or with fewer plain words, have none and don't take part, nor do such documents. A
    capital at the begin of a sentence is read as a name and as a plain word; a window is found if one reading is; one behind a German
    determiner is a plain word. The alignment
    (document place minus item place) with the most windows sets the value of each slot that it has, the one that most of its
    windows give it (the least of equals); of the other alignments those windows count that agree, and set the slots that are
    left in the same way. So each slot value of the item has one value in all. Repeated rows are rows of their own with
    one result, equal items are each told. Empty tables give no rows; other columns don't matter. Null ids are kept as null."""
    names = {"key": "item_id", "row_at": "item_at", "place": "item_place", "slots": "item_slots"}
    item = saved(windows(benchmark.dropDuplicates([item_id, item_text]), item_id, item_text).withColumnsRenamed(names), "decontam-items")
    sizes = tuple(sorted(r[0] for r in item.select("size").distinct().collect()))
    count = item.select("window").distinct().count()
    only = None
    if count <= FILTER_WINDOWS:
        only = np.sort(np.array([r[0] for r in item.select("window").distinct().collect()], np.int64).view(np.uint64))
    hits = saved(windows(docs, doc_id, text, only, sizes or (WINDOW,)).drop("own", "size"), "decontam-hits")
    total = item.groupBy("item_id", "item_at").agg(F.countDistinct("own").alias("n_windows"))
    both = hits.join(item, "window").withColumn("diagonal", F.col("place") - F.col("item_place"))
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda x: x["item_slots"] != 0)
    way = ["key", "row_at", "item_id", "item_at"]
    # an alignment has as many windows as its item, so its sets are as small
    lines = both.withColumn("pairs", pairs).groupBy(*way, "diagonal").agg(F.collect_set(F.struct("own", "pairs")).alias("told"))
    lines = lines.withColumn("all", F.flatten("told.pairs")).withColumn("pairs", F.array_distinct("all"))
    lines = lines.withColumn("pairs", most_told("pairs", F.col("all")))
    agrees = lambda x, mapping: F.forall(x["pairs"], lambda p: F.array_contains(mapping, p))
    lines = lines.withColumn("n", F.size(F.array_distinct(F.transform(F.filter("told", lambda x: agrees(x, F.col("pairs"))), lambda x: x["own"]))))
    found = lines.groupBy(*way).agg(F.max(F.struct("n", "diagonal", "pairs"))["pairs"].alias("base"), F.array_distinct(F.flatten(F.collect_list("told"))).alias("told"))
    clash = lambda p: F.exists("base", lambda b: (b["item_slots"] == p["item_slots"]) & (b["slots"] != p["slots"]))
    found = found.withColumn("told", F.filter("told", lambda x: ~F.exists(x["pairs"], clash)))
    found = found.withColumn("all", F.array_except(F.flatten("told.pairs"), "base")).withColumn("more", F.array_distinct("all"))
    found = found.withColumn("pairs", F.array_distinct(F.concat("base", most_told("more", F.flatten("told.pairs")))))
    found = found.withColumn("n_found", F.size(F.array_distinct(F.transform(F.filter("told", lambda x: agrees(x, F.col("pairs"))), lambda x: x["own"]))))
    out = found.join(total, (found["item_id"].eqNullSafe(total["item_id"])) & (found["item_at"] == total["item_at"]))
    changed = F.size(F.filter("pairs", lambda x: x["item_slots"] != x["slots"]))
    out = out.select(F.col("key").alias("doc_id"), "row_at", found["item_id"], F.col("n_windows").cast("long"), F.col("n_found").cast("long"), (F.col("n_found") / F.col("n_windows")).alias("coverage"), F.size("pairs").cast("long").alias("n_slots"), changed.cast("long").alias("n_changed"))
    return out.filter(F.col("coverage") >= threshold)


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """docs without the rows that hold a leak. Rows of null or empty text stay, equal rows go or stay together; columns may have any
    names."""
    (at,) = fresh(docs, "row_at")
    bad = leaks(docs, benchmark, doc_id=doc_id, text=text, **settings).select(F.col("row_at").alias(at)).distinct()
    return docs.withColumn(at, F.xxhash64(f"`{doc_id}`", f"`{text}`")).join(bad, at, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
