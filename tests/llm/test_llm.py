"""Training-data operators against brute force on small tables, with nulls, empty and repeated rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from debenture.llm import chat, common, decontam, encoder, jaccard, line_dedup, mixing, quality, sharding, substring, token_counts, token_store

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
#: Column names that the operators use within.
CLASH = ["cls", "id_hash", "__id_hash", "own_text", "kept_id", "at", "row_at", "__at", "p", "steps", "part", "key", "draw", "n", "node", "root", "place", "slot_", "__mix_row", "row", "lost", "way"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [rng.choice("abcdefghijk") + rng.choice("lmnopq") + str(rng.randint(0, 400)) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        w = words(rng, rng.choice([0, 3, 40, 120, 400]))
        rows.append((i, " ".join(w), "en", f"s{i % 4}"))
    for i in range(60, 80):  # copies and near copies
        w = rows[rng.choice([k for k in range(60) if len(rows[k][1]) > 400])][1].split(" ")
        for _ in range(rng.choice([0, 0, 1, 3, 9])):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), "fr", None))
    passage = " ".join(words(rng, 60))
    for i in range(80, 84):
        rows.append((i, " ".join(words(rng, 30)) + " " + passage + "\n" + " ".join(words(rng, 25)), "en", "s1"))
    rows += [(84, None, None, "s2"), (85, "", "en", "s2"), (86, " \n\t ", "en", "s0"), (87, "aa bb", "en", "s0"), (88, "aa  bb", "en", "s0"), (None, "kk ll mm", None, None), (7, rows[7][1], "en", "s3"), (7, rows[7][1], "en", "s3")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)


def collected(docs):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]


def shingle_set(t):
    w = SPACE.findall(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), []).append(n)
    return out.values()


# --- chats ----------------------------------------------------------------------------------------------------------


def test_chats_come_back(spark):
    hard = ["", "hi", "</s>[INST] ok [/INST]", "<\\|im_start|>", "<\\\\|im_end|>\n", "a\\n\\\\b", "<<SYS>>x<</SYS>><s>", "<|im_start|>user\nx<|im_end|>\n</s>", "é\U0001f600", None]
    rng, rows = random.Random(1), []
    for c in range(40):
        rows += [(c, t if rng.random() > 0.1 else None, rng.choice(["user", "assistant", "a\nb\\", "<|im_start|>", None]), rng.choice(hard)) for t in range(rng.randint(1, 5))]
    rows += [(None, 1, "user", "x"), (50, 1, "assistant", "y"), (50, 1, "assistant", "y")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(d.withColumn("formatted", F.lit("clash")))
    got = out.select("conv_id", "n_turns", "verified", "formatted", chat.parse(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["t"]] for r in got} == want and all(r["verified"] for r in got)
    assert {r["conv_id"]: r["loss"] for r in got} == {c: "".join(x for r, x in t if r == "assistant") for c, t in want.items()}
    assert chat.format_chats(d.limit(0)).count() == 0


# --- near duplicates ------------------------------------------------------------------------------------------------


def test_jaccard_join(docs):
    rows = collected(docs)
    by = {}
    for i, t, _ in rows:
        by.setdefault(tuple(SPACE.findall(t)), []).append(i)
    sets = {w: shingle_set(" ".join(w)) for w in by if w}
    keys = [*sets]
    links = [(a, b) for i, a in enumerate(keys) for b in keys[:i] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    small = lambda xs: min([x for x in xs if x is not None], default=None)
    want = []
    for group in components(keys, links):
        class_id = small(x for w in group for x in by[w])
        want += [(i, class_id, small(by[w]), len(by[w]), sum(w in link for link in links)) for w in group for i in by[w]]
    want += [(i, i, i, 1, 0) for i in by.get((), [])]
    got = [tuple(r) for r in jaccard.near_duplicates(docs.withColumns({c: F.lit("clash") for c in CLASH})).collect()]
    assert len(links) > 5 and sorted(got, key=str) == sorted(want, key=str)
    kept = [r["doc_id"] for r in jaccard.one_of_each(docs.withColumns({c: F.lit("clash") for c in CLASH})).collect()]
    assert sorted(kept, key=str) == sorted({w[1] for w in want}, key=str)
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_blocks_of_a_large_group_miss_no_link(docs, monkeypatch):
    one = sorted(map(tuple, jaccard.near_duplicates(docs).collect()), key=str)
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 3)
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect()), key=str) == one


def test_prefixes_are_shortened_until_the_links_are_found(spark):
    rng, texts = random.Random(21), []
    for _ in range(150):
        w = words(rng, 120)
        texts.append(list(w))
        for k in rng.sample(range(len(w)), 2):
            w[k] = words(rng, 1)[0]
        texts.append(w)
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    sets = [shingle_set(" ".join(w)) for w in texts]
    want = sum(len(a & b) / len(a | b) >= 0.8 for a, b in zip(sets[::2], sets[1::2], strict=True))
    found = {t: sum(r["n_links"] for r in jaccard.near_duplicates(d, trees=4, target=t).collect()) // 2 for t in (0.0, 0.95)}
    assert want > 100 and found[0.0] < 0.9 * want and found[0.95] >= 0.93 * want
    assert 1 - (1 - 0.8**substring.ROWS) ** substring.bands_for() >= substring.RECALL


def test_repeats(docs):
    got = {(r["doc_id"], tuple(r["kept_docs"])): r for r in substring.repeats(docs).collect()}
    found = {k[0] for k in got}
    rows = collected(docs)
    runs = {}
    for i, t, _ in rows:
        w = SPACE.findall(t)
        for j in range(len(w) - 49):
            runs.setdefault(tuple(w[j : j + 50]), set()).add(i)
    must = {i for ids in runs.values() if len(ids) > 1 for i in ids}
    short = {}
    for i, t, _ in rows:
        w = SPACE.findall(t)
        for j in range(len(w) - 19):
            short.setdefault(tuple(w[j : j + 20]), set()).add(i)
    may = {i for ids in short.values() if len(ids) > 1 for i in ids}
    assert {80, 81, 82, 83} <= must <= found <= may
    assert got[(80, ())]["n_removed"] == 0 and all(got[(i, (80,))]["removed_words"] >= 30 for i in (81, 82, 83))
    assert substring.repeats(docs.limit(0)).count() == 0


def test_exact_passages_are_found_and_marked_to_their_ends(spark):
    rng, texts, want = random.Random(11), [], {}
    for n in [28, 30, 31, 35, 40, 45, 48, 51, 60, 80, 120] * 3:
        p = words(rng, n)
        for copy in range(2):
            want[len(texts)] = n * copy
            texts.append(" ".join(words(rng, rng.randint(5, 60)) + p + words(rng, rng.randint(5, 60))))
    got = {r["doc_id"]: r for r in substring.repeats(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert {i: r["removed_words"] for i, r in got.items()} == want


def test_short_paragraphs_are_found_whole(spark):
    rng, texts, want = random.Random(12), [], {}
    for n in range(10, 49):
        p = " ".join(words(rng, n))
        for copy in range(2):
            want[len(texts)] = n * copy
            texts.append("\n".join([" ".join(words(rng, 12)), p, " ".join(words(rng, 12))]))
    got = {r["doc_id"]: r for r in substring.repeats(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert {i: r["removed_words"] for i, r in got.items()} == want


def test_near_paragraphs_against_brute_force(spark):
    rng, lines = random.Random(13), []
    for n in [12, 30, 45, 60, 60, 60, 100, 100, 150, 200] * 6:
        w = words(rng, n)
        lines.append(w)
        for _ in range(2):
            x = list(w)
            for _ in range(rng.randint(1, 4)):
                x[rng.choice([0, n // 2, n - 1, rng.randrange(n)])] = words(rng, 1)[0]
            lines.append(x)
    lines = [" ".join(w) for w in lines]
    sets = [shingle_set(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    got = {r["doc_id"]: r["cluster"] for r in substring.near_paragraphs(spark.createDataFrame([*enumerate(lines)], "doc_id long, text string")).collect()}
    together = sum(i in got and got[i] == got.get(j) for i, j in links)
    assert len(links) > 50 and together >= 0.97 * len(links)
    groups = {}
    for i, c in got.items():
        groups.setdefault(c, set()).add(i)
    want = [set(g) for g in components(range(len(lines)), links)]
    assert all(any(g <= x for x in want) for g in groups.values())


# --- leaks ----------------------------------------------------------------------------------------------------------


def test_leaks(spark):
    item = "if Anna buys 3 apples and 5 pears for 20 dollars then how much would Anna pay for 3 apples at the market stall today"
    other = item.replace("Anna", "Boris").replace("3", "17").replace(" 5 ", " 6 ").replace("20", "99")
    broken = item.replace("if Anna", "if Clara").replace("buys 3", "buys 4")  # one slot value, two others
    clean = "the weather of the mountain was as fine as anyone who had been there before could say without looking at a map"
    rows = [(1, f"Before. {item} After that."), (2, f"Also: {other}. More."), (3, clean), (4, None), (5, ""), (6, "too short"), (7, item[: len(item) // 2]), (8, broken)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(10, item), (11, None), (12, "a b")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.leaks(d, b).collect()}
    assert {1, 2} <= set(got) and not set(got) & {3, 4, 5, 6, 7}
    assert got[1]["n_changed"] == 0 and got[2]["n_changed"] > 2 and got[1]["item_id"] == 10
    # its name and one of its numbers have two values: the later ones are in more windows, the four windows of the first ones are lost
    assert (got[8]["n_windows"], got[8]["n_found"]) == (21, 17)
    assert {r["doc_id"] for r in decontam.without_leaks(d, b).collect()} >= {3, 4, 5, 6, 7} and decontam.leaks(d.limit(0), b).count() == 0 == decontam.leaks(d, b.limit(0)).count()


def test_leaks_with_other_names_at_sentence_begins(spark):
    item = "Tom has 5 apples. Tom buys 7 more apples. How many apples does Tom have now?"
    no_middle = "Tom has 5 apples.\nTom buys 7 more pears. Where may all these apples and pears go?"
    texts = [item, item.replace("Tom", "Ann").replace("5", "6").replace("7", "9"), "so Ann has 8 apples. Ann buys 2 more apples. how many apples does Ann have now?", no_middle.replace("Tom", "Ann"), "Tom has 5 apples. He likes his house and his dog more than all the pears that his sister may have now."]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    b = spark.createDataFrame([(10, item), (11, no_middle)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.leaks(d, b).collect()}
    assert set(got) == {(0, 10), (1, 10), (2, 10), (3, 11)} and all(r["coverage"] == 1 for r in got.values())
    assert got[0, 10]["n_changed"] == 0 and got[1, 10]["n_changed"] == 3 and got[3, 11]["n_changed"] == 1


def test_leaks_lose_only_the_windows_that_conflict(spark):
    item = "a farmer keeps 12 hens in a barn and another farmer by the river keeps 12 geese in a pond while their old father has nothing but a small dog and a cat who sleep all day long near the warm stove in his kitchen"
    other = item.replace("12", "15", 1).replace("12 geese", "30 geese")
    got = decontam.leaks(spark.createDataFrame([(1, other)], "doc_id long, text string"), spark.createDataFrame([(10, item)], "item_id long, text string")).collect()
    assert [(r["n_windows"] - r["n_found"], r["n_slots"], r["n_changed"]) for r in got] == [(4, 1, 1)]  # the first 12 is in four windows, the second in five


def test_values_are_consistent_over_all_alignments(spark):
    first = "Anna has 12 red apples and some green pears in her basket"
    second = "then 12 more people from the village ask Anna for a few of them"
    item = f"{first} and {second}"
    texts = [item, f"{first.replace('Anna', 'Boris')} indeed, and {second.replace('Anna', 'Boris')}", f"{first} indeed, and {second.replace('Anna', 'Boris').replace('12', '99')}"]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumns({c: F.lit("clash") for c in [*CLASH, "item_id"]})
    b = spark.createDataFrame([(10, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.leaks(d, b, threshold=0.0).collect()}
    n = got[0]["n_windows"]
    # "indeed," stands between: windows over it are lost, and in the third text those of the first half that name other values
    # than the second, which has more windows
    assert got[0]["n_found"] == n and got[1]["n_found"] < n and got[1]["n_changed"] == 1
    w = first.split()
    slots = sum(any(x in ("12", "Anna") for x in w[i : i + 5]) for i in range(len(w) - 4))
    assert got[1]["n_found"] - got[2]["n_found"] == slots
    assert (n, got[1]["n_found"], got[2]["n_found"]) == (23, 19, 16)
    assert {r["doc_id"] for r in decontam.without_leaks(d, b).collect()} == {2}


def brute_leaks(texts, items):
    """Of texts without sentence begins: every place of every item against every text, word by word."""

    def read(t):
        w = SPACE.findall(t)
        return [("N" if x.isdigit() else "P" if x[0].isupper() else x, x.lower()) for x in w]

    out = {}
    for i, t in enumerate(texts):
        for j, item in enumerate(items):
            a, b = read(item), read(t)
            k = min(5, len(a))
            starts = [s for s in range(len(a) - k + 1) if sum(x[0] not in ("N", "P") for x in a[s : s + k]) >= 2]
            best = 0
            for shift in range(-len(a), len(b)):
                hit = [s for s in starts if 0 <= s + shift <= len(b) - k and all(a[s + n][0] == b[s + shift + n][0] for n in range(k))]
                told = {}
                for s in hit:
                    for n in range(k):
                        if a[s + n][0] in ("N", "P"):
                            told.setdefault(a[s + n][1], []).append(b[s + shift + n][1])
                if all(len(set(v)) == 1 for v in told.values()):
                    best = max(best, len(hit))
            if starts and best / len(starts) >= 0.8:
                out[i, j] = best
    return out


def test_every_item_against_every_text(spark):
    rng, items = random.Random(61), []
    for _ in range(12):
        w = [rng.choice("abcdefgh") + rng.choice("lmno") + rng.choice("aeiou") for _ in range(rng.randint(3, 30))]
        names = rng.sample(["Anna", "Boris", "Clara", "Xaver"], 2)
        items.append(" ".join(rng.choice(names) if n and rng.random() < 0.1 else str(rng.choice([3, 17])) if rng.random() < 0.15 else x for n, x in enumerate(w)))
    items = [x if not x[0].isdigit() else f"so {x}" for x in items]
    texts = []
    for _ in range(60):
        t = rng.choice(items)
        for old, new in (("Anna", "Emil"), ("Boris", "Frida"), ("17", "170"), ("3", "4")):
            if rng.random() < 0.5:
                t = " ".join(new if x == old else x for x in t.split())
        w = t.split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = "other"
        texts.append(" ".join([*words(rng, rng.randint(0, 5)), *w, *words(rng, rng.randint(0, 5))]))
    want = brute_leaks(texts, items)
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    b = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_found"] for r in decontam.leaks(d, b).collect()}
    assert len(want) > 30 and got == want


def test_short_items_are_found_whole(spark):
    items = ["capital of France", "name the largest river", "two words", "one", "12 kg 13 kg"]
    texts = ["He knew the capital of France well.", "name the largest river", "these two words stand here", "one", "the capital of Spain", "12 kg 13 kg", None, ""]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    b = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(d, b).collect()} == {(0, 0), (1, 1), (4, 0)}


# --- tokens ---------------------------------------------------------------------------------------------------------

ODD = ["", "a  b\n\n c\t d <|endoftext|> x", " lead", "trail ", "x\xa0y z", "it's 5kg's, don't... ((x)) é²½ a1b2,,\n\n z's", "\n\n\n a", "  ", "é é 日本 語", "“q” — x", "a\x1cb c", "o.k., end."]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoder.default_vocabulary())


def test_store(spark, docs, tokenizer):
    d = docs.unionByName(spark.createDataFrame([(1000 + i, t, "en", "s", 0) for i, t in enumerate(ODD)], SCHEMA))
    rows = sorted(((i, t) for i, t, _ in collected(d)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, start = [], 0
    for (i, _), e in zip(rows, tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_store.stored(d.withColumn("shard", F.lit("clash"))).collect()), key=lambda r: r[1]) == want
    assert token_store.stored(docs.limit(0)).count() == 0


def test_encoder_against_the_library(tokenizer, monkeypatch):
    rng = random.Random(8)
    some = ["the", "cat", "l'été", "naïve", "12,5%", "(x)", "…", "日本", "🙂", "don't", "a.b", "x,", "end."]
    text = lambda n: "".join(rng.choice(some) + rng.choice([" ", " ", "  ", "\n", "\t", "\n\n "]) for _ in range(n)).strip()
    texts = [*ODD, *(text(rng.randint(0, 60)) for _ in range(200)), text(300_000), "x" * 1_200_000]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    def got(enc):
        raw = [t.encode() for t in texts]
        ids, first = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
        return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]

    assert got(encoder.Encoder(encoder.default_vocabulary())) == want
    # stretches whose hashes collide, here nearly all, are told apart by their bytes
    plain = encoder.Words.hash
    monkeypatch.setattr(encoder.Words, "hash", lambda *a, **b: plain(*a, **b) % np.uint64(7))
    texts = texts[:150]
    want = want[:150]
    assert got(encoder.Encoder(encoder.default_vocabulary())) == want


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64)
    for n in (1, 2, 7, 5000):
        k = keys[:n]
        g = token_store.build(k)
        assert sorted(token_store.slot_of(k, g, n)) == list(range(n))
        x = token_store.Index(token_store.index_bytes(k, np.zeros(n, np.int32), np.arange(n), np.arange(n)))
        assert x.find(k)[0].all() and (x.find(k)[2] == np.arange(n)).all()
    assert x.find(np.random.default_rng(2).integers(0, 2**64, 5000, dtype=np.uint64))[0].mean() < 0.01


def test_token_counts(spark, tokenizer):
    d = spark.createDataFrame([(i, t, "en" if i % 2 else None, "src") for i, t in enumerate([*ODD, "one\ntwo three\n", None])], "doc_id long, text string, lang string, source string")
    for r in token_counts.token_counts(d).collect():
        row = d.filter(F.col("doc_id") == r["doc_id"]).first()
        text, lang = row["text"] or "", row["lang"] or ""
        whole = f"lang: {lang}\nsource: src\n\n{text}"
        e = tokenizer.encode(whole, add_special_tokens=False)
        spans, p = [(6, 6 + len(lang)), (6 + len(lang) + 9, 6 + len(lang) + 12)], 6 + len(lang) + 14
        for line in text.splitlines(keepends=True) if "\x1c" not in text else [text]:
            spans.append((p, p + len(line)))
            p += len(line)
        counts = [0] * len(spans)
        for i, (a, b) in enumerate(e.offsets):
            stop = e.offsets[i + 1][0] if i + 1 < len(e.offsets) else len(whole)
            for k, (x, y) in enumerate(spans):
                if y > x and y > a and x < max(stop, a + 1):
                    counts[k] += 1
                    break
        assert r["n_tokens"] == len(e.ids) == sum(r["field_tokens"]) + r["text_tokens"] + r["glue_tokens"]
        assert r["field_tokens"] == counts[:2] and [x for x in r["line_tokens"] if x] == [x for x in counts[2:] if x]


# --- mixing, sharding -----------------------------------------------------------------------------------------------


def test_targets_fill_up(spark):
    sizes = {"a": 100, "b": 900, "c": 10, "d": 5000, None: 40}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame([*sizes.items()], "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    open_, left, want = set(sizes), float(sum(sizes.values())), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            break
        for s in full:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
        open_ -= full
    want |= {s: level * weight[s] for s in open_}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix(docs):
    got = mixing.mix_sources(docs.withColumns({c: F.lit("clash") for c in [*CLASH, "target"]})).collect()
    again = mixing.mix_sources(docs.repartition(3)).collect()
    slim = lambda rows: sorted(((r["doc_id"], r["size"], r["target"], r["taken"], r["passes"]) for r in rows), key=str)
    assert slim(got) == slim(again) and len(got) == docs.count()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((i, len(SPACE.findall(t))) for i, t, _ in collected(docs) if i is not None)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["passes"] <= 3
        x = by.setdefault(r["source"], [r["target"], 0, r["source_size"], 0])
        x[1] += r["taken"]
        x[3] += r["size"]
    assert all(abs(t - n) <= 1 and s == z for t, n, s, z in by.values())
    many = {}
    for r in got:
        many[r["doc_id"]] = many.get(r["doc_id"], 0) + r["passes"]
    out = [r["doc_id"] for r in mixing.mixed(docs.withColumns({c: F.lit("clash") for c in CLASH})).collect()]
    assert {i: out.count(i) for i in many} == many and len(out) == sum(many.values())
    first = {r["doc_id"]: r["first_slot"] for r in got if r["first_slot"] is not None and r["doc_id"] not in (7, None)}
    met = [i for i in dict.fromkeys(out) if i in first]
    assert [first[i] for i in met] == sorted(first[i] for i in met) and mixing.mixed(docs.limit(0)).count() == 0
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_schedule_is_even(spark):
    goal = spark.createDataFrame([("a", 5000, 5000.0), ("b", 2000, 2000.0), ("c", 1000, 1000.0)], "source string, source_size long, target double")
    rows = mixing.schedule(goal, 4).orderBy("slot").collect()
    assert sum(r["words"] for r in rows) == 8000 and [r["slot"] for r in rows] == [*range(2000)]
    for n in (100, 500, 1500):
        assert abs(sum(r["source"] == "a" for r in rows[:n]) / n - 5 / 8) < 0.03
    # by hand: points 0, 1/2, 1/4, 3/4, ... and each source's blocks in order
    point = lambda i: sum((i >> b & 1) / 2 ** (b + 1) for b in range(20))
    names = ["a" if point(i) < 1250 / 2000 else "b" if point(i) < 1750 / 2000 else "c" for i in range(2000)]
    same = sum(r["source"] == x for r, x in zip(rows, names, strict=True))
    assert same > 1990 and all([r["k"] for r in rows if r["source"] == s and names[r["slot"]] == s] == [*range(k)] for s, k in ((s, min(n, names.count(s))) for s, n in (("a", 1250), ("b", 500), ("c", 250))))


def test_a_small_source_does_not_set_the_blocks_of_others(spark):
    goal = spark.createDataFrame([("a", 10_000_000, 9_999_990.0), ("b", 10, 30.0), (None, 0, 0.0)], "source string, source_size long, target double")
    rows = mixing.schedule(goal)
    assert rows.count() == 9766 + 30 and rows.agg(F.sum("words")).first()[0] == 10_000_020


def test_shards(docs):
    d = docs.withColumns({c: F.lit("clash") for c in [*CLASH, "slot"]})
    got = sharding.shard(d).collect()
    n = docs.count()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == n and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(map(len, slots.values())) <= {n // 8, n // 8 + 1} and len(slots) == 8
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sharding.shard(d.repartition(5)).collect()), key=str)
    assert sharding.shard(docs.limit(0)).count() == 0


def test_repeated_rows_are_dealt_each_for_itself(spark):
    d = spark.createDataFrame([(1, "same")] * 400 + [(i, "own") for i in range(2, 402)], "doc_id long, text string")
    got = [tuple(r) for r in sharding.shard(d).collect()]
    of = [sum(r[0] == 1 and r[2] == s for r in got) for s in range(8)]
    assert sorted(r[:2] for r in got) == sorted(map(tuple, d.collect())) and all(25 < x < 75 for x in of)
    assert sorted(r[2:] for r in got) == [(s, k) for s in range(8) for k in range(100)]


def test_hypergeometric_law():
    rng = random.Random(5)
    xs = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(xs) - 6) < 0.15 and abs(np.var(xs) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    m = sharding.matrix([10, 0, 25, 7], 8, 1)
    assert [sum(r) for r in m] == [10, 0, 25, 7] and sorted(set(map(sum, zip(*m, strict=True)))) == [5, 6]


# --- quality --------------------------------------------------------------------------------------------------------


def base(text):
    w = SPACE.findall(text)
    tri = {}
    for i in range(len(w) - 2):
        tri.setdefault(tuple(w[i : i + 3]), []).append(i)
    hit = {i + j for at in tri.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_base_rules(spark):
    rng = random.Random(2)
    texts = ["", None, "\n\n a \n a \n", "é é é é é é", "x\r\nx\r\n#$ 日本\n日本", "a b c a b c " * 30]
    texts += ["".join(rng.choice(["ab ", "c ", "\n", "é* ", "\t", "x "]) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumn("kept", F.lit("clash"))
    for r in quality.judged(d, quality.Model(bias=50.0)).collect():
        want = base(texts[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) == (not r["kept"])


def test_classifier_on_rows_held_out(spark):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["the", "of", "river", "stone", "walks", "under"]) + rng.choice(["", "s", "ed"]) for _ in range(80))
    bad = lambda: " ".join(w + rng.choice(["###", "$$$", "!!"]) for w in good().split())
    d = spark.createDataFrame([(i, bad() if i % 4 == 0 else good()) for i in range(400)], "doc_id long, text string")
    labels = d.filter("doc_id < 200").select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality"))
    model = quality.fit(d, labels)
    r = quality.judged(d, model).filter("doc_id >= 200").collect()
    assert sum((x["probability"] >= 0.5) == (x["doc_id"] % 4 > 0) for x in r) >= 0.97 * len(r)
    assert quality.judged(d, quality.fit(d, labels.filter("quality = 1"))).filter("probability < 0.5").count() == 0


# --- lines ----------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines(spark, monkeypatch):
    rng = random.Random(6)
    basis = ["".join(rng.choice("abc dé\U0001f600") for _ in range(n)) for n in [*range(2, 30), 57, 58, 59, 60, 61, 62, 90, 118, 119, 120, 121, 123, 124, 200]]
    lines = []
    for b in basis:
        lines.append(b)
        for _ in range(4):
            x = list(b)
            for _ in range(min(len(x) - 1, rng.randint(0, 6))):
                k = rng.randrange(len(x))
                x[k : k + 1] = rng.choice([[], ["z"], ["z", x[k]]])
            lines.append("".join(x))
    rng.shuffle(lines)
    texts = ["\n".join(lines[i : i + 7]) for i in range(0, len(lines), 7)] + [None, "", "\n \n"]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumn("n", F.lit("clash"))
    place = [(i, n, x) for i, t in enumerate(texts) for n, x in enumerate((t or "").split("\n")) if SPACE.search(x)]
    unique = sorted({x for _, _, x in place})
    links = [(a, b) for i, a in enumerate(unique) for b in unique[:i] if distance(a, b) <= line_dedup.edits_of(min(len(a), len(b)))]
    cls = {x: k for k, g in enumerate(components(unique, links)) for x in g}
    seen, first, want = set(), set(), {}
    for i, n, x in place:
        want[i, n] = (x in seen, cls[x] not in first, sum(x in link for link in links))
        seen.add(x)
        first.add(cls[x])
    monkeypatch.setattr(line_dedup, "HOT", 2)
    got = {(r["doc_id"], r["n"]): (r["exact"], r["kept"], r["n_links"]) for r in line_dedup.line_classes(d).collect()}
    assert {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v} == {}
    assert got == want and len(links) > 40
    assert line_dedup.line_classes(d.limit(0)).count() == 0
    clean = {r["doc_id"]: r["text"] for r in line_dedup.without_duplicate_lines(d).collect()}
    assert clean[0] == "\n".join(x for n, x in enumerate(texts[0].split("\n")) if (0, n) not in want or want[0, n][1]) and clean[len(texts) - 3] is None


def test_lines_look_up_few_keys_and_meet_over_ranges_of_lengths(spark):
    rng, lines = random.Random(8), set()
    for n in [*range(8, 25), *range(56, 62), *range(68, 76), *range(116, 140), 150, 152]:
        base = [rng.choice("abcdefgh \u00e9\U0001f600") for _ in range(n)]
        lines.add("".join(base))
        for _ in range(5):
            x, k = list(base), rng.randint(0, 5)
            # edits at any places, or all of them before or behind the middle
            low, high = rng.choice([(0, 1), (0, 0.5), (0.5, 1)])
            for _ in range(k):
                at = min(len(x) - 1, int(len(x) * (low + (high - low) * rng.random())))
                x[at : at + 1] = rng.choice([[], ["z"], ["z", x[at]]])
            lines.add("".join(x))
    lines = sorted(x for x in lines if x.strip())
    d = spark.createDataFrame([*enumerate(lines)], "id long, line string")
    near = {(i, j): e for i, x in enumerate(lines) for j in range(i) if abs(len(x) - len(lines[j])) < 5 and (e := distance(x, lines[j])) <= line_dedup.edits_of(min(len(x), len(lines[j])))}
    assert {(r["b"], r["a"]): r["edits"] for r in line_dedup.near_lines(d).collect()} == near and len(near) > 100
    # 13 keys with four edits, and a quarter of the lines look into the range below as well; it was 49 for each line
    long = spark.createDataFrame([(n, "x" * n, n) for n in range(136, 200)], "id long, line string, n int")
    assert line_dedup.keyed(long, True).count() <= 64 * 13 * 1.25


def test_banded_distance(spark):
    rng, rows = random.Random(7), []
    for _ in range(600):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice([[], ["a"], ["c"]])
        rows.append((a, "".join(b)))
    d = spark.createDataFrame(rows, "a string, b string")
    assert all(r["x"] <= distance(r["a"], r["b"]) for ends in (2, 4) for r in d.select("a", "b", line_dedup.at_least(F.col("a"), F.col("b"), ends).alias("x")).collect())
    for k in (1, 2, 4):
        for r in d.select("a", "b", line_dedup.line_distance(F.col("a"), F.col("b"), k).alias("d"), line_dedup.banded_distance(F.col("a"), F.col("b"), k).alias("e")).collect():
            want = distance(r["a"], r["b"])
            assert (r["d"] == r["e"] == want) if want <= k else min(r["d"], r["e"]) > k


def test_digest_of_turns_matches_the_contract():
    assert hashlib.sha256(b"user\nok\n").hexdigest() == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in [("user", "ok")]).encode()).hexdigest()


# --- all operators: long texts, empty tables, repeated rows, clashing names ----------------------------------------


def test_clusters_and_removals_of_paragraphs(spark):
    rng, lines = random.Random(31), []
    for _ in range(25):
        w = words(rng, 60)
        lines += [w, list(w), [*w[:30], "other", *w[31:]], words(rng, 15)]
    texts = [" ".join(w) for w in lines]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    sets = [shingle_set(x) for x in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    whole = [frozenset(ids[i] for i in g) for g in components(range(len(texts)), links) if len(g) > 1]
    d = spark.createDataFrame([*zip(ids, texts, strict=True)], "doc_id long, text string").withColumns({c: F.lit("clash") for c in CLASH if c not in ("text", "doc_id")})
    near, groups = {r["doc_id"]: r for r in substring.near_paragraphs(d).collect()}, {}
    for i, r in near.items():
        groups.setdefault(r["cluster"], set()).add(i)
    # each cluster lies in one of the true ones, and nearly all are whole; of each the first place stays
    assert len(whole) == 25 and all(any(g <= w for w in whole) for g in groups.values()) and sum(g in whole for g in map(frozenset, groups.values())) >= 23
    want = {i: i != min(g) for g in groups.values() for i in g}
    assert {i: r["removed"] for i, r in near.items()} == want and all(r["kept"] == min(groups[r["cluster"]]) for r in near.values())
    out = {r["doc_id"]: r for r in substring.repeats(d).collect()}
    assert {i for i, gone in want.items() if gone} <= {i for i, r in out.items() if r["n_removed"]}
    # a removed paragraph goes whole, near its head or alike
    assert all(out[i]["removed_words"] == 60 for i, gone in want.items() if gone)


def test_very_long_texts(spark, tokenizer):
    rng = random.Random(32)
    long = " ".join(words(rng, 190_000))
    item = "if Anna buys 3 apples and 5 pears for 20 dollars then how much would Anna pay for 3 apples at the market stall today"
    texts = [long, long, long[:-3] + "xyz", f"{long} {item.replace('Anna', 'Boris')}", "short"]
    assert len(long) > 1 << 20
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    assert sorted((r["doc_id"], r["class_id"], r["copy_id"], r["n_links"]) for r in jaccard.near_duplicates(d).collect()) == [(0, 0, 0, 2), (1, 0, 0, 2), (2, 0, 2, 2), (3, 0, 3, 2), (4, 4, 4, 0)]
    assert {r["doc_id"] for r in substring.repeats(d).collect()} == {0, 1, 2, 3}
    b = spark.createDataFrame([(10, item)], "item_id long, text string")
    assert [(r["doc_id"], r["n_changed"]) for r in decontam.leaks(d, b).collect()] == [(3, 1)]
    assert {r["doc_id"]: r["n_words"] for r in quality.judged(d, quality.Model(bias=50.0)).collect()} == {0: 190_000, 1: 190_000, 2: 190_000, 3: 190_000 + len(item.split()), 4: 1}
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(d).collect()}
    assert got[2] == len(tokenizer.encode(f"lang: en\nsource: s\n\n{texts[2]}", add_special_tokens=False).ids)
    lines = line_dedup.per_document(d).collect()
    assert {r["doc_id"]: r["n_links"] for r in lines} == {i: int(i < 3 and distance(long[-9:], texts[2][-9:]) <= 4) for i in range(5)}
    assert sharding.shard(d).count() == 5 and mixing.mix_sources(d).agg(F.sum("size")).first()[0] > 4 * 190_000


def test_empty_tables_and_repeated_rows(spark):
    model = quality.Model(bias=50.0)
    item = spark.createDataFrame([(10, "the old river runs by the mill and the tall trees stand near it"), (10, "the old river runs by the mill and the tall trees stand near it")], "item_id long, text string")
    rows = [(1, "say the old river runs by the mill and the tall trees stand near it", "en", "s", 0)] * 3 + [(None, None, None, None, None)] * 2
    d = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in [*CLASH, "n_tokens", "n_words"]})
    none = d.limit(0)
    assert [x.count() for x in (token_counts.token_counts(none), quality.judged(none, model), sharding.shard(none), mixing.mixed(none), line_dedup.per_document(none), line_dedup.without_duplicate_lines(none), jaccard.one_of_each(none), decontam.without_leaks(none, item))] == [0] * 8
    assert len({str(r) for r in token_counts.token_counts(d).filter("doc_id = 1").collect()}) == 1 and token_counts.token_counts(d).count() == 5
    judged = quality.judged(d, model).filter("doc_id = 1").collect()
    assert len(judged) == 3 and {r["n_words"] for r in judged} == {15}
    assert [(r["doc_id"], r["item_id"]) for r in decontam.leaks(d, item).collect()] == [(1, 10)]
    assert decontam.without_leaks(d, item).count() == 2 and jaccard.one_of_each(d).count() == 2 and sharding.shard(d).count() == 5
    assert substring.repeats(d).count() == 0 and line_dedup.per_document(d).agg(F.sum("n_lines")).first()[0] == 3


def test_a_cluster_without_a_shared_folder_is_refused(spark, tmp_path):
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)
    Session.conf = Conf({"spark.master": "local[2]"})
    assert common.shared_dir(Session) == common.shared_dir(Session) == Session.conf["spark.checkpoint.dir"]


def there(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def test_working_files_go(spark):
    before = common.saved(spark.range(3), "before")
    with common.working(spark) as keep:
        with common.working(spark) as keep_inner:
            a, b = common.saved(spark.range(5), "a"), keep_inner(common.saved(spark.range(7), "b"))
        assert not there(spark, a.saved_at) and b.count() == 7
        c = keep(common.saved(b, "c"))
    assert not there(spark, b.saved_at) and c.count() == 7 and before.count() == 3
    with pytest.raises(ZeroDivisionError), common.working(spark) as keep:
        d = keep(common.saved(spark.range(2), "d"))
        1 / 0  # noqa: B018
    assert not there(spark, d.saved_at)
    common.discard(before, c)
    assert not there(spark, before.saved_at)
    with pytest.raises(ZeroDivisionError), common.bucketed(spark.range(3), "c", "id") as c:
        name = c.inputFiles()[0].rsplit("/", 2)[1]
        1 / 0  # noqa: B018
    assert not spark.catalog.tableExists(name)


def test_operators_in_two_threads_keep_their_files(spark, docs):
    from concurrent.futures import ThreadPoolExecutor

    other = docs.withColumn("doc_id", F.col("doc_id") + 1000)
    want = [sorted(map(tuple, jaccard.near_duplicates(d).collect()), key=str) for d in (docs, other)]
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda d: sorted(map(tuple, jaccard.near_duplicates(d).collect()), key=str), (docs, other)))
    assert got == want


def test_german_nouns_are_no_names(spark):
    item = "Das Kind hat die Mutter und der Vater hat die Tochter in der Stadt"
    texts = ["Der Koch hat die Suppe und der Gast hat die Rechnung in der Hand", f"Davor. {item}. Danach.", "Heute hat Anna 3 rote und der kleine alte Hund 5 blaue Bälle im Garten bei Paul", "Heute hat Berta 9 rote und der kleine alte Hund 7 blaue Bälle im Garten bei Otto", "Heute hat Berta 9 rote und der kleine alte Esel 7 blaue Bälle im Stalle bei Otto"]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    b = spark.createDataFrame([(10, item), (11, texts[2])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_changed"] for r in decontam.leaks(d, b).collect()}
    assert got == {(1, 10): 0, (2, 11): 0, (3, 11): 4}


def test_links_are_looked_for_where_none_was_found_at_full_depth(spark):
    rng, texts = random.Random(51), []
    for _ in range(12):
        w = words(rng, 120)
        texts += [w, [*w[:54], *["x" + x for x in w[54:66]], *w[66:84], "y", *w[85:]]]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    sets = [shingle_set(" ".join(w)) for w in texts]
    likeness = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 24, 2)]
    assert all(0.5 <= x < 0.7 for x in likeness)
    got = {r["doc_id"]: r["n_links"] for r in jaccard.near_duplicates(d, threshold=0.5).collect()}
    assert got == {i: 1 for i in range(24)}
    # one trie and long prefixes: at full depth nothing is found
    assert sum(r["n_links"] for r in jaccard.near_duplicates(d.filter("doc_id < 2"), threshold=0.5, trees=2).collect()) == 2


def test_names_in_either_case_and_rows_repeated_often(spark, monkeypatch):
    rows = [(i, f"text {i} " * 30, "mine") for i in range(20)]
    for name in ("Shard", "slot", "KEY", "key2", "Count", "piece"):
        d = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` string")
        got = sharding.shard(d)
        assert len({c.lower() for c in got.columns}) == len(got.columns) and got.count() == 20
        if name.lower() not in ("shard", "slot"):
            assert {r[name] for r in got.collect()} == {"mine"}
    for name in ("Kept", "N_WORDS"):
        assert quality.judged(spark.createDataFrame(rows, f"doc_id long, text string, `{name}` string"), quality.Model(bias=50.0)).filter("kept is not null").count() == 20
    monkeypatch.setattr(sharding, "COPIES", 7)
    often = spark.createDataFrame([(1, "a")], "doc_id long, text string").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1000)))).drop("n").unionByName(spark.createDataFrame([(2, "b"), (3, "c"), (3, "c")], "doc_id long, text string"))
    got = sharding.shard(often).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted([(1, "a")] * 1000 + [(2, "b"), (3, "c"), (3, "c")])
    assert {(r["shard"], r["slot"]) for r in got} == {(s, i) for s in range(8) for i in range(sum(r["shard"] == s for r in got))}
