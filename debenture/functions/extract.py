"""Dates, currency and size, coupon and banks as column expressions over cleaned text. compat (default): the answers of the
established rules, oddities included; strict: the oddities mended."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import anchors as A
from . import patterns as P
from .text import bank_sections, ci, empty_to_null, let, text_around

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def first_group(text: Column, pattern: str, group: int = 1, hits: Column | None = None) -> Column:
    value = empty_to_null(F.regexp_extract(text, ci(pattern), group))
    return value if hits is None else F.when(A.may_match(hits, pattern), value)


def first_filled(*found: Column) -> Column:
    return F.coalesce(*found)


# --- dates ----------------------------------------------------------------------------------------------------------


def normalise_dates(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"[/\\\-.]", "-"), r"(\d+)(?:st|nd|rd|th)", "$1")


def _date(y: Column, m: Column, d: Column) -> Column:
    iso = F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"))
    return iso.try_cast("date")


def _century(yy: Column, pivot: int) -> Column:
    return F.concat(F.when(yy.cast("int") >= pivot, "19").otherwise("20"), yy)


def parse_date(s: Column, strict: bool = False) -> Column:
    """d-m-yyyy, d-m-yy, m-d-yyyy, m-d-yy and yy-m-d, in this order, or `d Month yyyy`; two-digit years from 69 on are
    1900s. Behind a month a two-digit year counts only if the day has one digit: with two, the day is read as the year
    (strict: it isn't). Else null."""
    numeric, word = r"^\d{1,2}-\d{1,2}-(?:\d{4}|\d{2})$", r"^\d{1,2}\s+[A-Za-z]+\s+\d{2,4}$"

    def by_number(x: Column) -> Column:
        a, b, c = x["a"], x["b"], x["c"]
        four = F.length(c) == 4
        year = F.when(four, c).otherwise(_century(c, 69))
        return let(year, lambda y: F.coalesce(_date(y, b, a), _date(y, a, b), F.when(~four & (F.length(a) == 2), _date(_century(a, 69), b, c))))

    def by_name(x: Column) -> Column:
        d, y = x["a"], x["c"]
        month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(x["b"])).cast("string")
        short = F.when(F.length(y) == 2, _century(y, 50))
        if not strict:
            short = F.when(F.length(d) == 2, _century(d, 50)).otherwise(short)
        return _date(F.when(F.length(y) == 4, y).otherwise(short), month, d)

    def parts(v: Column) -> Column:
        return let(F.regexp_extract_all(v, F.lit("[0-9]+|[A-Za-z]+"), 0), lambda x: F.struct(*[F.get(x, F.lit(i)).alias(n) for i, n in enumerate("abc")]))

    return let(F.trim(s), lambda v: F.when(F.regexp_like(v, F.lit(numeric)), let(parts(v), by_number)).when(F.regexp_like(v, F.lit(word)), let(parts(v), by_name)))


def first_date(t: Column, patterns: list[str], strict: bool = False, hits: Column | None = None) -> Column:
    """Of each pattern in turn the first match, if it can be read. Patterns are run up to the first that matches, all of them only
    if its match can't be read; that reading is one lambda for all patterns, so the plan stays small."""
    groups = [first_group(t, p, hits=hits) for p in patterns]
    every = F.get(F.filter(F.transform(F.array(*groups), lambda x: parse_date(x, strict)), lambda d: d.isNotNull()), F.lit(0))
    return let(F.coalesce(*groups), lambda x: F.when(x.isNotNull(), F.coalesce(parse_date(x, strict), every)))


def _strict_normal(text: Column) -> Column:
    def without_commas(x: Column) -> Column:
        t = F.regexp_replace(x, r"(\d),(?=\s+\d{4})", "$1")
        return F.when(F.contains(x, F.lit(",")), F.regexp_replace(t, rf"(\d)\s*({'|'.join(m.title() for m in MONTHS)}),", "$1 $2")).otherwise(x)

    return let(normalise_dates(text), without_commas)


def _strict_dates(t: Column, patterns: list[str], hits: Column) -> Column:
    """t: text in its strict normal form. The patterns all end in the date that they read, in one of three forms; they are run where
    one of these stands anywhere."""
    lead = r"(?:issue\s+date|date\s+of\s+issue|issuance\s+date)" if patterns is P.ISSUE_DATE else r"(?:maturity\s+date|final\s+maturity|redemption\s+date)"
    behind = lambda p: F.when(A.may_match(hits, patterns[0]), F.regexp_extract(t, ci(rf"{lead}\s*[:\-]?\s*({p})"), 1))  # noqa: E731  the first pattern has the same lead
    us = F.regexp_replace(behind(r"[a-z]+\s+\d{1,2},?\s+\d{4}"), ci(r"^([a-z]+)\s+(\d{1,2}),?\s+(\d{4})$"), "$2 $1 $3")
    used = [p for i, p in enumerate(patterns) if not (patterns is P.ISSUE_DATE and i == P.NO_GROUP) and r"(\d{4})" not in p and r"(\d{8})" not in p]
    forms = dict.fromkeys(p[p.index(r"(\d") :] for p in used)
    found = F.when(F.regexp_like(t, F.lit(ci("|".join(forms)))), first_date(t, used, strict=True, hits=hits))
    return F.coalesce(behind(r"\d{4}-\d{1,2}-\d{1,2}").try_cast("date"), found, parse_date(us, strict=True))


def dates(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """struct of issue_date, maturity_date (yyyy-MM-dd) and failed: the ninth issue pattern has no group to read, so a text
    that comes to it without a date can't be processed (strict: it is read as month, day, year)."""
    out = lambda d: F.date_format(d, "yyyy-MM-dd")

    def read(t: Column, known: Column) -> Column:
        if strict:
            return F.struct(out(_strict_dates(t, P.ISSUE_DATE, known)).alias("issue_date"), out(_strict_dates(t, P.MATURITY_DATE, known)).alias("maturity_date"), F.lit(False).alias("failed"))
        issue, maturity = (first_date(t, x, hits=known) for x in (P.ISSUE_DATE[: P.NO_GROUP], P.MATURITY_DATE))

        def judge(x: Column) -> Column:
            failed = x["i"].isNull() & A.may_match(known, P.ISSUE_DATE[P.NO_GROUP]) & F.regexp_like(t, F.lit(ci(P.ISSUE_DATE[P.NO_GROUP])))
            return let(F.coalesce(failed, F.lit(False)), lambda f: F.struct(F.when(~f, out(x["i"])).alias("issue_date"), F.when(~f, out(x["m"])).alias("maturity_date"), f.alias("failed")))

        return let(F.struct(issue.alias("i"), maturity.alias("m")), judge)

    normal = _strict_normal(text) if strict else normalise_dates(text)
    return A.within(text, hits, lambda known: let(normal, lambda t: read(t, known)), [*P.ISSUE_DATE, *P.MATURITY_DATE])


# --- coupon ---------------------------------------------------------------------------------------------------------


def normalise_coupon(text: Column, strict: bool = False) -> Column:
    t = F.regexp_replace(text, r"(?i)\bper\s*cent\b\.?" if strict else r"per\s*cent\.?", "%")
    return F.regexp_replace(F.regexp_replace(t, r"\s+%", "%"), r"(\d+),(\d+)", "$1.$2")


def coupon(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """struct of coupon_rate and coupon_type. Rate: of each pattern in turn the first match from 0 to 20. Type: the first of
    the list that occurs; a rate without type is fixed, zero coupon without rate is 0."""
    return A.within(text, hits, lambda known: let(normalise_coupon(text, strict), lambda t: _coupon(t, known)))


def _coupon(t: Column, hits: Column) -> Column:
    fits = lambda x: F.coalesce(x.try_cast("double").between(0, 20), F.lit(False))
    rate = F.coalesce(*[F.when(A.may_match(hits, p), F.get(F.filter(F.regexp_extract_all(t, F.lit(ci(p)), 1), fits), F.lit(0))) for p in P.COUPON_RATE])
    kind = F.coalesce(*[F.when(A.may_match(hits, p), first_group(t, f"({p})")) for p in P.COUPON_TYPES])
    kind = F.regexp_replace(F.lower(F.trim(kind)), r"\s+", " ")

    def settle(x: Column) -> Column:
        k = F.when(x["r"].isNotNull(), F.coalesce(x["k"], F.lit("fixed rate"))).otherwise(x["k"])
        return F.struct(F.coalesce(x["r"], F.when(F.contains(x["k"], F.lit("zero")), F.lit("0"))).alias("coupon_rate"), k.alias("coupon_type"))

    return let(F.struct(rate.alias("r"), kind.alias("k")), settle)


# --- currency and size ----------------------------------------------------------------------------------------------


def normalise_currency(text: Column, strict: bool = False) -> Column:
    """Without white space beside currency symbols; the letters of Fr, kr and R count one by one (strict: $ € £ ¥ ₽ ₺ ₹ only)."""
    t = F.regexp_replace(text, r"\x{A0}", " ")
    symbols = "$€£¥₽₺₹" if strict else P.TIGHT
    return F.regexp_replace(t, rf"\s*([{symbols}])\s*", "$1")


def python_float(x: Column) -> Column:
    """A double as Python prints it: plain digits below 1e16, one decimal at least, else an exponent."""
    plain = F.format_string("%.1f", x)
    short = x.cast("string")
    broken = F.regexp_replace(short.cast("decimal(38,12)").cast("string"), r"0+$", "")
    exponent = F.regexp_replace(F.regexp_replace(short, r"\.0E", "E"), "E", "e+")
    return F.when(F.abs(x) >= 1e16, exponent).when(x == F.floor(x), plain).otherwise(broken)


def scaled(amount: Column, context: Column, strict: bool = False) -> Column:
    """amount times 1e9 if context says billion or bn, else 1e6 if it says million or has an m anywhere (strict: m behind the
    number); an amount that isn't a number stays as it is."""
    return let(F.struct(amount.alias("a"), context.alias("c")), lambda x: _scaled(x["a"], x["c"], strict))


def _scaled(amount: Column, context: Column, strict: bool) -> Column:
    value = amount.try_cast("double")
    large = F.contains(context, F.lit("billion")) | F.contains(context, F.lit("bn"))
    small = F.regexp_like(context, F.lit(r"(?i)\d\s*(million|m)\b")) if strict else F.contains(context, F.lit("m"))
    factor = F.when(large, F.lit(1e9)).when(small, F.lit(1e6))
    return F.when(factor.isNull() | value.isNull(), amount).otherwise(let(value * factor, python_float))


def code_in(text: Column) -> Column:
    """The first code of the list that stands in text as a word."""
    return F.coalesce(*[F.when(F.regexp_like(text, F.lit(rf"(?i)\b{c}\b")), F.lit(c)) for c in P.CURRENCY_CODES])


def code_of_symbol(group: Column) -> Column:
    return F.coalesce(*[F.when(F.contains(group, F.lit(s)), F.lit(c)) for s, c in P.SYMBOL_TO_CODE.items()])


def currency_primary(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """struct of currency and issue_size of the first pattern that finds either."""
    symbol = "|".join(P.CURRENCY_SYMBOLS)
    result = "struct<currency:string,issue_size:string>"

    def read(t: Column, p: str):
        groups = [1, 2] if p.count("(") - p.count("(?:") == 2 else [1]

        def one(m: Column) -> Column:
            given = [F.regexp_extract(m, ci(p), g) for g in groups]
            by_symbol = F.coalesce(*[F.when(F.regexp_like(g, F.lit(symbol)), code_of_symbol(g)) for g in given])
            size = F.replace(F.regexp_extract(m, r"([\d,.]+)", 1), F.lit(","), F.lit(""))
            return F.struct(F.coalesce(code_in(m), by_symbol).alias("currency"), empty_to_null(scaled(size, m, strict)).alias("issue_size"))

        found = F.transform(F.regexp_extract_all(t, F.lit(ci(p)), 0), one)
        return F.get(F.filter(found, lambda x: x["currency"].isNotNull() | x["issue_size"].isNotNull()), F.lit(0))

    first = lambda t, known: F.coalesce(*[F.when(A.may_match(known, p), read(t, p)) for p in P.ISSUE_SIZE], F.lit(None).cast(result))
    return A.within(text, hits, lambda known: let(normalise_currency(text, strict), lambda t: first(t, known)))


def currency_fallback(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """struct of currency and issue_size by the phrases that name an amount; a missing currency is looked for within 50
    characters. At last, the size of a medium term note programme."""
    result = "struct<currency:string,issue_size:string>"

    def phrase(known: Column, rule: str) -> Column:
        # a match counts if it has an amount, more than commas, or a currency
        p = P.counting_phrase(rule)

        def read(x: Column) -> Column:
            whole, group = x["w"], F.coalesce(empty_to_null(x["g"]), x["g2"])
            digits = F.replace(F.coalesce(empty_to_null(x["a"]), x["a2"]), F.lit(","), F.lit(""))
            amount = scaled(digits, F.lower(whole), strict)
            exact = F.coalesce(*[F.when(F.upper(group) == c, F.lit(c)) for c in P.CURRENCY_CODES])
            start = F.regexp_instr(text, F.lit(ci(p)))
            near = let(F.substring(text, F.greatest(start - 50, F.lit(1)), start + F.length(whole) + 50 - F.greatest(start - 50, F.lit(1))), code_in)
            return F.when(whole != "", F.struct(F.coalesce(exact, code_of_symbol(group), F.when(digits != "", near)).alias("currency"), empty_to_null(amount).alias("issue_size")))

        # texts without a match are read once
        whole = F.regexp_extract(text, ci(p), 0)
        groups = lambda w: F.struct(w.alias("w"), *[F.regexp_extract(text, ci(p), i).alias(n) for i, n in ((1, "g"), (2, "a"), (3, "g2"), (4, "a2"))])
        return F.when(A.may_match(known, rule), let(whole, lambda w: F.when(w != "", let(groups(w), read))))

    whole = F.regexp_extract(text, ci(P.PROGRAMME), 0)
    amount = scaled(F.replace(F.regexp_extract(text, ci(P.PROGRAMME), 1), F.lit(","), F.lit("")), F.lower(whole), strict)
    programme = F.when(whole != "", F.struct(F.lit("EUR").alias("currency"), empty_to_null(amount).alias("issue_size")))
    last = lambda known: F.when(A.may_match(known, P.PROGRAMME), programme)
    return A.within(text, hits, lambda known: F.coalesce(*[phrase(known, p) for p in P.AMOUNT_PHRASES], last(known), F.lit(None).cast(result)))


def currency(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """struct of currency and issue_size: the fallback fills what the primary patterns leave out."""

    def both(known: Column) -> Column:
        fill = lambda a, b: F.struct(F.coalesce(a["currency"], b["currency"]).alias("currency"), F.coalesce(a["issue_size"], b["issue_size"]).alias("issue_size"))
        return let(currency_primary(text, strict, known), lambda a: F.when(a["currency"].isNotNull() & a["issue_size"].isNotNull(), a).otherwise(let(currency_fallback(text, strict, known), lambda b: fill(a, b))))

    return A.within(text, hits, both)


# --- banks ----------------------------------------------------------------------------------------------------------


def all_matches(text: Column, patterns: list[str], hits: Column | None = None) -> Column:
    """Matches of each pattern in turn, in one array."""
    none = F.array().cast("array<string>")
    one = lambda p: F.regexp_extract_all(text, F.lit(ci(f"({p})")), 1)
    return F.flatten(F.array(*[one(p) if hits is None else F.when(A.may_match(hits, p), one(p)).otherwise(none) for p in patterns]))


def bank_roles(text: Column, hits: Column | None = None) -> Column:
    return A.within(text, hits, lambda known: F.array_distinct(F.transform(all_matches(text, P.BANK_ROLES, known), lambda r: F.trim(F.lower(r)))))


def known_banks(text: Column, hits: Column | None = None) -> Column:
    return A.within(text, hits, lambda known: F.array_distinct(all_matches(text, P.BANKS, known)))


def banks_near(text: Column, roles: Column, low: Column | None = None) -> Column:
    """Capitalised runs within 100 characters of a role's first place, where nothing around it speaks against. low: text in lower case."""

    def one(role: Column) -> Column:
        def read(around: Column) -> Column:
            good = (F.length(F.trim(around)) >= 3) & ~F.regexp_like(around, F.lit(ci(P.CONTEXT_STOP)))
            return F.when(good, F.filter(F.regexp_extract_all(around, F.lit(P.CAPITALISED), 0), lambda b: ~F.regexp_like(b, F.lit(P.CANDIDATE_STOP))))

        return let(text_around(text, role, 100, low), read)

    return F.array_distinct(F.flatten(F.array_compact(F.transform(roles, one))))


def common_subsequence(x: Column, y: Column) -> Column:
    """Length of the longest common subsequence. A bit for each character of the shorter text, while these fit a long: zeros in the end
    are what both have; for longer texts by rows of the table of lengths."""

    def by_bits(t: Column) -> Column:
        full = F.call_function("shiftleft", F.lit(1).cast("long"), F.size(t["y"])) - 1
        place = lambda c, i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
        mask = lambda x: F.aggregate(F.transform(t["y"], lambda c, i: F.when(c == x, place(c, i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
        step = lambda v, x: let(mask(x), lambda m: (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full))
        return F.size(t["y"]) - F.bit_count(F.aggregate(t["x"], full, step))

    def by_rows(t: Column) -> Column:
        def row(before: Column, x: Column) -> Column:
            cell = lambda now, j: F.when(F.get(t["y"], j - 1) == x, F.get(before, j - 1) + 1).otherwise(F.greatest(F.get(before, j), F.get(now, j - 1)))
            return F.aggregate(F.sequence(F.lit(1), F.size(t["y"])), F.array(F.lit(0)), lambda now, j: F.concat(now, F.array(cell(now, j))))

        return F.element_at(F.aggregate(t["x"], F.array_repeat(F.lit(0), F.size(t["y"]) + 1), row), -1)

    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    first = F.length(x) >= F.length(y)
    both = F.struct(letters(F.when(first, x).otherwise(y)).alias("x"), letters(F.when(first, y).otherwise(x)).alias("y"))
    return let(both, lambda t: F.when(F.size(t["y"]) == 0, F.lit(0)).when(F.size(t["y"]) <= 62, by_bits(t)).otherwise(by_rows(t)))


def likeness(x: Column, y: Column) -> Column:
    """0 to 100: twice the longest common subsequence as a share of both lengths, rounded, halves to the even number."""
    return F.bround(200 * common_subsequence(x, y) / F.greatest(F.length(x) + F.length(y), F.lit(1)), 0)


def name_words(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != "")))


def token_set_ratio(a: Column, b: Column) -> Column:
    """0 to 100: of the words that both have, followed by those that only one has, in order, the likeness of the two most alike of
    common, common and first, common and second; two texts of which one holds all words of the other are alike."""
    glue = lambda x, y: F.array_join(F.concat(x, y), " ")

    def ratio(s: Column) -> Column:
        both, x, y = F.array_intersect(s["a"], s["b"]), F.array_except(s["a"], s["b"]), F.array_except(s["b"], s["a"])
        one, two, common = glue(both, x), glue(both, y), F.array_join(both, " ")
        whole = (F.size(both) > 0) & ((F.size(x) == 0) | (F.size(y) == 0))
        # what is common begins the other two, so they have all of it
        part = lambda c: F.bround(200 * F.length(common) / F.greatest(F.length(common) + F.length(c), F.lit(1)), 0)
        return F.when(whole, F.lit(100)).when(F.size(both) == 0, likeness(one, two)).otherwise(F.greatest(part(one), part(two), likeness(one, two))).cast("double")

    return let(F.struct(name_words(a).alias("a"), name_words(b).alias("b")), ratio)


def standard_bank(name: Column, aliases: dict[str, list[str]], threshold: int = 85) -> Column:
    """struct of score and standard of the alias most like name (then the last by name), null below the threshold. The dictionary is
    a literal: no join."""
    every = F.array(*[F.struct(F.lit(a).alias("alias"), F.lit(s).alias("standard")) for s, xs in aliases.items() for a in xs])
    score = lambda x: F.struct(F.when(x["alias"] == name, F.lit(100.0)).otherwise(token_set_ratio(name, x["alias"])).alias("score"), x["standard"].alias("standard"))
    return let(F.array_max(F.transform(every, score)), lambda best: F.when(best["score"] >= threshold, best))


def confidence_tier(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "high").when(confidence >= 0.6, "medium").otherwise("low")


def clean_bank_name(name: Column) -> Column:
    c = F.regexp_replace(name, ci(P.BANK_SUFFIX), "")
    c = F.trim(F.regexp_replace(F.regexp_replace(c, ci(P.BANK_PREFIX), ""), r"\s+", " "))
    low = F.lower(c)
    return F.coalesce(*[F.when((low == old) | F.startswith(low, F.lit(old + " ")), F.lit(new)) for old, new in P.BANK_NAMES.items()], c)


def is_valid_bank_name(name: Column) -> Column:
    low = F.lower(name)
    wrong = low.isin([t for x in P.NOT_BANKS for t in (x, x + "s")])
    known = F.regexp_like(name, F.lit(ci("|".join(f"(?:{p})" for p in P.BANKS))))
    shaped = F.regexp_like(low, F.lit(P.BANK_ENDING)) | F.regexp_like(name, F.lit(P.BANK_OF)) | F.regexp_like(name, F.lit(P.PROPER_NAME))
    return F.coalesce(F.when((F.length(name) < 3) | wrong, F.lit(False)).otherwise(known | shaped), F.lit(False))


def bank_mentions(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """array of (section, bank, raw, roles): per section and raw name its standard name and the roles within 100 characters."""

    def of_section(s: Column, hits: Column) -> Column:
        t = s["text"]
        if strict:
            whole = lambda p: F.regexp_extract_all(t, F.lit((r"\b" if p.isupper() else r"(?i)\b") + f"({p})" + r"\b"), 1)
            known = F.array_distinct(F.flatten(F.array(*[F.when(A.may_match(hits, p), whole(p)).otherwise(F.array().cast("array<string>")) for p in P.BANKS])))
        else:
            known = known_banks(t, hits)

        def with_roles(x: Column) -> Column:
            roles, low = x["roles"], x["low"]
            raw = F.array_distinct(F.concat(known, banks_near(t, roles, low)))

            def one(bank: Column) -> Column:
                around = F.lower(text_around(t, bank, 100, low))
                return F.struct(s["section"].alias("section"), clean_bank_name(bank).alias("bank"), bank.alias("raw"), let(around, lambda a: F.filter(roles, lambda r: F.contains(a, r))).alias("roles"))

            return F.filter(F.transform(raw, one), lambda b: is_valid_bank_name(b["bank"]))

        return let(F.struct(bank_roles(t, hits).alias("roles"), F.lower(t).alias("low")), with_roles)

    # sections overlap; what may be in any of them is looked for once, in the whole text
    return A.within(text, hits, lambda h: F.flatten(F.transform(bank_sections(text, strict), lambda s: of_section(s, h))))


def banks(text: Column, strict: bool = False, hits: Column | None = None) -> Column:
    """array of (bank, roles, sections, raw, confidence), a row per standard name in the order found; raw is the least of the names
    as written, confidence how much of it and the standard name agree (1: all words of one are in the other)."""

    def merge(all_: Column) -> Column:
        names = F.array_distinct(F.transform(all_, lambda b: b["bank"]))

        def one(n: Column) -> Column:
            own = F.filter(all_, lambda b: b["bank"] == n)
            return F.struct(n.alias("bank"), F.array_distinct(F.flatten(F.transform(own, lambda b: b["roles"]))).alias("roles"), F.array_distinct(F.transform(own, lambda b: b["section"])).alias("sections"), F.array_min(F.transform(own, lambda b: b["raw"])).alias("raw"), F.array_max(F.transform(F.array_distinct(F.transform(own, lambda b: F.lower(b["raw"]))), lambda r: token_set_ratio(r, F.lower(n)) / 100)).alias("confidence"))

        return F.transform(names, one)

    return let(bank_mentions(text, strict, hits), merge)


# --- flags ----------------------------------------------------------------------------------------------------------


def validation_flags(n_banks: Column, issue_date: Column, maturity_date: Column, cur: Column, size: Column, rate: Column, kind: Column, n_sections: Column, filename: Column) -> Column:
    flag = lambda c, name: F.when(c, F.lit(name))
    known = reduce(lambda a, b: a | b, [F.contains(F.lower(filename), F.lit(x)) for x in P.RECOGNISED])
    return F.array_compact(
        F.array(
            flag(n_banks == 0, "no_banks_extracted"),
            flag(issue_date.isNull() & maturity_date.isNull(), "no_dates_extracted"),
            flag(cur.isNull() & size.isNull(), "no_currency_info_extracted"),
            flag(rate.isNull() & kind.isNull(), "no_coupon_info_extracted"),
            flag(n_sections == 0, "no_sections_found"),
            flag(~known, "filename_not_recognized"),
        )
    )


def plausibility_flags(issue_date: Column, maturity_date: Column, cur: Column, size: Column, confidence: Column) -> Column:
    """Maturity behind issue, years 1990 to 2050, size and currency there, banks told with confidence 0.85 or more."""
    flag = lambda c, name: F.when(c, F.lit(name))
    i, m = issue_date.try_cast("date"), maturity_date.try_cast("date")
    far = lambda d: ~F.year(d).between(1990, 2050)
    return F.array_compact(F.array(flag(m <= i, "maturity_not_after_issue"), flag(far(i), "issue_date_out_of_range"), flag(far(m), "maturity_date_out_of_range"), flag(cur.isNull() | size.isNull(), "size_or_currency_missing"), flag(confidence < 0.85, "low_bank_confidence")))
