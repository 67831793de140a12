"""The same rules as DuckDB SQL expressions over a column of cleaned text: what the Spark expressions are held against."""

from __future__ import annotations

from debenture.functions import patterns as P

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ci(p: str) -> str:
    return q("(?i)" + p)


def clean(t: str) -> str:
    space = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    return f"trim(regexp_replace(regexp_replace(coalesce({t}, ''), {q(space)}, ' ', 'g'), {q(r'[^\x{00}-\x{7F}]+')}, '', 'g'))"


def first(t: str, p: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({t}, {ci(p)}, {group}), '')"


def start(t: str, p: str) -> str:
    """Place of the first match; null if none."""
    return f"CASE WHEN regexp_matches({t}, {q(p)}) THEN length(regexp_extract({t}, {q('(?s)^(.*?)' + p)}, 1)) + 1 END"


def section(t: str, marker: str, end: str | None = None) -> str:
    low, key = f"lower({t})", marker.lower()
    heads = P.DISTRIBUTION if any(x in key for x in ("distribution", "subscription", "placement", "sale")) else P.MANAGEMENT if any(x in key for x in ("manager", "book", "lead", "underwriter")) else None
    at = "coalesce(" + ", ".join(start(low, p) for p in heads) + ")" if heads else f"nullif(strpos({low}, {q(key)}), 0)"
    if end is None:
        return f"(SELECT nullif(trim(substring({t}, s)), '') FROM (SELECT {at} AS s))"
    stop = f"strpos(substring({low}, s + {len(marker)}), {q(end)})"
    return f"(SELECT nullif(trim(CASE WHEN e > 0 THEN substring({t}, s, {len(marker)} + e - 1) ELSE substring({t}, s) END), '') FROM (SELECT s, {stop} AS e FROM (SELECT {at} AS s)))"


def norm_dates(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, {q(r'[/\\\-.]')}, '-', 'g'), {q(r'(\d+)(?:st|nd|rd|th)')}, {q(r'\1')}, 'g')"


def parsed(s: str) -> str:
    """A subquery that reads a date from text s."""
    num, word = r"^(\d{1,2})-(\d{1,2})-(\d{4}|\d{2})$", r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{2,4})$"
    pad = lambda y, m, d: f"TRY_CAST({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"
    cent = lambda y, pivot: f"((CASE WHEN TRY_CAST({y} AS INT) >= {pivot} THEN '19' ELSE '20' END) || {y})"
    year = f"(CASE WHEN length(c) = 4 THEN c ELSE {cent('c', 69)} END)"
    months = "[" + ", ".join(q(m) for m in MONTHS) + "]"
    named = f"(CASE WHEN length(y) = 4 THEN y WHEN length(d) = 2 THEN {cent('d', 50)} WHEN length(y) = 2 THEN {cent('y', 50)} END)"
    return (
        f"(SELECT CASE WHEN a <> '' THEN coalesce({pad(year, 'b', 'a')}, {pad(year, 'a', 'b')}, CASE WHEN length(c) = 2 AND length(a) = 2 THEN {pad(cent('a', 69), 'b', 'c')} END) "
        f"WHEN d <> '' THEN {pad(named, f'CAST(list_position({months}, lower(n)) AS VARCHAR)', 'd')} END FROM (SELECT "
        + ", ".join(f"regexp_extract(v, {q(num)}, {i}) AS {x}" for i, x in ((1, "a"), (2, "b"), (3, "c")))
        + ", "
        + ", ".join(f"regexp_extract(v, {q(word)}, {i}) AS {x}" for i, x in ((1, "d"), (2, "n"), (3, "y")))
        + f" FROM (SELECT trim({s}) AS v)))"
    )


def dates(rel: str, t: str = "t") -> str:
    """rel(doc_id, t) to (doc_id, issue_date, maturity_date, failed)."""
    issue = "coalesce(" + ", ".join(parsed(first("x", p)) for p in P.ISSUE_DATE[: P.NO_GROUP]) + ")"
    maturity = "coalesce(" + ", ".join(parsed(first("x", p)) for p in P.MATURITY_DATE) + ")"
    return f"""SELECT doc_id, CASE WHEN NOT failed THEN strftime(i, '%Y-%m-%d') END AS issue_date, CASE WHEN NOT failed THEN strftime(m, '%Y-%m-%d') END AS maturity_date, failed
FROM (SELECT doc_id, i, m, i IS NULL AND regexp_matches(x, {ci(P.ISSUE_DATE[P.NO_GROUP])}) AS failed
  FROM (SELECT doc_id, x, {issue} AS i, {maturity} AS m FROM (SELECT doc_id, {norm_dates(t)} AS x FROM ({rel}))))"""


def coupon(rel: str, t: str = "t") -> str:
    norm = f"regexp_replace(regexp_replace(regexp_replace({t}, {q(r'per\s*cent\.?')}, '%', 'g'), {q(r'\s+%')}, '%', 'g'), {q(r'(\d+),(\d+)')}, {q(r'\1.\2')}, 'g')"
    rate = "coalesce(" + ", ".join(f"list_filter(regexp_extract_all(x, {ci(p)}, 1), lambda r: TRY_CAST(r AS DOUBLE) BETWEEN 0 AND 20)[1]" for p in P.COUPON_RATE) + ")"
    kind = "coalesce(" + ", ".join(first("x", f"({p})") for p in P.COUPON_TYPES) + ")"
    return f"""SELECT doc_id, coalesce(r, CASE WHEN contains(k, 'zero') THEN '0' END) AS coupon_rate, k AS coupon_type
FROM (SELECT doc_id, r, CASE WHEN r IS NOT NULL THEN coalesce(k, 'fixed rate') ELSE k END AS k
  FROM (SELECT doc_id, {rate} AS r, regexp_replace(lower(trim({kind})), {q(r'\s+')}, ' ', 'g') AS k FROM (SELECT doc_id, {norm} AS x FROM ({rel}))))"""


def scaled(amount: str, ctx: str) -> str:
    factor = f"(CASE WHEN contains({ctx}, 'billion') OR contains({ctx}, 'bn') THEN 1e9 WHEN contains({ctx}, 'm') THEN 1e6 END)"
    return f"CASE WHEN {factor} IS NULL OR TRY_CAST({amount} AS DOUBLE) IS NULL THEN {amount} ELSE CAST(TRY_CAST({amount} AS DOUBLE) * {factor} AS VARCHAR) END"


def code_in(t: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN regexp_matches({t}, {q(rf'(?i)\b{c}\b')}) THEN {q(c)} END" for c in P.CURRENCY_CODES) + ")"


def symbol_code(g: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN contains({g}, {q(s)}) THEN {q(c)} END" for s, c in P.SYMBOL_TO_CODE.items()) + ")"


def currency_primary(rel: str, t: str = "t") -> str:
    """rel(doc_id, t) to (doc_id, currency, issue_size); nulls where nothing is found."""
    symbol = q("|".join(P.CURRENCY_SYMBOLS))
    norm = f"regexp_replace({t}, {q(rf'\s*([{P.TIGHT}])\s*')}, {q(r'\1')}, 'g')"
    parts = []
    for i, p in enumerate(P.ISSUE_SIZE):
        groups = [1, 2] if p.count("(") - p.count("(?:") == 2 else [1]
        by = ", ".join(f"CASE WHEN regexp_matches(regexp_extract(w, {ci(p)}, {g}), {symbol}) THEN {symbol_code(f'regexp_extract(w, {ci(p)}, {g})')} END" for g in groups)
        amount = f"replace(regexp_extract(w, {q(r'([\d,.]+)')}, 1), ',', '')"
        parts.append(f"SELECT doc_id, {i} AS p, n, coalesce({code_in('w')}, {by}) AS c, nullif({scaled(amount, 'w')}, '') AS s FROM (SELECT doc_id, unnest(a) AS w, generate_subscripts(a, 1) AS n FROM (SELECT doc_id, regexp_extract_all(x, {ci(p)}, 0) AS a FROM x))")
    return f"""WITH d AS ({rel}), x AS (SELECT doc_id, {norm} AS x FROM d), f AS ({' UNION ALL '.join(parts)}),
g AS (SELECT doc_id, c, s, row_number() OVER (PARTITION BY doc_id ORDER BY p, n) AS r FROM f WHERE c IS NOT NULL OR s IS NOT NULL)
SELECT d.doc_id, c AS currency, s AS issue_size FROM d LEFT JOIN g ON g.doc_id = d.doc_id AND r = 1"""


def currency_fallback(rel: str, t: str = "t") -> str:
    parts = []
    for i, p in enumerate(P.AMOUNT_PHRASES):
        p = P.counting_phrase(p)
        either = lambda x, y: f"coalesce(nullif(regexp_extract({t}, {ci(p)}, {x}), ''), regexp_extract({t}, {ci(p)}, {y}))"  # noqa: B023, E731
        parts.append(f"SELECT doc_id, {i} AS p, regexp_extract({t}, {ci(p)}, 0) AS w, {either(1, 3)} AS g, {either(2, 4)} AS a, {start(t, '(?i)' + p).replace('(?s)^(.*?)(?i)', '(?is)^(.*?)')} AS pos, {t} AS t FROM d")
    parts.append(f"SELECT doc_id, 9 AS p, regexp_extract({t}, {ci(P.PROGRAMME)}, 0) AS w, 'EUR' AS g, regexp_extract({t}, {ci(P.PROGRAMME)}, 1) AS a, 1 AS pos, {t} AS t FROM d")
    exact = "CASE " + " ".join(f"WHEN upper(g) = {q(c)} THEN {q(c)}" for c in P.CURRENCY_CODES) + " END"
    near = code_in("substring(t, greatest(pos - 50, 1), pos + length(w) + 50 - greatest(pos - 50, 1))")
    amount = scaled("replace(a, ',', '')", "lower(w)")
    return f"""WITH d AS ({rel}), f AS ({' UNION ALL '.join(parts)}),
g AS (SELECT doc_id, coalesce({exact}, {symbol_code('g')}, CASE WHEN replace(a, ',', '') <> '' THEN {near} END) AS c, nullif({amount}, '') AS s, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS r FROM f WHERE w <> '')
SELECT d.doc_id, c AS currency, s AS issue_size FROM d LEFT JOIN g ON g.doc_id = d.doc_id AND r = 1"""


def currency(rel: str, t: str = "t") -> str:
    return f"""SELECT a.doc_id, coalesce(a.currency, b.currency) AS currency, coalesce(a.issue_size, b.issue_size) AS issue_size
FROM ({currency_primary(rel, t)}) a JOIN ({currency_fallback(rel, t)}) b ON a.doc_id = b.doc_id"""


def matches(t: str, patterns: list[str]) -> str:
    return "flatten([" + ", ".join(f"regexp_extract_all({t}, {ci(f'({p})')}, 1)" for p in patterns) + "])"


def around(t: str, target: str, window: int) -> str:
    at = f"strpos(lower({t}), lower({target}))"
    return f"CASE WHEN {at} > 0 AND {target} <> '' THEN substring({t}, greatest({at} - {window}, 1), {at} + length({target}) + {window} - greatest({at} - {window}, 1)) ELSE '' END"


def bank_name(b: str) -> str:
    c = f"trim(regexp_replace(regexp_replace(regexp_replace({b}, {ci(P.BANK_SUFFIX)}, ''), {ci(P.BANK_PREFIX)}, ''), {q(r'\s+')}, ' ', 'g'))"
    names = ", ".join(f"CASE WHEN lower(c) = {q(o)} OR starts_with(lower(c), {q(o + ' ')}) THEN {q(n)} END" for o, n in P.BANK_NAMES.items())
    return f"(SELECT coalesce({names}, c) FROM (SELECT {c} AS c))"


def bank_valid(b: str) -> str:
    wrong = ", ".join(q(t) for x in P.NOT_BANKS for t in (x, x + "s"))
    known = ci("|".join(f"(?:{p})" for p in P.BANKS))
    return f"(length({b}) >= 3 AND lower({b}) NOT IN ({wrong}) AND (regexp_matches({b}, {known}) OR regexp_matches(lower({b}), {q(P.BANK_ENDING)}) OR regexp_matches({b}, {q(P.BANK_OF)}) OR regexp_matches({b}, {q(P.PROPER_NAME)})))"


def sections(rel: str, t: str = "t") -> str:
    """rel(doc_id, t) to (doc_id, section, text): where banks are looked for."""
    found = " UNION ALL ".join(f"SELECT doc_id, {q(s)} AS section, {section(t, s)} AS text FROM d" for s in ("distribution", "management", "stabilisation"))
    return f"""WITH d AS (SELECT * FROM ({rel}) WHERE {t} <> ''), s AS (SELECT * FROM ({found}) WHERE text IS NOT NULL)
SELECT * FROM s UNION ALL SELECT doc_id, 'full_text', {t} FROM d WHERE doc_id NOT IN (SELECT doc_id FROM s)"""


def roles(rel: str) -> str:
    """(doc_id, section, text) to the same and role, a row each."""
    return f"SELECT DISTINCT doc_id, section, text, trim(lower(unnest({matches('text', P.BANK_ROLES)}))) AS role FROM ({rel})"


def known(rel: str) -> str:
    return f"SELECT DISTINCT doc_id, section, text, unnest({matches('text', P.BANKS)}) AS raw FROM ({rel})"


def near(rel: str) -> str:
    ctx = f"SELECT doc_id, section, text, {around('text', 'role', 100)} AS a FROM ({roles(rel)})"
    good = f"length(trim(a)) >= 3 AND NOT regexp_matches(a, {ci(P.CONTEXT_STOP)})"
    return f"SELECT DISTINCT doc_id, section, text, raw FROM (SELECT doc_id, section, text, unnest(regexp_extract_all(a, {q(P.CAPITALISED)}, 0)) AS raw FROM ({ctx}) WHERE {good}) WHERE NOT regexp_matches(raw, {q(P.CANDIDATE_STOP)})"


def token_set(a: str, b: str) -> str:
    """The likeness of two texts by their words, 0 to 100; of texts of 62 characters or fewer."""
    bits = lambda x, y: f"list_transform(string_split({x}, ''), lambda c: list_sum(list_transform(range(length({y})), lambda i: CASE WHEN substring({y}, i + 1, 1) = c THEN 1::BIGINT << i ELSE 0 END))::BIGINT)"
    full = lambda y: f"((1::BIGINT << length({y})) - 1)"
    both = lambda x, y: f"(CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0 ELSE length({y}) - bit_count(list_reduce({bits(x, y)}, lambda v, m: ((v + (v & m)) | (v & ~m)) & {full(y)}, {full(y)})) END)"
    like = lambda x, y: f"round_even(200 * {both(x, y)} / greatest(length({x}) + length({y}), 1), 0)"
    words = lambda c: f"list_sort(list_distinct(list_filter(regexp_split_to_array({c}, {q(r'\s+')}), lambda w: w <> '')))"
    return f"""(SELECT CASE WHEN len(i) > 0 AND (len(x) = 0 OR len(y) = 0) THEN 100 WHEN len(i) = 0 THEN {like('o', 't')} ELSE greatest({like('c', 'o')}, {like('c', 't')}, {like('o', 't')}) END::DOUBLE
 FROM (SELECT i, x, y, array_to_string(i, ' ') AS c, array_to_string(list_concat(i, x), ' ') AS o, array_to_string(list_concat(i, y), ' ') AS t
  FROM (SELECT list_filter(k, lambda w: list_contains(l, w)) AS i, list_filter(k, lambda w: NOT list_contains(l, w)) AS x, list_filter(l, lambda w: NOT list_contains(k, w)) AS y FROM (SELECT {words(a)} AS k, {words(b)} AS l))))"""


def raw_names(rel: str, t: str = "t") -> str:
    """rel(doc_id, t) to (doc_id, bank, raw, confidence)."""
    s = sections(rel, t)
    return f"""SELECT doc_id, bank, min(raw) AS raw, max({token_set('lower(raw)', 'lower(bank)')} / 100) AS confidence FROM (
 WITH s AS MATERIALIZED ({s}) SELECT doc_id, raw, {bank_name('raw')} AS bank FROM ({known('SELECT * FROM s')} UNION {near('SELECT * FROM s')})) WHERE {bank_valid('bank')} GROUP BY doc_id, bank"""


def mentions(rel: str, t: str = "t") -> str:
    """rel(doc_id, t) to (doc_id, section, bank, role): role null where a bank has none."""
    s = sections(rel, t)
    return f"""WITH s AS MATERIALIZED ({s}), raw AS ({known('SELECT * FROM s')} UNION {near('SELECT * FROM s')}),
b AS (SELECT doc_id, section, text, raw, {bank_name('raw')} AS bank FROM raw),
v AS (SELECT doc_id, section, bank, lower({around('text', 'raw', 100)}) AS a FROM b WHERE {bank_valid('bank')}),
r AS ({roles('SELECT * FROM s')})
SELECT DISTINCT v.doc_id, v.section, v.bank, r.role FROM v LEFT JOIN r ON r.doc_id = v.doc_id AND r.section = v.section AND contains(v.a, r.role)"""


def places(t: str, p: str) -> str:
    """A list of structs (low, high, value) of a pattern's matches in t."""
    lens = f"list_transform(regexp_split_to_array({t}, {q(p)}), lambda x: length(x))"
    found = f"regexp_extract_all({t}, {q(p)}, 0)"
    return f"""(SELECT list_transform(range(1, len(m) + 1), lambda i: {{'low': 1 + list_sum(g[1:i]) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'high': 1 + list_sum(g[1:i]) + list_sum(list_transform(m[1:i], lambda x: length(x))), 'value': m[i]}})
 FROM (SELECT {lens} AS g, {found} AS m))"""


def roles_by_place(rel: str, names: str, roles_: str, window: int = 100) -> str:
    """rel(doc_id, t): each place of a name against each place of a role in its section, by strict sections."""
    heads = {"distribution": P.DISTRIBUTION, "management": P.MANAGEMENT, "stabilisation": [r"stabili[sz]ation"]}
    at = lambda s: "coalesce(" + ", ".join(start("lower(t)", p) for p in heads[s]) + ")"
    spans = " UNION ALL ".join(
        f"SELECT doc_id, t, '{s}' AS section, a AS first, CASE WHEN strpos(substring(lower(t), a + {len(s)}), 'listing') > 0 THEN a + {len(s)} + strpos(substring(lower(t), a + {len(s)}), 'listing') - 1 ELSE length(t) + 1 END AS last FROM (SELECT doc_id, t, {at(s)} AS a FROM d) WHERE a IS NOT NULL"
        for s in heads
    )
    return f"""WITH d AS MATERIALIZED (SELECT * FROM ({rel}) WHERE t <> ''), s AS MATERIALIZED ({spans}),
f AS (SELECT * FROM s UNION ALL SELECT doc_id, t, 'full_text', 1, length(t) + 1 FROM d WHERE doc_id NOT IN (SELECT doc_id FROM s)),
n AS MATERIALIZED (SELECT doc_id, unnest({places('t', names)}) AS x FROM d), r AS MATERIALIZED (SELECT doc_id, unnest({places('t', roles_)}) AS y FROM d),
b AS (SELECT f.doc_id, section, first, last, {bank_name('x.value')} AS bank, x.low AS low, x.high AS high FROM f JOIN n ON n.doc_id = f.doc_id AND x.low >= first AND x.high <= last),
v AS MATERIALIZED (SELECT * FROM b WHERE {bank_valid('bank')}),
p AS (SELECT v.doc_id, section, bank, trim(lower(y.value)) AS role, count(*) AS n, min(greatest(y.low - high, low - y.high, 0))::INT AS distance
  FROM v JOIN r ON r.doc_id = v.doc_id AND y.low >= greatest(low - {window}, first) AND y.high <= least(high + {window}, last) GROUP BY ALL)
SELECT * FROM p UNION ALL SELECT doc_id, section, bank, NULL, count(*), NULL FROM v WHERE (doc_id, section, bank) NOT IN (SELECT (doc_id, section, bank) FROM p) GROUP BY doc_id, section, bank"""
