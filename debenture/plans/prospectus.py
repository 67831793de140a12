"""A made-up prospectus for each customer, as one SQL text for Spark and DuckDB: eight ways to write dates, seven of size, nine of
coupon, seven of banks, with and without headings, so that every rule has something to find, to miss or to trip over."""

from __future__ import annotations

_MONTHS = "January February March April May June July August September October November December".split()

#: dialect: (day, month, year parts as text; remainder; pick from a list; long to text)
_WAYS = {
    "spark": {"pick": lambda items, i: f"element_at(array({', '.join(items)}), CAST({i} + 1 AS INT))", "plus": lambda d, n: f"date_add(DATE'{d}', CAST({n} AS INT))"},
    "duckdb": {"pick": lambda items, i: f"([{', '.join(items)}])[CAST({i} + 1 AS INT)]", "plus": lambda d, n: f"(DATE '{d}' + CAST({n} AS INT))"},
}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql(dialect: str, customer: str = "customer", nation: str = "nation") -> str:
    way = _WAYS[dialect]
    pick, plus = way["pick"], way["plus"]
    s = lambda x: f"CAST({x} AS STRING)" if dialect == "spark" else f"CAST({x} AS VARCHAR)"
    two = lambda x: f"lpad({s(x)}, 2, '0')"
    day, month, year = (lambda c, p=p: f"extract({p} FROM {c})" for p in ("day", "month", "year"))
    name = lambda c: pick([_text(m) for m in _MONTHS], f"({month(c)} - 1)")
    slash = lambda c: f"{two(day(c))} || '/' || {two(month(c))} || '/' || {s(year(c))}"
    long = lambda c: f"{s(day(c))} || ' ' || {name(c)} || ' ' || {s(year(c))}"
    short = lambda c: f"{two(f'{year(c)} % 100')}"
    nl = "chr(10)"
    dates = [
        f"'Issue Date: ' || {slash('i')} || {nl} || 'Maturity Date: ' || {slash('m')}",
        f"'Date of Issue: ' || {long('i')} || {nl} || 'Final Maturity: ' || {long('m')}",
        f"'Issuance Date: ' || {s(day('i'))} || 'th ' || {name('i')} || ' ' || {s(year('i'))} || '. The Notes will mature on ' || {long('m')}",
        f"'Issue Date: ' || {name('i')} || ' ' || {s(day('i'))} || ', ' || {s(year('i'))}",
        f"'Prospectus dated ' || {long('i')} || ' relating to Notes due ' || {s(year('m'))}",
        f"'Issue Date: ' || {s(day('i'))} || ' ' || {name('i')} || ' ' || {short('i')} || {nl} || 'Maturity Date: ' || {two(day('m'))} || '/' || {two(month('m'))} || '/' || {short('m')}",
        f"'Issue Date: ' || {two(month('i'))} || '/' || {two(day('i'))} || '/' || {s(year('i'))} || ' and notes maturing on ' || {long('m')}",
        "'The dates are set out in the Conditions'",
    ]
    n = "(k % 900 + 100)"
    code = pick(["'USD'", "'EUR'", "'GBP'", "'CHF'", "'SEK'"], "(k % 5)")
    sizes = [
        f"'Aggregate Nominal Amount: ' || {code} || ' ' || {s(n)} || ',000,000'",
        f"'Issue size: ' || {code} || ' ' || {s('(k % 4 + 1)')} || ' billion'",
        f"'Aggregate Nominal Amount: EUR ' || {s(n)} || ' million'",
        f"'The issue of ' || {code} || ' ' || {s(n)} || ' million'",
        f"'Under the ' || {s('(k % 9 + 2)')} || ' billion Euro Medium Term Note Programme'",
        f"'Principal amount: $ ' || {s(n)} || '.5 m and more in ' || {code}",
        "'The size has yet to be set'",
    ]
    coupons = [
        f"'Coupon: ' || {s('(k % 9)')} || '.625 per cent.'",
        f"'Interest rate: ' || {s('(k % 8)')} || ',25%'",
        f"'The Notes bear interest at ' || {s('(k % 7)')} || '.5%'",
        "'Zero Coupon Notes'",
        f"'Coupon: ' || {s('(k % 15 + 18)')} || '%'",
        "'Floating Rate Notes issued at a discount'",
        f"{s('(k % 6 + 1)')} || '% fixed rate interest'",
        f"'Step-up fixed notes due 2030 with a coupon of ' || {s('(k % 5)')} || '.75 percent'",
        "'No periodic payments'",
    ]
    bank = pick([_text(x) for x in ("Deutsche Bank AG", "J.P. Morgan Securities plc", "BofA Securities", "Société Générale", "Banco Santander S.A.", "HSBC", "Credit Agricole CIB", "the UBS AG")], "(k % 8)")
    other = pick([_text(x) for x in ("BNP Paribas", "Goldman Sachs Group Inc.", "Barclays Capital", "Nomura", "UniCredit", "Danske Bank", "Acme Partners")], "(k % 7)")
    banks = [
        f"'Subscription and Sale. Joint Lead Managers: ' || {bank} || ', ' || {other} || '.'",
        f"'Plan of Distribution' || {nl} || 'The Managers are ' || {bank} || ' and ' || {other} || '. Stabilization is left to ' || {other} || '. Listing in Luxembourg.'",
        f"'Stabilisation Manager: ' || {bank} || '; Fiscal Agent: ' || {other}",
        f"'Placement of the Notes by ' || {bank} || ' as bookrunner. Management: ' || {other} || ' Structuring Advisor. Stabilizing Manager: ' || {bank} || '. Stabilization may end. Listing follows.'",
        f"'Calculation Agent ' || {other} || ' Registrar North Street Partners'",
        f"'Arranger: ' || {bank} || ' (acting as dealer manager)' || {nl} || 'Initial Purchaser ' || {other}",
        "'Nobody has signed yet'",
    ]
    kinds = ["'Final_Terms'", "'Base_Prospectus'", "'Supplement'", "'Annex'", "'Pricing_Note'"]
    case = lambda items, by: f"CASE k % {by} " + " ".join(f"WHEN {j} THEN {x}" for j, x in enumerate(items)) + " END"
    return f"""
SELECT k AS doc_id, c_name AS company, n_name AS country, path AS file_path, kind AS doc_type, i AS issued,
  CASE WHEN k % 97 = 5 THEN '' ELSE
  '  Prospectus ' || {s('k')} || ' of ' || c_name || ' – ' || n_name || {nl} || '\t' || ({case(dates, 8)}) || '.' || {nl}
  || ({case(sizes, 7)}) || '; ' || ({case(coupons, 9)}) || '.' || {nl} || {nl} || ({case(banks, 7)}) || {nl} || 'Page  1 of  2 ' END AS text
FROM (SELECT c_custkey AS k, c_name, n_name, {plus('2012-01-03', 'c_custkey * 7 % 4000')} AS i, {plus('2016-02-05', 'c_custkey * 11 % 9000')} AS m,
    {pick(kinds, '(c_custkey % 5)')} AS kind,
    '/data/' || {s('c_nationkey')} || '/' || c_name || '/' || {pick(kinds, '(c_custkey % 5)')} || '_' || {s('c_custkey')} || '.pdf' AS path
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) AS base
"""
