"""Hand-derived expectations of the rules."""

import pytest
from pyspark.sql import functions as F

from debenture.functions import extract as E
from debenture.functions import text as T
from debenture.operators import records as R
from debenture.operators import register as G


def each(spark, values, column):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string").select("i", column(F.col("s")).alias("x")).orderBy("i").collect()
    return [r["x"] for r in rows]


def test_clean_text(spark):
    assert each(spark, ["A € B", "Société Générale", None, "", "a\t\n b c ", "é"], T.clean_text) == ["A  B", "Socit Gnrale", "", "", "a b c", ""]


def test_dates(spark):
    texts = {
        "Issue Date: 15/04/2022\nMaturity Date: 15/04/2027": ("2022-04-15", "2027-04-15", False),
        "Date of Issue: 15 April 2022\nFinal Maturity: 15 April 2027": ("2022-04-15", "2027-04-15", False),
        "Issuance Date: 2022-04-15\nRedemption Date: 2027-04-15": (None, None, False),
        "Issue Date: 15th April, 2022\nMaturity Date: 15th April, 2027": (None, None, False),
        "Issue Date: 04/15/2022": ("2022-04-15", None, False),
        "Maturity Date: 31/12/99": (None, "1999-12-31", False),
        "Issue Date: April 15, 2022": (None, None, True),
        "Notes due 2030": (None, None, False),
        "Issue Date: 5 January 24": ("2024-01-05", None, False),
        "Issue Date: 15 January 24": ("2015-01-15", None, False),
        "Prospectus dated 3 March 2021": ("2021-03-03", None, False),
        "Issue Date: 31/02/2022": (None, None, False),
    }
    assert [tuple(x) for x in each(spark, [*texts], lambda s: E.dates(T.clean_text(s)))] == [*texts.values()]


def test_strict_dates(spark):
    texts = ["Issuance Date: 2022-04-15", "Issue Date: April 15, 2022", "Issue Date: 15 January 24"]
    assert [x["issue_date"] for x in each(spark, texts, lambda s: E.dates(T.clean_text(s), strict=True))] == ["2022-04-15", "2022-04-15", "2024-01-15"]


def test_currency(spark):
    texts = {
        "Issue size: USD 2 billion": ("USD", "2000000000.0"),
        "Aggregate Nominal Amount: USD 500,000,000": ("USD", "500000000000000.0"),
        "Aggregate Nominal Amount: EUR 500 million": ("EUR", "500000000.0"),
        "issue of EUR 750 million": ("EUR", "750000000.0"),
        "EUR 10 billion Euro Medium Term Note Programme": ("EUR", "10000000000.0"),
        "nothing here": (None, None),
        "issue of , and of USD 5 bn": (None, None),
        # a currency stands for itself, with no size behind it; the match after it isn't looked at
        "issue of USD , then": ("USD", None),
        "Issue of EUR ,, notes; issue of GBP 5 million": ("EUR", None),
        "issue of ,, notes; issue of GBP 5 million": ("GBP", "5000000.0"),
        "principal amount: 5 million, in SEK": ("SEK", "5000000.0"),
    }
    got = [(x["currency"], x["issue_size"]) for x in each(spark, [*texts], lambda s: E.currency(T.clean_text(s)))]
    assert got == [*texts.values()]


def test_numbers_read_as_python_prints_them(spark):
    numbers = [5e8, 2.3 * 1e9, 5e15, 5e16, 1.5e17, 0.5 * 1e6, 1e16, 123456789.125]
    d = spark.createDataFrame([(float(x),) for x in numbers], "x double")
    assert [r[0] for r in d.select(E.python_float(F.col("x"))).collect()] == [str(x) for x in numbers]


def test_coupon(spark):
    texts = {
        "Coupon: 3.625 per cent.": ("3.625", "fixed rate"),
        "Interest rate: 3,625%": ("3.625", "fixed rate"),
        "The Notes bear interest at 4.5%": ("4.5", "fixed rate"),
        "Zero Coupon Notes": ("0", "zero coupon"),
        "Coupon: 25%": (None, None),
        "Floating Rate Notes issued at a discount": (None, "floating rate"),
    }
    assert [tuple(x) for x in each(spark, [*texts], E.coupon)] == [*texts.values()]


def test_bank_names(spark):
    raw = {"the Deutsche Bank AG": "Deutsche Bank", "J.P. Morgan Securities plc": "JPMorgan", "BofA Securities": "Bank of America", "Goldman Sachs Group Inc.": "Goldman Sachs Group", "Banco Santander S.A.": "Banco Santander", "Deutsche Telekom": "Deutsche Bank"}
    assert each(spark, [*raw], E.clean_bank_name) == [*raw.values()]
    valid = {"SG": False, "Coupons": False, "listing": True, "Bank of Foo": True, "acme": False, "Foo123": False}
    assert each(spark, [*valid], E.is_valid_bank_name) == [*valid.values()]


def test_banks_and_record(spark):
    text = "Subscription and Sale. Joint Lead Managers: BNP Paribas, Deutsche Bank AG."
    r = R.extracted(spark.createDataFrame([(1, "/x/final.pdf", text), (2, "x.pdf", "hello"), (3, "x.pdf", "é"), (4, "x.pdf", "Issue Date: April 15, 2022"), (5, None, None)], "doc_id long, file_path string, text string")).orderBy("doc_id").collect()
    assert r[0]["extracted_banks"] == ["Deutsche Bank", "BNP Paribas", "ubs"]
    assert {tuple(b["roles"]) for b in r[0]["bank_info"] if b["bank"] != "ubs"} == {("joint lead manager", "joint lead managers")}
    assert all(b["sections"] == ["distribution"] for b in r[0]["bank_info"]) and set(r[0]["sections"]) == {"distribution", "management"}
    assert r[1]["validation_flags"] == ["no_banks_extracted", "no_dates_extracted", "no_currency_info_extracted", "no_coupon_info_extracted", "no_sections_found", "filename_not_recognized"]
    assert r[2]["validation_flags"] == ["text_extraction_failed"] == r[4]["validation_flags"]
    assert r[3]["validation_flags"] == ["processing_error: no such group"] and r[3]["metadata"] is None


def test_sections_go_by_pattern_not_place(spark):
    assert each(spark, ["Placement of the Notes x. Distribution y", "no such"], lambda s: T.find_section(s, "distribution")) == ["Distribution y", None]
    assert each(spark, ["The Managers are A. Management: B"], lambda s: T.find_section(s, "management")) == ["Management: B"]


def test_paths_and_names(spark):
    lit = F.lit
    one = spark.range(1).select(
        G.organised_path(lit("A/B:C"), lit("Final Terms"), lit("2023-06-22"), lit("abcd1234ef")).alias("a"),
        G.organised_path(lit("A"), lit("T"), lit("15/04/2022"), lit("abcd1234ef")).alias("b"),
        G.organised_path(lit(None).cast("string"), lit(""), lit("x"), lit("abcd1234ef"), lit("20240101")).alias("c"),
        G.filename_of_header(lit('attachment; filename="x.pdf"')).alias("d"),
        G.download_name(lit(None).cast("string"), lit("https://h/a/b"), lit(None).cast("string")).alias("e"),
        G.filename_of_url(lit("https://h/"), lit(" link ")).alias("f"),
        G.filename_of_url(lit("https://h"), lit(" link ")).alias("g"),
    ).first()
    assert tuple(one) == ("A_B_C/Final_Terms_20230622_abcd1234.pdf", "A/T_15042022_abcd1234.pdf", "UnknownCompany/UnknownType_20240101_abcd1234.pdf", "x.pdf", "b.pdf", "", "link")


@pytest.mark.parametrize("name, short", [("TotalEnergies SE", "TotalEnergies"), ("Aker BP ASA", "Aker BP"), ("MEDIOBANCA", "MEDIOBANCA"), ("X PLC", "X PLC")])
def test_company_suffix(spark, name, short):
    assert each(spark, [name], T.strip_company_suffix) == [short]


def test_first_by_content(spark):
    d = spark.createDataFrame([(2, "b", "x"), (1, "a", "x"), (3, "c", "y"), (4, "d", None)], "seq int, path string, content string")
    got = {r["path"]: (r["kept_path"], r["is_duplicate"]) for r in G.first_by_content(d, F.col("content"), ["seq"]).filter("sha256 is not null").collect()}
    assert got == {"a": ("a", False), "b": ("a", True), "c": ("c", False)}
