"""What Spark makes of the queries: no rule is run for a filter, no text is brought into a form twice, no file is one task."""

from pyspark.sql import functions as F

from debenture.functions import extract as E
from debenture.functions import text as T
from debenture.operators import records as R
from debenture.plans import catalog


def nodes(plan):
    yield plan
    for i in range(plan.children().length()):
        yield from nodes(plan.children().apply(i))


def test_banks_are_not_filtered_by_rules(spark):
    plan = catalog.issuance_by_bank(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    conditions = [x.simpleString(1_000_000) for x in nodes(plan) if x.nodeName() in ("Join", "Filter")]
    assert len(conditions) >= 3
    assert not [c[:200] for c in conditions if "regexp" in c.lower() or len(c) > 1000]


def test_bank_rows(spark):
    records = spark.createDataFrame([(1, ["HSBC", "UBS"]), (2, []), (3, None), (4, ["UBS"])], "`a.b` long, extracted_banks array<string>")
    assert sorted(tuple(r) for r in R.bank_rows(records).collect()) == [(1, "HSBC"), (1, "UBS"), (4, "UBS")]


def test_strict_dates_are_dealt_out(spark):
    d = catalog.strict_dates(spark, "/root/testdata/sf0.001")
    assert d.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    # the commas of the strict normal form and the anchors are looked for once for all patterns
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(\d),(?=") == 1


def test_dates_beyond_an_unreadable_one(spark):
    texts = ["Issue Date: 31/02/2022. Prospectus dated 3 March 2021", "Issue Date: 31/02/2022. Issue Date: 1/2/2022", "Issue Date: 31/02/2022", "Prospectus  dated\t3 March 2021", "Issuance Date: March 3, 2021; supplement dated 4/3/2021", "Issue Date: March 33, 2021"]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, s string").withColumn("t", T.clean_text(F.col("s")))
    for strict, expected in ((True, ["2021-03-03", None, None, "2021-03-03", "2021-03-04", None]), (False, ["2021-03-03", None, None, "2021-03-03", "2021-03-04", None])):
        assert [r[0] for r in d.orderBy("i").select(E.dates(F.col("t"), strict)["issue_date"]).collect()] == expected


def test_clean_text_of_clean_text(spark):
    texts = [" a b ", "a  b", "a\x7f b", "\x1ca", "a\tb", "a \u00a0b", "\u00e9", "a b.", " ", "", None]
    d = spark.createDataFrame(list(enumerate(texts)), "i int, s string").orderBy("i")
    assert [tuple(r) for r in d.select(T.clean_text(F.col("s")), T.clean_text(F.col("s"), True)).collect()] == [("a b", "a b"), ("a b", "a b"), ("a\x7f b", "a\x7f b"), ("a", "a"), ("a b", "a b"), ("a b", "a b"), ("", "\u00e9"), ("a b.", "a b."), ("", ""), ("", ""), ("", "")]
