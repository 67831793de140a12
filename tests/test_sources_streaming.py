"""Files in and out, and streams against their batch twins."""

import json
import zipfile

from pyspark.sql import functions as F

from debenture import jobs as batch
from debenture.functions import extract, registry, text
from debenture.operators import companies, metrics, records, register
from debenture.sources import files, html, pdf
from debenture.streaming import jobs, ledger


def test_names_and_state(spark, tmp_path):
    assert files.read_names(spark, str(tmp_path / "none")).count() == 0
    d = spark.createDataFrame([(" b ",), ("a",), ("a",), ("",)], "name string")
    files.write_names(d, str(tmp_path / "names"))
    assert sorted(r[0] for r in files.read_names(spark, str(tmp_path / "names")).collect()) == ["a", "b"]
    files.bootstrap(spark, str(tmp_path / "state"))
    assert files.read_stats(spark, str(tmp_path / "state/stats")).count() == 0


def test_workbook(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rows = "".join(f'<row r="{i}"><c r="A{i}" t="inlineStr"><is><t>{n}</t></is></c><c r="C{i}" t="s"><v>{k}</v></c></row>' for i, (n, k) in enumerate([("h", 0)] * 4 + [("Acme", 0), ("Foo", 1)], 1))
    with zipfile.ZipFile(tmp_path / "c.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Upstream" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>France</t></si><si><t>Norway</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
    spark.dataSource.register(files.CompanySheet)
    got = spark.read.format("company_sheet").option("path", str(tmp_path / "c.xlsx")).load()
    assert [tuple(r) for r in companies.eligible(got).collect()] == [("Acme", "France", "Active")]
    assert sorted(map(tuple, files.read_sheet(spark, str(tmp_path / "c.xlsx")).collect())) == sorted(map(tuple, got.collect()))


def test_pdf_tiers(spark, tmp_path):
    for name, content in (("a.pdf", b"good " * 30), ("b.pdf", b"thin"), ("c.txt", b"no")):
        (tmp_path / name).write_bytes(content)
    first = lambda b: (1, b.decode())
    second = lambda b: (1, b.decode() + " by eye")
    got = {r["path"][-5:]: r["text"] for r in pdf.document_text(files.pdf_files(spark, str(tmp_path)), [first, second]).collect()}
    assert got == {"a.pdf": ("good " * 30).strip(), "b.pdf": "thin by eye"}
    assert [r[0][-5:] for r in files.pdf_paths(spark, [str(tmp_path), str(tmp_path / "a.pdf")]).collect()] == ["a.pdf", "b.pdf"]


def test_html_by_parser_and_by_pattern(spark):
    page = "<table><tbody><tr><td><span> A </span></td><td>T</td><td>2024</td><td><a href='u'>x</a><a href=\"https://h/f.pdf\">y</a></td></tr><tr><td>only</td></tr></tbody></table>"
    d = spark.createDataFrame([(1, page), (2, None)], "k int, html string")
    assert html.parsed_rows(d, "k", "html").count() == 2
    r = html.result_rows(d, "k", "html").collect()
    assert [(x["issuer_name"], x["doc_type"], x["date"], x["filename"]) for x in r] == [("A", "T", "2024", "u")]


def test_streams_equal_batch(spark, tmp_path):
    rows = [(f"c{i % 3}", "t", f"2024-01-0{i % 5 + 1}", f"text {i % 4}") for i in range(20)]
    d = spark.createDataFrame(rows, "company string, doc_type string, date string, content string")
    d.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for name, df, mode in (("once", jobs.new_contents(stream()), "append"), ("counts", jobs.running_counts(stream()), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert spark.table("once").count() == 4 == spark.table("once").select("sha256").distinct().count()
    assert {tuple(r) for r in spark.table("counts").collect()} == {tuple(r) for r in companies.type_counts(d).collect()}


def test_extract_stream_resumes(spark, tmp_path):
    d = spark.createDataFrame([(1, "a.pdf", "Zero Coupon Notes")], "doc_id long, file_path string, text string")
    d.write.parquet(str(tmp_path / "docs"))
    for _ in range(2):
        s = spark.readStream.schema(d.schema).parquet(str(tmp_path / "docs"))
        jobs.extract_stream(s, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_sql_names(spark):
    registry.register_functions(spark)
    assert spark.sql("SELECT is_final_terms('Final_x.pdf'), output_name('a/b'), normalise_dates('1st/2.3')").first() == (True, "a_b.json", "1-2-3")
    texts = ["a\u00a0 \n€ b ", "Lead Manager: Bank of Foo, per cent.", "", None, "İstanbul manager 3,5 per cent"]
    spark.createDataFrame([(t,) for t in texts], "t string").createOrReplaceTempView("some_texts")
    d = spark.table("some_texts")
    want = d.select(text.clean_text(F.col("t")), text.text_around(F.col("t"), F.lit("Manager"), 5), extract.normalise_coupon(F.col("t"))).collect()
    got = spark.sql("SELECT clean_text(t), text_context(t, 'Manager', 5), normalise_coupon(t) FROM some_texts").collect()
    assert [tuple(r) for r in got] == [(a, b or "", c) for a, b, c in want]
    records.register_extractor("length", F.length)
    try:
        registry.register_views(spark.createDataFrame([(1, "a.pdf", "abc")], "doc_id long, file_path string, text string"))
        assert spark.sql("SELECT length FROM extractions").first()[0] == 3
    finally:
        records.EXTRACTORS.clear()


def test_state_comes_back(spark, tmp_path):
    d = spark.createDataFrame([("s1", "a"), ("s1", "a"), ("s2", "b")], "sha256 string, kept_path string")
    files.write_hashes(d, str(tmp_path / "hashes"))
    assert sorted(map(tuple, files.read_hashes(spark, str(tmp_path / "hashes")).collect())) == [("s1", "a"), ("s2", "b")]
    assert files.read_hashes(spark, str(tmp_path / "none")).count() == 0
    s = companies.stats(spark.createDataFrame([("c", "t", "2024-01-01"), ("c", "u", "2024-02-01")], "company string, doc_type string, date string").withColumn("date", F.to_date("date")))
    files.write_stats(s, str(tmp_path / "stats"))
    back = files.read_stats(spark, str(tmp_path / "stats")).first()
    assert back["total_documents"] == 2 and back["document_types"] == {"t": 1, "u": 1}


def test_a_forgotten_file_is_replaced(spark):
    d = spark.createDataFrame([(1, "new1", "x"), (2, "new2", "x"), (3, "new3", "y")], "seq int, path string, content string")
    index = register.first_by_content(spark.createDataFrame([(0, "old1", "x"), (0, "old3", "y")], "seq int, path string, content string"), F.col("content"), ["seq"]).select("sha256", "path")
    there = spark.createDataFrame([("old3",)], "path string")
    got = {r["path"]: (r["kept_path"], r["is_duplicate"]) for r in register.against_index(d, F.col("content"), ["seq"], index, there).collect()}
    assert got == {"new1": ("new1", False), "new2": ("new1", True), "new3": ("old3", True)}


def test_register_search(spark):
    rows = [{"issuer_name": "A", "doc_type": "t", "date": "d", "url": f"u{i}"} for i in range(5)]
    spark.dataSource.register(files.RegisterSearch)
    read = lambda **o: spark.read.format("register_search").options(fixture=json.dumps({"A": rows, "B": []}), page_size="2", **o).load()
    assert sorted((r["company"], r["page"], r["row"], r["url"]) for r in read().collect()) == [("A", i // 2, i % 2, f"u{i}") for i in range(5)]
    assert read(max_pages="1").count() == 2 and read(companies='["B", "C"]').count() == 0 and read().rdd.getNumPartitions() == 3


def test_links_in_any_quotes(spark):
    d = spark.createDataFrame([(1, "<a href='x/y.pdf'>a</a>"), (2, '<a class="q" href=z.pdf >b</a>'), (3, "<p>"), (4, '<a rel="next" href="?page=2">more</a>')], "k int, html string")
    assert sorted((r["k"], r["url"]) for r in html.first_links(d, "k", "html").collect()) == [(1, "x/y.pdf"), (2, "z.pdf"), (4, "?page=2")]
    assert [r[0] for r in d.select(html.next_page("html")).collect()] == [None, None, None, "?page=2"]
    row = spark.createDataFrame([(1, "<tr><td>A</td><td>t</td><td>d</td><td><a href='u/f.pdf'>f</a></td></tr>")], "k int, html string")
    assert tuple(html.result_rows(row, "k", "html").first()) == (1, 0, "A", "t", "d", "u/f.pdf", "f.pdf")


def test_sessions_start_anew(spark):
    # a request every 30 minutes: the third is not later than an hour, the fourth is
    rows = [("a", i, 1800 * i) for i in range(8)] + [("b", i, i) for i in range(205)]
    log = spark.createDataFrame(rows, "company string, seq long, t long").select("company", "seq", F.timestamp_seconds("t").alias("ts"))
    got = {(r["company"], r["seq"]): (r["session"], r["request"], r["renew"]) for r in metrics.session_marks(log).collect()}
    assert [s for s in range(8) if got["a", s][2]] == [3, 6] and [s for s in range(205) if got["b", s][2]] == [100, 200]
    assert got["a", 7] == (2, 1, False) and got["b", 204] == (2, 4, False)


def test_likeness_of_names(spark):
    pairs = {("bnp paribas", "bnp paribas fortis"): 100, ("bank deutsche", "deutsche bank"): 100, ("santandr", "santander"): 94, ("", "x"): 0, ("jpmorgan chase", "jp morgan chase"): 97, ("ab", "cd"): 0, ("a" * 70 + "b", "a" * 69 + "cb"): 99}
    d = spark.createDataFrame([(*k,) for k in pairs], "a string, b string")
    assert [r[0] for r in d.select(extract.token_set_ratio(F.col("a"), F.col("b"))).collect()] == [*pairs.values()]


def test_bank_functions_in_sql(spark):
    registry.register_functions(spark)
    names = ["the Deutsche Bank AG", "J.P. Morgan Securities plc", "SG", "Bank of Foo", "acme", "O'Neil  Bank"]
    d = spark.createDataFrame([(n,) for n in names], "name string")
    d.createOrReplaceTempView("some_names")
    got = spark.sql("SELECT clean_bank_name(name) AS a, is_valid_bank_name(name) AS b FROM some_names").collect()
    assert got == d.select(extract.clean_bank_name(F.col("name")).alias("a"), extract.is_valid_bank_name(F.col("name")).alias("b")).collect()


def test_a_run_writes_all_it_should(spark, tmp_path):
    text = "Subscription and Sale. Joint Lead Managers: BNP Paribas, Deutsche Bank AG. Coupon: 3.625 per cent."
    docs = spark.createDataFrame([(1, "A/B", "/x/final_terms.pdf", text), (2, "A/B", "/x/other.pdf", ""), (3, "C", "/x/final.pdf", text), (4, "D", "/x/final.pdf", text)], "doc_id long, company string, file_path string, text string")
    names = spark.createDataFrame([(1, "A/B", "France"), (2, "C", "Japan"), (3, "D", "Spain"), (4, "E", "Italy")], "seq long, name string, country string")
    files.write_names(spark.createDataFrame([("D",)], "name string"), str(tmp_path / "processed"))
    got = batch.process(spark, names, str(tmp_path / "processed"), records.extracted(docs), str(tmp_path / "out"), 0).first().asDict()
    # the run is killed as the list of names is to be written, and comes again under its number
    files.write_names(spark.createDataFrame([("D",)], "name string"), str(tmp_path / "processed"))
    again = batch.process(spark, names, str(tmp_path / "processed"), records.extracted(docs), str(tmp_path / "out"), 0).first().asDict()
    assert again == got
    log = ledger.statistics(spark, str(tmp_path / "out/statistics"))
    assert [(r["company"], r["total_documents"]) for r in ledger.by_company(log).collect()] == [("A/B", 2)] and log.next() == 1
    assert got["companies_attempted"] == 2 and got["companies_succeeded"] == 1 and got["documents"] == 2 and got["errors"] == 1
    (written,) = [p for p in (tmp_path / "out/companies").iterdir() if not p.name.startswith(".")]
    document = json.loads(written.read_text())
    assert written.name == "A_B.json" and document["company"] == {"name": "A/B"} and [x["doc_id"] for x in document["documents"]] == [1, 2]
    flat = spark.read.option("header", "true").csv(str(tmp_path / "out/consolidated/sheet"))
    assert flat.columns == records.CONSOLIDATED and spark.read.json(str(tmp_path / "out/consolidated/json")).count() == flat.count() >= 3
    assert "Deutsche Bank AG" not in {r["bank_standard_name"] for r in flat.collect()}
    assert sorted(r[0] for r in files.read_names(spark, str(tmp_path / "processed")).collect()) == ["A/B", "D", "E"]
    metrics.save_metrics(spark.createDataFrame([("a", "found", None, None, 3, "1970-01-01"), ("a", "error", "scraper", "m", 0, "1970-01-01")], "company string, kind string, component string, message string, value int, ts string").withColumns({"seq": F.lit(1), "ts": F.to_timestamp("ts")}), str(tmp_path / "metrics"))
    assert spark.read.text(str(tmp_path / "metrics/report")).first()[0].startswith("  - a: runtime 0 s, found 3")
    assert batch.parser().parse_args(["extract", "--pdf-dir", "a", "--out", "b"]).use_ocr is False
