"""The named queries: each a function of (spark, folder of tables), with its DuckDB twin in `oracles`."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debenture.functions import extract as E
from debenture.functions import patterns as P
from debenture.functions import text as T
from debenture.operators import companies as C
from debenture.operators import concordance, mentions, names, pages
from debenture.operators import metrics as M
from debenture.operators import records as R
from debenture.operators import register as G
from debenture.streaming import ledger
from debenture.working import saved, shared_dir, working

from . import prospectus


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A small file is one split; rules cost milliseconds a text, so where there are fewer splits than cores the texts are dealt out
    first. What has enough splits isn't moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows that long work is done on, dealt out evenly: a Parquet file's rows go to the splits that hold the middle of its row
    groups, so of a file's splits a few or one may have all rows."""
    return df.repartition(4 * max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism))


def prospectuses(spark: SparkSession, sf: str) -> DataFrame:
    view = {"c": spread(table(spark, sf, "customer")), "n": table(spark, sf, "nation")}
    return spark.sql(prospectus.sql("spark", "{c}", "{n}"), **view)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return prospectuses(spark, sf).withColumn("t", T.clean_text(F.col("text")))


def register(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as register rows: every seventh url is told twice, every eleventh is missing."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey").cast("string")
    return o.select(
        F.col("o_orderkey").alias("seq"), F.col("c_name").alias("company"), F.substring("o_orderpriority", 3, 20).alias("doc_type"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
        F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(F.concat(F.lit("https://register.example/docs/"), F.floor(F.col("o_orderkey") / 7).cast("string"), F.lit("/file_"), F.floor(F.col("o_orderkey") / 7).cast("string"), F.when(F.col("o_orderkey") % 3 == 0, ".pdf?v=1").otherwise("#top"))).alias("url"),
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit('attachment; filename="Doc '), k, F.lit('.PDF"'))).when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("attachment; filename=raw"), k)).alias("header"),
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {"click": "found", "view": "download", "purchase": "cache", "signup": "end"}
    e = table(spark, sf, "events")
    kind = F.coalesce(F.when((F.col("event_type") == "signup") & (F.col("event_id") % 10 == 0), F.lit("bot")), *[F.when(F.col("event_type") == a, F.lit(b)) for a, b in kinds.items()], F.lit("error"))
    component = F.element_at(F.array(*[F.lit(x) for x in [*P.ERROR_COMPONENTS, "general"]]), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(F.col("event_id").alias("seq"), F.concat(F.lit("company "), (F.col("user_id") % 50).cast("string")).alias("company"), kind.alias("kind"), component.alias("component"), F.concat(F.lit("failure "), F.col("event_id").cast("string")).alias("message"), (F.col("event_id") % 7).alias("value"), "ts")


# --- text and sections ----------------------------------------------------------------------------------------------


def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


def clean_prospectus(spark, sf):
    return cleaned(spark, sf).select("doc_id", F.col("t").alias("clean"))


def find_section_distribution(spark, sf):
    return cleaned(spark, sf).select("doc_id", T.find_section(F.col("t"), "distribution", "stabilization").alias("section"))


def extract_sections(spark, sf):
    return cleaned(spark, sf).select("doc_id", F.explode(T.document_sections(F.col("t"))).alias("section", "body"))


def bank_sections(spark, sf):
    return cleaned(spark, sf).select("doc_id", F.explode(T.bank_sections(F.col("t"))).alias("s")).select("doc_id", "s.section", F.col("s.text").alias("body"))


def text_context(spark, sf):
    return cleaned(spark, sf).select("doc_id", T.text_around(F.col("t"), F.lit("Manager"), 50).alias("context"))


# --- fields ---------------------------------------------------------------------------------------------------------


def dates_issue_maturity(spark, sf):
    return cleaned(spark, sf).select("doc_id", E.dates(F.col("t")).alias("d")).select("doc_id", "d.*")


def date_parse_matrix(spark, sf):
    d = F.col("o_orderdate")
    ways = [F.date_format(d, x) for x in ("dd-MM-yyyy", "d-M-yyyy", "dd-MM-yy", "MM-dd-yyyy", "MM-dd-yy", "yy-MM-dd", "d MMMM yyyy", "dd MMMM yyyy", "d MMMM yy")]
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), F.posexplode(F.array(*ways)).alias("way", "s")).select("seq", "way", E.parse_date(F.col("s")).cast("string").alias("parsed"))


def currency_primary(spark, sf):
    return cleaned(spark, sf).select("doc_id", E.currency_primary(F.col("t")).alias("c")).select("doc_id", "c.currency", "c.issue_size")


def currency_fallback(spark, sf):
    return cleaned(spark, sf).select("doc_id", E.currency_fallback(F.col("t")).alias("c")).select("doc_id", "c.currency", "c.issue_size")


def currency_full(spark, sf):
    return cleaned(spark, sf).select("doc_id", E.currency(F.col("t")).alias("c")).select("doc_id", "c.currency", "c.issue_size")


def programme_size(spark, sf):
    whole = F.regexp_extract("t", T.ci(P.PROGRAMME), 0)
    return cleaned(spark, sf).filter(whole != "").select("doc_id", E.scaled(F.replace(F.regexp_extract("t", T.ci(P.PROGRAMME), 1), F.lit(","), F.lit("")), F.lower(whole)).alias("size"))


def coupon(spark, sf):
    return cleaned(spark, sf).select("doc_id", E.coupon(F.col("t")).alias("c")).select("doc_id", "c.*")


# --- banks ----------------------------------------------------------------------------------------------------------


def _sections(spark, sf):
    return cleaned(spark, sf).select("doc_id", F.explode(T.bank_sections(F.col("t"))).alias("s")).select("doc_id", "s.section", F.col("s.text").alias("body"))


def bank_roles(spark, sf):
    return _sections(spark, sf).select("doc_id", "section", F.explode(E.bank_roles(F.col("body"))).alias("role"))


def bank_known_names(spark, sf):
    return _sections(spark, sf).select("doc_id", "section", F.explode(E.known_banks(F.col("body"))).alias("raw"))


def bank_near_roles(spark, sf):
    return _sections(spark, sf).withColumn("roles", E.bank_roles(F.col("body"))).select("doc_id", "section", F.explode(E.banks_near(F.col("body"), F.col("roles"))).alias("raw"))


def bank_clean_name(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    return _names(s).select("k", "raw", E.clean_bank_name(F.col("raw")).alias("bank"))


RAW_NAMES = ["the Deutsche Bank AG", "J.P. Morgan Securities plc", "BofA Securities", "Goldman Sachs Group Inc.", "Banco Santander S.A.", "Deutsche Telekom", "by  Nomura  Ltd.", "RBC Capital Markets", "BNP", "Foo & Co", "SG", "Coupons", "listing", "Bank of Foo", "acme", "Foo123", "north Partners", "Amount", "issuers"]


def _names(s: DataFrame) -> DataFrame:
    return s.select("k", F.concat(F.element_at(F.array(*[F.lit(x) for x in RAW_NAMES]), (F.col("k") % len(RAW_NAMES) + 1).cast("int")), F.when(F.floor(F.col("k") / len(RAW_NAMES)) % 3 == 1, F.lit(" plc")).otherwise(F.lit(""))).alias("raw"))


def bank_valid_name(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    return _names(s).select("k", "raw", E.is_valid_bank_name(F.col("raw")).alias("valid"))


def bank_role_section(spark, sf):
    m = cleaned(spark, sf).select("doc_id", F.explode(E.bank_mentions(F.col("t"))).alias("b"))
    return m.select("doc_id", "b.section", "b.bank", F.explode_outer("b.roles").alias("role")).distinct().withColumn("rest", F.count("role").over(_by("doc_id", "section", "bank"))).filter("role is not null or rest = 0").drop("rest")


def _by(*cols):
    from pyspark.sql import Window

    return Window.partitionBy(*cols)


def bank_roles_by_place(spark, sf):
    """The strict rule: every place of a name, not the first one's surroundings."""
    # the texts are made here; dealt out once, they aren't made anew for each rule
    return mentions.bank_roles_by_place(cleaned(spark, sf).select("doc_id", "t").repartition("doc_id"))


def banks_by_role(spark, sf):
    return bank_role_section(spark, sf).groupBy(F.coalesce("role", F.lit("Unknown")).alias("role"), "bank").agg(F.countDistinct("doc_id").alias("n_documents"))


def standard_bank_names(spark, sf):
    """Aliases to the letter, else the alias whose words are most like the name's, from 85 on."""
    names = _names(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))).select("k", F.lower(E.clean_bank_name(F.col("raw"))).alias("name"))
    best = names.withColumn("best", E.standard_bank(F.col("name"), ALIASES)).filter("best is not null")
    return best.select("k", "name", F.col("best.standard").alias("standard"), (F.col("best.score") / 100).alias("confidence"))


def names_by_alias_table(spark, sf):
    """Part names, turned round, cut short or longer, against a table of parts."""
    k, n = F.col("p_partkey"), F.lower("p_name")
    made = F.when(k % 4 == 0, F.array_join(F.reverse(F.split(n, " ")), " ")).when(k % 4 == 1, F.regexp_replace(n, "e", "")).when(k % 4 == 2, F.concat(n, F.lit(" company"))).otherwise(n)
    p = table(spark, sf, "part")
    return names.standardised(p.select(made.alias("name")), p.select(n.alias("alias"), F.col("p_brand").alias("standard")))


def bank_confidence_tiers(spark, sf):
    d = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.lower(F.replace("s_name", F.lit("Supplier#"), F.lit("paribas bank "))).alias("name"))
    score = F.array_max(F.array(*[E.token_set_ratio(F.col("name"), F.lit(a)) for xs in ALIASES.values() for a in xs]))
    return d.withColumn("confidence", score / 100).withColumn("tier", E.confidence_tier(F.col("confidence")))


def bank_lists_by_role(spark, sf):
    d = bank_role_section(spark, sf).select(F.coalesce("role", F.lit("Unknown")).alias("role"), "bank").distinct()
    return d.groupBy("role").agg(F.array_join(F.sort_array(F.collect_set("bank")), "|").alias("banks"))


ALIASES = {"BNP Paribas": ["bnp", "bnp paribas"], "Deutsche Bank": ["deutsche bank", "db"], "JPMorgan": ["jpmorgan", "jp morgan chase"], "Banco Santander": ["banco santander", "santander"], "Goldman Sachs": ["goldman sachs", "goldman sachs group"]}


# --- records --------------------------------------------------------------------------------------------------------


def _records(spark, sf):
    return R.extracted(prospectuses(spark, sf))


def validation_flags(spark, sf):
    return _records(spark, sf).select("doc_id", F.array_join("validation_flags", ",").alias("flags"))


def extraction_record(spark, sf):
    return _records(spark, sf).select("doc_id", "filename", "metadata.*", F.array_join(F.sort_array("extracted_banks"), "|").alias("banks"), F.array_join("validation_flags", ",").alias("flags"))


def consolidated_flat(spark, sf):
    return R.consolidated(_records(spark, sf))


def typed_record(spark, sf):
    t = R.typed(_records(spark, sf))
    return t.select("doc_id", F.col("issue_date").cast("string").alias("issue_date"), F.col("maturity_date").cast("string").alias("maturity_date"), F.col("issue_size").cast("double").alias("issue_size"), "currency", F.col("coupon_rate").cast("double").alias("coupon_rate"))


def issuance_by_currency_year(spark, sf):
    t = R.typed(_records(spark, sf))
    return t.groupBy("currency", F.year("issue_date").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum("issue_size").cast("double").alias("size"))


def issuance_by_bank(spark, sf):
    r = _records(spark, sf).select("extracted_banks", F.col("metadata.issue_size").try_cast("double").cast("decimal(38,2)").alias("size"))
    return R.bank_rows(r).groupBy("bank").agg(F.count("*").alias("n"), F.sum("size").cast("double").alias("size"))


def flag_summary(spark, sf):
    """Flags per document, in a line of 27 characters at most, and numbers of flags and banks."""
    joined = F.array_join("validation_flags", ", ")
    line = F.when(F.size("validation_flags") == 0, "None").when(F.length(joined) > 27, F.concat(F.substring(joined, 1, 27), F.lit("..."))).otherwise(joined)
    return _records(spark, sf).select("doc_id", line.alias("line"), F.size("validation_flags").cast("long").alias("n_flags"), F.coalesce(F.size("extracted_banks"), F.lit(0)).cast("long").alias("n_banks"))


def plausibility(spark, sf):
    r = _records(spark, sf)
    flags = E.plausibility_flags(F.col("metadata.issue_date"), F.col("metadata.maturity_date"), F.col("metadata.currency"), F.col("metadata.issue_size"), F.array_min(F.transform("bank_info", lambda b: b["confidence"])))
    return r.select("doc_id", F.array_join(flags, ",").alias("flags"))


def run_summary(spark, sf):
    r = _records(spark, sf)
    bad = F.exists("validation_flags", lambda f: (f == "text_extraction_failed") | F.startswith(f, F.lit("processing_error")))
    return r.agg(F.countDistinct("company").alias("companies_attempted"), F.countDistinct(F.when(~bad, F.col("company"))).alias("companies_succeeded"), F.count("*").alias("documents"), F.count_if(bad).alias("errors"))


# --- names and paths ------------------------------------------------------------------------------------------------


def final_terms_filter(spark, sf):
    return prospectuses(spark, sf).select("doc_id", G.filename_of_path(F.col("file_path")).alias("filename")).filter(G.is_final_terms(F.col("filename")))


def filename_recognised(spark, sf):
    d = prospectuses(spark, sf).select("doc_id", G.filename_of_path(F.col("file_path")).alias("filename"))
    return d.select("doc_id", "filename", G.is_recognised(F.col("filename")).alias("recognised"))


def filename_from_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", G.filename_of_url(F.col("url")).alias("filename"))


def filename_from_header(spark, sf):
    return register(spark, sf).select("seq", G.download_name(F.col("header"), F.col("url"), F.when(F.col("seq") % 2 == 0, F.col("seq").cast("string"))).alias("filename"))


def organized_path(spark, sf):
    return register(spark, sf).select("seq", G.organised_path(F.concat("company", F.lit("/A:B")), F.col("doc_type"), F.when(F.col("seq") % 13 > 0, F.col("date")), F.sha2(F.col("url"), 256), F.lit("20240101")).alias("path"))


def path_collisions(spark, sf):
    r = register(spark, sf).withColumn("sha256", F.sha2("url", 256))
    return G.path_collisions(r.withColumn("path", G.organised_path(F.col("company"), F.col("doc_type"), F.lit("2024"), F.lit("00000000"), F.lit("20240101"))))


def output_filename(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", G.output_name(F.concat("c_name", F.lit("/x"))).alias("filename"))


def document_id_md5(spark, sf):
    return register(spark, sf).select("seq", G.joined_md5(F.col("url"), F.col("company"), F.col("doc_type"), F.when(F.col("seq") % 4 > 0, F.col("date"))).alias("id"))


def document_hash_md5(spark, sf):
    return register(spark, sf).select("seq", G.joined_md5(F.col("company"), F.col("doc_type"), F.col("date")).alias("id"), F.md5("url").alias("url_id"))


def content_sha256(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


def content_dedup(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    return G.first_by_content(d, F.col("text"), ["doc_id"]).select("doc_id", "sha256", "kept_path", "is_duplicate")


def url_dedup(spark, sf):
    return G.first_by_url(register(spark, sf), ["seq"]).select("company", "url", "seq")


# --- companies ------------------------------------------------------------------------------------------------------


def _companies(spark, sf, side="customer"):
    c, n = table(spark, sf, side), table(spark, sf, "nation")
    p = side[0]
    return c.join(n, F.col(f"{p}_nationkey") == F.col("n_nationkey")).select(F.col(f"{p}_{'custkey' if p == 'c' else 'suppkey'}").alias("seq"), F.col(f"{p}_name").alias("name"), F.element_at(F.array(*[F.lit(x) for x in [*P.EU_COUNTRIES, "Norway", "United Kingdom", "Japan"]]), (F.col("n_nationkey") * 7 % 30 + 1).cast("int")).alias("country"))


def eu_company_filter(spark, sf):
    return C.eligible(_companies(spark, sf))


def unprocessed_companies(spark, sf):
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("name"))
    return C.unprocessed(_companies(spark, sf), done)


def downloaded_documents(spark, sf):
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id")).filter("doc_id % 3 = 0")
    return C.downloaded(table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("status")), done)


def company_lookup_ci(spark, sf):
    names = table(spark, sf, "supplier").select(F.upper(F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))).alias("wanted")).distinct()
    return C.lookup(_companies(spark, sf), names).select("wanted", "seq", "name", "country")


def company_suffix_strip(spark, sf):
    c = table(spark, sf, "customer")
    name = F.concat("c_name", F.element_at(F.array(*[F.lit(x) for x in [*P.COMPANY_SUFFIXES, "", " PLC", " SE AG"]]), (F.col("c_custkey") % 12 + 1).cast("int")))
    return c.select("c_custkey", T.strip_company_suffix(name).alias("name"))


def company_type_counts(spark, sf):
    return C.type_counts(register(spark, sf)).select("company", "doc_type", "n", "last_updated")


def company_stats(spark, sf):
    s = C.stats(register(spark, sf).withColumn("date", F.to_date("date", "dd/MM/yyyy")))
    return s.select("company", "total_documents", "last_updated", F.explode("document_types").alias("doc_type", "n"))


def docs_top5_per_company(spark, sf):
    return C.first_per_company(register(spark, sf)).select("company", "seq", F.col("rank").cast("long").alias("rank"))


def first_companies(spark, sf):
    return _companies(spark, sf).orderBy("seq").limit(5)


def first_companies_override(spark, sf):
    return C.first_n(_companies(spark, sf), 5, first={"name": "Aker BP ASA", "country": "Norway"})


def mock_fallback_lookup(spark, sf):
    r = register(spark, sf).select("company", F.col("company").alias("issuer"), "seq")
    default = spark.createDataFrame([("default", "Default", -1), ("default", "Default", -2)], "company string, issuer string, seq long")
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return C.with_fallback(c, r.unionByName(default)).select("name", "issuer", "seq")


def cache_lookup(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    i = table(spark, sf, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("/cache/"), F.col("o_orderkey").cast("string")).alias("cache_path"))
    f = i.filter("doc_id % 2 = 0").select(F.col("cache_path").alias("path"))
    return G.cached(d, i, f).select("doc_id", "cache_path", "cache_hit")


def cache_inserts(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return G.new_cache_entries(d, d.filter("doc_id % 3 = 0"))


def company_documents(spark, sf):
    """Documents per company, with companies that have none."""
    r = register(spark, sf)
    return _companies(spark, sf).join(r, F.col("name") == F.col("company"), "left").groupBy("name").agg(F.count("url").alias("n"))


def processed_names_sorted(spark, sf):
    """Progress as it is written: trimmed, distinct, in order."""
    return table(spark, sf, "customer").select(F.trim(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).alias("name")).distinct().orderBy("name")


# --- metrics --------------------------------------------------------------------------------------------------------


def run_counters(spark, sf):
    return M.counters(run_log(spark, sf))


def success_rate(spark, sf):
    return M.success_rates(run_log(spark, sf))


def error_rollup(spark, sf):
    return M.error_rollup(run_log(spark, sf))


def error_top5(spark, sf):
    return M.error_top(run_log(spark, sf)).select("component", F.col("rank").cast("long").alias("rank"), "message", F.col("more").cast("long").alias("more"))


def session_budget(spark, sf):
    return M.session_marks(run_log(spark, sf)).select("company", "seq", "session", "request", "age_s", "renew")


def batch_totals(spark, sf):
    return M.batch_totals(run_log(spark, sf))


def metrics_report(spark, sf):
    return M.report(run_log(spark, sf))


def required_fields(spark, sf):
    """How many register rows have an id and a url, as all that is downloaded must."""
    r = register(spark, sf).withColumn("doc_id", F.when(F.col("seq") % 4 > 0, F.col("seq")))
    return r.agg(F.count("*").alias("n"), F.count_if(G.has_required(["doc_id", "url"])).alias("kept"))


def dry_run_stats(spark, sf):
    """Files that the organiser would move, skip (told before) and fail on (no url)."""
    return G.dry_run(register(spark, sf), ["company", "url"], F.col("url") == "")


def first_date_matches(spark, sf):
    """The first three dates of each document, by pattern, then place."""
    found = F.slice(E.all_matches(F.col("text"), P.DATE_STRINGS), 1, 3)
    return prospectuses(spark, sf).select("doc_id", F.posexplode(found).alias("nr", "found"))


def content_against_index(spark, sf):
    """Files looked up in an index of contents, of which some files are gone."""
    d = table(spark, sf, "documents").filter("text is not null").select("doc_id", "text", F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    i = G.first_by_content(d.filter("doc_id % 2 = 0"), F.col("text"), ["doc_id"]).filter("not is_duplicate").select("sha256", "path")
    there = i.filter("path not like '%4'").select("path")
    return G.against_index(d, F.col("text"), ["doc_id"], i, there).select("doc_id", "sha256", "kept_path", "is_duplicate")


def retry_delays(spark, sf):
    return spark.range(6).select(F.col("id").alias("attempt"), M.retry_delay(F.col("id")).alias("seconds"))


# --- pages and diagnostics ------------------------------------------------------------------------------------------


def html_links(spark, sf):
    from debenture.sources import html

    return html.first_links(table(spark, sf, "pages"), "page_id", "html")


def result_pages(spark, sf):
    """Register rows as pages of results, 20 keys to a page."""
    r = register(spark, sf)
    cell = lambda c: F.concat(F.lit("<td><span> "), c, F.lit(" </span></td>"))
    row = F.concat(F.lit("<tr>"), cell("company"), cell("doc_type"), F.lit("<td>\n "), "date", F.lit("</td>"), F.when(F.col("url") != "", F.concat(F.lit('<td><a class="x" href="'), "url", F.lit('">get</a></td>'))).otherwise("<td></td>"), F.lit("</tr>"))
    page = r.withColumn("page", F.floor(F.col("seq") / 20)).withColumn("row", row).groupBy("page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "row"))), lambda x: x["row"]), "").alias("rows"))
    return page.select("page", F.concat(F.lit("<table><tbody>"), "rows", F.lit("</tbody></table>")).alias("html"))


def html_result_rows(spark, sf):
    from debenture.sources import html

    return html.result_rows(result_pages(spark, sf), "page", "html").select("page", F.col("row").cast("long").alias("row"), "issuer_name", "doc_type", "date", "url", "filename")


def paged_result_rows(spark, sf):
    """Rows of results in the order of the pages' links: mostly seven pages to a chain; some lead back into it, some round and round."""
    from debenture.sources import html

    p = F.col("page")
    to = F.when(p % 35 == 33, p - 2).when(p % 70 == 69, p - 34).when(p % 35 == 20, p - 6).when(p % 7 != 6, p + 1)
    made = result_pages(spark, sf).withColumn("html", F.concat("html", F.when(to.isNotNull(), F.concat(F.lit("<a href='?page="), to.cast("string"), F.lit("' rel=\"next\">Next</a>"))).otherwise("")))
    link = F.regexp_extract(html.next_page(F.col("html")), r"page=(\d+)", 1).cast("long")
    chains = pages.page_chains(made.select("page", link.alias("next")))
    rows = html.result_rows(made, "page", "html").select("page", F.col("row").cast("long").alias("row"), "url")
    return chains.join(rows, "page").select("chain", "position", "page", "row", "url")


def keyword_lines(spark, sf):
    d = prospectuses(spark, sf).select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim(F.lower("line")))
    return d.filter(T.contains_any(F.col("line"), P.DATE_KEYWORDS))


def distinct_dates_top20(spark, sf):
    d = prospectuses(spark, sf).select(F.explode(E.all_matches(F.col("text"), P.DATE_STRINGS)).alias("found"))
    return d.distinct().orderBy("found").limit(20)


def name_concordance(spark, sf):
    d = cleaned(spark, sf).select("doc_id", "t", F.explode(F.array(*[F.lit(x) for x in P.CONCORDANCE_NAMES])).alias("name"))
    n = ((F.length("t") - F.length(F.replace("t", F.col("name"), F.lit("")))) / F.length("name")).cast("long")
    return d.select("doc_id", "name", n.alias("n"), F.md5(T.text_around(F.col("t"), F.col("name"), 100)).alias("context")).filter("n > 0")


def names_by_position(spark, sf):
    """Places of the known names of banks and of the nations' names in the texts, by the positional index."""
    known = spark.sql(f"SELECT explode(array({', '.join(repr(x) for x in P.CONCORDANCE_NAMES)})) AS name")
    nations = table(spark, sf, "nation").select(F.initcap(F.lower("n_name")).alias("name"))
    return concordance.concordance(concordance.positions(cleaned(spark, sf), text="t"), known.unionByName(nations)).select("doc_id", "name", "n", "first")


def statistics_by_batches(spark, sf):
    """Statistics by company and type of all register rows, counted in four batches of which one comes twice."""
    d = register(spark, sf).withColumn("date", F.to_date("date", "dd/MM/yyyy"))
    with working(spark) as keep:
        log = ledger.statistics(spark, f"{shared_dir(spark)}/statistics-{uuid.uuid4().hex}", every=3)
        try:
            for n in (0, 1, 1, 2, 3):
                ledger.add_documents(log, n, d.filter(F.pmod("seq", F.lit(4)) == n))
            return keep(saved(log.rows(), "statistics"))
        finally:
            log.drop()


def contents_by_batches(spark, sf):
    """The first batch and path of each text, the documents coming in four batches of which one comes twice, by the index with its filter."""
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"), F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    with working(spark) as keep:
        log = ledger.contents(spark, f"{shared_dir(spark)}/contents-{uuid.uuid4().hex}", every=2)
        try:
            for n in (0, 1, 1, 2, 3):
                ledger.new_files(log, n, d.filter(F.pmod(F.floor(F.col("doc_id") / 3), F.lit(4)) == n))
            return keep(saved(log.rows(), "contents"))
        finally:
            log.drop()


def strict_dates(spark, sf):
    """Dates as texts tell them that the compatible rules misread, read strictly: what was written must come back."""
    i = F.to_date("o_orderdate")
    m = F.add_months(i, 60)
    day = lambda d: F.date_format(d, "d")
    month = lambda d: F.element_at(F.array(*[F.lit(x) for x in MONTH_NAMES]), F.month(d))
    ordinal = lambda d: F.concat(day(d), F.lit("th "), month(d), F.lit(", "), F.year(d).cast("string"))
    first_month = lambda d: F.concat(month(d), F.lit(" "), day(d), F.lit(", "), F.year(d).cast("string"))
    iso = lambda d: d.cast("string")
    ways = [F.concat(F.lit(a), f(i), F.lit(f" {b}"), f(m)) for a, b, f in (("Issue Date: ", "Maturity Date: ", iso), ("Issuance Date: ", "Redemption Date: ", iso), ("Issue Date: ", "Maturity Date: ", ordinal), ("Issue Date: ", "Maturity Date: ", first_month))]
    t = dealt(table(spark, sf, "orders").select("o_orderkey", "o_orderdate")).select(F.col("o_orderkey").alias("seq"), F.posexplode(F.array(*ways)).alias("way", "t"))
    return t.withColumn("t", T.clean_text(F.col("t"))).select("seq", "way", E.dates(F.col("t"), strict=True).alias("d")).select("seq", "way", "d.issue_date", "d.maturity_date")


MONTH_NAMES = [x.title() for x in E.MONTHS]


def strict_errors(spark, sf):
    """Errors by component, those of unknown ones counted too."""
    return M.error_rollup(run_log(spark, sf), strict=True)


def path_union(spark, sf):
    """Paths named and paths found, once each, in order."""
    p = prospectuses(spark, sf).select(F.col("file_path").alias("path"))
    named = p.filter(F.contains("path", F.lit("/1/")))
    return named.unionByName(p.filter(F.endswith(F.lower("path"), F.lit(".pdf")))).distinct().orderBy("path")


def files_per_company(spark, sf):
    return prospectuses(spark, sf).groupBy(F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1).alias("folder")).agg(F.count("*").alias("n"))


NAMES = [
    clean_text, clean_prospectus, find_section_distribution, extract_sections, bank_sections, text_context,
    dates_issue_maturity, date_parse_matrix, currency_primary, currency_fallback, currency_full, programme_size, coupon,
    bank_roles, bank_known_names, bank_near_roles, bank_clean_name, bank_valid_name, bank_role_section, bank_roles_by_place, banks_by_role, bank_lists_by_role, standard_bank_names, names_by_alias_table, bank_confidence_tiers,
    validation_flags, extraction_record, consolidated_flat, typed_record, issuance_by_currency_year, issuance_by_bank, flag_summary, plausibility, run_summary,
    final_terms_filter, filename_recognised, filename_from_url, filename_from_header, organized_path, path_collisions, output_filename,
    document_id_md5, document_hash_md5, content_sha256, content_dedup, content_against_index, url_dedup, required_fields, dry_run_stats,
    eu_company_filter, unprocessed_companies, downloaded_documents, company_lookup_ci, company_suffix_strip, company_type_counts, company_stats,
    docs_top5_per_company, first_companies, first_companies_override, mock_fallback_lookup, cache_lookup, cache_inserts, company_documents, processed_names_sorted,
    run_counters, success_rate, error_rollup, error_top5, session_budget, batch_totals, metrics_report, retry_delays,
    html_links, html_result_rows, paged_result_rows, keyword_lines, first_date_matches, distinct_dates_top20, name_concordance, names_by_position, statistics_by_batches, contents_by_batches, strict_dates, strict_errors, path_union, files_per_company,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}
