"""DuckDB twins of the catalog's queries."""

from __future__ import annotations

from debenture.functions import patterns as P
from debenture.operators import mentions

from . import duck as D
from . import prospectus
from .catalog import ALIASES, RAW_NAMES

PRO = prospectus.sql("duckdb")
REL = f"SELECT doc_id, {D.clean('text')} AS t FROM ({PRO})"
q = D.q

REGISTER = """SELECT o_orderkey AS seq, c_name AS company, substring(o_orderpriority, 3, 20) AS doc_type, strftime(o_orderdate, '%d/%m/%Y') AS date, o_orderdate AS d,
 CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'https://register.example/docs/' || (o_orderkey // 7) || '/file_' || (o_orderkey // 7) || CASE WHEN o_orderkey % 3 = 0 THEN '.pdf?v=1' ELSE '#top' END END AS url,
 CASE o_orderkey % 5 WHEN 0 THEN 'attachment; filename="Doc ' || o_orderkey || '.PDF"' WHEN 1 THEN 'attachment; filename=raw' || o_orderkey END AS header
 FROM orders JOIN customer ON o_custkey = c_custkey"""
LOG = f"""SELECT event_id AS seq, 'company ' || (user_id % 50) AS company,
 CASE WHEN event_type = 'signup' AND event_id % 10 = 0 THEN 'bot' WHEN event_type = 'click' THEN 'found' WHEN event_type = 'view' THEN 'download' WHEN event_type = 'purchase' THEN 'cache' WHEN event_type = 'signup' THEN 'end' ELSE 'error' END AS kind,
 ([{', '.join(q(x) for x in [*P.ERROR_COMPONENTS, 'general'])}])[event_id % 4 + 1] AS component, 'failure ' || event_id AS message, event_id % 7 AS value, ts FROM events"""
COMPANIES = f"SELECT c_custkey AS seq, c_name AS name, ([{', '.join(q(x) for x in [*P.EU_COUNTRIES, 'Norway', 'United Kingdom', 'Japan'])}])[n_nationkey * 7 % 30 + 1] AS country FROM customer JOIN nation ON c_nationkey = n_nationkey"
BASENAME = "regexp_extract(file_path, '([^/]+)/*$', 1)"


def any_of(t: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({t}, {q(w)})" for w in words) + ")"


def url_name(u: str) -> str:
    return f"regexp_extract(regexp_extract({u}, {q(r'^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)')}, 1), '([^/]+)/*$', 1)"


def pick(items: list[str], i: str) -> str:
    return f"([{', '.join(q(x) for x in items)}])[{i}]"


def names() -> str:
    return f"SELECT s_suppkey AS k, {pick(RAW_NAMES, f's_suppkey % {len(RAW_NAMES)} + 1')} || CASE WHEN (s_suppkey // {len(RAW_NAMES)}) % 3 = 1 THEN ' plc' ELSE '' END AS raw FROM supplier"


def path(company: str, kind: str, date: str, sha: str, today: str) -> str:
    folder = f"left(regexp_replace({company}, {q(r'[\\/:*?"<>|]')}, '_', 'g'), 100)"
    typ = f"left(regexp_replace(regexp_replace({kind}, {q(r'\W+')}, '_', 'g'), '^_+|_+$', '', 'g'), 30)"
    return f"{folder} || '/' || {typ} || '_' || coalesce(nullif(left(regexp_replace(coalesce({date}, ''), '[^0-9]', '', 'g'), 8), ''), {today}) || '_' || left({sha}, 8) || '.pdf'"


MENTIONS = D.mentions(REL)
BANKS = f"SELECT DISTINCT doc_id, bank FROM ({MENTIONS})"
DOC_SECTIONS = " UNION ALL ".join(f"SELECT doc_id, {q(n)} AS section, {D.section('t', m, e)} AS body FROM r" for n, m, e in (("distribution", "distribution", "stabilization"), ("management", "managers", "stabilization"), ("stabilisation", "stabilization", "listing")))


def records() -> str:
    """A row per document: fields, banks (sorted, joined by |), flags."""
    name = "lower(filename)"
    flag = lambda c, f: f"CASE WHEN {c} THEN {q(f)} END"
    flags = ", ".join(
        [
            flag("b.names IS NULL", "no_banks_extracted"),
            flag("d.issue_date IS NULL AND d.maturity_date IS NULL", "no_dates_extracted"),
            flag("m.currency IS NULL AND m.issue_size IS NULL", "no_currency_info_extracted"),
            flag("c.coupon_rate IS NULL AND c.coupon_type IS NULL", "no_coupon_info_extracted"),
            flag("s.n IS NULL", "no_sections_found"),
            flag(f"NOT {any_of(name, P.RECOGNISED)}", "filename_not_recognized"),
        ]
    )
    return f"""WITH p AS MATERIALIZED (SELECT *, {BASENAME} AS filename FROM ({PRO})), r AS MATERIALIZED (SELECT doc_id, {D.clean('text')} AS t FROM p),
 d AS MATERIALIZED ({D.dates('SELECT * FROM r')}), m AS MATERIALIZED ({D.currency('SELECT * FROM r')}), c AS MATERIALIZED ({D.coupon('SELECT * FROM r')}),
 mn AS MATERIALIZED ({D.mentions('SELECT * FROM r')}), b AS (SELECT doc_id, string_agg(bank, '|' ORDER BY bank) AS names, count(*) AS n FROM (SELECT DISTINCT doc_id, bank FROM mn) GROUP BY doc_id),
 s AS (SELECT doc_id, count(*) AS n FROM ({DOC_SECTIONS}) WHERE body IS NOT NULL GROUP BY doc_id),
 rec AS MATERIALIZED (SELECT p.doc_id, p.company, p.file_path, p.filename, r.t = '' AS empty, d.failed,
  CASE WHEN g THEN d.issue_date END AS issue_date, CASE WHEN g THEN d.maturity_date END AS maturity_date, CASE WHEN g THEN m.issue_size END AS issue_size, CASE WHEN g THEN m.currency END AS currency,
  CASE WHEN g THEN c.coupon_rate END AS coupon_rate, CASE WHEN g THEN c.coupon_type END AS coupon_type, CASE WHEN g THEN coalesce(b.names, '') END AS banks, CASE WHEN g THEN coalesce(b.n, 0) ELSE 0 END AS n_banks,
  CASE WHEN r.t = '' THEN ['text_extraction_failed'] WHEN d.failed THEN ['processing_error: no such group'] ELSE list_filter([{flags}], lambda x: x IS NOT NULL) END AS flags
  FROM p JOIN r ON r.doc_id = p.doc_id JOIN d ON d.doc_id = p.doc_id JOIN m ON m.doc_id = p.doc_id JOIN c ON c.doc_id = p.doc_id LEFT JOIN b ON b.doc_id = p.doc_id LEFT JOIN s ON s.doc_id = p.doc_id,
  LATERAL (SELECT r.t <> '' AND NOT d.failed AS g))"""


REC = records()

NEAR_SCORE = f"""SELECT k, name, max_by(standard, (score, standard)) AS standard, max(score) / 100 AS confidence FROM (
 SELECT k, name, standard, alias, CASE WHEN name = alias THEN 100.0 ELSE {D.token_set('name', 'alias')} END AS score FROM n, al) GROUP BY k, name HAVING max(score) >= 85"""


def oracle_sql() -> dict[str, str]:
    o = {
        "clean_text": f"SELECT doc_id, {D.clean('text')} AS clean FROM documents",
        "clean_prospectus": f"SELECT doc_id, t AS clean FROM ({REL})",
        "find_section_distribution": f"SELECT doc_id, {D.section('t', 'distribution', 'stabilization')} AS section FROM ({REL})",
        "extract_sections": f"WITH r AS ({REL}) SELECT * FROM ({DOC_SECTIONS}) WHERE body IS NOT NULL",
        "bank_sections": f"SELECT doc_id, section, text AS body FROM ({D.sections(REL)})",
        "text_context": f"SELECT doc_id, {D.around('t', q('Manager'), 50)} AS context FROM ({REL})",
        "dates_issue_maturity": D.dates(REL),
        "date_parse_matrix": "SELECT seq, way, CAST({p} AS VARCHAR) AS parsed FROM (SELECT o_orderkey AS seq, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS way FROM (SELECT o_orderkey, [{w}] AS l FROM orders))".format(
            p=D.parsed("s"), w=", ".join(f"strftime(o_orderdate, {q(f)})" for f in ("%d-%m-%Y", "%-d-%-m-%Y", "%d-%m-%y", "%m-%d-%Y", "%m-%d-%y", "%y-%m-%d", "%-d %B %Y", "%d %B %Y", "%-d %B %y"))
        ),
        "currency_primary": D.currency_primary(REL),
        "currency_fallback": D.currency_fallback(REL),
        "currency_full": D.currency(REL),
        "programme_size": f"SELECT doc_id, {D.scaled("replace(a, ',', '')", 'lower(w)')} AS size FROM (SELECT doc_id, regexp_extract(t, {D.ci(P.PROGRAMME)}, 0) AS w, regexp_extract(t, {D.ci(P.PROGRAMME)}, 1) AS a FROM ({REL})) WHERE w <> ''",
        "coupon": D.coupon(REL),
        "bank_roles": f"SELECT doc_id, section, role FROM ({D.roles(D.sections(REL))})",
        "bank_known_names": f"SELECT doc_id, section, raw FROM ({D.known(D.sections(REL))})",
        "bank_near_roles": f"SELECT doc_id, section, raw FROM ({D.near(D.sections(REL))})",
        "bank_clean_name": f"SELECT k, raw, {D.bank_name('raw')} AS bank FROM ({names()})",
        "bank_valid_name": f"SELECT k, raw, {D.bank_valid('raw')} AS valid FROM ({names()})",
        "bank_roles_by_place": D.roles_by_place(REL, mentions.NAMES, mentions.ROLES),
        "bank_role_section": f"SELECT * FROM (SELECT doc_id, section, bank, role, count(role) OVER (PARTITION BY doc_id, section, bank) AS n FROM ({MENTIONS})) WHERE role IS NOT NULL OR n = 0".replace("SELECT * FROM (SELECT doc_id", "SELECT doc_id, section, bank, role FROM (SELECT doc_id", 1),
        "banks_by_role": f"WITH x AS (SELECT doc_id, section, bank, role, count(role) OVER (PARTITION BY doc_id, section, bank) AS n FROM ({MENTIONS})) SELECT coalesce(role, 'Unknown') AS role, bank, count(DISTINCT doc_id) AS n_documents FROM x WHERE role IS NOT NULL OR n = 0 GROUP BY 1, 2",
        "standard_bank_names": f"WITH n AS (SELECT k, lower({D.bank_name('raw')}) AS name FROM ({names()})), al AS (SELECT * FROM (VALUES {', '.join(f'({q(s)}, {q(a)})' for s, xs in ALIASES.items() for a in xs)}) v(standard, alias)) {NEAR_SCORE}",
        "names_by_alias_table": f"""WITH n AS MATERIALIZED (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN array_to_string(list_reverse(string_split(lower(p_name), ' ')), ' ') WHEN 1 THEN replace(lower(p_name), 'e', '') WHEN 2 THEN lower(p_name) || ' company' ELSE lower(p_name) END AS name FROM part),
 a AS MATERIALIZED (SELECT lower(p_name) AS alias, max(p_brand) AS standard FROM part GROUP BY 1),
 w AS (SELECT DISTINCT n.name, a.alias FROM (SELECT name, unnest(string_split(name, ' ')) AS w FROM n) n JOIN (SELECT alias, unnest(string_split(alias, ' ')) AS w FROM a) a ON n.w = a.w AND a.w <> '' WHERE name NOT IN (SELECT alias FROM a)),
 s AS (SELECT name, standard, 100.0::DOUBLE AS score FROM n JOIN a ON name = alias UNION ALL SELECT name, standard, {D.token_set('name', 'alias')} FROM w JOIN a USING (alias))
 SELECT name, max_by(standard, (score, standard)) AS standard, max(score) AS score FROM s GROUP BY name HAVING max(score) >= 85""",
        "validation_flags": f"{REC} SELECT doc_id, array_to_string(flags, ',') AS flags FROM rec",
        "extraction_record": f"{REC} SELECT doc_id, filename, issue_date, maturity_date, issue_size, currency, coupon_rate, coupon_type, banks, array_to_string(flags, ',') AS flags FROM rec",
        "consolidated_flat": f"""{REC}, x AS (SELECT doc_id, bank, role, count(role) OVER (PARTITION BY doc_id, bank) AS n FROM (SELECT DISTINCT doc_id, bank, role FROM mn)), rw AS ({D.raw_names('SELECT * FROM r')}), y AS (SELECT x.*, raw, confidence FROM x JOIN rw ON rw.doc_id = x.doc_id AND rw.bank = x.bank WHERE role IS NOT NULL OR n = 0)
 SELECT company AS company_name, company AS issuer_name, issue_date, maturity_date, issue_size, currency, coupon_rate, y.bank AS bank_standard_name, y.role AS bank_role, y.raw AS bank_raw_name, y.confidence AS bank_confidence, file_path AS pdf_path, array_to_string(flags, '; ') AS validation_flags
 FROM rec LEFT JOIN y ON y.doc_id = rec.doc_id AND NOT rec.failed""",
        "typed_record": f"{REC} SELECT doc_id, CAST(CAST(issue_date AS DATE) AS VARCHAR) AS issue_date, CAST(CAST(maturity_date AS DATE) AS VARCHAR) AS maturity_date, TRY_CAST(issue_size AS DOUBLE) AS issue_size, currency, CAST(coupon_rate AS DOUBLE) AS coupon_rate FROM rec",
        "issuance_by_currency_year": f"{REC} SELECT currency, CAST(year(CAST(issue_date AS DATE)) AS BIGINT) AS year, count(*) AS n, CAST(sum(CAST(TRY_CAST(issue_size AS DOUBLE) AS DECIMAL(38,6))) AS DOUBLE) AS size FROM rec GROUP BY 1, 2",
        "issuance_by_bank": f"{REC} SELECT bank, count(*) AS n, CAST(sum(CAST(TRY_CAST(issue_size AS DOUBLE) AS DECIMAL(38,2))) AS DOUBLE) AS size FROM (SELECT DISTINCT doc_id, bank FROM mn) b JOIN rec USING (doc_id) WHERE NOT failed GROUP BY bank",
        "flag_summary": f"{REC} SELECT doc_id, CASE WHEN len(flags) = 0 THEN 'None' WHEN length(j) > 27 THEN left(j, 27) || '...' ELSE j END AS line, len(flags) AS n_flags, n_banks FROM (SELECT *, array_to_string(flags, ', ') AS j FROM rec)",
        "plausibility": f"""{REC}, x AS (SELECT rec.doc_id, TRY_CAST(issue_date AS DATE) AS i, TRY_CAST(maturity_date AS DATE) AS m, currency, issue_size, CASE WHEN NOT failed THEN k.confidence END AS confidence FROM rec LEFT JOIN (SELECT doc_id, min(confidence) AS confidence FROM ({D.raw_names('SELECT * FROM r')}) GROUP BY doc_id) k ON k.doc_id = rec.doc_id)
 SELECT doc_id, array_to_string(list_filter([CASE WHEN m <= i THEN 'maturity_not_after_issue' END, CASE WHEN NOT year(i) BETWEEN 1990 AND 2050 THEN 'issue_date_out_of_range' END, CASE WHEN NOT year(m) BETWEEN 1990 AND 2050 THEN 'maturity_date_out_of_range' END, CASE WHEN currency IS NULL OR issue_size IS NULL THEN 'size_or_currency_missing' END, CASE WHEN confidence < 0.85 THEN 'low_bank_confidence' END], lambda x: x IS NOT NULL), ',') AS flags FROM x""",
        "run_summary": f"{REC} SELECT count(DISTINCT company) AS companies_attempted, count(DISTINCT company) FILTER (NOT empty AND NOT failed) AS companies_succeeded, count(*) AS documents, count(*) FILTER (empty OR failed) AS errors FROM rec",
        "final_terms_filter": f"SELECT doc_id, filename FROM (SELECT doc_id, {BASENAME} AS filename FROM ({PRO})) WHERE {any_of('lower(filename)', P.FINAL_TERMS)}",
        "filename_recognised": f"SELECT doc_id, filename, {any_of('lower(filename)', P.RECOGNISED)} AS recognised FROM (SELECT doc_id, {BASENAME} AS filename FROM ({PRO}))",
        "filename_from_url": f"SELECT page_id, {url_name('url')} AS filename FROM pages",
        "filename_from_header": f"SELECT seq, CASE WHEN regexp_matches(n, {D.ci(r'\.(pdf|docx|zip)$')}) THEN n ELSE n || '.pdf' END AS filename FROM (SELECT seq, coalesce(nullif(regexp_extract(header, 'filename=\"?([^\"]+)\"?', 1), ''), nullif({url_name('url')}, ''), {q(P.DEFAULT_FILE)} || CASE WHEN seq % 2 = 0 THEN seq::VARCHAR ELSE md5(url) END || '.pdf') AS n FROM ({REGISTER}))",
        "organized_path": f"SELECT seq, {path("company || '/A:B'", 'doc_type', 'CASE WHEN seq % 13 > 0 THEN date END', 'sha256(url)', q('20240101'))} AS path FROM ({REGISTER})",
        "path_collisions": f"SELECT path, count(*) AS n, count(DISTINCT sha) AS n_contents, CASE WHEN count(DISTINCT sha) > 1 THEN 'fail' WHEN count(*) > 1 THEN 'reuse' ELSE 'new' END AS verdict FROM (SELECT sha256(url) AS sha, {path('company', 'doc_type', q('2024'), q('00000000'), q('20240101'))} AS path FROM ({REGISTER})) GROUP BY path",
        "output_filename": "SELECT c_custkey, replace(c_name || '/x', '/', '_') || '.json' AS filename FROM customer",
        "document_id_md5": f"SELECT seq, md5(url || '_' || company || '_' || doc_type || '_' || CASE WHEN seq % 4 > 0 THEN date ELSE 'None' END) AS id FROM ({REGISTER})",
        "document_hash_md5": f"SELECT seq, md5(company || '_' || doc_type || '_' || date) AS id, md5(url) AS url_id FROM ({REGISTER})",
        "content_sha256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
        "content_dedup": "SELECT doc_id, sha256(text) AS sha256, first_value(path) OVER w AS kept_path, row_number() OVER w > 1 AS is_duplicate FROM (SELECT doc_id, text, source || '/' || doc_id AS path FROM documents) WINDOW w AS (PARTITION BY sha256(text) ORDER BY doc_id)",
        "url_dedup": f"SELECT company, url, min(seq) AS seq FROM ({REGISTER}) WHERE url <> '' GROUP BY company, url",
        "eu_company_filter": f"SELECT name, country, 'Active' AS status FROM ({COMPANIES}) WHERE country IN ({', '.join(q(c) for c in P.EU_COUNTRIES)})",
        "unprocessed_companies": f"SELECT name, seq, country FROM ({COMPANIES}) WHERE name NOT IN (SELECT c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F')",
        "downloaded_documents": "SELECT o_orderkey AS doc_id, o_orderstatus AS status FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 3 = 0)",
        "company_lookup_ci": f"SELECT wanted, min(seq) AS seq, min_by(name, seq) AS name, min_by(country, seq) AS country FROM (SELECT DISTINCT upper(replace(s_name, 'Supplier', 'Customer')) AS wanted FROM supplier) LEFT JOIN ({COMPANIES}) ON lower(wanted) = lower(name) GROUP BY wanted",
        "company_suffix_strip": "SELECT c_custkey, CASE " + " ".join(f"WHEN ends_with(name, {q(s)}) THEN left(name, length(name) - {len(s)})" for s in P.COMPANY_SUFFIXES) + f" ELSE name END AS name FROM (SELECT c_custkey, c_name || {pick([*P.COMPANY_SUFFIXES, '', ' PLC', ' SE AG'], 'c_custkey % 12 + 1')} AS name FROM customer)",
        "company_type_counts": f"SELECT company, doc_type, count(*) AS n, max(date) AS last_updated FROM ({REGISTER}) GROUP BY 1, 2",
        "company_stats": f"SELECT company, sum(n) OVER (PARTITION BY company)::BIGINT AS total_documents, max(l) OVER (PARTITION BY company) AS last_updated, doc_type, n FROM (SELECT company, doc_type, count(*) AS n, max(CAST(d AS DATE)) AS l FROM ({REGISTER}) GROUP BY 1, 2)",
        "docs_top5_per_company": f"SELECT company, seq, rank FROM (SELECT company, seq, row_number() OVER (PARTITION BY company ORDER BY seq) AS rank FROM ({REGISTER})) WHERE rank <= 5",
        "first_companies": f"SELECT seq, name, country FROM ({COMPANIES}) ORDER BY seq LIMIT 5",
        "first_companies_override": f"SELECT seq, CASE WHEN r = 1 THEN 'Aker BP ASA' ELSE name END AS name, CASE WHEN r = 1 THEN 'Norway' ELSE country END AS country FROM (SELECT *, row_number() OVER (ORDER BY seq) AS r FROM ({COMPANIES})) WHERE r <= 5",
        "mock_fallback_lookup": f"WITH r AS (SELECT company, seq FROM ({REGISTER})) SELECT c_name AS name, c_name AS issuer, seq FROM customer JOIN r ON company = c_name UNION ALL SELECT c_name, c_name, s FROM customer, (VALUES (-1), (-2)) v(s) WHERE c_name NOT IN (SELECT company FROM r)",
        "cache_lookup": "SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 6 = 0 THEN '/cache/' || o_orderkey END AS cache_path, o_orderkey % 6 = 0 AS cache_hit FROM orders",
        "cache_inserts": "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey % 3 <> 0",
        "company_documents": f"SELECT name, count(url) AS n FROM ({COMPANIES}) LEFT JOIN ({REGISTER}) ON name = company GROUP BY name",
        "processed_names_sorted": "SELECT DISTINCT trim(c_mktsegment) AS name FROM customer",
        "run_counters": f"SELECT count(*) FILTER (kind = 'end') AS companies_processed, coalesce(sum(value) FILTER (kind = 'found'), 0)::BIGINT AS documents_found, count(*) FILTER (kind = 'download') AS documents_downloaded, count(*) FILTER (kind = 'cache') AS documents_from_cache, count(*) FILTER (kind = 'bot') AS bot_detections FROM ({LOG})",
        "success_rate": f"SELECT company, found, processed, CASE WHEN found > 0 THEN processed / found END AS rate, processed / greatest(found, 1) AS report_rate FROM (SELECT company, coalesce(sum(value) FILTER (kind = 'found'), 0)::BIGINT AS found, count(*) FILTER (kind IN ('download', 'cache')) AS processed FROM ({LOG}) GROUP BY company)",
        "error_rollup": f"SELECT coalesce(component, 'total') AS component, count(*) AS n FROM ({LOG}) WHERE kind = 'error' AND component IN ({', '.join(q(c) for c in P.ERROR_COMPONENTS)}) GROUP BY ROLLUP (component)",
        "error_top5": f"SELECT component, rank, message, greatest(n, 5) - 5 AS more FROM (SELECT component, message, row_number() OVER (PARTITION BY component ORDER BY seq) AS rank, count(*) OVER (PARTITION BY component) AS n FROM ({LOG}) WHERE kind = 'error' AND component IN ({', '.join(q(c) for c in P.ERROR_COMPONENTS)})) WHERE rank <= 5",
        "session_budget": f"""WITH RECURSIVE l AS MATERIALIZED (SELECT company, seq, floor(epoch(ts))::BIGINT AS sec, row_number() OVER (PARTITION BY company ORDER BY ts, seq) AS nth FROM ({LOG})),
 f AS (SELECT company, seq, nth, 0::BIGINT AS session, 0::BIGINT AS request, sec AS start, sec, false AS renew FROM l WHERE nth = 1 UNION ALL
  SELECT company, seq, nth, session + r::INT, CASE WHEN r THEN 0 ELSE request + 1 END, CASE WHEN r THEN sec ELSE start END, sec, r
  FROM (SELECT l.company, l.seq, l.nth, l.sec, f.session, f.request, f.start, l.sec - f.start > 3600 OR f.request + 1 >= 100 AS r FROM f JOIN l ON l.company = f.company AND l.nth = f.nth + 1))
 SELECT company, seq, session, request, sec - start AS age_s, renew FROM f""",
        "batch_totals": f"SELECT company, count(*) FILTER (kind IN ('download', 'cache')) AS processed, count(*) FILTER (kind = 'error') AS errors, (floor(epoch(max(ts))) - floor(epoch(min(ts))))::BIGINT AS seconds FROM ({LOG}) GROUP BY company",
        "metrics_report": f"""WITH c AS (SELECT company, (floor(epoch(max(ts))) - floor(epoch(min(ts))))::BIGINT AS s, coalesce(sum(value) FILTER (kind = 'found'), 0)::BIGINT AS f, count(*) FILTER (kind IN ('download', 'cache')) AS p FROM ({LOG}) GROUP BY company),
 e AS (SELECT component, count(*) AS n FROM ({LOG}) WHERE kind = 'error' AND component IN ({', '.join(q(c) for c in P.ERROR_COMPONENTS)}) GROUP BY ROLLUP (component))
 SELECT 1 AS part, company AS of, '  - ' || company || ': runtime ' || s || ' s, found ' || f || ', processed ' || p || ', success rate ' || format('{{:,.2f}}', 100.0 * p / greatest(f, 1)) || '%' AS line FROM c
 UNION ALL SELECT CASE WHEN component IS NULL THEN 2 ELSE 3 END, coalesce(component, 'total'), CASE WHEN component IS NULL THEN 'Total errors: ' || n ELSE '  - ' || component || ': ' || n || ' errors' END FROM e""",
        "required_fields": f"SELECT count(*) AS n, count(*) FILTER (url <> '' AND doc_id IS NOT NULL) AS kept FROM (SELECT url, CASE WHEN seq % 4 > 0 THEN seq END AS doc_id FROM ({REGISTER}))",
        "dry_run_stats": f"SELECT count(*) AS total_files, count(*) FILTER (NOT gone AND NOT bad) AS organized_files, count(*) FILTER (gone AND NOT bad) AS skipped_files, count(*) FILTER (bad) AS error_files FROM (SELECT row_number() OVER (PARTITION BY url, company ORDER BY seq) > 1 AS gone, url = '' AS bad FROM ({REGISTER}))",
        "first_date_matches": f"SELECT doc_id, nr, found FROM (SELECT doc_id, unnest(l) AS found, generate_subscripts(l, 1) - 1 AS nr FROM (SELECT doc_id, list_slice({D.matches('text', P.DATE_STRINGS)}, 1, 3) AS l FROM ({PRO})))",
        "bank_confidence_tiers": f"SELECT k, name, confidence, CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS tier FROM (SELECT k, name, max({D.token_set('name', 'alias')}) / 100 AS confidence FROM (SELECT s_suppkey AS k, lower(replace(s_name, 'Supplier#', 'paribas bank ')) AS name FROM supplier), (VALUES {', '.join(f'({q(a)})' for xs in ALIASES.values() for a in xs)}) v(alias) GROUP BY k, name)",
        "bank_lists_by_role": f"WITH x AS (SELECT doc_id, section, bank, role, count(role) OVER (PARTITION BY doc_id, section, bank) AS n FROM ({MENTIONS})) SELECT coalesce(role, 'Unknown') AS role, string_agg(DISTINCT bank, '|' ORDER BY bank) AS banks FROM x WHERE role IS NOT NULL OR n = 0 GROUP BY 1",
        "content_against_index": """WITH f AS (SELECT doc_id, source || '/' || doc_id AS path, sha256(text) AS sha FROM documents WHERE text IS NOT NULL), i AS (SELECT sha, min_by(path, doc_id) AS old FROM f WHERE doc_id % 2 = 0 GROUP BY sha),
 j AS (SELECT i.sha, old, NOT old LIKE '%4' AS there FROM i), n AS (SELECT sha, min_by(path, doc_id) AS head FROM f GROUP BY sha)
 SELECT doc_id, sha AS sha256, CASE WHEN there THEN old ELSE head END AS kept_path, path <> CASE WHEN there THEN old ELSE head END AS is_duplicate FROM f JOIN n USING (sha) LEFT JOIN j USING (sha)""",
        "retry_delays": "SELECT range AS attempt, 5.0::DOUBLE * pow(2.0, range) AS seconds FROM range(6)",
        "html_links": f"SELECT page_id, url, {url_name('url')} AS filename FROM (SELECT page_id, regexp_extract(html, {q(r'(?is)<a\b[^>]*?href\s*=\s*"([^"]*)"')}, 1) AS url FROM pages) WHERE url <> ''",
        "html_result_rows": f"SELECT page, row, company AS issuer_name, doc_type, date, url, {url_name('url')} AS filename FROM (SELECT *, seq // 20 AS page, row_number() OVER (PARTITION BY seq // 20 ORDER BY seq) - 1 AS row FROM ({REGISTER})) WHERE url <> ''",
        "paged_result_rows": f"""WITH RECURSIVE r AS MATERIALIZED (SELECT seq // 20 AS page, row_number() OVER (PARTITION BY seq // 20 ORDER BY seq) - 1 AS row, url FROM ({REGISTER})),
 p AS MATERIALIZED (SELECT page, CASE WHEN page % 35 = 33 THEN page - 2 WHEN page % 70 = 69 THEN page - 34 WHEN page % 35 = 20 THEN page - 6 WHEN page % 7 <> 6 THEN page + 1 END AS next FROM (SELECT DISTINCT page FROM r)),
 l AS MATERIALIZED (SELECT * FROM p WHERE next IN (SELECT page FROM p)),
 w AS (SELECT page AS start, [page] AS seen FROM p UNION ALL SELECT start, list_append(seen, next) FROM w JOIN l ON l.page = seen[-1] WHERE NOT list_contains(seen, next)),
 a AS (SELECT start, arg_max(seen, len(seen)) AS seen FROM w GROUP BY start),
 h AS (SELECT page FROM p WHERE page NOT IN (SELECT next FROM l WHERE next <> page)),
 m AS (SELECT DISTINCT unnest(seen) AS page FROM a WHERE start IN (SELECT page FROM h)),
 c AS (SELECT * FROM a WHERE start IN (SELECT page FROM h) OR start NOT IN (SELECT page FROM m) AND start = list_min(seen)),
 o AS (SELECT start AS chain, unnest(seen) AS page, generate_subscripts(seen, 1) - 1 AS position FROM c)
 SELECT chain, position, page, row, url FROM o JOIN r USING (page) WHERE url <> ''""",
        "keyword_lines": f"SELECT doc_id, line FROM (SELECT doc_id, trim(lower(unnest(string_split(text, chr(10))))) AS line FROM ({PRO})) WHERE {any_of('line', P.DATE_KEYWORDS)}",
        "distinct_dates_top20": f"SELECT DISTINCT unnest({D.matches('text', P.DATE_STRINGS)}) AS found FROM ({PRO}) ORDER BY found LIMIT 20",
        "name_concordance": f"SELECT doc_id, name, n, md5({D.around('t', 'name', 100)}) AS context FROM (SELECT doc_id, t, name, ((length(t) - length(replace(t, name, ''))) // length(name)) AS n FROM ({REL}), (SELECT unnest([{', '.join(q(x) for x in P.CONCORDANCE_NAMES)}]) AS name)) WHERE n > 0",
        "names_by_position": f"WITH d AS (SELECT doc_id, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+') AS w FROM ({REL})), k AS (SELECT DISTINCT name, regexp_extract_all(name, '[\\p{{L}}\\p{{N}}]+') AS v FROM (SELECT unnest([{', '.join(q(x) for x in P.CONCORDANCE_NAMES)}]) AS name UNION ALL SELECT array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(n_name, ' ')], ' ') FROM nation)) SELECT doc_id, name, len(hits)::BIGINT AS n, (hits[1] - 1)::INTEGER AS first FROM (SELECT doc_id, name, [i FOR i IN range(1, len(w) - len(v) + 2) IF w[i:i + len(v) - 1] = v] AS hits FROM d, k WHERE list_has_all(w, v)) WHERE len(hits) > 0",
        "contents_by_batches": "SELECT sha256, batch, path FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY batch, path NULLS FIRST) AS r FROM (SELECT sha256(text) AS sha256, (doc_id // 3) % 4 AS batch, source || '/' || doc_id AS path FROM documents WHERE text IS NOT NULL)) WHERE r = 1",
        "strict_dates": "SELECT o_orderkey AS seq, unnest(range(4))::INT AS way, strftime(o_orderdate, '%Y-%m-%d') AS issue_date, strftime(o_orderdate + INTERVAL 60 MONTH, '%Y-%m-%d') AS maturity_date FROM orders",
        "strict_errors": f"SELECT coalesce(component, 'total') AS component, count(*) AS n FROM ({LOG}) WHERE kind = 'error' GROUP BY ROLLUP (component)",
        "statistics_by_batches": f"SELECT company, doc_type, count(*) AS n, max(d)::DATE AS last_updated FROM ({REGISTER}) GROUP BY company, doc_type",
        "path_union": f"SELECT DISTINCT file_path AS path FROM ({PRO})",
        "files_per_company": f"SELECT regexp_extract(file_path, '^(.*)/[^/]*$', 1) AS folder, count(*) AS n FROM ({PRO}) GROUP BY 1",
    }
    return o
