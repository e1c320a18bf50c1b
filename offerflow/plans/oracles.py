"""DuckDB SQL twins of the registered queries, over the same given tables.

The keyword lists come from the rule tables; the logic is written independently in SQL.
"""

from __future__ import annotations

import unicodedata

from offerflow import rules
from offerflow.functions import skills as sk
from offerflow.plans import fixture as fx

DAY = "DATE '2025-07-01'"
NOW = "TIMESTAMP '2025-07-01 10:00:00'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _with(body: str, *names: str) -> str:
    """``body`` with the named derived tables in front."""
    parts = ", ".join(f"{n} AS ({_DERIVED[n]})" for n in names)
    return f"WITH {parts} {body}" if names else body


_OFFERS = f"SELECT *, CAST(created_text AS TIMESTAMP) AS created_at FROM ({fx.OFFERS})"
_ENRICHED = (
    "SELECT * EXCLUDE (skills_text, processed_text), string_split(skills_text, ',') AS extracted_skills, "
    f"CAST(processed_text AS TIMESTAMP) AS processed_at, 0.5::DOUBLE AS confidence_score FROM ({fx.ENRICHED})"
)
_DERIVED: dict[str, str] = {
    "postings": fx.POSTINGS,
    "offers": _OFFERS,
    "enriched": _ENRICHED,
    "texts": "SELECT id, title, description, posted_date, contract_type, concat_ws(' ', title, description) AS txt, "
             "lower(concat_ws(' ', title, description)) AS low FROM offers",
    **fx.RAW,
}


def _hits(column: str, keywords) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, {_q(k)}) AS INTEGER)" for k in keywords) + ")"


def _best(column: str, table: dict) -> str:
    scores = {label: _hits(column, words) for label, words in table.items()}
    top = f"greatest({', '.join(scores.values())})"
    cases = " ".join(f"WHEN {top} = {score} THEN {_q(label)}" for label, score in scores.items())
    return f"CASE WHEN {top} = 0 THEN NULL {cases} END"


ORACLES: dict[str, str] = {}

# ----------------------------------------------------------- consolidation
_MAPPED = """
SELECT 'emploi' AS spider_source, id AS original_id, title, url, location, company_name,
 TRY_CAST(posted_date AS DATE) AS posted_date, source, coalesce(description_p, description_ul, '') AS description,
 contract_type, NULL AS salary, NULL AS category, NULL AS sector, NULL AS experience_level, NULL AS education_level,
 1 AS nb_positions, NULL::DATE AS expiration_date FROM emplois WHERE id IS NOT NULL
UNION ALL SELECT 'senjob', id, title, url, location, NULL, TRY_CAST(posted_date AS DATE), source, description,
 contract_type, salaire, categorie, NULL, NULL, NULL, 1, TRY_CAST(expiration AS DATE) FROM senjobs WHERE id IS NOT NULL
UNION ALL SELECT 'emploi_expatDakar', id, title, url, location, employeur,
 CAST(TRY_CAST(posted_date AS TIMESTAMP) AS DATE), source, description, type_contrat, NULL, NULL, secteur, niveau,
 niveau_etude, coalesce(TRY_CAST(nb_postes AS INTEGER), 1), NULL FROM emploi_expatdakar WHERE id IS NOT NULL
UNION ALL SELECT 'emploi_senegal', id, title, url, region, company_name, posted, source, description, contract, NULL,
 metier_type, company_sectors, experience, education, 1, NULL FROM jobs_emploi_senegal WHERE id IS NOT NULL
UNION ALL SELECT 'concoursn_stages', id, title, url, NULL, company, posted_date, source, description, 'Stage', NULL,
 categories, NULL, NULL, NULL, 1, NULL FROM concoursn_stages WHERE id IS NOT NULL
"""
ORACLES["consolidate_sources"] = _with(f"""
SELECT md5(concat(spider_source, '|', original_id)) AS id, spider_source, original_id, title, url, location,
 company_name, CAST(posted_date AS VARCHAR) AS posted_date, source, md5(description) AS description, contract_type,
 salary, category, sector, experience_level, education_level, CAST(nb_positions AS BIGINT) AS nb_positions,
 CAST(expiration_date AS VARCHAR) AS expiration_date, '2025-07-01 10:00:00' AS created_at
FROM ({_MAPPED}) m WHERE NOT EXISTS (
 SELECT 1 FROM offers o JOIN labels l ON CAST(l.doc_id AS VARCHAR) = o.id
 WHERE o.spider_source = m.spider_source AND o.original_id = m.original_id)""", "offers", *fx.RAW)

ORACLES["consolidation_rejects"] = _with("""
SELECT 'senjobs' AS "table", id, 'posted_date' AS "column", posted_date AS "value" FROM senjobs
 WHERE id IS NOT NULL AND posted_date IS NOT NULL AND TRY_CAST(posted_date AS DATE) IS NULL
UNION ALL SELECT 'senjobs', id, 'expiration', expiration FROM senjobs
 WHERE id IS NOT NULL AND expiration IS NOT NULL AND TRY_CAST(expiration AS DATE) IS NULL
UNION ALL SELECT 'emploi_expatdakar', id, 'nb_postes', nb_postes FROM emploi_expatdakar
 WHERE id IS NOT NULL AND nb_postes IS NOT NULL AND TRY_CAST(nb_postes AS INTEGER) IS NULL
""", "senjobs", "emploi_expatdakar")

ORACLES["requires_posted_date"] = _with(
    "SELECT id, CASE WHEN posted_date IS NULL THEN 'rejected' ELSE 'kept' END AS outcome FROM emplois", "emplois")

ORACLES["new_record_count"] = _with(
    f"SELECT count(*) AS new_records FROM offers WHERE created_at >= {DAY} - INTERVAL 1 DAY", "offers")

ORACLES["consolidation_stats"] = _with(f"""
SELECT spider_source, count(*) AS total_records,
 count(CASE WHEN created_at >= {DAY} - INTERVAL 1 DAY THEN 1 END) AS new_records
FROM offers GROUP BY spider_source""", "offers")

ORACLES["dedup_by_url"] = """
SELECT md5(url) AS id, url, doc_id, lang, source FROM (
 SELECT *, 'https://d.example.org/' || md5(text) AS url,
  row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""

# ---------------------------------------------------------------- cleaning
_STRIP = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _strip(expression: str) -> str:
    return _STRIP.format(expression)


def _collapse(expression: str) -> str:
    return _strip(f"regexp_replace({expression}, '\\s+', ' ', 'g')")


_FRAGMENTS = f"list_filter(list_transform(lines, lambda x: {_strip('x')}), lambda x: x <> '')"

ORACLES["clean_fields"] = f"""
WITH d AS (SELECT *, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, {_strip('lines[1]')} AS first_line, md5(lines[1]) AS first_raw,
 md5(CASE WHEN text <> '' THEN {_strip('text')} END) AS scalar,
 md5(coalesce(array_to_string({_FRAGMENTS}, chr(10)), '')) AS joined_lines,
 md5(coalesce(array_to_string({_FRAGMENTS}, ', '), '')) AS joined_commas,
 md5(regexp_replace({_collapse('text')}, '[^\\p{{L}}\\p{{N}}_\\sÀ-ÿ&''-]', '', 'g')) AS label,
 md5({_collapse('text')}) AS collapsed,
 md5({_collapse("replace(' Note : ' || text, ':', '')")}) AS without_colon,
 md5('https://d.example.org/' || CAST(doc_id AS VARCHAR)) AS url_id,
 md5(CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END) AS short
FROM d"""

ORACLES["labels_to_json"] = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, md5('[' || coalesce(array_to_string(
 list_transform({_FRAGMENTS}, lambda x: CAST(to_json(x) AS VARCHAR)), ', '), '') || ']') AS labels FROM d"""

ORACLES["number_fields"] = r"""
SELECT doc_id, TRY_CAST(regexp_replace(text, '[^0-9]', '', 'g') AS BIGINT) AS all_digits,
 TRY_CAST(regexp_extract(replace(text, ' ', ''), '([0-9]+(?:\.[0-9]+)?)', 1) AS DOUBLE) AS first_number,
 nullif(regexp_extract(text, '[0-9]+', 0), '') AS first_digits FROM documents"""

ORACLES["pick_fragments"] = _with(f"""
, c AS (SELECT doc_id, lang, contract_type, list_filter(list_concat(
  ['  ', ' ' || CAST(posted_date AS VARCHAR) || ' (publiée)'], [CAST(n_chars AS VARCHAR) || ' / Mois '],
  string_split(text, chr(10))), lambda x: x IS NOT NULL) AS raw FROM postings),
f AS (SELECT *, list_filter(list_transform(raw, lambda x: {_strip('x')}), lambda x: x <> '') AS cells FROM c)
SELECT doc_id, list_filter(cells, lambda x: regexp_matches(x, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'))[1] AS posted,
 md5(list_filter(cells, lambda x: contains(lower(x), 'mois'))[1]) AS salary,
 md5({_strip('raw[2]')}) AS second, lang AS sector, contract_type AS contract, NULL::VARCHAR AS positions
FROM f""", "postings").replace(") \n, c", "), c", 1)

ORACLES["company_from_title"] = _with(f"""
SELECT doc_id, md5(nullif({_strip('''regexp_extract(coalesce(company_name, '') || CASE site WHEN 0 THEN ' recrute '
 WHEN 1 THEN '  RECHERCHE ' WHEN 2 THEN ' - recrutement ' WHEN 3 THEN ' embauche ' ELSE ' recrutement ' END || text,
 '(?i)^([^-]+?)[[:space:]]+(?:recrute|recherche|recrutement)', 1)''')}, '')) AS company,
 CASE WHEN title = 'Acme recrute un commercial' THEN 'Acme' END AS from_title FROM postings""", "postings")

ORACLES["resolve_url"] = """
WITH h AS (SELECT page_id, url, unnest(['/a/b.html', '?page=2', '#top', 'c/d', 'https://o.example.org/z',
  '//cdn.example.org/i.png', ' ']) AS href FROM pages),
p AS (SELECT *, split_part(split_part(url, '#', 1), '?', 1) AS page, split_part(url, '/', 1) AS scheme,
  split_part(url, '/', 3) AS host FROM h)
SELECT page_id, href, CASE href WHEN '/a/b.html' THEN scheme || '//' || host || href WHEN '?page=2' THEN page || href
  WHEN '#top' THEN split_part(url, '#', 1) || href WHEN 'c/d' THEN regexp_replace(page, '[^/]*$', '') || href
  WHEN '//cdn.example.org/i.png' THEN scheme || href WHEN ' ' THEN url ELSE href END AS link,
 NOT contains(href, 'page=') AS is_detail FROM p"""

_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
ORACLES["parse_dates"] = _with(f"""
SELECT doc_id, CASE kind WHEN 0 THEN CAST(posted_date AS VARCHAR) WHEN 1 THEN 'il y a ' || d || ' jours'
  WHEN 2 THEN 'vendredi ' || n % 24 || ':' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') WHEN 3 THEN 'hier'
  WHEN 4 THEN (24 + n % 5) || '. juil, 13' WHEN 5 THEN 'depuis ' || n || ' minutes'
  WHEN 6 THEN 'il y a ' || n % 40 || ' heures' WHEN 7 THEN '0' || (1 + n % 9) || ' Décembre 2025'
  ELSE 'inconnu' END AS raw,
 CASE kind WHEN 0 THEN CAST(posted_date AS VARCHAR) END AS iso,
 {_TIME.format(f'''CASE kind WHEN 0 THEN CAST(posted_date AS TIMESTAMP)
  WHEN 1 THEN CASE WHEN d <= 23 THEN {DAY} + to_hours(d) ELSE {NOW} - to_days(CAST(d AS INTEGER)) END
  WHEN 2 THEN {DAY} + to_minutes((n % 24) * 60 + n % 60) WHEN 3 THEN {NOW} - INTERVAL 1 DAY
  WHEN 4 THEN make_timestamp(2025, 7, 24 + n % 5, 0, 0, 0.0)
  WHEN 5 THEN CASE WHEN n < 24 THEN {DAY} + to_hours(n)
   WHEN n BETWEEN 100 AND 2359 AND n % 100 < 60 THEN {DAY} + to_minutes((n // 100) * 60 + n % 100) END
  WHEN 6 THEN CASE WHEN n % 40 <= 23 THEN {DAY} + to_hours(n % 40) END
  WHEN 7 THEN {DAY} + to_hours(1 + n % 9) END''')} AS posted,
 {_TIME.format(f'''CASE kind WHEN 1 THEN {NOW} - to_days(CAST(d AS INTEGER)) WHEN 3 THEN {NOW} - INTERVAL 1 DAY
  WHEN 5 THEN {NOW} - to_minutes(n) WHEN 6 THEN {NOW} - to_hours(n % 40)
  WHEN 7 THEN make_timestamp(2025, 12, 1 + n % 9, 0, 0, 0.0) END''')} AS relative
FROM (SELECT doc_id, posted_date, n_chars AS n, n_chars % 95 AS d, doc_id % 9 AS kind FROM postings)""", "postings")

# ------------------------------------------------------- backlog and joins
_OPEN = """FROM offers o WHERE length(description) > 50
 AND NOT EXISTS (SELECT 1 FROM enriched e WHERE e.offre_id = o.id)"""
ORACLES["backlog"] = _with(f"""
SELECT id, title, md5(description) AS description, contract_type, location, company_name, spider_source,
 CAST(posted_date AS VARCHAR) AS posted_date FROM (
 SELECT * {_OPEN})""", "offers", "enriched")
ORACLES["backlog_top"] = _with(f"""
SELECT id, title, CAST(posted_date AS VARCHAR) AS posted_date FROM (
 SELECT * {_OPEN} ORDER BY posted_date DESC NULLS FIRST, id LIMIT 25)""", "offers", "enriched")
ORACLES["backlog_unlimited"] = _with(
    f"SELECT id, spider_source, CAST(posted_date AS VARCHAR) AS posted_date {_OPEN}", "offers", "enriched")
ORACLES["offers_left_enriched"] = _with("""
SELECT o.id, o.spider_source, e.extracted_sector, e.extracted_salary_min, e.extracted_salary_max,
 array_to_string(e.extracted_skills, '|') AS skills, strftime(e.processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at
FROM offers o LEFT JOIN enriched e ON o.id = e.offre_id""", "offers", "enriched")
_EXTRACT = """SELECT o.*, e.extracted_sector, e.extracted_contract_type, e.extracted_skills,
 e.extracted_salary_min, e.extracted_salary_max, e.job_level, e.job_type, e.confidence_score
FROM offers o LEFT JOIN enriched e ON o.id = e.offre_id WHERE o.description IS NOT NULL"""
ORACLES["offers_with_enrichment"] = _with(f"""
SELECT id, title, md5(description) AS description, company_name, location, CAST(posted_date AS VARCHAR) AS posted_date,
 extracted_sector, extracted_contract_type, array_to_string(extracted_skills, '|') AS skills, extracted_salary_min,
 extracted_salary_max, job_level, job_type, confidence_score FROM ({_EXTRACT})""", "offers", "enriched")
_LATEST = """SELECT * FROM enriched WHERE offre_id IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY offre_id ORDER BY processed_at DESC, id DESC) = 1"""
ORACLES["latest_enrichment"] = _with(f"""
SELECT offre_id, id, extracted_salary_min, strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at
FROM ({_LATEST})""", "enriched")

# -------------------------------------------------------------- statistics
_JOINED = "enriched e JOIN offers o ON e.offre_id = o.id"


def _metric(column: str, key: str, name: str, category: str) -> str:
    return _with(f"""
SELECT '{name}' AS metric_name, CAST(json_object('{key}', {column}, 'count', count(*)) AS VARCHAR) AS metric_value,
 '2025-06-01' AS period_start, '2025-07-01' AS period_end, '{category}' AS category
FROM {_JOINED} WHERE o.posted_date >= DATE '2025-06-01' AND {column} IS NOT NULL GROUP BY {column}
""", "offers", "enriched")


ORACLES["offers_by_sector"] = _metric("extracted_sector", "sector", "offers_by_sector", "sector_analysis")
ORACLES["offers_by_contract_type"] = _metric(
    "extracted_contract_type", "contract_type", "offers_by_contract_type", "contract_analysis")
ORACLES["salary_distribution"] = _with(f"""
SELECT 'salary_distribution' AS metric_name, '2025-06-01' AS period_start, '2025-07-01' AS period_end,
 'salary_analysis' AS category, round(avg(extracted_salary_min), 3) AS avg_min_salary,
 round(avg(extracted_salary_max), 3) AS avg_max_salary,
 round(quantile_cont((extracted_salary_min + extracted_salary_max) // 2, 0.5), 3) AS median_salary
FROM {_JOINED} WHERE o.posted_date >= DATE '2025-06-01' AND extracted_salary_min IS NOT NULL
 AND extracted_salary_max IS NOT NULL""", "offers", "enriched")


def _mode(column: str) -> str:
    return f"""(SELECT {column} FROM j WHERE j.month = m.month AND {column} IS NOT NULL
 GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"""


ORACLES["job_market_overview"] = _with(f"""
, j AS (SELECT date_trunc('month', o.posted_date) AS month, o.company_name, o.location, o.contract_type,
  e.extracted_sector, e.extracted_salary_min, e.extracted_salary_max
 FROM offers o LEFT JOIN enriched e ON o.id = e.offre_id WHERE o.posted_date >= DATE '2024-07-01'),
m AS (SELECT month, count(*) AS total_offers, count(DISTINCT company_name) AS unique_companies,
  count(DISTINCT location) AS unique_locations, round(avg(extracted_salary_min), 3) AS avg_salary_min,
  round(avg(extracted_salary_max), 3) AS avg_salary_max FROM j GROUP BY month)
SELECT strftime(month, '%Y-%m-%d') AS month, total_offers, unique_companies, unique_locations, avg_salary_min,
 avg_salary_max, {_mode('contract_type')} AS most_common_contract, {_mode('extracted_sector')} AS most_common_sector
FROM m""", "offers", "enriched").replace(") \n, j", "), j", 1)

ORACLES["exact_median_orders"] = \
    "SELECT quantile_cont(CAST(trunc(o_totalprice) AS BIGINT), 0.5) AS median_price FROM orders"
_TOTALS = f"""SELECT (SELECT count(*) FROM offers) AS total_offers,
 (SELECT count(*) FROM offers WHERE created_at >= {DAY}) AS new_offers_today,
 (SELECT count(*) FROM enriched) AS total_enriched,
 (SELECT count(*) FROM enriched WHERE processed_at >= {DAY}) AS new_enriched_today"""
ORACLES["exact_median_times"] = "SELECT quantile_cont(epoch_us(ts), 0.5) AS median_micros FROM events"
ORACLES["exact_median_signed"] = """
SELECT quantile_cont(CAST(trunc(o_totalprice) AS BIGINT) - 150000, 0.5) AS median_price FROM orders"""
ORACLES["totals"] = _with(_TOTALS, "offers", "enriched")
_AVERAGES = """SELECT round(coalesce(avg(extracted_salary_min), 0), 3) AS avg_min_salary,
 round(coalesce(avg(extracted_salary_max), 0), 3) AS avg_max_salary FROM enriched WHERE extracted_salary_min IS NOT NULL"""
ORACLES["avg_salary_range"] = _with(_AVERAGES, "enriched")
_TOP_SECTORS = f"""SELECT extracted_sector AS sector, count(*) AS count FROM {_JOINED}
 WHERE o.posted_date >= DATE '2025-06-24' AND extracted_sector IS NOT NULL
 GROUP BY extracted_sector ORDER BY count(*) DESC, extracted_sector LIMIT 5"""
_TOP_SKILLS = f"""SELECT skill, count(*) AS count FROM (SELECT unnest(extracted_skills) AS skill FROM {_JOINED}
 WHERE o.posted_date >= DATE '2025-06-24') GROUP BY skill ORDER BY count(*) DESC, skill LIMIT 10"""
ORACLES["top_sectors"] = _with(_TOP_SECTORS, "offers", "enriched")
ORACLES["top_skills"] = _with(_TOP_SKILLS, "offers", "enriched")


def _json_list(rows: str, name: str) -> str:
    items = f"list(json_object('{name}', {name}, 'count', count) ORDER BY count DESC, {name})"
    return f"(SELECT coalesce('[' || array_to_string({items}, ',') || ']', '[]') FROM ({rows}))"


ORACLES["daily_report"] = _with(f"""
SELECT '2025-07-01' AS date, t.*, a.*, {_json_list(_TOP_SECTORS, 'sector')} AS top_sectors,
 {_json_list(_TOP_SKILLS, 'skill')} AS top_skills FROM ({_TOTALS}) t, ({_AVERAGES}) a""", "offers", "enriched")
ORACLES["saved_report"] = _with("""
SELECT 'daily_summary_report' AS metric_name, '2025-07-01' AS date, count(*) AS total_offers,
 '2025-07-01' AS period_start, '2025-07-01' AS period_end, 'admin_report' AS category FROM offers""", "offers")
ORACLES["report_lines"] = _with(f"""
SELECT '<h2>📊 Rapport Quotidien - 2025-07-01</h2>' || chr(10) || '<p><b>Total offres:</b> ' || total_offers || '</p>'
 || chr(10) || '<p><b>Nouvelles offres:</b> ' || new_offers_today || '</p>' || chr(10)
 || '<p><b>Offres enrichies:</b> ' || total_enriched || '</p>' || chr(10)
 || '<p><b>Nouvelles enrichies:</b> ' || new_enriched_today || '</p>' || chr(10)
 || '<p><b>Salaire moyen min:</b> ' || CAST(round_even(avg_min_salary, 0) AS BIGINT) || ' XOF</p>' || chr(10)
 || '<p><b>Salaire moyen max:</b> ' || CAST(round_even(avg_max_salary, 0) AS BIGINT) || ' XOF</p>' AS html,
 '📊 Rapport Emploi Dakar 2025-07-01' || chr(10) || 'Total: ' || total_offers || ', Nouvelles: ' || new_offers_today
 || ', Enrichies: ' || total_enriched AS short_text,
 '{{"title":"📊 Rapport Emploi Dakar - 2025-07-01","fields":[{{"name":"Total Offres","value":"' || total_offers
 || '","inline":true}},{{"name":"Nouvelles Offres","value":"' || new_offers_today
 || '","inline":true}}],"color":3447003}}' AS card
FROM ({_TOTALS}) t, ({_AVERAGES}) a""", "offers", "enriched")

# ------------------------------------------------------------ completeness
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in rules.TARGET_COLUMNS)


def _completeness(rows: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) - count({c}) AS null_count,
 round_even(100.0::DOUBLE * count({c}) / count(*), 2) AS completeness, count(*) AS total_rows,
 count(CASE WHEN {_COMPLETE} THEN 1 END) AS complete_rows,
 count(CASE WHEN NOT ({_COMPLETE}) THEN 1 END) AS incomplete_rows FROM {rows}""" for c in rules.TARGET_COLUMNS)


ORACLES["completeness"] = _with(_completeness(f"({_EXTRACT})"), "offers", "enriched")
ORACLES["enrichment_coverage"] = _with(f"""
SELECT count(*) AS total, count(extracted_sector) AS with_enrichment,
 count(*) - count(extracted_sector) AS without_enrichment FROM ({_EXTRACT})""", "offers", "enriched")
ORACLES["split_complete"] = _with(f"""
SELECT id, extracted_salary_min, CASE WHEN {_COMPLETE} THEN 'complete' ELSE 'incomplete' END AS part
FROM ({_EXTRACT})""", "offers", "enriched")
ORACLES["not_yet_enriched"] = _with(
    f"SELECT id, extracted_salary_min FROM ({_EXTRACT}) WHERE extracted_sector IS NULL", "offers", "enriched")

# ------------------------------------------------------------- enrichment
_N, _C = r"(\d[\d\s]*)", rules.AMOUNT_CURRENCIES
_RANGES = (rf"{_N}(?:à|a|to|-)\s*{_N}{_C}", rf"{_N}-\s*{_N}{_C}",
           rf"entre\s+{_N}(?:et|and)\s+{_N}{_C}", rf"de\s+{_N}(?:à|a|to)\s+{_N}{_C}")
_SINGLES = (rf"{_N}{_C}", rf"{rules.SALARY_WORDS}\s+{_N}")


def _amount(column: str, pattern: str, group: int) -> str:
    n = f"TRY_CAST(regexp_replace(regexp_extract({column}, {_q(pattern)}, {group}), '[^0-9]', '', 'g') AS BIGINT)"
    return f"(CASE WHEN {n} < 1000 THEN {n} * 1000 ELSE {n} END)"


def _first_of(patterns: dict, column: str, default: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({column}, {_q(p)}) THEN '{k}'" for k, p in patterns.items())
    return f"CASE {cases} ELSE '{default}' END"


_PAIRS = ", ".join(f"{_amount('low', p, 1)} AS lo{i}, {_amount('low', p, 2)} AS hi{i}" for i, p in enumerate(_RANGES))
_OK = [f"lo{i} > 0 AND hi{i} > 0 AND lo{i} <= hi{i}" for i in range(len(_RANGES))]
_ONE = "coalesce(" + ", ".join(f"nullif({_amount('low', p, 1)}, 0)" for p in _SINGLES) + ")"


def _monthly(side: str) -> str:
    base = f"""CASE per WHEN 'yearly' THEN CAST(trunc({side}::DOUBLE / 12) AS HUGEINT)
  WHEN 'hourly' THEN {side}::HUGEINT * 160 WHEN 'daily' THEN {side}::HUGEINT * 22 ELSE {side}::HUGEINT END"""
    base = f"TRY_CAST({base} AS BIGINT)"
    return f"""CASE cur WHEN 'EUR' THEN TRY_CAST(trunc({base}::DOUBLE * 655.957::DOUBLE) AS BIGINT)
  WHEN 'USD' THEN TRY_CAST({base}::HUGEINT * 600 AS BIGINT)
  WHEN 'GBP' THEN TRY_CAST({base}::HUGEINT * 750 AS BIGINT) ELSE {base} END"""


_DERIVED["salary_raw"] = f"SELECT id, txt, low, {_PAIRS}, {_ONE} AS one, " \
    f"{_first_of(rules.CURRENCY_PATTERNS, 'low', 'XOF')} AS cur, " \
    f"{_first_of(rules.PERIOD_PATTERNS, 'low', 'monthly')} AS per FROM texts"
_DERIVED["salary_found"] = "SELECT id, txt, cur, per, " + ", ".join(
    f"coalesce(CASE {' '.join(f'WHEN {ok} THEN {s}{i}' for i, ok in enumerate(_OK))} END, one) AS {s}"
    for s in ("lo", "hi")) + " FROM salary_raw"
_DERIVED["salaries"] = f"SELECT id, txt, cur, per, {_monthly('lo')} AS min_salary, {_monthly('hi')} AS max_salary " \
    "FROM salary_found"
_SALARY = ("offers", "texts", "salary_raw", "salary_found", "salaries")
ORACLES["salary_fields"] = _with("""
SELECT id, min_salary, max_salary,
 CASE WHEN txt = '' THEN NULL WHEN min_salary IS NOT NULL THEN 'XOF' ELSE cur END AS currency,
 CASE WHEN txt = '' THEN NULL WHEN min_salary IS NOT NULL THEN 'monthly' ELSE per END AS period,
 CASE WHEN txt = '' THEN 0.0::DOUBLE WHEN min_salary IS NULL THEN 0.4::DOUBLE
  WHEN min_salary BETWEEN 50000 AND 5000000 THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS confidence,
 md5(CASE WHEN length(txt) > 200 THEN substr(txt, 1, 200) || '...' ELSE txt END) AS original_text
FROM salaries""", *_SALARY)

_INFER = "CASE " + " ".join(
    f"WHEN {_hits('low', words)} >= 2 THEN {_q(label)}" for label, words in rules.CONTRACT_HINTS.items()
) + " ELSE 'CDI' END"
_SCORE = _best("low", rules.CONTRACT_KEYWORDS)
_CLASSIFIED = f"CASE WHEN txt = '' THEN NULL ELSE coalesce({_SCORE}, {_INFER}) END"
ORACLES["contract_type"] = _with(
    f"SELECT id, {_SCORE} AS scored, {_INFER} AS inferred, {_CLASSIFIED} AS classified FROM texts", "offers", "texts")
_REMOTE = "(" + " OR ".join(f"contains(low, {_q(w)})" for w in rules.REMOTE_WORDS) + ")"
ORACLES["contract_info"] = _with(rf"""
, c AS (SELECT id, txt, {_CLASSIFIED} AS contract_type, CASE WHEN txt = '' THEN NULL ELSE coalesce(
  TRY_CAST(regexp_extract(low, '(\d+)\s*m', 1) AS BIGINT),
  TRY_CAST(TRY_CAST(regexp_extract(low, '(\d+)\s*(?:a|year)', 1) AS HUGEINT) * 12 AS BIGINT)) END AS duration_months,
 txt <> '' AND {_REMOTE} AS is_remote,
 txt = '' OR {_hits('low', rules.FULL_TIME_WORDS)} >= {_hits('low', rules.PART_TIME_WORDS)} AS is_full_time FROM texts)
SELECT id, contract_type, duration_months, is_remote, is_full_time, CASE WHEN txt = '' THEN 0.0::DOUBLE ELSE round(
 CASE WHEN contract_type <> '' THEN 0.4::DOUBLE ELSE 0 END + CASE WHEN duration_months <> 0 THEN 0.2::DOUBLE ELSE 0 END
 + CASE WHEN is_remote THEN 0.2::DOUBLE ELSE 0 END + 0.2::DOUBLE, 6) END AS confidence FROM c""",
    "offers", "texts").replace(") \n, c", "), c", 1)

_AVG = "coalesce(nullif(extracted_salary_min, 0), nullif(extracted_salary_max, 0)) / 2.0::DOUBLE"
_FITS = ", ".join(f"CASE WHEN s BETWEEN {a} AND {b} THEN {_q(k)} END" for k, (a, b) in rules.CONTRACT_SALARY_RANGES.items())
_VALID = " ".join(f"WHEN {_q(k)} THEN s BETWEEN {a} AND {b}" for k, (a, b) in rules.CONTRACT_SALARY_RANGES.items())
ORACLES["contract_recommendation"] = _with(f"""
SELECT id, coalesce(array_to_string(list_filter([{_FITS}], lambda x: x IS NOT NULL)[1:3], '|'), '') AS recommended,
 CASE WHEN s IS NULL THEN true ELSE CASE extracted_contract_type {_VALID} ELSE true END END AS valid
FROM (SELECT *, {_AVG} AS s FROM enriched)""", "enriched")

_CLEAN = r"""trim(regexp_replace(regexp_replace(low, '\s+', ' ', 'g'), '[^a-zA-ZÀ-ÿ0-9\s\-''"]', ' ', 'g'))"""


def _years(pattern: str) -> str:
    n = f"TRY_CAST(regexp_extract(clean, {_q(pattern)}, 1) AS INTEGER)"
    return f"CASE WHEN {n} BETWEEN 0 AND 30 THEN CAST({n} AS BIGINT) END"


_EXPERIENCE = "coalesce(" + ", ".join(_years(p) for p in (
    r"(\d+)\s*(?:an|ans|année|années)\s*(?:d'expérience|expérience)",
    r"expérience\s*(?:de\s*)?(\d+)\s*(?:an|ans|année|années)",
    r"(\d+)\+?\s*(?:an|ans|année|années)")) + ")"


def _count_in(words) -> str:
    return f"len(list_filter(words, lambda x: x IN ({', '.join(_q(w) for w in words)})))"


_DERIVED["cleaned"] = f"SELECT id, txt, {_CLEAN} AS clean FROM texts"
_DERIVED["worded"] = r"SELECT *, regexp_extract_all(clean, '[\p{L}\p{N}_]+') AS words FROM cleaned"
_DERIVED["semantics"] = f"""SELECT id, txt, {_EXPERIENCE} AS experience_years, {_best('clean', rules.SECTOR_KEYWORDS)} AS sector,
 {_best('clean', rules.CATEGORY_KEYWORDS)} AS job_category, {_best('clean', rules.LEVEL_KEYWORDS)} AS job_level,
 {_best('clean', rules.JOB_TYPE_KEYWORDS)} AS job_type,
 CASE WHEN len(words) = 0 THEN 0.0::DOUBLE ELSE round_even(greatest(least(
  ({_count_in(rules.POSITIVE_WORDS)} - {_count_in(rules.NEGATIVE_WORDS)})
  / greatest(len(words) * 0.02::DOUBLE, 1.0::DOUBLE), 1.0::DOUBLE), -1.0::DOUBLE), 3) END AS sentiment_score
FROM worded"""
_SEMANTICS = ("offers", "texts", "cleaned", "worded", "semantics")
_FOUND = " + ".join(f"CAST(m.{c} IS NOT NULL AS INTEGER)" for c in
                    ("experience_years", "sector", "job_category", "job_level", "job_type"))
ORACLES["semantic_fields"] = _with(f"""
SELECT id, experience_years, sector, job_category, job_level, job_type,
 CASE WHEN txt <> '' THEN sentiment_score END AS sentiment_score,
 CASE WHEN txt <> '' THEN round((1 + {_FOUND}) / 7.0::DOUBLE, 6) END AS confidence_score FROM semantics m""", *_SEMANTICS)
ORACLES["cleaned_text"] = _with("SELECT id, md5(clean) AS cleaned FROM cleaned", "offers", "texts", "cleaned")

# Key phrases: the same scoring over unnested phrases.
_STOPS = ", ".join(_q(w) for w in rules.STOP_WORDS)
_DERIVED["marked"] = rf"""SELECT id, array_to_string(list_transform(regexp_extract_all(
  regexp_replace(low, '[^\p{{L}}\p{{N}}''\- \t\n]|\n', ' | ', 'g'), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}''\-]*|\|'),
  lambda t: CASE WHEN t IN ({_STOPS}) THEN '|' ELSE t END), ' ') AS marked FROM texts"""
_DERIVED["phrases"] = """SELECT id, phrase, count(*) AS n, len(string_split(phrase, ' ')) AS size FROM (
 SELECT id, trim(unnest(string_split(marked, '|'))) AS phrase FROM marked)
 WHERE phrase <> '' AND len(string_split(phrase, ' ')) <= 4 GROUP BY id, phrase"""
_DERIVED["weights"] = """SELECT id, word, sum(n * size) / sum(n) AS weight FROM (
 SELECT id, n, size, unnest(string_split(phrase, ' ')) AS word FROM phrases) GROUP BY id, word"""
_DERIVED["key_phrases"] = """SELECT id, array_to_string(list(phrase ORDER BY rn), '|') AS key_phrases FROM (
 SELECT id, phrase, row_number() OVER (PARTITION BY id ORDER BY score DESC, phrase) AS rn FROM (
  SELECT p.id, p.phrase, round(sum(w.weight), 6) AS score FROM (
   SELECT id, phrase, unnest(string_split(phrase, ' ')) AS word FROM phrases) p
  JOIN weights w ON w.id = p.id AND w.word = p.word GROUP BY p.id, p.phrase)) WHERE rn <= 10 GROUP BY id"""
_PHRASES = ("marked", "phrases", "weights", "key_phrases")
ORACLES["key_phrases_of_offers"] = _with("SELECT id, key_phrases FROM key_phrases", "offers", "texts", *_PHRASES)


# Skills: decompose accents by replacement, then test every term against every text.
def _nfkd(column: str) -> str:
    for code in range(0xC0, 0x180):
        char = chr(code)
        parts = unicodedata.normalize("NFKD", char)
        if char.islower() and parts != char:
            column = f"replace({column}, {_q(char)}, {' || '.join(f'chr({ord(p)})' for p in parts)})"
    return column


def _term_regex(term: str) -> str:
    escaped = "".join("\\" + c if not c.isalnum() and c != " " and c.isascii() else c for c in term)
    return escaped.replace(" ", r"[\s\-]+")


_TERMS = [
    *[(t.title(), t) for ts in rules.TECHNICAL_SKILLS.values() for t in ts],
    *[(t.title(), t) for t in rules.SOFT_SKILLS],
    *[(label, t) for label, ts in rules.CONTEXT_SKILLS.items() for t in ts],
]
_DERIVED["terms"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_q(shown)}, {_q(f'(?:^|[^a-zA-Z0-9]){_term_regex(term)}(?:[^a-zA-Z0-9]|$)')})" for shown, term in _TERMS
) + ") AS v(shown, re)"
_DERIVED["normal"] = f"SELECT id, {_nfkd('low')} AS nt FROM texts"
_DERIVED["named"] = "SELECT id, array_to_string(list_transform(regexp_extract_all(m, '\\s+|\\S+'), " \
    "lambda x: upper(x[1]) || lower(x[2:])), '') AS skill FROM (" + " UNION ALL ".join(
        f"SELECT id, unnest(regexp_extract_all(nt, {_q(chr(92) + 'b' + p + chr(92) + 'b')})) AS m FROM normal"
        for p in rules.NAMED_SKILL_PATTERNS.values()) + ")"
_DERIVED["found"] = f"""SELECT DISTINCT id, skill FROM (
 SELECT id, shown AS skill FROM normal JOIN terms ON regexp_matches(nt, re) UNION ALL SELECT id, skill FROM named)
WHERE length(skill) BETWEEN 2 AND 60 AND NOT regexp_matches(lower(skill), '{'|'.join(rules.GENERIC_SKILL_TERMS)}')"""
# Rank: occurrences are counted in a text with doubled separators, so that neighbours share none.
_DERIVED["patterned"] = r"""SELECT f.id, f.skill, n.nt, n2.dt,
 replace(regexp_replace(lower(f.skill), '([^a-z0-9\s])', '\\\1', 'g'), ' ', '[\s\-]+') AS body,
 replace(regexp_replace(lower(f.skill), '([^a-z0-9\s])', '\\\1\\\1', 'g'), ' ', '[\s\-]+') AS dbody
FROM found f JOIN normal n ON n.id = f.id
JOIN (SELECT id, regexp_replace(nt, '([^a-zA-Z0-9])', '\1\1', 'g') AS dt FROM normal) n2 ON n2.id = f.id"""
_DERIVED["scored"] = r"""SELECT id, skill, CASE WHEN c = 0 THEN 0.1::DOUBLE
 ELSE c + (1.0::DOUBLE - p / greatest(length(nt), 1)::DOUBLE) END AS score FROM (
 SELECT id, skill, nt, len(regexp_extract_all(dt, '(?:^|[^a-zA-Z0-9])' || dbody || '(?:[^a-zA-Z0-9]|$)')) AS c,
  length(regexp_extract(nt, '(?s)^(|.*?[^a-zA-Z0-9])' || body || '(?:[^a-zA-Z0-9]|$)', 1)) AS p FROM patterned)"""
_SKILLS = ("offers", "texts", "terms", "normal", "named", "found")
ORACLES["skills_of_offers"] = _with("SELECT id, skill FROM found", *_SKILLS)
ORACLES["skill_ranking"] = _with("""
SELECT id, position, skill, round(score, 6) AS score FROM (SELECT *, row_number() OVER (
 PARTITION BY id ORDER BY score DESC, skill) AS position FROM scored) WHERE position <= 50""",
    *_SKILLS, "patterned", "scored")


def _kind_regex(terms) -> str:
    return _q(f"(?:^|[^a-zA-Z0-9])(?:{'|'.join(_term_regex(t) for t in terms)})(?:[^a-zA-Z0-9]|$)")


_KIND = f"""CASE WHEN regexp_matches(lower(skill), {_kind_regex([t for ts in rules.TECHNICAL_SKILLS.values() for t in ts])})
 THEN 'technical' WHEN regexp_matches(lower(skill), {_kind_regex(rules.SOFT_SKILLS)}) THEN 'soft_skills'
 WHEN regexp_matches(lower(skill), {_q(chr(92) + 'b' + rules.NAMED_SKILL_PATTERNS['spoken_languages'] + chr(92) + 'b')})
 THEN 'languages'
 WHEN regexp_matches(lower(skill), {_q(chr(92) + 'b' + rules.NAMED_SKILL_PATTERNS['certifications'] + chr(92) + 'b')})
 THEN 'certifications' ELSE 'other' END"""
ORACLES["skill_categories"] = _with(f"""
, k AS (SELECT id, skill, {_KIND} AS kind FROM found),
kinds AS (SELECT unnest([{', '.join(_q(k) for k in sk.SKILL_KINDS)}]) AS kind)
SELECT o.id, kinds.kind, coalesce((SELECT array_to_string(list(skill ORDER BY skill), '|') FROM k
 WHERE k.id = o.id AND k.kind = kinds.kind), '') AS skills FROM offers o, kinds""", *_SKILLS).replace(
    ") \n, k", "), k", 1)
_REFERENTIAL = [(t, c, "technical") for c, ts in rules.TECHNICAL_SKILLS.items() for t in ts] + [
    (t, "soft_skills", "soft") for t in rules.SOFT_SKILLS]
_DERIVED["referential"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_q(t)}, {_q(c)}, '{k}', {_q(f'(?:^|[^a-zA-Z0-9]){_term_regex(t)}(?:[^a-zA-Z0-9]|$)')})"
    for t, c, k in _REFERENTIAL) + ") AS v(skill, category, kind, re)"
ORACLES["skill_matches"] = _with("""
SELECT skill, category, kind, count(*) AS offers FROM normal JOIN referential ON regexp_matches(nt, re)
GROUP BY skill, category, kind""", "offers", "texts", "normal", "referential")
ORACLES["skill_matches_odd_terms"] = _with("""
SELECT skill, way, count(*) AS offers FROM offers, (SELECT unnest(['.net', '++', '<>']) AS skill), (SELECT unnest(['table', 'list']) AS way)
WHERE CAST(id AS BIGINT) % 3 = 0 GROUP BY skill, way""", "offers")
ORACLES["skill_referential"] = _with("""
SELECT DISTINCT r.skill, r.category, r.kind FROM referential r JOIN found f ON lower(f.skill) = r.skill""",
    *_SKILLS, "referential")

_DERIVED["open_offers"] = f"SELECT o.* {_OPEN}"
ORACLES["enriched_offers"] = _with(f"""
SELECT t.id AS offre_id, s.min_salary AS extracted_salary_min, s.max_salary AS extracted_salary_max,
 CASE WHEN s.min_salary IS NOT NULL THEN 'XOF' ELSE s.cur END AS extracted_salary_currency,
 {_CLASSIFIED.replace('txt', 't.txt').replace('(low', '(t.low')} AS extracted_contract_type, m.experience_years,
 coalesce((SELECT array_to_string(list(skill ORDER BY skill), '|') FROM found f WHERE f.id = t.id), '') AS skills,
 m.sector AS extracted_sector, m.job_category AS extracted_job_category, m.sentiment_score,
 coalesce(k.key_phrases, '') AS key_phrases, m.job_level, m.job_type, 'v1.0' AS processing_version,
 '2025-07-01 10:00:00' AS processed_at,
 round((1 + CAST(coalesce(k.key_phrases, '') <> '' AS INTEGER) + {_FOUND}) / 7.0::DOUBLE, 6) AS confidence_score
FROM open_offers o JOIN texts t ON t.id = o.id JOIN salaries s ON s.id = t.id JOIN semantics m ON m.id = t.id
LEFT JOIN key_phrases k ON k.id = t.id""", "offers", "enriched", "open_offers", "texts", *_SALARY[2:], *_SEMANTICS[2:],
    *_PHRASES, *_SKILLS[2:])
_REPORT = f"""
SELECT m.sector, {_CLASSIFIED.replace('txt', 't.txt').replace('(low', '(t.low')} AS contract_type,
 s.min_salary, (SELECT count(*) FROM found f WHERE f.id = t.id) AS skills
FROM texts t JOIN salaries s ON s.id = t.id JOIN semantics m ON m.id = t.id WHERE length(t.description) > 50"""
_REPORT_TABLES = (*_SALARY, *_SEMANTICS[2:], *_SKILLS[2:])
ORACLES["sector_report"] = _with(f"""
SELECT sector, contract_type, count(*) AS offers, count(min_salary) AS with_salary,
 round(avg(min_salary), 3) AS avg_min_salary, CAST(sum(skills) AS BIGINT) AS skills_found
FROM ({_REPORT}) GROUP BY sector, contract_type""", *_REPORT_TABLES)
ORACLES["incremental_enrich"] = _with(f"""
SELECT sector, contract_type, count(*) AS offers, count(min_salary) AS with_salary,
 CAST(sum(skills) AS BIGINT) AS skills_found FROM ({_REPORT}) GROUP BY sector, contract_type""", *_REPORT_TABLES)

# ------------------------------------------------------ upserts, retention
_DERIVED["items"] = """SELECT doc_id, 'https://d.example.org/' || md5(text) AS url, title, company_name,
 md5(description) AS description, contract_type AS contract, location AS region, posted_date AS posted, source,
 id AS job_count FROM postings"""
_DERIVED["old"] = """SELECT *, md5(url) AS id FROM (SELECT * REPLACE (concat_ws(' ', 'Ancien', title) AS title) FROM items
 WHERE doc_id IN (SELECT doc_id FROM labels)) QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1"""
_DERIVED["first_item"] = "SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1"
_DERIVED["last_item"] = "SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id DESC) = 1"
_UPSERT = ("postings", "items", "old", "first_item", "last_item")
# Every URL of the known rows is also in the batch, so the batch has all URLs.
ORACLES["upsert_by_url"] = _with("""
SELECT l.url, md5(l.url) AS id, l.title, l.company_name, l.description, l.contract, l.region,
 CAST(l.posted AS VARCHAR) AS posted, CASE WHEN o.url IS NULL THEN f.source ELSE o.source END AS source,
 CASE WHEN o.url IS NULL THEN f.job_count ELSE o.job_count END AS job_count
FROM last_item l JOIN first_item f ON f.url = l.url LEFT JOIN old o ON o.url = l.url""", *_UPSERT)
ORACLES["stream_upsert"] = ORACLES["upsert_by_url"]
ORACLES["upsert_without_url"] = _with("""
, b AS (SELECT * FROM items WHERE doc_id % 10 <> 3),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id DESC) = 1),
f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1)
SELECT coalesce(l.url, o.url) AS url, CASE WHEN l.url IS NULL THEN o.title ELSE l.title END AS title,
 CASE WHEN l.url IS NULL THEN o.description ELSE l.description END AS description,
 CASE WHEN o.url IS NULL THEN f.job_count ELSE o.job_count END AS job_count
FROM l JOIN f ON f.url = l.url FULL JOIN old o ON o.url = l.url
UNION ALL SELECT NULL, title, description, job_count FROM items WHERE doc_id % 10 = 3""", *_UPSERT).replace(") \n, b", "), b", 1)
ORACLES["upsert_by_key"] = _with("""
SELECT md5(url) AS id, url, title, company_name, description, contract, CAST(posted AS VARCHAR) AS posted, source,
 job_count FROM last_item""", *_UPSERT)
ORACLES["upsert_counts"] = _with("""
SELECT count(CASE WHEN url IN (SELECT url FROM old) THEN 1 END) AS updated,
 count(CASE WHEN url NOT IN (SELECT url FROM old) THEN 1 END) AS created FROM items""", *_UPSERT)
ORACLES["touched_rows"] = _with("""
SELECT id, created_text AS created_at,
 CASE WHEN contract_type = 'CDI' THEN '2025-07-01 10:00:00' ELSE created_text END AS updated_at FROM offers""", "offers")
_DERIVED["predictions"] = """SELECT id, CASE WHEN title IS NOT NULL THEN 'Finance' END AS extracted_sector,
 contract_type AS extracted_contract_type, 'Lead' AS job_level,
 CASE WHEN location = 'Dakar' THEN 'Remote' END AS job_type,
 CASE WHEN company_name IS NOT NULL THEN ['Java', company_name] END AS extracted_skills,
 length(description) AS extracted_salary_min, NULL::BIGINT AS extracted_salary_max FROM offers"""
_DERIVED["latest"] = _LATEST
_FILLED = ("extracted_sector", "extracted_contract_type", "job_level", "job_type")
ORACLES["patch_enrichment"] = _with(f"""
SELECT e.id, e.offre_id, {', '.join(f'coalesce(p.{c}, e.{c}) AS {c}' for c in _FILLED)},
 array_to_string(coalesce(p.extracted_skills, e.extracted_skills), '|') AS skills,
 coalesce(p.extracted_salary_min, e.extracted_salary_min) AS extracted_salary_min, e.extracted_salary_max,
 e.processing_version, CASE WHEN p.id IS NULL THEN strftime(e.processed_at, '%Y-%m-%d %H:%M:%S')
  ELSE '2025-07-01 10:00:00' END AS processed_at
FROM enriched e LEFT JOIN latest l ON l.id = e.id LEFT JOIN predictions p ON p.id = l.offre_id
UNION ALL SELECT md5('patch|' || p.id), p.id, {', '.join(f'p.{c}' for c in _FILLED)},
 array_to_string(p.extracted_skills, '|'), p.extracted_salary_min, NULL, '1.0', '2025-07-01 10:00:00'
FROM predictions p WHERE p.id NOT IN (SELECT offre_id FROM latest)""", "offers", "enriched", "latest", "predictions")
_DERIVED["ordered"] = """SELECT id, CASE WHEN job_type IS NULL THEN 'Achats' ELSE extracted_sector END AS extracted_sector,
 extracted_contract_type, job_level, 'On-site' AS job_type FROM predictions"""
ORACLES["patch_in_order"] = _with(f"""
SELECT e.id, e.offre_id, {', '.join(f'coalesce(p.{c}, e.{c}) AS {c}' for c in _FILLED)},
 CASE WHEN p.id IS NULL THEN strftime(e.processed_at, '%Y-%m-%d %H:%M:%S') ELSE '2025-07-01 10:00:00' END AS processed_at
FROM enriched e LEFT JOIN latest l ON l.id = e.id LEFT JOIN ordered p ON p.id = l.offre_id
UNION ALL SELECT md5('patch|' || p.id), p.id, {', '.join(f'p.{c}' for c in _FILLED)}, '2025-07-01 10:00:00'
FROM ordered p WHERE p.id NOT IN (SELECT offre_id FROM latest)""", "offers", "enriched", "latest", "predictions", "ordered")
ORACLES["retention"] = _with("""
SELECT 'offer' AS kind, id FROM offers WHERE posted_date >= DATE '2023-07-01' OR posted_date IS NULL
UNION ALL SELECT 'enrichment', id FROM enriched e WHERE NOT EXISTS (
 SELECT 1 FROM offers o WHERE o.id = e.offre_id AND o.posted_date < DATE '2023-07-01')""", "offers", "enriched")

# ------------------------------------------------------------------- pages
def _text_of(expression: str) -> str:
    """Character data of an HTML fragment without tags."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        expression = f"replace({expression}, '{entity}', {_q(char)})"
    return expression


_NAV = "regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
ORACLES["page_fields"] = f"""
SELECT page_id, {_strip(_text_of("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS title,
 {_strip(_text_of("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS heading,
 len(regexp_extract_all({_NAV}, '<a href="')) AS items,
 {_strip(_text_of("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)"))} AS ad FROM pages"""
_RESOLVED = """CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href ELSE href END"""


def _nav_links(condition: str) -> str:
    return f"""
SELECT DISTINCT page_id, 'detail' AS kind, {_RESOLVED} AS link FROM (
 SELECT page_id, url, {_text_of("unnest(regexp_extract_all(" + _NAV + ", '<a href=.([^>]*).>', 1))")} AS href FROM pages
 WHERE {condition}) WHERE href <> '' AND NOT contains({_RESOLVED}, 'page=')"""


ORACLES["listing_links"] = _nav_links("true")
ORACLES["numbered_listing_links"] = """
SELECT doc_id AS page_id, 'next' AS kind, 'https://l.example.org/sn/offres-d-emploi.php?page=' || (doc_id % 40 + 2) AS link
FROM documents"""
ORACLES["page_paragraphs"] = f"""
SELECT page_id, md5(array_to_string(list_filter(list_transform(
 regexp_extract_all(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>([^<]*)</p>', 1),
 lambda x: {_strip(_text_of('x'))}), lambda x: x <> ''), chr(10))) AS paragraphs FROM pages"""
ORACLES["json_fragment_links"] = _nav_links("NOT contains(url, '?')")

_JOINED_TEXT = f"""md5(array_to_string(list_filter([{_strip("coalesce(description, '')")}, {_strip('text')}],
 lambda x: x <> ''), chr(10)))"""
_LABEL = r"""regexp_replace(trim(regexp_replace({}, '\s+', ' ', 'g')), '[^\p{{L}}\p{{N}}_\sÀ-ÿ&''-]', '', 'g')"""
ORACLES["detail_pages_emplois"] = _with(f"""
SELECT nullif(title, '') AS title, coalesce(location, '') AS location, company_name,
 CAST(posted_date AS VARCHAR) AS posted_date,
 md5(array_to_string(list_filter([{_strip("coalesce(description, '')")}, {_strip('text')}], lambda x: x <> ''), chr(10)))
 AS description_p, md5(lang || ' ' || source) AS description_ul, contract_type,
 md5(url) AS id, url, 'emploidakar' AS source FROM postings""", "postings")
ORACLES["detail_pages_senjobs"] = _with(f"""
SELECT CAST(n_chars AS VARCHAR) || '/ mois' AS salaire, contract_type, {_JOINED_TEXT} AS description,
 source AS categorie, md5(url) AS id, url, 'senjob' AS source FROM postings""", "postings")
ORACLES["detail_pages_emploi_expatdakar"] = _with(f"""
SELECT {_LABEL.format('company_name')} AS employeur, NULL::VARCHAR AS secteur, contract_type AS type_contrat,
 NULL::VARCHAR AS niveau, NULL::VARCHAR AS niveau_etude, NULL::VARCHAR AS experience, '2' AS nb_postes,
 coalesce(title || ' ', '') AS title, strftime(posted_date, '%Y-%m-%d 00:00:00') AS posted_date,
 CAST(n_chars AS VARCHAR) AS ad_id, location, lang AS region,
 md5(array_to_string(list_filter([description, text], lambda x: x <> ''), chr(10))) AS description,
 md5(url) AS id, url, 'expat-dakar' AS source FROM postings""", "postings")
ORACLES["detail_pages_jobs_emploi_senegal"] = _with("""
SELECT title, company_name, NULL::VARCHAR AS company_sectors,
 md5(coalesce(description || chr(10), '') || chr(10) || text) AS description, coalesce(contract_type, '') AS contract,
 location AS region, NULL::VARCHAR AS education, NULL::VARCHAR AS experience, NULL::VARCHAR AS skills,
 CAST(posted_date AS VARCHAR) AS posted, NULL::VARCHAR AS metier_type, NULL::VARCHAR AS metiers, '' AS job_missions,
 lang || chr(10) AS job_profile, 'a' || chr(10) || 'b : ' || chr(10) || n_chars AS job_criteria, '' AS job_skills,
 CAST(n_chars AS VARCHAR) AS job_count, md5(url) AS id, url, 'Emploi_senegal' AS source,
 '2025-07-01 10:00:00' AS scraped_at FROM postings""", "postings")
ORACLES["detail_pages_concoursn_stages"] = _with(f"""
SELECT title, '["' || lang || '", "\\"' || source || '\\""]' AS categories, '[]' AS tags,
 strftime({NOW} - to_minutes(n_chars), '%Y-%m-%d %H:%M:%S') AS posted_date,
 md5(array_to_string(list_filter([{_strip("coalesce(description, '')")}, 'var x = "</p>";', {_strip('text')}],
 lambda x: x <> ''), chr(10))) AS description,
 CASE WHEN title = 'Acme recrute un commercial' THEN 'Acme' END AS company, '2025-07-01 10:00:00' AS scraped_at,
 md5(url) AS id, url, 'concoursn' AS source FROM postings""", "postings")
ORACLES["listing_items"] = _with("""
SELECT md5(u) AS id, u AS url, coalesce(title, '') AS title,
 trim(coalesce(location, '') || ' Sénégal') AS location, CAST(posted_date AS VARCHAR) AS posted_date,
 lang AS expiration, 'senjob' AS source
FROM (SELECT *, 'https://l.example.org/offre/' || id || '.html' AS u FROM postings)""", "postings")
ORACLES["site_listing_links"] = _with("""
SELECT doc_id AS page_id, kind, link, site FROM (
 SELECT doc_id, id, unnest([
  {'site': 'jobs_emploi_senegal', 'kind': 'detail', 'link': 'https://s.example.org/offre/' || id},
  {'site': 'jobs_emploi_senegal', 'kind': 'next', 'link': 'https://s.example.org/a/b?p=2'},
  {'site': 'concoursn_stages', 'kind': 'detail', 'link': 'https://s.example.org/a/stage/' || id},
  {'site': 'concoursn_stages', 'kind': 'next', 'link': 'https://s.example.org/p/2'},
  {'site': 'emploi_expatdakar', 'kind': 'detail', 'link': 'https://s.example.org/annonce/' || id},
  {'site': 'emploi_expatdakar', 'kind': 'next', 'link': 'https://s.example.org/l?p=2'},
  {'site': 'emplois', 'kind': 'detail', 'link': 'https://e.example.org/' || id}], recursive := true)
 FROM postings)""", "postings")

# ------------------------------------------------------- tables and files
ORACLES["table_round_trip"] = _with("""
SELECT f.format, id, title, md5(description) AS description
FROM offers, (SELECT unnest(['csv', 'json', 'parquet']) AS format) f
UNION ALL SELECT 'csv lines', id, title, md5('-') FROM offers""", "offers")
ORACLES["stored_enrichments"] = _with("""
SELECT id, offre_id, extracted_sector, array_to_string(extracted_skills, '|') AS skills,
 strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at FROM enriched""", "enriched")
ORACLES["training_snapshot"] = _with(f"""
SELECT id, title, CASE WHEN extracted_skills IS NULL THEN NULL ELSE '["' || array_to_string(extracted_skills, '","') || '"]' END
 AS extracted_skills, extracted_salary_min FROM ({_EXTRACT})""", "offers", "enriched")
ORACLES["repeated_consolidation"] = _with(f"""
SELECT spider_source, count(*) AS offers, count(posted_date) AS dated FROM ({_MAPPED}) GROUP BY spider_source""",
    *fx.RAW)
ORACLES["stored_statistics"] = f"""
SELECT md5(concat(metric_name, '|', metric_value, '|', period_end)) AS id, metric_name, metric_value, period_end,
 category, '2025-07-01 10:00:00' AS created_at
FROM ({ORACLES['offers_by_sector']} UNION ALL SELECT * FROM ({ORACLES['offers_by_contract_type']}))"""
ORACLES["enriched_csv"] = _with("""
SELECT id, offre_id, extracted_salary_min,
 CASE WHEN extracted_skills IS NULL THEN NULL ELSE '["' || array_to_string(extracted_skills, '","') || '"]' END
 AS extracted_skills, extracted_sector FROM enriched""", "enriched")

# -------------------------------------------------------------- imputation
ORACLES["stratified_split"] = """
WITH n AS (SELECT lang, count(*) AS size FROM documents GROUP BY lang),
w AS (SELECT CAST(ceil(sum(size) * 0.2::DOUBLE) AS BIGINT) AS wanted, sum(size) AS total FROM n),
x AS (SELECT lang, wanted, wanted * size / total::DOUBLE AS exact FROM n, w),
y AS (SELECT *, floor(exact) AS whole, row_number() OVER (ORDER BY exact - floor(exact) DESC, lang) AS turn FROM x),
q AS (SELECT lang, whole + CASE WHEN turn <= wanted - (SELECT sum(whole) FROM y) THEN 1 ELSE 0 END AS quota FROM y)
SELECT doc_id, lang, rn <= quota AS is_validation FROM (
 SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS rn
 FROM documents) JOIN q USING (lang)"""
ORACLES["label_index"] = _with("""
SELECT row_number() OVER (ORDER BY extracted_sector) - 1 AS position, extracted_sector AS label FROM (
 SELECT DISTINCT extracted_sector FROM enriched WHERE extracted_sector IS NOT NULL)""", "enriched")
ORACLES["classification_figures"] = """
WITH p AS (SELECT lang, CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS label FROM documents),
c AS (SELECT l.lang, count(*) FILTER (WHERE p.lang = l.lang)::DOUBLE AS actual, count(*) FILTER (WHERE p.label = l.lang)::DOUBLE
 AS said, count(*) FILTER (WHERE p.label = l.lang AND p.lang = l.lang)::DOUBLE AS hit
 FROM (SELECT DISTINCT lang FROM documents) l, p GROUP BY l.lang)
SELECT round(sum(hit) / sum(actual), 9) AS accuracy,
 round(sum(actual * CASE WHEN hit = 0 THEN 0 ELSE 2 * hit / (actual + said) END) / sum(actual), 9) AS f1 FROM c"""
ORACLES["imputation_contract"] = """
SELECT count(*) AS predicted, count(DISTINCT doc_id) AS documents, true AS known_labels, true AS accepted_by_confidence,
 true AS confidence_of_best FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL)"""
ORACLES["full_imputation_rows"] = _with(f"""
SELECT "column", non_null AS "before", true AS kept, (SELECT count(*) FROM ({_EXTRACT})) AS "rows"
FROM ({_completeness(f"({_EXTRACT})")})""", "offers", "enriched")
_FILL = f"""SELECT l.offre_id, {', '.join(f'coalesce(l.{c}, p.{c}) AS {c}' for c in (
    *_FILLED, 'extracted_skills', 'extracted_salary_min', 'extracted_salary_max'))}
FROM latest l LEFT JOIN predictions p ON p.id = l.offre_id"""
ORACLES["fill_missing"] = _with(f"""
SELECT * EXCLUDE (extracted_skills), array_to_string(extracted_skills, '|') AS skills FROM ({_FILL})""", "offers", "enriched", "latest", "predictions")
ORACLES["fill_report"] = _with(f"""
, filled AS ({_FILL}),
b AS ({_completeness('latest')}), a AS ({_completeness('filled')})
SELECT b."column", b.non_null AS "before", a.non_null AS "after", a.non_null - b.non_null AS improvement
FROM b JOIN a ON a."column" = b."column" """, "offers", "enriched", "latest", "predictions").replace(
    ") \n, filled", "), filled", 1)
ORACLES["impute_by_rules"] = _with(f"""
SELECT count(*) AS total,
 count(CASE WHEN x.id IN (SELECT id FROM found) THEN 1 END) AS with_skills, count(s.min_salary) AS with_salary
FROM (SELECT id FROM ({_EXTRACT}) WHERE extracted_sector IS NULL) x JOIN salaries s ON s.id = x.id""",
    "offers", "enriched", *_SALARY[1:], *_SKILLS[2:])

# --------------------------------------------------------------- streaming
ORACLES["stream_dedup"] = """
SELECT DISTINCT md5('https://d.example.org/' || md5(text)) AS id, 'https://d.example.org/' || md5(text) AS url
FROM documents"""
ORACLES["stream_first"] = """
SELECT md5('https://d.example.org/' || md5(text)) AS id, arg_min(doc_id, (1 - doc_id % 2, doc_id)) AS doc_id,
 arg_min(lang, (1 - doc_id % 2, doc_id)) AS lang FROM documents GROUP BY text"""
ORACLES["stream_dedup_events"] = """
SELECT DISTINCT md5(u) AS id, u AS url
FROM (SELECT 'https://e.example.org/' || event_type || '/' || user_id AS u FROM events)"""

ORACLES["stream_first_expiring"] = """
WITH e AS (SELECT *, epoch_us(ts) AS us, 'https://e.example.org/' || event_type || '/' || user_id AS url,
  least(3, (day(ts) - 1) // 8 + CASE WHEN event_id % 10 = 3 THEN 1 WHEN event_id % 50 = 4 THEN 2 ELSE 0 END)::INT AS arrival FROM events),
marks AS (SELECT a.arrival, max(b.us) // 1000 * 1000 - 5 * 86400000000 AS mark
  FROM (SELECT DISTINCT arrival FROM e) a LEFT JOIN e b ON b.arrival < a.arrival GROUP BY a.arrival),
live AS (SELECT e.* FROM e JOIN marks m ON m.arrival = e.arrival WHERE m.mark IS NULL OR e.us > m.mark),
runs AS (SELECT url, list({'last': us, 'kept': [event_id]} ORDER BY arrival, us, event_id) AS views FROM live GROUP BY url),
kept AS (SELECT unnest(list_reduce(views, lambda s, x: CASE WHEN x.last >= s.last + 4 * 86400000000
  THEN {'last': x.last, 'kept': list_concat(s.kept, x.kept)} ELSE s END).kept) AS event_id FROM runs)
SELECT md5(url) AS id, url, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value, props, arrival FROM live JOIN kept USING (event_id)"""
ORACLES["incremental_enrich_rest"] = _with(f"""
SELECT id AS offre_id, sector, contract_type FROM ({_REPORT.replace("SELECT", "SELECT t.id AS id,", 1)}) r
WHERE id NOT IN (SELECT offre_id FROM enriched WHERE offre_id IS NOT NULL)""", *_REPORT_TABLES, "enriched")

# ------------------------------------------- selection, calibration, jobs
_SAID = """said AS (SELECT 'lang' AS "column", c.candidate, lang AS actual, (doc_id % 97)::DOUBLE / 97 AS confidence,
  CASE WHEN doc_id % c.every = 0 THEN 'en' WHEN doc_id % 97 < c.every THEN 'fr' ELSE lang END AS label
  FROM documents, (VALUES (0.01::DOUBLE, 5), (0.1::DOUBLE, 9), (1.0::DOUBLE, 9)) c(candidate, every))"""
ORACLES["candidate_metrics"] = f"""
WITH {_SAID},
a AS (SELECT candidate, actual AS name, count(*) AS there, count(*) FILTER (WHERE actual = label) AS hit FROM said GROUP BY ALL),
l AS (SELECT candidate, label AS name, count(*) AS said FROM said GROUP BY ALL),
f AS (SELECT candidate, sum(there)::BIGINT AS "rows", sum(hit) / sum(there) AS accuracy,
  sum(there * 2 * hit / (there + coalesce(said, 0))) / sum(there) AS f1 FROM a LEFT JOIN l USING (candidate, name) GROUP BY candidate)
SELECT 'lang' AS "column", candidate, "rows", round(accuracy, 9) AS accuracy, round(f1, 9) AS f1,
 row_number() OVER (ORDER BY f1 DESC, candidate) = 1 AS chosen FROM f"""
# The pooled probability of a bin: the largest over its beginnings of the smallest over its ends of the mean between them.
ORACLES["candidate_reliability"] = f"""
WITH {_SAID},
b AS (SELECT least(floor(confidence * 10), 9)::INT AS bin, count(*) AS "rows", count(*) FILTER (WHERE actual = label) AS hits,
  avg(confidence) AS confidence FROM said WHERE candidate = 0.1 GROUP BY ALL),
spans AS (SELECT x.bin AS low, y.bin AS high, sum(z.hits + z.confidence) / sum(z."rows" + 1) AS mean
  FROM b x JOIN b y ON x.bin <= y.bin JOIN b z ON z.bin BETWEEN x.bin AND y.bin GROUP BY ALL),
worth AS (SELECT bin, max(mean) AS probability FROM (
  SELECT b.bin, s.low, min(s.mean) AS mean FROM b JOIN spans s ON s.low <= b.bin AND s.high >= b.bin GROUP BY ALL) GROUP BY bin)
SELECT b.bin, "rows", hits, round(confidence, 9) AS confidence, round(probability, 9) AS probability, probability >= 0.7 AS accepted
FROM b JOIN worth USING (bin)"""
ORACLES["acceptance_of_predictions"] = f"""
WITH {_SAID}
SELECT candidate, count(*) FILTER (WHERE confidence >= 0.7) AS accepted, count(*) AS total,
 round(count(*) FILTER (WHERE confidence >= 0.7)::DOUBLE / count(*), 9) AS rate FROM said GROUP BY candidate"""
ORACLES["model_selection"] = """
SELECT c AS "column", 2::BIGINT AS candidates, ceil(count(*) * 0.2)::BIGINT AS "rows", true AS agree, true AS best_is_best, true AS learned
FROM documents d JOIN labels l USING (doc_id), (VALUES ('quality'), ('language')) t(c) WHERE l.quality IS NOT NULL GROUP BY c"""
ORACLES["train_job"] = _with(f"""
, n AS (SELECT count(*) AS n FROM ({_EXTRACT}) WHERE {' AND '.join(f'{c} IS NOT NULL' for c in rules.TARGET_COLUMNS)})
SELECT n AS least, true AS trained, 'extracted_contract_type,extracted_sector,job_level,job_type' AS models, true AS calibrated FROM n
UNION ALL SELECT n + 1, false, '', true FROM n""", "offers", "enriched").replace(") \n, n AS", "), n AS", 1)
_JOB = f"""
, asked AS (SELECT DISTINCT id FROM ({_EXTRACT}) WHERE extracted_sector IS NULL),
newest AS (SELECT id FROM enriched WHERE offre_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY offre_id ORDER BY processed_at DESC, id DESC) = 1),
skill_counts AS (SELECT id, count(*) AS skills FROM found GROUP BY id),
rows_ AS (
 SELECT e.offre_id, a.id IS NOT NULL AS changed, e.processing_version AS version, e.extracted_sector, e.extracted_skills, s.skills
 FROM enriched e LEFT JOIN asked a ON a.id = e.offre_id AND e.id IN (SELECT id FROM newest) LEFT JOIN skill_counts s ON s.id = a.id
 UNION ALL
 SELECT a.id, true, '1.0', NULL, NULL, s.skills FROM asked a LEFT JOIN skill_counts s ON s.id = a.id
 WHERE a.id NOT IN (SELECT offre_id FROM enriched WHERE offre_id IS NOT NULL))
SELECT offre_id, changed, version, CASE WHEN NOT changed THEN extracted_sector END AS old_sector,
 CASE WHEN changed THEN coalesce(skills, len(extracted_skills))::INT END AS skills FROM rows_"""
ORACLES["predict_job"] = _with(_JOB, "offers", "enriched", "texts", *_SKILLS[2:]).replace(") \n, asked", "), asked", 1)
ORACLES["full_job"] = ORACLES["predict_job"]
ORACLES["ensured_table"] = _with("""
SELECT spider_source, count(*) AS offers, count(posted_date) AS dated, max(created_text) AS newest FROM offers GROUP BY spider_source""", "offers")
ORACLES["split_files"] = _with("""
SELECT f.format, id, title, md5(description) AS description, contract_type FROM offers, (VALUES ('csv'), ('json')) f(format)""", "offers")
ORACLES["overview_of_states"] = f"""
SELECT month AS period, total_offers, avg_salary_min, avg_salary_max, most_common_contract, most_common_sector, true AS companies_close,
 true AS locations_close, true AS median_close FROM ({ORACLES["job_market_overview"]})"""
ORACLES["phrases_of_all_offers"] = _with("""
, own AS (SELECT phrase, sum(n)::BIGINT AS own, string_split(phrase, ' ') AS words FROM phrases GROUP BY phrase),
inside AS (SELECT phrase AS whole, own, array_to_string(words[a:b], ' ') AS phrase
  FROM (SELECT *, unnest(range(a, len(words) + 1)) AS b FROM (SELECT *, unnest(range(1, len(words) + 1)) AS a FROM own))
  WHERE b - a + 1 < len(words)),
total AS (SELECT o.phrase, o.words, (own + coalesce((SELECT sum(own) FROM inside i WHERE i.phrase = o.phrase), 0))::BIGINT AS n FROM own o),
held AS (SELECT i.phrase, count(*) AS longer, sum(t.n) AS above FROM (SELECT DISTINCT phrase, whole FROM inside) i
  JOIN total t ON t.phrase = i.whole GROUP BY i.phrase)
SELECT t.phrase, t.n, coalesce(h.longer, 0) AS longer, round(log2(len(words) + 1) * (t.n - coalesce(above::DOUBLE / h.longer, 0)), 6) AS value
FROM total t LEFT JOIN held h ON h.phrase = t.phrase ORDER BY value DESC, t.phrase LIMIT 500""", "offers", "texts", "marked", "phrases").replace(
    ") \n, own", "), own", 1)
