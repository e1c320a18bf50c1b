"""Offer tables derived from the given tables, whole tables and whole texts.

The given tables hold invented prose, so offers are derived from ``documents``: every
document becomes one offer, its description a job phrase followed by the whole document
text. The SQL runs unchanged in Spark and in DuckDB. Offers "already known" or "already
enriched" are those whose document has a row in ``labels``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2025-07-01 10:00:00"
TABLES = ("documents", "labels", "pages", "events", "orders", "customer", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run portable SQL over the given tables."""
    names = [n for n in TABLES if re.search(rf"\b(FROM|JOIN) {n}\b", sql)]
    bound = re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b", r"\1 {\2}", sql)
    return spark.sql(bound, **{n: table(spark, sf_dir, n) for n in names})


# One row per document: the facts from which all offer tables are cut.
POSTINGS = """
WITH t(k, title, company_name, location) AS (VALUES
 (0,'Développeur Python Senior','Acme SN','Dakar'), (1,'Comptable confirmé','Baobab Audit','Thiès'),
 (2,'Stagiaire marketing','Teranga Média','Dakar'), (3,'Chef de projet digital','Acme SN','Saint-Louis'),
 (4,'Technicien support',NULL,'Dakar'), (5,'Data engineer','Sahel Data',NULL),
 (6,'Acme recrute un commercial','Acme SN','Kaolack'), (7,NULL,'Teranga Média','Dakar')),
p(k, phrase) AS (VALUES
 (0,'CDI temps plein, 5 ans d''expérience, Python, SQL et Docker. Salaire 300 000 à 450 000 FCFA par mois.'),
 (1,'CDD 6 mois, télétravail, Excel et communication. Rémunération 1 200 000 FCFA par an.'),
 (2,'Stage de 3 mois en marketing digital, teamwork, anglais courant. 100 000 FCFA.'),
 (3,'Freelance consultant AWS certified, Kubernetes, CI/CD. 500 USD par jour.'),
 (4,'Mission ponctuelle d''intérim, remplacement, mi-temps 20h. 15000 FCFA/jour.'),
 (5,'Banque et audit, comptabilité, 3 années expérience, opportunité, avantage.'),
 (6,'Machine learning, data engineering, big data, PyTorch, React Native. 2000 EUR par mois.'),
 (7,'Agile, Scrum, Six Sigma, PMP, leadership, gestion de projet.'),
 (8,'Poste urgent, risque, stress, salaire de 850.'),
 (9,'Vente et business development, entre 200 000 et 150 000 FCFA.'),
 (10,'Court.'),
 (11,'Ressources humaines, recrutement, formation continue, c++ c# next.js node.js.'))
SELECT d.doc_id AS doc_id, CAST(d.doc_id AS VARCHAR(20)) AS id, d.doc_id % 5 AS site, d.lang AS lang,
 d.text AS text, d.n_chars AS n_chars,
 concat('https://offers.example.org/', CAST(d.doc_id AS VARCHAR(20))) AS url,
 t.title AS title, t.company_name AS company_name, t.location AS location,
 CASE WHEN d.doc_id % 11 = 3 THEN CAST(NULL AS DATE)
  ELSE DATE '2025-07-01' - CAST((d.doc_id * 7) % 900 AS INT) END AS posted_date,
 CASE WHEN d.doc_id % 13 = 5 THEN NULL WHEN d.doc_id % 12 = 10 THEN p.phrase
  ELSE concat(p.phrase, ' ', d.text) END AS description,
 CASE d.doc_id % 4 WHEN 0 THEN 'CDI' WHEN 1 THEN 'CDD' WHEN 2 THEN 'Stage' ELSE NULL END AS contract_type,
 d.source AS source
FROM documents d JOIN t ON t.k = d.doc_id % 8 JOIN p ON p.k = d.doc_id % 12
"""

OFFERS = f"""
SELECT id,
 CASE site WHEN 0 THEN 'emploi' WHEN 1 THEN 'senjob' WHEN 2 THEN 'emploi_expatDakar'
  WHEN 3 THEN 'emploi_senegal' ELSE 'concoursn_stages' END AS spider_source,
 md5(url) AS original_id, title, url, location, company_name, posted_date, source, description, contract_type,
 CAST(NULL AS VARCHAR(20)) AS salary, CAST(NULL AS VARCHAR(20)) AS category, CAST(NULL AS VARCHAR(20)) AS sector,
 CAST(NULL AS VARCHAR(20)) AS experience_level, CAST(NULL AS VARCHAR(20)) AS education_level,
 1 AS nb_positions, CAST(NULL AS DATE) AS expiration_date,
 CASE WHEN posted_date IS NULL THEN '2025-07-01 10:00:00'
  ELSE concat(CAST(posted_date AS VARCHAR(10)), ' 08:00:00') END AS created_text
FROM ({POSTINGS}) AS postings
"""

# Raw tables: every document is in exactly one of the five.
RAW = {
    "emplois": f"""
SELECT md5(url) AS id, title, url, location, company_name, CAST(posted_date AS VARCHAR(10)) AS posted_date,
 'emploidakar' AS source, CASE WHEN lang = 'en' THEN NULL ELSE description END AS description_p,
 CASE WHEN lang = 'de' THEN NULL ELSE '- ' || description END AS description_ul, contract_type
FROM ({POSTINGS}) AS postings WHERE site = 0""",
    "senjobs": f"""
SELECT CASE WHEN lang = 'es' AND title IS NULL THEN NULL ELSE md5(url) END AS id, title, url, location,
 CASE WHEN lang = 'fr' THEN 'à convenir' ELSE CAST(posted_date AS VARCHAR(10)) END AS posted_date,
 'senjob' AS source, description,
 CASE WHEN lang = 'de' THEN 'bientôt' ELSE CAST(posted_date + 30 AS VARCHAR(10)) END AS expiration,
 concat(CAST(n_chars AS VARCHAR(20)), '/ mois') AS salaire, lang AS categorie, contract_type
FROM ({POSTINGS}) AS postings WHERE site = 1""",
    "emploi_expatdakar": f"""
SELECT md5(url) AS id, title, CAST(posted_date AS VARCHAR(10)) || ' 00:00:00' AS posted_date,
 CAST(n_chars AS VARCHAR(20)) AS ad_id, location, lang AS region, company_name AS employeur, lang AS secteur,
 contract_type AS type_contrat, 'Confirmé' AS niveau, 'Bac+5' AS niveau_etude, '3 ans' AS experience,
 CASE lang WHEN 'fr' THEN '3 postes' WHEN 'de' THEN NULL ELSE CAST(n_chars % 7 AS VARCHAR(20)) END AS nb_postes,
 description, url, 'expat-dakar' AS source
FROM ({POSTINGS}) AS postings WHERE site = 2""",
    "jobs_emploi_senegal": f"""
SELECT md5(url) AS id, url, title, company_name, lang AS company_sectors, description, contract_type AS contract,
 location AS region, 'Bac+3' AS education, '2 ans' AS experience, 'Excel' AS skills, posted_date AS posted,
 'IT' AS metiers, lang AS metier_type, 'Emploi_senegal' AS source
FROM ({POSTINGS}) AS postings WHERE site = 3""",
    "concoursn_stages": f"""
SELECT md5(url) AS id, title, url, 'concoursn' AS source, concat('["', lang, '"]') AS categories, '[]' AS tags,
 posted_date, description, company_name AS company
FROM ({POSTINGS}) AS postings WHERE site = 4""",
}

# Enrichments: one per labelled document, an older second one where the quality label is 0,
# and rows that lost their offer where the toxic label is 1.
ENRICHED = """
WITH base AS (
 SELECT d.doc_id AS doc_id, d.n_chars AS n_chars, l.quality AS quality, l.toxic AS toxic
 FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
rows_ AS (
 SELECT doc_id, n_chars, 0 AS version, CAST(doc_id AS VARCHAR(20)) AS offre_id FROM base
 UNION ALL SELECT doc_id, n_chars, 1 AS version, CAST(doc_id AS VARCHAR(20)) AS offre_id FROM base WHERE quality = 0
 UNION ALL SELECT doc_id, n_chars, 2 AS version, CAST(NULL AS VARCHAR(20)) AS offre_id FROM base WHERE toxic = 1)
SELECT md5(concat(CAST(doc_id AS VARCHAR(20)), ':', CAST(version AS VARCHAR(20)))) AS id, offre_id,
 CASE WHEN doc_id % 6 = 4 THEN NULL ELSE 50000 + n_chars * 37 + version END AS extracted_salary_min,
 CASE WHEN doc_id % 6 = 4 OR doc_id % 17 = 1 THEN NULL ELSE 60000 + n_chars * 41 END AS extracted_salary_max,
 'XOF' AS extracted_salary_currency,
 CASE doc_id % 4 WHEN 0 THEN 'CDI' WHEN 1 THEN 'Stage' WHEN 2 THEN 'CDD' ELSE NULL END AS extracted_contract_type,
 CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(doc_id % 12 AS INT) END AS extracted_experience_years,
 CASE doc_id % 5 WHEN 0 THEN 'Python,Sql' WHEN 1 THEN 'Excel' WHEN 2 THEN 'Python,Docker,Agile'
  WHEN 3 THEN 'Communication,Leadership' ELSE NULL END AS skills_text,
 CASE doc_id % 7 WHEN 0 THEN 'IT/Tech' WHEN 1 THEN 'Finance' WHEN 2 THEN 'IT/Tech' WHEN 3 THEN 'Marketing'
  WHEN 4 THEN 'HR' WHEN 5 THEN 'Sales' ELSE NULL END AS extracted_sector,
 'Support' AS extracted_job_category,
 CASE doc_id % 3 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Senior' ELSE NULL END AS job_level,
 CASE WHEN doc_id % 9 = 2 THEN NULL ELSE 'Full-time' END AS job_type,
 'v1.0' AS processing_version,
 concat(CAST(DATE '2025-07-01' - CAST(doc_id % 40 AS INT) AS VARCHAR(10)),
  CASE version WHEN 0 THEN ' 09:00:00' ELSE ' 03:00:00' END) AS processed_text
FROM rows_
"""


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, POSTINGS)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.col("created_text").cast("timestamp_ntz")
    return run_sql(spark, sf_dir, OFFERS).select("*", created.alias("created_at"), created.alias("updated_at")) \
        .drop("created_text")


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: run_sql(spark, sf_dir, sql) for name, sql in RAW.items()}


def labelled(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows of an offer table whose document has a label."""
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return rows.join(ids, "id", "left_semi").select(*rows.columns)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, ENRICHED).select(
        "id", "offre_id", F.col("extracted_salary_min").cast("bigint"),
        F.col("extracted_salary_max").cast("bigint"), "extracted_salary_currency", "extracted_contract_type",
        "extracted_experience_years", F.split("skills_text", ",").alias("extracted_skills"), "extracted_sector",
        "extracted_job_category", F.lit(0.0).alias("sentiment_score"),
        F.array().cast("array<string>").alias("key_phrases"), "job_level", "job_type", "processing_version",
        F.col("processed_text").cast("timestamp_ntz").alias("processed_at"), F.lit(0.5).alias("confidence_score"))
