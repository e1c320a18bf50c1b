"""The enrichment job: backlog, text analysis and assembly of enrichment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules, schemas
from offerflow.functions.contract import classify_lowered
from offerflow.functions.dates import moment
from offerflow.functions.salary import with_salary
from offerflow.functions.semantics import analyze_offer_text
from offerflow.functions.skills import with_skills
from offerflow.functions.text import lowered_text, offer_text
from offerflow.operators.keyed import left_join_many

MIN_DESCRIPTION = 50
ENRICH_VERSION = "v1.0"

# Columns of the offer extract used for imputation.
EXTRACT_COLUMNS = (
    "id", "title", "description", "company_name", "location", "posted_date", "extracted_sector",
    "extracted_contract_type", "extracted_skills", "extracted_salary_min", "extracted_salary_max",
    "job_level", "job_type", "confidence_score",
)


def enrichable() -> Column:
    return F.length("description") > MIN_DESCRIPTION


def newest_first(column: str, tie: str = "id") -> list[Column]:
    """Descending with NULLs first, and a tie-break that makes the order total."""
    return [F.desc_nulls_first(column), F.asc(tie)]


def backlog(offers: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """Enrichable offers without an enrichment: all of them, or with a ``limit`` that many, newest first."""
    done = enriched.where("offre_id IS NOT NULL").select(F.col("offre_id").alias("id")).distinct()
    open_offers = offers.where(enrichable()).join(done, "id", "left_anti").select(*offers.columns)
    if limit is None:
        return open_offers
    # The top-k runs on ids and dates only; its ids then select the wide rows, by a broadcast if Spark finds them few.
    chosen = open_offers.select("id", "posted_date").orderBy(*newest_first("posted_date")).limit(limit)
    return open_offers.join(chosen.select("id"), "id", "left_semi") \
        .select(*offers.columns).orderBy(*newest_first("posted_date"))


def offers_left_enriched(offers: DataFrame, enriched: DataFrame) -> DataFrame:
    """Every offer with each of its enrichments, or with NULLs."""
    facts = enriched.where("offre_id IS NOT NULL").withColumnRenamed("offre_id", "_offer").drop("id")
    overlap = [c for c in facts.columns if c in offers.columns]
    return left_join_many(offers, facts.drop(*overlap).withColumnRenamed("_offer", "id"), "id")


def enriched_inner_offers(enriched: DataFrame, offers: DataFrame) -> DataFrame:
    """Enrichments with the posting data of their offer."""
    posting = offers.select(F.col("id").alias("offre_id"), "posted_date")
    return enriched.join(posting, "offre_id", "inner")


def read_offers_with_enrichment(offers: DataFrame, enriched: DataFrame) -> DataFrame:
    """The extract for imputation: described offers and their enrichments, newest first."""
    described = offers.where("description IS NOT NULL")
    joined = offers_left_enriched(described, enriched)
    return joined.orderBy(*newest_first("created_at")).select(*EXTRACT_COLUMNS)


def _with_text(offers: DataFrame) -> DataFrame:
    return offers.withColumn("_text", offer_text(F.col("title"), F.col("description")))


def analyze(offers: DataFrame, phrases: bool = False) -> DataFrame:
    """Offers with the structs ``nlp`` and ``salary_info``, ``skills`` and ``classified``: one scan, no exchange."""
    df = analyze_offer_text(_with_text(offers), "_text", phrases)
    df = with_salary(df.withColumn("_lowered", lowered_text(F.col("_text"))), "_text", lowered="_lowered")
    df = with_skills(df.withColumn("classified", classify_lowered(F.col("_lowered"))), "_text")
    return df.drop("_text", "_lowered")


def enrich_offers(offers: DataFrame, as_of: str, phrases: bool = True) -> DataFrame:
    """One enrichment row per offer."""
    analyzed = analyze(offers, phrases).select("id", "contract_type", "nlp", "salary_info", "skills", "classified")
    nlp, salary = F.col("nlp"), F.col("salary_info")
    return schemas.conform(analyzed.select(
        F.md5(F.concat_ws("|", F.lit(ENRICH_VERSION), "id")).alias("id"),
        F.col("id").alias("offre_id"),
        salary["min_salary"].alias("extracted_salary_min"),
        salary["max_salary"].alias("extracted_salary_max"),
        salary["currency"].alias("extracted_salary_currency"),
        F.coalesce("classified", "contract_type").alias("extracted_contract_type"),
        nlp["experience_years"].alias("extracted_experience_years"),
        F.col("skills").alias("extracted_skills"),
        nlp["sector"].alias("extracted_sector"),
        nlp["job_category"].alias("extracted_job_category"),
        nlp["sentiment_score"].alias("sentiment_score"),
        F.coalesce(nlp["key_phrases"], F.array().cast("array<string>")).alias("key_phrases"),
        nlp["job_level"].alias("job_level"),
        nlp["job_type"].alias("job_type"),
        F.lit(ENRICH_VERSION).alias("processing_version"),
        moment(as_of).alias("processed_at"),
        F.coalesce(nlp["confidence_score"], F.lit(rules.EMPTY_TEXT_CONFIDENCE)).alias("confidence_score"),
    ), schemas.ENRICHED)
