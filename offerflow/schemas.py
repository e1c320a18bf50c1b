"""Explicit schemas of every table (never inferred) and table creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())


def _schema(text_columns: str = "", **typed: T.DataType) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in text_columns.split()]
    return T.StructType(fields + [T.StructField(c, t) for c, t in typed.items()])


# Columns of the five raw source tables.
RAW_SCHEMAS = {
    "emplois": _schema(
        "id title url location company_name posted_date source description_p description_ul contract_type"),
    "senjobs": _schema(
        "id title url location posted_date source description expiration salaire categorie contract_type"),
    "emploi_expatdakar": _schema(
        "id title posted_date ad_id location region employeur secteur type_contrat niveau niveau_etude "
        "experience nb_postes description url source"),
    "concoursn_stages": _schema(
        "id title url source categories tags", posted_date=T.TimestampNTZType(),
        description=T.StringType(), company=T.StringType(), scraped_at=T.TimestampNTZType()),
    "jobs_emploi_senegal": _schema(
        "id url title company_name company_sectors description contract region education experience skills",
        posted=T.DateType(), metiers=T.StringType(), metier_type=T.StringType(), source=T.StringType(),
        scraped_at=T.TimestampNTZType(), job_missions=T.StringType(), job_profile=T.StringType(),
        job_criteria=T.StringType(), job_skills=T.StringType(), job_count=T.StringType()),
}

# Columns of the derived tables.
OFFERS = _schema(
    "id spider_source original_id title url location company_name",
    posted_date=T.DateType(), source=T.StringType(), description=T.StringType(),
    contract_type=T.StringType(), salary=T.StringType(), category=T.StringType(), sector=T.StringType(),
    experience_level=T.StringType(), education_level=T.StringType(), nb_positions=T.IntegerType(),
    expiration_date=T.DateType(), created_at=T.TimestampNTZType(), updated_at=T.TimestampNTZType())

ENRICHED = _schema(
    "id offre_id", extracted_salary_min=T.LongType(), extracted_salary_max=T.LongType(),
    extracted_salary_currency=T.StringType(), extracted_contract_type=T.StringType(),
    extracted_experience_years=T.IntegerType(), extracted_skills=_STRINGS,
    extracted_sector=T.StringType(), extracted_job_category=T.StringType(),
    sentiment_score=T.DoubleType(), key_phrases=_STRINGS, job_level=T.StringType(),
    job_type=T.StringType(), processing_version=T.StringType(), processed_at=T.TimestampNTZType(),
    confidence_score=T.DoubleType())

SKILLS_REF = _schema(
    "id competence_name category subcategory description", created_at=T.TimestampNTZType())

STATISTICS = _schema(
    "id metric_name metric_value", period_start=T.DateType(), period_end=T.DateType(),
    category=T.StringType(), location=T.StringType(), created_at=T.TimestampNTZType())

USER_PROFILES = _schema(
    "id email phone first_name last_name location", experience_years=T.IntegerType(),
    education_level=T.StringType(), skills=_STRINGS, preferred_contract_type=_STRINGS,
    preferred_salary_min=T.LongType(), preferred_salary_max=T.LongType(), cv_url=T.StringType(),
    created_at=T.TimestampNTZType(), updated_at=T.TimestampNTZType())

RECOMMENDATIONS = _schema(
    "id user_id job_id", match_score=T.DoubleType(), match_reasons=_STRINGS,
    is_viewed=T.BooleanType(), is_applied=T.BooleanType(), created_at=T.TimestampNTZType())


def table_schemas() -> dict[str, T.StructType]:
    """Every table of the data model by name."""
    return RAW_SCHEMAS | {
        "offers": OFFERS, "offers_enriched": ENRICHED, "skills_ref": SKILLS_REF,
        "job_statistics": STATISTICS, "user_profiles": USER_PROFILES,
        "job_recommendations": RECOMMENDATIONS,
    }


def ensure_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Create the table as Parquet at ``location`` unless it exists, and return it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schemas()[name])
    where = location.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet LOCATION '{where}'")
    return spark.table(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: cast what exists, add typed NULLs for what does not."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])
