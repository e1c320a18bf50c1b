"""Market statistics, counts and completeness figures."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.dates import NTZ, day
from offerflow.operators.enrich import enriched_inner_offers, offers_left_enriched
from offerflow.operators.keyed import median_of_counts, single_row
from offerflow.workdir import written

TOP_SECTORS, TOP_SKILLS = 5, 10


def posted_since(as_of: str, months: int = 0, days: int = 0) -> Column:
    return F.col("posted_date") >= F.date_sub(F.add_months(day(as_of), -months), days)


def created_since(as_of: str, days: int = 0) -> Column:
    return F.col("created_at") >= F.date_sub(day(as_of), days).cast(NTZ)


def processed_since(as_of: str) -> Column:
    return F.col("processed_at") >= day(as_of).cast(NTZ)


# ------------------------------------------------------------ consolidation
def new_record_count(offers: DataFrame, as_of: str) -> DataFrame:
    return offers.where(created_since(as_of, 1)).agg(F.count(F.lit(1)).alias("new_records"))


def consolidation_stats(offers: DataFrame, as_of: str) -> DataFrame:
    """Per source: all offers and those of the last day."""
    return offers.groupBy("spider_source").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(created_since(as_of, 1)).alias("new_records"))


# -------------------------------------------------------- market statistics
def _metric(rows: DataFrame, name: str, category: str, as_of: str, *values: Column) -> DataFrame:
    return rows.select(
        F.lit(name).alias("metric_name"),
        F.to_json(F.struct(*values)).alias("metric_value"),
        F.add_months(day(as_of), -1).alias("period_start"),
        day(as_of).alias("period_end"),
        F.lit(category).alias("category"))


def _recent(enriched: DataFrame, offers: DataFrame, condition: Column) -> DataFrame:
    return enriched_inner_offers(enriched, offers).where(condition)


def _count_by(offers: DataFrame, enriched: DataFrame, column: str, since: Column) -> DataFrame:
    joined = _recent(enriched.select("offre_id", column), offers, since & F.col(column).isNotNull())
    return joined.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def offers_by_sector(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    counts = _count_by(offers, enriched, "extracted_sector", posted_since(as_of, months=1))
    return _metric(counts, "offers_by_sector", "sector_analysis", as_of,
                   F.col("extracted_sector").alias("sector"), F.col("count"))


def offers_by_contract_type(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    counts = _count_by(offers, enriched, "extracted_contract_type", posted_since(as_of, months=1))
    return _metric(counts, "offers_by_contract_type", "contract_analysis", as_of,
                   F.col("extracted_contract_type").alias("contract_type"), F.col("count"))


def salary_summary(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    """One row, also for no input: average minimum and maximum, median of the whole midpoints."""
    bounds = enriched.select("offre_id", "extracted_salary_min", "extracted_salary_max").where(
        "extracted_salary_min IS NOT NULL AND extracted_salary_max IS NOT NULL")
    recent = _recent(bounds, offers, posted_since(as_of, months=1))
    # One row per midpoint serves the averages and the median. It is written, so the join runs once.
    midpoints = recent.groupBy(F.expr("(extracted_salary_min + extracted_salary_max) div 2").alias("_value")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("extracted_salary_min").alias("low"), F.sum("extracted_salary_max").alias("high"))
    midpoints = written(midpoints, "midpoints")
    averages = midpoints.agg(F.try_divide(F.sum("low"), F.sum("_n")).alias("avg_min_salary"),
                             F.try_divide(F.sum("high"), F.sum("_n")).alias("avg_max_salary"))
    return single_row([averages, median_of_counts(midpoints, "median_salary")])


def salary_distribution(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    return _metric(salary_summary(offers, enriched, as_of), "salary_distribution", "salary_analysis", as_of,
                   F.col("avg_min_salary"), F.col("avg_max_salary"), F.col("median_salary"))


def job_market_overview(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    """Per month of the last year: offers, companies, locations, salaries, usual contract and sector.

    Distinct counts and modes are taken from one aggregation by (month, kind, value),
    combined before its shuffle; the final step sees one row per distinct value.
    """
    postings = offers.where(posted_since(as_of, months=12)).select(
        "id", "company_name", "location", "contract_type",
        F.trunc("posted_date", "month").alias("month"))
    facts = enriched.select("offre_id", "extracted_salary_min", "extracted_salary_max", "extracted_sector")
    joined = offers_left_enriched(postings, facts)
    kinds = {"company": "company_name", "location": "location", "contract": "contract_type",
             "sector": "extracted_sector"}
    everything = F.struct(F.lit("all").alias("kind"), F.lit(None).cast("string").alias("value"))
    parts = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in kinds.items()]
    exploded = joined.select(
        "month",
        F.col("extracted_salary_min").alias("low"), F.col("extracted_salary_max").alias("high"),
        F.inline(F.filter(F.array(everything, *parts), lambda p: (p["kind"] == "all") | p["value"].isNotNull())))
    counted = exploded.groupBy("month", "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), F.avg("low").alias("low"), F.avg("high").alias("high"))

    def whole(column: str) -> Column:
        return F.max(F.when(F.col("kind") == "all", F.col(column)))

    def most_common(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct((-F.col("n")).alias("order"), F.col("value"))))["value"]

    return counted.groupBy("month").agg(
        whole("n").alias("total_offers"),
        F.count_if(F.col("kind") == "company").alias("unique_companies"),
        F.count_if(F.col("kind") == "location").alias("unique_locations"),
        whole("low").alias("avg_salary_min"),
        whole("high").alias("avg_salary_max"),
        most_common("contract").alias("most_common_contract"),
        most_common("sector").alias("most_common_sector"),
    ).orderBy(F.desc("month"))


# ------------------------------------------------------------- daily report
def totals(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    """One row with all and today's offers and enrichments."""
    return single_row([
        offers.agg(F.count(F.lit(1)).alias("total_offers"),
                   F.count_if(created_since(as_of)).alias("new_offers_today")),
        enriched.agg(F.count(F.lit(1)).alias("total_enriched"),
                     F.count_if(processed_since(as_of)).alias("new_enriched_today")),
    ])


def avg_salary_range(enriched: DataFrame) -> DataFrame:
    return enriched.where("extracted_salary_min IS NOT NULL").agg(
        F.coalesce(F.avg("extracted_salary_min"), F.lit(0.0)).alias("avg_min_salary"),
        F.coalesce(F.avg("extracted_salary_max"), F.lit(0.0)).alias("avg_max_salary"))


def top_sectors(offers: DataFrame, enriched: DataFrame, as_of: str, n: int = TOP_SECTORS) -> DataFrame:
    counts = _count_by(offers, enriched, "extracted_sector", posted_since(as_of, days=7))
    return counts.select(F.col("extracted_sector").alias("sector"), "count") \
        .orderBy(F.desc("count"), "sector").limit(n)


def top_skills(offers: DataFrame, enriched: DataFrame, as_of: str, n: int = TOP_SKILLS) -> DataFrame:
    recent = _recent(enriched.select("offre_id", "extracted_skills"), offers, posted_since(as_of, days=7))
    return recent.select(F.explode("extracted_skills").alias("skill")) \
        .groupBy("skill").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), "skill").limit(n)


# ------------------------------------------------------------- completeness
def present(df: DataFrame, targets: Iterable[str]) -> list[str]:
    return [c for c in targets if c in df.columns]


def complete_mask(df: DataFrame, targets: Iterable[str] = rules.TARGET_COLUMNS) -> Column:
    """True where every target column that exists is filled."""
    mask = F.lit(True)
    for column in present(df, targets):
        mask = mask & F.col(column).isNotNull()
    return mask


def completeness(df: DataFrame, targets: Iterable[str] = rules.TARGET_COLUMNS) -> DataFrame:
    """One row per existing target column: filled, empty and percentage, with the row totals."""
    names = present(df, targets)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(complete_mask(df, targets)).alias("complete_rows"),
        *[F.count(c).alias(c) for c in names])
    total = F.col("total_rows")
    per_column = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null")) for c in names])
    return counts.select("total_rows", "complete_rows", F.inline(per_column)).select(
        "column", "non_null",
        (total - F.col("non_null")).alias("null_count"),
        F.bround(F.try_divide(F.col("non_null"), total) * 100, 2).alias("completeness"),
        "total_rows", "complete_rows",
        (total - F.col("complete_rows")).alias("incomplete_rows"))


def enrichment_coverage(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("extracted_sector").alias("with_enrichment"),
        F.count_if(F.col("extracted_sector").isNull()).alias("without_enrichment"))


def fill_report(before: DataFrame, after: DataFrame, targets: Iterable[str] = rules.TARGET_COLUMNS) -> DataFrame:
    """Per target column: filled rows before and after, and the difference."""
    old = completeness(before, targets).select("column", F.col("non_null").alias("before"))
    new = completeness(after, targets).select("column", F.col("non_null").alias("after"))
    return old.join(new, "column").withColumn("improvement", F.col("after") - F.col("before"))


def acceptance_rate(predictions: DataFrame) -> DataFrame:
    """Accepted among all predictions."""
    return predictions.agg(
        F.count_if("accepted").alias("accepted"), F.count(F.lit(1)).alias("total"),
        F.try_divide(F.count_if("accepted"), F.count(F.lit(1))).alias("rate"))


def extraction_rate(df: DataFrame) -> DataFrame:
    """Rows in which skills and salaries were found."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size("extracted_skills") > 0).alias("with_skills"),
        F.count("extracted_salary_min").alias("with_salary"))
