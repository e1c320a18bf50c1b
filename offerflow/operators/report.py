"""The daily report as one row, its texts, and the row that stores it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerflow.functions.dates import day
from offerflow.operators import stats
from offerflow.operators.keyed import single_row

# Texts of the report.
HTML_TEXT = (
    "<h2>📊 Rapport Quotidien - %s</h2>\n"
    "<p><b>Total offres:</b> %d</p>\n"
    "<p><b>Nouvelles offres:</b> %d</p>\n"
    "<p><b>Offres enrichies:</b> %d</p>\n"
    "<p><b>Nouvelles enrichies:</b> %d</p>\n"
    "<p><b>Salaire moyen min:</b> %s XOF</p>\n"
    "<p><b>Salaire moyen max:</b> %s XOF</p>"
)
SHORT_TEXT = "📊 Rapport Emploi Dakar %s\nTotal: %d, Nouvelles: %d, Enrichies: %d"
CARD_TITLE = "📊 Rapport Emploi Dakar - "
CARD_FIELDS = ("Total Offres", "Nouvelles Offres")
CARD_COLOR = 3447003


def daily_report(offers: DataFrame, enriched: DataFrame, as_of: str) -> DataFrame:
    """One row: date, summary, salary averages, top sectors and top skills."""
    # At most five and ten rows reach the lists.
    sectors = stats.top_sectors(offers, enriched, as_of).agg(
        F.collect_list(F.struct((-F.col("count")).alias("order"), "sector")).alias("_sectors"))
    skills = stats.top_skills(offers, enriched, as_of).agg(
        F.collect_list(F.struct((-F.col("count")).alias("order"), "skill")).alias("_skills"))
    row = single_row([
        stats.totals(offers, enriched, as_of), stats.avg_salary_range(enriched), sectors, skills])

    def listed(column: str, name: str):
        return F.transform(F.array_sort(column), lambda r: F.struct(r[name].alias(name), (-r["order"]).alias("count")))

    return row.select(
        F.date_format(day(as_of), "yyyy-MM-dd").alias("date"),
        F.struct("total_offers", "new_offers_today", "total_enriched", "new_enriched_today").alias("summary"),
        F.struct("avg_min_salary", "avg_max_salary").alias("salary_info"),
        listed("_sectors", "sector").alias("top_sectors"),
        listed("_skills", "skill").alias("top_skills"))


def report_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct(*report.columns)).alias("report"))


def save_daily_report(report: DataFrame, as_of: str) -> DataFrame:
    """The statistics row that stores the report."""
    return report_json(report).select(
        F.lit("daily_summary_report").alias("metric_name"), F.col("report").alias("metric_value"),
        day(as_of).alias("period_start"), day(as_of).alias("period_end"),
        F.lit("admin_report").alias("category"))


def report_lines(report: DataFrame) -> DataFrame:
    """Text forms of the report: HTML block, short text and two-field card."""
    summary, salary = F.col("summary"), F.col("salary_info")
    counts = [summary[c] for c in ("total_offers", "new_offers_today", "total_enriched", "new_enriched_today")]
    averages = [F.bround(salary[c], 0).cast("bigint").cast("string") for c in ("avg_min_salary", "avg_max_salary")]
    fields = [
        F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), F.lit(True).alias("inline"))
        for name, value in zip(CARD_FIELDS, counts)
    ]
    card = F.to_json(F.struct(
        F.concat(F.lit(CARD_TITLE), "date").alias("title"), F.array(*fields).alias("fields"),
        F.lit(CARD_COLOR).alias("color")))
    return report.select(
        F.format_string(HTML_TEXT, "date", *counts, *averages).alias("html"),
        F.format_string(SHORT_TEXT, "date", *counts[:3]).alias("short_text"),
        card.alias("card"))
