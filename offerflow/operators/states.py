"""Mergeable daily states of the offer market: reports over a period merge its days and read no offers again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerflow.operators.enrich import offers_left_enriched

#: Log2 of the registers of a distinct count (standard error 1.6 %) and size of a quantile sketch (rank error 1.7 %).
REGISTERS, ITEMS = 12, 200
_COUNTED = {"contract": "contract_type", "sector": "extracted_sector"}


def daily_states(offers: DataFrame, enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of every day on which offers were posted: one row of sums and sketches, and the counts of contract types and sectors.

    Offers without a date belong to no day. A day's row has a bounded size; its counts have a row for each value.
    """
    facts = enriched.select("offre_id", "extracted_salary_min", "extracted_salary_max", "extracted_sector")
    rows = offers_left_enriched(offers.where("posted_date IS NOT NULL").select(
        "id", "company_name", "location", "contract_type", F.col("posted_date").cast("date").alias("day")), facts)
    middle = F.expr("(extracted_salary_min + extracted_salary_max) div 2")
    states = rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("offers"),
        *[f(c).alias(f"{c}_{n}") for c in ("extracted_salary_min", "extracted_salary_max") for n, f in (("sum", F.sum), ("count", F.count))],
        F.hll_sketch_agg("company_name", REGISTERS).alias("companies"), F.hll_sketch_agg("location", REGISTERS).alias("locations"),
        F.kll_sketch_agg_bigint(middle, ITEMS).alias("middles"))
    values = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, c in _COUNTED.items()])
    counts = rows.select("day", F.inline(values)).where("value IS NOT NULL").groupBy("day", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    return states, counts


def append_states(offers: DataFrame, enriched: DataFrame, path: str, batch: int) -> None:
    """Write the states of a batch of offers. Days may have come before: states of one day add up. Repeating a batch overwrites it."""
    for name, rows in zip(("states", "counts"), daily_states(offers, enriched), strict=True):
        rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")


def overview_of_states(spark: SparkSession, path: str, period: Column, since: Column) -> DataFrame:
    """Figures of each period, a function of ``day``, for the days that satisfy ``since``.

    Counts, averages and the commonest values are exact. ``companies`` and ``locations`` are estimates with a
    standard error of 1.6 %, ``median_salary`` is a value whose rank is within 1.7 % of the middle. What is read are the states only.
    """
    def average(column: str) -> Column:
        return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_count"))

    states = spark.read.parquet(f"{path}/states").where(since).withColumn("period", period)
    merged = states.groupBy("period").agg(
        F.sum("offers").alias("total_offers"), average("extracted_salary_min").alias("avg_salary_min"),
        average("extracted_salary_max").alias("avg_salary_max"), F.hll_sketch_estimate(F.hll_union_agg("companies")).alias("companies"),
        F.hll_sketch_estimate(F.hll_union_agg("locations")).alias("locations"), F.kll_merge_agg_bigint("middles").alias("_middles"))
    some = F.kll_sketch_get_n_bigint("_middles") > 0
    merged = merged.withColumn("median_salary", F.when(some, F.kll_sketch_get_quantile_bigint("_middles", F.lit(0.5)))).drop("_middles")
    counts = spark.read.parquet(f"{path}/counts").where(since).groupBy(period.alias("period"), "kind", "value").agg(F.sum("n").alias("n"))
    commonest = counts.groupBy("period").agg(*[
        F.min(F.when(F.col("kind") == kind, F.struct((-F.col("n")).alias("order"), F.col("value"))))["value"].alias(f"most_common_{kind}")
        for kind in _COUNTED])
    return merged.join(commonest, "period", "left")
