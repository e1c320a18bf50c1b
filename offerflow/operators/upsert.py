"""Upserts, patches and retention as set operations over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.dates import NTZ, day, moment
from offerflow.operators.keyed import last_per_key

# Columns that a repeated URL overwrites; all others keep their first value.
URL_UPDATE_COLUMNS = (
    "title", "company_name", "company_sectors", "description", "contract", "region",
    "education", "experience", "skills", "posted", "scraped_at",
)
PATCH_VERSION = "1.0"


def upsert_by_url(target: DataFrame, batch: DataFrame, order: list[Column]) -> DataFrame:
    """The target after inserting or updating the batch by ``url``.

    Of several batch rows with one URL the first inserts and the last updates, as if
    they had been applied one by one. Batch rows without a URL never meet another row and are inserted as they are.
    """
    columns = target.columns
    kept = [c for c in columns if c not in URL_UPDATE_COLUMNS and c != "url"]
    updated = [c for c in columns if c in URL_UPDATE_COLUMNS]
    position = F.struct(*order)
    folded = batch.where("url IS NOT NULL").groupBy("url").agg(
        F.min_by(F.struct(*kept), position).alias("_first"),
        F.max_by(F.struct(*updated), position).alias("_last"))
    old = target.select("url", F.struct(*[c for c in columns if c != "url"]).alias("_old"))
    merged = old.join(folded, "url", "full_outer")

    def value(name: str) -> Column:
        if name == "url":
            return F.col("url")
        if name in updated:
            return F.when(F.col("_last").isNotNull(), F.col("_last")[name]).otherwise(F.col("_old")[name])
        return F.when(F.col("_old").isNotNull(), F.col("_old")[name]).otherwise(F.col("_first")[name])

    nameless = batch.where("url IS NULL").select(*columns)
    return merged.select(*[value(c).alias(c) for c in columns]) \
        .unionByName(nameless)


def upsert_by_key(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The target with whole rows replaced by primary key; the last batch row wins."""
    latest = last_per_key(batch, [key], order).select(*target.columns)
    return target.join(latest.select(key), key, "left_anti").unionByName(latest)


def touch_updated_at(rows: DataFrame, as_of: str, matched: Column | None = None) -> DataFrame:
    """Set ``updated_at`` on the (matched) rows."""
    stamp = moment(as_of)
    if matched is not None:
        stamp = F.when(matched, stamp).otherwise(F.col("updated_at"))
    return rows.withColumn("updated_at", stamp)


def latest_enrichment(enriched: DataFrame) -> DataFrame:
    """One enrichment per offer: the most recently processed one."""
    return last_per_key(enriched, ["offre_id"], [F.col("processed_at"), F.col("id")])


def patch_enrichment(
    enriched: DataFrame, predicted: DataFrame, as_of: str, order: list[Column] | None = None,
) -> DataFrame:
    """The enrichments after applying predictions keyed by offer ``id``.

    Only non-NULL predictions overwrite, and only on the latest enrichment of an offer;
    offers without one get a new row. Predictions without an id are skipped. Of several
    predictions for an offer the last non-NULL value of each column in ``order`` wins, as if they
    had been applied one by one; without an order the predictions of an offer must be alike.
    """
    columns = enriched.columns
    filled = [c for c in rules.TARGET_COLUMNS if c in predicted.columns]
    place = F.struct(*(order or [F.struct(*filled)]))
    folded = predicted.where("id IS NOT NULL").groupBy("id").agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in filled])
    new = folded.select(F.col("id").alias("_offer"), F.struct(*filled).alias("_new"))
    # One row per offer id, and the id of the enrichment that a prediction changes.
    current = enriched.where("offre_id IS NOT NULL").groupBy("offre_id").agg(
        F.max_by("id", F.struct("processed_at", "id")).alias("_target"))
    aimed = new.join(current, new["_offer"] == current["offre_id"], "left").drop("offre_id")
    patched = enriched.join(
        aimed.where("_target IS NOT NULL").select("_target", F.col("_new")),
        enriched["id"] == F.col("_target"), "left")

    def updated(name: str) -> Column:
        if name in filled:
            return F.coalesce(F.col("_new")[name], F.col(name))
        if name == "processed_at":
            return F.when(F.col("_target").isNotNull(), moment(as_of)).otherwise(F.col(name))
        return F.col(name)

    def created(name: str) -> Column:
        fixed = {
            "id": F.md5(F.concat_ws("|", F.lit("patch"), "_offer")), "offre_id": F.col("_offer"),
            "processing_version": F.lit(PATCH_VERSION), "processed_at": moment(as_of),
        }
        if name in filled:
            return F.col("_new")[name]
        return fixed.get(name, F.lit(None)).cast(enriched.schema[name].dataType)

    return patched.select(*[updated(c).alias(c) for c in columns]).unionByName(
        aimed.where("_target IS NULL").select(*[created(c).alias(c) for c in columns]))


def upsert_counts(target: DataFrame, batch: DataFrame, target_key: str, batch_key: str) -> DataFrame:
    """One row: how many batch rows update an existing key, how many create one."""
    keys = target.select(F.col(target_key).alias("_known")).where("_known IS NOT NULL").distinct()
    joined = batch.where(F.col(batch_key).isNotNull()).join(keys, F.col(batch_key) == F.col("_known"), "left")
    return joined.agg(
        F.count_if(F.col("_known").isNotNull()).alias("updated"),
        F.count_if(F.col("_known").isNull()).alias("created"))


def expired(as_of: str) -> Column:
    """Posted more than two years ago; offers without a date never expire."""
    return F.coalesce(F.col("posted_date") < F.add_months(day(as_of), -24), F.lit(False))


def apply_retention(offers: DataFrame, enriched: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Offers and enrichments that remain; enrichments go with their deleted offer."""
    deleted = offers.where(expired(as_of)).select(F.col("id").alias("offre_id")).distinct()
    return offers.where(~expired(as_of)), enriched.join(deleted, "offre_id", "left_anti").select(
        *enriched.columns)


def append_ids(rows: DataFrame, as_of: str) -> DataFrame:
    """Statistics rows with a reproducible id and their creation time."""
    key = F.md5(F.concat_ws("|", "metric_name", "metric_value", F.col("period_end").cast("string")))
    return rows.withColumns({"id": key, "created_at": F.lit(as_of).cast(NTZ)})
