"""Consolidation of the raw source tables into one table of offers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.dates import moment
from offerflow.functions.text import coalesce_description, url_id
from offerflow.operators.keyed import first_per_key

NATURAL_KEY = ["spider_source", "original_id"]


def _date(name: str) -> Column:
    return F.col(name).try_cast("date")


# Per raw table: the consolidated columns that do not simply carry over.
def _source_columns() -> dict[str, dict[str, Column]]:
    return {
        "emplois": {
            "posted_date": _date("posted_date"),
            "description": coalesce_description(F.col("description_p"), F.col("description_ul")),
        },
        "senjobs": {
            "company_name": F.lit(None),
            "posted_date": _date("posted_date"),
            "salary": F.col("salaire"),
            "category": F.col("categorie"),
            "expiration_date": _date("expiration"),
        },
        "emploi_expatdakar": {
            "company_name": F.col("employeur"),
            "posted_date": _date("posted_date"),
            "contract_type": F.col("type_contrat"),
            "sector": F.col("secteur"),
            "experience_level": F.col("niveau"),
            "education_level": F.col("niveau_etude"),
            "nb_positions": F.coalesce(F.col("nb_postes").try_cast("int"), F.lit(1)),
        },
        "jobs_emploi_senegal": {
            "location": F.col("region"),
            "posted_date": _date("posted"),
            "contract_type": F.col("contract"),
            "category": F.col("metier_type"),
            "sector": F.col("company_sectors"),
            "experience_level": F.col("experience"),
            "education_level": F.col("education"),
        },
        "concoursn_stages": {
            "location": F.lit(None),
            "company_name": F.col("company"),
            "posted_date": _date("posted_date"),
            "contract_type": F.lit("Stage"),
            "category": F.col("categories"),
        },
    }


_CARRIED = ("title", "url", "location", "company_name", "source", "description", "contract_type")
_COLUMNS = (
    ("title", "string"), ("url", "string"), ("location", "string"), ("company_name", "string"),
    ("posted_date", "date"), ("source", "string"), ("description", "string"), ("contract_type", "string"),
    ("salary", "string"), ("category", "string"), ("sector", "string"), ("experience_level", "string"),
    ("education_level", "string"), ("nb_positions", "int"), ("expiration_date", "date"),
)


def with_id(df: DataFrame) -> DataFrame:
    return df.where(F.col("id").isNotNull())


def map_source(name: str, raw: DataFrame) -> DataFrame:
    """Project one raw table to the consolidated columns."""
    special = _source_columns()[name]
    defaults = {c: F.col(c) for c in _CARRIED} | {"nb_positions": F.lit(1)}

    def column(target: str, kind: str) -> Column:
        return special.get(target, defaults.get(target, F.lit(None))).cast(kind).alias(target)

    return with_id(raw).select(
        F.lit(rules.SOURCE_TAGS[name]).alias("spider_source"),
        F.col("id").alias("original_id"),
        *[column(target, kind) for target, kind in _COLUMNS],
    )


def map_emplois(raw: DataFrame) -> DataFrame:
    return map_source("emplois", raw)


def map_senjobs(raw: DataFrame) -> DataFrame:
    return map_source("senjobs", raw)


def map_emploi_expatdakar(raw: DataFrame) -> DataFrame:
    return map_source("emploi_expatdakar", raw)


def map_jobs_emploi_senegal(raw: DataFrame) -> DataFrame:
    return map_source("jobs_emploi_senegal", raw)


def map_concoursn_stages(raw: DataFrame) -> DataFrame:
    return map_source("concoursn_stages", raw)


def offer_id() -> Column:
    """Deterministic id of an offer, so that a repeated run adds nothing."""
    return F.md5(F.concat_ws("|", *NATURAL_KEY))


def new_offers(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates whose natural key is not among the known offers: one anti join for all sources."""
    return candidates.join(known.select(*NATURAL_KEY).distinct(), NATURAL_KEY, "left_anti")


def consolidate(sources: dict[str, DataFrame], known: DataFrame | None, as_of: str) -> DataFrame:
    """New consolidated offers of all raw tables, ready to append."""
    mapped = reduce(DataFrame.unionByName, [map_source(name, raw) for name, raw in sources.items()])
    fresh = mapped if known is None else new_offers(mapped, known)
    return fresh.select(
        offer_id().alias("id"), "*", moment(as_of).alias("created_at"), moment(as_of).alias("updated_at"))


def consolidation_rejects(sources: dict[str, DataFrame]) -> DataFrame:
    """Raw values that could not be read as a date or a number: (table, id, column, value)."""
    checked = {
        "emplois": {"posted_date": "date"},
        "senjobs": {"posted_date": "date", "expiration": "date"},
        "emploi_expatdakar": {"posted_date": "date", "nb_postes": "int"},
    }

    def rejects(name: str) -> DataFrame:
        bad = F.array_compact(F.array(*[
            F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(),
                   F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
            for c, kind in checked[name].items()
        ]))
        return with_id(sources[name]).select(F.lit(name).alias("table"), "id", F.inline(bad))

    return reduce(DataFrame.unionByName, [rejects(n) for n in checked if n in sources])


def requires_posted_date(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a posting date, and the rejected rows without one."""
    return df.where("posted_date IS NOT NULL"), df.where("posted_date IS NULL")


def dedup_by_url(items: DataFrame, order: list[Column]) -> DataFrame:
    """First item per URL, with the URL hash as ``id``."""
    return first_per_key(items.withColumn("id", url_id(F.col("url"))), ["id"], order)
