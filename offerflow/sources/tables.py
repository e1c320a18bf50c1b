"""Reading and writing of offer tables, referentials and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerflow import rules, schemas
from offerflow.functions.dates import moment
from offerflow.operators.consolidate import new_offers
from offerflow.operators.upsert import append_ids
from offerflow.sources.multiline import read_csv, read_json

FORMATS = ("csv", "json", "parquet")


# ------------------------------------------------------------------ reading
def read_offers(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Offers from a CSV, JSON or Parquet path, chosen by its extension.

    Files are split: a CSV record and a JSON object take a line each. With ``multi_line`` CSV cells may hold
    line breaks and a JSON file may be one array; files are split all the same, for two more exchanges of their lines.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    if kind not in FORMATS:
        raise ValueError(f"unsupported format: {path}")
    if multi_line and kind != "parquet":
        return {"csv": read_csv, "json": read_json}[kind](spark, path, schema)
    options = {"csv": {"header": True, "escape": '"'}, "json": {}, "parquet": {}}
    return spark.read.schema(schema).options(**options[kind]).format(kind).load(path)


def read_sources(spark: SparkSession, base: str, fmt: str = "parquet", **options: str) -> dict[str, DataFrame]:
    """The five raw tables below ``base``.

    With ``fmt="jdbc"`` the options carry the caller's connection and partitioning
    settings, and every table is read by its name.
    """
    def read(name: str) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        if fmt == "jdbc":
            return reader.option("dbtable", name).load()
        return reader.schema(schemas.RAW_SCHEMAS[name]).load(f"{base}/{name}")

    return {name: read(name) for name in rules.SOURCE_TAGS}


# ------------------------------------------------------------------ writing
def append_consolidated(new: DataFrame, path: str) -> None:
    """Append consolidated offers; offers already in the target are not written again."""
    schemas.conform(new, schemas.OFFERS).write.mode("append").parquet(path)


def append_missing(spark: SparkSession, candidates: DataFrame, path: str) -> None:
    """Append those candidates whose natural key the target does not hold yet (safe to repeat)."""
    known = spark.read.schema(schemas.OFFERS).parquet(path)
    append_consolidated(new_offers(candidates, known), path)


def append_enriched(rows: DataFrame, path: str) -> None:
    schemas.conform(rows, schemas.ENRICHED).write.mode("append").parquet(path)


def append_statistics(rows: DataFrame, path: str, as_of: str) -> None:
    schemas.conform(append_ids(rows, as_of), schemas.STATISTICS).write.mode("append").parquet(path)


def write_enriched_csv(df: DataFrame, path: str) -> None:
    """CSV with header; array columns are written as JSON text."""
    columns = [
        (F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)).alias(f.name)
        for f in df.schema
    ]
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


# -------------------------------------------------------- skill referential
REFERENTIAL = T.StructType([
    T.StructField("technical_skills", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("soft_skills", T.ArrayType(T.StringType())),
])


def default_referential(spark: SparkSession) -> DataFrame:
    """The built-in skills as rows (skill, category, kind)."""
    rows = [(s, c, "technical") for c, skills in rules.TECHNICAL_SKILLS.items() for s in skills]
    rows += [(s, "soft_skills", "soft") for s in rules.SOFT_SKILLS]
    return spark.createDataFrame(rows, "skill string, category string, kind string")


def read_skill_referential(spark: SparkSession, path: str) -> DataFrame:
    """Skill rows of a JSON referential; a missing part keeps its built-in skills."""
    stored = spark.read.schema(REFERENTIAL).json(path, multiLine=True)
    defaults = default_referential(spark)
    technical = stored.select(F.explode("technical_skills").alias("category", "skills")) \
        .select(F.explode("skills").alias("skill"), "category", F.lit("technical").alias("kind"))
    soft = stored.select(F.explode("soft_skills").alias("skill")) \
        .select("skill", F.lit("soft_skills").alias("category"), F.lit("soft").alias("kind"))

    def default_for(kind: str, column: str) -> DataFrame:
        absent = stored.where(F.col(column).isNull()).select(F.lit(kind).alias("kind"))
        return defaults.join(absent, "kind", "left_semi").select("skill", "category", "kind")

    return technical.unionByName(soft) \
        .unionByName(default_for("technical", "technical_skills")) \
        .unionByName(default_for("soft", "soft_skills")) \
        .select(F.lower("skill").alias("skill"), "category", "kind")


def write_skill_referential(referential: DataFrame, path: str, as_of: str) -> None:
    """One JSON object with technical, soft and named patterns and the time of writing."""
    by_category = referential.where("kind = 'technical'").groupBy("category").agg(
        F.sort_array(F.collect_set("skill")).alias("skills"))
    technical = by_category.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("category", "skills")))).alias("technical_skills"))
    soft = referential.where("kind = 'soft'").agg(F.sort_array(F.collect_set("skill")).alias("soft_skills"))
    patterns = F.create_map(*[F.lit(x) for pair in rules.NAMED_SKILL_PATTERNS.items() for x in pair])
    merged = technical.unionByName(soft, allowMissingColumns=True).agg(
        F.any_value("technical_skills", True).alias("technical_skills"),
        F.any_value("soft_skills", True).alias("soft_skills"))
    merged.select(F.to_json(F.struct(
        "technical_skills", "soft_skills", patterns.alias("skill_patterns"),
        F.date_format(moment(as_of), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("last_updated"),
    )).alias("value")).write.mode("overwrite").text(path)
